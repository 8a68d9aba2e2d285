"""URL verdicts: host and path rules first, a logistic regression for the rest.

The regression sees hashed character n-grams of host and path. It is trained
on a small labelled URL table (at most TRAIN_ROWS different URLs, the first by
hash); everything runs on the JVM side.

Cases: a null URL or one without `://` has an empty host and path, fits no
rule and is judged by the regression's bias; long URLs are taken whole;
repeated rows get equal verdicts; an empty table gives no rows; if the labelled
table holds one verdict only, that is the answer, and `allow` if it is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 5_000
GRAMS = (2, 3, 4)
FEATURES = 1 << 14
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (host and path joined) and its verdict, or nulls.
    rules: (verdict, host, path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):  # the longest is tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, marked by where they come from."""
    def of(text: Column, mark: str, n: int) -> Column:
        framed = F.concat(F.lit("^"), text, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.length(framed) - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substr(framed, i, F.lit(n))))
    return F.concat(*(of(text, mark, n) for text, mark in ((host, "h"), (path, "p")) for n in GRAMS))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], labelled: DataFrame, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict of every row. labelled: (url, verdict)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF

    tf = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    host, path = host_path(F.col("url"))
    rows = labelled.select("url", "verdict").filter("verdict IN ('allow', 'block')").distinct()
    rows = rows.orderBy(F.xxhash64("url"), "url", "verdict").limit(TRAIN_ROWS)
    rows = rows.select(grams(host, path).alias("grams"), (F.col("verdict") == "block").cast("double").alias("label"))
    classes = sorted(r.label for r in rows.select("label").distinct().collect())

    out = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"))
    host, path = host_path(F.col("url"))
    out = out.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = out.withColumns({"rule": rule, "by_rule": verdict, "grams": grams(F.col("host"), F.col("path"))})
    if len(classes) == 2:
        model = LogisticRegression(maxIter=60, regParam=1e-3, standardization=False).fit(tf.transform(rows))
        out = model.transform(tf.transform(out))
        learnt = F.when(F.col("prediction") >= 0.5, "block").otherwise("allow")
    else:
        learnt = F.lit("block" if classes == [1.0] else "allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", learnt).alias("verdict"))


def labelled_by_rules(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url") -> DataFrame:
    """The URLs that a rule decides, as a labelled table."""
    urls = pages.select(pages[url_col].alias("url"))
    _, verdict = rule_of(*host_path(F.col("url")), rules)
    return urls.select("url", verdict.alias("verdict")).filter("verdict IS NOT NULL")
