"""Personal data: pattern spans, and terms that give protected entities away.

Patterns find emails, addresses, cards and phones (leftmost, not overlapping per
kind). They are the protected entities; the document is their context. The
corpus tells how strongly a word t discloses an entity e:

    p(e | t) = (n(t, e) + PRIOR p(e)) / (n(t) + PRIOR),   p(e) = n(e) / N
    bits = log2(n(t, e) / n(t) / p(e))

with n(t, e) the documents that have both, n(t) those with t, n(e) those with e
and N all documents, each different text counted once, whatever ids its copies
have. The prior stands for
a floor of support: with SHARE at one half, one document is enough for a word
that stands nowhere else, and a word of two documents has to be in both with e.
A word with p(e | t) >= SHARE and bits >= BITS for some e is a further span (kind
`term`) wherever it stands in any document, outside the pattern spans:
generalised to its kind, or removed from REMOVE_BITS on.

Entities of the same documents have the same counts and are counted as one
class, so a document of many entities has no product of words and entities.
Before rows are shuffled for a join, the 64-bit hashes of the other side's keys, if
they are at most SENT_KEYS (counted first), are broadcast to keep rows without a
partner out; with more keys the join alone decides.

Positions are code points. A match is found with the text before it
("gap, then match"), so lengths add up to positions; runs are possessive and
start at their left edge, so long runs cost linear time.

Cases: a null or empty text has no spans; long texts are taken whole; repeated
rows have equal spans and count as one document; an empty table gives no rows;
null ids are kept; names of other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugekeep.llm.common import stored, texts

KINDS = ("email", "ip", "card", "phone")
# Per kind: what a text must have for the search to be worth it, and the match.
GUARD = {"email": r"@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
MATCH = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"[\p{L}\p{M}\p{N}_]++"
PRIOR, SHARE, BITS, REMOVE_BITS = 1.0, 0.5, 4.0, 12.0
SENT_KEYS, BUCKETS = 1 << 20, 64
PLACED = "struct<at:int,out:array<struct<start:int,end:int,text:string>>>"


def _placed(text: Column, pattern: str, guard: Column) -> Column:
    """array<struct<start, end, text>> of the matches in a text."""
    whole = F.lit(rf"\G([\s\S]*?)({pattern})")  # each search starts where the last match ended, and only there
    pairs = F.arrays_zip(F.regexp_extract_all(text, whole, F.lit(1)).alias("gap"), F.regexp_extract_all(text, whole, F.lit(2)).alias("hit"))
    zero = F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(PLACED)

    def step(a, x):
        start = a["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("text")))).alias("out")).cast(PLACED)

    found = F.aggregate(pairs, zero, step, lambda a: a["out"])
    return F.when(guard, found).otherwise(F.array().cast("array<struct<start:int,end:int,text:string>>"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.split(F.reverse(digits), "")
    total = F.aggregate(F.transform(back, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0))), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _holds(kind: str, x: Column) -> Column:
    if kind == "ip":
        def small(p):
            short = F.regexp_replace(p, "^0+", "")
            return (F.length(short) < 3) | ((F.length(short) == 3) & (short <= "255"))
        return F.forall(F.split(x, r"\."), small)
    if kind == "card":
        return F.when(F.length(_digits(x)).between(14, 19), _luhn(_digits(x))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(x)).between(10, 15)
    return F.lit(True)


def base_spans(src: DataFrame) -> DataFrame:
    """`src` (with text) and spans: array<struct<start, ord, kind, end, value>>, in order."""
    for k in KINDS:
        src = src.withColumn(f"__{k}", _placed(F.col("text"), MATCH[k], F.col("text").rlike(GUARD[k])))
    def of(i: int, kind: str) -> Column:
        sound = F.filter(F.col(f"__{kind}"), lambda s: _holds(kind, s["text"]))
        return F.transform(sound, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("ord"), F.lit(kind).alias("kind"),
                                                     s["end"].alias("end"), F.lower(s["text"]).alias("value")))

    parts = [of(i, k) for i, k in enumerate(KINDS)]
    return src.withColumn("spans", F.array_sort(F.concat(*parts))).drop(*(f"__{k}" for k in KINDS))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _lower(x: Column) -> Column:
    """Lower case that a word has alone as in its text: one form of sigma."""
    return F.replace(F.lower(x), F.lit("ς"), F.lit("σ"))


def _classes(held: DataFrame) -> DataFrame:
    """k1, k2, n_e, x1, x2: the classes of entities of every document; n_e, x1, x2
    (count and hashes of a class's set of documents) name the class."""
    each = held.select("k1", "k2", F.explode(F.array_distinct(F.transform("spans", lambda s: F.xxhash64(s["kind"], s["value"])))).alias("entity"))
    named = each.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"), F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"))
    return each.join(named, "entity").select("k1", "k2", "n_e", "x1", "x2").distinct()


def disclosing(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, bits, n_t, n_in) above the thresholds, n_in the documents with t and
    some entity; and (k1, k2, term) of documents with entities. docs: k1, k2, spans,
    words and `counted`, which one document of every text is."""
    once = docs.filter("counted")
    total = float(once.count())
    held = docs.filter(F.size("spans") > 0)
    terms = (once.select((F.size("spans") > 0).cast("long").alias("held"), F.explode("words").alias("term"))
             .groupBy("term").agg(F.count(F.lit(1)).alias("n_t"), F.sum("held").alias("n_in"))
             .filter((F.col("n_in") > 0) & (F.col("n_t") <= total / 2**BITS)))  # n_te <= n_e: more documents have fewer bits
    here = stored(held.select("k1", "k2", "counted", F.explode("words").alias("term")).join(terms, "term"), "pii-words")

    def share(n_te: Column) -> Column:
        return (n_te + PRIOR * F.col("n_e") / F.lit(max(total, 1.0))) / (F.col("n_t") + PRIOR)

    both = (here.filter("counted").join(_classes(held.filter("counted")), ["k1", "k2"]).filter(share(F.least("n_t", "n_e")) >= SHARE)
            .groupBy("term", "n_t", "n_in", "n_e", "x1", "x2").agg(F.count(F.lit(1)).alias("n_te")))
    bits = F.log2(F.col("n_te") / F.col("n_t") * F.lit(total) / F.col("n_e"))
    found = (both.withColumn("bits", bits).filter((share(F.col("n_te")) >= SHARE) & (F.col("bits") >= BITS))
             .groupBy("term", "n_t", "n_in").agg(F.max("bits").alias("bits")))
    return stored(found, "pii-terms"), here.select("k1", "k2", "term")


def _among(x: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """Rows of `x` that may have a partner in `keys` by the column `name`."""
    if keys.count() > SENT_KEYS:
        return x
    sent = keys.select(F.xxhash64(name).alias("sent")).distinct()
    return x.join(F.broadcast(sent), F.xxhash64(name) == F.col("sent"), "left_semi")


def _bucket(x: Column) -> Column:
    return F.pmod(F.hash(x), F.lit(BUCKETS))


def _marked(docs: DataFrame) -> DataFrame:
    """k1, k2, spans, buckets, gone: a document's terms by bucket, and those to be removed."""
    terms, here = disclosing(docs)
    wide = terms.filter("n_t > n_in")  # the others stand in no document without entities
    rest = _among(docs.filter(F.size("spans") == 0).select("k1", "k2", F.explode("words").alias("term")), wide, "term")
    found = here.join(terms, "term").select("k1", "k2", "term", "bits").union(rest.join(wide, "term").select("k1", "k2", "term", "bits"))
    by_bucket = found.groupBy("k1", "k2", _bucket(F.col("term")).alias("b")).agg(
        F.collect_list("term").alias("terms"), F.collect_list(F.when(F.col("bits") >= REMOVE_BITS, F.col("term"))).alias("gone"))
    whole = by_bucket.groupBy("k1", "k2").agg(F.map_from_entries(F.collect_list(F.struct("b", "terms"))).alias("m"), F.flatten(F.collect_list("gone")).alias("gone"))
    buckets = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.coalesce(F.col("m")[b], F.array().cast("array<string>")))
    return whole.join(docs.select("k1", "k2", "spans"), ["k1", "k2"]).select("k1", "k2", "spans", buckets.alias("buckets"), "gone")


def _added() -> Column:
    """The places of the terms (`buckets`, by hash) in `text`, outside `spans`. These have to be
    columns of a table: an expression in their place would be evaluated again for every word."""
    whole = F.lit(rf"\G([\s\S]*?)({WORD})")
    pairs = F.arrays_zip(F.regexp_extract_all("text", whole, F.lit(1)).alias("gap"), F.regexp_extract_all("text", whole, F.lit(2)).alias("hit"))
    pairs = F.transform(pairs, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), _lower(x["hit"]).alias("word")))
    pairs = F.transform(pairs, lambda x: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), x["word"].alias("word"), F.array_contains(
        F.element_at("buckets", _bucket(x["word"]) + 1), x["word"]).alias("marked")))

    def step(a, x):  # places as text: an array in the state would be copied for every word
        place = F.concat_ws(":", (a["at"] + x["gap"]).cast("string"), (a["at"] + x["gap"] + x["hit"]).cast("string"), F.array_contains("gone", x["word"]).cast("string"))
        return F.struct((a["at"] + x["gap"] + x["hit"]).alias("at"), F.when(x["marked"], F.concat(a["out"], place, F.lit(","))).otherwise(a["out"]).alias("out")).cast("struct<at:int,out:string>")

    found = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast("struct<at:int,out:string>"), step, lambda a: a["out"])
    places = F.transform(F.filter(F.split(found, ","), lambda x: x != ""), lambda x: F.split(x, ":"))
    places = F.transform(places, lambda x: F.struct(x[0].cast("int").alias("start"), F.lit(len(KINDS)).alias("ord"), F.lit("term").alias("kind"),
                                                    x[1].cast("int").alias("end"), x[2].cast("boolean").alias("gone")))
    return F.filter(places, lambda w: ~F.exists("spans", lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))


def _keyed(src: DataFrame) -> DataFrame:
    return src.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64("text", "doc_id", F.lit(1))})


def _counted(src: DataFrame) -> DataFrame:
    """`src` with `counted`: true for one document of every text (repeated rows of
    it alike). Only keys are grouped; the texts that have copies are joined on, by
    broadcast if they are few."""
    text = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(2), "text").alias("t2")]
    copied = (src.select("k1", "k2", *text).groupBy("t1", "t2")
              .agg(F.min(F.struct("k1", "k2")).alias("one"), F.max(F.struct("k1", "k2")).alias("other")).filter("one <> other"))
    copied = stored(copied.select("t1", "t2", "one"), "pii-copied")
    if copied.count() <= SENT_KEYS:
        copied = F.broadcast(copied)
    keyed = src.withColumns({"__t1": text[0], "__t2": text[1]})
    keyed = keyed.join(copied, (F.col("__t1") == F.col("t1")) & (F.col("__t2") == F.col("t2")), "left")
    return keyed.withColumn("counted", F.coalesce(F.col("one") == F.struct("k1", "k2"), F.lit(True))).drop("__t1", "__t2", "t1", "t2", "one")


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k1, k2 (document key), doc_id, spans (base), added (terms, with `gone`
    true where the term is to be removed rather than generalised)."""
    src = _keyed(texts(docs, id_col, text_col))
    words = F.array_distinct(F.regexp_extract_all(_lower(F.col("text")), F.lit(WORD), F.lit(0)))
    found = stored(base_spans(_counted(src)).select("k1", "k2", "doc_id", "counted", "spans", words.alias("words")), "pii-spans")
    once = found.select("k1", "k2", "counted", "spans", "words")
    if not found.groupBy("k1", "k2").count().filter("count > 1").isEmpty():
        once = once.dropDuplicates(["k1", "k2"])
    marked = stored(_marked(once), "pii-marked")
    places = _among(src, marked, "k1").join(marked, ["k1", "k2"])
    added = places.select("k1", "k2", _added().alias("added")).dropDuplicates(["k1", "k2"])
    return found.select("k1", "k2", "doc_id", "spans").join(added, ["k1", "k2"], "left")


def _all(spans: Column, added: Column) -> Column:
    kind = "array<struct<start:int,ord:int,kind:string,end:int,gone:boolean>>"
    base = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["kind"].alias("kind"),
                                                 s["end"].alias("end"), F.lit(False).alias("gone")))
    return F.array_sort(F.concat(base.cast(kind), F.coalesce(added.cast(kind), F.array().cast(kind))))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    found = spans_of(docs, id_col, text_col)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"),
                        _joined(_all(F.col("spans"), F.col("added"))).alias("spans"))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with every span generalised to `[kind]` or removed; columns unchanged."""
    found = spans_of(docs, id_col, text_col).dropDuplicates(["k1", "k2"])
    found = found.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), _all(F.col("spans"), F.col("added")).alias("__spans"))
    keyed = _keyed(docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), F.struct("*").alias("row")))
    joined = keyed.join(found, (F.col("k1") == F.col("__k1")) & (F.col("k2") == F.col("__k2")), "left")
    text, state = F.col("text"), "struct<at:int,out:string>"

    def step(a, s):
        mark = F.when(s["gone"], F.lit("")).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        kept = F.substr(text, a["at"] + 1, s["start"] - a["at"])
        return F.when(s["start"] >= a["at"], F.struct(s["end"].alias("at"), F.concat(a["out"], kept, mark).alias("out")).cast(state)).otherwise(
            F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out")).cast(state))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(state)
    clean = F.aggregate("__spans", zero, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1, F.length(text))))
    shown = F.when(F.size("__spans") > 0, clean).otherwise(F.col("row")[text_col])
    return joined.select(*(shown.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
