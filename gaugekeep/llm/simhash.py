"""SimHash fingerprints of documents.

Every word votes on the 64 bits of its hash, with a weight of its length (up to
MAX_WEIGHT) at each occurrence. Votes are summed two bits to a long: the sum of
((hash >> i) & 0x100000001) * weight counts bit i in the low half and bit i + 32
in the high half, so a document needs 32 sums, exact up to 2^32 / MAX_WEIGHT
words. A bit is set if more than half of the weight votes for it.

Cases: a null text is empty; a text without words has fingerprint 0; long texts
are taken whole; equal texts have equal fingerprints; repeated rows and ids are
separate documents (ties of ids go by text); null ids sort first; an empty table
gives no rows; a single document is its own next one.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_WEIGHT = 16
LANE = 0x100000001
LOW = 0xFFFFFFFF
# Order range pieces: documents in a row lie in one piece; far below a driver's bound.
MAX_PIECES = 10_000


def _votes() -> list[Column]:
    h, w = F.col("h"), F.col("w")
    return [F.sum(F.shiftright(h, i).bitwiseAND(F.lit(LANE)) * w).alias(f"v{i}") for i in range(32)] + [F.sum("w").alias("all")]


def _bits() -> Column:
    """The fingerprint as a long, from the votes."""
    out = F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"v{i}").bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(F.col(f"v{i}"), 32)
        for lane, bit in ((low, i), (high, i + 32)):
            out = out.bitwiseOR(F.when(lane * 2 > F.col("all"), F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
    return out


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """`keys` and fp (long) for each row; rows without words are left out. If
    `rows` is partitioned by a subset of `keys`, nothing is shuffled."""
    word = F.explode(F.split(F.col(text), r"\s+"))
    words = rows.select(*keys, word.alias("word")).filter("word <> ''").select(
        *keys, F.xxhash64(F.lower("word")).alias("h"), F.least(F.length("word"), F.lit(MAX_WEIGHT)).cast("long").alias("w"))
    return words.groupBy(*keys).agg(*_votes()).select(*keys, _bits().alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """1 - Hamming distance / 64."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def as_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _pieces(src: DataFrame) -> DataFrame:
    """`src` (doc_id, text) dealt into ranges of ids: columns piece, key, extra.

    A range starts at an id that exists; its documents also go, as `extra`, to
    the range before, so that every document has its successor in its piece."""
    spark = src.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    n = max(1, min(MAX_PIECES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts = [i / n for i in range(n)]
    got = src.select(key.alias("k")).agg(F.percentile_approx("k", cuts, 10_000).alias("q"), F.min("k").alias("low")).collect()[0]
    starts = sorted({got.low, *(got.q or [])}) if got.low is not None else [0]
    array = F.expr("array(" + ", ".join(f"{s}L" if s > -(1 << 63) else "CAST('-9223372036854775808' AS BIGINT)" for s in starts) + ")")
    steps = []
    step = 1 << (len(starts).bit_length() - 1)
    while step:
        steps.append(step)
        step >>= 1
    # number of starts that are not above the key, by halving steps
    place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when(
        (at + s <= len(starts)) & (F.try_element_at(array, at + s) <= F.col("key")), at + s).otherwise(at))
    rows = src.withColumn("key", key).withColumn("at", place - 1)
    before = F.pmod(F.col("at") - 1, F.lit(len(starts)))
    own = F.struct(F.col("at").alias("piece"), F.lit(False).alias("extra"))
    again = F.struct(before.alias("piece"), F.lit(True).alias("extra"))
    first = F.element_at(array, F.col("at") + 1) == F.col("key")
    rows = rows.withColumn("p", F.explode(F.when(first, F.array(own, again)).otherwise(F.array(own))))
    return rows.select("doc_id", "text", "key", F.col("p.piece").alias("piece"), F.col("p.extra").alias("extra"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, whose last half is
    replaced by the start of the next document (by id; after the last the first)."""
    src = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = _pieces(src).repartition(F.col("piece"))
    in_order = Window.partitionBy("piece").orderBy("extra", "key", "text")
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.select("piece", "extra", "doc_id", "key", "text", F.row_number().over(in_order).alias("place"),
                       F.lead("text").over(in_order).alias("next_text"))
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", F.when(~F.col("extra"), edited))
    both = rows.select("piece", "place", "extra", "doc_id", F.length("text").cast("long").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"),
                       F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")),
                                         F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))).alias("x"))
    # one leading mark keeps texts without words: it votes with weight 0
    words = both.select("piece", "place", "extra", "doc_id", "n_chars", "edited_sha256",
                        F.explode(F.split(F.concat(F.lit(" "), F.coalesce("x.t", F.lit(""))), r"\s+")).alias("word"), F.col("x.side").alias("side"))
    h = F.when(F.col("word") == "", 0).otherwise(F.xxhash64(F.lower("word"))).alias("h")
    w = F.least(F.length("word"), F.lit(MAX_WEIGHT)).cast("long").alias("w")
    keys = ["piece", "place", "extra", "doc_id", "n_chars", "edited_sha256", "side"]
    fp = words.select(*keys, h, w).groupBy(*keys).agg(*_votes()).select(*keys, _bits().alias("fp"))
    docs_ = fp.groupBy(*keys[:-1]).agg(F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fp"),
                                       F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("efp"))
    by_place = Window.partitionBy("piece").orderBy("place")
    out = docs_.withColumn("nfp", F.lead("fp").over(by_place)).filter(~F.col("extra"))
    return out.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
                      as_text(F.col("efp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
                      likeness(F.col("fp"), F.col("nfp")).alias("near_next"))


def near_fingerprints(prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(a, b, distance), a < b: all pairs of different fingerprints (column fp,
    long) within `radius` bits.

    The 64 bits are cut into blocks. Of a near pair at most `radius` blocks
    differ, so in one of the permuted tables, each keyed by a choice of
    blocks - radius blocks, the two have the same key. A pair is kept in the
    first table that shows it. Copies of a fingerprint are one row."""
    if not 0 <= radius < blocks <= 16:
        raise ValueError("0 <= radius < blocks <= 16 is needed")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (e - s)) - 1) << s for s, e in zip(edges, edges[1:], strict=False)]
    tables = [sum(c) for c in combinations(masks, blocks - radius)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in tables]
    fps = prints.select("fp").filter("fp IS NOT NULL").distinct()
    keys = F.explode(F.array(*(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(signed))))
    rows = fps.select("fp", keys.alias("x")).select("fp", "x.t", "x.k")
    pairs = rows.toDF("a", "t", "k").join(rows.toDF("b", "t", "k"), ["t", "k"]).filter("a < b")
    x = F.col("a").bitwiseXOR(F.col("b"))
    first = F.array_position(F.array(*(x.bitwiseAND(F.lit(m)) == 0 for m in signed)), F.lit(True)) - 1
    return pairs.filter((F.bit_count(x) <= radius) & (first == F.col("t"))).select("a", "b", F.bit_count(x).alias("distance"))
