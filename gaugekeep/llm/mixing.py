"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is its share of the budget, held at `most` times its own size;
what a held source leaves goes to the others by weight until none is above. The
target is met by complete epochs, each of which takes all documents of the source,
and then by a sample for what is left: a document's exponential key is -ln(u) / w
(u: uniform, from a hash of its id; w: its quality weight), documents are taken in
rising order of the keys, and the sizes' prefix sums say where the budget ends.
The document in which it ends is taken in part, so that the words taken equal the
rounded target.

No source is sorted in one place. A key becomes a number of 60 bits in the same
order, floor(2^48 * key), and the budget's end is found digit by digit (15 bits at
a time): sizes are summed by source and digit, the sums' prefix sums over at most
32,768 rows a source give the digit in which the budget ends, and the next round
looks at the documents of that digit only. So a hot source costs a few partial
sums, and each document's part follows from its own number alone.

Cases: a null text is empty and has size 0, which takes nothing; null sources are a
source of their own, the last; documents of one number (repeated rows or ids, null
ids) in which the budget ends share what is left in proportion to their sizes,
rounded down, so that the result doesn't depend on the order of rows; a quality
that is null or missing counts as 1, one that is not above 0 or not finite as
the least, LEAST_QUALITY; an empty table gives no rows. The list of sources (one
row each) is ranked and weighed in one task. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugekeep.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
# Bits of a number (12 of them before the point: a key is below 37 / LEAST_QUALITY) and of a digit.
BITS, POINT, DIGIT = 60, 48, 15
LEAST_QUALITY = 0.01
SEED = "mix"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size): the number of words of every document."""
    return docs.select(docs[id_col].alias("doc_id"), docs[source_col].cast("string").alias("source"),
                       F.coalesce(F.regexp_count(docs[text_col], F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sizes: DataFrame, weights: tuple[float, ...], budget: float, most: float) -> DataFrame:
    """(source, source_size, target) of the sources in `sizes` (source, source_size).

    In rising order of (most * size / weight) each source is held or none after it
    is: it is held if its limit lies below its share of what the held ones before
    it leave."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("place", place).withColumn("w", weigh).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    s = s.withColumn("ratio", F.col("cap") / F.col("w"))
    every = Window.partitionBy()
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("ratio", "place").rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) * F.lit(float(budget)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        / F.sum("w").over(after)
    s = s.withColumn("level", level)
    # the first source that is not held sets the level of all
    # (the levels rise up to it and fall after it)
    s = s.withColumn("level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(every))
    return s.select("source", "source_size",
                    F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("level"))).alias("target"))


def numbers(docs: DataFrame, quality: DataFrame | None) -> DataFrame:
    """`docs` (doc_id, source, size) with the number of each one's key."""
    digest = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))
    if quality is None:
        w = F.lit(1.0)
    else:
        given = quality.groupBy("doc_id").agg(F.avg("quality").alias("q")).withColumnRenamed("doc_id", "of_id")
        docs = docs.join(given, docs.doc_id == given.of_id, "left").drop("of_id")
        sound = (F.col("q") > LEAST_QUALITY) & (F.col("q") < float("inf"))  # NaN is above all
        w = F.when(F.col("q").isNull(), F.lit(1.0)).when(sound, F.col("q")).otherwise(F.lit(LEAST_QUALITY))
    key = -F.log(u) / w
    return docs.select("doc_id", "source", "size", F.floor(key * F.lit(float(1 << POINT))).cast("long").alias("place"))


def _ends(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """`sources` (source, ..., rest) with the number at which the budget ends, the
    words before it and those of its documents; nulls where all fits or nothing is left."""
    ends = sources.select("source", "rest", F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("before"))
    for shift in range(BITS - DIGIT, -1, -DIGIT):
        here = ends.select(F.col("source").alias("of"), "rest", "end", "before")
        within = docs.join(here, docs.source.eqNullSafe(F.col("of")) &
                           (F.shiftright("place", shift + DIGIT) == F.shiftright("end", shift + DIGIT)))
        sums = within.groupBy("of", "rest", "end", "before", F.shiftright("place", shift).alias("digit")).agg(F.sum("size").alias("words"))
        order = Window.partitionBy("of").orderBy("digit")
        sums = sums.withColumn("upto", F.col("before") + F.sum("words").over(order))
        # the first digit whose documents go beyond what is left
        past = sums.filter(F.col("upto") > F.col("rest")).groupBy(F.col("of").alias("source")).agg(
            F.min_by(F.struct("rest", "digit", (F.col("upto") - F.col("words")).alias("before"), "words"), "digit").alias("p"))
        ends = stored(past.select("source", "p.rest", F.shiftleft("p.digit", shift).alias("end"), "p.before", "p.words"), "mix-ends")
    return ends.select("source", "end", "before", "words")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), budget: float = 1.5, most: float = 2.0,
        quality: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """doc_id, size, source, source_size, target, taken of every document.

    `weights` go to the sources in code point order, repeating; `budget`: words of
    the mix as a share of all words; `quality`: (doc_id, quality > 0), of which a
    larger one comes earlier into a sample."""
    base = stored(numbers(sized(docs, id_col, text_col, source_col), quality), "mix-sizes")
    sources = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most)
    words = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    sources = stored(sources.withColumn("epochs", epochs).withColumn("rest", words - F.col("epochs") * F.col("source_size")), "mix-sources")
    ends = _ends(base, sources).withColumnRenamed("source", "of")
    plan = stored(sources.join(ends, sources.source.eqNullSafe(ends.of), "left").select(
        F.col("source").alias("of"), "source_size", "target", "epochs", "rest", "end", "before", "words"), "mix-plan")
    part = F.expr("(cast(rest - before as decimal(19,0)) * cast(size as decimal(19,0))) div words")
    sampled = (F.when(F.col("end").isNull() | (F.col("place") > F.col("end")), F.lit(0))
               .when(F.col("place") < F.col("end"), F.col("size")).otherwise(part))
    # one row a source, read from a table of known size: Spark broadcasts it while that is small
    return base.join(plan, base.source.eqNullSafe(plan.of)).select(
        "doc_id", "size", "source", "source_size", "target", (F.col("epochs") * F.col("size") + sampled).cast("long").alias("taken"))
