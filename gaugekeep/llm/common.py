"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugekeep.session import scratch_dir

# Rows and bytes of one Arrow batch handed to Python, whichever is reached first.
ARROW_BATCH_ROWS, ARROW_BATCH_BYTES = 2000, 16 << 20


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of `docs`; a null text is empty, other columns are left out."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def bounded_batches(spark: SparkSession, rows: int = ARROW_BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared checkpoint folder and read back: later
    uses neither repeat the work nor depend on a lost executor's files."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of `links` (a long, b long): comp is the
    smallest node reachable.

    Each round takes the smallest label among the neighbours and then the
    label's own label, so that chains halve. A round's labels are a stored
    table; the driver sees one count per round."""
    edges = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                   "cc-edges")
    labels = stored(edges.groupBy(F.col("a").alias("node"))
                    .agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("comp")), "cc-labels")
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near, labels.node == near.a).select(
            "node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        parent = labels.select(F.col("node").alias("up"), F.col("comp").alias("up_comp"))
        step = step.join(parent, step.comp == parent.up, "left").select(
            "node", "was", F.least("comp", "up_comp").alias("comp"))
        step = stored(step, "cc-labels")
        labels = step.select("node", "comp")
        if step.filter("comp <> was").isEmpty():
            return labels
