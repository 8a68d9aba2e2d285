"""Key-based merges: null-safe anti-joins (J1, J2), source-priority
deduplication (W1) and stacking by name (U1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugekeep.columns import DAY_KEYS, DAY_PARAM_KEYS


def anti_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Rows of `left` whose keys do not occur in `right`; two missing keys
    count as equal. Plans as an equi anti-join (sort-merge, or broadcast when
    AQE measures the right side as small), never a nested loop."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{i}") for i, k in enumerate(keys)])
    cond = [F.col(k).eqNullSafe(F.col(f"__r_{i}")) for i, k in enumerate(keys)]
    return left.join(r, on=reduce(lambda a, b: a & b, cond), how="left_anti")


def anti_join_in_place(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """anti_join for a `right` that lies bucketed by `keys` (write_history): rows with
    all keys are joined by plain equality, which uses the buckets (null-safe keys
    would not), those that lack a key by a null-safe join with the few such rows of
    `right`. `left` is read twice; it is the small side."""
    keys = list(keys)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__r_{k}") for k in keys])
    return left.filter(whole).join(r, cond, "left_anti").unionByName(anti_join(left.filter(~whole), right.filter(~whole), keys))


def new_rows(incoming: DataFrame, stored: DataFrame, keys=DAY_KEYS) -> DataFrame:
    """Incoming rows whose (station, day) is not stored yet."""
    return anti_join(incoming, stored, keys)


def unaffected_rows(stored: DataFrame, publication: DataFrame, keys=DAY_PARAM_KEYS) -> DataFrame:
    """Stored rows that the new publication does not cover."""
    return anti_join(stored, publication, keys)


def stack(*frames: DataFrame) -> DataFrame:
    """Stack by column name, absent columns become NULL, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def prefer_first(frames, keys=DAY_KEYS, order_cols=()) -> DataFrame:
    """One row per key. Rows of an earlier frame win over later frames;
    inside a frame the row first by `order_cols` wins.

    `row_number() == 1` lets Spark insert a WindowGroupLimit before the
    shuffle, so at most one row per key and input partition travels."""
    tagged = [f.withColumn("__src", F.lit(i)) for i, f in enumerate(frames)]
    u = stack(*tagged)
    w = Window.partitionBy(*keys).orderBy("__src", *order_cols)
    return u.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn", "__src")
