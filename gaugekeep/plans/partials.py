"""Daily means that later readings can still change.

Per station, day and parameter the sum and number of its readings are kept, as long
as the day is not published. Each batch of readings adds its own sums (a row per
key, append only), so readings of a day may come in any number of batches and in
any order: the mean over all of them is stored, as the batch job (C3) gives it.

A station-day belongs to the readings if it was not stored before they came (J1).
Its row is changed by later readings until a publication covers it; published days
and days that other sources stored are never changed. One commit holds the new
rows, the sums and the number of the batch, so a batch that is run again after a
failure changes nothing.

Work per batch: the years that its days lie in are read; only years in which a
stored day changes are written anew, other new rows are appended. Every
`fold_every` batches the sums are folded to one row a key and published days lose
theirs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugekeep.columns import DATE, FLOW, LEVEL, PARAMETER, PUB_STATUS, PUBLISHED, STATION, UNPUBLISHED, VALUE
from gaugekeep.functions.columns import civil_day
from gaugekeep.operators.daily import NULL_POLICIES, clean_value
from gaugekeep.operators.merge import anti_join
from gaugekeep.plans.realtime import TABLE
from gaugekeep.session import ensure_checkpoint_dir
from gaugekeep.sinks.snapshots import Snapshot, TableStore

PARTIALS, PROGRESS = "daily_partials", "stream_progress"
KEYS = (STATION, DATE, PARAMETER)
SUMS = ("total", "n_values", "n_readings")
TABLE_OF = {FLOW: "flow", LEVEL: "level"}


def daily_partials(readings: DataFrame, time_col: str = DATE) -> DataFrame:
    """Sum of the values, number of values and of readings per station, civil day
    and parameter (flow and level)."""
    v = clean_value(VALUE)
    return (readings.filter(F.col(PARAMETER).isin(FLOW, LEVEL))
            .groupBy(STATION, civil_day(time_col).alias(DATE), PARAMETER)
            .agg(F.sum(v).alias("total"), F.count(v).alias("n_values"), F.count(F.lit(1)).alias("n_readings")))


def merged(partials: DataFrame) -> DataFrame:
    """One row per key."""
    return partials.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


def mean_of(null_policy: str) -> Column:
    """The day's mean from its sums (see realtime_daily_mean)."""
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    whole = F.col("n_values") > 0
    if null_policy == "poison":
        whole = whole & (F.col("n_values") == F.col("n_readings"))
    return F.when(whole, F.col("total") / F.col("n_values"))


def _matching(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the keys, two missing ones equal; the right side's keys are dropped."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in KEYS], *[c for c in right.columns if c not in KEYS])
    same = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in KEYS]
    return left.join(r, same[0] & same[1] & same[2], how).drop(*[f"__r_{c}" for c in KEYS])


def _stored(base: Snapshot, years: list[int | None] | None = None) -> DataFrame:
    """KEYS (the parameter tells the table) and status of the stored rows."""
    found = base.store.spark.createDataFrame([], f"{STATION} string, {DATE} date, {PARAMETER} string, {PUB_STATUS} string")
    for label, table in TABLE_OF.items():
        if table in base.tables:
            found = found.unionByName(base.read(table, years=years).select(STATION, DATE, F.lit(label).alias(PARAMETER), PUB_STATUS))
    return found


def folded(base: Snapshot) -> DataFrame:
    """The sums, one row a key, without the days that are published."""
    return anti_join(merged(base.read(PARTIALS)), _stored(base).filter(F.col(PUB_STATUS) == PUBLISHED), KEYS)


def add_readings(store: TableStore, readings: DataFrame, stream: str, batch: int, time_col: str = DATE,
                 null_policy: str = "skip", fold_every: int = 100) -> dict[str, int]:
    """Batch number `batch` (rising) of `stream`: returns the number of rows added
    and of rows changed. A batch that is committed already is skipped."""
    ensure_checkpoint_dir(store.spark)
    base = store.snapshot()
    done = {}
    if PROGRESS in base.tables:
        done = {r.stream: r.batch for r in base.read(PROGRESS).collect()}  # one row a stream
    if done.get(stream, -1) >= batch:
        return {"added": 0, "changed": 0}
    new = daily_partials(readings, time_col).checkpoint(eager=True)
    years = [r.year for r in new.select(F.year(DATE).alias("year")).distinct().collect()]
    # Spark's own partition by year (also of rows without a day) keeps this list short
    stored = _stored(base, years)
    plan = _matching(new, stored.withColumn("__stored", F.lit(True)), "left")
    if PARTIALS in base.tables:
        held = merged(_matching(base.read(PARTIALS, years=years), new.select(*KEYS), "left_semi"))
        plan = _matching(plan, held.select(*KEYS, *[F.col(c).alias(f"__{c}") for c in SUMS]), "left")
    else:
        plan = plan.select("*", *[F.lit(None).cast("double" if c == "total" else "bigint").alias(f"__{c}") for c in SUMS])
    ours = F.col("__n_readings").isNotNull()
    plan = plan.filter(F.col("__stored").isNull() | (ours & ~F.col(PUB_STATUS).eqNullSafe(F.lit(PUBLISHED))))
    added = {c: F.when(F.col(c).isNull() | F.col(f"__{c}").isNull(), F.coalesce(c, f"__{c}")).otherwise(F.col(c) + F.col(f"__{c}")) for c in SUMS}
    plan = plan.select(*KEYS, *[F.col(c).alias(f"new_{c}") for c in SUMS], F.col("__stored").isNotNull().alias("change"),
                       *[v.alias(c) for c, v in added.items()])
    plan = plan.select(*KEYS, "change", *[f"new_{c}" for c in SUMS], mean_of(null_policy).alias(VALUE)).checkpoint(eager=True)
    found = {(r[PARAMETER], r.change, r.year): r["count"] for r in
             plan.groupBy(PARAMETER, "change", F.year(DATE).alias("year")).count().collect()}
    with store.transaction(base) as t:
        for label, table in TABLE_OF.items():
            rows = (plan.filter(F.col(PARAMETER) == label).select(*KEYS, VALUE, "change")
                    .withColumn(PUB_STATUS, F.lit(UNPUBLISHED)))
            again = [y for p, change, y in found if p == label and change]
            if again:
                old = base.read(table, years=again)
                kept = anti_join(old, rows.filter("change"), (STATION, DATE))
                here = [F.year(DATE).eqNullSafe(F.lit(y).cast("int")) for y in again]
                whole = here[0]
                for h in here[1:]:
                    whole = whole | h
                t.replace_years(table, kept.unionByName(rows.filter(whole).drop("change"), allowMissingColumns=True), again)
                rows = rows.filter(~whole)
            if table not in base.tables or any(p == label and y not in again for p, _, y in found):
                t.append(table, rows.drop("change"))
        sums = plan.select(*KEYS, *[F.col(f"new_{c}").alias(c) for c in SUMS])
        if PARTIALS in base.tables and fold_every and batch % fold_every == fold_every - 1:
            t.replace(PARTIALS, merged(folded(base).unionByName(sums)))
        else:
            t.append(PARTIALS, sums)
        progress = [(s, b) for s, b in done.items() if s != stream] + [(stream, batch)]
        t.replace(PROGRESS, store.spark.createDataFrame(progress, "stream string, batch bigint"))
    return {"added": sum(n for (_, change, _), n in found.items() if not change),
            "changed": sum(n for (_, change, _), n in found.items() if change)}
