"""Column resolution (P4), civil day (P8) and point flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugekeep.columns import APPROVAL, DATE, GRADE, PARAMETER, VALUE

# Output name -> lower-case fragment the source name must
# contain (None = the name itself, matched exactly), in output order.
RESOLVE_SPEC = [
    (DATE, "date"),
    (PARAMETER, None),
    (VALUE, "value"),
    (APPROVAL, "approval"),
    (GRADE, "grade"),
]


class ColumnResolutionError(ValueError):
    pass


def resolve_names(names: list[str]) -> dict[str, str]:
    """Map output name -> source name for the columns of RESOLVE_SPEC.
    A fragment that matches nothing is left out; one that matches two
    columns is an error; `Parameter` must exist."""
    out: dict[str, str] = {}
    for target, frag in RESOLVE_SPEC:
        if frag is None:
            hits = [n for n in names if n == target]
            if not hits:
                raise ColumnResolutionError(f"column {target!r} not found in {names}")
        else:
            hits = [n for n in names if frag in n.lower()]
            if len(hits) > 1 and target in (DATE, VALUE):
                raise ColumnResolutionError(f"{target!r} matches several columns: {hits}")
        if hits:
            out[target] = hits[0]
    return out


def resolve_columns(df: DataFrame) -> DataFrame:
    """Select Date, Parameter, Value, Approval, Grade by name fragment
    (case-insensitive), renamed, followed by every other column unchanged."""
    m = resolve_names(df.columns)
    used = set(m.values())
    picked = [F.col(f"`{src}`").alias(dst) for dst, src in m.items()]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*picked, *rest)


def civil_day(ts) -> Column:
    """Calendar day of a reading time without any zone shift (NTZ input)."""
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def flatten_point(df: DataFrame, geom: str = "geometry") -> DataFrame:
    """Replace a point struct (x, y) by longitude and latitude columns."""
    return (df.withColumn("longitude", F.col(f"{geom}.x"))
              .withColumn("latitude", F.col(f"{geom}.y"))
              .drop(geom))
