"""Variable names from file headings (P7) and Parameter labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Heading rules, checked in this order, first hit wins. Each rule
# lists regexes that must all be found in the lower-cased heading.
VARIABLE_RULES = [
    (["precipitation|precip"], "precip"),
    (["air", "temperature|temp"], "air_temp"),
    (["water", "temperature|temp"], "water_temp"),
    (["temperature|temp"], "water_temp"),
    (["discharge|flow"], "flow"),
    (["level", "prim"], "level_prim"),
    (["level", "sec"], "level_sec"),
]
# Fallback: remove every match of this regex (dot = any character), then turn
# the first whitespace into "_".
FALLBACK_REMOVE = ".csv"

# Parameter label per variable; other variables keep their name.
PARAMETER_LABELS = {
    "precip": "Precipitation",
    "air_temp": "Air Temperature",
    "water_temp": "Water Temperature",
    "flow": "Flow",
    "level_prim": "Level (Primary Sensor)",
    "level_sec": "Level (Secondary Sensor)",
}


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def variable_name(heading) -> Column:
    """Short variable name for a file heading or file name, e.g.
    'Discharge.csv' -> 'flow', 'Water level (unit values).csv' ->
    'water_level (unit values)'."""
    low = F.lower(_as_col(heading))
    fallback = F.regexp_replace(F.regexp_replace(low, FALLBACK_REMOVE, ""), r"^(\S*)\s", "$1_")
    expr = None
    for patterns, name in VARIABLE_RULES:
        cond = None
        for p in patterns:
            hit = low.rlike(p)
            cond = hit if cond is None else (cond & hit)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(fallback)


def parameter_label(variable) -> Column:
    """Parameter label stored for a variable name."""
    v = _as_col(variable)
    lookup = F.create_map(*[F.lit(x) for kv in PARAMETER_LABELS.items() for x in kv])
    return F.coalesce(F.element_at(lookup, v), v)
