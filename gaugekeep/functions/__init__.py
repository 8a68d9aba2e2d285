"""Column expressions: names, column resolution and scalar functions."""

from gaugekeep.functions.names import parameter_label, variable_name
from gaugekeep.functions.columns import civil_day, flatten_point, resolve_columns
from gaugekeep.functions.scalars import (bytes_to_mb, days_between, is_leap_year, path_basename,
                                         r_round, release_stamp, window_start, yyyymmdd)

__all__ = [
    "parameter_label", "variable_name", "civil_day", "flatten_point", "resolve_columns",
    "bytes_to_mb", "days_between", "is_leap_year", "path_basename", "r_round",
    "release_stamp", "window_start", "yyyymmdd",
]
