"""Column helpers: each takes and returns Spark columns, none is a Python UDF."""

from triptych.functions.casts import to_int, to_type
from triptych.functions.labels import (
    bucketize,
    label_by_alias,
    label_by_part,
    label_by_value,
    positive_flag,
)
from triptych.functions.numbers import percent_of, round_half_away
from triptych.functions.quality import any_null, breaks_any, outside_range
from triptych.functions.score import additive_score

__all__ = [
    "additive_score",
    "any_null",
    "breaks_any",
    "bucketize",
    "label_by_alias",
    "label_by_part",
    "label_by_value",
    "outside_range",
    "percent_of",
    "positive_flag",
    "round_half_away",
    "to_int",
    "to_type",
]
