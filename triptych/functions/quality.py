"""Row checks built from rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from triptych.config import RangeRule


def outside_range(rule: RangeRule) -> Column:
    """True out of range, false in range, null for null."""
    column = F.col(rule.column)
    return (column < F.lit(rule.low)) | (column > F.lit(rule.high))


def breaks_any(rules: Sequence[RangeRule]) -> Column:
    """True when any rule is broken, else false: a null value breaks no rule."""
    return F.coalesce(reduce(or_, [outside_range(rule) for rule in rules]), F.lit(False))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(name).isNull() for name in columns])
