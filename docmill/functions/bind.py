"""Values that an expression uses more than once, worked out once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value. It is evaluated without generated code, which keeps large
    expressions that few rows need out of the generated code of all rows."""
    return F.element_at(F.transform(F.array(value), body), 1)
