"""Name an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``, which may use it many times.

    Catalyst inlines a plain Python variable at every use, and repeats the work when a use sits
    in a branch or a lambda.
    """
    return F.transform(F.array(value), body)[0]
