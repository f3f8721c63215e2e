"""Name an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once.

    A plain column used many times may be repeated by the optimizer, in filters above all; a
    lambda argument cannot be.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
