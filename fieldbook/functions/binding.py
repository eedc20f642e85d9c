"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body reads it.

    Without this, an expression that is read ten times stands in the plan ten times, and nested
    rules grow without limit."""
    return F.transform(F.array(value), body).getItem(0)
