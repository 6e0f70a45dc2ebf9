"""Naming an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body mentions it."""
    return F.transform(F.array(value), body)[0]


def named(**fields: Column) -> Column:
    """A struct whose names stay in the functions of lists, where Spark drops those of aliases."""
    return F.named_struct(*[x for name, field in fields.items() for x in (F.lit(name), field)])
