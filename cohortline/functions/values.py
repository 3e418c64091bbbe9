"""Typed pass-through of event value columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_value(c: Column, target: T.DataType) -> Column:
    """Cast to the declared output type; numbers use try_cast (ANSI mode throws on
    malformed text, the rule is null instead)."""
    if isinstance(target, T.StringType):
        return c.cast("string")
    return c.try_cast(target)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
