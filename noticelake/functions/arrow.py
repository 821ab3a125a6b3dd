"""Arrow functions that a module can define before there is a session."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow(returns: str) -> Callable:
    """A pandas UDF whose return type, in DDL, is read when it is first used."""

    def of(f: Callable) -> Callable[..., Column]:
        @wraps(f)
        def call(*columns) -> Column:
            return F.pandas_udf(f, returns)(*columns)

        return call

    return of
