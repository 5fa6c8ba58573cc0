"""Vectorised functions that are made when first used: their types can only be read once there is a session."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def vectorised(kind: str) -> Callable:
    """Like pandas_udf, but the module that holds the function can be imported without a session. Marked as not deterministic, which keeps the
    optimizer from copying the call into the expressions that use its result (a lambda can't hold one) and so from making it twice."""

    def wrap(function: Callable) -> Callable[..., Column]:
        @functools.wraps(function)
        def call(*columns: Column | str) -> Column:
            return F.pandas_udf(function, kind).asNondeterministic()(*columns)

        return call

    return wrap
