"""Columns of the rows apart from those an operator adds on its way, whose names begin with an underscore."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame


def own_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``operator(docs, ...)``, with columns of ``docs`` that begin with an underscore under other names meanwhile.

    Arguments that name such a column follow it.
    """

    @wraps(operator)
    def apart(docs: DataFrame, *args, **kwargs) -> DataFrame:
        hidden = {}
        for column in docs.columns:
            if column.startswith("_"):
                name = f"kept{column}"
                while name in docs.columns:
                    name = f"kept_{name}"
                hidden[column] = name
        if not hidden:
            return operator(docs, *args, **kwargs)
        moved = lambda value: hidden.get(value, value) if isinstance(value, str) else value
        result = operator(
            docs.withColumnsRenamed(hidden), *map(moved, args), **{name: moved(value) for name, value in kwargs.items()}
        )
        return result.withColumnsRenamed({name: column for column, name in hidden.items()})

    return apart
