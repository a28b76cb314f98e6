"""Keep a caller's other columns out of the way of an operator's own names."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_aside(docs: DataFrame, own: Sequence[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``docs`` with all columns but ``own`` under neutral names, and the function that restores them.

    ``back(df, *added)`` returns the columns of ``docs`` and then ``added``; a
    column of ``docs`` that is named like an added one is replaced by it.
    """
    names = {c: c if c in own else f"_extra_{i}" for i, c in enumerate(docs.columns)}

    def back(df: DataFrame, *added: str) -> DataFrame:
        return df.select(*[F.col(n).alias(c) for c, n in names.items() if c not in added], *added)

    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), back
