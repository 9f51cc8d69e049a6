"""Results tables: p-value text and a preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from retrocohort.functions.scalars import scientific


def format_pvalues(df: DataFrame, column: str = "pval") -> DataFrame:
    """The p-value column as text such as ``1.23E-05``; other columns unchanged."""
    return df.withColumn(column, scientific(column))


def preview(
    df: DataFrame,
    order_by: Sequence[str | Column],
    n: int = 100,
    predicates: Sequence[str | Column] = (),
) -> DataFrame:
    """The first ``n`` rows in a given order after optional filters.

    ``order_by`` should order the rows completely, so the preview is stable.
    """
    if not order_by:
        raise ValueError("a preview needs an order")
    for predicate in predicates:
        df = df.where(predicate)
    return df.orderBy(*order_by).limit(n)
