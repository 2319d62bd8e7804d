"""Frame helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame of global aggregates to every row of ``df``.

    Each column becomes a scalar subquery (evaluated once, merged by Spark, shipped as
    a value), so no join and no cartesian product is planned.
    """
    return df.withColumns({c: scalars.select(c).scalar() for c in scalars.columns})
