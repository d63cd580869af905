"""Parametrised SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def query(spark: SparkSession, text: str, params: Sequence | None = None, **views: DataFrame) -> DataFrame:
    """Run SQL with ``?`` bound to ``params`` in order; ``{name}`` stands for a DataFrame argument."""
    if params is None:
        return spark.sql(text, **views)
    return spark.sql(text, args=list(params), **views)
