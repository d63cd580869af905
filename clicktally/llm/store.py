"""Tables that cut a lineage: written to the folder all executors share, and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clicktally.config import new_run_dir


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df``, computed once; a lost executor costs only the tasks that read it.

    ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
