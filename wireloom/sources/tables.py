"""Scans."""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType, **options: Any) -> DataFrame:
    """The same table as a stream of files; works for one file and for a directory of them."""
    return spark.readStream.schema(schema).options(**options).parquet(f"{folder}/{{{name}}}.parquet")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet directory under a fixed schema; no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_query(spark: SparkSession, query: str, views: dict[str, DataFrame], **parameters: Any) -> DataFrame:
    """Run a SQL text over named frames; ``{name}`` in the text stands for a frame, ``:name`` for a parameter."""
    return spark.sql(query, args=parameters or None, **views)


def non_empty(df: DataFrame) -> DataFrame:
    """One row: whether a frame has a row; looks for one only."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("non_empty"))


def is_not_empty(df: DataFrame) -> bool:
    """True where a frame has a row; stops at the first one."""
    return non_empty(df).first()["non_empty"]
