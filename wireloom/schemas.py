"""Table schemas by (database, table), and the cast that makes a frame fit one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAGED = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("news", T.StringType()),
        T.StructField("links", T.StringType()),
        T.StructField("agency", T.StringType()),
    ]
)

ENRICHED = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("title", T.StringType()),
        T.StructField("resume", T.StringType()),
        T.StructField("links", T.StringType()),
        T.StructField("news", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("agency", T.StringType()),
    ]
)

AGENCIES = T.StructType(
    [
        T.StructField("telegram", T.StringType()),
        T.StructField("mono_category", T.StringType()),
        T.StructField("is_parsing", T.BooleanType()),
        T.StructField("language", T.StringType()),
        T.StructField("priority", T.IntegerType()),
    ]
)

REJECTED = T.StructType([*ENRICHED, T.StructField("errors", T.ArrayType(T.StringType()))])

PAGES = T.StructType(
    [
        T.StructField("channel", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

_BY_TABLE = {
    ("russian", "news"): STAGED,
    ("published", "agencies"): AGENCIES,
    ("error", "error_table"): REJECTED,
    ("error", "final_rejects"): REJECTED,
    ("error", "model_rejects"): REJECTED,
}


def table_schema(database: str, table: str) -> T.StructType:
    """Staged news of the home database has five columns, other news tables eight.

    Rejected news also carry the names of the broken rules.
    """
    return _BY_TABLE.get((database, table), ENRICHED)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a schema by name; absent columns become NULL, others are dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(field.name) if field.name in present else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schema
        ]
    )
