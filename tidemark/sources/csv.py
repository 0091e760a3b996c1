"""The bulk export: text columns by their headers, nothing inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_text_csv(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """All columns as text, empty fields as nulls or '' alike; ``max_rows`` caps for a trial load only."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in header])
    df = spark.read.option("header", True).option("multiLine", False).option("escape", '"').option("enforceSchema", False).schema(schema).csv(path)
    return df if max_rows is None else df.limit(max_rows)
