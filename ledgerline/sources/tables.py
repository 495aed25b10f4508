"""Tables as sources and sinks: optional reads, closed schemas, appends that widen the schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    """A closed schema with a primary key."""

    name: str
    schema: StructType
    key: tuple[str, ...]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_optional(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that may be missing: then it has no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def clean_names(df: DataFrame) -> DataFrame:
    """Column names in lower case, with underscores for spaces and hyphens and without dots."""
    return df.toDF(*(c.strip().lower().replace(" ", "_").replace("-", "_").replace(".", "") for c in df.columns))


def resolved(df: DataFrame, aliases: dict[str, list[str]], required: list[str]) -> DataFrame:
    """Renames the first alias that exists to each canonical name; a missing required name is an error."""
    found = {name: next((c for c in options if c in df.columns), None) for name, options in aliases.items()}
    missing = [name for name in required if found.get(name) is None]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*(F.col(c).alias(name) for name, c in found.items() if c is not None))


def appended(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables with the columns of either, old ones first; what is missing is null."""
    return old.unionByName(new, allowMissingColumns=True)


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, nulls empty."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns))


def violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys that are null or not unique: the key columns, n and reason. Other columns than the spec's are an error."""
    if df.columns != spec.schema.names:
        raise ValueError(f"{spec.name} must have exactly the columns {spec.schema.names}")
    null = F.lit(False)
    for c in spec.key:
        null = null | F.col(c).isNull()
    counted = df.groupBy(*spec.key).agg(F.count("*").alias("n")).withColumn("reason", F.when(null, "null key").when(F.col("n") > 1, "repeated key"))
    return counted.filter(F.col("reason").isNotNull())


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Appends rows, which may have other columns than those that are there; stored() reads the columns of all."""
    df.write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A table that was appended to, with the columns of all appends; what a part of it lacks is null."""
    return spark.read.option("mergeSchema", "true").parquet(path)
