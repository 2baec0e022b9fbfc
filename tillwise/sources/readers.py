"""Reading feeds and result tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _parsed(field: T.StructField) -> Column:
    """A text field as its declared type; what does not parse becomes null."""
    kind = field.dataType.simpleString()
    name = f"`{field.name}`"
    if isinstance(field.dataType, T.IntegralType):
        # A column with gaps is often written as 12.0.
        exact = f"try_cast({name} as {kind})"
        return F.expr(f"coalesce({exact}, try_cast(try_cast({name} as double) as {kind}))")
    return F.expr(f"try_cast({name} as {kind})")


def nan_as_null(df: DataFrame) -> DataFrame:
    """A NaN is a missing value here, not a number."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, key: str | None = None
) -> DataFrame:
    """Headered CSV, columns found by name and parsed to the declared types.

    Columns the file lacks are null. A missing ``key`` column is numbered in file
    order instead; write the frame before using it twice, as numbers follow the
    layout of the read.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    # A file's columns are those of its own header, whatever the other files have.
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"),
    )
    headers = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    layouts = headers.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    if len(layouts) <= 1:
        return _csv_columns(reader.csv(path), schema, key)
    parts = [
        _csv_columns(reader.csv(layout["files"]), schema, key)
        for layout in sorted(layouts, key=lambda layout: layout["header"])
    ]
    return reduce(DataFrame.unionByName, parts)


def _csv_columns(text: DataFrame, schema: T.StructType, key: str | None) -> DataFrame:
    """The declared columns from the text columns of files with one header."""
    def column(field: T.StructField) -> Column:
        if field.name in text.columns:
            return _parsed(field).alias(field.name)
        if field.name == key:
            return F.monotonically_increasing_id().cast(field.dataType).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return nan_as_null(text.select(*[column(f) for f in schema]))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return nan_as_null(spark.read.schema(schema).option("mode", "PERMISSIVE").json(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, source: str = "parquet"
) -> DataFrame:
    """The data at a path, or an empty frame of the schema when nothing is there."""
    try:
        if source == "csv":
            return read_csv(spark, path, schema)
        return spark.read.schema(schema).format(source).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def head_sample(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """The first n rows in key order: a top-n, not a full sort."""
    return df.orderBy(*key).limit(n)


def recent_runs(history: DataFrame, n: int = 8) -> DataFrame:
    return history.orderBy(F.desc("at")).limit(n)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A Parquet folder (or single file) as a stream; one micro-batch per set of files.

    The path is given as a pattern that matches only itself: the stream source
    takes a plain path to be a folder, while a pattern may also match a file.
    """
    path = path.rstrip("/")
    exact = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(exact)
