"""Reading tables: Parquet, JSON with or without an envelope, and JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StringType, StructField, StructType

from premia.functions.prices import nan_to_null


def without_nan(rows: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes NULL, the one mark for missing values."""
    doubles = [f.name for f in rows.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    if not doubles:
        return rows
    return rows.withColumns({c: nan_to_null(F.col(c)) for c in doubles})


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet file or a Hive-partitioned folder, missing values as NULL."""
    rows = spark.read.parquet(path)
    if columns:
        rows = rows.select(*columns)
    return without_nan(rows)


def scan_json(spark: SparkSession, path: str, record: str) -> DataFrame:
    """JSON documents holding a list of records, bare or as ``{"data": [...]}``.

    ``record`` is the record's DDL. Each file is one document, so a feed of many files is read in
    parallel. Adds ``_file`` and ``position``, the record's place in its file's list. A file that is not such a document fails
    the job (see ``explode_envelope``); only a file of no bytes at all is skipped by Spark's listing.
    """
    text = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("_file")
    )
    return explode_envelope(text, "value", record, ["_file"])


def explode_envelope(
    documents: DataFrame, column: str, record: str, order: Sequence[str]
) -> DataFrame:
    """Records of JSON documents in a text column, bare lists and envelopes alike.

    Keeps the ``order`` columns and adds the record's position as ``position``. Nothing is lost in silence: a document that
    is no JSON, is neither form, or holds a value of another type than declared, fails the job. Whole
    numbers may be written with a fraction of zero (``12.0``); an absent field is NULL.
    """
    declared = StructType.fromDDL(record)
    item = StructType([StructField(f.name, StringType() if f.dataType == LongType() else f.dataType) for f in declared])
    envelope = StructType([StructField("data", ArrayType(item))])
    strict = {"mode": "FAILFAST"}
    bare = F.ltrim(F.col(column)).startswith("[")
    parsed = F.when(bare, F.from_json(column, ArrayType(item), strict)).otherwise(
        F.from_json(column, envelope, strict)["data"]
    )
    # The first of the order columns names the document.
    name = F.col(order[0]).cast("string") if order else F.lit(None).cast("string")
    complaint = F.concat(F.lit("neither a list of records nor {data: [...]}: "), F.coalesce(name, F.substring(column, 1, 80), F.lit("NULL")))
    records = F.coalesce(parsed, F.raise_error(complaint).cast(ArrayType(item)))
    exploded = documents.select(*order, F.posexplode(records).alias("position", "_record"))
    return exploded.select(*order, "position", *(_declared(f) for f in declared))


def _declared(field: StructField):
    """A parsed field in its declared type; whole numbers were read as text."""
    value = F.col("_record")[field.name]
    if field.dataType != LongType():
        return value.alias(field.name)
    number = value.try_cast("double")
    whole = F.coalesce(value.try_cast("long"), F.when(number == F.floor(number), F.floor(number)))
    wrong = F.raise_error(F.concat(F.lit(f"{field.name} is no whole number: "), value)).cast("long")
    return F.when(value.isNotNull(), F.coalesce(whole, wrong)).alias(field.name)


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    **options: str,
) -> DataFrame:
    """A database table, read in parallel key ranges when a numeric ``partition_column`` is given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned read needs the key bounds")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def trim_fields(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Only the allowed fields that are present, in the order of the allow-list."""
    return rows.select(*(c for c in keep if c in rows.columns))
