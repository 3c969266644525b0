"""Scoring a stream of feature records with the batch transform."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from premia.operators.models import record_is_valid

PREDICTION = "predicted_premium"
SCORED, REFUSED = "scored", "refused"


def stream_outcomes(records: DataFrame, model, output: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Score a streaming frame, and keep what cannot be scored: one stream, one pass over its input, two tables.

    Every micro-batch is one write below ``output``, to ``outcome=scored`` and ``outcome=refused``, in a folder of its batch id. Scoring
    keeps no state, and a repeated batch replaces its own folders, so a restarted query goes on without loss or repeats.
    Records have no columns named outcome, batch_id or predicted_premium. ``once`` works through what is there and stops; otherwise the query keeps running.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        valid = F.col("_valid")
        marked = model.score(batch.withColumn("_valid", record_is_valid()), PREDICTION)
        outcome = F.when(valid, SCORED).otherwise(REFUSED).alias("outcome")
        predicted = F.when(valid, F.col(PREDICTION)).alias(PREDICTION)
        rows = marked.select(*(F.col(f"`{c}`") for c in batch.columns), predicted, outcome, F.lit(batch_id).alias("batch_id"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("outcome", "batch_id").parquet(output)

    writer = records.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def scored_records(spark: SparkSession, output: str, record: StructType) -> DataFrame:
    """All records scored so far, with their predictions; ``record`` is the schema of the stream."""
    return _outcome(spark, output, SCORED, record)


def refused_records(spark: SparkSession, output: str, record: StructType) -> DataFrame:
    """All records refused so far, as they came."""
    return _outcome(spark, output, REFUSED, record).drop(PREDICTION)


def _outcome(spark: SparkSession, output: str, outcome: str, record: StructType) -> DataFrame:
    # With the schema given, a table without a batch yet, or without a refused record, is an empty table.
    fields = [*record.fields, StructField(PREDICTION, DoubleType()), StructField("outcome", StringType())]
    rows = spark.read.schema(StructType(fields)).parquet(output)
    return rows.where(F.col("outcome") == outcome).drop("outcome")
