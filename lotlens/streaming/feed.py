"""Incremental landing of new listings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import LISTING_SCHEMA
from ..sources.writers import insert_new


def ingest_stream(
    spark: SparkSession, feed: str, target: str, checkpoint: str, schema: str = LISTING_SCHEMA, key: str = "id",
    delay: str = "1 day", clean: Callable[[DataFrame], DataFrame] | None = None,
    max_files: int | None = None,
) -> None:
    """Read all JSON-lines files that arrived, drop repeats of a key, append keys not yet in the target.

    `clean` comes first: a copy that it rejects never hides a good one. Repeats that arrive within `delay` of each other are dropped by streaming
    state; later ones by the insert-if-absent rule. Batches are numbered in the target's
    ledger under the stream's own id, so a replayed batch adds nothing, also after an
    append that stopped half-way.  The watermark runs on arrival time, so a listing with an old
    date is never taken for late data.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.json(feed)
    if clean is not None:
        rows = clean(rows)
    fresh = rows.withColumn("_at", F.current_timestamp()).withWatermark("_at", delay).dropDuplicatesWithinWatermark([key]).drop("_at")

    def land(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        insert_new(batch, target, [key], writer=stream, batch=number)

    query = (
        fresh.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
