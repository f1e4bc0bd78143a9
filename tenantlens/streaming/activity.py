"""Audit events from a landing folder into the activity history."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tenantlens.plans.build import add_activity
from tenantlens.schemas import RAW_DDL
from tenantlens.sources.landing import quarantined, records_of, usable_records
from tenantlens.sources.tables import TableStore


def activity_stream(
    spark: SparkSession,
    landing: str,
    store: TableStore,
    checkpoint: str,
    *,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Starts a load of all files that are new since the checkpoint.

    Every micro-batch is merged on the event id against the history itself. So
    the stream holds no state, an event may come late by any time, and a batch
    that is run again adds nothing twice. Lines that cannot be read whole are
    kept as text in ``quarantine.activity_stream``.
    """
    reader = spark.readStream
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def merge(lines: DataFrame, batch_id: int) -> None:
        batch = records_of(lines, RAW_DDL["activity"]).persist(StorageLevel.DISK_ONLY)  # parsed once
        try:
            # by batch, so that a batch run again replaces its own lines; the write counts them
            bad = quarantined(batch).withColumn("batch_id", F.lit(batch_id))
            if not bad.isEmpty():
                store.replace_partitions("quarantine.activity_stream", bad, ["batch_id"])
            add_activity(store, usable_records(batch), held=True)
        finally:
            batch.unpersist()

    return (
        reader.text(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
