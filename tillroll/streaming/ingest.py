"""The line ingest on a file stream: new text files in a folder are read,
validated and split into accepted and rejected rows, incrementally.

Same operators as the batch path (``clean_lines`` -> ``parse_lines`` ->
``accepted`` / ``rejected``); Structured Streaming tracks which files were
processed in its checkpoint. Each micro-batch is written to
``<sink>/batch=<id>`` with overwrite, so a batch re-run after a failure replaces
its own output instead of appending twice.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.sources.lines import TRANSACTION_SPEC, LineSpec, accepted, clean_lines, parse_lines, rejected


def stream_lines(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming frame of the non-empty, non-header lines of new files in ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return clean_lines(reader.load(path))


def start_line_split(
    spark: SparkSession,
    source: str,
    accepted_sink: str,
    rejected_sink: str,
    *,
    spec: LineSpec = TRANSACTION_SPEC,
    checkpoint: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental split; returns the running query.

    ``checkpoint`` is this stream's own progress folder (two streams must not share
    one), in a place that outlives the driver. ``available_now`` processes what is
    there, then stops.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_lines(batch, spec).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            accepted(parsed, spec).write.mode("overwrite").parquet(f"{accepted_sink}/batch={batch_id}")
            rejected(parsed).write.mode("overwrite").parquet(f"{rejected_sink}/batch={batch_id}")
        finally:
            parsed.unpersist()

    writer = (
        stream_lines(spark, source, max_files_per_trigger=max_files_per_trigger)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
