"""Incremental ingest of CSV files with Structured Streaming.

The file source does the batching (``maxFilesPerTrigger``) and remembers which
files were processed in the checkpoint. The stream itself carries paths only;
each micro-batch reads its files as the batch job does, small ones whole and
large ones line by line and cut across tasks, so a file of any size arrives. They
are aligned by header, cleaned and written to the clean store. The same
query picks up new files when it is run again, and a failed batch is rerun
from the checkpoint.

Each micro-batch is written to its own ``batch=<id>`` directory in overwrite
mode, so a batch that is replayed after a failure replaces its earlier partial
output instead of duplicating it. Batch numbers belong to the checkpoint: a
new checkpoint on a store that already holds batches is refused, as it would
replace them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from isotherm.operators.clean import clean_readings
from isotherm.schemas import FILES_PER_BATCH
from isotherm.sources.readings import WHOLE_FILE_BYTES, read_readings
from isotherm.sources.store import write_clean_store


# The columns of the binary-file source.
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _holds(spark: SparkSession, path: str, pattern: str) -> bool:
    """Whether the folder has an entry that matches the glob pattern."""
    full = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{pattern}")
    found = full.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(full)
    return found is not None and len(found) > 0


def start_incremental_ingest(spark: SparkSession, source_dir: str, store_path: str,
                             checkpoint_location: str, files_per_batch: int = FILES_PER_BATCH,
                             available_now: bool = True, processing_time: str | None = None,
                             file_pattern: str = "*.csv", whole_file_bytes: int = WHOLE_FILE_BYTES,
                             quoted_breaks: bool = False) -> StreamingQuery:
    """Start the stream; returns the query (``awaitTermination`` to wait).

    ``available_now`` processes every file present now in batches and stops;
    otherwise the query keeps running with ``processing_time`` triggers.
    """
    if not _holds(spark, checkpoint_location, "metadata") and _holds(spark, store_path, "batch=*"):
        raise ValueError(f"{store_path} holds batches of another checkpoint than {checkpoint_location}")
    source = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", file_pattern)
        .load(source_dir)
        .select("path")  # no content is read
    )
    base = store_path.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The paths of one micro-batch: files_per_batch at most.
        paths = [r.path for r in batch.collect()]
        rows = read_readings(spark, paths, whole_file_bytes=whole_file_bytes, quoted_breaks=quoted_breaks)
        write_clean_store(clean_readings(rows), f"{base}/batch={batch_id}", mode="overwrite")

    writer = source.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
