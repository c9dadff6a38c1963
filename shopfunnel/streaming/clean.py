"""The cleaning step on a stream of CSV files, into the layout of the batch side.

Each batch of files is parsed once and goes to both outputs through writers that know what
an earlier attempt of the same batch has written, so a restarted query neither loses nor
repeats rows. A batch is published as a version of its months: the dataset can be registered
as a table, and months can be reloaded, like one that was loaded by month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shopfunnel.operators import gate, versions
from shopfunnel.schemas import BRONZE, EVENTS

#: Files of a batch at most: what a failure has to repeat.
FILES_PER_BATCH = 200


def bronze_stream(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """CSV files as they arrive in ``folder``, every column a string."""
    reader = spark.readStream.schema(BRONZE).option("header", True)
    return reader.option("maxFilesPerTrigger", files_per_batch).csv(folder)


def start(
    bronze: DataFrame, root: str, checkpoint: str, quarantine_root: str | None = None, **trigger
) -> StreamingQuery:
    """Append processed rows by month and day, and rows that did not convert by batch.

    Without another trigger all files there are get read, and the query ends.
    """

    def write(rows: DataFrame, number: int) -> None:
        typed = gate.with_typed(rows).persist()
        try:
            processed = gate.with_partition_columns(gate.processed(typed)).select(*EVENTS.names)
            versions.append_batch(processed, root, f"batch-{number:012d}")
            if quarantine_root:
                failed = gate.quarantined(typed).hint("rebalance")
                failed.write.mode("overwrite").parquet(f"{quarantine_root.rstrip('/')}/batch={number}")
        finally:
            typed.unpersist()

    writer = bronze.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
