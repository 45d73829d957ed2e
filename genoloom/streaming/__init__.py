"""Restartable incremental loading: files that have arrived since the last run, each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def load_new(spark: SparkSession, folder: str, ddl: str, out: str, progress: str, step: Callable[[DataFrame], DataFrame] = lambda df: df, fmt: str = "csv", **options) -> int:
    """Runs ``step`` over the files in ``folder`` not processed yet, appends the rows to the Parquet table ``out``, and ends.

    ``progress`` keeps which files are done, so a run that failed or is repeated does nothing twice: each
    batch is written under its own number, replacing what a broken run left. Returns the number of batches.
    """
    done: list[int] = []

    def write(df: DataFrame, batch: int) -> None:
        step(df).write.mode("overwrite").parquet(f"{out}/batch={batch}")
        done.append(batch)

    source = spark.readStream.format(fmt).schema(ddl).options(**options).load(folder)
    source.writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    return len(done)
