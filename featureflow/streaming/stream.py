"""Scheduled refresh as a stream.

New payload files landing in a directory are picked up by a file stream; every
micro-batch is one refresh run with ``run_id = batch_id``: steps, diff against
the state of the run before, gates, publishing and the next state, all under
``out_dir``. A replayed batch (after a failure) overwrites its own folders, so
the output is the same, and the stream's checkpoint lives beside it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from featureflow.plans.refresh import SourceSpec, load_state, refresh


def refresh_stream(spark: SparkSession, source_dir: str, schema: T.StructType, spec: SourceSpec,
                   to_features: Callable[[DataFrame], DataFrame], out_dir: str, now: str,
                   file_glob: str | None = None, **options: str) -> str:
    """Run the stream until the available input is consumed; return the manifest directory.

    ``out_dir`` must be a folder that all executors share. How many files make
    a batch is left to the caller's stream ``options``: none by default, so all
    that has landed is one run.
    """
    def run_batch(batch: DataFrame, batch_id: int) -> None:
        index, meta = load_state(batch.sparkSession, out_dir, replay_of=str(batch_id))
        refresh(batch.sparkSession, [replace(spec, load=lambda _: to_features(batch))], index, meta, now,
                out_dir=out_dir, run_id=str(batch_id))

    reader = spark.readStream.schema(schema).options(**options)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    query = (reader.parquet(source_dir).writeStream.foreachBatch(run_batch)
             .option("checkpointLocation", f"{out_dir}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return f"{out_dir}/manifest"
