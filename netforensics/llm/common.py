"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from netforensics.session import reliable_checkpoint

# Rows of one slice inside a task hold about this many bytes of text.
SLICE_BYTES = 4 << 20


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file; only its path is used, the file stays where it is."""
    import public_tokenizers

    return public_tokenizers.path(name)


_MEMORIES: dict[str, Callable[[], None]] = {}


def remembers(name: str, forget: Callable[[], None]) -> None:
    """Register what a worker process may keep between tasks, and how to drop it."""
    _MEMORIES[name] = forget


def only(name: str = "") -> None:
    """Drop what this worker remembers for other operators: it serves one after the other."""
    for other, forget in _MEMORIES.items():
        if other != name:
            forget()
    pa.default_memory_pool().release_unused()


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about SLICE_BYTES of `column` (one row at least)."""
    for batch in batches:
        rows = batch.num_rows
        step = max(1, rows * SLICE_BYTES // max(1, batch.column(column).nbytes))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def as_batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster names in spark.checkpoint.dir.

    Only where nothing is named and the session is local (tests), a temporary folder is chosen.
    """
    reliable_checkpoint(spark.range(0))
    return os.path.join(spark.sparkContext.getCheckpointDir(), f"{name}-{uuid.uuid4().hex}")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that nothing refers to any more.

    It does so when the driver collects its garbage, which one with memory to spare never does between
    the rounds of an iteration; their files would pile up on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
