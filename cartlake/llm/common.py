"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.session import shared_dir

TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a written table of the shared folder: lineage ends here, lost executors do not matter.

    The reread frame has no partitioning, so later joins get two plain exchanges, which AQE can split at hot keys.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_id() -> Column:
    """A number per input row: partition and place in it, the same after a retry of a file scan."""
    return F.monotonically_increasing_id()


_cache: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What a Python worker remembers for one operator; that of the operator before it is let go."""
    if owner not in _cache:
        if _cache:
            _cache.clear()
            _hand_back()
        _cache[owner] = {}
    return _cache[owner]


def _hand_back() -> None:
    """Freed memory to the system, from Arrow's pool and, where it can be asked, from the C library."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(batch) -> dict of columns`` over Arrow batches; an empty batch gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache(fn.__module__)  # what another operator remembers goes
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays([pa.array(v) if not isinstance(v, pa.Array) else v for v in out.values()], names=list(out))

    return df.mapInArrow(run, schema)
