"""What several operators share: whole texts as bytes, bounded Arrow batches, written tables."""

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import SHUFFLE_CLEANUP, remove_folder, shared_folder, shuffles_removed  # noqa: F401

# One Arrow batch handed to a Python worker holds at most this many bytes (or a single row).
BATCH_BYTES = 8 << 20

# A word: a run of anything but ASCII white space, which is also what bytes.split() cuts at.
WORD = r"[^\x20\x09-\x0D]+"


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that long texts cannot pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own, for this run, in the shared checkpoint folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: str | None = None, within: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    The written rows cut the lineage: what follows reads files that every executor sees. Tables ``within`` a folder
    go when that is removed.
    """
    folder = f"{within}/{name}-{uuid.uuid4().hex}" if within else new_folder(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def memory_returned() -> None:
    """Return what this worker has freed to the system: a worker goes on to other stages, beside others."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each text; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def pieces(batches: Iterable[pa.RecordBatch], text: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece hold about ``most`` bytes (or are one row)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def word_count(text: Column) -> Column:
    """The number of words of a text; null has none. Built-in functions only."""
    # Each word becomes its first character and white space goes.
    firsts = F.regexp_replace(text, r"[\x20\x09-\x0D]*([^\x20\x09-\x0D])[^\x20\x09-\x0D]*[\x20\x09-\x0D]*|[\x20\x09-\x0D]+", "$1")
    return F.coalesce(F.length(firsts), F.lit(0)).cast("long")


def sent_if_small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """Broadcast ``df`` if it has at most ``most`` (narrow) rows; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
