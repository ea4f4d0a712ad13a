"""Token files: one concatenated id array with Elias-Fano coded document boundaries.

Layout of a token folder: a Parquet table with one row per block. A shard is one range of the
documents in ascending key order (nulls first); a block is a run of whole documents of a shard
with about ``BLOCK_IDS`` ids (or one longer document). Columns:

- ``shard``, ``block``: ascending, so that (shard, block) is the order of the documents
- ``first``: ids in earlier blocks of the shard
- ``n_docs``, ``n_ids``
- ``keys``: the documents' keys, in order
- ``ids``: the ids, little-endian, 2 bytes each if the vocabulary allows, else 4 (``width``)
- ``low``, ``high``, ``low_bits``: the documents' ends within the block as Elias-Fano code: the
  low bits of each end packed, the high bits as gaps in unary. About 2 + log2(n_ids / n_docs)
  bits a document; ``EliasFano.select`` finds an end without unpacking the others.

Spark writes and commits the table, so lost executors leave no half blocks, and it can lie in
any file system that Spark reaches.

Null texts are empty; each document has at least its end id. Documents with equal or null keys
stay separate rows. An empty table gives an empty folder.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.bpe import Encoder
from starmart.llm.common import as_bytes, bounded_batches, pieces

BLOCK_IDS = 1 << 20
SAMPLE = 256  # every so many ends, select remembers where it is
MOST_SHARDS_SENT = 1_000_000  # offsets of more shards are joined by a shuffle


class EliasFano:
    """A sorted list of numbers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        bits = np.frombuffer(high, dtype=np.uint8)
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])  # ones before each byte
        self._sample = np.searchsorted(self._before, np.arange(0, n, SAMPLE), side="right") - 1

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        n = len(values)
        last = int(values[-1]) if n else 0
        low_bits = max(0, (last // n).bit_length() - 1) if n else 0
        high = np.zeros((last >> low_bits) + n + 1, dtype=np.uint8)
        high[(values >> low_bits) + np.arange(n)] = 1
        shifts = np.arange(low_bits)
        low = ((values[:, None] >> shifts) & 1).astype(np.uint8).ravel() if low_bits else np.zeros(0, np.uint8)
        return cls(n, low_bits, np.packbits(low, bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes())

    def select(self, i: int) -> int:
        """The i-th number."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        byte = int(self._sample[i // SAMPLE])
        while self._before[byte + 1] <= i:
            byte += 1
        left, bits = i - int(self._before[byte]), self.high[byte]
        for _ in range(left):
            bits &= bits - 1
        place = byte * 8 + (bits & -bits).bit_length() - 1
        start, value = i * self.low_bits, 0
        if self.low_bits:
            part = int.from_bytes(self.low[start // 8 : (start + self.low_bits + 7) // 8], "little")
            value = part >> (start % 8) & ((1 << self.low_bits) - 1)
        return (place - i) << self.low_bits | value

    def all(self) -> np.ndarray:
        """All numbers."""
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        values = (places - np.arange(self.n)) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.low_bits)
            values = values + bits.reshape(self.n, self.low_bits) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return values


def write_tokens(df: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, add ``end_id`` to each, and write the token folder."""
    spark = df.sparkSession
    bounded_batches(spark)
    kind = df.schema[key].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard = Encoder.of(path), TaskContext.get().partitionId()
        width = 2 if max(len(encoder.names), end_id + 1) <= 1 << 16 else 4
        end, block, first = np.array([end_id], dtype="<u4").tobytes(), 0, 0
        keys: list = []
        texts: list[bytes] = []
        size = 0

        def block_row(key_type: pa.DataType) -> pa.RecordBatch:
            ends = np.cumsum([len(t) // 4 for t in texts], dtype=np.int64)
            code = EliasFano.of(ends)
            ids = np.frombuffer(b"".join(texts), dtype="<u4").astype(f"<u{width}").tobytes()
            values = [shard, block, first, len(texts), int(ends[-1]), width, keys, ids, code.low, code.high, code.low_bits]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(key_type), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
            names = ["shard", "block", "first", "n_docs", "n_ids", "width", "keys", "ids", "low", "high", "low_bits"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        key_type = pa.int64()
        for batch in pieces(batches, "text"):
            key_type = batch.schema.field("key").type
            for k, ids in zip(batch.column("key").to_pylist(), encoder.encode(as_bytes(batch.column("text")))):
                keys.append(k)
                texts.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= BLOCK_IDS:
                    yield block_row(key_type)
                    first, block, keys, texts, size = first + size, block + 1, [], [], 0
        if keys:
            yield block_row(key_type)

    ordered = (
        df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
        .repartitionByRange("key")
        .sortWithinPartitions("key")
    )
    rows = ordered.mapInArrow(
        blocks,
        f"shard int, block int, first long, n_docs int, n_ids long, width int, keys array<{kind}>, ids binary, low binary, high binary, low_bits int",
    )
    # Ids of natural text hardly repeat on bytes, so a fast codec is enough.
    rows.write.option("compression", "zstd").parquet(folder)


def read_tokens(spark: SparkSession, folder: str, key: str = "doc_id", crc: bool = False) -> DataFrame:
    """The documents of a token folder: ``key``, ``start`` (ids of all documents before it),
    ``n_tokens`` and either ``ids`` (little-endian unsigned 32-bit integers) or with ``crc`` their
    ``ids_crc32``."""
    bounded_batches(spark)
    table = spark.read.parquet(folder)
    kind = table.schema["keys"].dataType.elementType.simpleString()
    result, result_type = ("ids_crc32", "long") if crc else ("ids", "binary")
    shards = table.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    offsets = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    if shards.count() <= MOST_SHARDS_SENT:
        offsets = F.broadcast(offsets)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                c = {name: batch.column(name)[row].as_py() for name in ("offset", "n_docs", "low_bits", "low", "high", "width", "ids")}
                ends = EliasFano(c["n_docs"], c["low_bits"], c["low"], c["high"]).all()
                starts = np.concatenate([[0], ends[:-1]])
                ids = memoryview(np.frombuffer(c["ids"], dtype=f"<u{c['width']}").astype("<u4")).cast("B")
                parts = [ids[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                values = pa.array([zlib.crc32(p) for p in parts], pa.int64()) if crc else pa.array(map(bytes, parts), pa.binary())
                keys = batch.column("keys")[row].values
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(starts + c["offset"], pa.int64()), pa.array(ends - starts, pa.int64()), values],
                    [key, "start", "n_tokens", result],
                )

    placed = table.join(offsets, "shard").withColumn("offset", F.col("offset") + F.col("first"))
    return placed.select("keys", "offset", "n_docs", "low_bits", "low", "high", "width", "ids").mapInArrow(
        documents, f"{key} {kind}, start long, n_tokens long, {result} {result_type}"
    )
