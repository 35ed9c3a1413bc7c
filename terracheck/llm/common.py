"""Shared helpers: reading tables, shared scratch tables, ASCII lower case, bulk tokenising.

Python workers see texts as Arrow batches of ``BATCH_BYTES`` at most, or one row if that is longer
(``bounded_batches``). ``text_slices`` cuts a batch into slices of a few megabytes, so the memory of
a task depends on its longest single text and not on the number of rows in a batch. ``tokenise`` finds all words of a slice with array operations."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracheck.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Bytes of text that one array step handles.
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch: the JVM and the Python worker of each task hold several copies of one.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end at ``BATCH_BYTES``, unless the session sets a bound of its own."""
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: cuts the
    lineage, survives lost executors, and keeps column pruning for later readers."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # Spark deletes the shuffle files of the finished write once the driver has collected its plan
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a table of :func:`written` that no later step reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pack_texts(df: DataFrame) -> DataFrame:
    """``df`` with its column ``text`` compressed into binary: for texts that are to be shuffled.
    Null becomes the empty text. :func:`unpack` reads it."""
    names, at = df.columns, df.columns.index("text")
    fields = [T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in df.schema.fields]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for i, j, raw, off in text_slices(batch.column(at)):
                columns = [c.slice(i, j - i) for c in batch.columns]
                columns[at] = pa.array([press.compress(raw[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(pack, T.StructType(fields))


def unpack(packed: pa.Array) -> Iterator[bytes]:
    """The texts of a packed column, one at a time."""
    expand = zstandard.ZstdDecompressor()
    for z in packed:
        yield expand.decompress(z.as_py())


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(c, UPPER, LOWER)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name starting with ``base`` that ``df`` does not have (case is ignored)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def byte_table(separators: Callable[[int], bool]) -> bytes:
    """A 256-byte translation: A-Z to a-z, separators to a space, all else unchanged."""
    out = bytearray(range(256))
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        out[b] = 32 if separators(low) else low
    return bytes(out)


#: Words ``[^\x20\x09-\x0D]+``: white space separates.
SPACE_TABLE = byte_table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: ASCII digits and letters, and all that is not ASCII.
ALNUM_TABLE = byte_table(lambda b: b < 0x80 and not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A))


def string_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null is the empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def text_slices(arr: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows that hold about ``size`` bytes."""
    raw, off = string_buffers(arr)
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


class Words(NamedTuple):
    data: np.ndarray  # lower-cased bytes, separators as spaces
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    first: np.ndarray  # per row: index of its first word; one more entry at the end


def tokenise(raw: np.ndarray, off: np.ndarray, table: bytes) -> Words:
    """All words of a slice; words never cross rows."""
    data = np.frombuffer(table, dtype=np.uint8)[raw]
    inside = data != 32
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True  # a row ends and another begins
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return Words(data, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, off))


_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1), base, dtype=np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if n <= SLICE_BYTES + 2:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, equal wherever the word stands."""
    n = len(w.data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((w.data.astype(np.uint64) + np.uint64(1)) * _powers(_P, n), out=total[1:])
    h = (total[w.ends] - total[w.starts]) * _powers(_PINV, n + 1)[w.starts]
    return mix(h + (w.ends - w.starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each word on; the last ``k - 1`` entries are missing."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    mul = _powers(0xC2B2AE3D27D4EB4F, k)
    for j in range(k):
        out += h[j : j + m] * mul[j]
    return mix(out)
