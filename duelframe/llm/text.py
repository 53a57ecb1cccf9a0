"""Texts as NumPy byte arrays inside Arrow batches, and scratch tables in the shared folder."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from duelframe.session import stage_path

#: Bytes handled by NumPy at once, of which a worker holds some dozen arrays of eight times the size; longer texts are cut at white space by the callers that can add up parts.
BLOCK_BYTES = 1 << 20


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its rows; a null row is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, pa.scalar(b"", column.type) if pa.types.is_binary(column.type) else "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes; a longer row is alone in its range."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection) over unsigned hashes."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_SYMBOL = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """The first ``n`` powers of an odd base and of its inverse, modulo 2**64; kept for the next block."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.multiply.accumulate(row)
    return _POWERS


def prefix_hashes_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``prefix_hashes`` of a row of mixed numbers in place of bytes."""
    power, inverse = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return sums, inverse


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums ``s`` and factors ``f``: ``(s[end] - s[start]) * f[start]`` is a hash of the run, to be mixed."""
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SYMBOL[data] * power[: len(data)], out=sums[1:])
    return sums, inverse


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run ``data[start:end]``, equal for equal runs wherever they stand."""
    sums, inverse = prefix_hashes(data)
    return mixed((sums[ends] - sums[starts]) * inverse[starts] ^ (ends - starts).astype(np.uint64))


def spaces(data: np.ndarray) -> np.ndarray:
    """True at the ASCII white space bytes: tab, line feed, vertical tab, form feed, carriage return, space."""
    return _SPACE[data]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_runs(space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without white space."""
    edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``released`` deletes it."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``stored``, as a table bucketed by ``key``, which joins by that key leave where it is."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).option("compression", "zstd").saveAsTable(table)
    out = spark.table(table)
    out.stored_path = path
    return out


def released(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def finished(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that nothing refers to any more; it does so when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
