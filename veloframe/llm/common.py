"""What the operators share: scratch tables in the shared folder and text batches as byte arrays.

Scratch tables are Parquet written below ``spark.checkpoint.dir``, so that every executor sees them,
lineage is cut, and a lost executor costs at most the tasks it was running.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step handles; a single longer text is a step of its own.
STEP_BYTES = 1 << 18


def _frugal() -> None:
    """Large arrays go back to the system when they are freed, so that a worker between tasks does not keep its peak (where the C library can be told)."""
    with contextlib.suppress(OSError, AttributeError):
        tell = ctypes.CDLL(None).mallopt
        tell(-3, 4 << 20)  # M_MMAP_THRESHOLD
        tell(-1, 8 << 20)  # M_TRIM_THRESHOLD
    pa.set_memory_pool(pa.system_memory_pool())


_frugal()


def shared_dir(spark: SparkSession, own: dict = {}) -> str:  # noqa: B006  one folder for each application
    """The cluster's checkpoint folder; only where none is set and all runs in this process (tests), one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        name = spark.sparkContext.applicationId
        found = own.get(name) or own.setdefault(name, tempfile.mkdtemp(prefix="veloframe-"))
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/veloframe/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, compression: str = "zstd", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a scratch table and read it back: the lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).partitionBy(*partition_by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more, and let Spark drop shuffle files of finished jobs."""
    jvm = spark.sparkContext._jvm
    for table in tables:
        path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    jvm.System.gc()  # Spark's cleaner only learns of shuffles that are done from the driver's collector


def byte_column(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one array of UTF-8 bytes and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]] if len(at) else whole, at - at[0] if len(at) else np.zeros(1, np.int64)


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; whole rows only."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def class_table(excluded: str) -> np.ndarray:
    """Which byte values belong to words, from the complement of a regular-expression class of bytes."""
    odd = re.compile(f"[{excluded}]".encode("latin-1"))
    return np.array([odd.match(bytes([b])) is None for b in range(256)])


#: Words of `[^\x20\x09-\x0D]+` and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z has been lower-cased.
SPACED = class_table(r"\x20\x09-\x0D")
PLAIN = class_table(r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F")

_ODD = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006  one table for each process
    if len(cache.get("p", ())) < n:
        size = max(n, STEP_BYTES + (1 << 16))
        inverse = pow(_ODD, -1, 1 << 64)
        for key, base in (("p", _ODD), ("i", inverse)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            cache[key] = np.cumprod(out, dtype=np.uint64)
    return cache["p"], cache["i"]


def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


_VALUES = _byte_values()
_LOWER = _VALUES[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


class Words:
    """The words of some texts: byte ranges, 64-bit hashes, and the range of words of each text.

    ``start``/``end`` are byte offsets into the step's bytes, ``first[i]:first[i+1]`` are text i's words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool):
        self.data, self.offsets = data, offsets
        parts: list[tuple[np.ndarray, ...]] = []
        lo = 0
        while lo < len(data):  # a step's worth of bytes at a time, to the end of a word
            hi = min(len(data), lo + STEP_BYTES)
            while hi < len(data) and table[data[hi]]:
                gap = np.flatnonzero(~table[data[hi : hi + 4096]])
                hi = min(len(data), hi + (int(gap[0]) if len(gap) else 4096))
            parts.append(self._part(lo, hi, table, lower))
            lo = hi
        self.start, self.end, self.hash = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        self.first = np.searchsorted(self.start, offsets)

    def _part(self, lo: int, hi: int, table: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, n = self.data[lo:hi], hi - lo
        inside = table[data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = self.offsets[np.searchsorted(self.offsets, lo, "right") : np.searchsorted(self.offsets, hi)] - lo
        before[cuts], after[cuts - 1] = False, False
        start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        powers, inverses = _powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER if lower else _VALUES)[data] * powers[:n], out=sums[1:])
        return start + lo, end + lo, mixed((sums[end] - sums[start]) * inverses[start])

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they all belong to one text."""
        n = len(self.hash)
        if n < k:
            return np.empty(0, np.uint64), np.empty(0, bool)
        out = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            out = out * np.uint64(_ODD) + self.hash[j : n - k + 1 + j]
        ends = np.repeat(self.first[1:], self.counts())
        return mixed(out), np.arange(k, n + 1) <= ends[: n - k + 1]


def word_steps(column: pa.Array, table: np.ndarray, lower: bool) -> Iterator[tuple[int, int, Words]]:
    """The rows of a text column as (first row, end row, their words)."""
    data, offsets = byte_column(column)
    for lo, hi in steps(offsets):
        at = offsets[lo : hi + 1]
        yield lo, hi, Words(data[at[0] : at[-1]], at - at[0], table, lower)


def spread(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after the other."""
    counts = np.asarray(counts, np.int64)
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def extended(docs: DataFrame, columns: str, compute) -> DataFrame:
    """``docs`` with ``columns`` (DDL), which ``compute`` makes from each Arrow batch. Columns of the same names are replaced."""
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(columns)
    kept = docs.drop(*new.names)
    schema = StructType(kept.schema.fields + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch)], schema.names)

    return kept.mapInArrow(run, schema)


def set_aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` as the ``needed`` columns and one struct of all others, so that no column an operator adds can meet one of theirs; and the way back."""
    from pyspark.sql import functions as F

    others = [c for c in docs.columns if c not in needed]
    kept = [F.col(f"`{c}`") for c in needed if c in docs.columns]
    own = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))

    def back(found: DataFrame) -> DataFrame:
        return found.select(*[(F.col(f"`{c}`") if c in needed else F.col("own_columns")[c]).alias(c) for c in docs.columns])

    return docs.select(*kept, own.alias("own_columns")), back


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` has not."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded_sample(df: DataFrame, keys: list[str], rows: int) -> list:
    """About ``rows`` rows of ``df`` (all, if it has no more), those of least hash of ``keys``; never over twice as many.

    A threshold on the hash picks them where they are. No task sends its best rows to the driver, as an ordered limit would.
    """
    from pyspark.sql import functions as F

    total = df.count()
    if total > rows:
        space = 1 << 40
        df = df.filter(F.pmod(F.xxhash64(*keys), F.lit(space)) < space * rows // total).limit(2 * rows)
    return df.collect()
