"""Shared pieces: shared-folder tables, Arrow access to whole texts, vectorised hashing of words and byte strings.

Hashes are polynomial over 64 bits (``sum T[byte] * B**j``, B odd, so a substring's hash comes from two prefix sums and an
inverse power) followed by a finaliser. All of it is numpy over a whole batch of texts, a few nanoseconds a byte.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Bytes of text that are hashed at once; keeps the temporaries of one step near the CPU's cache.
SEGMENT = 1 << 19
#: Bytes of text that a step over whole documents takes at once (one longer document is taken alone).
SLICE = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a part of the warehouse where that is unset (tests)."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df as Parquet in the shared folder and reads it again with the same schema."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pagewarden/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes what stored() wrote for df, which nothing may read any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def cleaned(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more; else they stay until the driver's JVM, which
    does not know how full the disks are, happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def width(spark: SparkSession) -> int:
    """Partitions of an explicit shuffle: the session's setting, which a deployment sizes to its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, n: int, bucket: str) -> DataFrame:
    """One partition for each number in ``bucket`` (0 to n - 1); hashing the numbers would give some tasks several."""
    return df.repartitionById(n, F.col(bucket).cast("int"))


def fanned(df: DataFrame, n: int, key: str, fan: int = 64) -> DataFrame:
    """Rows of a key from every 64th task together: a first round of sums, so that no task gets a row from every other."""
    own = F.pmod(F.spark_partition_id(), F.lit(fan))
    return df.withColumn("_fan", own).repartition(n, key, "_fan").drop("_fan")


#: What a task gives up when it ends, besides free memory.
AT_END: list = []


def lean(run):
    """A task's function that returns its memory when it is done: Python workers live on, and what they keep adds up."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            for forget in (_powers.cache_clear, *AT_END):
                forget()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


#: The id under which a null doc_id is sorted.
NULL_ID = -(1 << 63)


def single(docs: DataFrame) -> DataFrame:
    """doc_id and text, one row for each doc_id (a null one as NULL_ID); only where ids repeat are rows grouped."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs
    return docs.groupBy("doc_id").agg(F.max("text").alias("text"))


def texts(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and row offsets into them, without copying; null is empty."""
    array = batch.column(column)
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    large = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64 if large else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off if len(off) else np.zeros(1, np.int64)


def row_slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have at most ``most`` bytes together; a longer row comes alone."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
        yield start, min(end, rows)
        start = min(end, rows)


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(n, U64(b), U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@lru_cache(maxsize=4)
def _byte_codes(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)


BASES = {1: 0x9E3779B97F4A7C15, 2: 0xD1B54A32D192ED03}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (the splitmix64 one)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Prefix:
    """Prefix sums over one byte string, from which the hash of any substring comes in constant time."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        n = len(data)
        size = max(SEGMENT, 1 << max(0, n).bit_length())
        self.up, self.down = _powers(BASES[seed], size)
        self.sums = np.zeros(n + 1, U64)
        step = _byte_codes(seed)[data]
        step *= self.up[:n]
        np.cumsum(step, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end], for arrays of bounds."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U64))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z become a-z; all other bytes stay."""
    out = data.copy()
    out[(out >= 65) & (out <= 90)] += 32
    return out


def word_bounds(data: np.ndarray, word: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes (by default: all but the six ASCII spaces)."""
    is_word = ~_SPACE[data] if word is None else word[data]
    edge = np.diff(np.concatenate(([0], is_word.view(np.int8), [0])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, offsets: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words of the rows between offsets, in order, and for each row the first word's place.

    Works through segments that end at a space, so a text of any length needs little memory; words never cross rows.
    """
    first, last = int(offsets[0]), int(offsets[-1])
    hashes, starts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    at = first
    cuts = offsets[1:-1]
    while at < last:
        end = min(at + SEGMENT, last)
        if end < last:
            gap = np.flatnonzero(_SPACE[data[at:end]])
            inner = int(np.searchsorted(cuts, end, side="right")) - 1
            end = max(at + int(gap[-1]) + 1 if len(gap) else 0, int(cuts[inner]) if inner >= 0 and cuts[inner] > at else 0) or _next_gap(data, end, last, cuts)
        part = lower_ascii(data[at:end])
        inside = cuts[(cuts > at) & (cuts < end)] - at
        s, e = _split_at(*word_bounds(part), inside)
        hashes.append(Prefix(part, seed).of(s, e))
        starts.append(s + at)
        at = end
    where = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(where, offsets, side="left")


def _next_gap(data: np.ndarray, at: int, last: int, cuts: np.ndarray) -> int:
    """The first place from ``at`` on after which a word may not go on: behind a space, a row's end, or the end."""
    stop = int(cuts[np.searchsorted(cuts, at, side="left")]) if np.searchsorted(cuts, at, side="left") < len(cuts) else last
    while at < stop:
        gap = np.flatnonzero(_SPACE[data[at : min(at + SEGMENT, stop)]])
        if len(gap):
            return at + int(gap[0]) + 1
        at = min(at + SEGMENT, stop)
    return stop


def _split_at(s: np.ndarray, e: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts words that run over a row's end (two rows may touch without a space)."""
    if not len(cuts) or not len(s):
        return s, e
    k = np.searchsorted(s, cuts, side="right") - 1
    inside = (k >= 0) & (cuts > s[k]) & (cuts < e[k])
    cut = np.unique(cuts[inside])
    if not len(cut):
        return s, e
    return np.sort(np.concatenate((s, cut))), np.sort(np.concatenate((e, cut)))


def shingles(words: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n-word shingles of each row (rows' words at places[i]:places[i+1]) and each shingle's row.

    A row of fewer words, but not none, has its whole sequence as its only shingle.
    """
    count = np.diff(places)
    rows = np.repeat(np.arange(len(count)), count)
    total = len(words)
    if not total:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    weights = [U64(pow(BASES[1], 2 * k + 1, 1 << 64)) for k in range(n)]
    h = np.full(total, U64(n), U64)
    for k, weight in enumerate(weights):
        h[: total - k] += words[k:] * weight
    full = np.arange(total) + n <= places[1:][rows]
    out, of = [mix(h[full])], [rows[full]]
    for r in np.flatnonzero((count > 0) & (count < n)):
        part = words[places[r] : places[r + 1]]
        v = int(len(part)) + sum(int(w) * int(x) for w, x in zip(part, weights))
        out.append(mix(np.array([v & 0xFFFFFFFFFFFFFFFF], U64)))
        of.append(np.array([r]))
    if len(out) == 1:
        return out[0], of[0]
    h, rows = np.concatenate(out), np.concatenate(of)
    order = np.argsort(rows, kind="stable")
    return h[order], rows[order]
