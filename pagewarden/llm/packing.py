"""Packing into length buckets that waste the least padding.

Every document's length in tokens (its subword ids and one end token) goes into one global histogram, a row for each
distinct length: their sum is at most the corpus's tokens, so there are at most sqrt(2 * tokens) of them, and in practice as
many as the longest text has tokens. Dynamic programming over them finds the boundaries that minimise the padding of all
documents when each is padded to the boundary of its bucket; the best last bucket begins no earlier for a longer end, so each
step halves its range (n log n for a bucket). Inside a bucket, documents in order of (length, doc_id) fill batches of
``budget // boundary`` rows (one at least), so a batch never holds more padded tokens than the budget unless a single
document does.

Places inside a bucket come from a range partitioning and one count for each partition and bucket, so no bucket, however
large, is ordered by one task. Null texts have the end token only. Every row gets a place of its own, repeated rows and
null ids included; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import lean, stored, width
from .subwords import counter, default_path

BUCKETS, BUDGET = 16, 65_536


def _lengths(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            n = [count(t.as_py() or "") + 1 for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64())})

    return lean(run)


def lengths(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) for every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_lengths(tokenizer or default_path("byte_bpe_50k.tiktoken")), "doc_id long, n_tokens long")


def _best_ends(before: np.ndarray, ends: np.ndarray, docs: np.ndarray, tokens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each j from ``least + 1`` on, the i in least..j-1 of least before[i] + cost(i, j), and that sum."""
    m = len(ends)
    best, frm = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    # pieces of ends whose middle is solved next, with the range that the answer lies in
    low, high = np.array([least + 1]), np.array([m])
    first, last = np.array([least]), np.array([m - 1])
    while len(low):
        mid = (low + high) // 2
        top = np.minimum(last, mid - 1)
        size = top - first + 1
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        i = np.arange(size.sum()) - np.repeat(begin - first, size)
        j = np.repeat(mid, size)
        sums = before[i] + ends[j - 1] * (docs[j] - docs[i]) - (tokens[j] - tokens[i])
        least_sum = np.minimum.reduceat(sums, begin)
        hit = np.flatnonzero(sums == np.repeat(least_sum, size))
        found = i[hit[np.searchsorted(hit, begin)]]
        best[mid], frm[mid] = least_sum, found
        parts = [(low, mid - 1, first, found), (mid + 1, high, found, last)]
        low, high, first, last = (np.concatenate(x) for x in zip(*[tuple(c[a <= b] for c in (a, b, f, t)) for a, b, f, t in parts]))
    return best, frm


def boundaries(ends: np.ndarray, count: np.ndarray, total: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket boundaries (a subset of ends, the last one included) of least padding.

    cost(i, j) of a bucket over lengths i..j-1 is ends[j-1] * documents - tokens; a step's best[j] is the least
    best-before[i] + cost(i, j). One more bucket never adds padding, so as many as there are lengths, or buckets, are used."""
    keep = count > 0
    ends, count, total = (x[keep].astype(np.int64) for x in (ends, count, total))
    m = len(ends)
    if not m:
        return np.zeros(0, np.int64)
    docs, tokens = np.concatenate(([0], np.cumsum(count))), np.concatenate(([0], np.cumsum(total)))
    best = np.concatenate(([0], ends)) * docs - tokens  # one bucket
    back = [np.zeros(m + 1, np.int64)]
    for b in range(1, min(buckets, m)):
        best, frm = _best_ends(best, ends, docs, tokens, b)
        back.append(frm)
    out, j = [], m
    for frm in reversed(back):
        out.append(int(ends[j - 1]))
        j = int(frm[j])
    return np.array(out[::-1], np.int64)


def histogram(sized: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, ascending, with the documents and tokens of each, over all documents."""
    rows = sized.groupBy("n_tokens").agg(F.count("*").alias("n")).orderBy("n_tokens").toPandas()
    ends, count = (rows[c].to_numpy(np.int64) for c in ("n_tokens", "n"))
    return ends, count, ends * count


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, tokenizer: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, bucket, boundary, batch (numbered over all buckets), slot, padding."""
    spark = docs.sparkSession
    sized = stored(lengths(docs, tokenizer), "pack-lengths")
    bounds = boundaries(*histogram(sized), buckets).tolist() or [1]
    bucket, boundary = F.lit(len(bounds) - 1), F.lit(bounds[-1])
    for k in reversed(range(len(bounds) - 1)):
        bucket = F.when(F.col("n_tokens") <= bounds[k], k).otherwise(bucket)
        boundary = F.when(F.col("n_tokens") <= bounds[k], bounds[k]).otherwise(boundary)
    placed = sized.withColumn("bucket", bucket).withColumn("boundary", boundary.cast("long"))
    placed = placed.repartitionByRange(width(spark), "bucket", "n_tokens", "doc_id").sortWithinPartitions("bucket", "n_tokens", "doc_id")
    numbered = stored(placed.mapInArrow(_number, "doc_id long, n_tokens long, bucket int, boundary long, part int, place long"), "pack-places")

    parts = numbered.groupBy("bucket", "part").agg(F.count("*").alias("n")).orderBy("bucket", "part").collect()  # partitions + buckets rows
    before, seen = {}, {}
    for r in parts:
        before[r.bucket, r.part] = seen.get(r.bucket, 0)
        seen[r.bucket] = seen.get(r.bucket, 0) + r.n
    room = [max(1, budget // b) for b in bounds]
    first_batch, at = [], 0
    for k, size in enumerate(room):
        first_batch.append(at)
        at += -(-seen.get(k, 0) // size)
    offsets = spark.createDataFrame([(b, p, o, room[b], first_batch[b]) for (b, p), o in before.items()], "bucket int, part int, offset long, room long, first_batch long")
    rank = F.col("offset") + F.col("place")
    return numbered.join(F.broadcast(offsets), ["bucket", "part"]).select(
        "doc_id", "n_tokens", "bucket", "boundary", (F.col("first_batch") + F.floor(rank / F.col("room"))).cast("long").alias("batch"), (rank % F.col("room")).cast("int").alias("slot"), (F.col("boundary") - F.col("n_tokens")).alias("padding")
    )


@lean
def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        bucket = np.asarray(batch.column("bucket"))
        place = np.zeros(len(bucket), np.int64)
        for b in np.unique(bucket):
            mine = bucket == b
            place[mine] = seen.get(int(b), 0) + np.arange(mine.sum())
            seen[int(b)] = seen.get(int(b), 0) + int(mine.sum())
        yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("doc_id", "n_tokens", "bucket", "boundary")} | {"part": pa.array(np.full(len(bucket), part, np.int32)), "place": pa.array(place)})
