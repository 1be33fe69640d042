"""Removal of repeated passages by a distributed suffix sort.

A byte is removed when a ``span``-byte string that covers it also starts earlier: in a document with a smaller doc_id, or
earlier in its own. Matches never cross documents; strings are judged on the input.

Sorting every suffix of a corpus moves many times its size. Here a suffix is a sequence of tokens that content defines, and
only suffixes that start at a sampling anchor enter the sort: the anchor of a ``span``-byte window is its least k-byte
substring by hash (leftmost of equal ones), so equal windows have equal anchors at equal offsets and none is missed. The
leading token of an anchor's suffix is the hash of its k bytes, the second one the hash of all bytes of the windows that it
is the anchor of. These suffixes are range-partitioned by splitters sampled from the corpus and sorted in each bucket by
multikey quicksort, token by token.

* Suffixes equal in both tokens are equal windows: all but the first (by doc_id, start) are repeats.
* First ones whose leading token has other continuations may share a part of their windows. A shared window reaches half
  of what it has besides the k bytes to their left or to their right, so only those stay that agree with another one there
  (by 16 bits each, which an anchor carries along). Their windows are compared one by one by 96 bits of hashes: in the
  document's own task first, then across tasks.
* Groups that a splitter cuts are compared across bucket boundaries by their first members.

Null texts are empty. Rows that share a doc_id count as one document, the one with the greatest text (a null doc_id is such
a document and comes before all others); documents shorter than ``span`` bytes lose nothing; extra columns are ignored; an
empty table gives an empty result. Texts of any length are worked through in segments.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import NULL_ID, Prefix, U64, lean, mix, row_slices, single, spread, stored, texts, width

SPAN, K = 100, 20
#: Documents are sampled for splitters at this rate, at least one of so many and up to so many suffixes in all.
SAMPLE, SAMPLED = 0.01, 20_000
_LOW = U64((1 << 24) - 1)
#: Window starts that one segment of a long document has at most; below 2**24.
_SEGMENT = (1 << 19) - (1 << 10)


def anchors(data: np.ndarray, off: np.ndarray, span: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each segment of the rows' bytes: (token 0, token 1, row, start of the first window, windows less one, left, right).

    left and right: 16 bits of the hashes of the k bytes with what is to one side of them, 0 where no window has that much."""
    first, last = int(off[0]), int(off[-1])
    at = first
    while last - at >= span:
        end = min(last, at + _SEGMENT + span - 1)
        part = data[at:end]
        n = len(part)
        one, two = Prefix(part, 1), Prefix(part, 2)
        gram = one.of(np.arange(n - k + 1), np.arange(k, n + 1)) if n < 1 << 16 else _grams(one, n, k)
        value = (gram & ~_LOW) | np.arange(n - k + 1, dtype=U64)
        least, have, want = value, 1, span - k + 1
        while have < want:
            step = min(have, want - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        place = (least & _LOW).astype(np.int64)
        starts = np.arange(len(place))
        row = np.searchsorted(off, starts + at, side="right") - 1
        valid = starts + at + span <= off[row + 1]
        new = np.concatenate(([True], (place[1:] != place[:-1]) | (row[1:] != row[:-1]))) & valid
        stop = np.concatenate((new[1:] | ~valid[1:], [True])) & valid
        p0, p1 = np.flatnonzero(new), np.flatnonzero(stop)
        a, side = place[p0], -(-(span - k) // 2)
        wide = np.stack((a - p0 >= side, a - p1 <= span - k - side))
        left = np.where(wide[0], two.of(np.where(wide[0], a - side, 0), a + k) % U64(65535) + U64(1), 0)
        right = np.where(wide[1], two.of(a, np.where(wide[1], a + k + side, a)) % U64(65535) + U64(1), 0)
        yield gram[a], two.of(p0, p1 + span), row[p0], p0 + at - off[row[p0]], p1 - p0, left.astype(np.uint16), right.astype(np.uint16)
        at = end - span + 1 if end < last else last


def _grams(prefix: Prefix, n: int, k: int) -> np.ndarray:
    return mix((prefix.sums[k:] - prefix.sums[: n - k + 1]) * prefix.down[: n - k + 1] + U64(k))


# ---- the suffixes' way into sorted buckets --------------------------------------------------------------------------

_COLUMNS = (("t0", U64), ("t1", U64), ("doc", np.int64), ("start", np.uint32), ("more", np.uint8), ("left", np.uint16), ("right", np.uint16))


def _pack(columns: list[np.ndarray]) -> bytes:
    return struct.pack("<I", len(columns[0])) + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def _unpack(payloads: list[bytes], kinds: tuple) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in kinds]
    for p in payloads:
        n, at = struct.unpack_from("<I", p)[0], 4
        for into, t in zip(parts, kinds):
            into.append(np.frombuffer(p, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(p) for p in parts]


def _ordered_bytes(t0, t1, doc, start) -> np.ndarray:
    """Keys whose byte order is the suffixes' order."""
    out = np.empty((len(t0), 28), np.uint8)
    for k, c in enumerate((t0, t1, doc.astype(np.int64).view(U64) ^ U64(1 << 63))):
        out[:, 8 * k : 8 * k + 8] = c.astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 24:] = start.astype(">u4").view(np.uint8).reshape(-1, 4)
    return out


class Splitters:
    """Bounds of the buckets, by (token 0, token 1, doc_id, start)."""

    def __init__(self, t0, t1, doc, start):
        self.t0, self.full = t0, _ordered_bytes(t0, t1, doc, start)

    def bucket(self, t0, t1, doc, start) -> np.ndarray:
        out = np.searchsorted(self.t0, t0, side="left")
        tie = np.flatnonzero(np.searchsorted(self.t0, t0, side="right") > out)
        if len(tie):  # the leading token is a splitter's own: whole keys decide
            keys = np.ascontiguousarray(_ordered_bytes(t0[tie], t1[tie], doc[tie], start[tie])).view("V28").ravel()
            full = [bytes(x) for x in self.full]
            order = np.argsort(np.ascontiguousarray(keys).view("S28").ravel(), kind="stable")
            ranks = np.fromiter((bisect.bisect_left(full, keys[i].tobytes()) for i in order), np.int64, len(order))
            out[tie[order]] = ranks
        return out

    def cuts(self, t0: np.ndarray) -> np.ndarray:
        return np.isin(t0, self.t0)


def _suffixes(batch: pa.RecordBatch, span: int, k: int) -> Iterator[list[np.ndarray]]:
    ids = np.asarray(batch.column("doc_id")).astype(np.int64)
    data, off = texts(batch)
    for a, b in row_slices(off, _SEGMENT):
        for t0, t1, row, start, more, left, right in anchors(data, off[a : b + 1], span, k):
            yield [t0, t1, ids[a + row], start.astype(np.uint32), more.astype(np.uint8), left, right]


def _sampled(span: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t0, t1, doc, start, *_ in _suffixes(batch, span, k):
                pick = slice(0, len(t0), max(1, len(t0) // 64))
                yield pa.RecordBatch.from_pydict({"t0": t0[pick].view(np.int64), "t1": t1[pick].view(np.int64), "doc": doc[pick], "start": start[pick].astype(np.int64)})

    return lean(run)


def splitters(docs: DataFrame, buckets: int, span: int = SPAN, k: int = K) -> Splitters:
    """From a sample of fixed rate, cut to a fixed number of suffixes by their hash."""
    found = docs.sample(SAMPLE, seed=7).mapInArrow(_sampled(span, k), "t0 long, t1 long, doc long, start long")
    got = found.orderBy(F.xxhash64("t0", "doc", "start")).limit(SAMPLED).toPandas()
    t0, t1, doc, start = (got[c].to_numpy(np.int64) for c in ("t0", "t1", "doc", "start"))
    t0, t1 = t0.view(U64), t1.view(U64)
    order = np.lexsort((start, doc, t1, t0))
    if not len(order):
        even = (np.arange(1, buckets) * ((1 << 64) // buckets)).astype(U64)
        return Splitters(even, np.zeros(len(even), U64), np.zeros(len(even), np.int64), np.zeros(len(even), np.int64))
    pick = order[np.unique((np.arange(1, buckets) * len(order)) // buckets)]
    return Splitters(t0[pick], t1[pick], doc[pick], start[pick])


def _deal(split: Splitters, span: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, payload = [], []
            held: list[list[np.ndarray]] = []
            for columns in _suffixes(batch, span, k):
                held.append(columns)
                if sum(len(c[0]) for c in held) > 100_000:
                    _send(held, split, where, payload)
                    held = []
            if held:
                _send(held, split, where, payload)
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(where, pa.int32()), "payload": pa.array(payload, pa.binary())})

    return lean(run)


def _send(held, split, where, payload) -> None:
    columns = [np.concatenate(c) for c in zip(*held)]
    bucket = split.bucket(*columns[:4])
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], bucket[order][1:] != bucket[order][:-1]))) if len(order) else []
    for a, b in zip(cut, [*cut[1:], len(order)]):
        o = order[a:b]
        where.append(int(bucket[o[0]]))
        payload.append(_pack([c[o] for c in columns]))


def multikey_quicksort(tokens: list[np.ndarray], insertion: int = 4096) -> np.ndarray:
    """Order of token sequences: ternary partition at a pivot of one token, going one token deeper in the middle part only."""
    index = np.arange(len(tokens[0]))
    out, todo = [], [(index, 0)]
    while todo:
        part, depth = todo.pop()
        if len(part) < 2 or depth == len(tokens):
            out.append(part)
            continue
        values = tokens[depth][part]
        if len(part) <= insertion:
            out.append(part[np.lexsort([t[part] for t in reversed(tokens[depth:])])])
            continue
        pivot = np.partition(values[:: max(1, len(values) // 63)], min(31, (len(values) - 1) // 2))[min(31, (len(values) - 1) // 2)]
        todo += [(part[values > pivot], depth), (part[values == pivot], depth + 1), (part[values < pivot], depth)]
    return np.concatenate(out) if out else index


_FOUND = "home int, kind int, payload binary, t0 long, t1 long, doc long, start long, more int"


def _sorted_bucket(split: Splitters, homes: int):
    """Of a task's buckets, sorted together: repeats and windows to compare, packed by the home of their document, and first members of cut groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payloads = [p for batch in batches for p in batch.column("payload").to_pylist()]
        t0, t1, doc, start, more, left, right = _unpack(payloads, tuple(t for _, t in _COLUMNS))
        del payloads
        if not len(t0):
            return
        order = multikey_quicksort([t0, t1, doc.view(U64) ^ U64(1 << 63), start.astype(U64)])
        t0, t1, doc, start, more, left, right = (c[order] for c in (t0, t1, doc, start, more, left, right))
        new0 = np.concatenate(([True], t0[1:] != t0[:-1]))
        new1 = np.concatenate(([True], t1[1:] != t1[:-1])) | new0
        group = np.cumsum(new0) - 1
        kinds = np.bincount(group, weights=new1)[group]
        cut = split.cuts(t0)
        ask = np.flatnonzero(new1 & (kinds > 1) & ~cut)
        ask = ask[_agreeing(group[ask], left[ask]) | _agreeing(group[ask], right[ask])]
        repeat, lead = np.flatnonzero(~new1), new1 & cut
        for kind, mask in ((0, repeat), (1, ask)):
            yield from _by_home(kind, [doc[mask], start[mask], more[mask]], homes)
        i = np.flatnonzero(lead)
        if len(i):
            none = pa.nulls(len(i), pa.int32())
            yield pa.RecordBatch.from_pydict({"home": none, "kind": pa.array([2] * len(i), pa.int32()), "payload": pa.nulls(len(i), pa.binary()), "t0": t0[i].view(np.int64), "t1": t1[i].view(np.int64), "doc": doc[i], "start": start[i].astype(np.int64), "more": more[i].astype(np.int32)})

    return lean(run)


def _agreeing(group: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Whether another member of the same group has the same side (0 is none)."""
    key = group.astype(np.int64) << 16 | side
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    return (count[inverse] > 1) & (side > 0)


def _home(doc: np.ndarray, homes: int) -> np.ndarray:
    return (mix(doc.view(U64)) % U64(homes)).astype(np.int32)


def _by_home(kind: int, columns: list[np.ndarray], homes: int) -> Iterator[pa.RecordBatch]:
    home = _home(columns[0], homes)
    order = np.argsort(home, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], home[order][1:] != home[order][:-1]))) if len(order) else []
    where, payload = [], []
    for a, b in zip(cut, [*cut[1:], len(order)]):
        where.append(int(home[order[a]]))
        payload.append(_pack([c[order[a:b]] for c in columns]))
    if where:
        n = len(where)
        yield pa.RecordBatch.from_pydict({"home": pa.array(where, pa.int32()), "kind": pa.array([kind] * n, pa.int32()), "payload": pa.array(payload, pa.binary())} | {c: pa.nulls(n, pa.int64()) for c in ("t0", "t1", "doc", "start")} | {"more": pa.nulls(n, pa.int32())})


# ---- documents meet what was found about them ------------------------------------------------------------------------

_HOME = "home int, kind int, payload binary, doc long"
_RANGE = (np.int64, np.uint32, np.uint8)
_WINDOW = (U64, np.uint32, np.int64, np.uint32)


def _text_rows(homes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids = np.asarray(batch.column("doc_id")).astype(np.int64)
            data, off = texts(batch)
            yield pa.RecordBatch.from_pydict({"home": pa.array(_home(ids, homes)), "kind": pa.array([9] * len(ids), pa.int32()), "payload": pa.array([pack.compress(data[off[i] : off[i + 1]].tobytes()) for i in range(len(ids))], pa.binary()), "doc": ids})

    return lean(run)


class _Ranges:
    """Ranges of documents, sorted by document."""

    def __init__(self, payloads: list[bytes], kinds: tuple):
        columns = _unpack(payloads, kinds)
        order = np.argsort(columns[0], kind="stable")
        self.columns = [c[order] for c in columns]

    def of(self, doc: int) -> list[np.ndarray]:
        a, b = np.searchsorted(self.columns[0], [doc, doc], side="left")[0], np.searchsorted(self.columns[0], doc, side="right")
        return [c[a:b] for c in self.columns[1:]]


def _bucketed(batches, kinds=(0, 1)):
    """Reads a task's rows, sorted by kind: first all ranges, then document rows one by one."""
    held: dict[int, list[bytes]] = {k: [] for k in kinds}
    for batch in batches:
        kind, payload, doc = batch.column("kind").to_pylist(), batch.column("payload"), batch.column("doc").to_pylist()
        for i, k in enumerate(kind):
            if k == 9:
                yield held, doc[i], payload[i]
            else:
                held[k].append(payload[i].as_buffer().to_pybytes())


_STEP = "bucket int, payload binary, doc long, kind int"


def _windows(span: int, homes: int, buckets: int):
    """Compares asked windows inside the task; the first of each goes on, the others are repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        asks = None
        out: list[list[np.ndarray]] = []
        for held, doc, packed in _bucketed(batches, (1,)):
            if asks is None:
                asks = _Ranges(held[1], _RANGE)
                held[1] = []
            start, more = asks.of(doc)
            if len(start):
                data = np.frombuffer(unpack.decompress(packed.as_buffer()), np.uint8)
                count = more.astype(np.int64) + 1
                p = np.repeat(start.astype(np.int64), count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                for at in range(0, len(data) - span + 1, _SEGMENT):
                    end = min(len(data), at + _SEGMENT + span - 1)
                    here = p[(p >= at) & (p < at + _SEGMENT)] - at
                    if len(here):
                        part = data[at:end]
                        out.append([Prefix(part, 1).of(here, here + span), (Prefix(part, 2).of(here, here + span) >> U64(32)).astype(np.uint32), np.full(len(here), doc), (here + at).astype(np.uint32)])
        if out:
            h1, h2, doc, p = (np.concatenate(c) for c in zip(*out))
            order = np.lexsort((p, doc, h2, h1))
            h1, h2, doc, p = h1[order], h2[order], doc[order], p[order]
            first = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            yield from _step(1, [h1[first], h2[first], doc[first], p[first]], (h1[first] % U64(buckets)).astype(np.int32))
            again = _runs(doc[~first], p[~first])
            yield from _step(3, again, (mix(again[0].view(U64)) % U64(buckets)).astype(np.int32))

    return lean(run)


def _runs(doc: np.ndarray, p: np.ndarray) -> list[np.ndarray]:
    """Consecutive windows of a document as (doc, start, further windows), at most 256 windows each."""
    order = np.lexsort((p, doc))
    doc, p = doc[order], p[order].astype(np.int64)
    if not len(p):
        return [doc, p.astype(np.uint32), p.astype(np.uint8)]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (p[1:] != p[:-1] + 1)))
    begin = np.flatnonzero(new)
    length = np.diff(np.concatenate((begin, [len(p)])))
    pieces = -(-length // 256)
    first = np.repeat(begin, pieces) + 256 * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    size = np.minimum(256, np.repeat(begin + length, pieces) - first)
    return [doc[first], p[first].astype(np.uint32), (size - 1).astype(np.uint8)]


def _step(kind: int, columns: list[np.ndarray], bucket, homes: int = 0) -> Iterator[pa.RecordBatch]:
    if bucket is None:
        bucket = _home(columns[0], homes)
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], bucket[order][1:] != bucket[order][:-1]))) if len(order) else []
    where, payload = [], []
    for a, b in zip(cut, [*cut[1:], len(order)]):
        where.append(int(bucket[order[a]]))
        payload.append(_pack([c[order[a:b]] for c in columns]))
    if where:
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(where, pa.int32()), "payload": pa.array(payload, pa.binary()), "doc": pa.nulls(len(where), pa.int64()), "kind": pa.array([kind] * len(where), pa.int32())})


def _settled(homes: int):
    """Of buckets of windows: every one but the first of its string, as runs for its document's home; known runs too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[bytes]] = {1: [], 3: []}
        for batch in batches:
            for kind, payload in zip(batch.column("kind").to_pylist(), batch.column("payload").to_pylist()):
                got[kind].append(payload)
        yield from _step(3, _unpack(got[3], _RANGE), None, homes)
        h1, h2, doc, p = _unpack(got[1], _WINDOW)
        if not len(h1):
            return
        order = np.lexsort((p, doc, h2, h1))
        h1, h2, doc, p = h1[order], h2[order], doc[order], p[order]
        again = np.concatenate(([False], (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])))
        yield from _step(3, _runs(doc[again], p[again]), None, homes)

    return lean(run)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, stops array<long>, text string"


def _removed(span: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, ranges = zstandard.ZstdDecompressor(), None
        rows: list[tuple] = []
        held_bytes = 0

        def flush():
            columns = list(zip(*rows))
            rows.clear()
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string())
            return pa.RecordBatch.from_pydict({n.split()[0]: pa.array(c, t) for n, c, t in zip(_RESULT.split(", "), columns, kinds)})

        for held, doc, packed in _bucketed(batches, (0, 3)):
            if ranges is None:
                ranges = _Ranges(held[0] + held[3], _RANGE)
                held[0], held[3] = [], []
            data = unpack.decompress(packed.as_buffer())
            start, more = ranges.of(doc)
            a, b = union(start.astype(np.int64), start.astype(np.int64) + more + span)
            cut = np.concatenate(([0], np.stack((a, b), 1).ravel(), [len(data)])).reshape(-1, 2)
            digest, kept = hashlib.sha256(), []
            view = memoryview(data)
            for x, y in cut:
                digest.update(view[x:y])
                if with_text:
                    kept.append(view[x:y])
            rows.append((doc if doc != NULL_ID else None, len(data), int((b - a).sum()), len(a), digest.hexdigest(), a.tolist(), b.tolist(), b"".join(kept).decode("utf-8", "ignore") if with_text else None))
            held_bytes += len(data) if with_text else 200
            if len(rows) >= 2000 or held_bytes > 16 << 20:
                held_bytes = 0
                yield flush()
        if rows:
            yield flush()

    return lean(run)


def union(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of intervals."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate(([True], start[1:] > stop[:-1]))
    return start[new], stop[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(stop) - 1]))]


def remove_repeats(docs: DataFrame, span: int = SPAN, k: int = K, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts and stops of what was removed (byte
    places), and text, what is left (bytes of a character that a cut splits are dropped)."""
    spark = docs.sparkSession
    n = width(spark)
    docs = single(docs)
    split = splitters(docs, n, span, k)
    dealt = spread(docs.mapInArrow(_deal(split, span, k), "bucket int, payload binary"), n, "bucket")
    found = stored(dealt.mapInArrow(_sorted_bucket(split, n), _FOUND), "suffix-found")

    leads = found.where("kind = 2")  # compare across boundaries: first members of groups that a splitter cuts
    firsts = leads.groupBy("t0", "t1").agg(F.min(F.struct("doc", "start")).alias("first"))
    many = firsts.groupBy("t0").agg((F.count("*") > 1).alias("many"))
    leads = leads.join(firsts, ["t0", "t1"]).join(many, "t0").withColumn("is_first", F.struct("doc", "start") == F.col("first"))
    leads = leads.where("NOT is_first OR many").select("doc", "start", "more", F.when(F.col("is_first"), 1).otherwise(0).alias("kind"))
    extra = leads.mapInArrow(_lead_rows(n), _HOME)

    rows = docs.mapInArrow(_text_rows(n), _HOME)
    ranges = found.where("kind < 2").select("home", "kind", "payload", F.lit(None).cast("long").alias("doc")).unionByName(extra)
    met = spread(rows.unionByName(ranges.where("kind = 1")), n, "home").sortWithinPartitions("kind")
    asked = spread(met.mapInArrow(_windows(span, n, n), _STEP), n, "bucket")
    settled = asked.mapInArrow(_settled(n), _STEP).select(F.col("bucket").alias("home"), "kind", "payload", "doc")
    final = spread(rows.unionByName(ranges.where("kind = 0")).unionByName(settled), n, "home").sortWithinPartitions("kind")
    return final.mapInArrow(_removed(span, with_text), _RESULT)


def _lead_rows(homes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = np.asarray(batch.column("kind"))
            doc, start, more = (np.asarray(batch.column(c)) for c in ("doc", "start", "more"))
            for k in (0, 1):
                m = kind == k
                for got in _by_home(k, [doc[m].astype(np.int64), start[m].astype(np.uint32), more[m].astype(np.uint8)], homes):
                    yield pa.RecordBatch.from_pydict({c: got.column(c) for c in ("home", "kind", "payload", "doc")})

    return lean(run)
