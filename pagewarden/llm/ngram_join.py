"""N-gram Jaccard join: blocked sparse products of the document by n-gram incidence.

Documents link when the Jaccard similarity of their sets of distinct word n-grams is at least ``percent`` / 100. Lower-cased
(A-Z) words between ASCII white space; a text with fewer than n words has its whole sequence as one n-gram; one without
words, or null, has none and links with nothing.

1. Word counts of all documents go into one sketch of fixed size. They order n-grams: those with the rarest word first.
2. Equal sets form a class. By the size-derived bound, two classes that link share one of the first
   ``size - ceil(percent * size / 100) + 1`` n-grams in that order; only these become postings. Two classes of a posting
   that cannot link are told apart by their sizes, by how many n-grams follow the common one, and by signatures: bits, one at
   least for each n-gram, that are flipped by each n-gram of the set; sets differ by as many n-grams as bits at least.
   Of n-grams in at most ``PAIRED`` classes all pairs are judged; in more, a search from class to class ties those that may
   link without making all pairs.
3. What may link gives blocks that no link leaves. In each block the product of the incidence matrix with its transpose accumulates
   exact overlap counts (rare columns pair by pair, frequent columns as dense products); pairs below their bound go. A large
   block becomes tiles, each pair of tiles a task of its own; only each tile's components and degrees leave it.

Results per row of the input: doc_id, n_shingles, component_id (the smallest doc_id reachable), n_links (linked classes of
other n-gram sets). Rows with a null doc_id get the component of their class, null if nothing else is in it
(it joins others only through equal sets); repeated rows give repeated results; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import U64, cleaned, discard, fanned, lean, mix, row_slices, shingles, stored, texts, width, word_hashes
from .components import components

#: Cells of the word-count sketch (its levels take one byte each where they are used).
CELLS = 1 << 22
_SLICE = 1 << 16
#: Of n-grams that begin more classes than this, classes are tied along a search and not in all pairs.
PAIRED = 128
#: Bits of the signature that every class has; sets of more n-grams have a longer one too.
SMALL = 512
#: A block of more classes is tiled.
TILE = 1024
#: Columns of a block that hold more rows are multiplied as dense matrices.
DENSE = 32


# ---- 1: word counts -------------------------------------------------------------------------------------------------


@lean
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, np.uint32)
    for batch in batches:
        data, off = texts(batch)
        for a, b in row_slices(off):
            h, _ = word_hashes(data, off[a : b + 1])
            total += np.bincount((h >> U64(20)).astype(np.int64) & (CELLS - 1), minlength=CELLS).astype(np.uint32) if len(h) > CELLS // 16 else 0
            if len(h) <= CELLS // 16:
                cell, n = np.unique((h >> U64(20)).astype(np.int64) & (CELLS - 1), return_counts=True)
                total[cell] += n.astype(np.uint32)
    pack = zstandard.ZstdCompressor(level=1)
    parts = [(k, total[k * _SLICE : (k + 1) * _SLICE]) for k in range(CELLS // _SLICE)]
    parts = [(k, pack.compress(p.tobytes())) for k, p in parts if p.any()]
    yield pa.RecordBatch.from_pydict({"part": pa.array([k for k, _ in parts], pa.int32()), "counts": pa.array([p for _, p in parts], pa.binary())})


@lean
def _merge_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of slices, as slices again; a count stops at the type's largest value."""
    unpack, pack, sums = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1), {}
    for batch in batches:
        for k, p in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            part = np.frombuffer(unpack.decompress(p), np.uint32).astype(np.uint64)
            sums[k] = sums[k] + part if k in sums else part
    yield pa.RecordBatch.from_pydict({"part": pa.array(list(sums), pa.int32()), "counts": pa.array([pack.compress(np.minimum(v, 0xFFFFFFFF).astype(np.uint32).tobytes()) for v in sums.values()], pa.binary())})


@lean
def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack, sums = zstandard.ZstdDecompressor(), {}
    for batch in batches:
        for k, p in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            part = np.frombuffer(unpack.decompress(p), np.uint32).astype(np.uint64)
            sums[k] = sums[k] + part if k in sums else part
    yield pa.RecordBatch.from_pydict({"part": pa.array(list(sums), pa.int32()), "levels": pa.array([_level(v).tobytes() for v in sums.values()], pa.binary())})


def _level(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(4 * np.log2(np.maximum(count, 1))), 255).astype(np.uint8)


def word_levels(docs: DataFrame) -> np.ndarray:
    """For each cell of the sketch 4 * log2 of the count of its words over all documents; fixed size."""
    n = width(docs.sparkSession)
    parts = docs.select("text").mapInArrow(_count_words, "part int, counts binary")
    parts = fanned(parts, n, "part").mapInArrow(_merge_counts, "part int, counts binary").repartition(min(CELLS // _SLICE, n), "part")
    out = np.zeros(CELLS, np.uint8)
    for row in parts.mapInArrow(_add_counts, "part int, levels binary").collect():
        out[row.part * _SLICE : (row.part + 1) * _SLICE] = np.frombuffer(row.levels, np.uint8)
    return out


# ---- 2: classes and postings ----------------------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int, levels: np.ndarray | None = None):
    """Distinct n-grams of each row, rarest first: (hash, row, level), sorted by row, level, hash."""
    words, places = word_hashes(data, off)
    h, row = shingles(words, places, n)
    if levels is None:
        level = np.zeros(len(h), np.int64)
    else:
        w = levels[(words >> U64(20)).astype(np.int64) & (CELLS - 1)]
        count = np.diff(places)
        rarest = w.copy()
        for k in range(1, n):
            np.minimum(rarest[: len(w) - k], w[k:], out=rarest[: len(w) - k])
        rows = np.repeat(np.arange(len(count)), count)
        full = np.arange(len(w)) + n <= places[1:][rows]
        short = [(r, w[places[r] : places[r + 1]].min()) for r in np.flatnonzero((count > 0) & (count < n))]
        if short:
            at = np.concatenate((rows[full], [r for r, _ in short]))
            level = np.concatenate((rarest[full], [x for _, x in short]))[np.argsort(at, kind="stable")].astype(np.int64)
        else:
            level = rarest[full].astype(np.int64)
    order = np.lexsort((h, row * 256 + level))
    h, row, level = h[order], row[order], level[order]
    if len(h):
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
        h, row, level = h[new], row[new], level[new]
    return h, row, level


def class_keys(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """128 bits for each row that depend on its set alone; rows without n-grams get zeros."""
    out = np.zeros((rows, 2), U64)
    for k, salt in enumerate((0xA5A5A5A5A5A5A5A5, 0x3C3C3C3C3C3C3C3C)):
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix(h ^ U64(salt)), dtype=U64)))
        edge = np.searchsorted(row, np.arange(rows + 1))
        out[:, k] = mix(sums[edge[1:]] - sums[edge[:-1]])
    return out


def signatures(h: np.ndarray, row: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits that the n-grams of each row's set flip, packed row after row, and each row's number of bits: a power of two that is
    ``SMALL`` and the size at least. Halves of a signature added without carry are the signature of half the length."""
    bits = np.maximum(SMALL, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    start = np.cumsum(bits) - bits
    cell = start[row] + ((h >> U64(20)).astype(np.int64) & (bits[row] - 1))
    return np.packbits((np.bincount(cell, minlength=int(bits.sum())) & 1).astype(np.uint8)), bits


def folded(sig: np.ndarray, nbytes: int) -> np.ndarray:
    """Rows of signatures, shortened to so many bytes."""
    return np.bitwise_xor.reduce(sig.reshape(len(sig), -1, nbytes), axis=1)


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits rows of bytes differ: their sets differ by as many n-grams at least."""
    return np.bitwise_count(np.ascontiguousarray(x).view(U64) ^ np.ascontiguousarray(y).view(U64)).sum(-1, dtype=np.int64)


def _needed(m: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """The least number of common n-grams with which sets of sizes m and n link."""
    return -(-percent * (m + n) // (100 + percent))


_HEAD = struct.Struct("<III")


def _pack(tokens, sizes, places, keys, doc_ids, doc_null, doc_n, doc_keys, sig_bytes, sigs: bytes) -> bytes:
    return b"".join((_HEAD.pack(len(tokens), len(doc_ids), len(sigs)), tokens.tobytes(), sizes.astype(np.uint32).tobytes(), places.astype(np.uint32).tobytes(), keys.tobytes(), doc_ids.tobytes(), doc_null.astype(np.uint8).tobytes(), doc_n.astype(np.uint32).tobytes(), doc_keys.tobytes(), sig_bytes.astype(np.uint32).tobytes(), sigs))


def _unpack(p: bytes) -> list[np.ndarray]:
    k, m, s = _HEAD.unpack_from(p)
    at, out = _HEAD.size, []
    for kind, count, wide in ((U64, k, 1), (np.uint32, k, 1), (np.uint32, k, 1), (U64, k, 2), (np.int64, m, 1), (np.uint8, m, 1), (np.uint32, m, 1), (U64, m, 2), (np.uint32, m, 1), (np.uint8, s, 1)):
        n = count * wide
        a = np.frombuffer(p, kind, n, at)
        at += a.nbytes
        out.append(a.reshape(-1, 2) if wide == 2 else a)
    return out


def _post(n: int, percent: int, buckets: int, levels):
    """Rows of texts become packed postings, and document rows with the signatures of their classes, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = levels.value
        for batch in batches:
            ids = batch.column("doc_id")
            null, ids = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0)).astype(np.int64)
            data, off = texts(batch)
            bucket_out, pay_out = [], []
            for a, b in row_slices(off):
                rows = b - a
                h, row, level = shingle_sets(data, off[a : b + 1], n, level_of)
                keys = class_keys(h, row, rows)
                edge = np.searchsorted(row, np.arange(rows + 1))
                size = np.diff(edge)
                _, once = np.unique(keys, axis=0, return_index=True)
                first = np.zeros(rows, bool)
                first[once] = True
                sig, bits = signatures(h, row, size)
                sig_at = (np.cumsum(bits) - bits) // 8
                sig_bytes = np.where(first & (size > 0), bits // 8, 0)
                prefix = np.where(first & (size > 0), size - -(-percent * size // 100) + 1, 0)
                place = np.arange(len(h)) - edge[row]
                take = place < prefix[row]
                t, r, place = h[take], row[take], place[take]
                bucket = (mix(t) % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                home = (keys[:, 1] % U64(buckets)).astype(np.int64)
                home_order = np.argsort(home, kind="stable")
                cut, home_cut = np.searchsorted(bucket[order], np.arange(buckets + 1)), np.searchsorted(home[home_order], np.arange(buckets + 1))
                for k in np.flatnonzero((np.diff(cut) > 0) | (np.diff(home_cut) > 0)):
                    o, d = order[cut[k] : cut[k + 1]], home_order[home_cut[k] : home_cut[k + 1]]
                    bucket_out.append(int(k))
                    sigs = b"".join(sig[sig_at[i] : sig_at[i] + sig_bytes[i]].tobytes() for i in d)
                    pay_out.append(_pack(t[o], size[r[o]], place[o], keys[r[o]], ids[a + d], null[a + d], size[d], keys[d], sig_bytes[d], sigs))
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket_out, pa.int32()), "payload": pa.array(pay_out, pa.binary())})

    return lean(run)


_JUDGE = "kind string, a binary, b binary, doc_id long, n long, token long, place long"


def _judge(percent: int, paired: int):
    """Of one bucket: document rows, each class's signatures, pairs of classes that sizes and places allow, and the members of
    postings that are too long for pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[] for _ in range(10)]
        for batch in batches:
            for p in batch.column("payload"):
                for into, x in zip(parts, _unpack(p.as_buffer().to_pybytes())):
                    into.append(x)
        if not parts[0]:
            return
        token, size, place, key, ids, null, n, doc_key, sig_bytes, sigs = (np.concatenate(p) for p in parts)
        del parts
        for at in range(0, len(ids), 50_000):
            s = slice(at, at + 50_000)
            yield _rows("doc", a=doc_key[s], doc_id=pa.array(ids[s], pa.int64(), mask=null[s].astype(bool)), n=n[s].astype(np.int64))
        yield from _signed(doc_key, n.astype(np.int64), sig_bytes.astype(np.int64), sigs)
        del ids, null, n, doc_key, sig_bytes, sigs
        order = np.lexsort((key[:, 1], key[:, 0], size, token))
        token, size, place, key = token[order], size[order].astype(np.int64), place[order].astype(np.int64), key[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1]).any(1)
        token, size, place, key = token[new], size[new], place[new], key[new]
        start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
        length = np.diff(np.append(start, len(token)))
        many = np.flatnonzero(np.repeat(length > paired, length))
        for at in range(0, len(many), 50_000):
            i = many[at : at + 50_000]
            yield _rows("many", a=key[i], token=token[i].view(np.int64), n=size[i], place=place[i])
        few = np.repeat((length > 1) & (length <= paired), length)
        token, size, place, key = token[few], size[few], place[few], key[few]
        i = np.arange(len(token) - 1)
        for step in range(1, paired):
            i = i[i < len(token) - step]
            i = i[(token[i] == token[i + step]) & (size[i] * 100 >= percent * size[i + step])]  # by size, so none after the first that is too large
            if not len(i):
                break
            j = i + step
            may = np.minimum(size[i] - place[i], size[j] - place[j]) >= _needed(size[i], size[j], percent)
            x, y = key[i[may]], key[j[may]]
            swap = (x[:, 0] > y[:, 0]) | (x[:, 0] == y[:, 0]) & (x[:, 1] > y[:, 1])
            x, y = np.where(swap[:, None], y, x), np.where(swap[:, None], x, y)
            pairs = np.unique(np.concatenate((x, y), 1), axis=0)
            for at in range(0, len(pairs), 50_000):
                yield _rows("pair", a=pairs[at : at + 50_000, :2], b=pairs[at : at + 50_000, 2:])

    return lean(run)


def _signed(key: np.ndarray, n: np.ndarray, nbytes: np.ndarray, sigs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A short signature of each class, and a long one where the set has more n-grams than that has bits."""
    start = np.cumsum(nbytes) - nbytes
    has = np.flatnonzero(nbytes)
    _, once = np.unique(key[has], axis=0, return_index=True)
    has = has[once]
    for wide in np.unique(nbytes[has]):
        some = has[nbytes[has] == wide]
        step = max(1, (8 << 20) // int(wide))
        for at in range(0, len(some), step):
            i = some[at : at + step]
            sig = sigs[start[i][:, None] + np.arange(wide)]
            yield _rows("small", a=key[i], b=folded(sig, SMALL // 8), n=n[i])
            if wide > SMALL // 8:
                yield _rows("full", a=key[i], b=sig, n=n[i])


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a binary column, and where each value begins and its length."""
    raw, off = texts(pa.RecordBatch.from_arrays([column], ["x"]), "x")
    return raw, off[:-1], np.diff(off)


def _sift(percent: int):
    """Pairs whose signatures allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = (np.asarray(batch.column(c)).astype(np.int64) for c in ("m", "n"))
            (xr, xo, xl), (yr, yo, yl) = _matrix(batch.column("x")), _matrix(batch.column("y"))
            good = np.zeros(len(m), bool)
            for u, v in np.unique(np.stack((xl, yl), 1), axis=0):
                every, wide = np.flatnonzero((xl == u) & (yl == v)), min(u, v)
                for at in range(0, len(every), step := max(1, (8 << 20) // int(max(u, v)))):
                    i = every[at : at + step]
                    diff = apart(folded(xr[xo[i][:, None] + np.arange(u)], wide), folded(yr[yo[i][:, None] + np.arange(v)], wide))
                    good[i] = diff <= m[i] + n[i] - 2 * _needed(m[i], n[i], percent)
            if good.any():
                yield batch.select(["a", "b", "m", "n"]).filter(pa.array(good))

    return lean(run)


def searched(size: np.ndarray, place: np.ndarray, sig: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the members of one posting, by ascending size: ties along a search that goes from member to member by what may link.
    Members that are tied already are not compared again, so a group of near copies costs little more than its members."""
    nbytes = np.array([len(s) for s in sig])
    level = {int(w): _level_of(sig, nbytes, int(w)) for w in np.unique(nbytes)}
    left, frm, to = np.arange(len(size)), [], []
    while len(left) > 1:
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            i = front.pop()
            low = np.searchsorted(size[left], -(-percent * size[i] // 100))
            high = np.searchsorted(size[left], size[i] * 100 // percent, side="right")
            near = left[low:high]
            need = _needed(size[i], size[near], percent)
            near_ok = np.minimum(size[i] - place[i], size[near] - place[near]) >= need
            for w, (row, rows) in level.items():
                k = np.flatnonzero(near_ok & (np.minimum(nbytes[near], nbytes[i]) == w))
                if len(k):
                    diff = apart(rows[row[near[k]]], rows[row[i]])
                    near_ok[k] = diff <= size[i] + size[near[k]] - 2 * need[k]
            found = near[near_ok]
            if len(found):
                frm.append(np.full(len(found), i))
                to.append(found)
                front += found.tolist()
                left = np.concatenate((left[:low], near[~near_ok], left[high:]))
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(frm or empty), np.concatenate(to or empty)


def _level_of(sig: list[np.ndarray], nbytes: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of members that have w bytes or more, shortened to w, and each member's row among them."""
    some = np.flatnonzero(nbytes >= w)
    return np.cumsum(nbytes >= w) - 1, np.stack([folded(sig[i][None], w)[0] for i in some])


def _tie(percent: int):
    """Of rows sorted by token: ties between the members of each long posting."""

    def solve(key: list, size: list, place: list, sig: list) -> pa.RecordBatch:
        size, place = np.array(size, np.int64), np.array(place, np.int64)
        order = sorted(range(len(key)), key=lambda i: (size[i], key[i]))
        i, j = searched(size[order], place[order], [sig[k] for k in order], percent)
        return pa.RecordBatch.from_arrays([pa.array([key[order[k]] for k in x], pa.binary()) for x in (i, j)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, got = None, [[], [], [], []]
        for batch in batches:
            for t, k, n, p, s in zip(*(batch.column(c).to_pylist() for c in ("token", "node", "n", "place", "sig"))):
                if t != now:
                    if len(got[0]) > 1:
                        yield solve(*got)
                    now, got = t, [[], [], [], []]
                for into, x in zip(got, (k, n, p, np.frombuffer(s, np.uint8))):
                    into.append(x)
        if len(got[0]) > 1:
            yield solve(*got)

    return lean(run)


def _rows(kind: str, a, b=None, **more) -> pa.RecordBatch:
    n = len(a)
    binary = lambda x: pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.nbytes // max(n, 1)), n, [None, pa.py_buffer(np.ascontiguousarray(x).tobytes())]).cast(pa.binary()) if x is not None else pa.nulls(n, pa.binary())
    col = lambda c, t: more[c] if isinstance(more.get(c), pa.Array) else pa.array(more[c], t) if c in more else pa.nulls(n, t)
    return pa.RecordBatch.from_pydict({"kind": pa.array([kind] * n, pa.string()), "a": binary(a), "b": binary(b), "doc_id": col("doc_id", pa.int64()), "n": col("n", pa.int64()), "token": col("token", pa.int64()), "place": col("place", pa.int64())})


# ---- 3: products inside blocks --------------------------------------------------------------------------------------


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Exact overlap counts of all pairs of sets: the product of the incidence matrix with its transpose."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    col = np.unique(np.concatenate(sets), return_inverse=True)[1] if m else np.zeros(0, np.int64)
    row = np.repeat(np.arange(m), size)
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    start = np.flatnonzero(np.concatenate(([True], col[1:] != col[:-1]))) if len(col) else np.zeros(0, np.int64)
    df = np.diff(np.concatenate((start, [len(col)])))
    out = np.zeros((m, m), np.float32)
    flat = out.reshape(-1)
    for c in range(2, DENSE + 1):
        at = start[df == c]
        i, j = np.triu_indices(c, 1)
        step = max(1, 1_000_000 // len(i))
        for k in range(0, len(at), step):
            rows = row[at[k : k + step, None] + np.arange(c)]
            cell, n = np.unique(rows[:, i].astype(np.int64) * m + rows[:, j], return_counts=True)
            flat[cell] += n
    out += out.T
    wide = np.flatnonzero(df > DENSE)
    for k in range(0, len(wide), 2048):
        some = wide[k : k + 2048]
        dense = np.zeros((m, len(some)), np.float32)
        count = df[some]
        place = np.repeat(start[some] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        dense[row[place], np.repeat(np.arange(len(some)), count)] = 1
        out += dense @ dense.T
    np.fill_diagonal(out, 0)
    return out


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs reach the similarity, by integer arithmetic on overlap counts."""
    size = np.array([len(s) for s in sets], np.int64)
    both = overlaps(sets).astype(np.int64)
    return (100 * both >= percent * (size[:, None] + size[None, :] - both)) & (both > 0)


def grouped(links: np.ndarray) -> np.ndarray:
    """For each row the least row of its component."""
    m = len(links)
    out = np.full(m, -1)
    for i in range(m):
        if out[i] < 0:
            out[i] = i
            front = np.array([i])
            while len(front):
                near = links[front].any(0) & (out < 0)
                front = np.flatnonzero(near)
                out[front] = i
    return out


def _block(n: int, percent: int):
    """Over rows sorted by block: a row for each class with its tile's component and its number of links there."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[1])
        tiles = np.array([r[2] for r in rows])
        keys = [r[1] for r in rows]
        links = linked([r[3] for r in rows], percent)
        if rows[0][0][1] != rows[0][0][2]:  # pairs inside a tile belong to that tile's own task, though the other one be empty
            links &= tiles[:, None] != tiles[None, :]
        root, degree = grouped(links), links.sum(1)
        out = [i for i in range(len(rows)) if degree[i]]
        return pa.RecordBatch.from_pydict({"node": pa.array([keys[i] for i in out], pa.binary()), "root": pa.array([keys[root[i]] for i in out], pa.binary()), "links": pa.array([int(degree[i]) for i in out], pa.int64()), "tiled": pa.array([rows[0][4]] * len(out), pa.bool_())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            blocks = list(zip(batch.column("block").to_pylist(), batch.column("i").to_pylist(), batch.column("j").to_pylist()))
            keys, tile, tiled = batch.column("node").to_pylist(), batch.column("tile").to_pylist(), batch.column("tiled").to_pylist()
            data, off = texts(batch)
            for a, b in row_slices(off):
                h, row, _ = shingle_sets(data, off[a : b + 1], n)
                edge = np.searchsorted(row, np.arange(b - a + 1))
                own = class_keys(h, row, b - a)
                for k in range(a, b):
                    if own[k - a].tobytes() != keys[k] or rows and rows[-1][:2] == (blocks[k], keys[k]):
                        continue  # a repeated doc_id: another text, or the same one again
                    if blocks[k] != now:
                        if len(rows) > 1:
                            yield solve(rows)
                        now, rows = blocks[k], []
                    rows.append((blocks[k], keys[k], tile[k], h[edge[k - a] : edge[k - a + 1]].copy(), tiled[k]))
        if len(rows) > 1:
            yield solve(rows)

    return lean(run)


def _edges(got: DataFrame, percent: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """A stored table, and from it (a, b) of classes that may link: all such pairs of short postings, and ties of long ones."""
    small = got.where("kind = 'small'").select(F.col("a").alias("node"), F.col("n").alias("size"), F.col("b").alias("sig"))
    full = got.where("kind = 'full'").select(F.col("a").alias("node"), F.col("b").alias("long"))
    pairs = got.where("kind = 'pair'").select("a", "b").distinct()
    kept = "a binary, b binary, m long, n long"
    both = pairs.join(small.toDF("a", "m", "x"), "a").join(small.toDF("b", "n", "y"), "b")
    short = stored(both.mapInArrow(_sift(percent), kept), "ngram-pairs")
    # where one of two sets has more n-grams than the short signature has bits, the long ones decide
    wide = short.where(F.greatest("m", "n") > SMALL)
    for end, sig in (("a", "x"), ("b", "y")):
        whole = small.toDF(end, "_size", "_sig").join(full.toDF(end, "_long"), end, "left").select(end, F.coalesce("_long", "_sig").alias(sig))
        wide = wide.join(whole, end)
    wide = wide.mapInArrow(_sift(percent), kept)
    many = got.where("kind = 'many'").select("token", F.col("a").alias("node"), "n", "place")
    many = many.join(small.drop("size"), "node").join(full, "node", "left").select("token", "node", "n", "place", F.coalesce("long", "sig").alias("sig"))
    tied = many.repartition(buckets, "token").sortWithinPartitions("token").mapInArrow(_tie(percent), "a binary, b binary")
    return short, short.where(F.greatest("m", "n") <= SMALL).select("a", "b").unionByName(wide.select("a", "b")).unionByName(tied)


def join(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, n_links."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = width(spark)
    levels = spark.sparkContext.broadcast(word_levels(docs))
    posted = docs.mapInArrow(_post(n, percent, buckets, levels), "bucket int, payload binary").repartition(buckets, "bucket")
    got = stored(posted.mapInArrow(_judge(percent, PAIRED), _JUDGE), "ngram-postings")
    levels.unpersist()
    del posted
    cleaned(spark)
    rows = got.where("kind = 'doc'").select("doc_id", "n", F.col("a").alias("node"))
    classes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"))
    short, edges = _edges(got, percent, buckets)
    edges = stored(edges, "ngram-edges")
    discard(short)
    cleaned(spark)
    blocks = stored(components(edges), "ngram-blocks")
    discard(edges)
    cleaned(spark)

    sizes = blocks.groupBy("root").agg(F.count("*").alias("members"))
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    placed = blocks.join(sizes, "root").withColumn("tiles", F.when(F.col("members") <= TILE, F.lit(1)).otherwise(tiles * 2))
    placed = placed.join(classes, "node").where("rep IS NOT NULL")
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.select("rep", "node", "root", "tile", (F.col("tiles") > 1).alias("tiled"), F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
    task = placed.join(docs, F.col("rep") == F.col("doc_id")).select(F.col("root").alias("block"), "i", "j", "node", "tile", "tiled", "text")
    task = task.repartition(buckets, "block", "i", "j").sortWithinPartitions("block", "i", "j", "node")
    solved = stored(task.mapInArrow(_block(n, percent), "node binary, root binary, links long, tiled boolean"), "ngram-links")
    del task, placed
    cleaned(spark)  # the texts that were sent to the blocks, before a caller sends the documents again

    whole = solved.where("NOT tiled").select("node", "root")
    if not solved.where("tiled").isEmpty():
        whole = whole.unionByName(components(solved.where("tiled").select(F.col("node").alias("a"), F.col("root").alias("b"))))
    degree = solved.groupBy("node").agg(F.sum("links").alias("n_links"))
    member = whole.join(classes, "node")
    lowest = member.groupBy("root").agg(F.min("rep").alias("low"))
    component = whole.join(lowest, "root").select("node", "low").join(degree, "node")
    named = classes.join(component, "node", "left").select("node", F.coalesce("low", "rep").alias("low"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.join(named, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"), F.when(F.col("n") > 0, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"))
