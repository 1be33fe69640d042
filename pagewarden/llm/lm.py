"""Language-model scores: a causal self-attention model over subword ids, trained and run in numpy.

Text is scored as its lower-cased (A-Z) words, each encoded with a space before it, then one end id. The model's
probability of a text is the product over its words (and the end) of

    P(first id of the word | ids before)  *  ((max(c - D, 0) + D * T * S) / C)

where S, the probability of spelling the rest of the word and then ending it, and the first factor come from attention, c
is the word's exact count over all training documents, C and T count all and all distinct training words that begin with
its first id, and D = n1 / (n1 + 2 n2), from the words seen once and twice: absolute discounting towards the spelling.

Attention is over the ids themselves: an id's input vector is its class's and one of its own, and the hidden state after it
predicts every id of the vocabulary, in three steps that each sum to one. Ids belong to classes: the most frequent have one
each, the others share classes by frequency and by whether they begin a word; a shared class has finer ones, and the ids of a
finer class are the leaves of a binary tree. The hidden state adds, by output vectors, to the logits of the class, of the
finer class in it and of each decision in the tree. What counts over all training documents say is where the logits start:
the class's smoothed frequency after the class before, the finer class's in its class after the finer class before, and the
smoothed share of ids that go left.

Windows of ``LENGTH`` ids overlap: each scores ``STRIDE`` ids and repeats the ``LENGTH - STRIDE`` before them as context
(none before a text's first id), so every id is scored once. Positions enter as a bias for each distance.

Training is data-parallel: in each of ``ROUNDS`` rounds every partition takes its own share of its windows, each window in
exactly one round, and the mean of the partitions' weights goes on: of the vectors of ids and decisions, which only windows
with them move, the mean of the changes. What reaches the driver is of fixed size.

Words travel once, in columns: each batch of texts sends its words by hash bucket, with their spelling's logarithm in single
precision (sums of probabilities are taken between logarithms, so no word is too long); a bucket counts, and sends back sums
for each document, also of the base score (smoothed unigrams of the words).

Every row of the input is scored for itself, repeated rows too; null texts are empty (the end id only); a null doc_id is
never held out; extra columns are ignored. With no training rows counts are zero and shares uniform. An empty table gives
an empty result.
"""

from __future__ import annotations

import contextlib
import ctypes
import glob
import math
import os
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BASES, SLICE, U64, _powers, fanned, lean, mix, row_slices, stored, texts, width
from .subwords import BLANKS, begins_with_space, default_path, plain_ids

CLASSES, OWN, FINER, DIM = 24, 8, 61, 12
LENGTH, STRIDE, BATCH = 24, 20, 300
ROUNDS, RATE, ROW_RATE = 2, 0.01, 0.03
END = 50256
#: Windows that are scored at once.
SCORED = 600
_COUNT_SLICE = 1 << 15
#: How far an output vector's parts go from zero: hidden states are within 1, so logits are within 60, and exp() is safe.
FAR = 60 / DIM


# ---- one pass over the texts: ids -------------------------------------------------------------------------------------

_PASS = "block long, idx int, doc_id long, held_out boolean, n_words long, payload binary"


_ODD = tuple(c for c in BLANKS if not (c.isascii() and c.encode().isspace()))


def word_ids(text: bytes, ids, starts: np.ndarray) -> tuple[np.ndarray, int]:
    """The ids of a UTF-8 text's lower-cased words, every one with a space before it, and how many words there are.

    The whole text is encoded at once; where it has white space that does not part words, each word by itself."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint16), 0
    whole = (b" " + b" ".join(words)).decode("utf-8", "replace")
    out = np.frombuffer(array("H", ids(whole)), np.uint16)
    if np.count_nonzero(starts[out]) != len(words) or not whole.isascii() and any(c in whole for c in _ODD):
        out = np.array([i for w in words for i in ids(" " + w.decode("utf-8", "replace"))], np.uint16)
    return out, len(words)


def _read_texts(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, starts, pack = plain_ids(tokenizer), begins_with_space(tokenizer), zstandard.ZstdCompressor(level=1)
        block = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        for batch in batches:
            data, off = texts(batch)
            for a, b in row_slices(off, 4 * SLICE):
                rows = b - a
                payload, n_words = [], []
                for i in range(a, b):
                    ids, n = word_ids(data[off[i] : off[i + 1]].tobytes(), encode, starts)
                    payload.append(pack.compress(ids.tobytes()))
                    n_words.append(n)
                yield pa.RecordBatch.from_pydict({"block": np.full(rows, block), "idx": np.arange(rows, dtype=np.int32), "doc_id": batch.column("doc_id").slice(a, rows), "held_out": batch.column("held_out").slice(a, rows), "n_words": pa.array(n_words, pa.int64()), "payload": pa.array(payload, pa.binary())})
                block += 1

    return lean(run)


# ---- words, as runs of ids that begin at a starter -------------------------------------------------------------------


@lru_cache(1)
def _mixed_ids() -> np.ndarray:
    return mix(np.arange(1 << 16, dtype=U64) + U64(1))


def _word_keys(y: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs y[begin:end]."""
    up, down = _powers(BASES[1], 1 << max(20, int(len(y)).bit_length()))
    sums = np.zeros(len(y) + 1, U64)
    np.cumsum(_mixed_ids().take(y) * up[: len(y)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(U64))


def _columns(*columns: np.ndarray) -> bytes:
    return b"".join(struct.pack("<cI", c.dtype.char.encode(), len(c)) + c.tobytes() for c in columns)


def _split(p: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(p):
        kind, n = struct.unpack_from("<cI", p, at)
        out.append(np.frombuffer(p, kind.decode(), n, at + 5))
        at += 5 + out[-1].nbytes
    return out


def _packed(counts: np.ndarray) -> bytes:
    return zstandard.compress(counts.astype(np.int64).tobytes(), 1)


def _unpacked(p: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(p), np.int64)


def _least(x: np.ndarray) -> np.ndarray:
    """x in the smallest unsigned type that holds it."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def _dealt(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) over ascending keys."""
    cut = np.searchsorted(keys, (np.arange(1, buckets) * ((1 << 64) // buckets)).astype(U64))
    return [(k, x, y) for k, (x, y) in enumerate(zip([0, *cut.tolist()], [*cut.tolist(), len(keys)])) if y > x]


def _send_words(starts: np.ndarray, buckets: int):
    """Distinct words of each batch of training documents with their counts, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_heap()
        for batch in batches:
            ids = _ids(batch)
            for a, b in _groups(ids, 1_000_000):
                y = np.concatenate(ids[a:b]).astype(np.int64)
                at = np.flatnonzero(starts[y])
                begin = at[y[at] != END]
                end = at[np.flatnonzero(y[at] != END) + 1]
                keys = _word_keys(y, begin, end)
                order = np.argsort(keys)
                keys = keys[order]
                first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
                count, lead = np.diff(first, append=len(keys)), y[begin[order[first]]].astype(np.uint16)
                keys = keys[first]
                parts = _dealt(keys, buckets)
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([k for k, _, _ in parts], pa.int32()), "payload": pa.array([_columns(keys[x:z], lead[x:z], _least(count[x:z])) for _, x, z in parts], pa.binary())})

    return lean(run)


def _word_totals(size: int):
    """Of a task's buckets: tokens, distinct words, words seen once and twice, and distinct words by first id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_split(p) for batch in batches for p in batch.column("payload").to_pylist()]
        if not parts:
            return
        keys, lead, count = (np.concatenate(x) for x in zip(*parts))
        del parts
        every, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        count = np.bincount(inverse, weights=count)
        total = np.concatenate(([count.sum(), len(every), (count == 1).sum(), (count == 2).sum()], np.bincount(lead[first], minlength=size))).astype(np.int64)
        at = range(0, len(total), _COUNT_SLICE)
        yield pa.RecordBatch.from_pydict({"part": pa.array([k // _COUNT_SLICE for k in at], pa.int32()), "counts": pa.array([_packed(total[k : k + _COUNT_SLICE]) for k in at], pa.binary())})

    return lean(run)


_SUMS = "block long, payload binary"


def _judge_words(known: Known):
    """All of a task's buckets: counts of training words; then for each block its documents' sums of log10(count + 1), of
    words known, and of the model's log10 probability of completing each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_heap()
        blocks, packs, out = [], [], {}
        for batch in batches:
            for b, k, p in zip(batch.column("block").to_pylist(), batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
                if k < 0:
                    yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int64()), "payload": pa.array([p], pa.binary())})
                else:
                    blocks.append(b)
                    packs.append(_split(p))
        if not packs:
            return
        keys = np.concatenate([p[0] for p in packs])
        every, inverse = np.unique(keys, return_inverse=True)
        del keys
        seen = np.concatenate([np.bincount(np.repeat(np.arange(len(p[0])), p[2]), weights=np.unpackbits(p[5])[p[3]], minlength=len(p[0])) for p in packs])
        count = np.bincount(inverse, weights=seen, minlength=len(every))
        at = 0
        for b, (word, lead, many, owner, spell, train) in zip(blocks, packs):
            c = np.repeat(count[inverse[at : at + len(word)]], many)
            at += len(word)
            complete = known.completion(c, np.repeat(lead, many), spell.astype(np.float64))
            docs = int(owner.max()) + 1
            sums = [np.bincount(owner, weights=x, minlength=docs) for x in (np.log10(c + 1), c > 0, complete)]
            if b in out:
                size = max(len(out[b][0]), docs)
                sums = [np.pad(x, (0, size - len(x))) + np.pad(y, (0, size - len(y))) for x, y in zip(out[b], sums)]
            out[b] = sums
        items = list(out.items())
        for k in range(0, len(items), 200):
            some = items[k : k + 200]
            yield pa.RecordBatch.from_pydict({"block": pa.array([b for b, _ in some], pa.int64()), "payload": pa.array([_sums(*x) for _, x in some], pa.binary())})

    return lean(run)


def _sums(logs, known, complete) -> bytes:
    i = np.flatnonzero((logs != 0) | (known != 0) | (complete != 0))
    return _columns(i.astype(np.uint32), logs[i], _least(known[i].astype(np.int64)), complete[i])


@lean
def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, idx, log_sum, n_known, score); a task gets all parts of its blocks."""
    got: dict[int, list] = {}
    for batch in batches:
        for b, p in zip(batch.column("block").to_pylist(), batch.column("payload").to_pylist()):
            got.setdefault(b, []).append(_split(p))
    for b, parts in got.items():
        i, s, k, c = (np.concatenate(x) for x in zip(*parts))
        sums, known, score = (np.bincount(i, weights=x) for x in (s, k, c))
        yield pa.RecordBatch.from_pydict({"block": np.full(len(sums), b), "idx": np.arange(len(sums), dtype=np.int32), "log_sum": sums, "n_known": known.astype(np.int64), "score": score})


class Known:
    """What all training words say: totals, and for each first id its words and its distinct words."""

    def __init__(self, totals: np.ndarray, ids: np.ndarray, size: int):
        self.n, self.v, once, twice = (int(x) for x in totals[:4]) if len(totals) else (0, 0, 0, 0)
        self.discount = once / (once + 2 * twice) if once and twice else 0.5
        self.kinds = totals[4:].astype(np.float64) if len(totals) else np.zeros(size)
        self.all = ids.astype(np.float64)

    def completion(self, count: np.ndarray, lead: np.ndarray, spell: np.ndarray) -> np.ndarray:
        """log10 of the probability of the rest of a word after its first id."""
        with np.errstate(divide="ignore"):
            by_count, kinds = np.log(np.maximum(count - self.discount, 0)), np.log(self.discount * self.kinds)[lead]
            total = np.log(self.all)[lead]
        out = np.logaddexp(by_count, kinds + spell * np.log(10)) - total
        return np.where(self.all[lead] > 0, out / np.log(10), spell)


# ---- the model -------------------------------------------------------------------------------------------------------


class Model:
    """Class and finer class of each id, log shares inside finer classes, counted bigrams, and the network's weights."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, classes: int = CLASSES, own: int = OWN, dim: int = DIM, finer: int = FINER):
        order = np.lexsort((np.arange(len(ids)), -ids))
        self.of, self.fine = np.zeros(len(ids), np.uint8), np.zeros(len(ids), np.uint16)
        self.of[order[:own]] = self.fine[order[:own]] = np.arange(min(own, len(order)))
        rest = order[own:]
        shared = (classes - own) // 2
        for k, flag in enumerate((True, False)):
            some = rest[starts[rest] == flag]
            mass = np.cumsum(ids[some] + 1.0)
            place = np.minimum(shared * finer * mass / (mass[-1] if len(mass) else 1), shared * finer - 1).astype(np.int64)
            self.of[some] = own + k * shared + place // finer
            self.fine[some] = own + k * shared * finer + place
        self.fines, self.own, self.width = own + 2 * shared * finer, own, finer
        #: The class of each finer class.
        self.up = np.concatenate((np.arange(own), own + np.arange(2 * shared * finer) // finer))
        per = np.bincount(self.fine, weights=ids + 1.0, minlength=self.fines)
        self.share = np.log((ids + 1.0) / per[self.fine]).astype(np.float32)
        self._plant(ids + 1.0)
        rng = np.random.Generator(np.random.PCG64(11))
        small = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
        self.starts = starts
        self.sides = np.ones((classes, 2), np.float32)
        self.sides[np.setdiff1d(np.arange(classes), self.of[starts]), 1] = 0
        self.set_bigram(np.zeros((self.fines, self.fines)), per)
        self.weights = {"e": small(classes, dim), "q": small(dim, dim), "k": small(dim, dim), "v": small(dim, dim), "o": small(dim, dim), "w": small(dim, dim), "b": np.zeros(dim, np.float32), "u": np.zeros((dim, classes), np.float32), "near": np.zeros(LENGTH, np.float32)}
        #: What attention adds below the classes: output vectors of finer classes; each id's own input vector, then the output
        #: vectors of decisions. All start at zero, where counts alone speak.
        self.finer = np.zeros((self.fines, dim), np.float32)
        self.rows = np.zeros((len(ids) + len(self.left), dim), np.float32)

    def _plant(self, mass: np.ndarray) -> None:
        """A binary tree over the ids of each finer class: ``depth`` of an id's class's tree, its ``leaf``, its ``tree``'s first
        node, and ``left``, each node's counted share that goes left. Node k's children are 2k and 2k + 1, the root is 1."""
        order = np.argsort(self.fine, kind="stable")
        many = np.bincount(self.fine, minlength=self.fines)
        begin = np.cumsum(many) - many
        depth = np.ceil(np.log2(np.maximum(many, 1))).astype(np.int64)
        first = np.cumsum(1 << depth) - (1 << depth)
        self.depth, self.tree = depth[self.fine].astype(np.uint8), first[self.fine].astype(np.int32)
        self.leaf = np.zeros(len(mass), np.int32)
        self.leaf[order] = np.arange(len(mass)) - begin[self.fine[order]]
        leaves = np.zeros(int((1 << depth).sum()))
        leaves[self.tree + self.leaf] = mass
        self.left = np.ones(len(leaves))
        for d in np.unique(depth[depth > 0]).tolist():
            at = first[depth == d][:, None]
            level = leaves[at + np.arange(1 << d)]
            for up in range(d - 1, -1, -1):
                pairs = level.reshape(len(at), -1, 2)
                level = pairs.sum(-1)
                self.left[at + np.arange(1 << up, 2 << up)] = np.where(level > 0, pairs[:, :, 0] / np.maximum(level, 1e-300), 1)
        # the decisions of all ids, one id's after another's
        deep = self.depth.astype(np.int64)
        self.way = np.cumsum(deep) - deep
        down = np.repeat(self.way + deep, deep) - np.arange(deep.sum())
        leaf = np.repeat(self.leaf + (1 << deep), deep)
        self.node = np.repeat(self.tree, deep) + (leaf >> down)
        right = leaf >> (down - 1) & 1
        left = self.left.take(self.node)
        self.odds = np.stack((1 - 2 * right, np.where(right, 1 - left, left), np.where(right, left, 1 - left)), 1).astype(np.float32)

    def decisions(self, y: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of ids y: those with decisions on the way to them, and where theirs begin; for every one whose y it is, its node, 1
        where it goes left and -1 where right, and the counted shares of that way and of the other."""
        depth = self.depth.take(y)
        deep = np.flatnonzero(depth)
        depth = depth.take(deep).astype(np.int64)
        begin = np.cumsum(depth) - depth
        at = np.repeat(self.way.take(y.take(deep)) - begin, depth)
        at += np.arange(len(at))
        return deep, begin, np.repeat(deep, depth), self.node.take(at), *self.odds.take(at, 0).T

    def set_bigram(self, counts: np.ndarray, one: np.ndarray | None = None) -> None:
        """From counts of finer classes after finer classes: ``bigram`` of classes, and ``inner``, the logarithm of a finer
        class's share of its class after the finer class before."""
        one = counts.sum(0) + 1.0 if one is None else one + 1.0
        classes = int(self.up.max()) + 1
        begin = np.searchsorted(self.up, np.arange(classes))  # finer classes come in the order of their classes
        pairs = np.add.reduceat(np.add.reduceat(counts, begin, 0), begin, 1)
        whole = np.add.reduceat(one, begin)
        self.bigram = ((pairs + 20 * whole / whole.sum()) / (pairs.sum(1, keepdims=True) + 20)).astype(np.float32)
        after = np.add.reduceat(counts, begin, 1)[:, self.up]
        given = ((counts + 20 * (one / whole[self.up])) / (after + 20)).astype(np.float32)
        self.inner = np.log(given)
        #: The same shares inside shared classes: a row for each finer class before and shared class.
        self.given = np.ascontiguousarray(given[:, self.own :]).reshape(-1, self.width)

    def shares(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The logarithm of the share of each id y in its class, after x."""
        cell = self.fine.take(x).astype(np.int64) * self.fines + self.fine.take(y)
        return self.inner.ravel().take(cell) + self.share.take(y)


#: Distance from key to query, in a window whose last STRIDE positions are queries, and what a query sees.
_DISTANCE = np.arange(LENGTH - STRIDE, LENGTH)[:, None] - np.arange(LENGTH)[None, :]
_SEEN = _DISTANCE >= 0
_BACK = np.maximum(_DISTANCE, 0)


def steady_heap() -> None:
    """Lets freed arrays of a step serve the next one instead of going back to the system and being zeroed again; lean()
    returns them when the task ends. Keeps small products on the task's own core: numpy's OpenBLAS has a thread for each core
    of the executor, and they wait for each other by spinning."""
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), "..", "numpy.libs", "*openblas*")):
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(path).scipy_openblas_set_num_threads64_(1)
    with contextlib.suppress(OSError, AttributeError):
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 64 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 256 << 20)  # M_TRIM_THRESHOLD


class Tables:
    """What the layer makes of each symbol: query, key, value with a one for the sum, and its part of the hidden state. Symbols
    are the rows of w["e"], classes or ids; the one after them stands before a text."""

    def __init__(self, w: dict, by_id: bool = False):
        dim = w["q"].shape[0]
        self.symbols, self.by_id = len(w["e"]), by_id
        one = w["e"].dtype.type(1)
        none = np.zeros((1, dim), w["e"].dtype)
        self.ask = (w["e"] @ w["q"]) * (one / np.sqrt(one * dim))
        self.key = np.vstack((w["e"] @ w["k"], none))
        self.near = np.where(_SEEN, np.exp(w["near"][_BACK]), 0).astype(none.dtype)
        self.value = np.zeros((self.symbols + 1, dim + 1), none.dtype)
        self.value[:-1, :-1], self.value[:-1, -1] = w["e"] @ w["v"], 1
        self.own, self.mixing = w["e"] @ w["w"] + w["b"], w["o"] @ w["w"]

    def hidden(self, x: np.ndarray):
        """Of windows of symbols x (n, LENGTH): hidden states of the queries, and what the gradient needs."""
        n, q = len(x), x[:, LENGTH - STRIDE :]
        ask, key = self.ask.take(q, 0), self.key.take(x, 0)
        a = ask @ key.transpose(0, 2, 1)
        np.clip(a, -40, 40, out=a)
        np.exp(a, out=a)
        a *= self.near
        values = self.value.take(x, 0)
        mixed = a @ values
        total = mixed[:, :, -1:]
        mixed = mixed[:, :, :-1] / total
        h = mixed.reshape(n * STRIDE, -1) @ self.mixing
        h += self.own.take(q.ravel(), 0)
        np.tanh(h, out=h)
        return h, (ask, key, a, total, values, mixed)


def layer(model: Model) -> Tables:
    """The layer over ids: an id's vector is its class's and its own."""
    of = model.up.take(model.fine)
    return Tables(model.weights | {"e": model.weights["e"].take(of, 0) + model.rows[: len(of)]}, by_id=True)


def class_logs(model: Model, x: np.ndarray, y: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of classes x before and classes y, with hidden states: natural logs of the probabilities of y and of any class that
    begins a word."""
    p = h @ model.weights["u"]
    np.exp(p, out=p)
    p *= model.bigram.take(x, 0)
    both = p @ model.sides
    picked = p.ravel().take(np.arange(len(p)) * p.shape[1] + y)
    total, tiny = both[:, 0], np.float32(1e-37)
    return np.log(np.maximum(picked, tiny) / total), np.log(np.maximum(both[:, 1], tiny) / total)


class _Finer:
    """Finer classes y after x in the order of their classes, and the finer ones' unnormalised probabilities (a row of ``p`` for
    each y in a shared class; those come last, from ``own`` on) with hidden states h, given in that order by ``order``."""

    def __init__(self, model: Model, x: np.ndarray, y: np.ndarray, h: np.ndarray, finer: np.ndarray):
        of = model.up.astype(np.uint8).take(y)
        self.order = np.argsort(of, kind="stable")
        count = np.bincount(of, minlength=int(model.up[-1]) + 1)
        self.own = own = int(count[: model.own].sum())
        stop = np.cumsum(count[model.own :]).tolist()
        self.parts = [(c, a, b) for c, (a, b) in enumerate(zip([0, *stop], stop)) if b > a]
        self.h = h.take(self.order, 0)
        shared = self.order[own:]
        x, y, of = x.take(shared), y.take(shared).astype(np.int64), of.take(shared).astype(np.int64)
        of -= model.own
        self.cell = np.arange(len(y)) * model.width
        self.cell += y - (model.own + of * model.width)
        self.tables = finer[model.own :].reshape(-1, model.width, h.shape[1])
        turned = np.ascontiguousarray(self.tables.transpose(0, 2, 1))
        self.p = np.empty((len(y), model.width), h.dtype)
        for c, a, b in self.parts:
            np.matmul(self.h[own + a : own + b], turned[c], out=self.p[a:b])
        self.picked = self.p.ravel().take(self.cell)
        np.exp(self.p, out=self.p)
        of += x.astype(np.int64) * len(turned)
        self.p *= model.given.take(of, 0)
        self.total = self.p @ np.ones(model.width, h.dtype)


def id_logs(model: Model, x: np.ndarray, y: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Natural logs of the probabilities of ids y in their classes, after ids x, with hidden states."""
    out = model.shares(x, y)
    at = _Finer(model, model.fine.take(x), model.fine.take(y), h, model.finer)
    out[at.order[at.own :]] += at.picked - np.log(at.total)
    deep, begin, who, node, sign, own, other = model.decisions(y)
    if len(deep):
        z = sign * np.einsum("ij,ij->i", h.take(who, 0), model.rows[len(model.of) :].take(node, 0))
        out[deep] -= np.add.reduceat(np.log(own + other * np.exp(-z)), begin).astype(out.dtype)
    return out


def _numbered(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers below ``size`` in x, and x by their places; what is not below comes after all."""
    there = np.zeros(size + 1, bool)
    there[x] = True
    some = np.flatnonzero(there[:size])
    place = np.empty(size + 1, np.intp)
    place[some], place[size] = np.arange(len(some)), len(some)
    return some, place.take(x)


class Step:
    """A batch of training targets as gradient() meets it: class frequencies after each symbol, and what is below classes."""

    def __init__(self, model: Model, finer: np.ndarray, rows: np.ndarray, of: np.ndarray, x: np.ndarray, y: np.ndarray, on: np.ndarray):
        self.model, self.finer, self.rows, self.x, self.y = model, finer, rows, x, y
        self.after, self.on = model.bigram.take(of, 0), np.flatnonzero(on)
        self.nodes = self.steps = None

    def take(self, symbols: np.ndarray, axis: int) -> np.ndarray:
        return self.after.take(symbols, axis)

    def below(self, h: np.ndarray, g: dict) -> np.ndarray:
        """Adds the finer classes' gradient to g, keeps the decisions', and returns that of h."""
        model, size = self.model, max(1, len(self.on))
        at = _Finer(model, model.fine.take(self.x), model.fine.take(self.y), h.take(self.on, 0), self.finer)
        y, on = self.y.take(at.order), self.on.take(at.order)
        back = np.full(len(h), len(on))
        back[on] = np.arange(len(on))
        h, p, total = at.h, at.p, at.total[:, None]
        p.reshape(-1)[at.cell] -= at.total
        scaled = h[at.own :] / total
        dh = np.zeros((len(h) + 1, h.shape[1]), h.dtype)  # ends with zeros, for where nothing is on
        below = dh[at.own : -1]
        turned = np.zeros((len(at.tables), h.shape[1], model.width), h.dtype)
        for c, a, b in at.parts:
            np.matmul(scaled[a:b].T, p[a:b], out=turned[c])
            np.matmul(p[a:b], at.tables[c], out=below[a:b])
        below /= total
        g["finer"] = np.vstack((np.zeros_like(self.finer[: model.own]), turned.transpose(0, 2, 1).reshape(-1, h.shape[1]) / size))
        deep, begin, who, node, sign, own, other = model.decisions(y)
        hidden, vector = h.take(who, 0), self.rows[len(model.of) :].take(node, 0)
        push = other * np.exp(-sign * np.einsum("ij,ij->i", hidden, vector))
        push *= -sign / (own + push)
        push = push.astype(h.dtype, copy=False)[:, None]
        self.nodes, local = _numbered(node, len(model.left))
        hidden *= push / size
        self.steps = _by_class(local, hidden, len(self.nodes))
        if len(deep):
            vector *= push
            dh[deep] += _runs(vector, begin)
        dh /= size
        return dh.take(back, 0)


def _runs(rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of the rows from each place on to the next. Two columns are added as one complex number: half as many loops."""
    if rows.shape[1] % 2:
        return np.add.reduceat(rows, begin, axis=0)
    pairs = np.ascontiguousarray(rows).view(np.result_type(rows.dtype, np.complex64))
    return np.add.reduceat(pairs, begin, axis=0).view(rows.dtype)


def _by_class(of: np.ndarray, rows: np.ndarray, classes: int) -> np.ndarray:
    """Sums of the rows of each class (or symbol)."""
    order = np.argsort(of.astype(np.uint16) if classes <= 1 << 16 else of, kind="stable")
    count = np.bincount(of, minlength=classes)
    some = np.flatnonzero(count)
    out = np.zeros((classes, rows.shape[1]), rows.dtype)
    if len(some):
        out[some] = _runs(rows.take(order, 0), np.cumsum(count[some]) - count[some])
    return out


def gradient(w: dict, bigram: np.ndarray | Step, x: np.ndarray, y: np.ndarray, on: np.ndarray) -> dict:
    """Of the mean negative log probability over queries that are on: of classes y, and of the ids in them with a Step."""
    t = Tables(w)
    classes, dim = w["u"].shape[1], w["q"].shape[0]
    q = x[:, LENGTH - STRIDE :]
    h, (ask, key, a, total, values, mixed) = t.hidden(x)
    p = h @ w["u"]
    np.exp(p, out=p)
    p *= bigram.take(q.ravel(), 0)
    share = on.ravel() / max(1, on.sum())
    p *= (share / (p @ np.ones(classes, p.dtype)))[:, None]
    p.reshape(-1)[np.arange(len(p)) * classes + y.ravel()] -= share
    g = {"u": h.T @ p}
    dh = p @ np.ascontiguousarray(w["u"].T)
    if isinstance(bigram, Step):
        dh += bigram.below(h, g)
    dh *= 1 - h * h
    d_mixing = mixed.reshape(-1, dim).T @ dh
    dm = (dh @ np.hstack((t.mixing.T, np.zeros((dim, 1), h.dtype)))).reshape(*q.shape, dim + 1)
    a /= total
    early = np.flatnonzero(x[:, 0] == t.symbols)  # windows that begin before their texts
    a[early] *= (x[early] != t.symbols)[:, None, :]
    d_value = (a.transpose(0, 2, 1) @ dm[:, :, :-1]).reshape(-1, dim)
    np.negative(np.einsum("ijk,ijk->ij", dm[:, :, :-1], mixed), out=dm[:, :, -1])  # values end with a one
    ds = dm @ values.transpose(0, 2, 1)
    ds *= a
    g["near"] = np.bincount(_BACK.ravel(), weights=(ds.sum(0) * _SEEN).ravel(), minlength=LENGTH)
    scale = 1 / np.sqrt(h.dtype.type(dim))
    d_ask = (ds @ key).reshape(-1, dim)
    d_key = (ds.transpose(0, 2, 1) @ ask).reshape(-1, dim)
    e = np.vstack((w["e"], np.zeros((1, dim), h.dtype)))
    every, asking = e.take(x.ravel(), 0), e.take(q.ravel(), 0)
    g["q"], g["k"], g["v"] = asking.T @ d_ask * scale, every.T @ d_key, every.T @ d_value
    g["w"], g["b"], g["o"] = asking.T @ dh + w["o"].T @ d_mixing, np.ones(len(dh), dh.dtype) @ dh, d_mixing @ w["w"].T
    turn = {c: np.ascontiguousarray(w[c].T) for c in "qkvw"}
    d_every, d_asking = d_key @ turn["k"], d_ask @ (turn["q"] * scale)
    d_every += d_value @ turn["v"]
    d_asking += dh @ turn["w"]
    d_every.reshape(*x.shape, dim)[:, LENGTH - STRIDE :] += d_asking.reshape(*q.shape, dim)
    g["e"] = _by_class(x.ravel(), d_every, t.symbols + 1)[:-1]
    return g


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts with so many ids: each window's text, and the first position that it scores."""
    count = -(-lengths // STRIDE)
    text = np.repeat(np.arange(len(lengths)), count)
    return text, STRIDE * (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count))


class Placed:
    """Inputs (each id's predecessor), targets and the windows over them, of several texts one after another."""

    def __init__(self, ids: list[np.ndarray]):
        self.lengths = np.array([len(x) for x in ids])
        self.y = np.concatenate(ids)
        self.begin = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.x = np.concatenate((np.array([END], self.y.dtype), self.y[:-1]))
        self.x[self.begin] = END
        self.text, self.start = windows(self.lengths)

    def batch(self, of: np.ndarray, none: int, some, by_id: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of some windows: input classes or ids (``none`` outside the text), target classes, which targets there are, their
        places."""
        t, s = self.text[some], self.start[some]
        left = np.maximum(self.begin[t], self.begin[t] + s - (LENGTH - STRIDE))
        at = (self.begin[t] + s)[:, None] + np.arange(STRIDE - LENGTH, STRIDE)
        stop = (self.begin[t] + self.lengths[t])[:, None]
        inside = (at >= left[:, None]) & (at < stop)
        at = np.clip(at, 0, len(self.x) - 1)
        x = self.x.take(at)
        x = np.where(inside, x if by_id else of.take(x), np.intp(none))
        target, on = at[:, LENGTH - STRIDE :], inside[:, LENGTH - STRIDE :]
        x[:, LENGTH - STRIDE :][~on] = 0  # past the end: a query that nothing reads
        return x, of.take(self.y.take(target)).astype(np.int64), on, target


def _ids(batch: pa.RecordBatch) -> list[np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    return [np.concatenate((np.frombuffer(unpack.decompress(p.as_buffer()), np.uint16), np.array([END], np.uint16))) for p in batch.column("payload")]


def _groups(ids: list[np.ndarray], most: int = 200_000) -> Iterator[tuple[int, int]]:
    a = n = 0
    for i, x in enumerate(ids):
        n += len(x)
        if n >= most:
            yield a, i + 1
            a, n = i + 1, 0
    if a < len(ids):
        yield a, len(ids)


def token_logs(model: Model, ids: list[np.ndarray], tables: Tables):
    """Of several texts one after another: ids y, owners, log P(id | before), and log P(a word begins | before)."""
    placed = Placed(ids)
    log, side = np.zeros(len(placed.y), np.float32), np.zeros(len(placed.y), np.float32)
    for k in range(0, len(placed.text), SCORED):
        x, y, on, target = placed.batch(model.of, tables.symbols, slice(k, k + SCORED), tables.by_id)
        on, target = np.flatnonzero(on), target[on]
        h = tables.hidden(x)[0].take(on, 0)
        x, y = placed.x.take(target), placed.y.take(target)
        log[target], side[target] = class_logs(model, model.of.take(x), model.of.take(y), h)
        log[target] += id_logs(model, x, y, h)
    return placed.y.astype(np.int64), np.repeat(np.arange(len(ids)), placed.lengths), log.astype(np.float64), side.astype(np.float64)


def _score(model: Model, buckets: int):
    """Words of each block by bucket, with their spelling's log10 probability; under bucket -1 - b what needs no counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_heap()
        tables = layer(model)
        for batch in batches:
            ids = _ids(batch)
            block, idx, held = np.asarray(batch.column("block")), np.asarray(batch.column("idx")).astype(np.int64), np.asarray(batch.column("held_out"))
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(ids)]
            for low, high in zip(cuts, cuts[1:]):
                if high == low:
                    continue
                held_words, firsts = [], []
                for a, b in _groups(ids[low:high]):
                    y, owner, log, side = token_logs(model, ids[low + a : low + b], tables)
                    own = idx[low + a : low + b][owner]
                    at = np.flatnonzero(model.starts[y])
                    firsts.append((own[at], (log - side)[at] / np.log(10)))
                    word = np.flatnonzero(y[at] != END)
                    begin, end = at[word], at[word + 1]
                    inner = np.concatenate(([0.0], np.cumsum(np.where(model.starts[y], 0, log))))
                    spell = (inner[end] - inner[begin + 1] + side[end]) / np.log(10)
                    held_words.append((_word_keys(y, begin, end), y[begin].astype(np.uint16), own[begin], spell.astype(np.float32)))
                own, value = (np.concatenate(x) for x in zip(*firsts))
                first = np.bincount(own, weights=value)
                none = np.zeros(len(first))
                where, out = [-1 - int(block[low]) % buckets], [_sums(none, none, first)]
                keys, lead, own, spell = (np.concatenate(x) for x in zip(*held_words))
                order = np.argsort(keys, kind="stable")  # documents come in order, so those of a word stay in order
                keys, lead, own, spell = keys[order], lead[order], own[order], spell[order]
                train = np.packbits(_spread(idx[low:high], ~held[low:high]))
                if len(keys):
                    new = np.concatenate(([True], keys[1:] != keys[:-1]))
                    at = np.flatnonzero(new)
                    many = np.diff(np.concatenate((at, [len(keys)])))
                    for k, x, z in _dealt(keys[at], buckets):
                        p, q = at[x], at[z] if z < len(at) else len(keys)
                        where.append(k)
                        out.append(_columns(keys[at[x:z]], lead[at[x:z]], _least(many[x:z]), _least(own[p:q]), spell[p:q], train))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(where, pa.int32()), "block": pa.array([int(block[low])] * len(where), pa.int64()), "payload": pa.array(out, pa.binary())})

    return lean(run)


def _spread(idx: np.ndarray, flags: np.ndarray) -> np.ndarray:
    out = np.zeros(int(idx.max()) + 1, bool)
    out[idx] = flags
    return out


# ---- what the model learns from all training documents ---------------------------------------------------------------


def _vectors(df: DataFrame, count) -> np.ndarray:
    """Sums a vector that count makes of each partition's ids, slice by slice on the executors."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_heap()
        total = None
        for batch in batches:
            ids = _ids(batch)
            for a, b in _groups(ids):
                part = count(ids[a:b])
                total = part if total is None else total + part
        if total is not None:
            at = range(0, len(total), _COUNT_SLICE)
            yield pa.RecordBatch.from_pydict({"part": pa.array([k // _COUNT_SLICE for k in at], pa.int32()), "counts": pa.array([_packed(total[k : k + _COUNT_SLICE]) for k in at], pa.binary())})

    return _added(df.mapInArrow(per_task, "part int, counts binary"))


def _added(parts: DataFrame) -> np.ndarray:
    """The sum of vectors that come in slices."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, p in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                part = _unpacked(p)
                sums[k] = sums[k] + part if k in sums else part
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(sums), pa.int32()), "counts": pa.array([_packed(v) for v in sums.values()], pa.binary())})

    n = width(parts.sparkSession)
    parts = fanned(parts, n, "part").mapInArrow(lean(add), "part int, counts binary")
    rows = parts.repartition(min(8, n), "part").mapInArrow(lean(add), "part int, counts binary").collect()
    return np.concatenate([_unpacked(r.counts) for r in sorted(rows, key=lambda r: r.part)]) if rows else np.zeros(0, np.int64)


def _bigrams(fine: np.ndarray, fines: int):
    def count(ids: list[np.ndarray]) -> np.ndarray:
        placed = Placed(ids)
        return np.bincount(fine.take(placed.x).astype(np.int64) * fines + fine.take(placed.y), minlength=fines * fines)

    return count


def _flat(w: dict) -> np.ndarray:
    return np.concatenate([w[c].ravel() for c in sorted(w)])


def _views(flat: np.ndarray, like: dict) -> dict:
    """The weights as parts of one vector, so that a step on it is a step on all."""
    out, at = {}, 0
    for c in sorted(like):
        out[c] = flat[at : at + like[c].size].reshape(like[c].shape)
        at += like[c].size
    return out


def _train(model: Model, turn: int):
    """Sums, by windows seen, of the weights of one pass over this turn's windows, and of the change of the rows of ids and
    decisions (most are zero, and take no room)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_heap()
        like = model.weights | {"finer": model.finer}
        flat, rows = _flat(like), model.rows.copy()
        w = _views(flat, like)
        first, second, met = np.zeros_like(flat), np.zeros_like(flat), np.full(len(rows), 1e-12, np.float32)
        of, size = model.up.take(model.fine), len(model.of)
        step = seen = 0

        def move(at: np.ndarray, g: np.ndarray) -> None:
            met[at] += np.einsum("ij,ij->i", g, g) / g.shape[1]
            rows[at] = np.clip(rows[at] - np.float32(ROW_RATE / (1 + turn)) * g / np.sqrt(met[at])[:, None], -FAR, FAR)

        for batch in batches:
            ids = _ids(batch)
            for a, b in _groups(ids, 2_000_000):
                placed = Placed(ids[a:b])
                pick = np.flatnonzero((np.arange(len(placed.text)) * 2654435761 >> 7) % ROUNDS == turn)
                for k in range(0, len(pick), BATCH):
                    x, y, on, target = placed.batch(model.of, size, pick[k : k + BATCH], by_id=True)
                    some, x = _numbered(x, size)
                    at = target[on]
                    below = Step(model, w["finer"], rows, of[some], placed.x.take(at), placed.y.take(at), on)
                    got = gradient(w | {"e": w["e"].take(of[some], 0) + rows[some]}, below, x, y, on.astype(np.float32))
                    move(some, got["e"])
                    if below.nodes is not None:
                        move(below.nodes + size, below.steps)
                    got["e"] = _by_class(of[some], got["e"], len(w["e"]))
                    g = _flat(got).astype(np.float32)
                    step, seen = step + 1, seen + len(x)
                    first += np.float32(0.1) * (g - first)
                    second += np.float32(0.01) * (g * g - second)
                    rate = RATE / (1 + turn) * math.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    flat -= np.float32(rate) * first / (np.sqrt(second) + np.float32(1e-8))
                    for v in (w["u"], w["finer"]):
                        np.clip(v, -FAR, FAR, out=v)
        if seen:
            yield _weights_batch(seen, flat * np.float32(seen), (rows - model.rows) * np.float32(seen))

    return lean(run)


def _weights_batch(n: int, flat: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    packed = zstandard.compress(np.concatenate((flat.ravel(), rows.ravel())).astype(np.float32).tobytes(), 1)
    return pa.RecordBatch.from_pydict({"part": pa.array([0], pa.int32()), "n": pa.array([n], pa.int64()), "w": pa.array([packed], pa.binary())})


def _unpacked_weights(p: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(p), np.float32)


@lean
def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for batch in batches:
        for k, p in zip(batch.column("n").to_pylist(), batch.column("w").to_pylist()):
            part = _unpacked_weights(p).astype(np.float64)
            total, n = (part if total is None else total + part), n + k
    if n:
        yield _weights_batch(n, total, np.zeros(0))


def take_mean(model: Model, parts: list[tuple[int, bytes]]) -> bool:
    """Moves the model to the mean of its parts (windows seen, packed sums); whether there are any."""
    n = sum(k for k, _ in parts)
    if n:
        mean = sum(_unpacked_weights(p).astype(np.float64) for _, p in parts) / n
        like = model.weights | {"finer": model.finer}
        cut = sum(v.size for v in like.values())
        got = _views(mean[:cut].astype(np.float32), like)
        model.finer = got.pop("finer")
        model.weights, model.rows = got, model.rows + mean[cut:].reshape(model.rows.shape).astype(np.float32)
    return n > 0


def train(rows: DataFrame, starts: np.ndarray) -> tuple[Model, np.ndarray]:
    """rows: payload, of training documents; starts: which ids begin a word. The model, and the counts of all ids."""
    spark = rows.sparkSession
    size = len(starts)
    ids = _vectors(rows, lambda x: np.bincount(np.concatenate(x), minlength=size))
    ids = ids if len(ids) else np.zeros(size, np.int64)
    model = Model(ids, starts)
    pairs = _vectors(rows, _bigrams(model.fine, model.fines))
    if len(pairs):
        model.set_bigram(pairs.reshape(model.fines, -1).astype(np.float64))
    for turn in range(ROUNDS):
        means, fan = rows.mapInArrow(_train(model, turn), "part int, n long, w binary"), 8 * width(spark)
        while fan > 4:  # a task adds some eight parts, and four of fixed size are left
            fan = max(4, fan // 8)
            means = means.repartition(fan).mapInArrow(_mean, "part int, n long, w binary")
        if not take_mean(model, [(r.n, r.w) for r in means.collect()]):
            break
    return model, ids


def score(docs: DataFrame, held_out, tokenizer: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    held_out: a boolean column of docs; those rows are scored and never learned from."""
    spark = docs.sparkSession
    tokenizer, buckets = tokenizer or default_path("byte_bpe_50k.tiktoken"), width(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    rows = stored(docs.mapInArrow(_read_texts(tokenizer), _PASS), "lm-ids")
    learn = rows.where("NOT held_out").select("payload")
    starts = begins_with_space(tokenizer)
    starts[END] = True

    totals = learn.mapInArrow(_send_words(starts, buckets), "bucket int, payload binary").repartition(buckets, "bucket").mapInArrow(_word_totals(len(starts)), "part int, counts binary")
    totals = _added(totals)
    ends = learn.count()
    model, ids = train(learn, starts)
    known = Known(totals, ids, len(starts))
    n, v = known.n + ends, known.v + (ends > 0)

    words = rows.select("block", "idx", "held_out", "payload").mapInArrow(_score(model, buckets), "bucket int, block long, payload binary").repartition(buckets, "bucket")
    judged = words.mapInArrow(_judge_words(known), _SUMS).repartition(buckets, "block").mapInArrow(_add_sums, "block long, idx int, log_sum double, n_known long, score double")
    both = rows.select("block", "idx", "doc_id", "held_out", "n_words").join(judged, ["block", "idx"], "left")
    tokens = F.col("n_words") + 1
    base = F.col("log_sum") + float(np.log10(ends + 1)) - tokens * float(np.log10(n + v + 1))
    return both.select("doc_id", "held_out", tokens.alias("n_tokens"), (F.col("n_known") + int(ends > 0)).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
