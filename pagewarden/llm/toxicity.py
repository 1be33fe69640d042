"""Toxicity scores: a weighted lexicon matched by Aho-Corasick on folded text, with exception phrases.

Folding lower-cases, replaces homoglyphs (Cyrillic, Greek, full-width letters) and digit or sign substitutions by the Latin
letters they stand for, drops zero-width characters, and makes every other ASCII sign a space. The lexicon holds whole
words and word stems with their weights (smoothed log odds), learned from at most ``LABELS`` labelled rows. A term counts
only when it was seen in several contexts, so that words of one copied document do not enter. Exception phrases are pairs of
words around a term that occur in clean labelled documents only; a term inside one does not count. All terms and phrases that
pass these rules are kept; what is learned is bounded by the labelled rows alone.

The sum of the weights of all hits of a whole text, against the text's length in words, gives the score through a logistic
curve fitted on the same labelled rows. Null and empty texts have no hits and get the curve's lowest value. Repeated rows
are scored alike, each for itself; null ids are scored too (they are never in the labelled sample). Extra columns of the
input pass through; columns named as an output column are replaced. Without usable labels a seed lexicon of ten English
words and a fixed curve are used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import lean

#: At most so many labelled rows are learned from (those with the smallest hash of their id).
LABELS = 20_000
STEMS = (4, 5, 6)

# Letters that look like Latin ones, digits and signs that stand for letters.
HOMOGLYPHS = dict(zip("авекмнорстухіјѕԁһ", "abekmhopctyxijsdh")) | dict(zip("αβεικνορτυχ", "abeiknoptux"))
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
SEED_WORDS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
ZERO_WIDTH = "­​‌‍⁠﻿"


def _byte_table() -> bytes:
    out = list(range(256))
    for b in range(128):
        c = chr(b)
        out[b] = ord(SUBSTITUTES.get(c, c.lower() if c.isalnum() else " "))
    return bytes(out)


_TABLE = _byte_table()
_RARE = {ord(k): v for k, v in HOMOGLYPHS.items()} | {ord(c): None for c in ZERO_WIDTH} | {0xFF01 + i: chr(0x21 + i).lower() for i in range(94)} | {0xA0: " ", 0x2019: " ", 0x2013: " ", 0x2014: " "}
_LEADS = tuple(sorted({chr(k).encode()[:1] for k in _RARE if k > 127} - {b"\xc2"})) + (b"\xc2\xa0", b"\xc2\xad")


def fold(text: str) -> str:
    """The folded text, padded with a space on both sides."""
    low = text.lower()
    data = low.encode("utf-8", "replace")
    if len(data) != len(low) and any(lead in data for lead in _LEADS):
        data = low.translate(_RARE).encode("utf-8", "replace")
    return " " + data.translate(_TABLE).decode() + " "


def _terms(words: list[str]) -> Iterator[tuple[str, int]]:
    """Terms of a folded text with their words' places: ' word ' and, of longer words, ' stem'."""
    for i, w in enumerate(words):
        yield f" {w} ", i
        for n in STEMS:
            if len(w) > n:
                yield f" {w[:n]}", i


def held_out(id_col: Column, mod: int, rest: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % mod == rest, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, most: int = LABELS) -> DataFrame:
    """Labelled rows to learn from, with ``toxic``: never held-out ones, at most ``most`` ids; a fixed bound, so broadcast."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"), 5, 0))
    own = own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumnRenamed("doc_id", "_label_id")
    return docs.join(F.broadcast(own), F.col("doc_id") == F.col("_label_id")).select("doc_id", F.col("text").cast("string").alias("text"), F.col("_toxic").alias("toxic"))


@lean
def _count_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of toxic rows: for each term the documents with it and up to eight different neighbourhoods."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):  # few texts at a time: each new term takes some hundred bytes
            docs: dict[str, int] = {}
            seen: dict[str, set[str]] = {}
            for text in batch.column("text").slice(at, 200).to_pylist():
                words = fold(text or "").split()
                for term in {t for t, _ in _terms(words)}:
                    docs[term] = docs.get(term, 0) + 1
                for term, i in _terms(words):
                    around = seen.setdefault(term, set())
                    if len(around) < 8:
                        around.add(f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}")
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(docs), pa.string()), "pos": pa.array(list(docs.values()), pa.int64()), "around": pa.array([sorted(seen[t]) for t in docs], pa.list_(pa.string()))})


def _count_clean(terms: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs: dict[str, int] = {}
            for text in batch.column("text").to_pylist():
                for term in {t for t, _ in _terms(fold(text or "").split()) if t in terms}:
                    docs[term] = docs.get(term, 0) + 1
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(docs), pa.string()), "neg": pa.array(list(docs.values()), pa.int64())})

    return lean(run)


def _count_phrases(lexicon: dict[str, float]):
    """(phrase, toxic documents, clean documents): a lexicon word with the word before or after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = fold(text or "").split()
                near = {f" {' '.join(words[a : a + 2])} " for t, i in _terms(words) if t in lexicon for a in (i - 1, i) if 0 <= a < len(words) - 1}
                for p in near:
                    found.setdefault(p, [0, 0])[0 if toxic else 1] += 1
            yield pa.RecordBatch.from_pydict({"phrase": pa.array(list(found), pa.string()), "pos": pa.array([x[0] for x in found.values()], pa.int64()), "neg": pa.array([x[1] for x in found.values()], pa.int64())})

    return lean(run)


class Model:
    """Lexicon, exception phrases and curve; plain data, so it travels to the executors with the function. The automaton is
    built where it is first used, once for each copy of the model, and goes with it."""

    def __init__(self, lexicon: dict[str, float], phrases: tuple[str, ...], curve: tuple[float, float, float]):
        self.lexicon, self.phrases, self.curve = lexicon, phrases, curve
        self._automaton: ahocorasick.Automaton | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            out = ahocorasick.Automaton()
            for term, weight in self.lexicon.items():
                out.add_word(term, (0, weight, len(term)))
            for phrase in self.phrases:
                if phrase not in self.lexicon:
                    out.add_word(phrase, (1, 0.0, len(phrase)))
            out.make_automaton()
            self._automaton = out
        return self._automaton

    def evidence(self, text: str | None) -> tuple[float, int]:
        """Sum of the weights of the hits, and the number of words."""
        folded = fold(text or "")
        words = len(folded.split())
        hits, spared = [], []
        for end, (kind, value, n) in self.automaton.iter(folded):
            (hits if kind == 0 else spared).append((end - n + 1, end, value))
        total, last = 0.0, (-1, 0.0)
        for start, end, value in sorted(hits):
            if spared and any(a <= start and end <= b for a, b, _ in spared):
                continue
            if start == last[0]:  # of a word's stems and itself the heaviest counts
                total -= min(value, last[1])
                value_now = max(value, last[1])
                total += value
                last = (start, value_now)
            else:
                total += value
                last = (start, value)
        return total, words

    def score(self, evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        z = a * np.log1p(evidence) - b * np.log1p(words) + c
        z = np.where(evidence > 0, z, np.minimum(z, -4.0))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, most: int = LABELS, least_odds: float = 3.0) -> Model:
    """Learns lexicon, exceptions and curve. What reaches the driver is bounded by the labelled rows, ``most`` of them."""
    seed = {f" {w} ": 3.0 for w in SEED_WORDS}
    rows = sample(docs, labels, most).persist()
    try:
        n_pos, n_all = rows.agg(F.sum("toxic"), F.count("*")).first()
        if not n_pos or n_pos == n_all:
            return Model(seed, (), (2.0, 0.5, 0.0))
        n_neg = n_all - n_pos
        schema = "term string, pos long, around array<string>"
        pos = rows.where("toxic = 1").select("text").mapInArrow(_count_toxic, schema).groupBy("term").agg(F.sum("pos").alias("pos"), F.size(F.array_distinct(F.flatten(F.collect_list("around")))).alias("around"))
        least = max(3, round(0.002 * n_pos))
        got = {r.term: r.pos for r in pos.where((F.col("pos") >= least) & (F.col("around") >= 4)).collect()}
        neg = {r.term: r.neg for r in rows.where("toxic = 0").select("text").mapInArrow(_count_clean(frozenset(got)), "term string, neg long").groupBy("term").agg(F.sum("neg").alias("neg")).collect()}
        odds = {t: math.log((p + 0.5) / (n_pos + 1)) - math.log((neg.get(t, 0) + 0.5) / (n_neg + 1)) for t, p in got.items()}
        lexicon = {t: round(x, 6) for t, x in odds.items() if x >= least_odds}
        lexicon = {t: x for t, x in lexicon.items() if not (t.endswith(" ") and any(t[: n + 1] in lexicon for n in STEMS))} or seed
        near = rows.mapInArrow(_count_phrases(lexicon), "phrase string, pos long, neg long").groupBy("phrase").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        phrases = tuple(sorted(r.phrase for r in near.where((F.col("neg") >= 3) & (F.col("pos") * 10 <= F.col("neg"))).collect()))
        model = Model(lexicon, phrases, (2.0, 0.5, 0.0))
        seen = rows.select("text", "toxic").mapInArrow(_evidence(model), "evidence double, words long, toxic int").toPandas()
        return Model(lexicon, phrases, _curve(seen["evidence"].to_numpy(), seen["words"].to_numpy(), seen["toxic"].to_numpy()))
    finally:
        rows.unpersist()


def _evidence(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.evidence(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"evidence": pa.array([e for e, _ in found], pa.float64()), "words": pa.array([w for _, w in found], pa.int64()), "toxic": batch.column("toxic").cast(pa.int32())})

    return lean(run)


def _curve(evidence: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on log evidence and log length by Newton's method with a ridge; length never adds to a score."""
    some = evidence > 0
    if some.sum() < 20 or toxic[some].min() == toxic[some].max():
        return 2.0, 0.5, 0.0 if not some.any() or toxic[some].mean() >= 0.5 else -4.0
    x = np.stack([np.log1p(evidence), -np.log1p(words), np.ones(len(words))], 1)
    w, ridge = np.zeros(3), np.diag([0.05, 0.05, 0.01])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (toxic - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    a, b, c = w
    return max(float(a), 0.1), max(float(b), 0.0), float(c)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with tox_score (0 to 1), tox_evidence and tox_words; no row moves, and only texts go to Python."""
    own = ["tox_score", "tox_evidence", "tox_words"]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [model.evidence(t.as_py()) for t in batch]
            e, w = np.array([x for x, _ in found], np.float64), np.array([n for _, n in found], np.int64)
            yield pa.StructArray.from_arrays([pa.array(model.score(e, w)), pa.array(e), pa.array(w)], own)

    scored = F.arrow_udf(lean(run), "tox_score double, tox_evidence double, tox_words long", F.ArrowUDFType.SCALAR_ITER)
    names = [c for c in docs.columns if c.lower() not in own]
    out = docs.select(*[F.col(f"`{c}`") for c in names], scored(F.col(text_col).cast("string")).alias("_tox"))
    return out.select(*[F.col(f"`{c}`") for c in names], *[F.col(f"_tox.{c}") for c in own])
