import itertools
import math
import os
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pagewarden.llm import chat, lm, packing, rollups, sstable, suffix_dedup, toxicity
from pagewarden.llm.subwords import Subwords, counter, default_path

from .cases import clashing, documents, frame, prose

DATA = "/root/testdata/sf0.01"


def test_folding():
    assert toxicity.fold("1D10T! Ｉｄｉоt").split() == ["idiot", "idiot"] and toxicity.fold("") == "  "
    assert toxicity.fold("Été") == " été "


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"), 5, 0)).select("toxic", "tox_score").toPandas()
    right = (out.tox_score >= 0.5) == (out.toxic == 1)
    assert right.mean() > 0.97 and right[out.toxic == 1].mean() > 0.85
    odd = toxicity.score(clashing(frame(spark)), model)
    assert odd.count() == len(documents()) and odd.where("tox_score IS NULL OR tox_score < 0 OR tox_score > 1").isEmpty()
    assert toxicity.score(frame(spark, []), model).isEmpty()


def test_toxicity_phrases_and_no_labels(spark):
    model = toxicity.Model({" trash ": 5.0}, (" trash can ",), (2.0, 0.5, 0.0))
    assert model.evidence("the trash can")[0] == 0 and model.evidence("TR4SH can, trash")[0] > 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert " idiot " in toxicity.fit(frame(spark), none).lexicon


def padding(ends, n, bounds):
    return sum(c * (min(b for b in bounds if b >= e) - e) for e, c in zip(ends, n))


def test_boundaries_are_optimal():
    rng = np.random.Generator(np.random.PCG64(5))
    for _ in range(40):
        ends = np.sort(rng.choice(np.arange(1, 60), rng.integers(1, 9), replace=False))
        n = rng.integers(1, 30, len(ends))
        for k in (1, 2, 3, 4, 20):
            got = packing.boundaries(ends, n, ends * n, k).tolist()
            every = [(*x, ends[-1]) for x in itertools.combinations(ends[:-1], min(k, len(ends)) - 1)]
            assert padding(ends, n, got) == min(padding(ends, n, b) for b in every) and len(got) <= k


def test_boundaries_of_long_texts_are_optimal():
    rng = np.random.Generator(np.random.PCG64(6))
    ends = np.sort(rng.choice(np.arange(1100, 30000), 300, replace=False))
    n = rng.integers(1, 9, 300)
    cost = [[int((n[i:j] * (ends[j - 1] - ends[i:j])).sum()) if i < j else 0 for j in range(301)] for i in range(301)]
    best = [0] + [math.inf] * 300  # plain dynamic programming
    for _ in range(16):
        best = [0] + [min(best[i] + cost[i][j] for i in range(j)) for j in range(1, 301)]
    assert padding(ends, n, packing.boundaries(ends, n, ends * n, 16).tolist()) == best[300]


def test_long_lengths_are_boundaries(spark):
    lengths = (1500, 3010, 5005, 9001, 20011)
    ends, n, t = packing.histogram(spark.createDataFrame([(x,) for x in lengths for _ in range(20)], "n_tokens long"))
    assert packing.boundaries(ends, n, t, 16).tolist() == list(lengths) and t.tolist() == [20 * x for x in lengths]
    none = packing.histogram(spark.createDataFrame([], "n_tokens long"))
    assert packing.boundaries(*none, 16).tolist() == []


def test_packing(spark):
    df = packing.pack(clashing(frame(spark, documents() + [documents()[0], (None, "x", None, None, None)])), buckets=4, budget=2000).toPandas()
    assert len(df) == len(documents()) + 2 and (df.n_tokens <= df.boundary).all() and df.boundary.nunique() <= 4
    assert not df.duplicated(["batch", "slot"]).any()
    g = df.groupby("batch").agg(n=("slot", "size"), b=("boundary", "max"))
    assert ((g.n * g.b <= 2000) | (g.n == 1)).all() and packing.pack(frame(spark, [])).isEmpty()


@lru_cache
def tokenizer():
    t = Tokenizer.from_file(default_path())
    t.encode_special_tokens = True
    return t


def whole(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "a", "a  b", " a b ", "don't 's 12,5\n\n x y \u3000z", "<|endoftext|> a", "a\tb c", "tail ", "\u00e9 \u00e8  \u00e0", "x" * 50]
ODD += ["x end.\nNext line, so \u00e9t\u00e9.\n\u00catre 3.5\n4 a--b (c) \u00a0d \n e\n f g\r\nh ,.;\n. i'll j_k2l \u0107\u00d7\u01c0"]


@pytest.mark.parametrize("text", ODD)
def test_chunks_encode_as_the_whole(text):
    assert np.frombuffer(Subwords(default_path(), kept=3).encode(["x y", text, "z"])[1], np.uint16).tolist() == whole(text)
    assert counter(default_path())(text) == counter(default_path("byte_bpe_50k.tiktoken"))(text) == len(whole(text))


def test_random_texts_encode_as_the_whole():
    rng = np.random.Generator(np.random.PCG64(8))
    signs = list("abcdeXYZ\u00e9\u00df\u0416 0123456789 .,;:!?'()|-_\n\n \t\u00a0\u3000\u2019  ") + [" the", " on", "ing "]
    encoder = Subwords(default_path(), kept=50)
    for _ in range(300):
        text = "".join(rng.choice(signs, rng.integers(1, 60)))
        assert np.frombuffer(encoder.encode([text])[0], np.uint16).tolist() == whole(text), repr(text)


def test_shards(spark):
    rows = [*documents(), (-5, "minus", None, None, None), (None, "no id", None, None, None), (8, "a", None, None, None)]
    manifest = sstable.write_shards(clashing(frame(spark, rows)))
    got = {r.doc_id: r for r in sstable.read_shards(manifest).collect()}
    texts = {i: t or "" for i, t, *_ in rows if i != 8} | {8: "word"}
    start = 0
    for i in sorted(texts, key=lambda i: (i is not None, i or 0)):
        ids = [*whole(texts[i]), 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    found = 0
    for path in (r.path for r in manifest.collect()):
        fs, at = sstable._opened(path)
        reader = sstable.Reader(fs.open_input_file(at))
        ids = {i: np.frombuffer(x, np.uint16) for i, _, x in reader}
        assert all(np.array_equal(reader.lookup(i), x) for i, x in ids.items()) and reader.lookup(10**9) is None
        found += len(ids)
    assert found == len(texts) and sstable.read_shards(sstable.write_shards(frame(spark, []))).isEmpty()


def test_chat(spark):
    turn = lambda c, *xs: [(c, k, "user" if k % 2 == 0 else "assistant", x) for k, x in enumerate(xs)]
    rows = turn(1, "a", "b") + turn(2, "a", "b", "c") + turn(3, "a", "b", "c") + turn(4, "a", "x") + turn(5, None, "") + turn(6, "", "") + turn(None, "n") + [(7, None, "user", "a"), (7, 0, "assistant", "b"), (7, 0, "assistant", "b")]
    out = chat.render(clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {r.conv_id: r for r in out.collect()}
    assert got.keys() == {2, 4, 5, 6, 7, None} and got[2].n_turns == 3 and got[7].n_turns == 3
    assert got[4].rendered == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"
    long = spark.createDataFrame([(1, k, "user", str(k)) for k in range(25)], "conv_id long, turn long, role string, text string")
    parts = chat.render(long, segment=10).orderBy("segment").collect()
    assert [r.segment for r in parts] == [0, 1, 2] and "".join(r.rendered for r in parts).count("<|im_start|>") == 25
    assert chat.render(long.where("false")).isEmpty()


def test_rollups(spark):
    docs = frame(spark)
    counted = rollups.counts(clashing(docs)).cache()
    roll = rollups.Rollup(spark)
    assert roll.commit("a", rollups.inserts(counted)) and not roll.commit("a", rollups.inserts(counted))
    total = lambda: {r.tokenizer: (r.n_docs, r.n_tokens) for r in roll.totals().collect()}
    words = sum(len((t or "").encode().split()) for _, t, *_ in documents())
    assert total()["words-1"] == (len(documents()), words)
    assert roll.commit("b", rollups.revisions(counted.where("tokenizer = 'words-1'"), F.col("n_tokens") + 1)) and total()["words-1"][1] == words + len(documents())
    roll.compact()
    assert not roll.commit("b", rollups.inserts(counted)) and total()["words-1"][1] == words + len(documents())
    assert roll.commit("c", rollups.deletes(counted)) and roll.commit("none", rollups.inserts(counted.where("false")))
    assert total()["words-1"] == (0, len(documents()))
    with pytest.raises(Exception, match="unknown change"):
        roll.commit("d", rollups.inserts(counted).withColumn("change", F.lit("other")))
    assert rollups.Rollup(spark).totals().isEmpty()
    before = total()
    roll.vacuum()
    assert total() == before and not roll.commit("a", rollups.inserts(counted))


def test_rollups_that_stop_or_race(spark, monkeypatch):
    counted = rollups.counts(frame(spark)).cache()
    roll = rollups.Rollup(spark)
    roll.commit("a", rollups.inserts(counted))
    total = lambda: sorted(map(tuple, roll.totals().collect()))
    before = total()

    def stop(*_):
        raise KeyboardInterrupt

    for step in (roll.compact, lambda: roll.commit("b", rollups.inserts(counted))):  # stops before its manifest is there
        with monkeypatch.context() as m:
            m.setattr(roll, "_publish", stop)
            with pytest.raises(KeyboardInterrupt):
                step()
        assert total() == before and not roll.committed("b")
    number, now = roll.state()
    assert not roll._publish(number, now) and roll.state() == (number, now)  # the number is taken
    state, other = roll.state, rollups.Rollup(spark, roll.folder)
    stale = [(number, now)]

    def late():  # another commit comes between reading the state and publishing
        if stale:
            other.commit("c", rollups.deletes(counted.where("tokenizer = 'words-1'")))
            return stale.pop()
        return state()

    monkeypatch.setattr(roll, "committed", lambda _: False)
    monkeypatch.setattr(roll, "state", late)
    assert roll.commit("b", rollups.inserts(counted)) and set(state()[1]["batches"]) == {"a", "b", "c"}


def test_places_as_spark_names_them(tmp_path):
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        fs, at = sstable._opened(path)
        assert at == str(tmp_path) and fs.type_name == "local"


def small_model(classes=12, own=6, dim=4, ids=300, seed=1):
    rng = np.random.Generator(np.random.PCG64(seed))
    model = lm.Model(np.arange(ids), np.arange(ids) % 2 == 0, classes=classes, own=own, dim=dim, finer=3)
    model.set_bigram(rng.integers(0, 50, (model.fines, model.fines)).astype(float))
    model.weights = {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in model.weights.items()}
    return model, rng


def plain_logits(model, x):
    """Of the classes x so far: the unnormalised logs of the next class, position by position."""
    w, out = model.weights, []
    for i in range(len(x)):
        before = range(max(0, i - (i % lm.STRIDE) - (lm.LENGTH - lm.STRIDE)), i + 1)
        q = w["e"][x[i]] @ w["q"]
        pull = np.array([q @ (w["e"][x[j]] @ w["k"]) / math.sqrt(len(q)) + w["near"][i - j] for j in before])
        pull = np.exp(pull - pull.max())
        mixed = sum(p * (w["e"][x[j]] @ w["v"]) for p, j in zip(pull / pull.sum(), before))
        h = np.tanh((mixed @ w["o"] + w["e"][x[i]]) @ w["w"] + w["b"])
        out.append(h @ w["u"] + np.log(model.bigram[x[i]]))
    return np.array(out)


def test_gradient():
    model, rng = small_model()
    w = model.weights
    x, y = rng.integers(0, 12, (3, lm.LENGTH)), rng.integers(0, 12, (3, lm.STRIDE))
    x[0, : lm.LENGTH - lm.STRIDE] = 12  # before a text
    on = (rng.random((3, lm.STRIDE)) < 0.8).astype(float)

    def loss():
        h, _ = lm.Tables(w).hidden(x)
        z = h @ w["u"] + np.log(model.bigram[x[:, lm.LENGTH - lm.STRIDE :]]).reshape(len(h), -1)
        z -= np.log(np.exp(z).sum(-1, keepdims=True))
        return -(z[np.arange(len(z)), y.ravel()] * on.ravel()).sum() / on.sum()

    g = lm.gradient(w, model.bigram, x, y, on)
    for name, v in w.items():
        for _ in range(3):
            i = tuple(rng.integers(0, s) for s in v.shape)
            keep, step = v[i], 1e-5
            v[i] = keep + step
            up = loss()
            v[i] = keep - step
            down = loss()
            v[i] = keep
            assert (up - down) / (2 * step) == pytest.approx(g[name][i], abs=2e-4), name


def test_windows_score_every_id_once():
    for n in (1, lm.STRIDE, lm.STRIDE + 1, 500):
        text, start = lm.windows(np.array([n]))
        assert [p for s in start for p in range(s, min(s + lm.STRIDE, n))] == list(range(n))


def test_token_logs_against_plain_loops():
    model, rng = small_model()
    ids = [rng.integers(0, 300, n).astype(np.uint16) for n in (1, 30, 100)]
    end, lm.END = lm.END, 299
    try:
        y, owner, log, side = lm.token_logs(model, ids, lm.Tables(model.weights))
    finally:
        lm.END = end
    for k, x in enumerate(ids):
        before = np.concatenate(([299], x[:-1])).astype(int)
        z = plain_logits(model, model.of[before])
        z -= np.log(np.exp(z).sum(1, keepdims=True))
        shares = [model.inner[model.fine[a], model.fine[b]] + model.share[b] for a, b in zip(before, x)]
        assert log[owner == k] == pytest.approx(z[np.arange(len(x)), model.of[x]] + shares, abs=1e-4)
        assert side[owner == k] == pytest.approx(np.log(np.exp(z) @ model.sides[:, 1]), abs=1e-4)


def test_shares_sum_to_one():
    model, _ = small_model()
    for x in (0, 7, 299):
        total = np.exp(model.shares(np.full(300, x), np.arange(300)))
        assert np.bincount(model.of, weights=total) == pytest.approx(np.ones(12), abs=1e-5)


def test_long_words_are_completed_between_logarithms():
    known = lm.Known(np.concatenate(([100, 10, 4, 2], np.full(5, 3))), np.full(5, 20), 5)
    got = known.completion(np.array([0, 0, 9]), np.array([1, 1, 1]), np.array([-50_000.0, -2.0, -50_000.0]))
    assert got == pytest.approx([math.log10(0.5 * 3 / 20) - 50_000, math.log10(0.5 * 3 / 20 * 0.01), math.log10(8.5 / 20)])


def test_words_of_texts():
    from pagewarden.llm.subwords import begins_with_space, plain_ids

    path = default_path("byte_bpe_50k.tiktoken")
    ids, starts = plain_ids(path), begins_with_space(path)
    for text in ("", " ", "Don't  stop\n12,5 x", "a\u3000 b \u3000c", "\u00e9t\u00e9 \x1c y\x85z", "\ufffd " * 3, "x" * 300_000):
        got, n = lm.word_ids(text.encode(), ids, starts)
        words = text.encode().lower().split()
        want = [i for w in words for i in ids(" " + w.decode())]
        assert n == len(words) == np.count_nonzero(starts[got]) and got.tolist() == want


def id_model():
    """With something learned at every level down to the ids, and vectors of the ids' own."""
    model, rng = small_model()
    model.finer = 0.5 * rng.standard_normal(model.finer.shape)
    model.rows = 0.5 * rng.standard_normal(model.rows.shape)
    return model, rng


def plain_below(model, mass, h, node, size, ids):
    """Probabilities of the ids under a node of a finer class's tree that has room for ``size``; leaves fill it from the left."""
    if size == 1:
        return np.ones(len(ids))
    one, two = ids[: size // 2], ids[size // 2 :]
    left = plain_below(model, mass, h, 2 * node, size // 2, one)
    if not len(two):
        return left
    odds = mass[one].sum() / mass[two].sum() * math.exp(h @ model.rows[len(model.of) + model.tree[ids[0]] + node])
    return np.concatenate((odds * left, plain_below(model, mass, h, 2 * node + 1, size // 2, two))) / (1 + odds)


def plain_ids(model, x):
    """Probabilities of every id after the ids x, by attention over the ids' vectors."""
    w, i, size = model.weights, len(x) - 1, len(model.of)
    e = [w["e"][model.of[a]] + model.rows[a] for a in x]
    before = range(max(0, i - (i % lm.STRIDE) - (lm.LENGTH - lm.STRIDE)), i + 1)
    pull = np.exp([e[i] @ w["q"] @ (e[j] @ w["k"]) / math.sqrt(len(e[i])) + w["near"][i - j] for j in before])
    mixed = sum(p * (e[j] @ w["v"]) for p, j in zip(pull / pull.sum(), before))
    h = np.tanh((mixed @ w["o"] + e[i]) @ w["w"] + w["b"])
    top = np.exp(h @ w["u"]) * model.bigram[model.of[x[i]]]
    finer = np.exp(h @ model.finer.T + model.inner[model.fine[x[i]]])
    out, mass = np.zeros(size), np.arange(size) + 1.0
    for f in range(model.fines):
        ids = np.flatnonzero(model.fine == f)
        if len(ids):
            c = model.up[f]
            out[ids] = top[c] / top.sum() * finer[f] / finer[model.up == c].sum() * plain_below(model, mass, h, 1, 1 << (len(ids) - 1).bit_length(), ids)
    return out


def test_attention_is_over_ids_and_reaches_every_id(monkeypatch):
    model, rng = id_model()
    monkeypatch.setattr(lm, "END", 299)
    ids = [rng.integers(0, 300, n).astype(np.uint16) for n in (1, 30, 50)]
    _, owner, log, _ = lm.token_logs(model, ids, lm.layer(model))
    for k, x in enumerate(ids):
        before = np.concatenate(([299], x[:-1])).astype(int)
        plain = [plain_ids(model, before[: i + 1]) for i in range(len(x))]
        assert [p.sum() for p in plain] == pytest.approx(np.ones(len(x)))
        assert log[owner == k] == pytest.approx([math.log(p[a]) for p, a in zip(plain, x)], abs=1e-4)
    # another id of the same classes, further back than a bigram reaches, changes what follows
    x = ids[1].copy()
    x[3] = next(a for a in range(300) if a != x[3] and model.fine[a] == model.fine[x[3]])
    got = [lm.token_logs(model, [y], lm.layer(model))[2] for y in (x, ids[1])]
    assert got[0][:3] == pytest.approx(got[1][:3]) and (abs(got[0] - got[1])[5:20] > 1e-5).all()


def test_finer_classes_of_a_batch_at_once():
    model, rng = id_model()
    before, after = rng.integers(0, 300, (2, 90))
    h = np.tanh(rng.standard_normal((90, 4)))
    at = lm._Finer(model, model.fine[before], model.fine[after], h, model.finer)
    assert sorted(at.order) == list(range(90)) and (np.diff(model.of[after[at.order]].astype(int)) >= 0).all()
    assert (model.of[after[at.order[: at.own]]] < 6).all() and len(at.p) == 90 - at.own > 0
    for i, p, picked, total, cell in zip(at.order[at.own :], at.p, at.picked, at.total, at.cell):
        inside = np.flatnonzero(model.up == model.of[after[i]])
        want = np.exp(model.finer[inside] @ h[i] + model.inner[model.fine[before[i]], inside])
        assert p == pytest.approx(want, rel=1e-5) and total == pytest.approx(want.sum(), rel=1e-5)
        assert picked == pytest.approx(model.finer[model.fine[after[i]]] @ h[i]) and at.p.ravel()[cell] == p[inside == model.fine[after[i]]]


def test_decisions_of_ids_with_little_weight():
    """The share of a decision's own way is kept beside the other's, where one less the other would be zero."""
    counts = np.ones(300)
    counts[::3] = 1e9
    model = lm.Model(counts, np.arange(300) % 2 == 0, classes=12, own=6, dim=4, finer=3)
    deep, begin, who, node, sign, own, other = model.decisions(np.arange(300))
    assert (own > 0).all() and own + other == pytest.approx(np.ones(len(own)), abs=1e-6) and own.min() < 1e-7
    assert (who[begin] == deep).all() and (np.bincount(who, minlength=300) == model.depth).all()
    assert (model.left[node] == pytest.approx(np.where(sign > 0, own, other), abs=1e-6)) and set(sign) == {1, -1}
    share = np.ones(300)
    np.multiply.at(share, who, own)
    assert np.bincount(model.fine, weights=share) == pytest.approx(np.ones(model.fines), abs=1e-4)


def test_sums_of_runs():
    rng = np.random.Generator(np.random.PCG64(4))
    begin = np.array([0, 1, 5, 6])
    for kind, columns in itertools.product((np.float32, np.float64), (3, 4)):
        rows = rng.standard_normal((9, columns)).astype(kind)
        got = lm._runs(rows, begin)
        assert got.dtype == kind and got == pytest.approx(np.array([x.sum(0) for x in np.split(rows, begin[1:])]), abs=1e-5)


def test_gradient_of_ids(monkeypatch):
    model, rng = id_model()
    monkeypatch.setattr(lm, "END", 299)
    placed = lm.Placed([rng.integers(0, 299, n).astype(np.uint16) for n in (1, 30, 70)])
    x, y, on, target = placed.batch(model.of, 300, slice(None), by_id=True)
    on[2, 4] = False
    at = target[on]
    before, after = placed.x[at], placed.y[at]

    def loss():
        h = lm.layer(model).hidden(x)[0][on.ravel()]
        return -(lm.class_logs(model, model.of[before], model.of[after], h)[0] + lm.id_logs(model, before, after, h)).mean()

    step = lm.Step(model, model.finer, model.rows, model.of, before, after, on)
    g = lm.gradient(model.weights | {"e": model.weights["e"][model.of] + model.rows[:300]}, step, x, y, on.astype(float))
    rows = np.zeros_like(model.rows)
    rows[:300], rows[300 + step.nodes] = g["e"], step.steps
    g["e"] = lm._by_class(model.of, g["e"], 12)
    for name, v, d in [(k, v, g[k]) for k, v in model.weights.items()] + [("finer", model.finer, g["finer"]), ("rows", model.rows, rows)]:
        for i in rng.permutation(np.argwhere(d))[:6]:
            i, keep = tuple(i), v[tuple(i)]
            v[i] = keep + 1e-4
            up = loss()
            v[i] = keep - 1e-4
            down = loss()
            v[i] = keep
            assert (up - down) / 2e-4 == pytest.approx(d[i], abs=3e-4), name


def test_training_learns_ids_that_classes_hide():
    """After a, b comes c; after d, b comes e: no class nor bigram of classes tells, only attention over ids."""
    r = np.random.Generator(np.random.PCG64(5))
    ids = [np.concatenate([((3000, 5000, 7000), (3001, 5000, 7001))[k] for k in r.integers(0, 2, 400)]).astype(np.uint16) for _ in range(60)]
    counts = np.bincount(np.concatenate(ids), minlength=lm.END + 1) + np.arange(lm.END + 1) % 7
    model = lm.Model(counts, np.arange(lm.END + 1) % 2 == 0)
    model.fine[[3000, 3001]], model.fine[[7000, 7001]] = model.fine[3000], model.fine[7000]
    model.of = model.up[model.fine].astype(np.uint8)
    model._plant(counts + 1.0)
    batch = pa.RecordBatch.from_pydict({"payload": pa.array([zstandard.compress(x.tobytes()) for x in ids], pa.binary())})
    for turn in range(lm.ROUNDS):
        lm.take_mean(model, [(out.column("n")[0].as_py(), out.column("w")[0].as_py()) for out in lm._train(model, turn)(iter([batch] * 20))])
    h = lm.layer(model)
    right, wrong = (lm.token_logs(model, [np.array([*start, 5000, 7000], np.uint16)], h)[2][-1] for start in ((3000,), (3001,)))
    assert right > wrong + 0.1


def test_training_takes_every_window_once(monkeypatch):
    r = np.random.Generator(np.random.PCG64(3))
    ids = [r.integers(0, 300, n).astype(np.uint16) for n in (1, 40, 700, 5000)]
    batch = pa.RecordBatch.from_pydict({"payload": pa.array([zstandard.compress(x.tobytes()) for x in ids], pa.binary())})
    model = lm.Model(np.arange(lm.END + 1), np.arange(lm.END + 1) % 2 == 0)
    model.of = (np.arange(lm.END + 1) % 251).astype(np.uint8)  # so that windows can be told apart
    seen = Counter()

    def gradient(w, bigram, x, y, on):
        seen.update(bytes(row[: int(o.sum())].astype(np.uint8)) for row, o in zip(y, on))
        return {c: np.zeros_like(v) for c, v in w.items()}

    monkeypatch.setattr(lm, "gradient", gradient)
    n = sum(out.column("n")[0].as_py() for turn in range(lm.ROUNDS) for out in lm._train(model, turn)(iter([batch])))
    targets = [model.of[np.append(x, lm.END)] for x in ids]
    every = Counter(bytes(t[k : k + lm.STRIDE].astype(np.uint8)) for t in targets for k in range(0, len(t), lm.STRIDE))
    assert n == sum(every.values()) and seen == every


def test_lm_scores(spark):
    rows = [(i, prose(i % 40, 40 + i % 7), "en", "s", 1) for i in range(300)] + [(900, None, None, None, None), (None, "nothing", None, None, None)]
    df = frame(spark, rows)
    got = {r.doc_id: r for r in lm.score(clashing(df), F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows}
    words = {i: [*(t or "").encode().lower().split(), None] for i, t, *_ in rows}
    c = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in words.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9) and -1e6 < r.score < 0
    assert lm.score(frame(spark, []), F.lit(False)).isEmpty()


def test_pipeline_against_plain_stages(spark):
    """Each stage, on what the one before kept, against a plain version of it."""
    from .test_dedup_ops import components_of, contaminated

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, DATA)
        assert got.columns == docs.columns
        ids = {r.doc_id for r in got.collect()}
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
            want = {i for i, r in kept.items() if model.score(*map(np.atleast_1d, model.evidence(r.text)))[0] < 0.5}
        elif name == "exact_dedup":
            first = {}
            for i in sorted(kept):
                first.setdefault(__import__("re").sub(r"[\x20\x09-\x0d]+", " ", kept[i].text or ""), i)
            want = set(first.values())
        elif name == "ngram_join":
            groups = components_of([(i, r.text) for i, r in kept.items()], 5, 80)
            want = {i for i, (_, root) in groups.items() if i == root}
            assert len(want) < len(kept)
        else:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
            want = {i for i, x in contaminated([(i, r.text) for i, r in kept.items()], items).items() if not x[4]}
        assert ids == want, name
        kept = {i: rows[i] for i in ids}
        docs = spark.createDataFrame([kept[i] for i in sorted(ids)], docs.schema)
    packed = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()}
    tokens = {i: len(whole(r.text)) + 1 for i, r in kept.items()}
    ends, n = np.unique(list(tokens.values()), return_counts=True)
    bounds = packing.boundaries(ends, n, ends * n, packing.BUCKETS).tolist()
    first = 0
    for k, bound in enumerate(bounds):  # plain batches of each bucket, in order of length and id
        mine = sorted((t, i) for i, t in tokens.items() if t <= bound and (k == 0 or t > bounds[k - 1]))
        room = max(1, packing.BUDGET // bound)
        for place, (t, i) in enumerate(mine):
            r = packed.pop(i)
            assert (r.n_tokens, r.bucket, r.boundary, r.batch, r.slot, r.padding) == (t, k, bound, first + place // room, place % room, bound - t)
        first += -(-len(mine) // room)
    assert not packed


def test_only_the_entry_guards_the_import():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "pagewarden")):
        for n in names:
            if n.endswith(".py") and not folder.endswith("llm"):
                assert "pagewarden.llm" not in open(os.path.join(folder, n)).read()
