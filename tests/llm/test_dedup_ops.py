import hashlib
import re
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from pagewarden.llm import decontaminate, exact_dedup, ngram_join, suffix_dedup
from pagewarden.llm.components import components

from .cases import clashing, documents, frame, prose


def test_exact(spark):
    norm = {i: re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for i, t, *_ in documents()}
    got = {r.doc_id: r for r in exact_dedup.assign(clashing(frame(spark))).collect()}
    assert got.keys() == norm.keys()
    for i, t in norm.items():
        same = [j for j in norm if norm[j] == t]
        r = got[i]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (min(same), len(same), i == min(same), hashlib.sha256(t.encode()).hexdigest())


def test_exact_keeps_rows_whole(spark):
    df = clashing(frame(spark))
    out = exact_dedup.deduplicate(df)
    rows = {r.doc_id: r for r in df.collect()}
    got = out.collect()
    assert out.schema == df.schema and all(rows[r.doc_id] == r for r in got) and 2 not in {r.doc_id for r in got}


def test_exact_repeats_nulls_and_empty(spark):
    rows = [(1, "x", None, None, None), (1, "x", None, None, None), (None, "x", None, None, None), (None, "y", None, None, None)]
    got = exact_dedup.assign(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == [("1", "1", 3, False), ("1", "1", 3, True), ("None", "1", 3, False), ("None", "None", 1, True)]
    assert exact_dedup.assign(frame(spark, [])).count() == 0 and exact_dedup.deduplicate(frame(spark, [])).count() == 0


def components_of(rows, n, percent):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_ngram_join(spark, monkeypatch):
    rows = documents() + [(100 + k, " ".join(f"w{j}" if j % 60 != k % 60 else f"z{k}" for j in range(90)), "en", "s", 1) for k in range(60)]
    monkeypatch.setattr(ngram_join, "TILE", 16)  # so that the sixty near copies are tiled
    for n, percent in ((3, 90), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(clashing(frame(spark, rows)), n, percent).collect()}
        assert got == components_of(rows, n, percent)


def links_of(rows, n, percent):
    sets = [(i, {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}) for i, w in ((i, t.encode().lower().split()) for i, t, *_ in rows)]
    out = {i: 0 for i, _ in sets}
    for (i, a), (j, b) in combinations(sets, 2):
        if a != b and 100 * len(a & b) >= percent * len(a | b):
            out[i] += 1
            out[j] += 1
    return out


def test_ngram_join_ties_only_what_may_link(spark, monkeypatch):
    """Texts that share a rare passage with the next one, but link with none, made one block whose texts went to every tile."""
    tied = []
    monkeypatch.setattr(ngram_join, "components", lambda edges: tied.append(edges.count()) or components(edges))
    passage = lambda k: " ".join(f"pass{k}x{j}" for j in range(5))
    common = lambda k: " ".join(f"c{x}" for x in np.random.Generator(np.random.PCG64(k)).integers(0, 50, 200))
    rows = [(k, f"{passage(k)} {common(k)} {passage(k + 1)}", "en", "s", 1) for k in range(60)]
    for n, percent in ((3, 90), (5, 80)):
        got = ngram_join.join(frame(spark, rows), n, percent).collect()
        assert all(r.component_id == r.doc_id and r.n_links == 0 for r in got) and tied.pop() == 0


def test_ngram_join_long_postings(spark, monkeypatch):
    """Long postings are searched and not paired: links of near copies of all sizes, beside texts that only share a passage."""
    monkeypatch.setattr(ngram_join, "PAIRED", 3)
    monkeypatch.setattr(ngram_join, "TILE", 8)
    rows = [(100 * m + k, " ".join(f"w{m}x{j}" if j % 40 != k else f"z{k}x{j}" for j in range(m)), "en", "s", 1) for m in (70, 500, 1100) for k in range(12)]
    rows += [(5000 + k, f"w70x1 w70x2 w70x3 w70x4 w70x5 {prose(k, 20 * k + 5)}", "en", "s", 1) for k in range(12)]
    rows += [(6000 + k, " ".join(f"v{j}" for j in range(100 - 3 * k, 200)), "en", "s", 1) for k in range(12)]
    for n, percent in ((3, 90), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.join(frame(spark, rows), n, percent).collect()}
        links = links_of(rows, n, percent)
        assert got == {i: (*x, links[i]) for i, x in components_of(rows, n, percent).items()} and any(links.values())


def test_signatures():
    r = np.random.Generator(np.random.PCG64(3))
    sets = [np.unique(r.integers(0, 1 << 63, m).astype(np.uint64)) for m in (0, 1, 40, 511, 512, 513, 3000)]
    sets += [s[len(s) // 20 :] for s in sets]
    row, size = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.array([len(s) for s in sets])
    packed, bits = ngram_join.signatures(np.concatenate(sets), row, size)
    sig = np.split(packed, np.cumsum(bits)[:-1] // 8)
    for (a, x), (b, y) in combinations(list(zip(sets, sig)), 2):
        w = min(len(x), len(y))
        assert ngram_join.apart(ngram_join.folded(x[None], w), ngram_join.folded(y[None], w))[0] <= len(np.setxor1d(a, b))


def test_ngram_join_empty_and_null_ids(spark):
    assert ngram_join.join(frame(spark, [])).count() == 0
    got = ngram_join.join(frame(spark, [(None, "a b c d", None, None, None), (3, "a b c d", None, None, None), (3, "a b c d", None, None, None)])).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("3", 3), ("3", 3), ("None", 3)]


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (6, 6), (None, 1)] + [(k, k + 1) for k in range(10, 60)], "a long, b long")
    got = {r.node: r.root for r in components(e).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4} | {k: 10 for k in range(10, 61)}


def repeats(rows, span):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        d = (t or "").encode()
        gone = bytearray(len(d))
        for p in range(len(d) - span + 1):
            if d[p : p + span] in seen:
                gone[p : p + span] = b"\1" * span
            seen.add(d[p : p + span])
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out[i] = (len(d), sum(gone), sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1])), hashlib.sha256(kept).hexdigest())
    return out


def test_suffixes(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 5000)  # so that long documents are cut
    for span in (100, 60):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(clashing(frame(spark)), span=span).collect()}
        assert got == repeats(documents(), span)


def test_suffixes_empty_and_repeated_ids(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0
    t = prose(1, 40)
    got = suffix_dedup.remove_repeats(frame(spark, [(1, t, None, None, None), (1, t, None, None, None), (None, t, None, None, None)])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("1", len(t.encode())), ("None", 0)]


def contaminated(rows, items, length=10):
    words = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    spans = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - length + 1)) if w else ():
            spans.setdefault(tuple(w[k : k + length]), set()).add(i)
    out = {}
    for i, t, *_ in rows:
        w, hit, ids = words(t), set(), set()
        for k in range(len(w)):
            for n in {len(s) for s in spans}:
                if found := spans.get(tuple(w[k : k + n])) if k + n <= len(w) else None:
                    hit |= set(range(k, k + n))
                    ids |= found
        listed = ",".join(sorted(map(str, ids)))
        out[i] = (len(w), len(hit), len(ids), hashlib.sha256(listed.encode()).hexdigest(), bool(hit))
    return out


def test_decontamination_by_items_without_an_id(spark):
    items = [(None, "alpha beta gamma"), (None, " ".join(f"w{k}" for k in range(12))), (4, "gamma delta")]
    rows = [(1, "x alpha beta gamma y", None, None, None), (2, "a " + items[1][1] + " alpha beta gamma delta", None, None, None), (3, "clean words", None, None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contamination(frame(spark, rows), bench).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {1: (3, 1, sha(""), True), 2: (16, 2, sha("4"), True), 3: (0, 0, sha(""), False)}
    assert {r.doc_id for r in decontaminate.clean(frame(spark, rows), bench).collect()} == {3}


def test_clean_judges_rows_not_ids(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    rows = [(None, "alpha beta gamma", None, None, None), (None, "clean", None, None, None), (1, "so alpha beta gamma", None, None, None), (1, "clean too", None, None, None)]
    df = clashing(frame(spark, rows))
    out = decontaminate.clean(df, bench)
    assert out.columns == df.columns and sorted(r.text for r in out.collect()) == ["clean", "clean too"]


def test_decontamination(spark):
    rows = documents()
    text = {r[0]: r[1] for r in rows}
    items = [(1, " ".join(text[10].split()[35:50])), (2, text[10].split()[40].upper() + ", " + " ".join(text[10].split()[41:60])), (3, "Two... words"), (4, None), (5, "!"), (6, prose(99, 20)), (7, " ".join(text[15].split()[5000:5010])), (8, text[13])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contamination(clashing(frame(spark)), bench).collect()}
    assert got == contaminated(rows, items)
    kept = {r.doc_id for r in decontaminate.clean(frame(spark), bench).collect()}
    assert kept == {i for i, x in got.items() if not x[4]}
    none = bench.where("false")
    assert decontaminate.contamination(frame(spark), none).where("contaminated").isEmpty() and decontaminate.contamination(frame(spark, []), bench).isEmpty()
