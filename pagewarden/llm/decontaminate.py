"""Benchmark decontamination by winnowing, with DataFrame functions only.

Words are runs of letters, digits and non-ASCII characters after A-Z were lower-cased. Of every window of consecutive k-gram
hashes the least is a fingerprint; a span of ``length`` words holds ``length - k + 1`` k-grams, one window, so two equal
spans always share a fingerprint, and every sufficiently long shared span is found. Fingerprints of documents and benchmark
join; each hit is extended over the spans around it, whose hashes join with the item's spans. A document word inside a span
that an item has too is hit. An item of fewer words than ``length``, but not none, is one span; all such lengths together
have one pass of their own, with every span of those lengths.

Hashes of n words come from hashes of half as many, and sliding minima from minima of half the window, so a text costs a
few additions to arrays for each word. Documents without a fingerprint in common with an item travel as one row of their own
hash, so no key stands for all of them.

Null and empty texts have no words. Rows with the same doc_id count as one document, whose words are those of its longest
row and whose hits are those of all its rows; a null doc_id is one such document. Items of equal text all count. Items
with a null item_id hit like others; all of them are one item in n_items and none in items and items_sha256. Extra columns are ignored. An empty
benchmark leaves every document clean; empty documents give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import stored

#: Every character that is not part of a word.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Array of lower-cased words; only ASCII letters change case, so other texts go through translate()."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(low, GAP), "")


def _paired(x: Column, width: int, y: Column, more: int, f) -> Column:
    """f of each entry of x, which stands for ``width`` words, and the entry of y that many places later, of ``more`` words."""
    last = F.size(x) - more
    pairs = F.zip_with(F.slice(x, F.lit(1), last), F.slice(y, F.lit(width + 1), last), f)
    return F.when(last > 0, pairs).otherwise(F.array().cast("array<bigint>"))


def _slid(df: DataFrame, of: str, n: int, f, out: str) -> DataFrame:
    """df with a column: f over every n consecutive entries of an array column, from powers of two. Each step is a column of
    its own, which is used twice and computed once."""
    keep, now, have, done = df.columns, of, 1, None
    while have <= n:
        if n & have:
            if done is None:
                done, size = now, have
            else:
                df = df.withColumn(f"_{out}{size + have}", _paired(F.col(now), have, F.col(done), size, f))
                done, size = f"_{out}{size + have}", size + have
        if 2 * have <= n:
            df = df.withColumn(f"_{out}_{2 * have}", _paired(F.col(now), have, F.col(now), have, f))
            now = f"_{out}_{2 * have}"
        have *= 2
    return df.select(*keep, F.col(done).alias(out))


def _grams(df: DataFrame, n: int, out: str) -> DataFrame:
    """df with the hashes of all n consecutive entries of h; fewer have none."""
    return _slid(df, "h", n, lambda a, b: F.xxhash64(a, b), out)


#: Minima go by the upper bits of a hash, then by place, which takes the lower bits.
_PLACE = 24
_LOW = (1 << _PLACE) - 1


def _least(df: DataFrame, window: int, out: str) -> DataFrame:
    """df with the places of the least g of every window, leftmost of equal ones, each place once."""
    upper = lambda x: x.bitwiseAND(F.lit(~_LOW))
    df = df.withColumn("_packed", F.transform("g", lambda x, i: upper(x).bitwiseOR(i.cast("bigint"))))
    df = _slid(df, "_packed", window, lambda a, b: F.least(a, b), "_min")
    near = lambda i: F.transform(F.slice("g", i + 1, F.lit(window)), upper)
    last = F.size("g") - window
    slow = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_position(near(i), F.array_min(near(i))).cast("int") + i - 1)
    places = F.when(last >= _LOW, slow).otherwise(F.transform("_min", lambda x: x.bitwiseAND(F.lit(_LOW)).cast("int")))
    return df.withColumn(out, F.array_distinct(places)).drop("_packed", "_min")


def _hashed(df: DataFrame, keep: str) -> DataFrame:
    """keep, n_words, and h, the words' hashes."""
    out = df.select(keep, words(F.col("text")).alias("w"))
    return out.select(keep, F.size("w").alias("n_words"), F.transform("w", lambda x: F.xxhash64(x)).alias("h"))


def spans_hit(docs: DataFrame, benchmark: DataFrame, length: int = 10, k: int = 5) -> DataFrame:
    """(doc_id, n_words, start, length, item_id): each place where a document has an item's span, and for every row of docs
    one row without a place."""
    window, reach = length - k + 1, length - k
    prepared = lambda df, keep: _least(_grams(_grams(_hashed(df, keep), k, "g"), length, "s"), window, "p")

    items = prepared(benchmark.select("item_id", "text"), "item_id")
    prints = items.select(F.explode(F.transform("p", lambda p: F.element_at("g", p + 1))).alias("f")).distinct()
    spans = items.select("item_id", F.explode("s").alias("span")).distinct().withColumn("known", F.lit(True))

    near = lambda p: F.slice("s", F.greatest(p - reach, F.lit(0)) + 1, F.lit(reach + 1) + F.least(p - reach, F.lit(0)))
    own = F.xxhash64(F.lit("none"), F.col("doc_id"))  # spreads the rows that stand for whole documents
    none = F.struct(F.lit(-1).alias("at"), own.alias("f"), F.array().cast("array<bigint>").alias("near"))
    marks = F.transform("p", lambda p: F.struct(p.alias("at"), F.element_at("g", p + 1).alias("f"), near(p).alias("near")))
    rows = prepared(docs.select("doc_id", "text"), "doc_id").select("doc_id", "n_words", F.explode(F.concat(F.array(none), marks)).alias("m"))
    rows = rows.select("doc_id", "n_words", "m.at", "m.f", "m.near")
    met = rows.join(prints.withColumn("met", F.lit(True)), "f", "left").where("met OR at < 0")
    met = met.select("doc_id", "n_words", "at", F.col("f").alias("own"), F.posexplode_outer("near").alias("k", "span"))
    start = F.greatest(F.col("at") - reach, F.lit(0)) + F.col("k")
    met = met.select("doc_id", "n_words", start.alias("start"), "at", F.coalesce("span", "own").alias("span"))
    found = met.join(spans, "span", "left").where("known OR at < 0")
    at_all = F.col("at") >= 0
    out = found.select("doc_id", "n_words", F.when(at_all, F.col("start")).alias("start"), F.lit(length).alias("length"), F.when(at_all, F.col("item_id")).alias("item_id"))

    short = _hashed(benchmark.select("item_id", "text"), "item_id").where((F.size("h") > 0) & (F.size("h") < length))
    lengths = sorted(r.n_words for r in short.select("n_words").distinct().collect())  # below `length`
    if not lengths:
        return out
    every, of_items = _hashed(docs.select("doc_id", "text"), "doc_id"), short
    for n in lengths:
        every, of_items = (_grams(x, n, f"g{n}") for x in (every, of_items))
    whole = F.coalesce(*[F.when(F.col("n_words") == n, F.element_at(f"g{n}", 1)) for n in lengths])
    wanted = of_items.select("item_id", F.col("n_words").alias("length"), whole.alias("span"))
    spots = lambda n: F.transform(f"g{n}", lambda x, i: F.struct(F.lit(n).alias("length"), i.alias("start"), x.alias("span")))
    held = every.select("doc_id", "n_words", F.explode(F.concat(*map(spots, lengths))).alias("x")).select("doc_id", "n_words", "x.length", "x.start", "x.span")
    return out.unionByName(held.join(wanted, ["length", "span"]).select("doc_id", "n_words", "start", "length", "item_id"))


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = 10, k: int = 5) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items."""
    hits = spans_hit(docs, benchmark, length, k)
    place = F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("stop")))
    per = hits.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.sort_array(F.collect_set(place)).alias("places"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"), F.max((F.col("start").isNotNull() & F.col("item_id").isNull()).cast("int")).alias("nameless"))
    covered = F.aggregate("places", F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")), lambda acc, x: F.struct(F.greatest(acc["end"], x["stop"]).alias("end"), (acc["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(acc["end"], x["start"]))).alias("n")), lambda acc: acc["n"])
    return per.select("doc_id", F.col("n_words").cast("long").alias("n_words"), covered.alias("n_hit"), (F.size("items") + F.col("nameless")).cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("places") > 0).alias("contaminated"), "items")


def clean(docs: DataFrame, benchmark: DataFrame, length: int = 10, k: int = 5) -> DataFrame:
    """The rows of docs without a hit, unchanged; each row is judged for itself, also where doc_ids repeat or are null."""
    rows = stored(docs.withColumn("_dc_row", F.monotonically_increasing_id()), "decontaminate-rows")
    bad = contamination(rows.select(F.col("_dc_row").alias("doc_id"), "text"), benchmark, length, k).where("contaminated").select(F.col("doc_id").alias("_dc_row"))
    return rows.join(bad, "_dc_row", "left_anti").select(docs.columns)
