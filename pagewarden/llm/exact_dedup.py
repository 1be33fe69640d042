"""Exact deduplication by skew-safe combining.

Three stages, each comparing full content: equal texts meet inside an Arrow batch first (nothing moves), then within
(digest, salt) groups, then the salt winners of a digest meet. A group of copies, however large, sends one row for each
batch into a salt group and one row for each salt into the last stage.

Texts are equal when they are identical after each run of space, tab, line feed, vertical tab, form feed and carriage
return is replaced by one space; null counts as empty. The row with the smallest doc_id of a group stays; of rows with
equal doc_id and equal text (repeated rows) one stays; a null doc_id ranks after every other. Empty tables give empty
results; further columns, whatever their names, travel untouched in ``deduplicate``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import SLICE, lean, stored, width

SALTS = 16
_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_RUN = re.compile(b"  +")
#: Own columns carry this prefix, so that columns of the input cannot clash with them.
P = "_xd_"


def normalised(text: bytes) -> bytes:
    """Each run of ASCII white space as one space."""
    text = text.translate(_BLANKS)
    return _RUN.sub(b" ", text) if b"  " in text else text


def _local(id_col: str, text_col: str, salts: int, members: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        serial = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        for batch in batches:
            ids = batch.column(id_col).to_pylist()
            groups: dict[bytes, list[int]] = {}
            for i, t in enumerate(batch.column(text_col)):
                groups.setdefault(normalised(t.as_buffer().to_pybytes() if t.is_valid else b""), []).append(i)
            rank = lambda i: (ids[i] is None, ids[i] or 0)
            first, digest, raw, count, key, listed = [], [], [], [], [], []
            for text, rows in groups.items():
                rows.sort(key=rank)
                first.append(rows[0])
                digest.append(hashlib.sha256(text).digest())
                own = batch.column(text_col)[rows[0]]
                raw.append(pack.compress(own.as_buffer().to_pybytes() if own.is_valid and not members else text))
                count.append(len(rows))
                key.append(serial)
                listed.append([ids[i] for i in rows])
                serial += 1
            salt = [k * 2654435761 % 2**32 % salts for k in key]
            if members:
                cols = {f"{P}id": pa.array([ids[i] for i in first], pa.int64()), f"{P}ids": pa.array(listed, pa.list_(pa.int64()))}
            else:
                kept = batch.take(pa.array(first, pa.int64()))
                cols = {c: kept.column(c) for c in kept.schema.names if c != text_col} | {f"{P}null": kept.column(text_col).is_null()}
            cols |= {f"{P}digest": pa.array(digest, pa.binary()), f"{P}salt": pa.array(salt, pa.int32()), f"{P}n": pa.array(count, pa.int64()), f"{P}key": pa.array(key, pa.int64()), f"{P}text": pa.array(raw, pa.binary())}
            yield pa.RecordBatch.from_pydict(cols)

    return lean(run)


class _Group:
    """Rows of one digest with one content; the best row is a place in the batch at hand, or a copied row of an earlier one."""

    def __init__(self, content: bytes, packed: bytes):
        self.content, self.packed, self.n, self.rank, self.place, self.row, self.keys = content, packed, 0, None, None, None, []


def _merge(id_col: str, names: list[str], keyed: bool, text: str | None = None):
    """Over rows sorted by digest: one row for each content. keyed: rows carry the keys of the local groups they stand for.
    text: the column that gets the content back as it was.

    Only the groups of the last digest of a batch outlive it, each with a copy of its best row."""

    def finished(batch: pa.RecordBatch, groups: list[_Group]) -> Iterator[pa.RecordBatch]:
        here, earlier = [g for g in groups if g.row is None], [g for g in groups if g.row is not None]
        parts = [(here, batch.take(pa.array([g.place for g in here], pa.int64())))] if here else []
        for some, rows in parts + [([g], g.row) for g in earlier]:
            cols = {c: rows.column(c) for c in names if c in rows.schema.names}
            cols[f"{P}n"] = pa.array([g.n for g in some], pa.int64())
            if keyed:
                cols[f"{P}keys"] = pa.array([g.keys for g in some], pa.list_(pa.int64()))
            if not text:
                yield pa.RecordBatch.from_pydict({c: cols[c] for c in names})
                continue
            unpack = zstandard.ZstdDecompressor()
            packs, none = rows.column(f"{P}text"), rows.column(f"{P}null").to_pylist()
            own, size, begin = [], 0, 0
            for i in range(len(some)):
                own.append(None if none[i] else unpack.decompress(packs[i].as_buffer()).decode())
                size += len(own[-1] or "")
                if size >= SLICE or i == len(some) - 1:
                    cols[text] = pa.array(own, pa.string())
                    yield pa.RecordBatch.from_pydict({c: cols[c] if c == text else cols[c].slice(begin, len(own)) for c in names})
                    own, size, begin = [], 0, i + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        now, groups, batch = None, [], None
        for batch in batches:
            digests, packs = batch.column(f"{P}digest").to_pylist(), batch.column(f"{P}text")
            ids, ns, keys = (batch.column(c).to_pylist() for c in (id_col, f"{P}n", f"{P}key"))
            many = batch.column(f"{P}keys").to_pylist() if keyed and f"{P}keys" in batch.schema.names else None
            done: list[_Group] = []
            for i, d in enumerate(digests):
                if d != now:
                    for g in groups:
                        g.content = g.packed = None
                    done += groups
                    now, groups = d, []
                packed = packs[i].as_py()
                g = next((g for g in groups if g.packed == packed), None)
                if g is None:
                    content = normalised(unpack.decompress(packed))
                    g = next((g for g in groups if g.content == content), None)
                    if g is None:
                        g = _Group(content, packed)
                        groups.append(g)
                g.n += ns[i]
                if keyed:
                    g.keys += many[i] if many else [keys[i]]
                rank = (ids[i] is None, ids[i] or 0, keys[i])
                if g.rank is None or rank < g.rank:
                    g.rank, g.place, g.row = rank, i, None
            yield from finished(batch, done)
            for g in groups:
                if g.row is None:
                    g.row = batch.take(pa.array([g.place], pa.int64()))
        if groups:
            yield from finished(batch, groups)

    return lean(run)


def _combine(local: DataFrame, id_col: str, keyed: bool, own: T.StructType | None = None, text: str | None = None) -> DataFrame:
    """Salt winners, then winners, of the output of _local(); own and text: the last step's schema, with the text as it was."""
    n = width(local.sparkSession)
    schema = T.StructType([f for f in local.schema if f.name != f"{P}keys"])
    if keyed:
        schema = schema.add(f"{P}keys", T.ArrayType(T.LongType()))
    salted = local.repartition(n, f"{P}digest", f"{P}salt").sortWithinPartitions(f"{P}digest", f"{P}salt")
    winners = salted.mapInArrow(_merge(id_col, schema.names, keyed), schema)
    final = winners.repartition(n, f"{P}digest").sortWithinPartitions(f"{P}digest")
    out = own or schema
    return final.mapInArrow(_merge(id_col, out.names, keyed, text), out)


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    schema = T.StructType([T.StructField(f"{P}id", T.LongType()), T.StructField(f"{P}ids", T.ArrayType(T.LongType())), T.StructField(f"{P}digest", T.BinaryType()), T.StructField(f"{P}salt", T.IntegerType()), T.StructField(f"{P}n", T.LongType()), T.StructField(f"{P}key", T.LongType()), T.StructField(f"{P}text", T.BinaryType())])
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    local = stored(source.mapInArrow(_local("id", "text", salts, True), schema), "exact-local")
    won = _combine(local.drop(f"{P}ids"), f"{P}id", True)
    won = won.select(F.col(f"{P}id").alias("keep_id"), F.col(f"{P}key").alias("won"), F.col(f"{P}n").alias("group_size"), F.lower(F.hex(f"{P}digest")).alias("text_sha256"), F.explode(f"{P}keys").alias("key"))
    rows = local.select(F.col(f"{P}key").alias("key"), F.posexplode(f"{P}ids").alias("pos", "doc_id"))
    kept = (F.col("key") == F.col("won")) & (F.col("pos") == 0)
    return rows.join(won, "key").select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of docs that stay, with all their columns; the text travels compressed and comes back as it was."""
    names = docs.columns
    if not isinstance(docs.schema[id_col].dataType, (T.LongType, T.IntegerType)):
        raise TypeError(f"{id_col} must be an integer column")
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])  # own names, which no column of ours has
    fields = [f for f in docs.schema if f.name != text_col]
    schema = T.StructType(fields + [T.StructField(f"{P}null", T.BooleanType()), T.StructField(f"{P}digest", T.BinaryType()), T.StructField(f"{P}salt", T.IntegerType()), T.StructField(f"{P}n", T.LongType()), T.StructField(f"{P}key", T.LongType()), T.StructField(f"{P}text", T.BinaryType())])
    local = docs.mapInArrow(_local(id_col, text_col, salts, False), schema)
    return _combine(local, id_col, False, docs.schema, text_col).toDF(*names)
