"""Token ids of documents in sorted-string-table shards.

A shard holds documents in ascending order of their identifier:

* data blocks, each compressed by itself: entries ``shared, unshared, length`` (unsigned LEB128), the key's last ``unshared``
  bytes and the value, where a key is the identifier as 8 big-endian bytes with its sign bit turned; every 16th entry is
  a restart with a whole key, and the places of the restarts (32 bits each, then their number) end the block;
* a sparse index with, for each block, its last key, place, size, documents, and ids before it in the shard;
* a Bloom filter over all keys, with ten bits for each;
* a footer of fixed size with the places of index and filter, totals, the width of an id, and a magic number.

``lookup`` asks the filter, then the index and the restarts by binary search, and reads one block. Executors write shards
into the shared folder through pyarrow's file systems, under a name of their own, renamed when complete; only shards in the
manifest that Spark commits count, so a task that runs twice leaves a spare file and nothing else.

Null texts are empty. Rows that share a doc_id count as one document, the one with the greatest text; a null doc_id is such
a document and comes first. Extra columns are ignored; an empty table gives no shards.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .blocks import NULL_ID, lean, shared_dir, single, stored, width
from .subwords import default_path, subwords

#: Bytes of values after which a block ends; entries from one restart to the next; bits of the filter for each key.
BLOCK, RESTART, BITS, PROBES = 256 << 10, 16, 10, 7
MAGIC = b"PWSST\x00\x00\x01"
_INDEX = struct.Struct("<8sQIIQ")
_FOOTER = struct.Struct("<QQQQQQI4x8s")
END = 0


def key_of(doc_id: int) -> bytes:
    return (doc_id + (1 << 63)).to_bytes(8, "big")


def id_of(key: bytes) -> int:
    return int.from_bytes(key, "big") - (1 << 63)


def _leb(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _unleb(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & 0xFFFFFFFFFFFFFFFF, h >> 64 | 1
    return [(a + i * b & 0xFFFFFFFFFFFFFFFF) % bits for i in range(PROBES)]


class Writer:
    """Writes one shard; keys must come in ascending order."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.at = self.docs = self.ids = 0
        self.block, self.size, self.restarts, self.entries = bytearray(), 0, [], 0
        self.last, self.block_ids = b"", 0
        self.index: list[bytes] = []
        self.keys: list[bytes] = []
        self.pack = zstandard.ZstdCompressor(level=1)
        self.first = self.top = None

    def add(self, doc_id: int, ids: bytes) -> None:
        key = key_of(doc_id)
        if self.keys and key <= self.last:
            raise ValueError("keys must ascend")
        shared = 0
        if self.entries % RESTART == 0:
            self.restarts.append(len(self.block))
        else:
            while shared < 8 and key[shared] == self.last[shared]:
                shared += 1
        self.block += _leb(shared) + _leb(8 - shared) + _leb(len(ids)) + key[shared:] + ids
        self.first = doc_id if self.first is None else self.first
        self.last, self.top = key, doc_id
        self.keys.append(key)
        self.entries += 1
        self.docs += 1
        self.block_ids += len(ids) // self.width
        if len(self.block) >= BLOCK:
            self._end_block()

    def _end_block(self) -> None:
        if not self.entries:
            return
        body = bytes(self.block) + b"".join(struct.pack("<I", r) for r in self.restarts) + struct.pack("<I", len(self.restarts))
        packed = self.pack.compress(body)
        self.out.write(packed)
        self.index.append(_INDEX.pack(self.last, self.at, len(packed), self.entries, self.ids))
        self.at += len(packed)
        self.ids += self.block_ids
        self.block, self.restarts, self.entries, self.block_ids = bytearray(), [], 0, 0

    def close(self) -> None:
        self._end_block()
        bits = max(64, BITS * len(self.keys)) + 7 & ~7
        bloom = bytearray(bits // 8)
        for key in self.keys:
            for b in _probes(key, bits):
                bloom[b >> 3] |= 1 << (b & 7)
        index = b"".join(self.index)
        self.out.write(index)
        self.out.write(bytes(bloom))
        self.out.write(_FOOTER.pack(self.at, len(index), self.at + len(index), len(bloom), self.docs, self.ids, self.width, MAGIC))


def entries(body: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(key, ids) of a decompressed block."""
    end = len(body) - 4 - 4 * struct.unpack_from("<I", body, len(body) - 4)[0]
    at, key = 0, b""
    while at < end:
        shared, at = _unleb(body, at)
        own, at = _unleb(body, at)
        size, at = _unleb(body, at)
        key = key[:shared] + body[at : at + own]
        at += own
        yield key, body[at : at + size]
        at += size


class Reader:
    """Reads one shard: all of it in order, or one document by its identifier."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        foot = _FOOTER.unpack(self._read(size - _FOOTER.size, _FOOTER.size))
        if foot[-1] != MAGIC:
            raise ValueError("not a shard")
        at, n, self.bloom_at, self.bloom_n, self.docs, self.ids, self.width = foot[:-1]
        raw = self._read(at, n)
        self.blocks = [_INDEX.unpack_from(raw, k) for k in range(0, n, _INDEX.size)]
        self.bloom: bytes | None = None

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _body(self, block) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self._read(block[1], block[2]))

    def __iter__(self) -> Iterator[tuple[int, int, bytes]]:
        """(doc_id, ids before it in the shard, ids)."""
        for block in self.blocks:
            before = block[4]
            for key, ids in entries(self._body(block)):
                yield id_of(key), before, ids
                before += len(ids) // self.width

    def maybe(self, doc_id: int) -> bool:
        self.bloom = self.bloom or self._read(self.bloom_at, self.bloom_n)
        return all(self.bloom[b >> 3] >> (b & 7) & 1 for b in _probes(key_of(doc_id), 8 * self.bloom_n))

    def lookup(self, doc_id: int) -> np.ndarray | None:
        """The ids of one document, or None: filter, index, restarts, then at most RESTART entries."""
        if not self.maybe(doc_id):
            return None
        key = key_of(doc_id)
        k = bisect_left(self.blocks, key, key=lambda b: b[0])
        if k == len(self.blocks):
            return None
        body = self._body(self.blocks[k])
        count = struct.unpack_from("<I", body, len(body) - 4)[0]
        places = struct.unpack_from(f"<{count}I", body, len(body) - 4 - 4 * count)

        def head(place: int) -> bytes:
            at = place
            for _ in range(3):
                _, at = _unleb(body, at)
            return body[at : at + 8]

        low, high = 0, count - 1
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if head(places[mid]) <= key else (low, mid - 1)
        end = places[low + 1] if low + 1 < count else len(body) - 4 - 4 * count
        at, now = places[low], b""
        while at < end:
            shared, at = _unleb(body, at)
            own, at = _unleb(body, at)
            size, at = _unleb(body, at)
            now = now[:shared] + body[at : at + own]
            at += own
            if now == key:
                return np.frombuffer(body, np.uint16 if self.width == 2 else np.uint32, size // self.width, at)
            at += size
        return None


def _opened(path: str):
    """pyarrow's file system for a path as Spark writes it: a plain path, file:/x, s3a:// (s3:// there) or another scheme."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        local = (rest if colon else path)
        return pafs.LocalFileSystem(), local[2:] if local.startswith("//") else local
    return pafs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else path)


_MANIFEST = "path string, first long, last long, docs long, ids long, bytes long"


def _write(folder: str, tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords(tokenizer)
        end = np.array([END], encoder.kind).tobytes()
        part = TaskContext.get().partitionId()
        out = writer = None
        for batch in batches:
            ids, found = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(ids), 256):
                for i, e in zip(ids[at : at + 256], encoder.encode(found.slice(at, 256).to_pylist())):
                    if writer is None:
                        path = f"{folder}/shard-{part:06d}-{uuid.uuid4().hex}.sst"
                        fs, where = _opened(path)
                        fs.create_dir(where.rpartition("/")[0], recursive=True)
                        out = fs.open_output_stream(where + ".tmp")
                        writer = Writer(out, encoder.kind().itemsize)
                    writer.add(i, e + end)
        if writer is None:
            return
        writer.close()
        size = out.tell()
        out.close()
        fs.move(where + ".tmp", where)
        yield pa.RecordBatch.from_pydict({c.split()[0]: pa.array([v], pa.string() if "string" in c else pa.int64()) for c, v in zip(_MANIFEST.split(", "), (path, writer.first, writer.top, writer.docs, writer.ids, size))})

    return lean(run)


def write_shards(docs: DataFrame, tokenizer: str | None = None, folder: str | None = None) -> DataFrame:
    """Encodes and writes every document; the manifest: path, first, last, docs, ids, bytes of each shard."""
    folder = folder or f"{shared_dir(docs.sparkSession)}/pagewarden/sst-{uuid.uuid4().hex}"
    ordered = single(docs).repartitionByRange(width(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    return stored(ordered.mapInArrow(_write(folder, tokenizer or default_path()), _MANIFEST), "sst-manifest")


@lean
def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
            fs, where = _opened(path)
            with fs.open_input_file(where) as source:
                rows = []
                reader = Reader(source)
                for doc, before, ids in reader:
                    wide = ids if reader.width == 4 else np.frombuffer(ids, np.uint16).astype("<u4").tobytes()
                    rows.append((None if doc == NULL_ID else doc, base + before, len(ids) // reader.width, zlib.crc32(wide)))
                    if len(rows) == 5000:
                        yield _out(rows)
                        rows = []
                if rows:
                    yield _out(rows)


def _out(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(("doc_id", "start", "n_tokens", "ids_crc32"), zip(*rows))})


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document of the shards: doc_id, start (ids before it in the whole order), n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    shards, total = [], 0
    for row in manifest.orderBy("first").select("path", "ids").collect():  # one row for each shard
        shards.append((row.path, total))
        total += row.ids
    listed = spark.createDataFrame(shards, "path string, base long")
    return listed.repartition(max(1, min(len(shards), width(spark))), "path").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
