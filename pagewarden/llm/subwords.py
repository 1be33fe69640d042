"""Subword ids of whole texts, through tiktoken, or through tokenizers with the encodings of space-delimited chunks kept."""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Chunks whose ids one process keeps at most in each of two generations.
KEPT = 300_000
#: Characters of a text that are cut into chunks at once.
PIECE = 1 << 20


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizers(path: str):
    """The library's encoder, and its model, which takes pieces as they are."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, tokenizer.model


#: Pieces that the splitting of a text cannot change, whatever is around them: runs of Latin letters, of digits, and of ASCII
#: marks (without the apostrophe), and single line feeds between them.
_RUNS = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]++|[0-9]++|[!-&(-/:-@\[-`{-~]++"
_PLAIN = re.compile(rf"(?:{_RUNS})(?:\n?(?:{_RUNS}))*+\Z")
_PIECE = re.compile(rf"{_RUNS}|\n")
#: How a byte-level vocabulary shows the bytes that are no visible character of their own: as the characters from 256 on.
_SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))}
_SPACE = chr(_SHOWN[32])
#: The same as a decoding table; spaces stay, as they part the chunks.
_TABLE = "".join(" " if b == 32 else chr(_SHOWN.get(b, b)) for b in range(256))


def _ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _tiktoken(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(path), special_tokens={}).encode_ordinary


def begins_with_space(path: str) -> np.ndarray:
    """For each id whether it begins with a space; room for one id more, which ends a text. A new array at each call."""
    if path.endswith(".tiktoken"):
        ranks = _ranks(path)
        out = np.zeros(max(ranks.values()) + 2, bool)
        out[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        return out
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
    return out


class _Kept:
    """Ids of chunks in two generations: a full table becomes the old one, whose entries move up when they are met again."""

    def __init__(self, most: int):
        self.now: dict = {}
        self.old: dict = {}
        self.most = most

    def missing(self, chunks: set) -> list:
        """Makes room, moves up what the old generation has, and says what neither has."""
        new = chunks - self.now.keys()
        if len(self.now) + len(new) > self.most:
            self.old, self.now = self.now, {}
            new = chunks
        known = new & self.old.keys()
        for c in known:
            self.now[c] = self.old[c]
        return list(new - known)


class Subwords:
    """Encodes with the tokenizers library. A byte-level BPE never merges over a space between two other characters, so
    chunks from one such space to the next are encoded apart and their ids kept. Chunks to be learned are encoded as one
    text and told apart by the space that only their first id holds."""

    def __init__(self, path: str, kept: int = KEPT):
        self.ids, self.model = _tokenizers(path)
        self.short: dict[str, list[int]] = {}  # ids of pieces of one ASCII character
        self.spaced = begins_with_space(path)
        self.first, self.later = _Kept(kept // 4), _Kept(kept)
        self.kind = np.uint16 if len(self.spaced) <= 1 << 16 else np.uint32

    def _one(self, text: str) -> bytes:
        return np.array(self.ids(text), self.kind).tobytes()

    def _spaced(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk with a space before it. Chunks of plain pieces go to the library's model piece by piece."""
        plain, rest = [], []
        match = _PLAIN.match
        for c in chunks:
            (plain if match(c) else rest).append(c)
        got = dict(zip(rest, self._joined(rest)))
        for at in range(0, len(plain), 20_000):
            some = plain[at : at + 20_000]
            got.update(zip(some, self._plain(some)))
        return [got[c] for c in chunks]

    def _plain(self, chunks: list[str]) -> list[bytes]:
        tokenize, find, short, space = self.model.tokenize, _PIECE.findall, self.short, _SPACE
        flat: list[int] = []
        edge = [0]
        for c, shown in zip(chunks, _shown(" ".join(chunks)).split(" ")):
            if c.isalpha():
                flat += [t.id for t in tokenize(space + shown)]
            else:
                before = space
                for piece in find(c):
                    if len(piece) == 1 and piece.isascii():
                        piece = before + piece
                        if piece not in short:
                            short[piece] = [t.id for t in tokenize(before + _shown(piece[-1]))]
                        flat += short[piece]
                    else:
                        flat += [t.id for t in tokenize(before + (piece if piece.isascii() else _shown(piece)))]
                    before = ""
            edge.append(len(flat))
        raw, wide = np.array(flat, self.kind).tobytes(), self.kind().itemsize
        return [raw[a * wide : b * wide] for a, b in zip(edge, edge[1:])]

    def _joined(self, chunks: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(chunks), 2000):
            some = chunks[at : at + 2000]
            ids = np.array(self.ids(" " + " ".join(some)), self.kind)
            begin = np.flatnonzero(self.spaced[ids])
            if len(begin) == len(some):
                raw, wide = ids.tobytes(), ids.itemsize
                edge = (np.append(begin, len(ids)) * wide).tolist()
                out += [raw[a:b] for a, b in zip(edge, edge[1:])]
            else:
                out += [self._one(" " + c) for c in some]
        return out

    def _learn(self, kept: _Kept, chunks: set[str]) -> None:
        new = kept.missing(chunks)
        odd = [c for c in new if not c or c[-1].isspace() or c[0].isspace() or " " in c]
        plain = list(set(new) - set(odd)) if odd else new
        kept.now.update(zip(plain, self._spaced(plain)))
        kept.now.update((c, self._one(" " + c)) for c in odd)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``kind``."""
        pieces, owner = [], []
        for i, text in enumerate(texts):
            for piece in _pieces(text):
                pieces.append(piece)
                owner.append(i)
        out: list[list[bytes]] = [[] for _ in texts]
        for at in range(0, len(pieces), 500):
            for i, ids in zip(owner[at : at + 500], self._encode(pieces[at : at + 500])):
                out[i].append(ids)
        return [b"".join(x) if len(x) != 1 else x[0] for x in out]

    def _encode(self, pieces: list[tuple[bool, str]]) -> list[bytes]:
        split = [_CUT.split(p) if _unsafe(p) else p.split(" ") for _, p in pieces]
        begun = {s[0] for s, (begins, _) in zip(split, pieces) if begins}
        fresh = self.first.missing(begun)
        self.first.now.update((c, self._one(c)) for c in fresh)
        self._learn(self.later, set().union(*(s[1:] if begins else s for s, (begins, _) in zip(split, pieces))))
        get = self.later.now.__getitem__
        return [(self.first.now[s[0]] if begins else get(s[0])) + b"".join(map(get, s[1:])) for s, (begins, _) in zip(split, pieces)]


#: A space between two other characters.
_CUT = re.compile(r"(?<=\S) (?=\S)")
BLANKS = tuple(c for c in map(chr, range(0x3001)) if c.isspace())


def _unsafe(text: str) -> bool:
    """Whether a space is beside white space or at an end."""
    return text[:1] == " " or text[-1:] == " " or any(c + " " in text or " " + c in text for c in BLANKS if c in text)


def _pieces(text: str) -> list[tuple[bool, str]]:
    """Parts of a long text with whether each is the first; parts are cut at a space between two other characters."""
    out, at = [], 0
    while len(text) - at > PIECE and (cut := _CUT.search(text, at + PIECE)):
        out.append((at == 0, text[at : cut.start()]))
        at = cut.end()
    return [*out, (at == 0, text[at:])]


def _shown(text: str) -> str:
    return codecs.charmap_decode(text.encode(), "strict", _TABLE)[0]


@lru_cache(maxsize=1)
def subwords(path: str) -> Subwords:
    """The process's encoder of a .json vocabulary; what it has learned, bounded by KEPT, serves its later tasks too."""
    return Subwords(path)


@lru_cache(maxsize=1)
def plain_ids(path: str) -> Callable[[str], list[int]]:
    """The encoder of a .tiktoken vocabulary, which needs no table of its own to be fast."""
    return _tiktoken(path)


def counter(path: str) -> Callable[[str], int]:
    """How many ids a text has."""
    if path.endswith(".tiktoken"):
        ids = plain_ids(path)
        return lambda text: sum(len(ids(piece)) for _, piece in _pieces(text))
    encoder = subwords(path)
    return lambda text: len(encoder.encode([text])[0]) // encoder.kind().itemsize
