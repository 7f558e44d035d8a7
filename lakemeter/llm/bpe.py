"""Byte-level BPE encoding and decoding (operator 1).

A vocabulary is a rank file (base64 token, rank).  A text is cut by a pattern; each match is
encoded on its own: a segment tree over its byte positions holds, for every live token, the
rank of the pair it forms with its right neighbour, so the root is the leftmost pair of least
rank; a merge changes three leaves (the merged token, its left neighbour, the token that went)
and the paths above them, so a match of n bytes takes O(n log n) whatever its length.

Cases: null or empty text -> no ids; ids outside the vocabulary raise ``KeyError`` in ``decode``;
every row gives one row; columns of the input other than the id and the text are not carried.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemeter.llm.texts import release

#: matches kept with their ids in each worker; the memory is emptied when full
CACHE_ENTRIES = 200_000
CACHE_BYTES = 64
#: matches up to this size are merged many at a time, longer ones alone
SHARED_BYTES = 64
#: texts encoded at a time
ROWS = 256
_NONE = np.int64(1 << 62)

_loaded: dict[tuple[str, str], "Vocabulary"] = {}
_decoders: dict[str, "Decoder"] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class Vocabulary:
    """Encoder and decoder of one rank file and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)
        self.id_bytes = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        # A single space between other characters always begins a match, so texts are cut there
        # first; only a space that stands inside a longer run of white space may not be one.
        self.odd_space = re.compile(r"\s (?:\s|\Z)")
        self.heads: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}
        pairs = {(ranks[t[:i]] << 32) | ranks[t[i:]]: rank for t, rank in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        del pairs
        self.byte_ids = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)

    @classmethod
    def load(cls, path: str, pattern: str) -> "Vocabulary":
        if (path, pattern) not in _loaded:
            _loaded[path, pattern] = cls(load_ranks(path), pattern)
        return _loaded[path, pattern]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for cache in (self.heads, self.tails, self.pieces):
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
        parts = [None if self.odd_space.search(x) else x.split(" ") for x in texts]
        heads = {x[0] for x in parts if x}.difference(self.heads)
        tails = set().union(*[x[1:] for x in parts if x]).difference(self.tails)
        whole = [x for x, cuts in zip(texts, parts) if cuts is None]
        found = [[x.encode("utf-8", "surrogatepass") for x in cut(self.pattern, text)]
                 for text in [*heads, *(" " + x for x in tails), *whole]]
        learnt = {x for pieces in found for x in pieces}.difference(self.pieces)
        self._learn(learnt)
        get = self.pieces.__getitem__
        done = [b"".join(map(get, x)) for x in found]
        self.heads.update(zip(heads, done))
        self.tails.update(zip(tails, done[len(heads):]))
        rest = iter(done[len(heads) + len(tails):])
        tail = self.tails.__getitem__
        out = [next(rest) if x is None else self.heads[x[0]] + b"".join(map(tail, x[1:])) for x in parts]
        for cache, new in ((self.heads, heads), (self.tails, tails), (self.pieces, learnt)):
            for key in new:
                if len(key) > CACHE_BYTES:
                    del cache[key]
        return out

    def pieces_of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each byte string as one match, not remembered."""
        own, self.pieces = self.pieces, {}
        self._learn(set(pieces))
        found = [self.pieces[x] for x in pieces]
        self.pieces = own
        return found

    def _learn(self, pieces: set[bytes]) -> None:
        self.pieces.update((x, self.id_bytes[x]) for x in pieces if x in self.id_bytes)
        new = [x for x in pieces if x not in self.id_bytes]
        by_size: dict[int, list[bytes]] = {}
        for x in new:
            by_size.setdefault(max(4, 1 << (len(x) - 1).bit_length()), []).append(x)
        for size, group in by_size.items():
            if size > SHARED_BYTES or self.byte_ids.min() < 0:
                for x in group:
                    self.pieces[x] = b"".join([self.id_bytes[t] for t in merge(x, self.ranks, self.longest)])
            else:
                for at in range(0, len(group), 8_000):
                    some = group[at:at + 8_000]
                    self.pieces.update(zip(some, self.merge_many(some, size)))

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 without one."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merge_many(self, pieces: list[bytes], size: int) -> list[bytes]:
        """``merge`` for many short matches at once: one segment tree of ``size`` leaves per row."""
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        rows = np.arange(len(pieces))
        text = np.frombuffer(b"".join([x.ljust(size, b"\0") for x in pieces]), np.uint8).reshape(-1, size)
        token = np.concatenate([self.byte_ids[text], np.zeros((len(pieces), 1), np.int64)], axis=1)
        place = np.arange(size)
        rank = self._pair(token[:, :size - 1], token[:, 1:size])
        tree = np.full((len(pieces), 2 * size), _NONE)
        tree[:, size:-1] = np.where((rank < 0) | (place[:-1] + 1 >= n[:, None]), _NONE, rank * size + place[:-1])
        for i in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1], out=tree[:, i])
        after = np.minimum(np.tile(np.arange(1, size + 2), (len(pieces), 1)), n[:, None])
        before = np.tile(np.arange(-1, size), (len(pieces), 1))
        live = place < n[:, None]
        row = rows[tree[:, 1] < _NONE]

        def update(leaf, value):
            node = leaf + size
            tree[row, node] = value
            while node[0] > 1:
                node = node >> 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

        while len(row):
            best = tree[row, 1]
            at = best & (size - 1)
            gone = after[row, at]
            nxt = after[row, gone]
            token[row, at] = best // size
            live[row, gone] = False
            after[row, at] = nxt
            before[row, nxt] = at
            update(gone, _NONE)
            rank = self._pair(token[row, at], token[row, np.minimum(nxt, size)])
            update(at, np.where((nxt >= n[row]) | (rank < 0), _NONE, rank * size + at))
            left = before[row, at]
            rank = self._pair(token[row, left], token[row, at])
            # without a left neighbour the leaf keeps its value
            spot = np.where(left < 0, at, left)
            update(spot, np.where(left < 0, tree[row, at + size], np.where(rank < 0, _NONE, rank * size + left)))
            row = row[tree[row, 1] < _NONE]
        ids = token[:, :size][live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class Decoder:
    """Ids back to bytes; it holds the tokens alone."""

    def __init__(self, ranks: dict[bytes, int]):
        self.token = {rank: token for token, rank in ranks.items()}

    @classmethod
    def load(cls, path: str) -> "Decoder":
        if path not in _decoders:
            _decoders[path] = cls(load_ranks(path))
        return _decoders[path]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_PLAIN = re.compile("[^\u0000-\u0500]")
_newer: dict[int, int] = {}


def newer_characters() -> dict[int, int]:
    """Letters and numbers of ``regex`` that the tiktoken library, with its own edition of
    Unicode, takes for neither: each is mapped to a private-use character, which is neither too."""
    if not _newer:
        import regex
        import tiktoken

        text = "".join(map(chr, [*range(0x500, 0xD800), *range(0xE000, 0x110000)]))
        single = {bytes([i]): i for i in range(256)}
        for kind in (r"\p{L}", r"\p{N}"):
            other = tiktoken.Encoding("characters", pat_str=kind, mergeable_ranks=single, special_tokens={})
            known = set(bytes(other.encode_ordinary(text)).decode())
            _newer.update((ord(x), 0xE000) for x in regex.findall(kind, text) if x not in known)
        _newer.setdefault(0xE000, 0xE000)
    return _newer


def cut(pattern, text: str) -> list[str]:
    """The pattern's matches in order."""
    if not _PLAIN.search(text):
        return pattern.findall(text)
    return [text[x.start():x.end()] for x in pattern.finditer(text.translate(newer_characters()))]


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[bytes]:
    """The tokens of one match.  Leaves hold ``rank * size + position``, so a minimum is leftmost."""
    n = len(piece)
    if n < 2:
        return [piece] if n else []
    size = 1 << (n - 1).bit_length()
    none = (1 << 62)
    get = ranks.get
    leaves = []
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        leaves.append(none if rank is None else rank * size + i)
    tree = [none] * size + leaves + [none] * (size - n + 1)
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after = list(range(1, n + 1))  # start of the next live token
    before = list(range(-1, n - 1))
    low = size - 1
    while (best := tree[1]) < none:
        at = best & low
        gone = after[at]
        nxt = after[gone]
        after[at] = nxt
        if nxt < n:
            before[nxt] = at
        changes = [(gone, none)]
        rank = None
        if nxt < n and (end := after[nxt]) - at <= longest:
            rank = get(piece[at:end])
        changes.append((at, none if rank is None else rank * size + at))
        if (left := before[at]) >= 0:
            rank = get(piece[left:nxt]) if nxt - left <= longest else None
            changes.append((left, none if rank is None else rank * size + left))
        for leaf, value in changes:
            i = size + leaf
            tree[i] = value
            while i > 1:
                other = tree[i ^ 1]
                i >>= 1
                if other < value:
                    value = other
                if tree[i] == value:
                    break
                tree[i] = value
    out, at = [], 0
    while at < n:
        out.append(piece[at:after[at]])
        at = after[at]
    return out


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """(id, token_ids): the ids of each whole text as little-endian unsigned 32-bit integers.

    ``decoded``: also the bytes that the ids decode to, in the same pass (one Python worker a task)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.load(path, pattern)
        back = Decoder.load(path) if decoded else None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                ids = vocabulary.encode_many([x or "" for x in some.column(1).to_pylist()])
                columns = {id_col: some.column(0), "token_ids": pa.array(ids, pa.binary())}
                if back:
                    columns["decoded"] = pa.array([back.decode(x) for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            release()

    schema = f"`{id_col}` {kind}, token_ids binary" + ", decoded binary" * decoded
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``encode``'s rows with ``decoded``, the bytes that the ids stand for (null ids: empty)."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder.load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                texts = [decoder.decode(x.as_py() or b"") for x in some.column(1)]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.binary())], names=[id_col, "token_ids", "decoded"])

    return encoded.select(F.col(id_col), F.col("token_ids")).mapInArrow(run, f"`{id_col}` {kind}, token_ids binary, decoded binary")


def digests(decoded: DataFrame, id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of ``decode``'s rows, and the ids themselves if wanted."""
    return decoded.select(
        F.col(id_col), (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        *([F.col("token_ids")] if keep_ids else []))
