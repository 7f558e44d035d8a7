"""BPE encoding and decoding with word ends (operator 11).

A vocabulary is a tokenizer file (JSON: added tokens, normalizer, pre-tokenizer, vocabulary and
merges).  A text is cut at white space, each chunk is cut at added tokens, brought to its normal form
and lower case and cut by the file's pattern; the symbols of a match are its bytes, the last one with
the end-of-word mark.  ``merge`` keeps the symbols in a doubly linked list and the ranks of
neighbouring pairs in a priority queue: the least rank (leftmost first) is taken, an entry whose pair
has changed since is stale and skipped, and a merge queues the two pairs that it makes: O(n log n) for
n bytes, whatever their length.  Decoding joins the vocabulary strings of the ids.

No step of this kind of file looks across white space, so chunks are encoded apart, and a bounded number of
them is remembered in each worker.

Cases: null or empty text, or one without any match -> no ids and an empty decoded text; the string of an
added token inside a text becomes its id; ids outside the vocabulary raise ``KeyError`` in ``decode``;
equal texts give equal ids; a text of any length is one row, and one without white space is one chunk;
every row gives one row, an empty table none; columns other than the id and the text are not carried.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemeter.llm.texts import release

#: chunks and matches remembered in each worker (two generations of each), up to ``CACHE_BYTES`` each
CACHED_CHUNKS = 400_000
CACHED_WORDS = 200_000
CACHE_BYTES = 64
#: texts encoded at a time
ROWS = 256

_PLAIN = re.compile("[^\u0000-\u0500]")
_loaded: dict[str, "Tokenizer"] = {}


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 characters
    stand for themselves, the other bytes in order for the characters from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Memory(dict):
    """Results by key; a missing one is made by ``make`` and kept if its key is short.

    Two generations of up to ``size`` entries: when the younger is full it becomes the elder, and what is
    asked for again moves back, so frequent keys outlive rare ones."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.elder = make, size, {}

    def __missing__(self, key):
        value = self.elder.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= CACHE_BYTES:
            if len(self) >= self.size:
                self.elder = dict(self)
                self.clear()
            self[key] = value
        return value


class Tokenizer:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, file: dict):
        import regex

        model, pre = file["model"], file["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in file["normalizer"]["normalizers"]]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        if kinds != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in pre] != ["Split", "ByteLevel"] or not plain \
                or pre[0]["behavior"] != "Removed" or not pre[0]["invert"] or pre[1]["use_regex"] or pre[1]["add_prefix_space"] \
                or file["decoder"] or any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] or re.search(r"\s", x["content"])
                                          for x in file["added_tokens"]):
            raise ValueError("not a BPE file with word ends of the supported kind")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        symbols = byte_symbols()
        self.inner = [vocab[x] for x in symbols]
        self.last = [vocab[x + end] for x in symbols]
        self.token = {i: x.encode() for x, i in vocab.items()}
        self.added = {x["content"]: x["id"] for x in file["added_tokens"]}
        self.token.update((i, x.encode()) for x, i in self.added.items())
        self.find_added = re.compile("|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        pattern = pre[0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.classes = re.findall(r"\\p\{\w+\}", pattern)
        # the same pattern for lower-case ASCII text; a chunk of letters alone is one match of it
        for kind, plain in ((r"\p{L}", "a-z"), (r"\p{N}", "0-9"), (r"\s", r" \t\n\r\f\v")):
            pattern = pattern.replace(kind, plain)
        self.ascii_pattern = re.compile(pattern) if "\\p" not in pattern else None
        self.letters_are_one = self.ascii_pattern is not None and self.ascii_pattern.findall("abcdefghijklmnopqrstuvwxyz") == ["abcdefghijklmnopqrstuvwxyz"]
        self.pairs: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[vocab[a], vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.unlike: dict[int, int | str] | None = None
        self.chunks = _Memory(self._chunk, CACHED_CHUNKS)
        self.words = _Memory(self._word, CACHED_WORDS)

    @classmethod
    def load(cls, path: str) -> "Tokenizer":
        if path not in _loaded:
            with open(path, encoding="utf-8") as file:
                _loaded[path] = cls(json.load(file))
        return _loaded[path]

    def encode(self, text: bytes) -> bytes:
        """The ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def decode(self, ids: bytes) -> bytes:
        """The vocabulary strings of the ids, joined by one space (the file names no decoder)."""
        return b" ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _chunk(self, chunk: bytes) -> bytes:
        if self.letters_are_one and chunk.isalpha():  # ASCII letters only
            return self.words[chunk.lower()]
        text = chunk.decode("utf-8", "surrogatepass")
        out, at = [], 0
        for found in self.find_added.finditer(text):
            out += self._matches(text[at:found.start()])
            out.append(self.added[found.group()].to_bytes(4, "little"))
            at = found.end()
        out += self._matches(text[at:])
        return b"".join(out)

    def _matches(self, text: str) -> list[bytes]:
        words = self.words
        if text.isascii() and self.ascii_pattern:
            return [words[x.encode()] for x in self.ascii_pattern.findall(text.lower())]
        if not _PLAIN.search(text):
            # lower case character by character: the end of a word has no rule of its own
            text = "".join(map(str.lower, unicodedata.normalize("NFC", text)))
            cuts = self.pattern.findall(text)
        else:
            text = self._normal(text)
            cuts = [text[x.start():x.end()] for x in self.pattern.finditer(text.translate(self._unlike()))]
        return [words[x.encode("utf-8", "surrogatepass")] for x in cuts]

    def _normal(self, text: str) -> str:
        """Normal form and lower case of a chunk with characters past U+0500, by the library's edition of Unicode."""
        from tokenizers import normalizers as N

        return N.Lowercase().normalize_str(N.NFC().normalize_str(text))

    def _unlike(self) -> dict[int, int]:
        """Characters in one of the pattern's classes for ``regex``, but in none for the library, whose
        edition of Unicode is older: each is mapped to a private-use character, which is in none either."""
        if self.unlike is None:
            import regex
            from tokenizers import Regex
            from tokenizers.pre_tokenizers import Split

            text = "".join(map(chr, [*range(0x500, 0xD800), *range(0xE000, 0x110000)]))
            self.unlike = {}
            for kind in set(self.classes):
                known = set("".join(x for x, _ in Split(Regex(kind + "+"), "removed", invert=True).pre_tokenize_str(text)))
                self.unlike.update((ord(x), 0xE000) for x in regex.findall(kind, text) if x not in known)
        return self.unlike

    def _word(self, word: bytes) -> bytes:
        symbols = [*map(self.inner.__getitem__, word)]
        symbols[-1] = self.last[word[-1]]
        ids = array("I", self.merge(symbols))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def merge(self, symbols: list[int]) -> list[int]:
        """The ids of one match.  Queue entries hold ``rank * n + position``, so equal ranks go leftmost first."""
        n = len(symbols)
        get = self.pairs.get
        queue = []
        for i, pair in enumerate(zip(symbols, symbols[1:])):
            rank = get(pair)
            if rank is not None:
                queue.append(rank * n + i)
        if not queue:
            return symbols
        made = self.made
        ahead = list(range(1, n + 1))
        behind = list(range(-1, n - 1))
        heapify(queue)
        while queue:
            rank, at = divmod(heappop(queue), n)
            right = ahead[at]
            # stale: the symbol is gone (-1), is the last one, or its pair has another rank by now
            if right >= n or get((symbols[at], symbols[right])) != rank:
                continue
            token = symbols[at] = made[rank]
            symbols[right] = -1
            after = ahead[at] = ahead[right]
            if after < n:
                behind[after] = at
                new = get((token, symbols[after]))
                if new is not None:
                    heappush(queue, new * n + at)
            left = behind[at]
            if left >= 0:
                new = get((symbols[left], token))
                if new is not None:
                    heappush(queue, new * n + left)
        return [x for x in symbols if x >= 0]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, token_ids): the ids of each whole text as little-endian unsigned 32-bit integers.

    ``decoded``: also the text that the ids decode to (UTF-8), in the same pass (one Python worker a task)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                ids = [tokenizer.encode(x) if x else b"" for x in some.column(1).cast(pa.binary()).to_pylist()]
                columns = {id_col: some.column(0), "token_ids": pa.array(ids, pa.binary())}
                if decoded:
                    columns["decoded"] = pa.array(map(tokenizer.decode, ids), pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            release()

    schema = f"`{id_col}` {kind}, token_ids binary" + ", decoded binary" * decoded
    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``encode``'s rows with ``decoded``, the text that the ids stand for (null ids: empty)."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                texts = [tokenizer.decode(x or b"") for x in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.binary())], names=[id_col, "token_ids", "decoded"])

    return encoded.select(F.col(f"`{id_col}`"), F.col("token_ids")).mapInArrow(run, f"`{id_col}` {kind}, token_ids binary, decoded binary")
