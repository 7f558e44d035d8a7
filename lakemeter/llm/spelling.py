"""Spelling variants: words one edit apart, each pointing at a much more frequent neighbour (operator 12).

Every edit of a word is probed against Bloom filters of the vocabulary, one filter for each word
length, blocked so that a probe reads one 64-bit block.  The filters are broadcast; only probes that
hit leave the task, and an exact join with the vocabulary removes the false ones.  A pair of words is
probed once: the longer word deletes a code point (the last one of a run of equal ones), and of two
words of one length the one with the larger code point replaces it by the smaller.

Bounds: a filter slice holds ``Limits.slice_words`` words, and a pass broadcasts at most ``pass_slices`` times
as many (two bytes a word, 32 MB); a larger vocabulary takes more passes, each over the words whose edits
have a length of that pass.  Lengths from ``longest`` on share a filter.  A word has at most its length
times ``len(alphabet)`` edits, which are made ``PROBES`` at a time, so no group of pairs grows with the
corpus.  Counts are combined in each task before they are shuffled.

Cases: null or empty text -> no words; a null id is the empty text in the damage; a row that repeats
counts again; runs of any length are words; an empty table, or one without frequent words, gives no rows;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemeter.llm.texts import mix, release
from lakemeter.session import Scratch, settle

#: code points of words, beside a-z: all of them, as ranges
ALPHABET = "a-zÀ-ÿ"
PROBES = 1 << 20
_BITS = 4
_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))
_CODE = np.random.Generator(np.random.PCG64(20240312)).integers(1, 2 ** 63, 256, dtype=np.uint64)


class Limits(NamedTuple):
    """Sizes that bound memory; results don't depend on them."""
    #: distinct words counted in a task before they are sent on
    counted: int = 200_000
    #: words of a filter slice, and slices' worth of words broadcast in a pass
    slice_words: int = 4_000_000
    pass_slices: int = 4
    #: words of this length and longer share filters
    longest: int = 64

    def shard(self, length: int) -> int:
        return min(length, self.longest)


# -- words -----------------------------------------------------------------------------------
def damage(doc_id: int | None, runs: Counter, every: int) -> Iterator[tuple[str, int]]:
    """(word, occurrences): a run loses one code point where ``every`` divides its checksum."""
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), head)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        yield run, n


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6,
                least_count: int = 5, every: int = 199, limits: Limits = Limits()) -> DataFrame:
    """(word, n): damaged runs of letters of ``least_length`` code points and ``least_count`` occurrences or more."""
    pattern = re.compile(f"[{ALPHABET}]{{{least_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, text in zip(ids, batch.column(1).cast(pa.binary())):
                text = text.as_py()
                if not text:
                    continue
                # only A-Z have another case here: lower() of bytes leaves the rest alone
                found = Counter(pattern.findall(text.lower().decode("utf-8", "replace")))
                for word, n in damage(i, found, every):
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= limits.counted:
                    yield flush()
            release()
        if counts:
            yield flush()

    parts = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# -- hashes and filters ------------------------------------------------------------------------
def codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each (all are below 256)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def prefixes(matrix: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Sums of the code points' values times powers of the base, before each place and in the end."""
    out = np.zeros((len(matrix), matrix.shape[1] + 1), np.uint64)
    np.cumsum(_CODE[matrix] * power[:matrix.shape[1]], axis=1, out=out[:, 1:])
    return out


def slice_of(h: np.ndarray, slices: int) -> np.ndarray:
    return mix(h + np.uint64(1)) % np.uint64(slices)


def _place(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each (mixed) hash and its bits in it."""
    bits = np.uint64(1) << (h & np.uint64(63))
    for i in range(1, _BITS):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), bits


def build(hashes: np.ndarray) -> np.ndarray:
    """A filter of 16 bits a word: one block of 64 bits for each four words."""
    blocks = np.zeros(max(1, (len(hashes) + 3) // 4), np.uint64)
    at, bits = _place(hashes, len(blocks))
    np.bitwise_or.at(blocks, at, bits)
    return blocks


def hit(blocks: np.ndarray, h: np.ndarray) -> np.ndarray:
    at, bits = _place(h, len(blocks))
    return (blocks[at] & bits) == bits


def by_length(words: list[str]) -> Iterator[list[str]]:
    """Words of one length at a time, so many that their edits are about ``PROBES``."""
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    for length, group in groups.items():
        size = max(1, PROBES // (length * 16))
        for at in range(0, len(group), size):
            yield group[at:at + size]


def _filters(vocabulary: DataFrame, wanted: list[tuple[int, int]], slices: dict[int, int], limits: Limits) -> dict[tuple[int, int], np.ndarray]:
    """The filters of a pass, by (shard, slice), built by tasks: two bytes a word of the pass."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in by_length(batch.column(0).to_pylist()):
                matrix = codes(words)
                shard = limits.shard(matrix.shape[1])
                h = mix(prefixes(matrix, powers(matrix.shape[1]))[:, -1])
                part = slice_of(h, slices[shard]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), shard, np.int32)), pa.array(part), pa.array(h.astype(np.int64))],
                                                 names=["shard", "part", "h"])

    def fill(key, table):
        blocks = build(np.asarray(table["h"]).astype(np.uint64))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()),
                         "blocks": pa.array([blocks.tobytes()], pa.binary())})

    shards = sorted({s for s, _ in wanted})
    rows = vocabulary.filter(F.least(F.length("word"), F.lit(limits.longest)).isin(shards)).select("word").mapInArrow(hashes, "shard int, part int, h long")
    keep = F.struct("shard", "part").isin([F.struct(F.lit(s), F.lit(p)) for s, p in wanted])
    filters = rows.filter(keep).groupBy("shard", "part").applyInArrow(fill, "shard int, part int, blocks binary")
    return {(r["shard"], r["part"]): np.frombuffer(r["blocks"], np.uint64) for r in filters.collect()}


def passes(sizes: dict[int, int], slices: dict[int, int], limits: Limits) -> list[list[tuple[int, int]]]:
    """(shard, slice) of each pass: as many as hold ``pass_slices * slice_words`` words together."""
    out: list[list[tuple[int, int]]] = []
    room = 0
    for shard in sorted(slices):
        for part in range(slices[shard]):
            words = -(-sizes[shard] // slices[shard])
            if not out or words > room:
                out.append([])
                room = limits.pass_slices * limits.slice_words
            out[-1].append((shard, part))
            room -= words
    return out


# -- pairs --------------------------------------------------------------------------------------
def edits(words: list[str], alphabet: np.ndarray, filters: dict, slices: dict[int, int], limits: Limits) -> Iterator[tuple[list[int], list[str]]]:
    """(row, edit) of the edits of words of one length that some filter of the pass may hold."""
    matrix = codes(words)
    rows, length = matrix.shape
    power = powers(length)
    before = prefixes(matrix, power)
    whole = before[:, -1]

    def may(h: np.ndarray, shard: int) -> np.ndarray:
        h = mix(h)
        part = slice_of(h, slices[shard]) if slices[shard] > 1 else None
        out = np.zeros(h.shape, bool)
        for (s, p), blocks in filters.items():
            if s == shard:
                out |= hit(blocks, h) if part is None else hit(blocks, h) & (part == np.uint64(p))
        return out

    if any(s == limits.shard(length - 1) for s, _ in filters) and length > 1:
        last_of_run = np.ones(matrix.shape, bool)
        last_of_run[:, :-1] = matrix[:, :-1] != matrix[:, 1:]
        r, i = np.nonzero(may(before[:, :-1] + (whole[:, None] - before[:, 1:]) * _BACK, limits.shard(length - 1)) & last_of_run)
        if len(r):
            text = matrix[r]
            left = np.arange(length)[None, :] != i[:, None]
            yield r.tolist(), _words(text[left].reshape(len(r), length - 1))
    if any(s == limits.shard(length) for s, _ in filters):
        width = max(1, PROBES // max(1, rows * len(alphabet)))
        for start in range(0, length, width):
            old = matrix[:, start:start + width]
            h = whole[:, None, None] + (_CODE[alphabet][None, None, :] - _CODE[old][:, :, None]) * power[start:start + old.shape[1]][None, :, None]
            lower = alphabet[None, None, :] < old[:, :, None]
            r, i, c = np.nonzero(lower)
            some = may(h[lower], limits.shard(length))
            r, i, c = r[some], i[some] + start, c[some]
            if len(r):
                text = matrix[r]
                text[np.arange(len(r)), i] = alphabet[c]
                yield r.tolist(), _words(text)


def _words(matrix: np.ndarray) -> list[str]:
    text, length = matrix.tobytes().decode("latin-1"), matrix.shape[1]
    return [text[at:at + length] for at in range(0, len(text), length)]


def near_pairs(vocabulary: DataFrame, scratch: Scratch, limits: Limits = Limits()) -> DataFrame:
    """(word, n, other, other_n): each pair of words at one edit, once."""
    spark = vocabulary.sparkSession
    sizes = {r["shard"]: r["n"] for r in vocabulary.groupBy(F.least(F.length("word"), F.lit(limits.longest)).alias("shard"))
             .agg(F.count("*").alias("n")).collect()}  # at most limits.longest rows
    letters = [ord(r[0]) for r in vocabulary.select(F.explode(F.split("word", "")).alias("c")).filter("c != ''").distinct().collect()]
    alphabet = np.array(sorted(letters), np.uint8)  # at most 90
    slices = {s: -(-n // limits.slice_words) for s, n in sizes.items()}
    hits = None
    for wanted in passes(sizes, slices, limits):
        filters = spark.sparkContext.broadcast(_filters(vocabulary, wanted, slices, limits))

        def probe(batches: Iterator[pa.RecordBatch], filters=filters) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                count = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                for words in by_length(list(count)):
                    for rows, found in edits(words, alphabet, filters.value, slices, limits):
                        own = [words[r] for r in rows]
                        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(own, pa.string()),
                                                          pa.array([count[w] for w in own], pa.int64())], names=["edit", "word", "n"])
                release()

        shards = sorted({s for s, _ in wanted})
        near = sorted({limits.shard(s + i) for s in shards for i in (0, 1)})
        own = vocabulary.filter(F.least(F.length("word"), F.lit(limits.longest)).isin(near))
        found = scratch.save(own.select("word", "n").mapInArrow(probe, "edit string, word string, n long"))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return vocabulary.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    exact = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return hits.join(exact, hits["edit"] == exact["other"]).select("word", "n", "other", "other_n")


# -- forms and roots ----------------------------------------------------------------------------
def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root): forms followed to the last.  Words that have arrived leave the next round; counts grow
    along a chain by the factor of ``variants``, so chains are short."""
    step = forms.select(F.col("word").alias("_at"), F.col("form").alias("_to"))
    rest = scratch.save(forms.select("word", F.col("form").alias("root")))
    done = None
    while not rest.isEmpty():
        moved = scratch.save(rest.join(step, rest["root"] == step["_at"], "left"))
        arrived = moved.filter(F.col("_to").isNull()).select("word", "root")
        done = arrived if done is None else done.unionByName(arrived)
        rest = moved.filter(F.col("_to").isNotNull()).select("word", F.col("_to").alias("root"))
    return rest if done is None else done


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5,
             every: int = 199, factor: int = 5, limits: Limits = Limits()) -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row for each word of the corpus.

    ``form``: the near word with the largest count (ties: the smallest in code-point order) where that is at least
    ``factor`` times the word's, else null; ``root``: the last word reached through forms, or the word itself."""
    with Scratch(docs.sparkSession) as scratch:
        vocabulary = scratch.save(word_counts(docs, id_col, text_col, least_length, least_count, every, limits))
        pairs = scratch.save(near_pairs(vocabulary, scratch, limits))
        both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"),
                                              F.col("n").alias("other_n")))
        near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
        near = near.select(F.col("word").alias("_word"), "n_near", F.col("best.other").alias("_form"), (-F.col("best.less")).alias("_form_n"))
        joined = vocabulary.join(near, F.col("word") == F.col("_word"), "left")
        enough = F.col("_form_n") >= F.col("n") * F.lit(factor)
        words = scratch.save(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                           F.when(enough, F.col("_form")).alias("form"), F.when(enough, F.col("_form_n")).alias("form_n")))
        ends = roots(words.filter(F.col("form").isNotNull()), scratch).select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        out = words.join(ends, F.col("word") == F.col("_word"), "left")
        return settle(out.select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n"))
