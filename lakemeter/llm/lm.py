"""Language-model scoring with causal self-attention over subword ids (operator 10).

Text is lower-cased (A-Z) and cut into words; each word, with a space before it, becomes subword
ids of a public vocabulary; a document ends with an end id.  The model gives the next id's class by
one layer of causal self-attention over a window of ids, trained in numpy, and the id in its class
by its training frequency.  Classes are kept apart by whether their ids begin a word, so the model
also says where a word ends; a word's probability is that of its ids and of ending there.  It is
mixed, for the ``TABLE_WORDS`` most frequent words, with the class the attention expects times the
word's training frequency among the words whose first id has that class.

Learning covers all training documents:
* counts of every word, in shards by word hash (the base model and the table are read off them);
* all ids of every document as training text, cut as for scoring: counts of ids and of
  their company (summed over all tasks), classes by k-means on the company, and the attention
  weights, by local gradient descent in every task and averaging, once for each of ``RATES``.

Scoring walks every whole document in overlapping windows: each scores its last ``STRIDE`` ids
only, so every id counts once, with at least ``CONTEXT - STRIDE`` ids before it (or the whole
beginning).  Words outside the table look their counts up in the shards, so no table grows with
the corpus.

Cases: null or empty text is the end alone; rows that repeat an id count and score as documents of
their own; a null id's checksum is that of the empty text; no training documents: base scores 0
(log10 of 1), every id alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemeter.llm import bpe
from lakemeter.llm import texts as T
from lakemeter.session import Scratch, settle

TABLE_WORDS = 1 << 17
SHARD_WORDS = 4_000_000
#: training windows of a segment, ids of a row of segments, training windows that one task descends on,
#: steps it takes at least if three walks give them, and the step sizes of the rounds of averaging
SEGMENT = 256
ROW_IDS = 1 << 16
TASK_WINDOWS = 32_000
STEPS = 1500
RATES = (0.01, 0.003)
#: units (frequent ids with a vector of their own), width, classes of each kind, ids in view
UNITS = 4096
WIDTH = 16
KINDS = 24
CONTEXT = 32
STRIDE = 24
COMPANY = 64
IDS = 1 << 16
END_WORD = np.uint64(0x0123456789ABCDEF)


# -- subword ids ---------------------------------------------------------------------------
class Subwords:
    """Ids of words by word hash, kept flat; emptied when full."""
    LIMIT = 600_000

    def __init__(self, path: str):
        self.vocabulary = bpe.Vocabulary.load(path, r"\S+")
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted
        self.row = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint16)
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = 0

    def look_up(self, hashes: tuple[np.ndarray, np.ndarray, np.ndarray], data: np.ndarray, start: np.ndarray,
                end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of the words ``data[start:end]`` in order; ``hashes``: the distinct
        ones, sorted, with the first word of each and the place of each word's."""
        unique, at, back = hashes
        if len(self.known) > self.LIMIT:
            self.clear()
        first = len(self.known)
        place = np.searchsorted(self.known, unique)
        old = np.zeros(len(unique), bool)
        if first:
            old = self.known[np.minimum(place, first - 1)] == unique
        row = np.empty(len(unique), np.int64)
        row[old] = self.row[place[old]]
        new = np.flatnonzero(~old)
        if len(new):
            words = [b" " + data[start[i]:end[i]].tobytes() for i in at[new].tolist()]
            found = self.vocabulary.pieces_of(words)
            sizes = np.fromiter((len(x) // 4 for x in found), np.int64, len(found))
            flat = np.frombuffer(b"".join(found), "<u4").astype(np.uint16)
            row[new] = first + np.arange(len(new))
            self.known, self.row = np.insert(self.known, place[new], unique[new]), np.insert(self.row, place[new], row[new])
            while len(self.start) < len(self.known):
                self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
            while len(self.ids) < self.used + len(flat):
                self.ids = np.resize(self.ids, 2 * len(self.ids))
            self.ids[self.used:self.used + len(flat)] = flat
            self.size[first:first + len(new)] = sizes
            self.start[first:first + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.used += len(flat)
        row = row[back]
        size = self.size[row]
        spot = np.repeat(self.start[row] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.ids[spot], size


_subwords: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    if path not in _subwords:
        _subwords[path] = Subwords(path)
    return _subwords[path]


# -- counts and training windows -----------------------------------------------------------
_GATHERED = "shard long, words binary, windows binary, slice int, part int, counts binary"
_COUNT = np.dtype([("word", np.uint64), ("n", np.int64), ("first", np.int64)])


def gather(docs: DataFrame, path: str, end_id: int, shards: int) -> DataFrame:
    """Rows with a shard: counts of a task's words; with windows: ``segments`` of training text;
    with a slice: counts of the ids of all words."""
    return docs.mapInArrow(lambda batches: gather_batches(batches, path, end_id, shards), _GATHERED)


def _row_batch(n: int, **columns) -> pa.RecordBatch:
    kinds = {"shard": pa.int64(), "words": pa.binary(), "windows": pa.binary(), "slice": pa.int32(), "part": pa.int32(), "counts": pa.binary()}
    return pa.RecordBatch.from_arrays([columns.get(k, pa.nulls(n, t)) for k, t in kinds.items()], names=list(kinds))


def gather_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int, shards: int) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    n = 0
    id_counts = np.zeros(IDS)

    def flush() -> pa.RecordBatch:
        rows = _added(np.concatenate(held) if held else np.zeros(0, _COUNT))
        parts = _split(rows, rows["word"] % np.uint64(shards))
        return _row_batch(len(parts), shard=pa.array([k for k, _ in parts], pa.int64()), words=pa.array([T.packed(x) for _, x in parts], pa.binary()))

    for block in T.blocks(batches):
        w = T.words(block.data, block.offsets, lower=True)
        unique, at, back, count = np.unique(w.hash, return_index=True, return_inverse=True, return_counts=True)
        ids, sizes = subwords(path).look_up((unique, at, back), T.LOWER[block.data], w.start, w.end)
        id_counts += np.bincount(ids, minlength=IDS)
        id_counts[end_id] += len(block)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        rows = np.zeros(len(unique) + 1, _COUNT)
        rows["word"][:-1], rows["n"][:-1], rows["first"][:-1] = unique, count, ids[upto[at]]
        rows[-1] = (END_WORD, len(block), end_id)
        held.append(rows)
        n += len(rows)
        if n > 2_000_000:
            yield flush()
            held, n = [], 0
        for part in segments(ids, upto[w.bounds], end_id):
            yield _row_batch(1, windows=pa.array([T.packed(part)], pa.binary()))
    yield flush()
    table = T.table_rows(id_counts)
    yield _row_batch(table.num_rows, slice=table["slice"], part=table["part"], counts=table["counts"])


_MORE, _STOP = 0xFFFE, 0xFFFF


def segments(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> Iterator[np.ndarray]:
    """Training text of documents (``bounds``) in parts of about ``ROW_IDS`` ids, ``_STOP`` after each
    segment.  A document is an end, its ids and an end; a long one goes on in segments that begin with
    ``_MORE`` and the last ids before: enough for each window that scoring would see."""
    size = np.diff(bounds) + 2
    text = np.full(int(size.sum()), end_id, np.uint16)
    first = np.cumsum(size) - size
    text[np.arange(len(ids)) + 2 * np.repeat(np.arange(len(size)), size - 2) + 1] = ids
    count = -(-_windows(size - 1) // SEGMENT)
    doc = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    begin = nth * (SEGMENT * STRIDE)
    length = np.minimum(size[doc] - begin, SEGMENT * STRIDE + CONTEXT - STRIDE + 1)
    begin, more = begin + first[doc], nth > 0
    row = np.cumsum(length) // ROW_IDS
    edges = [0, *(np.flatnonzero(np.diff(row)) + 1).tolist(), len(row)]
    for a, b in zip(edges, edges[1:]):
        long, mark = length[a:b], more[a:b].astype(np.int64)
        place = np.cumsum(long + mark + 1) - (long + 1)
        out = np.full(int((long + mark + 1).sum()), _STOP, np.uint16)
        out[place[mark > 0] - 1] = _MORE
        step = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
        out[np.repeat(place, long) + step] = text[np.repeat(begin[a:b], long) + step]
        yield out


def _windows(size: np.ndarray) -> np.ndarray:
    """Overlapping windows in a document of so many inputs: the first gives all its ids, later ones their last ``STRIDE``."""
    return np.where(size > 0, 1 + np.maximum(0, -(-(size - CONTEXT) // STRIDE)), 0)


def _added(rows: np.ndarray) -> np.ndarray:
    """Counts of equal words added."""
    rows = rows[np.argsort(rows["word"], kind="stable")]
    head = np.ones(len(rows), bool)
    head[1:] = rows["word"][1:] != rows["word"][:-1]
    out = rows[head]
    if len(rows):
        out["n"] = np.add.reduceat(rows["n"], np.flatnonzero(head))
    return out


def _split(rows: np.ndarray, key: np.ndarray) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(key, kind="stable")
    rows, key = rows[order], key[order]
    edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(rows)]
    return [(int(key[a]), rows[a:b]) for a, b in zip(edges, edges[1:]) if b > a]


_BINS = 400  # of counts, eight to a doubling


def _bin(n: np.ndarray) -> np.ndarray:
    return np.minimum((np.log2(np.maximum(n, 1)) * 8).astype(np.int64), _BINS - 1)


def shard_counts(gathered: DataFrame) -> DataFrame:
    """(shard, words, tokens, distinct, bins): the counts of each shard's words, and how they are spread."""
    def add(key, table):
        rows = _added(np.concatenate([np.frombuffer(x.as_py(), _COUNT) for x in table["words"]]))
        bins = np.bincount(_bin(rows["n"]), minlength=_BINS)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "words": pa.array([T.packed(rows)], pa.binary()),
                         "tokens": pa.array([int(rows["n"].sum())], pa.int64()), "distinct": pa.array([len(rows)], pa.int64()),
                         "bins": pa.array([bins.tolist()], pa.list_(pa.int64()))})

    return gathered.filter(F.col("shard").isNotNull()).select("shard", "words").groupBy("shard").applyInArrow(
        add, "shard long, words binary, tokens long, distinct long, bins array<long>")


def frequent_words(counts: DataFrame) -> np.ndarray:
    """Words whose count reaches the bin that keeps the table within ``TABLE_WORDS`` rows."""
    rows = counts.select(F.posexplode("bins").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n")).collect()  # _BINS rows
    bins = np.zeros(_BINS, np.int64)
    for r in rows:
        bins[r["bin"]] = r["n"]
    above = np.cumsum(bins[::-1])[::-1]  # words in this bin or a higher one
    least = int(np.argmax(above <= TABLE_WORDS))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch["words"]:
                own = np.frombuffer(x.as_py(), _COUNT)
                own = own[_bin(own["n"]) >= least]
                yield pa.RecordBatch.from_arrays([pa.array([T.packed(own)], pa.binary())], names=["words"])

    parts = [np.frombuffer(r["words"], _COUNT) for r in counts.select("words").mapInArrow(pick, "words binary").collect()]
    return np.sort(np.concatenate(parts) if parts else np.zeros(0, _COUNT), order="word")


# -- the model -----------------------------------------------------------------------------
@dataclass
class Model:
    """Attention weights, and what the ids are to it."""
    unit: np.ndarray        # id -> unit
    kind: np.ndarray        # id -> class; classes below ``begins`` begin a word
    inside: np.ndarray      # id -> natural log of its share of its class
    begins: int
    p: dict[str, np.ndarray]

    def prepared(self) -> dict[str, np.ndarray]:
        p = self.p
        rel = np.arange(CONTEXT)[:, None] - np.arange(CONTEXT)[None, :]
        bias = np.where(rel >= 0, p["far"][np.maximum(rel, 0)], -1e9).astype(np.float32)
        split = np.zeros((p["out"].shape[1], 2), np.float32)
        split[:, 0] = 1
        split[:self.begins, 1] = 1
        return {"qkv": np.concatenate([p["e"] @ p["wq"] / np.float32(np.sqrt(WIDTH)), p["e"] @ p["wk"], p["e"] @ p["wv"]], axis=1),
                "o": p["e"] @ p["wx"] + p["b"], "bias": bias, "split": split, "out": p["out"]}


def initial(units: int, kinds: int) -> dict[str, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(7))
    f = lambda *s: (r.standard_normal(s) * 0.3).astype(np.float32)
    return {"e": f(units, WIDTH), "wq": f(WIDTH, WIDTH), "wk": f(WIDTH, WIDTH), "wv": f(WIDTH, WIDTH), "wx": f(WIDTH, kinds),
            "out": f(WIDTH, kinds), "b": np.zeros(kinds, np.float32), "far": np.zeros(CONTEXT, np.float32)}


def attend(t: dict[str, np.ndarray], u: np.ndarray, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Masked attention of windows of units (windows, CONTEXT): (logits' exponentials, sums over all classes and over those
    that begin a word), of all places or of those asked for (numbered through all windows)."""
    flat_u = u.ravel()
    y = t["qkv"].take(flat_u, axis=0).reshape(*u.shape, 3 * WIDTH)
    q, k, v = y[..., :WIDTH], y[..., WIDTH:2 * WIDTH], y[..., 2 * WIDTH:]
    s = np.matmul(q, k.transpose(0, 2, 1))
    s += t["bias"]
    np.minimum(s, 30, out=s)
    np.exp(s, out=s)
    o = np.matmul(s, v)
    o /= (s @ np.ones(s.shape[2], s.dtype))[:, :, None]
    o = o.reshape(-1, WIDTH)
    if places is not None:
        flat_u, o = flat_u[places], o.take(places, axis=0)
    z = o @ t["out"]
    z += t["o"].take(flat_u, axis=0)
    np.minimum(z, 60, out=z)
    np.maximum(z, -60, out=z)
    np.exp(z, out=z)
    return z, z @ t["split"]


_REL = np.arange(CONTEXT)[:, None] - np.arange(CONTEXT)[None, :]
_AHEAD = np.where(_REL >= 0, np.float32(0), np.float32(-1e9))
_FAR = np.maximum(_REL, 0)
_WIDE = np.arange(WIDTH)


def gradients(p: dict[str, np.ndarray], u: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy of the next class over a batch of windows.

    Projections are one product, sums along rows are products with ones, vectors of units are added up in one call,
    and places without weight get no logits: many small arrays cost more here than their numbers."""
    n, c = u.shape
    flat_u, rows = u.ravel(), n * c
    share = (weight / max(weight.sum(), 1)).ravel()
    used = np.flatnonzero(share)  # the other places are only looked at: their outputs have no gradient
    share = share[used]
    scale = np.float32(1 / np.sqrt(WIDTH))
    into = np.concatenate([p["wq"] * scale, p["wk"], p["wv"]], axis=1)
    x = p["e"].take(flat_u, axis=0)
    y = (x @ into).reshape(n, c, 3 * WIDTH)
    q, k, v = y[..., :WIDTH], y[..., WIDTH:2 * WIDTH], y[..., 2 * WIDTH:]
    a = np.matmul(q, k.transpose(0, 2, 1))
    a += (p["far"][_FAR] + _AHEAD)[:c, :c]
    a -= a.max(axis=2, keepdims=True)
    np.exp(a, out=a)
    a *= (1 / (a @ np.ones(c, np.float32)))[:, :, None]
    o = np.matmul(a, v)
    xo = np.concatenate([x.take(used, axis=0), o.reshape(rows, WIDTH).take(used, axis=0)], axis=1)
    onto = np.concatenate([p["wx"], p["out"]])
    d = xo @ onto
    d += p["b"]
    d -= d.max(axis=1, keepdims=True)
    np.exp(d, out=d)
    d *= (share / (d @ np.ones(d.shape[1], np.float32)))[:, None]
    d[np.arange(len(used)), target.ravel()[used]] -= share
    both = xo.T @ d
    g = {"wx": both[:WIDTH], "out": both[WIDTH:], "b": np.ones(len(used), np.float32) @ d}
    back = d @ onto.T
    do = np.zeros((rows, WIDTH), back.dtype)
    do[used] = back[:, WIDTH:]
    do = do.reshape(n, c, WIDTH)
    dy = np.empty_like(y)
    np.matmul(a.transpose(0, 2, 1), do, out=dy[..., 2 * WIDTH:])
    ds = np.matmul(do, v.transpose(0, 2, 1))
    ds -= np.einsum("ijk,ijk->ij", do, o)[:, :, None]
    ds *= a
    # the mask leaves zeros ahead of each place
    g["far"] = np.bincount(_FAR[:c, :c].ravel(), weights=np.ones(n, np.float32) @ ds.reshape(n, c * c), minlength=CONTEXT).astype(np.float32)
    np.matmul(ds, k, out=dy[..., :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=dy[..., WIDTH:2 * WIDTH])
    dy = dy.reshape(rows, 3 * WIDTH)
    three = x.T @ dy
    g["wq"], g["wk"], g["wv"] = three[:, :WIDTH] * scale, three[:, WIDTH:2 * WIDTH], three[:, 2 * WIDTH:]
    dx = dy @ into.T
    dx[used] += back[:, :WIDTH]
    e = np.zeros(p["e"].size, dx.dtype)
    np.add.at(e, (flat_u[:, None] * WIDTH + _WIDE).ravel(), dx.ravel())
    g["e"] = e.reshape(p["e"].shape)
    return g


def train_windows(ids: np.ndarray, model: Model, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, next classes and weights of the overlapping windows in ``segments``: each id after a
    document's first end has weight 1 once."""
    ends = np.flatnonzero(ids == _STOP)
    starts = np.concatenate([[0], ends[:-1] + 1])
    more = ids[starts] == _MORE
    starts = starts + more
    count = _windows(ends - starts - 1)
    own = np.repeat(np.arange(len(starts)), count)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    begin, last = starts[own] + nth * STRIDE, ends[own] - 1
    spot = begin[:, None] + np.arange(CONTEXT + 1)
    x = ids[np.minimum(spot, last[:, None])]
    new = ((nth == 0) & ~more[own])[:, None] | (np.arange(CONTEXT) >= CONTEXT - STRIDE)
    weight = ((spot[:, 1:] <= last[:, None]) & new).astype(np.float32)
    return model.unit[x[:, :-1]], model.kind[x[:, 1:]], weight


def descend(p: dict[str, np.ndarray], data, steps: int, rate: float, seed: int) -> dict[str, np.ndarray]:
    """Adam over shuffled batches of 64 windows: one walk over the data, or up to three until ``steps`` steps."""
    u, target, weight = data
    names, place = sorted(p), {}
    at = 0
    for k in names:
        place[k] = slice(at, at + p[k].size)
        at += p[k].size
    # all weights in one array, so that a step is a few passes in place
    now = flat(p)
    views = {k: now[place[k]].reshape(p[k].shape) for k in names}
    g, m, s, part = (np.zeros_like(now) for _ in range(4))
    r = np.random.Generator(np.random.PCG64(seed))
    batch, step = 64, 0
    once = -(-len(u) // batch)
    while step < max(min(steps, 3 * once), once):
        order = r.permutation(len(u))
        for at in range(0, len(u), batch):
            some = order[at:at + batch]
            step += 1
            for k, x in gradients(views, u[some], target[some], weight[some]).items():
                g[place[k]] = x.ravel()
            np.subtract(g, m, out=part)
            part *= np.float32(0.1)
            m += part
            g *= g
            g -= s
            g *= np.float32(0.01)
            s += g
            np.multiply(s, np.float32(1 / (1 - 0.99 ** step)), out=part)
            np.sqrt(part, out=part)
            part += np.float32(1e-6)
            np.divide(m, part, out=part)
            part *= np.float32(rate / (1 - 0.9 ** step))
            now -= part
    return {k: v.copy() for k, v in views.items()}


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def shaped(x: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = x[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def clusters(company: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """k-means of rows (square roots of shares), seeded by spread-out rows, weighted."""
    if len(company) <= k:
        return np.arange(len(company))
    x = np.sqrt(company / np.maximum(company.sum(axis=1, keepdims=True), 1))
    x -= (x * weight[:, None]).sum(axis=0) / max(weight.sum(), 1)
    centre = [int(np.argmax(weight))]
    far = ((x - x[centre[0]]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        centre.append(int(np.argmax(far * np.sqrt(weight))))
        far = np.minimum(far, ((x - x[centre[-1]]) ** 2).sum(axis=1))
    c = x[centre]
    for _ in range(15):
        own = ((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)).argmin(axis=1)
        for i in range(k):
            mine = own == i
            if mine.any():
                c[i] = (x[mine] * weight[mine, None]).sum(axis=0) / max(weight[mine].sum(), 1e-9)
    return own


def company(ids: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """How often each unit lies in a window with units of each remainder by ``COMPANY``; each id of ``segments`` once, in windows
    of ``CONTEXT`` ids."""
    ends = np.flatnonzero(ids == _STOP)
    starts = np.concatenate([[0], ends[:-1] + 1])
    starts = starts + np.where(ids[starts] == _MORE, CONTEXT - STRIDE + 2, 0)  # ids that the segment before holds
    size = ends - starts
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    u = unit[ids[np.repeat(starts, size) + step]]
    window = np.cumsum(step % CONTEXT == 0) - 1
    # windows side by side, filled up with a unit of no company; then pairs of an id and an id of its window
    full = np.full((int(window[-1]) + 1 if len(window) else 0, CONTEXT), UNITS, np.int64)
    full[window, step % CONTEXT] = u
    out = np.zeros((UNITS + 1) * (COMPANY + 1))
    for at in range(0, len(full), 1024):
        some = full[at:at + 1024]
        pairs = some[:, :, None] * (COMPANY + 1) + np.where(some < UNITS, some % COMPANY, COMPANY)[:, None, :]
        out += np.bincount(pairs.ravel(), minlength=len(out))
    return out.reshape(UNITS + 1, COMPANY + 1)[:UNITS, :COMPANY]


def learn(windows: DataFrame, count: np.ndarray, path: str, end_id: int) -> Model:
    """Classes and attention weights of all training windows; ``count``: of every id in all training text."""
    token = bpe.Decoder.load(path).token
    begin = np.zeros(IDS, bool)
    begin[[i for i, t in token.items() if t[:1] == b" "]] = True
    begin[end_id] = True

    def over(table):
        """A table of numbers from each task's windows, summed."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [np.frombuffer(x.as_py(), np.uint16) for batch in batches for x in batch["windows"]]
            if parts:
                yield T.table_rows(table(np.concatenate(parts)))
        return windows.mapInArrow(run, "slice int, part int, counts binary")

    order = np.argsort(-count, kind="stable")[:UNITS - 2]
    order = order[count[order] > 0]
    unit = np.where(begin, 0, 1).astype(np.int64)  # two units for all other ids
    unit[order] = np.arange(len(order)) + 2

    together = T.table_sum(over(lambda ids: company(ids, unit)), UNITS * COMPANY).reshape(UNITS, COMPANY)
    kind = np.zeros(IDS, np.int64)
    first = 0
    for begins in (True, False):
        own = order[begin[order] == begins]
        own = own[own != end_id]
        rest = first + (1 if begins else 0)  # class 0 is the end
        kind[begin == begins] = rest
        kind[own] = rest + 1 + clusters(together[unit[own]], count[own], KINDS - 2)
        first = rest + 1 + (KINDS - 2)
        if begins:
            begin_kinds = first
    kind[end_id] = 0
    kinds = first
    mass = count + 0.1
    mass[[i for i in range(IDS) if i not in token and i != end_id]] = 0
    total = np.bincount(kind, weights=mass, minlength=kinds)
    inside = np.log(np.maximum(mass, 1e-9) / np.maximum(total, 1e-9)[kind]).astype(np.float32)
    model = Model(unit, kind, inside, begin_kinds, initial(UNITS, kinds))
    share = np.bincount(kind, weights=count, minlength=kinds) + 0.5
    model.p["b"] = np.log(share / share.sum()).astype(np.float32)
    size = len(flat(model.p))
    for turn in range(len(RATES) if count.sum() else 0):
        def step(ids: np.ndarray, start=model, turn=turn) -> np.ndarray:
            data = train_windows(ids, start, end_id)
            if not len(data[0]):
                return np.zeros(size + 1)
            done = descend(start.p, data, STEPS, RATES[turn], turn)
            return np.concatenate([flat(done) * len(data[0]), [len(data[0])]])

        total = T.table_sum(over(step), size + 1)
        if total[-1]:
            model = Model(unit, kind, inside, begin_kinds, shaped(total[:-1] / total[-1], model.p))
    return model


# -- scoring -------------------------------------------------------------------------------
def id_scores(model: Model, t: dict[str, np.ndarray], ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each id of each document (``bounds``): log probability after the ids before it, and the log
    probability, just before it, that a word begins.  Documents are walked in overlapping windows."""
    size = np.diff(bounds)
    # a document's inputs: an end, then all its ids but the last
    source = np.empty(len(ids), np.int64)
    source[1:] = ids[:-1]
    source[bounds[:-1][size > 0]] = end_id
    units, kinds = model.unit[source], model.kind[ids]
    count = _windows(size)
    doc = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    begin = bounds[doc] + nth * STRIDE
    chosen, any_ = np.empty(len(ids), np.float32), np.empty(len(ids), np.float32)
    for at in range(0, len(doc), 64):  # what a block of windows needs stays in a core's cache
        some = slice(at, at + 64)
        spot = begin[some, None] + np.arange(CONTEXT)
        last = bounds[doc[some] + 1][:, None] - 1
        # the first window of a document scores all its ids, later ones their last STRIDE
        own = (spot <= last) & ((nth[some, None] == 0) | (np.arange(CONTEXT) >= CONTEXT - STRIDE))
        row = np.flatnonzero(own.ravel())
        where = spot.ravel()[row]
        z, sums = attend(t, units[np.minimum(spot, last)], row)
        chosen[where] = z[np.arange(len(row)), kinds[where]] / sums[:, 0]
        any_[where] = sums[:, 1] / sums[:, 0]
    tiny = np.float32(1e-30)
    return np.log(np.maximum(chosen, tiny)) + model.inside[ids], np.log(np.maximum(any_, tiny))


_SCORED = "key long, id long, n_tokens long, n_known long, base double, score double, shard long, rare binary"
_RARE = np.dtype([("key", np.int64), ("word", np.uint64)])


@dataclass
class Table:
    """The most frequent words (sorted hashes), with the numbers that scoring needs of each."""
    words: np.ndarray
    base: np.ndarray      # log10 of the smoothed unigram probability
    in_class: np.ndarray  # natural log of the word's share of its class
    share: float          # of the pure subword model in the mixture
    unknown: float        # base of a word that was never seen

    @classmethod
    def of(cls, rows: np.ndarray, model: Model, tokens: int, distinct: int) -> "Table":
        n = rows["n"].astype(np.float64)
        kind = model.kind[rows["first"]]
        mass = np.bincount(kind, weights=n, minlength=int(model.kind.max()) + 1)
        outside = 1 - n.sum() / max(tokens, 1)
        return cls(np.ascontiguousarray(rows["word"]), np.log10((n + 1) / (tokens + distinct + 1)), np.log(n / mass[kind]),
                   min(0.9, 0.15 + outside) if len(rows) else 1.0, float(np.log10(1 / (tokens + distinct + 1))))


def score_rows(docs: DataFrame, model: Model, table: Table, path: str, end_id: int, shards: int) -> DataFrame:
    """Rows with a key: each document's score and the part of its base that the table holds; with a shard: its other words."""
    return docs.mapInArrow(lambda batches: score_batches(batches, model, table, path, end_id, shards), _SCORED)


def score_batches(batches: Iterator[pa.RecordBatch], model: Model, table: Table, path: str, end_id: int, shards: int) -> Iterator[pa.RecordBatch]:
    names = ["key", "id", "n_tokens", "n_known", "base", "score", "shard", "rare"]
    t = model.prepared()
    key = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
    for block in T.blocks(batches):
        k = len(block)
        w = T.words(block.data, block.offsets, lower=True)
        ids, sizes = subwords(path).look_up(np.unique(w.hash, return_index=True, return_inverse=True), T.LOWER[block.data], w.start, w.end)
        # each document's words and its end: word slots, then id slots
        n_words = np.diff(w.bounds)
        slot_bounds = np.concatenate([[0], np.cumsum(n_words + 1)])
        is_end = np.zeros(slot_bounds[-1], bool)
        is_end[slot_bounds[1:] - 1] = True
        slot_hash = np.full(slot_bounds[-1], END_WORD)
        slot_hash[~is_end] = w.hash
        slot_size = np.ones(slot_bounds[-1], np.int64)
        slot_size[~is_end] = sizes
        upto = np.concatenate([[0], np.cumsum(slot_size)])
        every = np.full(upto[-1], end_id, np.int64)
        every[np.repeat(~is_end, slot_size)] = ids
        log_id, log_any = id_scores(model, t, every, upto[slot_bounds], end_id)
        # a word: its ids, given that a word begins, and that the next begins after it
        total = np.concatenate([[0.0], np.cumsum(log_id, dtype=np.float64)])
        first = upto[:-1]
        mixed = total[upto[1:]] - total[first] - log_any[first] + np.log(table.share)
        mixed += np.where(is_end, 0.0, log_any[np.minimum(upto[1:], len(every) - 1)])
        if len(table.words):
            at = np.minimum(np.searchsorted(table.words, slot_hash), len(table.words) - 1)
            in_table = table.words[at] == slot_hash
            spot, at = first[in_table], at[in_table]
            by_class = log_id[spot] - model.inside[every[spot]] - log_any[spot] + table.in_class[at]
            mixed[in_table] = np.logaddexp(mixed[in_table], by_class + np.log(1 - table.share))
        else:
            in_table, at = np.zeros(len(slot_hash), bool), np.zeros(0, np.int64)
        doc = np.repeat(np.arange(k), n_words + 1)
        score = np.bincount(doc, weights=mixed, minlength=k) / np.log(10)
        base = np.bincount(doc[in_table], weights=table.base[at], minlength=k).astype(np.float64)  # whole numbers if there are none
        known = np.bincount(doc[in_table], minlength=k)
        keys = key + np.arange(k)
        key += k
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(block.ids), pa.array(n_words + 1), pa.array(known), pa.array(base), pa.array(score),
             pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary())], names=names)
        rare = np.zeros(int((~in_table).sum()), _RARE)
        rare["key"], rare["word"] = keys[doc[~in_table]], slot_hash[~in_table]
        parts = _split(rare, rare["word"] % np.uint64(shards))
        none = [pa.nulls(len(parts), x) for x in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
        yield pa.RecordBatch.from_arrays(
            [*none, pa.array([x for x, _ in parts], pa.int64()),
             pa.array([T.packed(x["key"]) + T.packed(x["word"]) for _, x in parts], pa.binary())], names=names)


_REST = np.dtype([("key", np.int64), ("known", np.int64), ("rest", np.float64)])


def rare_rows(scored: DataFrame, counts: DataFrame, tokens: int, distinct: int, buckets: int) -> DataFrame:
    """(key, known, rest): what the words outside the table add to each document.

    A shard of words packs its sums by bucket of documents; buckets add them up."""
    def look_up(left, right):
        own = [np.frombuffer(x.as_py(), _COUNT) for x in right["words"]]
        own = own[0] if own else np.zeros(0, _COUNT)
        halves = [np.frombuffer(x.as_py(), np.int64).reshape(2, -1) for x in left["rare"]]
        key = np.concatenate([x[0] for x in halves]) if halves else np.zeros(0, np.int64)
        word = (np.concatenate([x[1] for x in halves]) if halves else key).view(np.uint64)
        n = np.zeros(len(word), np.int64)
        if len(own):
            at = np.minimum(np.searchsorted(own["word"], word), len(own) - 1)
            n = np.where(own["word"][at] == word, own["n"][at], 0)
        unique, back = np.unique(key, return_inverse=True)
        rows = np.zeros(len(unique), _REST)
        rows["key"] = unique
        rows["known"] = np.bincount(back[n > 0], minlength=len(unique))
        rows["rest"] = np.bincount(back, weights=np.log10((n + 1) / (tokens + distinct + 1)), minlength=len(unique))
        parts = _split(rows, T.mix(rows["key"].astype(np.uint64)) % np.uint64(buckets))
        return pa.table({"bucket": pa.array([k for k, _ in parts], pa.int64()), "rows": pa.array([T.packed(x) for _, x in parts], pa.binary())})

    def add(key, table):
        rows = np.concatenate([np.frombuffer(x.as_py(), _REST) for x in table["rows"]])
        unique, back = np.unique(rows["key"], return_inverse=True)
        return pa.table({"key": pa.array(unique), "known": pa.array(np.bincount(back, weights=rows["known"], minlength=len(unique)).astype(np.int64)),
                         "rest": pa.array(np.bincount(back, weights=rows["rest"], minlength=len(unique)), pa.float64())})

    left = scored.filter(F.col("shard").isNotNull()).select("shard", "rare").groupBy("shard")
    packed = left.cogroup(counts.select("shard", "words").groupBy("shard")).applyInArrow(look_up, "bucket long, rows binary")
    return packed.groupBy("bucket").applyInArrow(add, "key long, known long, rest double")


def score(docs: DataFrame, held_out: Column, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 50256) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row, learnt from the rows where ``held_out`` is false."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = max(8, total // 6 // SHARD_WORDS + 1)
    training = docs.filter(~held_out).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        gathered = scratch.save(gather(training, path, end_id, shards))
        counts = scratch.save(shard_counts(gathered))
        stats = counts.agg(F.sum("tokens").alias("n"), F.sum("distinct").alias("v")).first()
        tokens, distinct = stats["n"] or 0, stats["v"] or 0
        count = T.table_sum(gathered.filter(F.col("slice").isNotNull()).select("slice", "part", "counts"), IDS)
        windows = gathered.filter(F.col("windows").isNotNull()).select("windows")
        tasks = max(1, int(count.sum()) // STRIDE // TASK_WINDOWS)
        model = learn(scratch.save(windows.repartition(tasks)), count, path, end_id)
        table = Table.of(frequent_words(counts), model, tokens, distinct)
        scored = scratch.save(score_rows(rows, model, table, path, end_id, shards))
        rare = rare_rows(scored, counts, tokens, distinct, max(8, total // (16 << 20) + 1))
        out = scored.filter(F.col("key").isNotNull()).join(rare, "key", "left")
        null_id = F.when(F.col("id") == T.NULL_ID, F.lit(None).cast("long")).otherwise(F.col("id"))
        return settle(out.select(
            null_id.alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score"))
