"""Toxicity by class-conditional Kneser-Ney models (operator 6).

Each class (toxic, ordinary) has a Kneser-Ney word model: a word's count is the number of
different words it follows in the class, ``DISCOUNT`` is taken off every count, and the mass set
free goes to a backoff distribution that both classes share, from the counts that both have in
common.  A word that is rare in a class therefore says nothing, in either direction.  A text's
evidence is the toxic minus the ordinary log-likelihood, normalised by length - over the whole
text and over its best stretch of 1, 2, 4 ... 64 words, so that a passage shows in a long text.
A logistic curve, fitted on labelled texts that the word models did not see, turns it into a score.

The models are fitted on bounded samples of the labelled rows (``MODEL_ROWS`` of each class,
``CURVE_ROWS`` for the curve, by a hash of the id); the table of words that both carry is bounded
by ``TABLE_WORDS``.  Every text is scored whole.  Only the text enters a score.

Cases: null or empty text: the score of no evidence; a label that is null, or that repeats or
contradicts another of its document: the larger counts; labels without a document are passed over;
no labelled row of either class: score 0 for all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemeter.llm import texts as T
from lakemeter.session import Scratch

DISCOUNT = 3.0
#: labelled rows of each class for the word models, and of both for the curve
MODEL_ROWS = 4000
CURVE_ROWS = 4000
TABLE_WORDS = 1 << 18
STRETCHES = (1, 2, 4, 8, 16, 64)
#: part of the shared backoff that every word has alike
FLOOR = 0.1


@dataclass
class Model:
    """Words (sorted hashes) with their evidence, the evidence of all others, and the curve."""
    words: np.ndarray
    evidence: np.ndarray
    other: float
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Length-normalised evidence of each document of a block: whole, then best stretches."""
        n_docs = len(offsets) - 1
        out = np.zeros((n_docs, 1 + len(STRETCHES)))
        w = T.words(data, offsets, lower=True, between=T.NOT_ALNUM)
        if not len(w.hash):
            return out
        e = np.full(len(w.hash), self.other)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, w.hash), len(self.words) - 1)
            e = np.where(self.words[at] == w.hash, self.evidence[at], self.other)
        upto = np.concatenate([[0.0], np.cumsum(e)])
        size = np.diff(w.bounds)
        some = np.flatnonzero(size)
        first = w.bounds[:-1][some]
        whole = (upto[w.bounds[1:][some]] - upto[first]) / size[some]
        out[some, 0] = whole
        for i, k in enumerate(STRETCHES):
            best = np.full(len(e), -np.inf)
            if len(e) >= k:
                mean = (upto[k:] - upto[:-k]) / k
                best[:len(mean)] = np.where(w.doc[:len(mean)] == w.doc[k - 1:], mean, -np.inf)
            best = np.maximum.reduceat(best, first)
            out[some, 1 + i] = np.where(size[some] >= k, best, whole)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        x = self.weights[0] + ((features - self.mean) / self.spread) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


NO_EVIDENCE = Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, np.zeros(7), np.ones(7), np.array([-30.0] + [0.0] * 7))


def labelled_sample(docs: DataFrame, labels: DataFrame, train, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, text, label, curve): the bounded sample, by a hash of the id."""
    rows = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & train)
    rows = rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    rows = rows.join(docs.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    rows = rows.withColumn("order", F.xxhash64("id")).withColumn("curve", F.pmod(F.xxhash64("id", F.lit("curve")), F.lit(4)) == 0)
    parts = [rows.filter(~F.col("curve") & (F.col("label") == k)).orderBy("order", "id").limit(MODEL_ROWS) for k in (0, 1)]
    parts.append(rows.filter("curve").orderBy("order", "id").limit(CURVE_ROWS))
    chosen = parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("order")
    chosen = F.broadcast(chosen)  # 2 * MODEL_ROWS + CURVE_ROWS rows at most
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(chosen, "id")


def continuations(sample: DataFrame) -> DataFrame:
    """(word, c0, c1): how many different words each word follows in each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in T.blocks(batches, "id"):
            w = T.words(block.data, block.offsets, lower=True, between=T.NOT_ALNUM)
            if not len(w.hash):
                continue
            before = np.zeros(len(w.hash), np.uint64)
            before[1:] = np.where(w.doc[1:] == w.doc[:-1], w.hash[:-1], 0)
            label = block.batch["label"].slice(block.first_row, len(block)).to_numpy()[w.doc]
            rows = np.unique(np.rec.fromarrays([label, before, w.hash], names="label,before,word"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(rows["label"]), pa.int32()), pa.array(np.ascontiguousarray(rows["before"]).view(np.int64)),
                 pa.array(np.ascontiguousarray(rows["word"]).view(np.int64))], names=["label", "before", "word"])

    pairs = sample.select("id", "text", "label").mapInArrow(run, "label int, before long, word long").distinct()
    return pairs.groupBy("word").agg(F.count_if(F.col("label") == 0).alias("c0"), F.count_if(F.col("label") == 1).alias("c1"))


def fit(docs: DataFrame, labels: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model of the labelled rows for which the condition ``train`` holds."""
    with Scratch(docs.sparkSession) as scratch:
        sample = scratch.save(labelled_sample(docs, labels, train, id_col, text_col, label_col))
        return fit_sample(sample, scratch.save(continuations(sample.filter("not curve"))))


def fit_sample(sample: DataFrame, counts: DataFrame) -> Model:
    """The model of a labelled sample and its ``continuations``."""
    d = F.lit(DISCOUNT)
    t = counts.agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"), F.sum(F.least("c0", "c1")).alias("common"), F.count(F.lit(1)).alias("words"),
                   F.sum(F.least(F.col("c0").cast("double"), d)).alias("d0"), F.sum(F.least(F.col("c1").cast("double"), d)).alias("d1")).first()
    if not t["n0"] or not t["n1"]:
        return NO_EVIDENCE
    top = counts.filter(F.greatest("c0", "c1") > d).orderBy(F.greatest("c0", "c1").desc(), "word").limit(TABLE_WORDS).collect()
    word = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    c = np.array([[r["c0"], r["c1"]] for r in top], np.float64).reshape(-1, 2)
    shared = (1 - FLOOR) * c.min(axis=1) / max(t["common"], 1) + FLOOR / (t["words"] + 1)
    n, free = np.array([t["n0"], t["n1"]], float), np.array([t["d0"], t["d1"]], float)
    p = np.maximum(c - DISCOUNT, 0) / n + (free / n) * shared[:, None]
    evidence = np.log(p[:, 1]) - np.log(p[:, 0])
    order = np.argsort(word)
    model = Model(word[order], evidence[order], float(np.log(free[1] / n[1]) - np.log(free[0] / n[0])), *([None] * 3))
    rows = _features(sample.filter("curve").select("id", "text", "label"), model).collect()  # CURVE_ROWS rows at most
    if len({r["label"] for r in rows}) < 2:  # too few labels to set any aside
        rows = _features(sample.select("id", "text", "label"), model).collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows], float)
    model.mean, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.weights = logistic((x - model.mean) / model.spread, y)
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 60) -> np.ndarray:
    """Weights (constant first) of a ridge logistic regression, by Newton steps."""
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - keep * w)
        w += step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _features(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in T.blocks(batches, "id"):
            x = model.features(block.data, block.offsets)
            label = block.batch["label"].slice(block.first_row, len(block))
            yield pa.RecordBatch.from_arrays([label, pa.array(list(x), pa.list_(pa.float64()))], names=["label", "x"])

    return rows.mapInArrow(run, "label int, x array<double>")


def scored(model: Model):
    """A column function, text -> score: only the texts go through Python, and other columns stay where they are."""
    @F.arrow_udf("double")
    def of(text: pa.Array) -> pa.Array:
        data, offsets = T.string_buffers(text)
        out = []
        at = 0
        while at < len(text):  # blocks of whole texts, as ``texts.blocks`` cuts them
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + T.BLOCK_BYTES, "right")) - 1)
            out.append(model.score(model.features(data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at])))
            at = end
        T.release()
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return of


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """``docs`` with ``score_col``: 0 to 1, higher where toxic is likelier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in T.blocks(batches, id_col, text_col):
            s = model.score(model.features(block.data, block.offsets))
            rows = block.batch.slice(block.first_row, len(block))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(s)], names=[*rows.schema.names, score_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{score_col}` double")
