"""Vector searches and mixing against brute force; models by held-out accuracy and invariants."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemeter.llm import ann, bpe, exact_topk, lm, mixing, toxicity
from lakemeter.llm.queries import QUERIES, RANKS
from lakemeter.llm.texts import crc_mod
from tests.llm.conftest import SF, frame, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def vectors():
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(r.normal(size=6))]) for i in range(120)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.5]) for i in range(200, 230)]  # one vector many times: ties
    rows += [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (302, [float("nan")] + [1.0] * 5), (303, [float("inf")] + [1.0] * 5), (304, [0.0] * 6),
             (305, []), (350, [0.25, -0.5]), (400, [1.0, 2.0]), (None, [1.0] * 6), (5, rows[5][1]), (50, [3.0] * 6), (500, [1e30] + [0.0] * 5)]
    return rows


@pytest.fixture(scope="module")
def table(workers):
    return workers.createDataFrame(vectors(), "vec_id long, embedding array<float>").repartition(3)


def usable(zero):
    rows = {(i, tuple(np.float32(v).astype(float))) for i, v in vectors() if i is not None and v is not None and None not in v
            and all(math.isfinite(x) for x in v) and (zero or any(v))}
    queries = {}
    for i, v in rows:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    return rows, queries


def ranked(rows, queries, score):
    out = []
    for q, v in queries.items():
        found = sorted((-score(v, x), i) for i, x in rows if i != q and len(x) == len(v))[:5]
        out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(found)]
    return sorted(out)


def test_exact_topk(table, workers, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK", 16)
    monkeypatch.setattr(exact_topk, "PIVOTS", 8)
    whole = lambda v: tuple(max(-2 ** 63, min(2 ** 63 - 1, math.floor(256 * x))) for x in v)
    rows, queries = usable(True)
    rows = {(i, whole(v)) for i, v in rows}
    queries = {i: min(w for j, w in rows if j == i) for i in queries}
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in exact_topk.search(table, F.col("id") % 50 == 0).collect())
    clamp = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
    assert [x for x in got if x[0] != 500] == [x for x in ranked(rows, queries, lambda a, b: clamp(sum(p * q for p, q in zip(a, b)))) if x[0] != 500]
    assert exact_topk.search(table.limit(0), F.col("id") % 50 == 0).count() == 0


def test_exact_topk_with_many_copies_of_the_best_pivot(workers):
    """Copies of one row are one candidate: they must not raise the score that others have to reach."""
    rows = [(1, [100.0, 0.0])] * 70 + [(50, [1.0, 0.0])] + [(i, [float(i), 1.0]) for i in range(2, 12)]
    table = workers.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in exact_topk.search(table, F.col("id") == 50).collect())
    assert got == [(50, 1, 1), (50, 2, 11), (50, 3, 10), (50, 4, 9), (50, 5, 8)]


def test_ann_is_exact(table, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rows, queries = usable(False)

    def cosine(a, b):
        a, b = np.array(a), np.array(b)
        return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))

    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(table, F.col("id") % 50 == 0).collect())
    want = ranked(rows, queries, cosine)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=1e-12)
    assert ann.search(table.limit(0), F.col("id") % 50 == 0).count() == 0


def test_mixing_targets_and_draws(docs, no_docs):
    got = mixing.report(mixing.plan_mix(docs)).collect()
    rows = [(i, t, None if i == 84 else f"s{(i or 0) % 4}") for i, t in texts()]
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(size.values()))
    while True:
        rate = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if 3 * size[s] < weight[s] * rate]
        if not full:
            break
        for s in full:
            target[s] = 3 * size[s]
            left -= target[s]
            open_.remove(s)
    target |= {s: weight[s] * rate for s in open_}
    source = {(i, t): s for i, t, s in rows}
    taken = defaultdict(int)
    for r in got:
        s = next(v for (i, t), v in source.items() if i == r["doc_id"])
        assert r["source_size"] == size[s] and abs(r["target"] - target[s]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"] and len(r["shards"]) == r["copies"] and r["taken"] == r["copies"] * r["size"]
        taken[s] += r["taken"]
    for s in size:
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 30), (s, taken[s], target[s])
    again = mixing.report(mixing.plan_mix(docs.repartition(5))).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert mixing.plan_mix(no_docs).count() == 0
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == sum(r["copies"] for r in got if r["doc_id"] not in (7, 8)) + len([r for r in mixed if r["doc_id"] in (7, 8)])


def test_mixing_splits_rows_that_share_an_id(workers):
    """Rows without an id, or with one id, are drawn one by one, also where their texts are equal."""
    rows = [(None, "one two three", "a")] * 500 + [(7, f"word{i} more", "b") for i in range(300)] + [(i, "a b c d", "c") for i in range(700)]
    docs = workers.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.plan_mix(docs).collect()
    assert len(got) == len(rows)
    taken, target = Counter(), {r["source"]: r["target"] for r in got}
    for r in got:
        taken[r["source"]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - target[s]) <= 4 for s in target), (taken, target)
    again = mixing.plan_mix(docs.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert Counter(r["source"] for r in mixing.mix(docs).collect()) == Counter(s for r in got for s in [r["source"]] * r["copies"])


def test_splitting_tree_keeps_exact_quotas(workers):
    quotas = workers.createDataFrame([([193, 7, 0, 64, 1],)], "counts array<int>")
    parts = mixing.splitting_tree(quotas, 5).collect()
    assert sorted(r["shard"] for r in parts) == [0, 1, 2, 3, 4]
    assert np.array([r["counts"] for r in parts]).sum(axis=0).tolist() == [193, 7, 0, 64, 1]
    sizes = [sum(r["counts"]) for r in parts]
    assert max(sizes) - min(sizes) <= 3 and min(min(r["counts"]) for r in parts) >= 0


def test_hypergeometric_inversion(workers):
    """Frequencies over many uniforms follow the distribution."""
    n = 2000
    k = mixing._hypergeometric(F.lit(20), F.lit(8), F.lit(5), (F.col("id") + 0.5) / n)
    got = Counter(r["k"] for r in workers.range(n).select(k.alias("k")).collect())
    for i in range(6):
        p = math.comb(8, i) * math.comb(12, 5 - i) / math.comb(20, 5)
        assert abs(got[i] / n - p) < 0.002


def test_toxicity_learns_and_leaves_clean_texts(workers, no_docs):
    r = random.Random(1)
    words = ["".join(r.choice("lmnopqrst") for _ in range(4)) for _ in range(300)]
    bad = ["vile", "awful", "rotten"]
    rows = []
    for i in range(400):
        w = [r.choice(words) for _ in range(r.choice([20, 60, 400]))]
        if i % 4 == 0:
            for _ in range(3):
                w[r.randrange(len(w))] = r.choice(bad)
        rows.append((i, " ".join(w)))
    docs = frame(workers, rows + [(1000, None), (1001, ""), (None, "vile awful")])
    labels = workers.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(3, 0), (None, 1), (77, None), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, crc_mod("doc_id", 5) != 0)
    got = {r["doc_id"]: r["s"] for r in toxicity.score(docs, model, score_col="s").collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held])
    assert right > 0.97 and got[1000] == got[1001] < 0.5 and all(0 <= x <= 1 for x in got.values())
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert max(r["toxicity"] for r in toxicity.score(docs, none).collect()) < 1e-6


def test_lm_scores(docs, no_docs):
    out = lm.score(docs, crc_mod("doc_id", 7) == 2, RANKS)
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in out.collect()), key=repr)
    az = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: [*WORD.findall((t or "").translate(az)), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    count = Counter(w for i, t in texts() if not held(i) for w in split(t))
    n, v = sum(count.values()), len(count)
    want = sorted(((i, len(split(t)), sum(count[w] > 0 for w in split(t)), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in split(t)))
                   for i, t in texts()), key=repr)
    assert [x[:4] for x in got] == [x[:4] for x in want]
    assert np.allclose([x[4] for x in got], [x[4] for x in want], rtol=1e-9)
    assert all(math.isfinite(x[5]) and x[5] < 0 for x in got)
    assert lm.score(no_docs, F.lit(False), RANKS).count() == 0
    alone = lm.score(docs.limit(5), F.lit(True), RANKS).collect()  # nothing to learn from
    assert all(r["base_score"] == 0 and r["n_known"] == 0 for r in alone)


def lm_training_text(rows):
    """Ids (``0xFFFF`` between) that ``gather`` takes as training text from rows of (id, text)."""
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], names=["doc_id", "text"])
    parts = [np.frombuffer(x, np.uint16) for b in lm.gather_batches(iter([batch]), RANKS, 50256, 8) for x in b["windows"].to_pylist() if x is not None]
    return np.concatenate(parts)


def test_lm_learns_from_every_document():
    """Each document's text is in the training text, whatever its id and length."""
    rows = [(None, f"alone{i} word") for i in range(40)] + [(7, " ".join(f"w{j}x{i}" for j in range(60))) for i in range(5)]
    text = "".join(bpe.Decoder.load(RANKS).token.get(i, b"").decode() for i in lm_training_text(rows).tolist() if i < 50256)
    assert {w for _, t in rows for w in t.split()} <= set(text.split())


def test_lm_learns_each_id_once(monkeypatch):
    """Every id of a document and its end are targets once, after the id before them, however long its words are."""
    monkeypatch.setattr(lm, "SEGMENT", 3, raising=False)
    rows = [(1, "q7" * 400), (2, " ".join("internationalization" * 3 for _ in range(30))), (3, "a b"), (4, ""), (5, None)]
    model = lm.Model(np.arange(lm.IDS), np.arange(lm.IDS), None, 1, {})
    u, target, weight = lm.train_windows(lm_training_text(rows), model, 50256)
    vocabulary = bpe.Vocabulary.load(RANKS, r"\S+")
    want = Counter()
    for _, t in rows:
        own = [i for w in (t or "").split() for i in np.frombuffer(vocabulary.pieces_of([b" " + w.encode()])[0], "<u4").tolist()]
        want.update(zip([50256, *own], [*own, 50256]))
    assert Counter(zip(u[weight > 0].tolist(), target[weight > 0].tolist())) == want


def test_lm_gradients():
    r = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in lm.initial(12, 6).items()}
    p["far"] = r.normal(size=lm.CONTEXT)
    u, target = r.integers(0, 12, (3, lm.CONTEXT)), r.integers(0, 6, (3, lm.CONTEXT))
    weight = (r.random((3, lm.CONTEXT)) > 0.2).astype(float)

    def loss():
        m = lm.Model(None, None, None, 2, p)
        z, sums = lm.attend(m.prepared(), u)
        return -(np.log(z.reshape(3, lm.CONTEXT, -1)[np.arange(3)[:, None], np.arange(lm.CONTEXT), target] / sums[:, 0].reshape(3, -1)) * weight).sum() / weight.sum()

    g = lm.gradients(p, u, target, weight)
    for name in p:
        at = tuple(r.integers(0, s) for s in p[name].shape)
        old, h = p[name][at], 1e-4
        p[name][at] = old + h
        up = loss()
        p[name][at] = old - h
        down = loss()
        p[name][at] = old
        assert abs((up - down) / (2 * h) - g[name][at]) < 1e-4, name


def test_lm_windows_score_each_id_once_and_alike():
    """Overlapping windows give the scores of one walk with the same context."""
    r = np.random.default_rng(2)
    kinds = 6
    model = lm.Model(r.integers(0, 12, lm.IDS), r.integers(0, kinds, lm.IDS), np.zeros(lm.IDS, np.float32), 3, lm.initial(12, kinds))
    sizes = [1, 5, lm.CONTEXT, lm.CONTEXT + 1, 200]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ids = r.integers(0, 100, bounds[-1])
    got, _ = lm.id_scores(model, model.prepared(), ids, bounds, 7)
    t = model.prepared()
    for d, n in enumerate(sizes):
        own = ids[bounds[d]:bounds[d + 1]]
        source = model.unit[np.concatenate([[7], own[:-1]])]
        for i in range(n):
            k = 0 if i < lm.CONTEXT else -(-(i - lm.CONTEXT + 1) // lm.STRIDE)
            begin = k * lm.STRIDE
            window = np.zeros((1, lm.CONTEXT), np.int64)
            part = source[begin:begin + lm.CONTEXT]
            window[0, :len(part)] = part
            z, sums = lm.attend(t, window)
            assert abs(got[bounds[d] + i] - np.log(z[i - begin, model.kind[own[i]]] / sums[i - begin, 0])) < 1e-4


def test_lm_subwords_and_places(monkeypatch):
    """Ids of words kept from block to block, also when the store is emptied; logits of some places only."""
    monkeypatch.setattr(lm.Subwords, "LIMIT", 40)
    store, vocabulary, r = lm.Subwords(RANKS), bpe.Vocabulary.load(RANKS, r"\S+"), np.random.default_rng(3)
    for block in range(6):
        words = [b"w%dunbelievably" % i for i in r.integers(0, 30 + 20 * block, 50)]
        edge = np.concatenate([[0], np.cumsum([len(x) for x in words])])
        hashes = np.array([zlib.crc32(x) for x in words], np.uint64)
        ids, sizes = store.look_up(np.unique(hashes, return_index=True, return_inverse=True),
                                   np.frombuffer(b"".join(words), np.uint8), edge[:-1], edge[1:])
        want = [np.frombuffer(x, "<u4").tolist() for x in vocabulary.pieces_of([b" " + x for x in words])]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    t = lm.Model(None, None, None, 2, lm.initial(12, 6)).prepared()
    u = r.integers(0, 12, (5, lm.CONTEXT))
    places = np.flatnonzero(r.random(u.size) > 0.4)
    for some, every in zip(lm.attend(t, u, places), lm.attend(t, u)):
        assert np.allclose(some, every[places], rtol=1e-5)


def test_pipeline_stages(workers):
    import corpus_pipeline

    docs = workers.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in kept.select("doc_id").collect()}
        kept = stage(workers, kept, SF).cache()
        assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} <= before
    out = corpus_pipeline.STAGES[-1][1](workers, kept, SF)
    assert out.count() == kept.count() and {"doc_id", "n_tokens", "ids_sha256"} <= set(out.columns)


def test_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_lm_company_and_steps():
    """Company against pairs counted one by one; a walk of the descent against Adam written out."""
    r = np.random.Generator(np.random.PCG64(5))
    sizes = np.array([0, 1, 31, 40, 7000])
    parts = list(lm.segments(r.integers(0, 300, sizes.sum()).astype(np.uint16), np.concatenate([[0], np.cumsum(sizes)]), 50256))
    unit = r.integers(0, lm.UNITS, lm.IDS)
    want = np.zeros((lm.UNITS, lm.COMPANY))
    for part in parts:
        for seg in np.split(part, np.flatnonzero(part == lm._STOP) + 1)[:-1]:
            seg = seg[lm.CONTEXT - lm.STRIDE + 2:-1] if seg[0] == lm._MORE else seg[:-1]
            for at in range(0, len(seg), lm.CONTEXT):
                u = unit[seg[at:at + lm.CONTEXT]]
                np.add.at(want, (u[:, None], u[None, :] % lm.COMPANY), 1)
    assert (lm.company(np.concatenate(parts), unit) == want).all()

    p = lm.initial(64, 6)
    u, target, weight = r.integers(0, 64, (150, 32)), r.integers(0, 6, (150, 32)), np.ones((150, 32), np.float32)
    got = lm.descend(p, (u, target, weight), 1, 0.01, 3)
    q, m, s = ({k: f(v) for k, v in p.items()} for f in (np.copy, np.zeros_like, np.zeros_like))
    order = np.random.Generator(np.random.PCG64(3)).permutation(150)
    for step, at in enumerate(range(0, 150, 64), 1):
        some = order[at:at + 64]
        for k, g in lm.gradients(q, u[some], target[some], weight[some]).items():
            m[k] += 0.1 * (g - m[k])
            s[k] += 0.01 * (g * g - s[k])
            q[k] = q[k] - 0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-6)
    assert all(np.allclose(got[k], q[k], atol=1e-5) for k in p) and not np.allclose(got["e"], p["e"], atol=1e-3)
