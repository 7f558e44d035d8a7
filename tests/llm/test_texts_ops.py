"""Operators on texts against brute force, on a table of odd rows and on an empty one."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemeter.llm import bpe, debruijn, jaccard, licenses, suffix
from lakemeter.llm import texts as T
from lakemeter.llm.queries import RANKS
from tests.llm.conftest import texts

BIG = 2 ** 63 - 1
AZ = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sha(x):
    return hashlib.sha256(x).hexdigest()


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_bpe_matches_the_library_and_round_trips(docs, no_docs):
    import public_tokenizers as P
    import tiktoken

    ranks = bpe.load_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe.encode(docs, RANKS, P.PATTERN)
    got = rows_of(bpe.digests(bpe.decode(encoded, RANKS)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for i, t in texts():
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())))
    assert got == sorted(want, key=repr)
    assert got == rows_of(bpe.digests(bpe.encode(docs, RANKS, P.PATTERN, decoded=True)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert bpe.digests(bpe.encode(no_docs, RANKS, P.PATTERN, decoded=True)).count() == 0


def test_bpe_segment_tree_equals_many_rows_form():
    v = bpe.Vocabulary.load(RANKS, r"\S+")
    r = np.random.default_rng(3)
    pieces = [bytes(r.choice(list(b"theandingion \xc3\xa9"), size=int(n)).tolist()) for n in r.integers(2, 60, 300)]
    many = []
    for p in pieces:
        size = max(4, 1 << (len(p) - 1).bit_length())
        many.append(v.merge_many([p], size)[0])
    assert many == [b"".join(v.id_bytes[x] for x in bpe.merge(p, v.ranks, v.longest)) for p in pieces]


def test_suffix_dedup(docs, no_docs):
    got = rows_of(suffix.report(suffix.remove_repeats(docs.select("doc_id", "text"))), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    by_id, where = {}, {}
    for i, t in sorted(texts(), key=lambda x: (BIG if x[0] is None else x[0])):
        b = (t or "").encode()
        for s in range(len(b) - 99):
            where.setdefault(b[s:s + 100], (BIG if i is None else i, s))
            where[b[s:s + 100]] = min(where[b[s:s + 100]], (BIG if i is None else i, s))
    for i, t in texts():
        b, key = (t or "").encode(), BIG if i is None else i
        by_id.setdefault(key, set()).update(x for s in range(len(b) - 99) if where[b[s:s + 100]] < (key, s) for x in range(s, s + 100))
    want = []
    for i, t in texts():
        b, key = (t or "").encode(), BIG if i is None else i
        gone = [x in by_id[key] for x in range(len(b))]
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want.append((i, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    assert got == sorted(want, key=repr)
    assert suffix.remove_repeats(no_docs.select("doc_id", "text")).count() == 0


def test_suffix_cut_keeps_columns_and_characters(docs):
    cut = suffix.cut_texts(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    kept = {r["doc_id"]: r for r in cut.collect()}
    assert kept[93]["text"].count("é") < 400 and kept[80]["text"] is None and kept[93]["kept"] == "k"
    assert kept[93]["n_chars"] == len(kept[93]["text"])


def test_suffix_array_and_common_prefixes():
    r = np.random.default_rng(1)
    for text in (b"", b"a", b"a" * 300, bytes(r.choice(list(b"ab\x00"), 700).tolist()), b"banana" * 50):
        x = np.frombuffer(text, np.uint8)
        sa, place = suffix.suffix_array(x)
        order = sorted(range(len(text)), key=lambda i: text[i:])
        assert sa.tolist() == order
        lcp = suffix.kasai(x, sa, place, np.arange(0, len(text), 97), 100)
        for k in range(1, len(order)):
            a, b = text[order[k - 1]:], text[order[k]:]
            common = next((j for j, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
            assert lcp[k] == min(common, 100)


def test_suffix_merges_grams_dealt_over_shards(workers, monkeypatch):
    """A gram with more classes than a shard holds gives the same result."""
    from tests.llm.conftest import frame
    rows = [(i, f"{i:06d} " + "the very same middle of every text, longer than a window of bytes " * 2 + f"{i * 7919:08d} end") for i in range(60)]
    frames = frame(workers, rows, 4).select("doc_id", "text")
    whole = rows_of(suffix.report(suffix.remove_repeats(frames)), "doc_id", "n_removed", "kept_sha256")
    data = {i: t.encode() for i, t in rows}
    first = {}
    for i, b in sorted(data.items()):
        for s in range(len(b) - 99):
            first.setdefault(b[s:s + 100], (i, s))
    for i, removed, _ in whole:
        b = data[i]
        assert removed == len({x for s in range(len(b) - 99) if first[b[s:s + 100]] < (i, s) for x in range(s, s + 100)})


def test_debruijn_dedup(docs, no_docs):
    got = rows_of(debruijn.report(debruijn.remove_repeats(docs.select("doc_id", "text"))), "doc_id", "n_words", "n_removed", "kept_sha256")
    first, gone = {}, {}
    for i, t in texts():
        w, key = (t or "").encode().split(), BIG if i is None else i
        for s in range(len(w) - 49):
            k = tuple(w[s:s + 50])
            first[k] = min(first.get(k, key), key)
    for i, t in texts():
        w, key = (t or "").encode().split(), BIG if i is None else i
        gone.setdefault(key, set()).update(x for s in range(len(w) - 49) if first[tuple(w[s:s + 50])] < key for x in range(s, s + 50))
    want = []
    for i, t in texts():
        w, key = (t or "").encode().split(), BIG if i is None else i
        own = [k in gone[key] for k in range(len(w))]
        want.append((i, len(w), sum(own), sha(b" ".join(x for x, g in zip(w, own) if not g))))
    assert got == sorted(want, key=repr)
    assert debruijn.remove_repeats(no_docs.select("doc_id", "text")).count() == 0


def jaccard_brute(rows):
    sets = []
    for i, t in rows:
        w = (t or "").encode().translate(AZ).split()
        sets.append((BIG if i is None else i, {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, o in sets[:a]:
            if s and o and 100 * len(s & o) >= 80 * len(s | o):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((None if i == BIG else i, len(s), None if find(i) == BIG else find(i)) for i, s in sets), key=repr)


@pytest.mark.parametrize("region", [768, 4])
def test_jaccard_join(docs, no_docs, monkeypatch, region):
    """Also with regions too large for a task."""
    monkeypatch.setattr(jaccard, "REGION", region)
    assert rows_of(jaccard.join(docs), "doc_id", "n_shingles", "component_id") == jaccard_brute(texts())
    if region == 4:
        assert jaccard.join(no_docs).count() == 0


def test_jaccard_hot_shingles(docs, monkeypatch):
    """Shingles dealt over several shards."""
    monkeypatch.setattr(jaccard, "HOT", 3)
    assert rows_of(jaccard.join(docs), "doc_id", "n_shingles", "component_id") == jaccard_brute(texts())


def test_jaccard_keeps_one_of_each_group(docs):
    """A document is an id with its text: one of each component stays, and every text without words."""
    kept = jaccard.keep_one(docs)
    rows = sorted(set(texts()), key=lambda x: (BIG if x[0] is None else x[0], x[1] or ""))
    numbered = jaccard_brute([(k, t) for k, (_, t) in enumerate(rows)])
    want = Counter(rows[k] for k, n, c in numbered if n and k == c)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect() if (r["text"] or "").split()) == want
    assert sum(not (r["text"] or "").split() for r in kept.collect()) == sum(not (t or "").split() for _, t in texts())
    assert kept.columns == docs.columns and (8, rows[[i for i, _ in rows].index(8)][1]) in want


def test_jaccard_keeps_rows_without_an_id(workers):
    """Rows without an id are one document only if their texts are alike; a real text stays before an empty one."""
    from tests.llm.conftest import frame
    long = lambda c: " ".join(f"{c}{i}" for i in range(30))
    rows = [(None, long("a")), (None, long("b")), (None, long("b")), (1, long("a") + " more"), (None, None), (None, " "), (2, None), (2, long("c"))]
    got = Counter((r["doc_id"], r["text"]) for r in jaccard.keep_one(frame(workers, rows)).collect())
    assert got == Counter([(None, long("b")), (1, long("a") + " more"), (None, None), (None, " "), (2, None), (2, long("c"))])


def test_many_rows_without_an_id_or_with_one(workers):
    """Work grows with the rows, not with their pairs, and the results are those of documents of their own."""
    import time

    from tests.llm.conftest import frame
    passage = " ".join(f"shared{k}" for k in range(70))
    say = lambda i, side: " ".join(f"{side}{(i * 131 + k) * 7919 % 999983}" for k in range(60))
    rows = [f"{say(i, 'a')} {passage} {say(i, 'b')}" for i in range(1500)]
    start = time.monotonic()
    nameless = frame(workers, [(None, t) for t in rows], 4).select("doc_id", "text")
    cut = sorted(x["n_removed"] for x in debruijn.report(debruijn.remove_repeats(nameless)).collect())
    assert cut[0] == 0 and cut[1:] == [70] * 1499
    cut = suffix.report(suffix.remove_repeats(nameless)).collect()
    assert sum(x["n_removed"] == 0 for x in cut) == 1 and min(x["n_removed"] for x in cut if x["n_removed"]) >= len(passage)
    linked = jaccard.join(nameless).collect()
    assert len(linked) == 1500 and {x["component_id"] for x in linked} == {None}
    assert jaccard.keep_one(nameless).count() == 1500
    one = frame(workers, [(7, t) for t in rows], 4).select("doc_id", "text")
    assert {x["component_id"] for x in jaccard.join(one).collect()} == {7} and jaccard.keep_one(one).count() == 1500
    assert time.monotonic() - start < 300


def test_long_words_of_two_letters_have_hashes_of_their_own(workers):
    """A polynomial modulo a power of two takes these two words of 4,096 letters for one."""
    a = "ab"
    while len(a) < 4096:
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    data = np.frombuffer(f"{a} {b} {a}".encode(), np.uint8)
    h = T.words(data, np.array([0, len(data)])).hash
    assert h[0] == h[2] != h[1]
    from tests.llm.conftest import frame
    fill = " ".join(f"f{k}" for k in range(60))
    docs = frame(workers, [(1, f"{a} {fill}"), (2, f"{b} {fill}"), (3, a), (4, b)]).select("doc_id", "text")
    assert rows_of(jaccard.join(docs), "doc_id", "n_shingles", "component_id") == jaccard_brute([(1, f"{a} {fill}"), (2, f"{b} {fill}"), (3, a), (4, b)])
    assert {x["doc_id"]: x["n_removed"] for x in debruijn.report(debruijn.remove_repeats(docs)).collect()} == {1: 0, 2: 60, 3: 0, 4: 0}


def test_licenses(workers, no_docs):
    from tests.llm.conftest import frame
    filler = "lorem of the dolor and under version " * 40
    gpl = licenses.TEMPLATES["GPL-notice"]
    rows = [(1, filler + "Released under the MIT License. " + filler), (2, filler), (3, None), (4, ""), (5, gpl.replace("redistribute", "share").upper()),
            (6, "licensed under CC BY-NC 4.0"), (7, filler * 5 + licenses.TEMPLATES["MIT-notice"] + filler), (None, "Released under the MIT License")]
    got = {r["doc_id"]: r["license"] for r in licenses.scan(frame(workers, rows)).collect()}
    assert got == {1: "MIT", 2: None, 3: None, 4: None, 5: "GPL-notice", 6: "CC-BY-NC-4.0", 7: "MIT-notice", None: "MIT"}
    assert licenses.scan(no_docs).count() == 0


def test_license_scan_finds_every_notice(workers):
    """Repeated notices, several licenses in a text, and whole license texts."""
    from tests.llm.conftest import frame
    mit, t = "Released under the MIT License", licenses.TEMPLATES
    rows = [(1, f"alpha beta gamma {mit} delta {mit} epsilon"), (2, f"{mit} {mit} {mit}"), (3, " code of the file ".join([t["MIT-notice"]] * 3)),
            (4, f"{mit} and parts {t['Apache-2.0']}"), (5, "Copyright " + t["BSD-3-Clause"]), (6, t["ISC"]), (7, t["Unlicense"]), (8, t["MIT-text"] * 2)]
    got = {r["doc_id"]: [x["license"] for x in r["notices"]] for r in licenses.scan(frame(workers, rows)).collect()}
    assert got == {1: ["MIT"] * 2, 2: ["MIT"] * 3, 3: ["MIT-notice"] * 3, 4: ["MIT", "Apache-2.0"], 5: ["BSD-3-Clause"], 6: ["ISC"],
                   7: ["Unlicense"], 8: ["MIT-text"] * 2}
    assert {r["doc_id"]: (r["first_word"], r["end_word"]) for r in licenses.scan(frame(workers, rows[:1])).collect()} == {1: (3, 8)}


def test_license_scan_tells_relatives_apart(workers):
    """One word less or more makes another license: that one, or none."""
    from tests.llm.conftest import frame
    phrases = {"Licensed under the MIT License": "MIT", "licensed under the Apache License": None, "licensed under the GPL License": None,
               "licensed under the Mozilla License": None, "Licensed under the Apache License, Version 1.1": None, "Released under the GPL License": None,
               "Licensed under CC BY-ND 4.0": None, "Licensed under CC BY 3.0": None, "Licensed under CC BY-NC-SA 4.0": None,
               "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.": None,
               "This work is licensed under the GNU General Public License, version 2": None, "Licensed under the MIT or BSD License": "BSD",
               licenses.TEMPLATES["GPL-notice"].replace("version 3", "version 2"): None,
               "Licensed under the Apache License 2.0": "Apache-2.0", "Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0", "Licensed under the BSD License": "BSD"}
    for before in ("", "Some words before it. "):
        got = {r["doc_id"]: r["license"] for r in licenses.scan(frame(workers, [(i, before + p + " and more.") for i, p in enumerate(phrases)])).collect()}
        assert {p: got[i] for i, p in enumerate(phrases)} == phrases


def test_license_scan_loses_nothing_to_its_windows():
    """Against aligning every template with every stretch of the text."""
    import random
    r = random.Random(2)
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.LEAST)
    common = sorted({w for x in scanner.words.values() for w in x})
    for _ in range(150):
        name = r.choice(scanner.names)
        own = [w if r.random() > 0.15 else b"odd" for w in scanner.words[name]]
        text = [r.choice(common + [b"q%d" % k for k in range(200)]) for _ in range(r.randint(0, 60))]
        text[len(text) // 2:len(text) // 2] = own
        joined = b" ".join(text)
        data = np.frombuffer(joined, np.uint8)
        got = scanner.best(text, T.words(data, np.array([0, len(data)]), between=T.NOT_ALNUM).hash)
        exact = len(licenses.align(scanner.words[name], own)) / len(own)
        if exact >= licenses.LEAST:
            assert got is not None and got[1] >= licenses.LEAST


def test_longest_increasing():
    import itertools
    for p in itertools.permutations(range(6)):
        got = [p[i] for i in licenses.increasing(list(p))]
        best = max(len(c) for k in range(7) for c in itertools.combinations(p, k) if list(c) == sorted(c))
        assert got == sorted(got) and len(got) == best


def test_extra_columns_are_carried(docs):
    assert jaccard.join(docs.withColumn("n", F.lit("x"))).columns == ["doc_id", "n_shingles", "component_id"]


def test_one_python_worker_a_task(docs):
    """An executor keeps every Python worker it has started: no stage of the cut holds two Python steps."""
    plan = suffix.cut_texts(docs)._jdf.queryExecution().executedPlan().toString()
    stage = plan[:plan.index("Exchange")]
    assert stage.count("InArrow") == 1, stage


def test_memory_goes_back_when_the_last_block_is_gone(monkeypatch):
    import weakref

    class Held:
        pass

    seen = []

    def run(batches):
        for x in batches:
            held = Held()
            seen.append(weakref.ref(held))
            yield x

    monkeypatch.setattr(T, "release", lambda: seen.append(all(x() is None for x in seen if callable(x))))
    assert list(T.tidy_batches(run)(iter([1, 2]))) == [1, 2] and seen[-1] is True
    small, large = pa.table({"x": [1]}), pa.table({"x": np.zeros(T.TIDY_BYTES // 8)})
    n = len(seen)
    assert T.tidy_group(lambda key, table: table)(0, small) is small and len(seen) == n
    assert T.tidy_group(lambda key, table: table)(0, large) is large and len(seen) == n + 1
