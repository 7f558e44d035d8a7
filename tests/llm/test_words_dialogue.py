"""BPE with word ends, spelling variants and conversation repair against the library and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemeter.llm import bpe, dialogue, spelling, word_bpe
from lakemeter.llm import queries as Q
from lakemeter.session import Scratch
from tests.llm.conftest import SF, texts


def sha(x):
    return hashlib.sha256(x).hexdigest()


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# -- BPE with word ends ----------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(Q.WORD_ENDS)


ODD = ["", "  \t ", "Hello, world's <|endoftext|>héé<|startoftext|><|endoftext|", "ΣΑΣ ΌΣΟΣ İstanbul ǅ ﬁ ½²٣", "é \x1c\x85\xa0x y",
       "'S 'LL don't DON'T 'ré", "á ́b", "漢字kana カ🙂🙂 👨‍👩‍👧", "가나 가", "z" * 5000, "the the THE", "Ᲊx Ƛy \U00010d50",
       "<|endoftext|>" * 3, "a" * 40 + " " + "ab" * 3000, "\x00\x01 ﻿bom"]


def test_word_bpe_equals_the_library(library):
    own = word_bpe.Tokenizer.load(Q.WORD_ENDS)
    r = random.Random(4)
    made = ["".join(chr(c) for c in (r.choice([r.randrange(top), 32, 0x301, r.randrange(97, 123)]) for _ in range(r.randint(1, 60)))
                    if not 0xD800 <= c < 0xE000) for top in (0x80, 0x250, 0x600, 0x3000, 0x20000) for _ in range(60)]
    for text in ODD + made:
        want = library.encode(text, add_special_tokens=False).ids
        ids = own.encode(text.encode())
        assert np.frombuffer(ids, "<u4").tolist() == want, ascii(text)[:80]
        assert own.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_word_bpe_query_form(docs, no_docs, workers, library):
    encoded = word_bpe.encode(docs, Q.WORD_ENDS)
    got = rows_of(bpe.digests(word_bpe.decode(encoded, Q.WORD_ENDS)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for i, t in texts():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert got == sorted(want, key=repr)
    assert got == rows_of(bpe.digests(word_bpe.encode(docs, Q.WORD_ENDS, decoded=True)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert bpe.digests(word_bpe.encode(no_docs, Q.WORD_ENDS, decoded=True)).count() == 0
    whole = workers.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: sha(np.array(library.encode(r["text"] or "", add_special_tokens=False).ids, "<u4").tobytes()) for r in whole}
    assert {r["doc_id"]: r["ids_sha256"] for r in Q.op11_word_bpe(workers, SF).collect()} == want


def test_word_bpe_merges_stay_fast_and_memory_is_bounded():
    import time

    own = word_bpe.Tokenizer.load(Q.WORD_ENDS)
    start = time.monotonic()
    assert len(own.encode(b"theandingion" * 40_000)) > 0
    assert time.monotonic() - start < 30
    small = word_bpe._Memory(lambda key: key + b"!", 10)
    for i in range(105):
        assert small[b"word%d" % i] == b"word%d!" % i and small[b"often"] == b"often!"
        assert len(small) <= 10 and len(small.elder) <= 10 and (b"often" in small or b"often" in small.elder)
    assert small[b"x" * 100] and b"x" * 100 not in small


def test_word_bpe_refuses_other_kinds():
    with pytest.raises(ValueError):
        word_bpe.Tokenizer({"model": {}, "normalizer": {"normalizers": [{"type": "NFD"}]}, "pre_tokenizer": {"pretokenizers": []}, "decoder": None, "added_tokens": []})


# -- spelling variants ---------------------------------------------------------------------------
def near_words(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows, every=199):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in words if near_words(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, c in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, c, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def spelled():
    """Documents of words in chains of rising counts, with ties, doubled letters, accents and a very long word."""
    r = random.Random(9)
    counts = {"thousand": 400, "thousamd": 60, "thousam": 9, "housam": 5, "thousandd": 30, "thousaand": 6, "Éclairé": 50, "Èclairé": 6, "éclairé": 7,
              "straße": 40, "strasse": 5, "stra×e": 7, "stra÷e": 7, "aabbcc": 5, "abbcc": 50, "aabcc": 50, "abcdef": 30, "abcdeg": 30, "abcdeh": 6,
              "x" * 3000: 30, "x" * 2999 + "y": 6, "x" * 2999: 5, "y" * 64: 40, "y" * 65: 7, "y" * 63: 6, "seldom": 4, "UPPERCASE": 9, "UPPERCASEÉ": 50}
    words = [w for w, n in counts.items() for _ in range(n)]
    r.shuffle(words)
    rows = [(i, r.choice([" ", ", ", "\n", "-", "2"]).join(words[at:at + 17])) for i, at in enumerate(range(0, len(words), 17))]
    return rows + [(None, "thousand thousand"), (3, None), (4, ""), (5, "\t 12 ..."), (6, rows[0][1]), (6, rows[0][1])]


@pytest.mark.parametrize("every,limits", [(199, spelling.Limits()), (7, spelling.Limits(counted=20, slice_words=5, pass_slices=2, longest=8))])
def test_spelling_variants(workers, every, limits):
    rows = spelled()
    df = workers.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    assert rows_of(spelling.variants(df, every=every, limits=limits), *COLUMNS) == brute_variants(rows, every)


def test_spelling_of_tables(workers, no_docs):
    rows = [tuple(r) for r in workers.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(Q.op12_spelling_variants(workers, SF), *COLUMNS) == brute_variants(rows)
    empty = spelling.variants(no_docs)
    assert empty.columns == list(COLUMNS) and empty.count() == 0
    rare = no_docs.sparkSession.createDataFrame([(1, "several words, each once")], "doc_id long, text string")
    assert spelling.variants(rare).count() == 0


def test_filters_have_no_false_negatives_and_few_false_positives():
    h = spelling.mix(np.arange(1, 200_001, dtype=np.uint64))
    blocks = spelling.build(h[:100_000])
    assert spelling.hit(blocks, h[:100_000]).all()
    assert spelling.hit(blocks, h[100_000:]).mean() < 0.02


# -- conversation repair ------------------------------------------------------------------------------
def brute_repair(symbols):
    """Exhaustive search over audits with all costs up to that of deleting every row."""
    best = [3 * len(symbols) + 1, ""]

    def go(i, q, cost, audit):
        if cost > best[0]:
            return
        if i == len(symbols) and q in (0, 3) and [cost, audit] < best:
            best[:] = [cost, audit]
        asked = {0: "u", 1: "u", 2: "a", 3: "u"}[q]
        to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
        if cost + 2 <= best[0]:
            go(i, to[q, asked], cost + 2, audit + "I")
        if i < len(symbols):
            initial, must, cut = symbols[i]
            go(i + 1, q, cost + 3, audit + "D")
            if not must:
                if (q, initial) in to:
                    go(i + 1, to[q, initial], cost + cut, audit + "K")
                go(i + 1, to[q, asked], cost + 2 + cut, audit + "R")

    go(0, 0, 0, "")
    return best[0], best[1]


def brute_conversations(rows):
    by = {}
    for conv, turn, role, text in rows:
        out = by.setdefault(conv, [])
        written = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{written(conv)}:{written(turn)}".encode()) % 20
        role, text = written(role), written(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    result = []
    for conv, after in by.items():
        key = lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest())
        after.sort(key=key)
        seen, symbols, count = set(), [], Counter()
        for _, role, text in after:
            solid = re.sub("[\x20\x09-\x0D]", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            count[fault] += 1
            symbols.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        cost, audit = brute_repair(symbols)
        lines, state, row = [], "", iter(after)
        for e in audit:
            item = None if e == "I" else next(row)
            if e == "D":
                continue
            asked = "assistant" if state == "u" else "user"
            role, text = (asked, "") if e == "I" else (asked if e == "R" else item[1], item[2])
            state = role[:1]
            lines.append(f"{role}:{text}")
        turns = [t for t, _, _ in after if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        result.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha("\n".join(lines).encode())))
    return sorted(result, key=repr)


REPORT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, mark string, part int, seq int, kind string"


def talk():
    r = random.Random(11)
    rows = []
    for conv in range(60):
        for t in range(r.randint(1, 7)):
            role = r.choice(["system"] * (t == 0) + ["user", "assistant"] * 3 + ["tool", "usher", None])
            text = r.choice(["Yes.", "No!", "Well", "", None, " \t", "A longer text?\n", f"text {r.random()}.", f"cut {r.random()}"])
            rows.append((conv, r.choice([t, t * 2, t]), role, text))
    rows += [(100, None, "user", "a."), (100, None, "user", "a."), (100, 3, "assistant", "b."), (None, 1, "user", "x."), (None, None, "assistant", "y."),
             (101, 5, "", "z."), (101, 6, "user", "ok."), (102, None, None, None)]
    dropped = next(c for c in range(1000, 5000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(dropped, 0, "user", "gone.")] + rows[:5]


def conversations(spark, rows, parts=3):
    return spark.createDataFrame([(*x, "m", 1, 2, "k") for x in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("block", [256, 2])
def test_conversation_repair(workers, block):
    rows = talk()
    assert rows_of(dialogue.report(conversations(workers, rows), size=block), *REPORT) == brute_conversations(rows)


def test_conversation_repair_of_tables(workers):
    rows = [tuple(r) for r in workers.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(Q.op13_conversation_repair(workers, SF), *REPORT) == brute_conversations(rows)
    empty = dialogue.report(conversations(workers, []))
    assert empty.columns == list(REPORT) and empty.count() == 0


def test_search_from_both_ends_equals_exhaustive():
    r = random.Random(3)
    for _ in range(1500):
        rows = "".join(r.choice("suaxSUAXDua") for _ in range(r.randint(0, 6)))
        symbols = [("" if x == "D" else x.lower(), x == "D", int(x in "SUAX")) for x in rows]
        assert dialogue.cheapest(rows, 0, dialogue.ENDS, True) == brute_repair(symbols), rows


def test_long_conversation_in_blocks_equals_one_search(workers):
    r = random.Random(8)
    rows = [(1, t // 3 * 2, r.choice(["user", "assistant", "tool", "system"]), r.choice(["same.", f"cut {t}", f"whole {t}.", f"whole {t}!", ""])) for t in range(900)]
    rows += [(1, 2000, "user", "again and again.")] * 300 + [(2, t, ["user", "assistant"][t % 2], f"t {t}.") for t in range(50)]
    df = conversations(workers, rows, 5).select(*[F.col(c) for c in ("conv_id", "turn", "role", "text")], F.lit(1).alias("copies"))
    with Scratch(workers) as scratch:
        done = dialogue.repair(df, scratch, size=16)
        report = {x["conv_id"]: x for x in done.report.collect()}
        repaired = done.rows.orderBy("conv_id", "part", "seq", "place").collect()
    after = sorted([x for x in rows if x[0] == 1], key=lambda x: (x[1], x[2], hashlib.sha256(f"{len(x[2])}:{x[2]}{x[3]}".encode()).digest()))
    seen, symbols = set(), ""
    for _, _, role, text in after:
        initial = role[0] if role[0] in "sua" else "x"
        symbols += "D" if not text or (role, text) in seen else initial if text[-1] in ".!" else initial.upper()
        seen.add((role, text))
    assert (report[1]["cost"], report[1]["audit"]) == dialogue.cheapest(symbols, 0, dialogue.ENDS, True)
    assert report[1]["illegal"] == sum(a[2][0] + b[2][0] not in dialogue.LEGAL for a, b in zip(after, after[1:]))
    assert report[1]["gaps"] == 2001 - len({x[1] for x in after})
    form = "".join(x["role"][0] for x in repaired if x["conv_id"] == 1)
    assert re.fullmatch("(s?(ua)+)?", form) and len(form) == sum(c != "D" for c in report[1]["audit"])
    assert (report[2]["cost"], report[2]["audit"]) == (0, "K" * 50)


# -- the pipeline on odd rows ---------------------------------------------------------------------------
def test_pipeline_takes_odd_rows_and_none(workers, docs, no_docs):
    """Null and repeated ids, empty texts, clashing column names, an empty table: every stage gives its rows."""
    import corpus_pipeline
    from lakemeter.session import materialize

    for rows in (docs, no_docs):
        kept = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = kept
            kept = materialize(stage(workers, before, SF))
            assert kept.columns == rows.columns, name
            if name == "near_duplicates" and before.count():
                empty = F.coalesce(F.trim("text"), F.lit("")) == ""
                assert kept.filter(empty).count() == before.filter(empty).count()
                assert kept.select("doc_id", "text").distinct().count() == kept.filter(~empty).count() + kept.filter(empty).select("doc_id", "text").distinct().count()
        encoded = corpus_pipeline.STAGES[-1][1](workers, kept, SF)
        assert encoded.count() == kept.count() and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(encoded.columns)
