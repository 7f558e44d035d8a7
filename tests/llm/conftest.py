import os

import pytest
from pyspark.sql import types as S

from lakemeter.llm.queries import importable

DOCS = S.StructType([S.StructField("doc_id", S.LongType()), S.StructField("text", S.StringType()), S.StructField("lang", S.StringType()),
                     S.StructField("source", S.StringType()), S.StructField("n_chars", S.LongType()),
                     # names that operators use inside
                     S.StructField("id", S.StringType()), S.StructField("size", S.LongType()), S.StructField("hash", S.StringType()),
                     S.StructField("kept", S.StringType()), S.StructField("score", S.StringType()), S.StructField("_bucket", S.StringType())])


def texts():
    """(id, text): copies, near copies, shared passages, repeats, odd white space, nulls, long runs."""
    import random

    r = random.Random(5)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(1, 7))) for _ in range(400)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    passage = say(70)
    rows = []
    for i in range(60):
        w = say(r.choice([3, 4, 5, 30, 80, 200]))
        if i % 6 == 0:
            w[len(w) // 2:len(w) // 2] = passage
        rows.append((i, " ".join(w)))
    for i in range(60, 75):  # near copies of one document, some linked only through others
        w = rows[11][1].split() if len(rows[11][1].split()) > 60 else rows[6][1].split()
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = "x" + str(i)
        rows.append((i, " ".join(w)))
    rows += [(80, None), (81, ""), (82, "  \t\n "), (83, "Ünïcode ½ 漢字 🙂   tail "), (84, "word"), (85, "Word"), (86, "a b c d"), (87, "A b C d")]
    rows += [(90, "ab " * 300), (91, "ab " * 120), (92, "z" * 3000), (93, "é" * 400 + " end"), (94, " ".join(passage).upper())]
    rows += [(None, " ".join(passage)), (7, rows[7][1]), (8, " ".join(say(90)))]  # null id, repeated row, id with another text
    return rows


@pytest.fixture(scope="session")
def workers(spark):
    importable(spark)
    return spark


def frame(spark, rows, parts=3):
    full = [(i, t, "en", f"s{(i or 0) % 4}" if i != 84 else None, None if t is None else len(t), "x", 1, "h", "k", "s", "b") for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


@pytest.fixture(scope="session")
def docs(workers):
    return frame(workers, texts()).cache()


@pytest.fixture(scope="session")
def no_docs(workers):
    return workers.createDataFrame([], DOCS)


SF = os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.001")
