import datetime as dt

import pytest

from lakemeter.plans import tables as T


def _df(spark, rows):
    return spark.createDataFrame(rows, "k int, d date, v double")


D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def test_pure_keyed_writes(spark):
    target = _df(spark, [(1, D1, 1.0), (2, D1, 2.0), (None, D2, 9.0)])
    source = _df(spark, [(2, D1, 20.0), (3, D2, 30.0), (3, D2, 31.0), (None, D2, 90.0)])
    ins = {(r.k, r.v) for r in T.insert_only(target, source, ["k"]).collect()}
    assert ins == {(1, 1.0), (2, 2.0), (None, 9.0), (3, 31.0)}  # NULL key matched null-safely
    ups = {(r.k, r.v) for r in T.upsert(target, source.where("v <> 31.0"), ["k"]).collect()}
    assert ups == {(1, 1.0), (2, 20.0), (3, 30.0), (None, 90.0)}
    dele = {r.k for r in T.delete_matching(target, _df(spark, [(0, D1, 0.0), (0, None, 0.0)]), "d").collect()}
    assert dele == {None}


def test_store_partitioned_replace_and_delete(spark, scratch):
    store = T.TableStore(spark, scratch, {"silver.t": "d"})
    store.upsert("silver.t", _df(spark, [(1, D1, 1.0), (2, D2, 2.0), (3, D3, 3.0)]), ["k"])
    store.upsert("silver.t", _df(spark, [(2, D2, 22.0), (4, D2, 4.0)]), ["k"])
    assert {(r.k, r.v) for r in store.read("silver.t").collect()} == {(1, 1.0), (2, 22.0), (3, 3.0), (4, 4.0)}
    # replace: affected D1 and D3, new content only for D3 -> D1 partition disappears
    affected = _df(spark, [(0, D1, 0.0), (0, D3, 0.0)])
    store.replace_partitions("silver.t", _df(spark, [(5, D3, 5.0)]), affected)
    assert {(r.k, r.d) for r in store.read("silver.t").collect()} == {(2, D2), (4, D2), (5, D3)}
    store.delete_matching("silver.t", _df(spark, [(0, D2, 0.0)]), "d")
    assert {r.k for r in store.read("silver.t").collect()} == {5}
    with pytest.raises(T.DuplicateKeyError):
        store.upsert("silver.t", _df(spark, [(7, D1, 1.0), (7, D1, 2.0)]), ["k"])


def test_store_insert_only_counts(spark, scratch):
    store = T.TableStore(spark, scratch)
    first = store.insert_only("bronze.raw", _df(spark, [(1, D1, 1.0), (2, D1, 2.0)]), ["k"])
    again = store.insert_only("bronze.raw", _df(spark, [(1, D1, 1.0), (3, D1, 3.0)]), ["k"])
    assert first == {"seen": 2, "inserted": 2} and again == {"seen": 2, "inserted": 1}
    assert store.read("bronze.raw").count() == 3
    store.overwrite("bronze.raw", _df(spark, [(9, D1, 9.0)]))
    assert [r.k for r in store.read("bronze.raw").collect()] == [9]


def test_upsert_follows_keys_that_change_partition_and_null_partitions(spark, scratch):
    from lakemeter.plans.tables import TableStore
    store = TableStore(spark, scratch, {"silver.t": "p"})
    make = lambda rows: spark.createDataFrame(rows, "k long, v string, p string")
    read = lambda: sorted(((r["k"], r["v"], r["p"]) for r in store.read("silver.t").collect()), key=repr)
    store.upsert("silver.t", make([(1, "a", "x"), (2, "b", "x"), (8, "n", None), (5, "c", "a:b")]), ["k"])
    store.upsert("silver.t", make([(1, "A", "y"), (9, "m", None)]), ["k"])
    assert read() == sorted([(1, "A", "y"), (2, "b", "x"), (8, "n", None), (9, "m", None), (5, "c", "a:b")], key=repr)
    store.upsert("silver.t", make([(2, "B", "y")]), ["k"])
    assert read() == sorted([(1, "A", "y"), (2, "B", "y"), (8, "n", None), (9, "m", None), (5, "c", "a:b")], key=repr)
    store.delete_matching("silver.t", make([(0, "", "a:b")]), "p")
    assert read() == sorted([(1, "A", "y"), (2, "B", "y"), (8, "n", None), (9, "m", None)], key=repr)


def test_insert_only_may_keep_repeats(spark, scratch):
    from lakemeter.plans.tables import TableStore
    store = TableStore(spark, scratch)
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string")
    assert store.insert_only("silver.q", rows, ["k"], keep_repeats=True) == {"seen": 3, "inserted": 3}
    assert store.insert_only("silver.q", rows, ["k"], keep_repeats=True) == {"seen": 3, "inserted": 0}
    assert store.read("silver.q").count() == 3
