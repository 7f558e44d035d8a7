"""Properties: latest-wins equals a ranking window; exact percentiles equal the built-in."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemeter.operators.dedup import flag_latest, latest_rows

rows = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 3)),        # key (NULL allowed)
              st.one_of(st.none(), st.integers(0, 4)),        # first order column (NULL allowed)
              st.sampled_from(["a", "b", "c"])),              # second order column
    min_size=1, max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_flag_latest_matches_ranking_window(spark, data):
    # a unique last order column, as the operator requires
    df = spark.createDataFrame([(k, o, s, i) for i, (k, o, s) in enumerate(data)],
                               "k int, o int, s string, seq int")
    order = ["o", "s", "seq"]
    w = Window.partitionBy("k").orderBy(*[F.col(c).desc_nulls_last() for c in order])
    ref = {r.seq for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1").collect()}
    got = {r.seq for r in flag_latest(df, ["k"], order).where("is_latest").collect()}
    assert got == ref
    assert {r.seq for r in latest_rows(df, ["k"], order).collect()} == ref


values = st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-5, 5).map(lambda x: x / 2))),
                  min_size=1, max_size=40)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=values, slices=st.integers(1, 5))
def test_exact_percentiles_match_builtin(spark, data, slices):
    from lakemeter.operators.stats import exact_percentiles
    df = spark.createDataFrame(data, "g int, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    ours = {r.g: [r[n] for n in ("p00", "p25", "p50", "p90", "p100")]
            for r in exact_percentiles(df, ["g"], "v", probs, slices=slices).collect()}
    ref = {r.g: r.p for r in df.groupBy("g").agg(
        F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("p")).collect() if r.p is not None}
    assert set(ours) == set(ref)
    for g, expected in ref.items():
        assert all(abs(x - y) < 1e-9 for x, y in zip(ours[g], expected))
