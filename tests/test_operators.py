"""Operators on small frames: nulls, ties, empties, hot keys, chunk borders."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from plantmart.operators import checks, dedup, joins, ordered, ranking, reshape
from plantmart.operators.aggregates import share_between_0_and_1, text_set, weighted_average
from plantmart.operators.attribution import barrier_fill


def rows(df, *order):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: tuple((x is not None, x) for x in r))


def test_latest_and_first_are_order_independent(spark):
    data = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "n"), (None, 2, "k")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, t int, v string").repartition(4)
        assert rows(dedup.latest_by(df, ["k"], ["t", "v"])) == [(None, 2, "k"), ("a", 3, "z"), ("b", None, "n")]
        assert rows(dedup.first_by(df, ["k"], ["t", "v"])) == [(None, 2, "k"), ("a", 1, "x"), ("b", None, "n")]


def test_latest_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.latest_by(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_release_keeps_all_rows_of_the_release(spark):
    df = spark.createDataFrame([("a", 1, "r1"), ("a", 2, "r2"), ("a", 3, "r2"), ("b", 1, "r1")], "k string, n int, r string")
    assert rows(dedup.latest_release(df, ["k"], "r", ["n"]).select("k", "n")) == [("a", 2), ("a", 3), ("b", 1)]


def events(spark, count=400, units=3, seed=1):
    rnd = random.Random(seed)
    data = [(0 if rnd.random() < 0.5 else rnd.randrange(units), t, rnd.choice([None, None, float(t)])) for t in range(count)]
    return data, spark.createDataFrame(data, "u int, t int, v double").repartition(5)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_chunked_scans_equal_plain_loops(spark, width):
    data, df = events(spark)
    chunk = F.floor(F.col("t") / width)
    by_unit: dict[int, list] = {}
    for u, t, v in data:
        by_unit.setdefault(u, []).append((t, v))
    nxt, fwd, back, before, nth = set(), set(), set(), set(), set()
    for u, items in by_unit.items():
        last, total = None, 0.0
        for i, (t, v) in enumerate(items):
            nxt.add((u, t, items[i + 1][0] if i + 1 < len(items) else None))
            last = v if v is not None else last
            fwd.add((u, t, last))
            back.add((u, t, next((x for _, x in items[i:] if x is not None), None)))
            before.add((u, t, total))
            total += v or 0.0
            nth.add((u, t, i + 1))
    got = ordered.next_value(df, "t", ["u"], ["t"], chunk, "n").select("u", "t", "n")
    assert set(map(tuple, got.collect())) == nxt
    got = ordered.forward_fill(df, {"v": "f"}, ["u"], ["t"], chunk).select("u", "t", "f")
    assert set(map(tuple, got.collect())) == fwd
    got = ordered.backward_fill(df, {"v": "f"}, ["u"], ["t"], chunk).select("u", "t", "f")
    assert set(map(tuple, got.collect())) == back
    got = ordered.total_before(df, "v", ["u"], ["t"], chunk, "s").select("u", "t", "s")
    assert set(map(tuple, got.collect())) == before
    got = ordered.occurrence_index(df, ["u"], ["t"], chunk, "n").select("u", "t", "n")
    assert set(map(tuple, got.collect())) == nth


def test_scans_without_chunk_and_on_empty_input(spark):
    data, df = events(spark, 20)
    assert ordered.next_value(df, "t", ["u"], ["t"], None, "n").filter("n IS NULL").count() == len({u for u, _, _ in data})
    empty = df.filter(F.lit(False))
    assert ordered.forward_fill(empty, {"v": "f"}, ["u"], ["t"], F.col("t")).count() == 0


def test_a_busy_unit_is_cut_into_many_chunks(spark):
    data = [("hot", 1_700_000_000 + 40 * i) for i in range(600)] + [("calm", 1_700_000_000), (None, 1_700_000_000)]
    df = spark.createDataFrame(data, "u string, s long").withColumn("ts", F.timestamp_seconds("s"))
    chunk = ordered.time_chunk("ts")
    parts = {r.u: r.n for r in df.groupBy("u").agg(F.count_distinct(chunk).alias("n")).collect()}
    assert parts["calm"] == 1 and parts[None] == 1 and parts["hot"] >= 6
    got = ordered.next_value(df, "s", ["u"], ["s"], chunk, "n").filter("u = 'hot'")
    assert {r.n - r.s for r in got.filter("n IS NOT NULL").collect()} == {40} and got.filter("n IS NULL").count() == 1


@pytest.mark.parametrize("cut", [True, False])
def test_running_totals_outgrow_the_measure_s_type(spark, cut):
    df = spark.createDataFrame([(1, k, 2_000_000_000) for k in range(4)], "u int, t int, v int")
    got = ordered.total_before(df, "v", ["u"], ["t"], F.col("t") if cut else None, "s")
    assert {r.t: r.s for r in got.collect()} == {k: k * 2_000_000_000 for k in range(4)}


def test_null_unit_is_a_group_of_its_own(spark):
    df = spark.createDataFrame([(None, 1), (None, 5), (1, 2)], "u int, t int")
    assert rows(ordered.next_value(df, "t", ["u"], ["t"], F.col("t"), "n")) == [(None, 1, 5), (None, 5, None), (1, 2, None)]


def sentinel_fill(items):
    """The rule in its sentinel form, one unit: (state, value) -> value."""
    step = [("-" if s in ("IDLE", "CHANGE-OVER") else v) for s, v in items]
    last = None
    for i, v in enumerate(step):
        last = v if v is not None else last
        step[i] = last
    step = ["empty" if s == "IDLE" else (None if v == "-" else v) for (s, _), v in zip(items, step)]
    following = None
    for i in range(len(step) - 1, -1, -1):
        following = step[i] if step[i] is not None else following
        step[i] = following
    return [None if v == "empty" else v for v in step]


@pytest.mark.parametrize("width", [None, 1, 3, 50])
def test_barrier_fill_equals_sentinel_form(spark, width):
    rnd = random.Random(7)
    data, want = [], {}
    for unit in range(150):
        items = [(rnd.choice(["RUNNING", "RUNNING", "IDLE", "CHANGE-OVER", None]), rnd.choice([None, "a", "b"])) for _ in range(rnd.randrange(1, 14))]
        data += [(unit, t, s, v) for t, (s, v) in enumerate(items)]
        for t, v in enumerate(sentinel_fill(items)):
            want[unit, t] = v
    df = spark.createDataFrame(data, "u int, t int, s string, v string").repartition(4)
    chunk = None if width is None else F.floor(F.col("t") / width)
    got = barrier_fill(df, ["v"], F.col("s") == "IDLE", F.col("s") == "CHANGE-OVER", ["u"], ["t"], chunk)
    assert {(r.u, r.t): r.v for r in got.collect()} == want


def test_next_step_ends_open(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 5.0), ("a", 5.0), ("b", 2.0)], "k string, q double")
    assert rows(ordered.next_step(df, ["k"], "q", "m", 1e12)) == [("a", 1.0, 5.0), ("a", 5.0, 1e12), ("b", 2.0, 1e12)]


def test_quantiles_match_linear_interpolation_with_a_hot_value(spark):
    values = [0.0] * 500 + [float(i) for i in range(1, 1000)] + [None] * 10
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    exact = df.select(F.percentile("v", F.array(F.lit(0.0), F.lit(0.25), F.lit(0.8), F.lit(0.9), F.lit(1.0))).alias("p")).first().p
    got = ranking.exact_quantiles(df, "v", {"a": 0.0, "b": 0.25, "c": 0.8, "d": 0.9, "e": 1.0}).first()
    assert list(got) == pytest.approx(exact)


def test_quantiles_of_nothing_and_of_one(spark):
    df = spark.createDataFrame([(3.0,)], "v double")
    assert tuple(ranking.exact_quantiles(df, "v", {"a": 0.9}).first()) == (3.0,)
    assert tuple(ranking.exact_quantiles(df.filter("v > 9"), "v", {"a": 0.9}).first()) == (None,)


def test_surrogate_ids_are_dense_ordered_and_null_safe(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 2), (None, 5), ("a", None)], "k string, n int")
    got = ranking.surrogate_ids(df, ["k", "n"])
    assert rows(got) == [(None, 5, 880), ("a", None, 881), ("a", 2, 882), ("a", 2, 882), ("b", 1, 883)]


def test_bands_include_their_border(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    got = ranking.band_by_quantile(df, "v", [("Large", 0.9), ("Medium", 0.8)], "Small", "s")
    assert {r.v: r.s for r in got.collect()} == {**{float(i): "Small" for i in range(8)}, 8.0: "Medium", 9.0: "Large", 10.0: "Large"}


def test_membership_ignores_nulls_in_the_list(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    members = spark.createDataFrame([("a",), (None,), ("a",)], "m string")
    assert rows(joins.only_members(df, members, {"k": "m"})) == [("a",)]
    assert rows(joins.without_members(df, members, {"k": "m"})) == [(None,), ("b",)]


def test_membership_in_a_frame_of_the_same_origin(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert rows(joins.only_members(df, df.filter("v = 'x'"), ["k"])) == [(1, "x")]


def test_duplicate_lookup_key_fails(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(joins.lookup(left, spark.createDataFrame([(1, "x")], "k int, v string"), ["k"])) == [(1, "x"), (2, None)]
    with pytest.raises(Exception, match="duplicate key in lookup"):
        joins.lookup(left, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"]).collect()


def test_defaults_only_for_misses(spark):
    left = spark.createDataFrame([(1, "own"), (2, "own2")], "k int, d string")
    right = spark.createDataFrame([(1, None)], "k int, v string")
    got = joins.left_join_with_defaults(left, right, ["k"], {"v": F.col("d")})
    assert rows(got) == [(1, "own", None), (2, "own2", "own2")]


def test_reconcile_accounts_for_every_row(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "lk int, lv string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 12), (None, 13)], "rk int, rv int")
    sides = joins.reconcile(left, right, {"lk": "rk"})
    assert sides.matched.count() == 4
    assert rows(sides.left_only) == [(None, "d"), (2, "c")]
    assert rows(sides.right_only) == [(None, 13), (3, 12)]


def test_bracket_is_half_open(spark):
    df = spark.createDataFrame([("x", 0.0), ("x", 10.0), ("x", 99.0), ("y", 5.0), (None, 5.0)], "i string, v double")
    b = spark.createDataFrame([("x", 0.0, 10.0, "low"), ("x", 10.0, 50.0, "high")], "i string, lo double, hi double, b string")
    got = joins.bracket_join(df, b, ["i"], "v", "lo", "hi").select("i", "v", "b")
    assert rows(got) == [(None, 5.0, None), ("x", 0.0, "low"), ("x", 10.0, "high"), ("x", 99.0, None), ("y", 5.0, None)]


def test_brackets_of_one_key_equal_plain_comparison(spark):
    rnd = random.Random(5)
    inf, nan = float("inf"), float("nan")
    values = [0.0, -0.0, 1.0, 2.0, 1e308, -1e308, inf, -inf, nan, None] + [rnd.uniform(-9, 9) * 10 ** rnd.randrange(-3, 9) for _ in range(200)]
    borders = sorted(rnd.choice(values[10:]) for _ in range(24))
    brackets = [("x", lo, hi, i) for i, (lo, hi) in enumerate(zip(borders, borders[3:]))]
    brackets += [("x", 5.0, 5.0, 90), ("x", 9.0, 1.0, 91), ("x", None, 1.0, 92), ("x", 3.0, None, 93), ("x", -inf, inf, 94), ("y", 0.0, 1e12, 95), (None, 0.0, 1e12, 96)]
    rows_in = [(k, n, v) for k in ("x", "y", None) for n, v in enumerate(values)]
    expected = set()
    for k, n, v in rows_in:
        hit = {
            i for key, lo, hi, i in brackets
            if None not in (k, v, lo, hi) and key == k and v == v and lo <= v < hi
        }
        expected |= {(k, n, i) for i in hit or {None}}
    df = spark.createDataFrame(rows_in, "i string, n int, v double")
    b = spark.createDataFrame(brackets, "i string, lo double, hi double, b int")
    got = [tuple(r) for r in joins.bracket_join(df, b, ["i"], "v", "lo", "hi").select("i", "n", "b").collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_rows_of_one_frequent_key_meet_their_brackets_in_many_parts(spark):
    df = spark.range(5000).select(F.lit("x").alias("i"), (F.col("id") * 7.0).alias("v"))
    b = spark.createDataFrame([("x", 0.0, 100.0, "a"), ("x", 100.0, 1e12, "b")], "i string, lo double, hi double, b string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = joins.bracket_join(df, b, ["i"], "v", "lo", "hi").groupBy(F.spark_partition_id().alias("p"), "b").count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    parts = {}
    for r in got:
        parts[r.p] = parts.get(r.p, 0) + r["count"]
    assert len(parts) > 1 and max(parts.values()) < 5000 and sum(parts.values()) == 5000
    assert sum(r["count"] for r in got if r.b == "a") == 15


def test_later_rules_replace_earlier_ones(spark):
    df = spark.createDataFrame([("a", 1, "base"), ("a", 2, "base"), ("b", 1, "base")], "g string, c int, m string")
    own = spark.createDataFrame([("a", 1, "own")], "g string, c int, w string")
    general = spark.createDataFrame([("a", "general")], "g string, w string")
    got = joins.override(df, "m", [(own, ["g", "c"], "w"), (general, ["g"], "w")])
    assert {(r.g, r.c): r.m for r in got.collect()} == {("a", 1): "general", ("a", 2): "general", ("b", 1): "base"}


def test_neighbours_in_time(spark):
    data = [("p", 1, 2, 1.0), ("p", 3, 4, 2.0), ("p", 4, 9, 3.0), ("p", 6, 7, 4.0), ("p", 8, 9, 5.0), ("q", 1, 9, 6.0)]
    df = spark.createDataFrame(data, "k string, f int, t int, v double")
    got = joins.neighbours_in_time(df, ["k"], "f", "t", ["v"], F.lit(5)).select("k", "future_v", "previous_v").distinct()
    assert rows(got) == [("p", 4.0, 2.0), ("q", None, None)]


def test_aggregates(spark):
    df = spark.createDataFrame([("a", -1.0, 2.0), ("a", -2.0, 1.0), ("b", 1.0, 0.0), ("c", 1.0, 3.0)], "k string, r double, w double")
    got = {r.k: r.x for r in df.groupBy("k").agg(weighted_average("r", "w").alias("x")).collect()}
    assert got == {"a": 0.0, "b": None, "c": 1.0}
    pairs = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (-1.0, 2.0), (3.0, 2.0), (1.0, 2.0)], "g double, p double")
    shares = [r[0] for r in pairs.select(share_between_0_and_1(F.col("g"), F.col("p"))).collect()]
    assert shares == [0.0, 0.0, 0.0, 1.0, 0.5]
    names = spark.createDataFrame([("z",), ("a",), (None,), ("z",)], "n string")
    assert names.agg(text_set("n")).first()[0] == "a,z"


def test_matrix_and_complement_agree(spark):
    pairs = spark.createDataFrame([("p", "x"), ("p", "y"), ("q", "x"), ("r", None)], "k string, v string")
    matrix = reshape.membership_matrix(pairs, "k", "v", ["x", "y"], "in_")
    assert rows(matrix) == [("p", "Yes", "Yes"), ("q", "Yes", "No"), ("r", "No", "No")]
    long = reshape.unpivot(matrix, ["k"], ["in_x", "in_y"], "v", "flag").filter("flag = 'No'")
    absent = reshape.complement_pairs(pairs, "k", "v")
    assert rows(absent) == [("q", "y"), ("r", "x"), ("r", "y")]
    assert {(k, v[3:]) for k, v, _ in rows(long)} == set(rows(absent))


def test_value_list_is_sorted_and_without_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    assert reshape.value_list(df, "v") == ["a", "b"]


def test_inverse_of_inverse_is_the_rate(spark):
    df = spark.createDataFrame([("a", "b", 4.0), ("c", "d", 0.0)], "s string, t string, r double")
    assert rows(reshape.with_inverse(df, "s", "t", "r")) == [("a", "b", 4.0), ("b", "a", 0.25), ("c", "d", 0.0), ("d", "c", None)]


def test_checks(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None), (3, "x", "y")], "id int, a string, b string")
    got = checks.completeness_check(df, checks.missing("a", "b"), all_failures=True).select("id", "remarks", F.array_join("failures", "+"))
    assert rows(got) == [(1, "a", "a+b"), (2, "b", "b")]
    deviation = checks.relative_deviation(F.col("v"), F.col("w"))
    pairs = spark.createDataFrame([(0.0, 5.0), (10.0, 8.9), (10.0, 9.5)], "v double, w double")
    assert checks.rows_matching_any(pairs, deviation >= 0.1).count() == 1
