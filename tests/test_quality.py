import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake import quality as Q
from marketlake.operators.ordered import lag_in_order
from marketlake.quality import CheckSpec, run_suite


def data(spark):
    rows = [(1, "a", 1.0, None), (2, "b", 5.0, "x"), (3, "B", None, "y"), (4, "c", 3.0, "x"), (5, None, 2.0, None)]
    return spark.createDataFrame(rows, "idx int, s string, v double, n string")


def test_null_rows_pass_row_checks(spark):
    df = data(spark)
    assert Q.expression_is_true(df, "v > 1").count() == 1            # only v=1.0; NULL passes
    assert Q.values_to_be_between(df, "v", 2, 4).count() == 2         # 1.0 and 5.0
    assert Q.values_to_be_between(df, "v", 2, 5, strictly=True).count() == 3
    assert Q.values_to_be_in_set(df, "s", ["a", "b", "c"]).count() == 2   # "B" and NULL (NULL fails)
    assert Q.values_to_not_be_in_set(df, "s", ["a"]).count() == 1         # NULL passes


def test_between_requires_a_bound(spark):
    try:
        Q.expression_between(data(spark), "v")
    except ValueError:
        return
    raise AssertionError("expected ValueError")


def test_casing_and_uniqueness(spark):
    df = data(spark)
    assert Q.values_to_have_consistent_casing(df, "s", True).first().inconsistent_columns == "b"
    # compact form: NULL counted by count(1) but not by count(distinct) -> fails
    assert Q.values_to_have_consistent_casing(df.filter("s != 'B' OR s IS NULL"), "s").count() == 1
    assert Q.values_to_be_unique(df, "n").collect()[0].n_records == 2


def test_regex_and_like_lists(spark):
    df = spark.createDataFrame([("green bolt",), ("blue nut",), ("red bolt",)], "p string")
    assert Q.match_regex(df, "p", "^GREEN", flags="i").count() == 2
    assert Q.not_match_regex_list(df, "p", ["bolt", "red"], match_on="any").count() == 1   # all match
    assert Q.not_match_regex_list(df, "p", ["bolt", "red"], match_on="all").count() == 2   # any match
    assert Q.match_like_pattern_list(df, "p", ["%bolt", "green%"], match_on="all").count() == 2
    try:
        Q.match_regex(df, "p", "x", flags="z")
        raise AssertionError("bad flag accepted")
    except ValueError:
        pass


def test_aggregate_checks(spark):
    df = data(spark)
    assert Q.max_to_be_between(df, "v", max_value=4).first().metric == 5.0
    # NULL is a distinct value that is not in the set (as in the SQL form)
    assert {r.value_field for r in Q.distinct_values_to_equal_set(df, "n", ["x", "z"]).collect()} == {None, "y", "z"}
    assert Q.distinct_values_to_contain_set(df, "n", ["x", "q"]).first().value_field == "q"
    nn = df.filter("n IS NOT NULL")
    assert Q.most_common_value_to_be_in_set(nn, "n", ["y"], top_n=1).first().value_field == "x"
    assert Q.most_common_value_to_be_in_set(nn, "n", ["y"], top_n=2).count() == 0


def test_equal_expression_missing_groups_and_percent(spark):
    a = spark.createDataFrame([("g1", 10), ("g2", 0)], "g string, v int")
    b = spark.createDataFrame([("g1", 11), ("g3", 5)], "g string, v int")
    r = {x.col_1: x for x in Q.equal_expression(a, "sum(v)", b, group_by=["g"]).collect()}
    assert set(r) == {"g1", "g3"} and r["g3"].expression_difference == 5
    pct = Q.equal_expression(a, "sum(v)", b, group_by=["g"], tolerance_percent=0.05).collect()
    assert [x.col_1 for x in pct] == ["g1"]   # g3: left is NULL -> percent NULL -> passes


def test_within_n_stdevs_without_group_always_passes(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 1.0)
    assert Q.values_to_be_within_n_stdevs(df, "v", sigma_threshold=0.1).count() == 0


def test_lag_in_order_matches_plain_window(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("o"), ((F.col("id") * 7919) % 101).alias("v"),
                                     (F.col("id") % 3).alias("g"))
    fast = lag_in_order(df, "v", "o", ["g"])
    ref = df.withColumn("prev_value", F.lag("v").over(Window.partitionBy("g").orderBy("o")))
    assert sorted(map(tuple, fast.select("o", "prev_value").collect())) == \
        sorted(map(tuple, ref.select("o", "prev_value").collect()))
    glob = lag_in_order(df, "v", "o")
    ref2 = df.withColumn("prev_value", F.lag("v").over(Window.orderBy("o")))
    assert sorted(map(tuple, glob.select("o", "prev_value").collect())) == \
        sorted(map(tuple, ref2.select("o", "prev_value").collect()))


def test_suite_fuses_row_checks(spark):
    df = data(spark)
    specs = [CheckSpec("a", "t", "values_to_not_be_null", {"column": "s"}),
             CheckSpec("b", "t", "values_to_be_between", {"column": "v", "min_value": 2}, severity="warn"),
             CheckSpec("c", "t", "values_to_be_unique", {"column": "n"}),
             CheckSpec("d", "t", "values_to_be_null", {"column": "idx"}, enabled=False)]
    res = run_suite(specs, {"t": df})
    got = {r.check_name: (r.failures, r.status) for r in res.collect()}
    assert got == {"a": (1, "error"), "b": (1, "warn"), "c": (1, "error")}
    # row and uniqueness checks on t share one scan
    leaves = res._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert leaves == 1


def test_table_shape(spark):
    df = data(spark)
    assert Q.column_to_exist(df, "IDX", 1).count() == 0
    assert Q.column_to_exist(df, "idx", 2).count() == 1
    assert Q.table_columns_to_match_ordered_list(df, ["idx", "v"]).count() == 3
    assert Q.table_row_count_to_equal(df, 5).count() == 0


def _plain_top(values, k):
    from collections import Counter

    counts = Counter(values)
    return sorted(counts.items(), key=lambda r: (-r[1], r[0] is not None, r[0] if r[0] is not None else ""))[:k]


@pytest.mark.parametrize("case", ["hot", "flat", "tie", "few", "null"])
def test_most_common_values(spark, case):
    """Candidates first, the rest only where they cannot decide: always the ranks of a full count."""
    values = {
        "hot": [f"v{k}" for k in range(20000)] + ["hot"] * 9000 + ["warm"] * 4000,
        "flat": [f"v{k % 7000}" for k in range(21000)],
        "tie": [f"v{k}" for k in range(20000)] + ["b"] * 5000 + ["a"] * 5000 + ["c"] * 5000,
        "few": ["a", "b", "b"],
        "null": [None] * 3000 + [f"v{k}" for k in range(3000)] + ["x"] * 3000,
    }[case]
    df = spark.createDataFrame([(v, 1) for v in values], "v string, value_field int").repartition(4)
    for k in (1, 2, 4):
        got = Q.most_common_values(df, "v", k, tracked=64, candidates=16)
        assert got.columns == ["value_field", "value_count"]
        assert [tuple(r) for r in got.orderBy(F.col("value_count").desc(), "value_field").collect()] == _plain_top(values, k)
    rank = Q.most_common_value_to_be_in_set(df, "v", ["none"], top_n=2)
    assert rank.collect() == Q.most_common_value_to_be_in_set(df, "v", ["none"], top_n=2, candidates_first=True).collect()
    assert Q.most_common_values(df.filter("false"), "v", 3).collect() == []


def test_most_common_values_decided_by_candidates(spark):
    """The values beside the candidates are not shuffled: the result is the counted candidates themselves."""
    rows = spark.range(50000).select(F.when(F.col("id") % 3 == 0, -0.0).when(F.col("id") % 3 == 1, 0.0).otherwise(F.col("id").cast("double")).alias("v"))
    got = Q.most_common_values(rows, "v", 1, tracked=256, candidates=32)
    assert [tuple(r) for r in got.collect()] == [(0.0, 33334)]
    assert "LogicalRDD" in got._jdf.queryExecution().optimizedPlan().toString() or "LocalRelation" in got._jdf.queryExecution().optimizedPlan().toString()
