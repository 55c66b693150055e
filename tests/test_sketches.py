import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators.sketches import depth_bars_from_sketches, depth_sketches, rank_error, read_sketches, write_sketches
from marketlake.quality import CheckSpec, run_suite
from marketlake.quality.distinct import distinct_count_holds, distinct_counts, interval, refresh_sketches
from marketlake.session import scratch_path


def books(spark, n, days):
    """Books of two series, one with most of them, with skewed mid prices."""
    return spark.range(n).select(
        F.lit("x").alias("exchange"), F.when(F.col("id") % 10 == 0, "A").otherwise("B").alias("symbol"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") * 7919) % (days * 86400)).alias("event_ts"), F.lit(1.5).alias("spread_bps"),
        (F.exp(F.pmod(F.xxhash64("id"), F.lit(1000)) / 150) + F.col("id") % 97).cast("decimal(38,10)").alias("mid_price"))


def test_rank_error_at_three_grains_from_one_table(spark):
    k, path = 64, scratch_path(spark, "t-kll")
    b = books(spark, 60_000, 2)
    write_sketches(depth_sketches(b, "minute", k), path)
    worst = {}
    for grain in ("minute", "hour", "day"):
        bars = depth_bars_from_sketches(read_sketches(spark, path), grain, k)
        values = b.groupBy("symbol", F.date_trunc(grain, "event_ts").alias("metric_ts")).agg(F.sort_array(F.collect_list("mid_price")).alias("v"))
        rows = bars.join(values, ["symbol", "metric_ts"]).collect()
        assert len(rows) == values.count() == bars.count()
        off = []
        for r in rows:
            v = np.array([float(x) for x in r.v])
            below, upto = (v < float(r.median_mid_price)).mean(), (v <= float(r.median_mid_price)).mean()
            off.append(max(0.0, below - 0.5, 0.5 - upto))
            assert len(v) > k or off[-1] == 0  # exact while a sketch holds all values
        worst[grain] = max(off)
        assert np.quantile(off, 0.99) <= rank_error(k)
    assert 0 < worst["day"] <= 2 * rank_error(k)
    day = read_sketches(spark, path, "2024-01-02", "2024-01-02")
    assert "PartitionFilters: [isnotnull(metric_date" in day._jdf.queryExecution().executedPlan().toString() and rank_error() < 0.001
    with pytest.raises(ValueError):
        depth_bars_from_sketches(day, "fortnight")


def test_only_changed_days_are_read_and_verdicts_are_exact(spark):
    base = scratch_path(spark, "t-hll")
    rows = spark.range(40_000).select(F.concat(F.lit("2024-01-0"), F.col("id") % 4 + 1).alias("dt"), (F.col("id") % 9000).alias("v"),
                                      F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("w"))
    rows.write.partitionBy("dt").parquet(f"{base}/t")
    assert refresh_sketches(spark, f"{base}/t", f"{base}/s", ["v"]) == [f"2024-01-0{k}" for k in (1, 2, 3, 4)]
    assert refresh_sketches(spark, f"{base}/t", f"{base}/s", ["v"]) == []
    assert len(refresh_sketches(spark, f"{base}/t", f"{base}/s", ["v", "w"])) == 4 and refresh_sketches(spark, f"{base}/t", f"{base}/s", ["v"]) == []
    rows.filter("dt = '2024-01-02'").withColumn("v", F.col("v") + 100_000).write.mode("append").partitionBy("dt").parquet(f"{base}/t")
    stale = {r.column_name: r.estimate for r in distinct_counts(spark, f"{base}/t", f"{base}/s").collect()}
    assert stale["v"] < 9_400  # the changed day's sketch counts no more
    assert refresh_sketches(spark, f"{base}/t", f"{base}/s", ["w"]) == ["2024-01-02"]
    t = spark.read.parquet(f"{base}/t")
    true = {c: t.agg(F.count_distinct(c)).first()[0] for c in ("v", "w")}
    found = {r.column_name: r for r in distinct_counts(spark, f"{base}/t", f"{base}/s").collect()}
    assert found["w"].estimate == true["w"] == 5 and found["v"].row_count == t.count() and found["w"].row_count == t.filter("w IS NOT NULL").count()
    low, high = interval(found["v"].estimate)
    assert low <= true["v"] <= high and high - low < 0.1 * true["v"]
    ops = {"=": lambda a, b: a == b, ">": lambda a, b: a > b, "<": lambda a, b: a < b, ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b}
    checks = [(c, op, v) for c in ("w", "v") for op in ops for v in (true[c] // 2, true[c] * 2, true[c] - 1, true[c], true[c] + 1)]
    for r in distinct_count_holds(spark, f"{base}/t", f"{base}/s", checks).collect():
        assert r.holds == ops[r.op](true[r.column_name], r.value), r
    far = distinct_count_holds(spark, f"{base}/t", f"{base}/s", [("v", ">", true["v"] // 2), ("v", "<", true["v"] // 2), ("w", "=", 5)])
    assert not any(r.counted for r in far.collect())  # no exact pass where the bound is clear of the error
    assert all(r.counted for r in distinct_count_holds(spark, f"{base}/t", f"{base}/s", [("v", "=", true["v"])]).collect())


def suite_table(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, "a", "b", "c"]), rng.choice([None, 1.0, 2.5, -1.0]), rng.randint(0, 3)) for _ in range(200)]
    return spark.createDataFrame(rows, "k int, s string, x double, g int")


SPECS = [
    CheckSpec("u1", "t", "values_to_be_unique", {"column": "k"}),
    CheckSpec("u2", "t", "unique_column_combination", {"columns": ["k", "s"]}),
    CheckSpec("u3", "t", "compound_columns_to_be_unique", {"column_list": ["s", "x"]}, fail_calc="sum(n_records)"),
    CheckSpec("u4", "t", "compound_columns_to_be_unique", {"column_list": ["k", "x"], "row_condition": "g > 1"}, severity="warn"),
    CheckSpec("u5", "t", "unique_column_combination", {"columns": ["k"], "row_filter": "x > 0"}),
    CheckSpec("u6", "t", "unique_column_combination", {"columns": ["k"]}),
    CheckSpec("r1", "t", "values_to_not_be_null", {"column": "k"}),
    CheckSpec("r2", "t", "values_to_be_between", {"column": "x", "min_value": 0}),
    CheckSpec("r3", "t", "values_to_be_between", {"column": "x", "min_value": 0, "row_condition": "g = 2"}),
    CheckSpec("m1", "t", "max_to_be_between", {"column": "x", "max_value": 2}),
]


def test_one_pass_equals_each_check_alone(spark):
    t = suite_table(spark)
    whole = {r.check_name: tuple(r) for r in run_suite(SPECS, {"t": t}).collect()}
    assert len(whole) == len(SPECS)
    for s in SPECS:
        import marketlake.quality as q
        alone = getattr(q, s.check)(t, **s.kwargs).agg(F.expr(s.fail_calc).alias("n")).first()["n"] or 0
        assert whole[s.name][2] == alone, s.name
    assert whole["u4"][3:] == ("warn", "warn") and whole["u3"][4] == "error"
    empty = run_suite(SPECS, {"t": t.limit(0)}).collect()
    assert sum(r.failures for r in empty if r.check_name != "m1") == 0


def test_one_scan_and_one_expand_per_table(spark):
    path = scratch_path(spark, "t-suite")
    suite_table(spark).write.parquet(path)
    res = run_suite(SPECS[:-1], {"t": spark.read.parquet(path)})
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1


def test_more_checks_than_a_mask_has_bits(spark):
    t = suite_table(spark)
    many = [CheckSpec(f"r{k}", "t", "expression_is_true", {"expression": f"g <> {k % 5}"}) for k in range(130)] + SPECS[:3]
    got = {r.check_name: r.failures for r in run_suite(many, {"t": t}).collect()}
    assert all(got[f"r{k}"] == t.filter(f"g = {k % 5}").count() for k in (0, 4, 61, 62, 63, 129)) and len(got) == 133


def test_project_suite_reads_each_table_once(spark):
    from conftest import SF001
    from marketlake.plans.suite import project_suite
    from marketlake.plans.tables import pipeline_tables

    plan = run_suite(project_suite(), pipeline_tables(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 7  # seven models
