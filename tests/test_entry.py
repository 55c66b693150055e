import importlib

from conftest import SF001


def test_entry_and_registry(spark):
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert len(df.columns) == 20 and df.count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 100
    missing = sorted(set(qs) - set(sql) - set(E.LLM_QUERIES))
    assert missing == [], missing


def test_sample_queries_run(spark):
    E = importlib.import_module("__spark_entry__")
    for name in ["a1_candles_day", "q23_values_in_set", "d4_date_dimension", "v10_rows_per_series"]:
        assert E.queries()[name](spark, SF001).count() >= 0
