"""Quality checks registered as queries over the driver's tables.

Each entry pairs the Spark check with its DuckDB SQL.  Arguments are chosen
so that most checks do find violations on the generated data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake import quality as Q
from marketlake.plans.catalog import query
from marketlake.plans.oracle import ORACLE_SQL
from marketlake.plans.present import present
from marketlake.sources.adapters import read_table


def _t(spark, sf, name):
    return read_table(spark, sf, name)


def reg(name, sql, round6=()):
    """Decorator: register the query and its oracle SQL under one key."""
    def deco(fn):
        def run(spark, sf):
            return present(fn(spark, sf), round6=round6)
        run.__name__ = fn.__name__
        query(name)(run)
        ORACLE_SQL[name] = round_sql(sql, round6)
        return fn
    return deco


def round_sql(sql: str, cols) -> str:
    """Apply the same 6-place rounding to the oracle's inexact columns."""
    if not cols:
        return sql
    rep = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _r"

# --- generic engines -------------------------------------------------------


@reg("q1_expression_is_true", "SELECT * FROM lineitem WHERE NOT ((l_discount <= 0.08) = true)")
def _q1(s, sf):
    return Q.expression_is_true(_t(s, sf, "lineitem"), "l_discount <= 0.08")


@reg("q1_expression_is_true_grouped",
     "SELECT l_returnflag, l_linestatus, avg(l_discount) < 0.05 AS expression FROM lineitem "
     "GROUP BY l_returnflag, l_linestatus HAVING NOT ((avg(l_discount) < 0.05) = true)")
def _q1g(s, sf):
    return Q.expression_is_true(_t(s, sf, "lineitem"), "avg(l_discount) < 0.05",
                                group_by=["l_returnflag", "l_linestatus"])


@reg("q2_expression_between",
     "SELECT * FROM orders WHERE o_orderstatus = 'F' AND NOT (o_totalprice >= 5000 AND o_totalprice <= 450000)")
def _q2(s, sf):
    return Q.expression_between(_t(s, sf, "orders"), "o_totalprice", 5000, 450000, row_condition="o_orderstatus = 'F'")


_EQ = """
WITH a AS (SELECT l_linestatus AS col_1, sum(l_quantity) AS expression FROM lineitem
           WHERE l_shipdate < TIMESTAMP '1999-01-01' GROUP BY 1),
b AS (SELECT l_linestatus AS col_1, sum(l_quantity) AS compare_expression FROM lineitem GROUP BY 1),
f AS (SELECT coalesce(a.col_1, b.col_1) AS col_1, a.expression, b.compare_expression,
             abs(coalesce(a.expression, 0) - coalesce(b.compare_expression, 0)) AS expression_difference
      FROM a FULL OUTER JOIN b ON a.col_1 = b.col_1)
SELECT *, expression_difference / nullif(expression * 1.0, 0) AS expression_difference_percent
FROM f WHERE expression_difference > 0"""


@reg("q3_equal_expression", _EQ, round6=("expression_difference_percent",))
def _q3(s, sf):
    li = _t(s, sf, "lineitem")
    return Q.equal_expression(li, "sum(l_quantity)", li, group_by=["l_linestatus"],
                              row_condition="l_shipdate < timestamp'1999-01-01'", compare_row_condition="1=1")


@reg("q4_ignore_row_if_any_missing",
     "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem "
     "WHERE NOT (l_orderkey IS NULL OR l_linenumber IS NULL) GROUP BY 1, 2 HAVING count(*) > 1")
def _q4(s, sf):
    return Q.compound_columns_to_be_unique(_t(s, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                                           ignore_row_if="any_value_is_missing")


# --- table shape -----------------------------------------------------------

_COLS = "(SELECT upper(column_name) AS c, column_index AS i FROM duckdb_columns() WHERE table_name = '{t}')"


@reg("q5_column_to_exist",
     "SELECT x.column_name, x.column_index FROM (VALUES ('o_comment', NULL::INTEGER), ('o_totalprice', 2), "
     "('O_ORDERKEY', 1)) x(column_name, column_index) "
     f"WHERE NOT EXISTS (SELECT 1 FROM {_COLS.format(t='orders')} k WHERE k.c = upper(x.column_name) "
     "AND (x.column_index IS NULL OR x.column_index = 0 OR k.i = x.column_index))")
def _q5(s, sf):
    o = _t(s, sf, "orders")
    parts = [Q.column_to_exist(o, "o_comment"), Q.column_to_exist(o, "o_totalprice", 2),
             Q.column_to_exist(o, "O_ORDERKEY", 1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@reg("q6_recent_data",
     "SELECT max(o_orderdate) AS max_timestamp FROM orders WHERE o_orderdate <= TIMESTAMP '2002-01-01' "
     "HAVING coalesce(max(o_orderdate), TIMESTAMP '1970-01-01') < TIMESTAMP '2002-01-01' - INTERVAL 30 DAY")
def _q6(s, sf):
    return Q.row_values_to_have_recent_data(_t(s, sf, "orders"), "o_orderdate", "day", 30, now="2002-01-01")


@reg("q7_grouped_recent_data",
     "SELECT o_orderpriority, max(o_orderdate) AS latest_timestamp_column, 1 AS row_count FROM orders "
     "WHERE o_orderdate <= TIMESTAMP '2001-09-30' AND o_orderpriority IS NOT NULL GROUP BY 1 "
     "HAVING max(o_orderdate) < TIMESTAMP '2001-09-30' - INTERVAL 1 DAY")
def _q7(s, sf):
    return Q.grouped_row_values_to_have_recent_data(
        _t(s, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("none"))),
        ["o_orderpriority"], "o_orderdate", "day", 1, now="2001-09-30")


_AGG_EQ = """
WITH a AS (SELECT sum(l_extendedprice) AS expression FROM lineitem),
b AS (SELECT sum(o_totalprice) AS compare_expression FROM orders),
f AS (SELECT a.expression, b.compare_expression,
             abs(coalesce(a.expression, 0) - coalesce(b.compare_expression, 0)) AS expression_difference
      FROM a CROSS JOIN b)
SELECT *, expression_difference / nullif(expression * 1.0, 0) AS expression_difference_percent
FROM f WHERE expression_difference / nullif(expression * 1.0, 0) > 0.01"""


@reg("q8_table_aggregation_equal_other_table", _AGG_EQ,
     round6=("expression", "compare_expression", "expression_difference", "expression_difference_percent"))
def _q8(s, sf):
    return Q.table_aggregation_to_equal_other_table(_t(s, sf, "lineitem"), "sum(l_extendedprice)",
                                                    _t(s, sf, "orders"), "sum(o_totalprice)",
                                                    tolerance_percent=0.01)


@reg("q9_column_count_between",
     f"SELECT CAST(count(*) AS INTEGER) AS column_count FROM {_COLS.format(t='lineitem')} HAVING count(*) > 8")
def _q9(s, sf):
    return Q.table_column_count_to_be_between(_t(s, sf, "lineitem"), 0, 8)


@reg("q10_column_count_equal",
     f"SELECT CAST(count(*) AS INTEGER) AS column_count FROM {_COLS.format(t='orders')} HAVING count(*) <> 7")
def _q10(s, sf):
    return Q.table_column_count_to_equal(_t(s, sf, "orders"), 7)


@reg("q11_column_count_equal_other_table",
     f"SELECT CAST((SELECT count(*) FROM {_COLS.format(t='orders')}) AS INTEGER) AS column_count, "
     f"CAST((SELECT count(*) FROM {_COLS.format(t='customer')}) AS INTEGER) AS other_column_count "
     f"WHERE (SELECT count(*) FROM {_COLS.format(t='orders')}) <> (SELECT count(*) FROM {_COLS.format(t='customer')})")
def _q11(s, sf):
    return Q.table_column_count_to_equal_other_table(_t(s, sf, "orders"), _t(s, sf, "customer"))


@reg("q12_columns_contain_set",
     "SELECT x.column_name FROM (VALUES ('o_orderkey'), ('o_comment'), ('o_clerk')) x(column_name) "
     f"WHERE upper(x.column_name) NOT IN (SELECT c FROM {_COLS.format(t='orders')})")
def _q12(s, sf):
    return Q.table_columns_to_contain_set(_t(s, sf, "orders"), ["o_orderkey", "o_comment", "o_clerk"])


@reg("q13_columns_not_contain_set",
     "SELECT x.column_name FROM (VALUES ('o_orderkey'), ('o_comment')) x(column_name) "
     f"WHERE upper(x.column_name) IN (SELECT c FROM {_COLS.format(t='orders')})")
def _q13(s, sf):
    return Q.table_columns_to_not_contain_set(_t(s, sf, "orders"), ["o_orderkey", "o_comment"])


@reg("q14_columns_match_set",
     f"SELECT c AS relation_column, NULL AS input_column FROM {_COLS.format(t='region')} "
     "WHERE c NOT IN ('R_REGIONKEY', 'R_COMMENT') UNION ALL "
     "SELECT NULL, x.c FROM (VALUES ('R_REGIONKEY'), ('R_COMMENT')) x(c) "
     f"WHERE x.c NOT IN (SELECT c FROM {_COLS.format(t='region')})")
def _q14(s, sf):
    return Q.table_columns_to_match_set(_t(s, sf, "region"), ["r_regionkey", "r_comment"])


@reg("q15_columns_match_ordered_list",
     "SELECT k.c AS relation_column, CASE WHEN k.c IS NOT NULL THEN coalesce(k.i, x.i) END AS relation_column_idx, "
     "x.c AS input_column, CASE WHEN x.c IS NOT NULL THEN coalesce(x.i, k.i) END AS input_column_idx "
     f"FROM {_COLS.format(t='nation')} k FULL OUTER JOIN (VALUES ('N_NATIONKEY', 1), ('N_REGIONKEY', 2)) x(c, i) "
     "ON k.i = x.i WHERE k.c IS DISTINCT FROM x.c")
def _q15(s, sf):
    return Q.table_columns_to_match_ordered_list(_t(s, sf, "nation"), ["n_nationkey", "n_regionkey"])


@reg("q16_row_count_between",
     "SELECT l_returnflag, count(*) AS metric FROM lineitem GROUP BY 1 HAVING NOT (count(*) >= 0 AND count(*) <= 20000)")
def _q16(s, sf):
    return Q.table_row_count_to_be_between(_t(s, sf, "lineitem"), 0, 20000, group_by=["l_returnflag"])


@reg("q17_row_count_equal",
     "SELECT o_orderstatus, count(*) = 4979 AS expression FROM orders GROUP BY 1 HAVING NOT ((count(*) = 4979) = true)")
def _q17(s, sf):
    return Q.table_row_count_to_equal(_t(s, sf, "orders"), 4979, group_by=["o_orderstatus"])


_RC = """
WITH a AS (SELECT l_orderkey AS col_1, count(*) AS expression FROM lineitem GROUP BY 1),
b AS (SELECT o_orderkey AS col_1, count(*) * {f} AS compare_expression FROM orders GROUP BY 1),
f AS (SELECT coalesce(a.col_1, b.col_1) AS col_1, a.expression, b.compare_expression,
             abs(coalesce(a.expression, 0) - coalesce(b.compare_expression, 0)) AS expression_difference
      FROM a FULL OUTER JOIN b ON a.col_1 = b.col_1)
SELECT *, expression_difference / nullif(expression * 1.0, 0) AS expression_difference_percent
FROM f WHERE expression_difference > 0"""


@reg("q18_row_count_equal_other_table", _RC.format(f=1), round6=("expression_difference_percent",))
def _q18(s, sf):
    return Q.table_row_count_to_equal_other_table(_t(s, sf, "lineitem"), _t(s, sf, "orders"),
                                                  group_by=["l_orderkey"], compare_group_by=["o_orderkey"])


@reg("q19_row_count_equal_other_table_times_factor", _RC.format(f=4), round6=("expression_difference_percent",))
def _q19(s, sf):
    return Q.table_row_count_to_equal_other_table_times_factor(
        _t(s, sf, "lineitem"), _t(s, sf, "orders"), 4, group_by=["l_orderkey"], compare_group_by=["o_orderkey"])


# --- column values ---------------------------------------------------------

@reg("q20_values_between", "SELECT * FROM lineitem WHERE NOT (l_quantity >= 2 AND l_quantity <= 49)")
def _q20(s, sf):
    return Q.values_to_be_between(_t(s, sf, "lineitem"), "l_quantity", 2, 49)


_INC = """
WITH o AS (SELECT *, lpad(o_orderkey::VARCHAR, 9, '0') || '-' || lpad(o_custkey::VARCHAR, 9, '0') || '-'
                     || lpad(CAST(round(o_totalprice * 100) AS BIGINT)::VARCHAR, 12, '0') AS seq FROM orders)
SELECT * FROM (SELECT *, lag({v}) OVER ({p} ORDER BY {o}) AS previous_value FROM o)
WHERE previous_value IS NOT NULL AND NOT ({v} {op} previous_value)"""


def _in_sequence(s, sf):
    """Orders with a text to sort by that no two different orders share (order keys repeat in this data)."""
    parts = [F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"),
             F.lpad(F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"), 12, "0")]
    return _t(s, sf, "orders").withColumn("seq", F.concat_ws("-", *parts))


@reg("q21_values_increasing", _INC.format(v="o_totalprice", p="", o="seq", op=">"))
def _q21(s, sf):
    return Q.values_to_be_increasing(_in_sequence(s, sf), "o_totalprice", sort_column="seq")


@reg("q21_text_increasing", _INC.format(v="o_orderpriority", p="", o="seq", op=">="))
def _q21t(s, sf):
    return Q.values_to_be_increasing(_in_sequence(s, sf), "o_orderpriority", sort_column="seq", strictly=False)


@reg("q21_values_increasing_grouped",
     _INC.format(v="o_totalprice", p="PARTITION BY o_custkey", o="seq", op=">="))
def _q21g(s, sf):
    return Q.values_to_be_increasing(_in_sequence(s, sf), "o_totalprice", sort_column="seq",
                                     strictly=False, group_by=["o_custkey"])


@reg("q22_values_decreasing", _INC.format(v="o_totalprice", p="", o="seq", op="<"))
def _q22(s, sf):
    return Q.values_to_be_decreasing(_in_sequence(s, sf), "o_totalprice", sort_column="seq")


@reg("q23_values_in_set", "SELECT * FROM orders WHERE NOT coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false)")
def _q23(s, sf):
    return Q.values_to_be_in_set(_t(s, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@reg("q24_values_not_in_set", "SELECT * FROM lineitem WHERE l_returnflag IN ('R')")
def _q24(s, sf):
    return Q.values_to_not_be_in_set(_t(s, sf, "lineitem"), "l_returnflag", ["R"])


@reg("q25_values_in_type_list",
     "SELECT column_name, lower(data_type) AS column_type FROM duckdb_columns() WHERE table_name = 'orders' "
     "AND column_name = 'o_totalprice' AND lower(data_type) NOT IN ('int', 'bigint')")
def _q25(s, sf):
    return Q.values_to_be_in_type_list(_t(s, sf, "orders"), "o_totalprice", ["int", "bigint"])


@reg("q26_values_of_type",
     "SELECT column_name, lower(data_type) AS column_type FROM duckdb_columns() WHERE table_name = 'orders' "
     "AND column_name = 'o_custkey' AND lower(data_type) <> 'int'")
def _q26(s, sf):
    return Q.values_to_be_of_type(_t(s, sf, "orders"), "o_custkey", "int")


@reg("q27_values_null", "SELECT * FROM orders WHERE o_totalprice > 495000 AND o_orderstatus IS NOT NULL")
def _q27(s, sf):
    return Q.values_to_be_null(_t(s, sf, "orders"), "o_orderstatus", row_condition="o_totalprice > 495000")


@reg("q28_values_not_null", "SELECT * REPLACE (NULL::VARCHAR AS l_returnflag) FROM lineitem WHERE l_returnflag = 'R'")
def _q28(s, sf):
    li = _t(s, sf, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("R")))
    return Q.values_to_not_be_null(li, "l_returnflag")


@reg("q29_values_unique",
     "SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def _q29(s, sf):
    return Q.values_to_be_unique(_t(s, sf, "orders"), "o_custkey")


@reg("q30_consistent_casing",
     "SELECT lower(v) AS inconsistent_columns, count(v) AS set_count_case_insensitive "
     "FROM (SELECT DISTINCT c_mktsegment AS v FROM customer UNION SELECT DISTINCT lower(c_mktsegment) FROM customer) "
     "GROUP BY 1 HAVING count(v) > 1")
def _q30(s, sf):
    c = _t(s, sf, "customer")
    both = c.select("c_mktsegment").unionByName(c.select(F.lower("c_mktsegment").alias("c_mktsegment")))
    return Q.values_to_have_consistent_casing(both, "c_mktsegment", display_inconsistent_columns=True)


@reg("q30_consistent_casing_compact",
     "SELECT count(1) AS set_count, count(DISTINCT lower(v)) AS set_count_case_insensitive "
     "FROM (SELECT DISTINCT p_type AS v FROM part UNION SELECT lower(p_type) FROM part WHERE p_partkey % 2 = 0) "
     "HAVING count(1) <> count(DISTINCT lower(v))")
def _q30c(s, sf):
    p = _t(s, sf, "part")
    planted = p.select("p_type").unionByName(p.filter("p_partkey % 2 = 0").select(F.lower("p_type").alias("p_type")))
    return Q.values_to_have_consistent_casing(planted, "p_type")


# --- strings ---------------------------------------------------------------

@reg("q31_value_lengths_equal", "SELECT * FROM orders WHERE length(o_orderpriority) <> 8")
def _q31(s, sf):
    return Q.value_lengths_to_equal(_t(s, sf, "orders"), "o_orderpriority", 8)


@reg("q32_value_lengths_between", "SELECT * FROM part WHERE NOT (length(p_name) >= 10 AND length(p_name) <= 30)")
def _q32(s, sf):
    return Q.value_lengths_to_be_between(_t(s, sf, "part"), "p_name", 10, 30)


@reg("q33_match_regex", "SELECT * FROM orders WHERE NOT regexp_matches(o_orderpriority, '(?i)^[0-9]-[a-z]+$')")
def _q33(s, sf):
    return Q.match_regex(_t(s, sf, "orders"), "o_orderpriority", "^[0-9]-[a-z]+$", flags="i")


@reg("q34_not_match_regex", "SELECT * FROM customer WHERE regexp_matches(c_name, '00[0-9]$')")
def _q34(s, sf):
    return Q.not_match_regex(_t(s, sf, "customer"), "c_name", "00[0-9]$")


@reg("q35_match_regex_list",
     "SELECT * FROM part WHERE NOT (regexp_matches(p_type, '^STANDARD') OR regexp_matches(p_type, '^SMALL'))")
def _q35(s, sf):
    return Q.match_regex_list(_t(s, sf, "part"), "p_type", ["^STANDARD", "^SMALL"], match_on="any")


@reg("q36_not_match_regex_list",
     "SELECT * FROM part WHERE NOT (NOT regexp_matches(p_name, 'green') AND NOT regexp_matches(p_name, 'bolt'))")
def _q36(s, sf):
    return Q.not_match_regex_list(_t(s, sf, "part"), "p_name", ["green", "bolt"], match_on="all")


@reg("q37_match_like_pattern", "SELECT * FROM customer WHERE NOT (c_mktsegment LIKE 'AUTO%')")
def _q37(s, sf):
    return Q.match_like_pattern(_t(s, sf, "customer"), "c_mktsegment", "AUTO%")


@reg("q38_not_match_like_pattern", "SELECT * FROM orders WHERE o_orderpriority LIKE '%URGENT'")
def _q38(s, sf):
    return Q.not_match_like_pattern(_t(s, sf, "orders"), "o_orderpriority", "%URGENT")


@reg("q39_match_like_pattern_list", "SELECT * FROM part WHERE NOT (p_name LIKE '%bolt' AND p_name LIKE 'blue%')")
def _q39(s, sf):
    return Q.match_like_pattern_list(_t(s, sf, "part"), "p_name", ["%bolt", "blue%"], match_on="all")


@reg("q40_not_match_like_pattern_list",
     "SELECT * FROM part WHERE NOT (NOT (p_name LIKE '%bolt') OR NOT (p_name LIKE 'blue%'))")
def _q40(s, sf):
    return Q.not_match_like_pattern_list(_t(s, sf, "part"), "p_name", ["%bolt", "blue%"], match_on="any")


# --- aggregates ------------------------------------------------------------

@reg("q41_distinct_count_equal",
     "SELECT l_returnflag, count(DISTINCT l_linestatus) AS metric FROM lineitem GROUP BY 1 "
     "HAVING NOT (count(DISTINCT l_linestatus) = 1)")
def _q41(s, sf):
    return Q.distinct_count_to_equal(_t(s, sf, "lineitem"), "l_linestatus", 1, group_by=["l_returnflag"])


@reg("q42_distinct_count_greater_than",
     "SELECT count(DISTINCT o_orderpriority) AS metric FROM orders HAVING NOT (count(DISTINCT o_orderpriority) > 10)")
def _q42(s, sf):
    return Q.distinct_count_to_be_greater_than(_t(s, sf, "orders"), "o_orderpriority", 10)


@reg("q43_distinct_count_less_than",
     "SELECT c_mktsegment, count(DISTINCT c_nationkey) AS metric FROM customer GROUP BY 1 "
     "HAVING NOT (count(DISTINCT c_nationkey) < 25)")
def _q43(s, sf):
    return Q.distinct_count_to_be_less_than(_t(s, sf, "customer"), "c_nationkey", 25, group_by=["c_mktsegment"])


@reg("q44_distinct_count_equal_other_table",
     "WITH a AS (SELECT count(DISTINCT o_custkey) AS expression FROM orders), "
     "b AS (SELECT count(DISTINCT c_nationkey) AS compare_expression FROM customer) "
     "SELECT a.expression, b.compare_expression, abs(coalesce(a.expression, 0) - coalesce(b.compare_expression, 0)) "
     "AS expression_difference, abs(coalesce(a.expression, 0) - coalesce(b.compare_expression, 0)) / "
     "nullif(a.expression * 1.0, 0) AS expression_difference_percent FROM a CROSS JOIN b "
     "WHERE abs(coalesce(a.expression, 0) - coalesce(b.compare_expression, 0)) > 0",
     round6=("expression_difference_percent",))
def _q44(s, sf):
    return Q.distinct_count_to_equal_other_table(_t(s, sf, "orders"), "o_custkey", _t(s, sf, "customer"),
                                                 "c_nationkey")


@reg("q45_distinct_values_in_set",
     "SELECT DISTINCT CAST(o_orderstatus AS VARCHAR) AS value_field FROM orders "
     "WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')")
def _q45(s, sf):
    return Q.distinct_values_to_be_in_set(_t(s, sf, "orders"), "o_orderstatus", ["F", "O"])


@reg("q46_distinct_values_contain_set",
     "SELECT v AS value_field FROM (VALUES ('A'), ('R'), ('N'), ('X')) s(v) "
     "WHERE v NOT IN (SELECT l_returnflag FROM lineitem WHERE l_returnflag IS NOT NULL)")
def _q46(s, sf):
    return Q.distinct_values_to_contain_set(_t(s, sf, "lineitem"), "l_returnflag", ["A", "R", "N", "X"])


@reg("q47_distinct_values_equal_set",
     "SELECT coalesce(d.v, s.v) AS value_field FROM (SELECT DISTINCT l_linestatus AS v FROM lineitem) d "
     "FULL OUTER JOIN (VALUES ('O'), ('Z')) s(v) ON d.v = s.v WHERE d.v IS NULL OR s.v IS NULL")
def _q47(s, sf):
    return Q.distinct_values_to_equal_set(_t(s, sf, "lineitem"), "l_linestatus", ["O", "Z"])


def _between_sql(table, group, metric, lo, hi):
    conds = " AND ".join(c for c in ((f"{metric} >= {lo}" if lo is not None else ""),
                                     (f"{metric} <= {hi}" if hi is not None else "")) if c)
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return f"SELECT {g}{metric} AS metric FROM {table}{gb} HAVING NOT ({conds})"


@reg("q48a_max_between", _between_sql("lineitem", "l_returnflag", "max(l_extendedprice)", None, 104990))
def _q48a(s, sf):
    return Q.max_to_be_between(_t(s, sf, "lineitem"), "l_extendedprice", max_value=104990, group_by=["l_returnflag"])


@reg("q48b_min_between", _between_sql("orders", "o_orderpriority", "min(o_totalprice)", 1100, None))
def _q48b(s, sf):
    return Q.min_to_be_between(_t(s, sf, "orders"), "o_totalprice", min_value=1100, group_by=["o_orderpriority"])


@reg("q48c_mean_between", _between_sql("lineitem", "l_linestatus", "avg(l_discount)", None, 0.0499),
     round6=("metric",))
def _q48c(s, sf):
    return Q.mean_to_be_between(_t(s, sf, "lineitem"), "l_discount", max_value=0.0499, group_by=["l_linestatus"])


@reg("q48d_median_between", _between_sql("orders", "o_orderstatus", "median(o_totalprice)", 251400, None))
def _q48d(s, sf):
    return Q.median_to_be_between(_t(s, sf, "orders"), "o_totalprice", min_value=251400, group_by=["o_orderstatus"])


@reg("q48e_sum_between", _between_sql("lineitem", "l_returnflag", "sum(l_quantity)", None, 508000))
def _q48e(s, sf):
    return Q.sum_to_be_between(_t(s, sf, "lineitem"), "l_quantity", max_value=508000, group_by=["l_returnflag"])


@reg("q48f_stdev_between", _between_sql("orders", "o_orderpriority", "stddev_samp(o_totalprice)", None, 143000),
     round6=("metric",))
def _q48f(s, sf):
    return Q.stdev_to_be_between(_t(s, sf, "orders"), "o_totalprice", max_value=143000, group_by=["o_orderpriority"])


@reg("q48g_unique_value_count_between",
     _between_sql("lineitem", "l_returnflag", "count(DISTINCT l_partkey)", 1000000, None))
def _q48g(s, sf):
    return Q.unique_value_count_to_be_between(_t(s, sf, "lineitem"), "l_partkey", min_value=1000000,
                                              group_by=["l_returnflag"])


@reg("q49_quantile_between",
     _between_sql("lineitem", "l_linestatus", "quantile_cont(l_extendedprice, 0.9)", None, 60000), round6=("metric",))
def _q49(s, sf):
    return Q.quantile_values_to_be_between(_t(s, sf, "lineitem"), "l_extendedprice", 0.9, max_value=60000,
                                           group_by=["l_linestatus"])


@reg("q50_proportion_unique_between",
     _between_sql("orders", "", "count(DISTINCT o_custkey) / count(o_custkey)", 0.5, None), round6=("metric",))
def _q50(s, sf):
    return Q.proportion_of_unique_values_to_be_between(_t(s, sf, "orders"), "o_custkey", min_value=0.5)


@reg("q51_most_common_value_in_set",
     "SELECT value_field FROM (SELECT c_nationkey AS value_field, row_number() OVER (ORDER BY count(*) DESC, "
     "c_nationkey ASC) AS value_count_rank FROM customer GROUP BY c_nationkey) WHERE value_count_rank = 1 "
     "AND value_field NOT IN (101, 102)")
def _q51(s, sf):
    return Q.most_common_value_to_be_in_set(_t(s, sf, "customer"), "c_nationkey", [101, 102], top_n=1,
                                            quote_values=False, data_type="int")


@reg("q51_most_common_values",
     "SELECT part AS value_field, n AS value_count FROM (SELECT CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_orderkey END AS part, "
     "count(*) AS n FROM lineitem GROUP BY 1) ORDER BY n DESC, part LIMIT 1")
def _q51_candidates(s, sf):
    # a hot value among as many others as there are orders: candidates decide, the others are not shuffled
    part = F.when(F.col("l_partkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey"))
    return Q.most_common_values(_t(s, sf, "lineitem").select(part.alias("part")), "part", 1)


# --- multi-column ----------------------------------------------------------

@reg("q52_compound_columns_unique",
     "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem "
     "WHERE NOT (l_orderkey IS NULL AND l_linenumber IS NULL) GROUP BY 1, 2 HAVING count(*) > 1")
def _q52(s, sf):
    return Q.compound_columns_to_be_unique(_t(s, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@reg("q53_unique_within_record",
     "WITH li AS (SELECT * REPLACE (nullif(l_suppkey, 3) AS l_suppkey, nullif(l_linenumber, 7) AS l_linenumber) "
     "FROM lineitem), k AS (SELECT row_number() OVER () AS rn, * FROM li), "
     "n AS (SELECT rn, count(DISTINCT v) AS n FROM (SELECT rn, unnest([l_partkey, l_suppkey, l_linenumber]) AS v "
     "FROM k) GROUP BY 1) SELECT k.* EXCLUDE (rn) FROM k JOIN n USING (rn) WHERE n.n < 3")
def _q53(s, sf):
    li = _t(s, sf, "lineitem").withColumns({"l_suppkey": F.nullif("l_suppkey", F.lit(3)),
                                            "l_linenumber": F.nullif("l_linenumber", F.lit(7))})
    return Q.select_column_values_to_be_unique_within_record(li, ["l_partkey", "l_suppkey", "l_linenumber"])


@reg("q54_multicolumn_sum_equal", "SELECT * FROM lineitem WHERE l_quantity < 5 AND NOT (l_quantity + l_linenumber = 6)")
def _q54(s, sf):
    return Q.multicolumn_sum_to_equal(_t(s, sf, "lineitem"), ["l_quantity", "l_linenumber"], 6,
                                      row_condition="l_quantity < 5")


@reg("q55_pair_a_greater_than_b", "SELECT * FROM lineitem WHERE NOT (l_tax >= l_discount)")
def _q55(s, sf):
    return Q.column_pair_values_A_to_be_greater_than_B(_t(s, sf, "lineitem"), "l_tax", "l_discount", or_equal=True)


@reg("q56_pair_values_equal",
     "SELECT * FROM lineitem WHERE l_returnflag = 'N' AND NOT (l_returnflag = l_linestatus)")
def _q56(s, sf):
    return Q.column_pair_values_to_be_equal(_t(s, sf, "lineitem"), "l_returnflag", "l_linestatus",
                                            row_condition="l_returnflag = 'N'")


@reg("q57_pair_values_in_set",
     "SELECT * FROM lineitem WHERE NOT ((l_returnflag = 'A' AND l_linestatus = 'F') OR "
     "(l_returnflag = 'R' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O'))")
def _q57(s, sf):
    return Q.column_pair_values_to_be_in_set(_t(s, sf, "lineitem"), "l_returnflag", "l_linestatus",
                                             [("A", "F"), ("R", "F"), ("N", "O")])


# --- distributional --------------------------------------------------------

@reg("q58_within_n_stdevs",
     "WITH m AS (SELECT l_suppkey, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY 1), "
     "s AS (SELECT *, avg(l_quantity) OVER () AS l_quantity_average, stddev_samp(l_quantity) OVER () AS "
     "l_quantity_stddev FROM m) SELECT *, (l_quantity - l_quantity_average) / nullif(l_quantity_stddev, 0) AS "
     "l_quantity_sigma FROM s WHERE abs((l_quantity - l_quantity_average) / nullif(l_quantity_stddev, 0)) > 2",
     round6=("l_quantity_average", "l_quantity_stddev", "l_quantity_sigma"))
def _q58(s, sf):
    return Q.values_to_be_within_n_stdevs(_t(s, sf, "lineitem"), "l_quantity", group_by=["l_suppkey"],
                                          sigma_threshold=2)


_MOV = """
WITH g AS (SELECT date_trunc('day', o_orderdate) AS metric_period, sum(o_totalprice) AS agg_metric_value
           FROM orders GROUP BY 1),
p AS (SELECT *, lag(agg_metric_value, 1) OVER (ORDER BY metric_period) AS prior_agg_metric_value FROM g),
v AS (SELECT *, coalesce(ln(nullif(agg_metric_value, 0)), 0) - coalesce(ln(nullif(prior_agg_metric_value, 0)), 0)
                AS metric_test_value FROM p),
r AS (SELECT *, avg(metric_test_value) OVER (ORDER BY metric_period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
                AS metric_test_rolling_average,
             stddev_samp(metric_test_value) OVER (ORDER BY metric_period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
                AS metric_test_rolling_stddev FROM v),
z AS (SELECT *, metric_test_value - metric_test_rolling_average AS metric_test_delta,
             (metric_test_value - metric_test_rolling_average) / nullif(metric_test_rolling_stddev, 0)
                AS metric_test_sigma FROM r)
SELECT * FROM z WHERE metric_period >= TIMESTAMP '2001-08-02' - INTERVAL 400 DAY
  AND metric_period < TIMESTAMP '2001-08-02'
  AND NOT (metric_test_sigma >= -2 AND metric_test_sigma <= 2)"""


@reg("q59_within_n_moving_stdevs", _MOV,
     round6=("metric_test_value", "metric_test_rolling_average", "metric_test_rolling_stddev",
             "metric_test_delta", "metric_test_sigma", "agg_metric_value", "prior_agg_metric_value"))
def _q59(s, sf):
    return Q.values_to_be_within_n_moving_stdevs(_t(s, sf, "orders"), "o_totalprice", "o_orderdate", period="day",
                                                 test_periods=400, sigma_threshold=2, now="2001-08-02 00:00:00")


_SPINE = """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders
           WHERE o_orderpriority = '1-URGENT'),
spine AS (SELECT CAST(d AS TIMESTAMP) AS date_day, lo FROM b, range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
          INTERVAL 1 DAY) t(d)),
s2 AS (SELECT * FROM spine WHERE {spine_filter}),
m AS (SELECT {key} AS date_day, count(*) AS row_cnt FROM orders, b WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT s2.date_day, m.date_day IS NULL AS is_missing, coalesce(m.row_cnt, 0) AS row_cnt
FROM s2 LEFT JOIN m ON s2.date_day = m.date_day WHERE coalesce(m.row_cnt, 0) = 0"""


@reg("q60_data_for_every_day", _SPINE.format(spine_filter="true", key="date_trunc('day', o_orderdate)"))
def _q60(s, sf):
    return Q.row_values_to_have_data_for_every_n_datepart(_t(s, sf, "orders"), "o_orderdate", "day",
                                                          row_condition="o_orderpriority = '1-URGENT'")


@reg("q60_data_for_every_3_days",
     _SPINE.format(spine_filter="date_diff('day', lo, CAST(date_day AS DATE)) % 3 = 0",
                   key="date_trunc('day', o_orderdate) - to_days(CAST(date_diff('day', lo, "
                       "CAST(o_orderdate AS DATE)) % 3 AS INTEGER))"))
def _q60i(s, sf):
    return Q.row_values_to_have_data_for_every_n_datepart(_t(s, sf, "orders"), "o_orderdate", "day", interval=3,
                                                          row_condition="o_orderpriority = '1-URGENT'")


@reg("q60_data_for_every_hour", """
WITH b AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events WHERE event_type = 'error'),
spine AS (SELECT d AS date_hour FROM b, range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 HOUR) t(d)),
m AS (SELECT date_trunc('hour', ts) AS date_hour, count(*) AS row_cnt FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT spine.date_hour, m.date_hour IS NULL AS is_missing, coalesce(m.row_cnt, 0) AS row_cnt
FROM spine LEFT JOIN m ON spine.date_hour = m.date_hour WHERE coalesce(m.row_cnt, 0) = 0""")
def _q60h(s, sf):
    return Q.row_values_to_have_data_for_every_n_datepart(_t(s, sf, "events"), "ts", "hour",
                                                          row_condition="event_type = 'error'")


@reg("q60_data_for_every_quarter", """
WITH o AS (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND quarter(o_orderdate) <> 2),
b AS (SELECT date_trunc('quarter', min(o_orderdate)) AS lo, date_trunc('quarter', max(o_orderdate)) AS hi FROM o),
spine AS (SELECT d AS date_quarter FROM b, range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 3 MONTH) t(d)),
m AS (SELECT CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS date_quarter, count(*) AS row_cnt FROM o GROUP BY 1)
SELECT spine.date_quarter, m.date_quarter IS NULL AS is_missing, coalesce(m.row_cnt, 0) AS row_cnt
FROM spine LEFT JOIN m ON spine.date_quarter = m.date_quarter WHERE coalesce(m.row_cnt, 0) = 0""")
def _q60q(s, sf):
    return Q.row_values_to_have_data_for_every_n_datepart(
        _t(s, sf, "orders"), "o_orderdate", "quarter",
        row_condition="o_orderpriority = '1-URGENT' AND quarter(o_orderdate) <> 2")


@reg("q62_unique_column_combination",
     "SELECT o_custkey, o_orderpriority, count(*) AS n_records FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def _q62(s, sf):
    return Q.unique_column_combination(_t(s, sf, "orders"), ["o_custkey", "o_orderpriority"])


# --- W14: running sums with the default (RANGE) frame, ascending and descending

@reg("w14_running_sums",
     "SELECT o_orderkey, o_custkey, o_orderdate, "
     "sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rolling_sum_increasing, "
     "sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rolling_sum_decreasing "
     "FROM orders", round6=("rolling_sum_increasing", "rolling_sum_decreasing"))
def _w14(s, sf):
    from pyspark.sql import Window
    o = _t(s, sf, "orders")
    w = Window.partitionBy("o_custkey")
    return o.select("o_orderkey", "o_custkey", "o_orderdate",
                    F.sum("o_totalprice").over(w.orderBy("o_orderdate")).alias("rolling_sum_increasing"),
                    F.sum("o_totalprice").over(w.orderBy(F.col("o_orderdate").desc())).alias("rolling_sum_decreasing"))


# --- X3-X15 scalar functions used by checks and models -------------------------

@reg("x3_x15_scalar_functions", """
SELECT l_orderkey, l_linenumber, l_partkey,
  md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)) AS row_md5,
  CAST(l_partkey % 7 AS BIGINT) AS part_mod_7,
  CAST(floor(l_extendedprice / 1000) AS BIGINT) AS price_thousands,
  least(l_discount, l_tax) AS min_rate,
  power(l_quantity, 2) AS qty_squared,
  CAST(length(l_returnflag || l_linestatus) AS INTEGER) AS flags_length,
  CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS tax_per_discount,
  CASE WHEN l_discount - 0.05 > 0 THEN ln(l_discount - 0.05) END AS safe_log,
  TRY_CAST(CASE WHEN l_linenumber = 7 THEN 'x' ELSE CAST(l_quantity AS VARCHAR) END AS DOUBLE) AS safe_cast_qty
FROM lineitem""", round6=("safe_log",))
def _x(s, sf):
    from marketlake.functions import safe_divide, safe_ln
    li = _t(s, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.md5(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
        .alias("row_md5"),
        (F.col("l_partkey") % 7).alias("part_mod_7"),
        F.floor(F.col("l_extendedprice") / 1000).cast("bigint").alias("price_thousands"),
        F.least("l_discount", "l_tax").alias("min_rate"),
        F.pow("l_quantity", 2).alias("qty_squared"),
        F.length(F.concat("l_returnflag", "l_linestatus")).alias("flags_length"),
        safe_divide(F.col("l_tax"), F.nullif(F.col("l_discount"), F.lit(0.0))).alias("tax_per_discount"),
        safe_ln(F.col("l_discount") - 0.05).alias("safe_log"),
        F.when(F.col("l_linenumber") == 7, F.lit("x")).otherwise(F.col("l_quantity").cast("string"))
        .try_cast("double").alias("safe_cast_qty"))
