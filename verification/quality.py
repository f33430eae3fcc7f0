"""Declarative checks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.plans import dims, facts, marts
from candlewick.session import scratch_path
from candlewick.tables import quality as Q
from verification.base import CAL_START, assets_dim, check, hourly_fct, stg_trades, table, using

_NULLED = "(SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END AS k FROM orders)"


def nulled(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("k"))


@check("dq_not_null", f"SELECT * FROM {_NULLED} WHERE k IS NULL")
def dq_not_null(spark, sf):
    return Q.not_null(nulled(spark, sf), "k")


@check("dq_unique", f"SELECT k AS unique_field, count(*) AS n_records FROM {_NULLED} WHERE k IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, sf):
    return Q.unique(nulled(spark, sf), "k")


@check("dq_accepted_values", "SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1")
def dq_accepted_values(spark, sf):
    return Q.accepted_values(table(spark, sf, "events"), "event_type", ["click", "view"])


@check("dq_relationships", f"""SELECT k AS from_field, count(*) AS n_records FROM {_NULLED} c LEFT JOIN (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal > 0) p
    ON p.c_custkey = c.k WHERE k IS NOT NULL AND c_custkey IS NULL GROUP BY 1""")
def dq_relationships(spark, sf):
    return Q.relationships(nulled(spark, sf), "k", table(spark, sf, "customer").filter("c_acctbal > 0"), "c_custkey")


@check("dq_unique_combination", "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_combination(spark, sf):
    return Q.unique_combination(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@check("dq_severity", f"SELECT count(*) AS failures, count(*) > 10 AS should_warn, count(*) > 1000000000 AS should_error FROM {_NULLED} WHERE k IS NULL")
def dq_severity(spark, sf):
    rule = Q.Severity("failures > 10", "failures > 1000000000")
    return Q.severity(Q.not_null(nulled(spark, sf), "k"), rule)


@check("dq_calendar_covers", using("trades", "SELECT transaction_date, count(*) AS trades FROM trades WHERE transaction_date > DATE '2024-01-20' GROUP BY 1"))
def dq_calendar_covers(spark, sf):
    """Trades after the last day of a calendar that ends too early."""
    short = dims.calendar(spark, CAL_START, "2024-01-20")
    return marts.outside_calendar(facts.fct_trades(stg_trades(spark, sf), assets_dim(spark, sf), short))


@check("dq_fail_calc", """SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS failures, sum(n) > 100 AS should_warn, sum(n) > 1000000000 AS should_error FROM (
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def dq_fail_calc(spark, sf):
    """Failures counted as all rows of a repeated key, not as keys."""
    rule = Q.Severity("failures > 100", "failures > 1000000000", fail_calc="sum(n_records)")
    return Q.severity(Q.unique_combination(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]), rule)


@check("dq_failures_view", f"SELECT * FROM {_NULLED} WHERE k IS NULL")
def dq_failures_view(spark, sf):
    return Q.failures_view(Q.not_null(nulled(spark, sf), "k"), "rows_without_k")


@check("dq_store_failures", f"SELECT * FROM {_NULLED} WHERE k IS NULL")
def dq_store_failures(spark, sf):
    return Q.store_failures(Q.not_null(nulled(spark, sf), "k"), scratch_path(spark, "failures"))


@check("dq_row_diff", """SELECT n, 'actual' AS actual_or_expected FROM (SELECT c_nationkey AS n FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)
    UNION ALL SELECT n, 'expected' FROM (SELECT s_nationkey AS n FROM supplier EXCEPT ALL SELECT c_nationkey FROM customer)""")
def dq_row_diff(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_nationkey").alias("n"))
    return Q.row_diff(a, table(spark, sf, "supplier").select(F.col("s_nationkey").alias("n")))


@check("dq_contract", "SELECT n_nationkey, n_name FROM nation")
def dq_contract(spark, sf):
    declared = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType())])
    return Q.contract(table(spark, sf, "nation").select("n_nationkey", "n_name"), declared)
