"""Incremental loading, schema drift, row history."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators import joins as J
from candlewick.plans import facts, staging
from candlewick.session import scratch_path
from candlewick.tables import compaction, drift, incremental, snapshot
from candlewick.tables.maintained import Maintained, changed_groups
from candlewick.tables.store import Table
from verification.base import (
    DAY_KEYS, candles_1m, candles_long, check, daily, kline_messages, r, raw_trades, rounded, stg_trades, table, using,
)

O = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"  # noqa: E741
O_COLS = O.split(", ")


def orders(spark, sf):
    return table(spark, sf, "orders").select(*O_COLS)


def stored(spark, df, label, partition_by=()):
    t = Table(spark, scratch_path(spark, label), partition_by)
    t.replace(df)
    return t


# the stored table has the cheaper orders; the batch brings dearer ones and corrections of the middle band
OLD, BATCH = "o_totalprice < 300000", "o_totalprice >= 200000"


def batch(spark, sf):
    return orders(spark, sf).filter(BATCH).withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("o_orderstatus", F.lit("X"))


_BATCH = f"SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE {BATCH}"
_MERGED = f"SELECT {O} FROM orders WHERE NOT ({BATCH}) UNION ALL {_BATCH}"


# ---- which rows are new -----------------------------------------------------


@check("inc_gate", f"SELECT {O} FROM orders WHERE o_totalprice >= 300000")
def inc_gate(spark, sf):
    t = Table(spark, scratch_path(spark, "gate"))
    incremental.load(t, orders(spark, sf).filter(OLD), "append")  # no target yet: a full build
    incremental.load(t, orders(spark, sf).filter(f"not ({OLD})"), "append", full_refresh=True)
    return t.read()


@check("inc_high_water_global", "SELECT event_id, event_type, ts FROM events")
def inc_high_water_global(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    half = e.agg(F.expr("max(event_id) div 2")).scalar()
    t = stored(spark, e.filter(F.col("event_id") <= half), "marks")
    t.append(incremental.above_mark(e, t.read(), "event_id"))
    return t.read()


@check("inc_high_water_per_key", using("trades", """SELECT agg_trade_id, pair_symbol, transaction_date FROM trades WHERE pair_symbol <> 'CLIUSDT' OR transaction_date > DATE '2024-01-10'
    UNION ALL SELECT agg_trade_id, pair_symbol, transaction_date FROM trades WHERE pair_symbol = 'CLIUSDT' AND transaction_date <= DATE '2024-01-10'"""))
def inc_high_water_per_key(spark, sf):
    t = stg_trades(spark, sf).select("agg_trade_id", "pair_symbol", "transaction_date")
    early = t.filter("(pair_symbol = 'CLIUSDT' and transaction_date <= '2024-01-10') or (pair_symbol = 'VIEUSDT' and transaction_date <= '2024-01-20')")
    out = stored(spark, early, "per_key")  # three pairs are new to the table
    out.append(incremental.above_own_mark(t, out.read(), ["pair_symbol"], "transaction_date"))
    return out.read()


@check("inc_anti_join", using("candles_long", "SELECT asset_pair_symbol, open_date, open_time, close FROM candles_long"))
def inc_anti_join(spark, sf):
    c = candles_long(spark, sf).select("asset_pair_symbol", "open_date", "open_time", "close")
    t = stored(spark, c.filter("open_date < '1998-01-01'"), "anti")
    t.append(incremental.unseen(c, t.read(), staging.CANDLE_KEYS))
    return t.read()


# ---- strategies -------------------------------------------------------------


@check("inc_append", f"SELECT {O} FROM orders WHERE {OLD} UNION ALL {_BATCH}")
def inc_append(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "append")
    incremental.load(t, batch(spark, sf), "merge", unique_key=())  # a merge without a key appends
    return t.read()


@check("inc_merge", f"SELECT {O} FROM orders WHERE {OLD} AND NOT ({BATCH}) UNION ALL {_BATCH}")
def inc_merge(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "merge")
    incremental.load(t, batch(spark, sf), "merge", ["o_orderkey"])
    return t.read()


@check("inc_merge_partitioned", """SELECT o_orderkey, y, CASE WHEN y >= 2000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM (
    SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)""")
def inc_merge_partitioned(spark, sf):
    """Only the years present in the batch are read and rewritten."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"), "o_totalprice")
    known = o.filter(f"{OLD} or y < 2000").drop("o_totalprice")  # of the newer years only the cheaper orders are stored
    o = o.drop("o_totalprice")
    t = stored(spark, known, "years", ["y"])
    fresh = o.filter("y >= 2000").withColumn("o_orderstatus", F.lit("X"))
    incremental.load(t, fresh, "merge", ["o_orderkey", "y"], partition_in_key=True)
    return t.read()


@check("inc_merge_pruned", f"""SELECT {O} FROM orders WHERE {OLD} AND o_orderkey % 400 <> 0 UNION ALL
    SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 400 = 0""")
def inc_merge_pruned(spark, sf):
    """A merge that reads and rewrites only the files that hold a key of the batch."""
    t = Table(spark, scratch_path(spark, "pruned"), key=["o_orderkey"])
    t.replace(orders(spark, sf).filter(OLD).repartitionByRange(8, "o_orderkey"))
    fresh = orders(spark, sf).filter("o_orderkey % 400 = 0").withColumn("o_orderstatus", F.lit("X"))
    incremental.load(t, fresh, "merge", ["o_orderkey"])
    return t.read()


@check("inc_append_compacted", f"SELECT {O} FROM orders")
def inc_append_compacted(spark, sf):
    """Small appends whose files are packed as they come together."""
    t = Table(spark, scratch_path(spark, "compacted"))
    for i in range(9):
        compaction.append(t, orders(spark, sf).filter(f"o_orderkey % 9 = {i}"), fan_in=4)
    return t.read()


@check("inc_merge_columns", f"""SELECT o_orderkey, o_custkey, CASE WHEN {OLD} THEN o_orderstatus ELSE 'X' END AS o_orderstatus,
    CASE WHEN {BATCH} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""")
def inc_merge_columns(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "columns")
    incremental.load(t, batch(spark, sf), "merge", ["o_orderkey"], update_columns=["o_totalprice"])
    return t.read()


@check("inc_merge_predicates", f"""SELECT {O} FROM orders WHERE {OLD} AND NOT (o_orderstatus = 'F' AND {BATCH}) UNION ALL {_BATCH}""")
def inc_merge_predicates(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "predicate")
    incremental.load(t, batch(spark, sf), "merge", ["o_orderkey"], predicate=F.col("o_orderstatus") == "F")
    return t.read()


@check("inc_delete_insert", f"""SELECT {O} FROM orders WHERE {OLD} AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE {BATCH})
    UNION ALL {_BATCH} UNION ALL {_BATCH}""")
def inc_delete_insert(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "delins")
    b = batch(spark, sf)
    incremental.load(t, b.unionByName(b), "delete_insert", ["o_custkey"])
    return t.read()


@check("inc_insert_overwrite", _BATCH)
def inc_insert_overwrite(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "overwrite")
    incremental.load(t, batch(spark, sf), "insert_overwrite")
    return t.read()


@check("inc_insert_overwrite_columns", f"SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE {BATCH}")
def inc_insert_overwrite_columns(spark, sf):
    """Only the named columns are inserted; the others become NULL."""
    t = stored(spark, orders(spark, sf).filter(OLD), "overwrite_columns")
    incremental.load(t, batch(spark, sf), "insert_overwrite", columns=["o_orderkey", "o_totalprice"])
    return t.read()


@check("inc_merge_newest", f"""SELECT {O} FROM orders WHERE {OLD} AND NOT ({BATCH}) UNION ALL
    SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 2 AS o_totalprice FROM orders WHERE {BATCH}""")
def inc_merge_newest(spark, sf):
    """A batch with two rows per key, reduced to the newest by a stated order."""
    t = stored(spark, orders(spark, sf).filter(OLD), "merge_newest")
    b = batch(spark, sf)
    twice = b.unionByName(b.withColumn("o_totalprice", F.col("o_totalprice") + 1))
    incremental.load(t, twice, "merge", ["o_orderkey"], newest_by=["o_totalprice"])
    return t.read()


@check("inc_microbatch", """SELECT event_id, CASE WHEN d BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' THEN value + 1 ELSE value END AS value, d
    FROM (SELECT event_id, value, ts::DATE AS d FROM events) WHERE NOT (d = DATE '2024-01-11')""")
def inc_microbatch(spark, sf):
    import datetime as dt

    e = table(spark, sf, "events").select("event_id", "value", F.to_date("ts").alias("d"))
    t = stored(spark, e, "periods", ["d"])
    again = e.filter("d between '2024-01-10' and '2024-01-12' and d <> '2024-01-11'").withColumn("value", F.col("value") + 1)
    incremental.load(t, again, "microbatch", event_time="d", period=(dt.date(2024, 1, 10), dt.date(2024, 1, 13)))
    return t.read()


@check("inc_strategy_default", f"SELECT {O} FROM orders WHERE {OLD} AND NOT ({BATCH}) UNION ALL {_BATCH}")
def inc_strategy_default(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "default")
    incremental.load(t, batch(spark, sf), unique_key=["o_orderkey"])
    return t.read()


# ---- drift ------------------------------------------------------------------


def drifted(spark, sf):
    """The batch without the status, with a segment, and with a wider customer key."""
    b = orders(spark, sf).filter(f"not ({OLD})").drop("o_orderstatus")
    return b.withColumn("segment", F.lit("new"))


@check("inc_schema_ignore", f"SELECT {O} FROM orders")
def inc_schema_ignore(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "ignore")
    extra = orders(spark, sf).filter(f"not ({OLD})").withColumn("segment", F.lit("new"))
    incremental.load(t, extra, "append", on_schema_change="ignore")
    return t.read()


@check("inc_schema_append", f"""SELECT o_orderkey, o_custkey, CASE WHEN {OLD} THEN o_orderstatus END AS o_orderstatus, o_totalprice,
    CASE WHEN NOT ({OLD}) THEN 'new' END AS segment FROM orders""")
def inc_schema_append(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "append_columns")
    incremental.load(t, drifted(spark, sf), "append", on_schema_change="append_new_columns")
    return t.read()


@check("inc_schema_sync", f"""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice, CASE WHEN NOT ({OLD}) THEN 'new' END AS segment FROM orders""")
def inc_schema_sync(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "sync")
    incremental.load(t, drifted(spark, sf).withColumn("o_custkey", F.col("o_custkey").cast("string")), "append", on_schema_change="sync_all_columns")
    return t.read()


@check("inc_schema_fail", f"SELECT {O} FROM orders WHERE {OLD}")
def inc_schema_fail(spark, sf):
    t = stored(spark, orders(spark, sf).filter(OLD), "fail")
    try:
        incremental.load(t, drifted(spark, sf), "append", on_schema_change="fail")
    except drift.SchemaChanged:
        return t.read()  # the refused batch left the table as it was
    raise AssertionError("the drift was not noticed")


@check("inc_schema_diff", """SELECT o_orderstatus, count(*) AS n, 'segment' AS added, 'o_orderstatus' AS removed, 'o_custkey' AS retyped FROM orders GROUP BY 1""")
def inc_schema_diff(spark, sf):
    o = orders(spark, sf)
    d = drift.diff(o.schema, drifted(spark, sf).withColumn("o_custkey", F.col("o_custkey").cast("string")).schema)
    names = {k: ",".join(f.name for f in getattr(d, k)) for k in ("added", "removed", "retyped")}
    return o.groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumns({k: F.lit(v) for k, v in names.items()})


# ---- history ----------------------------------------------------------------

T1, T2 = "2024-03-01 00:00:00", "2024-03-02 00:00:00"


def parts(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("cmc_rank"))


def parts_later(spark, sf):
    """Some ranks changed, some became NULL, some keys gone, some new."""
    p = parts(spark, sf)
    rank = F.when(F.col("id") % 100 == 10, F.lit(None)).when(F.col("id") % 10 == 0, F.col("cmc_rank") + 1).otherwise(F.col("cmc_rank"))
    new = p.filter("id % 400 = 3").withColumn("id", F.col("id") + 1_000_000_000)
    return p.filter("id % 50 <> 1").withColumn("cmc_rank", rank.cast("int")).unionByName(new)


FIRST = lambda spark, sf, **k: snapshot.first_snapshot(parts(spark, sf), ["id"], F.lit(T1), **k)


def _v(source, at, to="NULL", extra=""):
    scd = f"md5(id || '|' || '{at}')"
    return f"""SELECT id, name, cmc_rank, {scd} AS dbt_scd_id, TIMESTAMP '{at}' AS dbt_updated_at, TIMESTAMP '{at}' AS dbt_valid_from,
    {to} AS dbt_valid_to{extra} FROM {source}"""


_NULL = "CAST(NULL AS TIMESTAMP)"
_END = f"TIMESTAMP '{T2}'"
_HIST = """WITH p AS (SELECT p_partkey AS id, p_name AS name, p_size AS cmc_rank FROM part),
l AS (SELECT id, name, CASE WHEN id % 100 = 10 THEN NULL WHEN id % 10 = 0 THEN cmc_rank + 1 ELSE cmc_rank END AS cmc_rank FROM p WHERE id % 50 <> 1
    UNION ALL SELECT id + 1000000000, name, cmc_rank FROM p WHERE id % 400 = 3)
"""
_CHANGED = "(SELECT p.* FROM p JOIN l USING (id) WHERE p.cmc_rank IS DISTINCT FROM l.cmc_rank)"
_SAME = "(SELECT p.* FROM p JOIN l USING (id) WHERE p.cmc_rank IS NOT DISTINCT FROM l.cmc_rank)"
_GONE = "(SELECT * FROM p WHERE id NOT IN (SELECT id FROM l))"
_NEWER = "(SELECT l.* FROM l LEFT JOIN p USING (id) WHERE p.id IS NULL OR p.cmc_rank IS DISTINCT FROM l.cmc_rank)"


def history_sql(open_end=_NULL, gone_end=_NULL, tombs=False):
    extra = ", 'False' AS dbt_is_deleted" if tombs else ""
    sql = _HIST + " UNION ALL ".join([
        _v(_CHANGED, T1, _END, extra), _v(_SAME, T1, open_end, extra), _v(_GONE, T1, gone_end, extra), _v(_NEWER, T2, open_end, extra)])
    if tombs:
        sql += " UNION ALL " + _v(_GONE, T2, open_end, ", 'True' AS dbt_is_deleted")
    return sql


@check("scd2_initial", _HIST + _v("p", T1, _NULL))
def scd2_initial(spark, sf):
    return FIRST(spark, sf)


@check("scd2_check", history_sql())
def scd2_check(spark, sf):
    return snapshot.snapshot(FIRST(spark, sf), parts_later(spark, sf), ["id"], T2, check_cols=["cmc_rank"])


@check("scd2_check_all", _HIST + " UNION ALL ".join([
    _v("(SELECT p.* FROM p JOIN l USING (id) WHERE p.cmc_rank IS DISTINCT FROM l.cmc_rank OR id % 7 = 0)", T1, _END),
    _v("(SELECT p.* FROM p JOIN l USING (id) WHERE p.cmc_rank IS NOT DISTINCT FROM l.cmc_rank AND id % 7 <> 0)", T1, _NULL), _v(_GONE, T1, _NULL),
    _v("(SELECT l.id, CASE WHEN l.id % 7 = 0 AND p.id IS NOT NULL THEN l.name || '!' ELSE l.name END AS name, l.cmc_rank FROM l LEFT JOIN p USING (id)"
       " WHERE p.id IS NULL OR p.cmc_rank IS DISTINCT FROM l.cmc_rank OR l.id % 7 = 0)", T2, _NULL)]))
def scd2_check_all(spark, sf):
    """Every column but the key is compared: some names change, too."""
    renamed = F.when((F.col("id") % 7 == 0) & (F.col("id") < 1_000_000_000), F.concat("name", F.lit("!"))).otherwise(F.col("name"))
    return snapshot.snapshot(FIRST(spark, sf), parts_later(spark, sf).withColumn("name", renamed), ["id"], T2, check_cols="all")


@check("scd2_check_stamped", _HIST + " UNION ALL ".join([
    _v(_CHANGED, T1, "TIMESTAMP '2024-03-01 12:00:00'"), _v(_SAME, T1, _NULL), _v(_GONE, T1, _NULL), _v(_NEWER, "2024-03-01 12:00:00", _NULL)]))
def scd2_check_stamped(spark, sf):
    """Columns decide what changed, the source's stamp dates it."""
    stamped = lambda df, at: df.withColumn("seen_at", F.lit(at).cast("timestamp_ntz"))
    old = snapshot.first_snapshot(stamped(parts(spark, sf), T1), ["id"], F.col("seen_at"))
    later = stamped(parts_later(spark, sf), "2024-03-01 12:00:00")
    return snapshot.snapshot(old, later, ["id"], T2, check_cols=["cmc_rank"], updated_at="seen_at").drop("seen_at")


@check("scd2_column_names", "SELECT id, name, cmc_rank, dbt_scd_id AS version_id, dbt_updated_at, dbt_valid_from AS starts, dbt_valid_to AS ends FROM (" + history_sql() + ")")
def scd2_column_names(spark, sf):
    names = {"dbt_scd_id": "version_id", "dbt_valid_from": "starts", "dbt_valid_to": "ends"}
    return snapshot.snapshot(FIRST(spark, sf, names=names), parts_later(spark, sf), ["id"], T2, check_cols=["cmc_rank"], names=names)


@check("scd2_timestamp", _HIST + " UNION ALL ".join([
    _v("(SELECT * FROM p WHERE id NOT IN (SELECT id FROM l WHERE id % 4 = 0))", T1, _NULL),
    _v("(SELECT * FROM p WHERE id IN (SELECT id FROM l WHERE id % 4 = 0))", T1, _END),
    _v("(SELECT * FROM l WHERE id % 4 = 0 AND id < 1000000000)", T2, _NULL),
    _v("(SELECT * FROM l WHERE id >= 1000000000)", T1, _NULL)]).replace("dbt_updated_at, TIMESTAMP", "dbt_updated_at, TIMESTAMP"))
def scd2_timestamp(spark, sf):
    stamp = F.when((F.col("id") % 4 == 0) & (F.col("id") < 1_000_000_000), F.lit(T2)).otherwise(F.lit(T1)).cast("timestamp_ntz")
    old = snapshot.first_snapshot(parts(spark, sf).withColumn("seen_at", F.lit(T1).cast("timestamp_ntz")), ["id"], F.col("seen_at"))
    out = snapshot.snapshot(old, parts_later(spark, sf).withColumn("seen_at", stamp), ["id"], T2, updated_at="seen_at")
    return out.drop("seen_at")


@check("scd2_merge", history_sql())
def scd2_merge(spark, sf):
    """The open part of the stored history is replaced, the closed one added to; a repeated run changes nothing."""
    h = snapshot.History(spark, scratch_path(spark, "history"), ["id"], check_cols=["cmc_rank"])
    h.start(parts(spark, sf), F.lit(T1))
    for _ in range(2):
        h.run(parts_later(spark, sf), T2)
    return h.read()


@check("scd2_hard_delete_ignore", history_sql())
def scd2_hard_delete_ignore(spark, sf):
    return snapshot.snapshot(FIRST(spark, sf), parts_later(spark, sf), ["id"], T2, check_cols=["cmc_rank"], hard_deletes="ignore")


@check("scd2_hard_delete_invalidate", history_sql(gone_end=_END))
def scd2_hard_delete_invalidate(spark, sf):
    return snapshot.snapshot(FIRST(spark, sf), parts_later(spark, sf), ["id"], T2, check_cols=["cmc_rank"], hard_deletes="invalidate")


@check("scd2_hard_delete_new_record", history_sql(gone_end=_END, tombs=True))
def scd2_hard_delete_new_record(spark, sf):
    old = FIRST(spark, sf, hard_deletes="new_record")
    return snapshot.snapshot(old, parts_later(spark, sf), ["id"], T2, check_cols=["cmc_rank"], hard_deletes="new_record")


_FOREVER = "9999-12-31 00:00:00"


@check("scd2_valid_to_current", history_sql(open_end=f"TIMESTAMP '{_FOREVER}'", gone_end=f"TIMESTAMP '{_FOREVER}'"))
def scd2_valid_to_current(spark, sf):
    old = FIRST(spark, sf, open_marker=_FOREVER)
    return snapshot.snapshot(old, parts_later(spark, sf), ["id"], T2, check_cols=["cmc_rank"], open_marker=_FOREVER)


@check("scd2_multi_key", (_HIST + "SELECT id, name, cmc_rank, a AS dbt_valid_from, b AS dbt_valid_to FROM (" + " UNION ALL ".join([
    f"SELECT *, TIMESTAMP '{T1}' AS a, {_END} AS b FROM {_CHANGED}", f"SELECT *, TIMESTAMP '{T1}', {_NULL} FROM {_SAME}",
    f"SELECT *, TIMESTAMP '{T1}', {_NULL} FROM {_GONE}", f"SELECT *, TIMESTAMP '{T2}', {_NULL} FROM {_NEWER}"]) + ")"))
def scd2_multi_key(spark, sf):
    keys = ["id", "name"]
    old = snapshot.first_snapshot(parts(spark, sf), keys, F.lit(T1))
    return snapshot.snapshot(old, parts_later(spark, sf), keys, T2, check_cols=["cmc_rank"]).drop("dbt_scd_id", "dbt_updated_at")


@check("scd2_add_columns", (_HIST + "SELECT id, cmc_rank, NULL AS size_text, a AS dbt_valid_from, b AS dbt_valid_to FROM (" + " UNION ALL ".join([
    f"SELECT *, TIMESTAMP '{T1}' AS a, {_END} AS b FROM {_CHANGED}", f"SELECT *, TIMESTAMP '{T1}', {_NULL} FROM {_SAME}",
    f"SELECT *, TIMESTAMP '{T1}', {_NULL} FROM {_GONE}"]) + f") UNION ALL SELECT id, cmc_rank, 'n' || id, TIMESTAMP '{T2}', {_NULL} FROM {_NEWER}"))
def scd2_add_columns(spark, sf):
    later = parts_later(spark, sf).withColumn("size_text", F.concat(F.lit("n"), F.col("id").cast("string")))
    out = snapshot.snapshot(FIRST(spark, sf), later, ["id"], T2, check_cols=["cmc_rank"])
    return out.select("id", "cmc_rank", "size_text", "dbt_valid_from", "dbt_valid_to")


# ---- look-back --------------------------------------------------------------


@check("inc_lookback_windows", using("crossed", f"SELECT asset_pair_symbol, open_date, {r('price_avg_50', 'price_avg_50')}, {r('price_avg_200', 'price_avg_200')}, ma_crossover_event FROM crossed"))
def inc_lookback_windows(spark, sf):
    """An incremental run of a rolling indicator equals the full run."""
    d = daily(spark, sf)
    cols = [*DAY_KEYS, "price_avg_50", "price_avg_200", "ma_crossover_event"]
    t = stored(spark, facts.technical_columns(d.filter("open_date < '2000-01-01'")).select(*cols), "technical")
    t.append(facts.with_new_days(d, t.read(), facts.technical_columns, 200).select(*cols))
    return rounded(t.read(), "price_avg_50", "price_avg_200")


# ---- maintained aggregates --------------------------------------------------

_FINAL = "(SELECT o_orderstatus, o_orderpriority, CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS p FROM orders WHERE o_orderkey % 7 <> 0)"


@check("mat_maintained", f"""SELECT o_orderstatus, o_orderpriority, count(*) AS n, {r('sum(p)', 'o_totalprice_sum')}, {r('avg(p)', 'o_totalprice_mean')},
    min(p) AS o_totalprice_least, max(p) AS o_totalprice_greatest FROM {_FINAL} GROUP BY ALL""")
def mat_maintained(spark, sf):
    """Orders come in two batches, every ninth is corrected, every seventh deleted: the same as over the final rows."""
    keys = ["o_orderstatus", "o_orderpriority"]
    o = table(spark, sf, "orders").select("o_orderkey", *keys, "o_totalprice")
    ninth, seventh = F.col("o_orderkey") % 9 == 0, F.col("o_orderkey") % 7 == 0
    right = o.withColumn("o_totalprice", F.when(ninth, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")))
    now = {"rows": o}
    m = Maintained(scratch_path(spark, "states"), spark, keys, ["o_totalprice"], lambda groups: changed_groups(now["rows"], groups, keys))
    m.start(o.filter("o_orderkey % 2 = 0"), 0)
    m.apply(o.filter("o_orderkey % 2 = 1"), number=1)
    now["rows"] = right
    m.apply(right.filter(ninth), o.filter(ninth), 2)
    now["rows"] = right.filter(~seventh)
    for _ in range(2):  # the same batch twice: taken in once
        m.apply(went=right.filter(seventh), number=3)
    out = m.read().select(*keys, "n", "o_totalprice_sum", "o_totalprice_mean", "o_totalprice_least", "o_totalprice_greatest")
    return rounded(out, "o_totalprice_sum", "o_totalprice_mean")
