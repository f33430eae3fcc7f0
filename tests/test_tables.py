"""Stored tables, loading strategies, drift, history."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import scratch_path
from candlewick.operators import aggregates
from candlewick.sources import files
from candlewick.sources import generators as G
from candlewick.tables import drift, incremental, quality, snapshot
from candlewick.tables.store import Table


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, data):
    return spark.createDataFrame(data, "k int, d string, v double")


def table(spark, data, partition_by=()):
    t = Table(spark, scratch_path(spark, "t"), partition_by)
    t.replace(frame(spark, data))
    return t


BASE = [(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0)]


def test_replace_publishes_by_commit(spark):
    t = table(spark, BASE)
    first = t.location()
    old = t.read()
    t.replace(frame(spark, BASE[:1]))
    assert t.location() != first and t.read().count() == 1
    assert old.count() == 3  # the earlier version stays readable
    # a rebuild that never published its manifest is not seen
    t._write(frame(spark, BASE))
    assert t.read().count() == 1


class Crash(Exception):
    pass


@pytest.mark.parametrize("strategy", ["merge", "delete_insert", "microbatch", "append", "insert_overwrite"])
def test_crash_before_publishing(spark, monkeypatch, strategy):
    """Files are written, the version isn't: the table is as before, and a replay gives what one run gives."""
    t = table(spark, BASE, ["d"])
    batch = frame(spark, [(1, "a", 10.0), (9, "c", 9.0)])
    more = {"event_time": "d", "period": ("a", "b")} if strategy == "microbatch" else {"partition_in_key": True}
    load = lambda: incremental.load(t, batch, strategy, ["k", "d"], **more)

    def crash(*_):
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(Table, "_publish", crash)
        with pytest.raises(Crash):
            load()
    assert rows(t.read().select("k", "d", "v")) == BASE
    load()
    got = rows(t.read().select("k", "d", "v"))
    want = {
        "merge": [(1, "a", 10.0), (2, "a", 2.0), (3, "b", 3.0), (9, "c", 9.0)],
        "delete_insert": [(1, "a", 10.0), (2, "a", 2.0), (3, "b", 3.0), (9, "c", 9.0)],
        "microbatch": [(1, "a", 10.0), (3, "b", 3.0), (9, "c", 9.0)],
        "append": [(1, "a", 1.0), (1, "a", 10.0), (2, "a", 2.0), (3, "b", 3.0), (9, "c", 9.0)],
        "insert_overwrite": [(1, "a", 10.0), (9, "c", 9.0)],
    }
    assert got == want[strategy]
    if strategy == "merge":
        load()
        assert rows(t.read().select("k", "d", "v")) == got


def test_readers_keep_their_version(spark):
    t = table(spark, BASE, ["d"])
    old = t.read()
    incremental.load(t, frame(spark, [(1, "a", 10.0)]), "merge", ["k", "d"], partition_in_key=True)
    assert rows(old.select("k", "d", "v")) == BASE


def test_old_versions_go(spark):
    t = table(spark, BASE, ["d"])
    for i in range(6):
        incremental.load(t, frame(spark, [(1, "a", float(i))]), "merge", ["k", "d"], partition_in_key=True)
    assert len(t.versions()) == t.kept_versions
    used = {load for n in t.versions() for load in t.manifest(n)["loads"]}
    assert {n.partition("=")[2] for n in t._names(f"{t.path}/data/*")} == used
    assert rows(t.read().select("k", "d", "v")) == [(1, "a", 5.0), *BASE[1:]]


def test_null_and_odd_partitions(spark):
    data = [(1, None, 1.0), (2, "a/b=c %", 2.0), (3, "x", 3.0)]
    t = table(spark, data, ["d"])
    incremental.load(t, frame(spark, [(2, "a/b=c %", 20.0), (5, None, 5.0)]), "merge", ["k", "d"], partition_in_key=True)
    assert rows(t.read().select("k", "d", "v")) == rows(frame(spark, [(1, None, 1.0), (2, "a/b=c %", 20.0), (3, "x", 3.0), (5, None, 5.0)]))
    kept = [f for fs in t.manifest()["loads"].values() for f in fs]
    assert len(kept) == 3 and len(t.manifest()["loads"]) == 2  # the untouched partition keeps its files


def test_merge_reads_only_touched_folders(spark):
    t = table(spark, BASE, ["d"])
    assert all("d=b" in f for f in t.only({("b",)}).inputFiles()) and t.only(set()).count() == 0
    assert t.marks("d") == ["a", "b"] or sorted(t.marks("d")) == ["a", "b"]


def test_merge_refuses_duplicate_keys(spark):
    twice = frame(spark, [(1, "a", 5.0), (1, "a", 6.0), (None, "a", 7.0), (None, "a", 8.0)])
    for columns in (None, ["v"]):
        t = table(spark, BASE)
        with pytest.raises(incremental.DuplicateKeys):
            incremental.load(t, twice, "merge", ["k"], update_columns=columns)
        assert rows(t.read()) == BASE
        incremental.load(t, twice, "merge", ["k"], update_columns=columns, newest_by=["v"])
        assert sorted((r.k or 0, r.v) for r in t.read().collect()) == [(0, 7.0), (0, 8.0), (1, 6.0), (2, 2.0), (3, 3.0)]


def test_column_subset(spark):
    t = table(spark, BASE)
    incremental.load(t, frame(spark, [(7, "q", 7.0)]), "insert_overwrite", columns=["k", "V"])
    assert rows(t.read()) == [(7, None, 7.0)]
    incremental.load(t, frame(spark, [(8, "q", 8.0)]).drop("d"), "append", columns=["k"])
    assert rows(t.read()) == [(7, None, 7.0), (8, None, None)]
    with pytest.raises(ValueError):
        incremental.load(t, frame(spark, BASE), "merge", ["k"], columns=["k"])
    with pytest.raises(ValueError):
        incremental.load(t, frame(spark, BASE), "append", columns=["nope"])


def test_marks_reach_the_scan(spark):
    t = table(spark, BASE, ["d"])
    src = table(spark, [(4, "a", 4.0), (5, "b", 5.0), (6, "c", 6.0), (7, None, 7.0), (8, "b", 1.0)])
    new = incremental.above_own_mark(src.read(), t.read(), ["d"], "v")
    assert rows(new) == rows(frame(spark, [(4, "a", 4.0), (5, "b", 5.0), (6, "c", 6.0), (7, None, 7.0)]))
    assert rows(incremental.above_own_mark(src.read(), t.read(), ["d"], "v", strict=True)) == [(4, "a", 4.0), (5, "b", 5.0)]
    assert "GreaterThan(v,2.0)" in incremental.above_own_mark(src.read(), t.read(), ["d"], "v", strict=True)._jdf.queryExecution().toString()
    assert "GreaterThan(v,3.0)" in incremental.above_mark(src.read(), t.read(), "v")._jdf.queryExecution().toString()
    assert incremental.above_mark(src.read(), t.read().limit(0), "v").count() == 5
    assert incremental.above_mark(src.read(), t.read().limit(0), "v", strict=True).count() == 0


def test_replace_from_itself(spark):
    t = table(spark, BASE)
    t.replace(t.read().filter("k > 1"))
    assert rows(t.read()) == BASE[1:]


def test_empty_target_keeps_schema(spark):
    t = table(spark, [], ["d"])
    assert t.read().count() == 0 and t.read().columns == ["k", "v", "d"]
    incremental.load(t, frame(spark, BASE), "merge", ["k", "d"], partition_in_key=True)
    assert t.read().count() == 3


@pytest.mark.parametrize("partitioned", [False, True])
def test_merge_is_idempotent(spark, partitioned):
    t = table(spark, BASE, ["d"] if partitioned else ())
    batch = frame(spark, [(2, "a", 20.0), (4, "c", 4.0)])
    for _ in range(2):
        incremental.load(t, batch, "merge", ["k", "d"], partition_in_key=partitioned)
    assert rows(t.read().select("k", "d", "v")) == [(1, "a", 1.0), (2, "a", 20.0), (3, "b", 3.0), (4, "c", 4.0)]


def test_partitioned_merge_leaves_other_files(spark):
    t = table(spark, BASE, ["d"])
    files = lambda: {f for f in t.read().inputFiles() if "/d=b/" in f}
    before = files()
    incremental.load(t, frame(spark, [(2, "a", 9.0)]), "merge", ["k", "d"], partition_in_key=True)
    assert files() == before


def test_null_keys_never_match(spark):
    got = incremental.merged(frame(spark, [(None, "a", 1.0)]), frame(spark, [(None, "b", 2.0)]), ["k"])
    assert got.count() == 2


def test_update_and_exclude_columns(spark):
    target, source = frame(spark, BASE), frame(spark, [(1, "z", 10.0), (7, "z", 70.0)])
    got = rows(incremental.merged(target, source, ["k"], update_columns=["v"]))
    assert got == [(1, "a", 10.0), (2, "a", 2.0), (3, "b", 3.0), (7, "z", 70.0)]
    assert rows(incremental.merged(target, source, ["k"], exclude_columns=["v"]))[0] == (1, "z", 1.0)
    with pytest.raises(ValueError):
        incremental.merged(target, source, ["k"], ["v"], ["d"])


def test_delete_insert_keeps_batch_duplicates(spark):
    got = incremental.delete_inserted(frame(spark, BASE), frame(spark, [(1, "x", 5.0), (1, "x", 5.0)]), ["k"])
    assert rows(got) == [(1, "x", 5.0), (1, "x", 5.0), (2, "a", 2.0), (3, "b", 3.0)]


def test_microbatch_period(spark):
    t = Table(spark, scratch_path(spark, "t"), ["d"])
    day = lambda s: dt.date.fromisoformat(s)
    schema = "k int, d date"
    t.replace(spark.createDataFrame([(1, day("2024-01-01")), (2, day("2024-01-02")), (3, day("2024-01-03"))], schema))
    batch = spark.createDataFrame([(9, day("2024-01-02"))], schema)
    for _ in range(2):
        incremental.load(t, batch, "microbatch", event_time="d", period=(day("2024-01-02"), day("2024-01-04")))
    assert rows(t.read().select("k")) == [(1,), (9,)]
    with pytest.raises(ValueError):
        incremental.load(t, batch, "microbatch")


def test_high_water(spark):
    empty, some = frame(spark, []), frame(spark, BASE)
    assert incremental.above_mark(some, empty, "k").count() == 3
    assert incremental.above_mark(some, empty, "k", strict=True).count() == 0
    assert rows(incremental.above_mark(some, frame(spark, BASE[:2]), "k")) == BASE[2:]


def test_high_water_per_key(spark):
    new = frame(spark, [(1, "a", 1.0), (5, "a", 5.0), (1, "n", 1.0)])
    target = frame(spark, [(3, "a", 0.0)])
    assert rows(incremental.above_own_mark(new, target, ["d"], "k")) == [(1, "n", 1.0), (5, "a", 5.0)]
    assert rows(incremental.above_own_mark(new, target, ["d"], "k", strict=True)) == [(5, "a", 5.0)]


def test_unknown_strategy(spark):
    t = table(spark, BASE)
    with pytest.raises(ValueError):
        incremental.load(t, frame(spark, BASE), "guess", ["k"])
    assert incremental.default_strategy(False) == "append"


def test_drift_fail_and_ignore(spark):
    t = table(spark, BASE)
    wider = frame(spark, BASE).withColumn("w", F.lit(1))
    with pytest.raises(drift.SchemaChanged):
        incremental.load(t, wider, "append", on_schema_change="fail")
    incremental.load(t, wider, "append", on_schema_change="ignore")
    assert t.read().columns == ["k", "d", "v"] and t.read().count() == 6
    with pytest.raises(drift.SchemaChanged):
        incremental.load(t, frame(spark, BASE).drop("v"), "append", on_schema_change="ignore")


def test_drift_append_needs_no_rewrite(spark):
    t = table(spark, BASE)
    before = list(t.manifest()["loads"])
    incremental.load(t, frame(spark, [(9, "z", 9.0)]).withColumn("w", F.lit(1)).drop("v"), "append", on_schema_change="append_new_columns")
    assert list(t.manifest()["loads"])[:1] == before and len(t.manifest()["loads"]) == 2
    assert rows(t.read())[-1] == (9, "z", None, 1) and rows(t.read())[0] == (1, "a", 1.0, None)


# ---- history ----------------------------------------------------------------

S1 = [(1, "a", 5), (2, "b", None), (3, "c", 7), (4, "d", 8)]
S2 = [(1, "a", 6), (2, "b", 2), (3, "c", None), (5, "e", 9)]
D1, D2, D3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def src(spark, data):
    return spark.createDataFrame(data, "id int, name string, cmc_rank int")


def spans(df):
    day = lambda t: t.day if t else None
    return sorted(((r.id, r.cmc_rank, day(r.dbt_valid_from), day(r.dbt_valid_to)) for r in df.collect()), key=str)


def hist(spark, mode="ignore"):
    return snapshot.first_snapshot(src(spark, S1), ["id"], F.lit(D1), hard_deletes=mode)


def step(h, s, now, mode="ignore", **k):
    return snapshot.snapshot(h, s, ["id"], now, check_cols=["cmc_rank"], hard_deletes=mode, **k)


def test_check_is_null_aware(spark):
    got = spans(step(hist(spark), src(spark, S2), D2))
    assert (2, None, 1, 2) in got and (2, 2, 2, None) in got
    assert (3, 7, 1, 2) in got and (3, None, 2, None) in got
    assert (4, 8, 1, None) in got and (5, 9, 2, None) in got
    assert len(got) == 8


def test_replay_changes_nothing(spark):
    once = step(hist(spark), src(spark, S2), D2)
    assert spans(step(once, src(spark, S2), D3)) == spans(once)


def test_two_changes_keep_one_open_row(spark):
    h = step(step(hist(spark), src(spark, S2), D2), src(spark, S1), D3)
    assert [x for x in spans(h) if x[0] == 1] == [(1, 5, 1, 2), (1, 5, 3, None), (1, 6, 2, 3)]
    assert h.filter(snapshot.is_open()).groupBy("id").count().filter("count > 1").count() == 0
    assert h.select("dbt_scd_id").distinct().count() == h.count()


def test_invalidate_then_back(spark):
    h = step(hist(spark), src(spark, S2), D2, "invalidate")
    assert (4, 8, 1, 2) in spans(h)
    assert (4, 8, 3, None) in spans(step(h, src(spark, S1), D3, "invalidate"))


def test_deleted_record_and_back(spark):
    h = step(hist(spark, "new_record"), src(spark, S2), D2, "new_record")
    gone = [(r.dbt_valid_to is None, r.dbt_is_deleted) for r in h.filter("id = 4").collect()]
    assert sorted(gone) == [(False, "False"), (True, "True")]
    again = step(h, src(spark, S2), D3, "new_record")
    assert spans(again) == spans(h)  # a tombstone is written once
    back = step(h, src(spark, S1), D3, "new_record").filter("id = 4")
    assert sorted((r.dbt_valid_to is None, r.dbt_is_deleted) for r in back.collect()) == [(False, "False"), (False, "True"), (True, "False")]


def test_new_check_column_changes_every_row(spark):
    s = src(spark, S1).withColumn("w", F.lit(1))
    got = snapshot.snapshot(hist(spark), s, ["id"], D2, check_cols=["cmc_rank", "w"])
    assert got.count() == 8 and got.filter(snapshot.is_open()).count() == 4


def test_column_gone_from_source(spark):
    got = step(hist(spark), src(spark, S1).drop("name"), D2)
    assert got.count() == 4 and got.filter("name is null").count() == 0


def test_snapshot_needs_one_strategy(spark):
    with pytest.raises(ValueError):
        snapshot.snapshot(hist(spark), src(spark, S1), ["id"], D2)


# ---- checks and fixtures ----------------------------------------------------


def test_contract(spark):
    df = frame(spark, BASE)
    with pytest.raises(quality.ContractBroken):
        quality.contract(df, T.StructType([T.StructField("k", T.LongType()), T.StructField("d", T.StringType())]))
    assert quality.contract(df, df.schema) is df


def test_severity_limit(spark):
    r = quality.severity(frame(spark, BASE), quality.Severity("failures > 1", "failures > 2", 2)).collect()[0]
    assert (r.failures, r.should_warn, r.should_error) == (2, True, False)


def test_accepted_values_ignores_null(spark):
    df = spark.createDataFrame([("USDT",), (None,), ("UNKNOWN",)], "q string")
    assert rows(quality.accepted_values(df, "q", ["USDT"])) == [("UNKNOWN", 1)]


def test_literal_rows(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert rows(G.literal_rows(spark, [{"a": 1}], schema)) == [(1, None)]
    assert G.literal_rows(spark, [], schema).schema == schema
    with pytest.raises(ValueError):
        G.literal_rows(spark, [{"c": 1}], schema)


def test_date_spine_end(spark):
    b = spark.sql("SELECT date'2024-01-30' AS start, date'2024-02-02' AS end")
    assert G.date_spine(b, "day").count() == 3 and G.date_spine(b, "day", inclusive=True).count() == 4
    with pytest.raises(ValueError):
        G.generate_series(spark, 0)


def test_long_date_spine_is_not_one_row(spark):
    b = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS start, timestamp'2025-01-01 00:00:00' AS end")
    assert G.date_spine(b, "minute").count() == 366 * 1440
    months = G.date_spine(spark.sql("SELECT date'2024-01-31' AS start, date'2024-05-01' AS end"), "month")
    assert [str(r.date_month)[:10] for r in months.collect()] == ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]
    assert G.date_spine(spark.sql("SELECT CAST(NULL AS DATE) AS start, date'2024-01-01' AS end"), "day").count() == 0


def test_seed_override_keeps_the_text(spark, tmp_path):
    (tmp_path / "s.csv").write_text("code,n,v\n007,1,1.5\n010,2,\n")
    got = files.seed_csv(spark, str(tmp_path / "s.csv"), {"CODE": "string", "n": "bigint"})
    assert rows(got) == [("007", 1, 1.5), ("010", 2, None)] and got.dtypes == [("code", "string"), ("n", "bigint"), ("v", "double")]
    with pytest.raises(ValueError):
        files.seed_csv(spark, str(tmp_path / "s.csv"), {"none": "string"})


@pytest.mark.parametrize("values", [[], [5.0], [1.0, 2.0], [3.0] * 50 + [1.0, 9.0], [float(x * 7 % 101) for x in range(101)], [None, 4.0, None, 8.0]])
def test_quantiles(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    points = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    known = [v for v in values if v is not None]
    want = [float(np.quantile(known, p)) for p in points] if known else [None] * len(points)
    got = aggregates.quantiles(df, "v", points)
    assert got == want or np.allclose(got, want, rtol=1e-12)


def test_snapshot_forms(spark):
    s1 = spark.createDataFrame([(1, "a", 5, "x"), (2, "b", 6, "y")], "id int, name string, rank int, seen string")
    s2 = spark.createDataFrame([(1, "a", 5, "z"), (2, "B", 6, "z")], "id int, name string, rank int, seen string")
    first = snapshot.first_snapshot(s1, ["id"], F.lit(D1))
    everything = snapshot.snapshot(first, s2, ["id"], D2, check_cols="all")
    assert everything.filter(snapshot.is_open()).filter(F.col("dbt_valid_from") == F.lit(D2).cast("timestamp_ntz")).count() == 2
    with pytest.raises(ValueError):
        snapshot.snapshot(first, s2, ["id"], D2, check_cols="some")
    stamped = s2.withColumn("seen", F.lit("2024-01-01 06:00:00"))
    one = snapshot.snapshot(first, stamped, ["id"], D2, check_cols=["name"], updated_at="seen")
    assert [(r.id, r.dbt_valid_from.hour) for r in one.filter("dbt_valid_from > timestamp_ntz'2024-01-01 00:00:00'").collect()] == [(2, 6)]
    names = {"dbt_valid_from": "a", "dbt_valid_to": "b", "dbt_is_deleted": "gone"}
    own = snapshot.first_snapshot(s1, ["id"], F.lit(D1), hard_deletes="new_record", names=names)
    own = snapshot.snapshot(own, s2.filter("id = 1"), ["id"], D2, check_cols=["name"], hard_deletes="new_record", names=names)
    assert {"a", "b", "gone"} <= set(own.columns) and not {"dbt_valid_to", "dbt_is_deleted"} & set(own.columns)
    assert own.filter(snapshot.is_open(valid_to="b")).count() == 2 and own.filter("gone = 'True'").count() == 1
    with pytest.raises(ValueError):
        snapshot.first_snapshot(s1, ["id"], F.lit(D1), names={"nope": "x"})


def test_fail_calc_and_view(spark):
    failing = spark.createDataFrame([(3,), (4,)], "n int")
    one = lambda rule, df=failing: quality.severity(df, rule).collect()[0].failures
    assert one(quality.Severity()) == 2 and one(quality.Severity(fail_calc="sum(n)")) == 7
    assert one(quality.Severity(fail_calc="sum(n)"), failing.limit(0)) == 0
    assert quality.failures_view(failing, "bad_rows").count() == spark.table("bad_rows").count() == 2


def test_freshness_of_a_query(spark):
    df = spark.createDataFrame([(1,), (5,)], "t int")
    assert aggregates.freshness_of_query(spark, "SELECT max(t) FROM {x}", x=df).collect()[0].max_loaded_at == 5
    with pytest.raises(ValueError):
        aggregates.freshness_of_query(spark, "SELECT 1, 2")
