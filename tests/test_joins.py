"""Lookups give the same rows broadcast and salted; NOT IN follows the NULL rules."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from candlewick.operators import joins


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_broadcast(spark, how):
    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 17).alias("k"))
    facts = facts.unionByName(spark.createDataFrame([(9999, None)], "id bigint, k bigint"))
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (5, "d"), (None, "z")], "k bigint, v string")
    small = joins.lookup_join(facts, dim, ["k"], how)
    large = joins.lookup_join(facts, dim, ["k"], how, broadcast_rows=2, salts=7)
    assert rows(small.select("id", "k", "v")) == rows(large.select("id", "k", "v"))
    assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in large._jdf.queryExecution().analyzed().toString()


def test_as_of_version_both_ways(spark):
    versions = spark.createDataFrame(
        [("A", 1, "2024-01-01", "2024-02-01"), ("A", 2, "2024-02-01", None), ("B", 3, "2024-01-10", None)],
        "symbol string, v int, valid_from string, valid_to string",
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})
    facts = spark.createDataFrame(
        [(1, "A", "2023-12-31"), (2, "A", "2024-01-01"), (3, "A", "2024-02-01"), (4, "B", "2024-01-09"), (5, "B", "2024-05-01"), (6, "C", "2024-05-01")],
        "id int, symbol string, at string",
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    want = [(1, None), (2, 1), (3, 2), (4, None), (5, 3), (6, None)]
    for limit in (100, 1):
        got = joins.as_of_version(facts, versions, "symbol", "at", broadcast_rows=limit)
        assert rows(got.select("id", "v")) == want


def test_not_in_follows_sql(spark):
    left = [(a, b) for a in (1, 2, None) for b in ("x", "y", None)]
    for right in ([], [(1, "x")], [(1, None)], [(None, "y")], [(1, "x"), (None, "y"), (2, None)], [(None, None)]):
        l = spark.createDataFrame(left, "a int, b string")
        r = spark.createDataFrame(right, "a int, b string")
        db = duckdb.connect()
        db.execute("CREATE TABLE l(a INT, b VARCHAR)")
        db.execute("CREATE TABLE r(a INT, b VARCHAR)")
        db.executemany("INSERT INTO l VALUES (?, ?)", left)
        for row in right:
            db.execute("INSERT INTO r VALUES (?, ?)", row)
        # spelled out, because engines differ in how they treat row values
        want = db.execute(
            """SELECT a, b FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE (r.a = l.a OR r.a IS NULL OR l.a IS NULL)
            AND (r.b = l.b OR r.b IS NULL OR l.b IS NULL))"""
        ).fetchall()
        assert rows(joins.not_in(l, r, ["a", "b"])) == sorted(want, key=str), right


def test_against_group_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 10.0), ("b", 2.0), ("b", None)], "g string, v double")
    assert rows(joins.against_group_mean(df, ["g"], "v", 2).select("g", "v")) == [("a", 10.0)]


def test_small_enough_counts_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.small_enough(df) and not joins.small_enough(df, rows=99)
    assert not joins.small_enough(df, size=100_000) and joins.small_enough(df, size=110_000)


def test_fixed_lookup_refuses_a_large_side(spark, monkeypatch):
    days, facts = spark.range(1000).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
    assert joins.fixed_lookup(facts, days, "k").count() == 10
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    with pytest.raises(ValueError, match="too large"):
        joins.fixed_lookup(facts, days, "k")


def as_of_plain(facts, versions):
    out = []
    for i, k, at in facts:
        hit = [v for vk, f, t, v in versions if k is not None and at is not None and vk == k and f is not None and f <= at and (t is None or at < t)]
        assert len(hit) < 2
        out.append((i, k, at, hit[0] if hit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("seed", "block_rows"), [(1, 10**6), (2, 120), (3, 15), (4, 1)])
def test_as_of_merge(spark, seed, block_rows):
    """Ties, gaps, open ends, no version at all, and a key with most facts, in blocks of all sizes."""
    rng = random.Random(seed)
    day = dt.datetime(2024, 1, 1)
    moment = lambda: day + dt.timedelta(minutes=rng.randrange(0, 200_000, 30))
    versions = []
    for k in ("a", "b", "c"):
        cuts = sorted({moment() for _ in range(12)})
        for n, (f, t) in enumerate(zip(cuts, [*cuts[1:], None])):
            if rng.random() < 0.8:  # else a gap
                versions.append((k, f, t, f"{k}{n}"))
        versions.append((k, cuts[3], cuts[3], "never"))
    versions += [(None, day, None, "no key"), ("a", None, day, "no start")]
    edges = [v[1] for v in versions if v[1]]
    facts = [(i, rng.choice(["a", "a", "a", "a", "b", "c", "d", None]), rng.choice([moment(), rng.choice(edges), None])) for i in range(400)]
    f = spark.createDataFrame(facts, "i int, k string, at timestamp_ntz")
    v = spark.createDataFrame(versions, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    got = joins.as_of_merge(f.repartition(3), v, "k", "at", block_rows=block_rows)
    assert got.columns == ["i", "k", "at", "valid_from", "valid_to", "v"]
    assert sorted(map(tuple, got.drop("valid_from", "valid_to").collect()), key=repr) == as_of_plain(facts, versions)
    small = joins.as_of_version(f, v, "k", "at", small=True)
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, got.collect()), key=repr)


def test_as_of_merge_copies_nothing(spark):
    """No row generator and no join in the plan; versions as dates compare with moments."""
    f = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 2, 5)), (2, "a", dt.datetime(2023, 1, 1))], "i int, k string, at timestamp_ntz")
    v = spark.createDataFrame([("a", dt.date(2024, 1, 1), None, "x")], "k string, valid_from date, valid_to date, v string")
    got = joins.as_of_version(f, v, "k", "at", small=False)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    assert {(r.i, r.v) for r in got.collect()} == {(1, "x"), (2, None)}
    assert joins.as_of_version(f.limit(0), v, "k", "at", small=False).collect() == []
