"""Topic files as a stream, scans in bands, quantiles by refinement, maintained aggregates, correlated pairs."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.operators import aggregates
from candlewick.plans import indicators
from candlewick.session import scratch_path, stage
from candlewick.streaming import klines, topic
from candlewick.tables import incremental
from candlewick.tables.maintained import Maintained, changed_groups

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


# ---- topic ------------------------------------------------------------------


def fill(path, partition, n, tag):
    topic.append_segment(path, partition, [(f"{tag}-{partition}-{i}", T0) for i in range(n)])


class Crash(Exception):
    pass


def consume(spark, path, out, checkpoint, sizes, start="earliest", most=None, positions=None, seconds=60, want=None, crash_at=None):
    """Runs a query until the folder has `want` rows, or it fails."""
    import time

    def apply(batch, number):
        n = batch.count()
        if n:
            sizes.append(n)
        if crash_at is not None and number == crash_at:
            raise Crash
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = klines.each_batch(topic.read_topic_files(spark, path, start, most, positions), apply, checkpoint, trigger={"processingTime": "0 seconds"})
    until = time.time() + seconds
    try:
        while time.time() < until and query.isActive and not (want is not None and sum(sizes) >= want and not query.status["isTriggerActive"]):
            time.sleep(0.2)
        if not query.isActive and query.exception():
            return query.exception()
    finally:
        query.stop()


def taken(spark, out):
    return sorted(r.value for r in spark.read.option("basePath", out).parquet(f"{out}/*").collect())


def test_topic_with_a_limit_and_a_failure(spark):
    path, out, chk, pos = (scratch_path(spark, n).removeprefix("file:") for n in ("topic", "out", "chk", "pos"))
    for k in (0, 1):
        fill(path, k, 9, "a")
        fill(path, k, 4, "b")
    sizes = []
    assert consume(spark, path, out, chk, sizes, most=6, positions=pos, crash_at=2) is not None
    assert max(sizes) <= 6
    fill(path, 2, 5, "late partition")
    again = []
    consume(spark, path, out, chk, again, most=6, positions=pos, want=31 - sum(sizes[:-1]))
    assert max(again) <= 6
    got = taken(spark, out)
    assert len(got) == len(set(got)) == 31


def test_topic_from_the_end_and_from_offsets(spark):
    path = scratch_path(spark, "topic").removeprefix("file:")
    fill(path, 0, 5, "old")
    fill(path, 1, 5, "old")
    reader = lambda **o: topic.TopicReader({"path": path} | {k.lower(): v for k, v in o.items()})
    latest = reader()
    assert latest.initialOffset() == latest.latestOffset() == {"0": 5, "1": 5}
    assert reader(startingOffsets="earliest").initialOffset() == {"0": 0, "1": 0}
    chosen = reader(startingOffsets='{"0": 3}')
    ranges = chosen.partitions(chosen.initialOffset(), {"0": 5, "1": 2})
    assert [(r.partition, r.first, r.end) for r in ranges] == [("0", 3, 5), ("1", 0, 2)]
    assert [(v, o, p) for v, o, p, _ in chosen.read(ranges[0])] == [("old-0-3", 3, 0), ("old-0-4", 4, 0)]
    assert chosen.partitions({"0": 5}, {"0": 5}) == []
    with pytest.raises(ValueError, match="folder for planned"):
        reader(maxOffsetsPerTrigger="5")


def test_planned_offsets_survive_a_restart(spark):
    path, pos = (scratch_path(spark, n).removeprefix("file:") for n in ("topic", "pos"))
    fill(path, 0, 10, "a")
    options = {"path": path, "startingoffsets": "earliest", "maxoffsetspertrigger": "4", "positions": pos}
    first = topic.TopicReader(options)
    assert [first.initialOffset(), first.latestOffset(), first.latestOffset()] == [{"0": 0}, {"0": 4}, {"0": 8}]
    restarted = topic.TopicReader(options)  # the last planned end comes first: Spark may not have taken it in
    assert [restarted.latestOffset(), restarted.latestOffset(), restarted.latestOffset()] == [{"0": 8}, {"0": 10}, {"0": 10}]


# ---- bands ------------------------------------------------------------------


def test_a_stale_key_does_not_widen_the_scan(spark):
    """Files by day: the newest keys read the last days only, the stale one its own rows alone."""
    start, path = dt.date(2019, 1, 1), scratch_path(spark, "days")
    rows = [(f"k{k}", start + dt.timedelta(days=d), k * 10_000 + d) for k in range(5) for d in range(0, 1800, 10)]
    df = spark.createDataFrame(rows, "pair string, day date, v int")
    df.repartitionByRange(6, "pair", "day").sortWithinPartitions("pair", "day").write.partitionBy("pair").parquet(path)
    source = spark.read.schema("day date, v int, pair string").parquet(path)
    marks = [("k0", start + dt.timedelta(days=10))] + [(f"k{k}", start + dt.timedelta(days=1780 - k)) for k in range(1, 4)]
    target = spark.createDataFrame([(p, m, 0) for p, m in marks], "pair string, day date, v int")
    got = incremental.above_own_mark(source, target, ["pair"], "day")
    want = {(p, d, v) for p, d, v in rows if d > dict(marks).get(p, dt.date.min)}
    assert {(r.pair, r.day, r.v) for r in got.collect()} == want
    stale = incremental.in_bands(source, stage(target.select("pair", F.col("day").alias("m")), "m"), ["pair"], "day", "m")
    plan = stale._jdf.queryExecution().executedPlan().toString()
    old_scans = [s for s in plan.split("FileScan")[1:] if "2019-01-11" in s.split("ReadSchema")[0]]
    assert len(old_scans) == 1 and "k0" in old_scans[0] and "k1" not in old_scans[0].split("ReadSchema")[0]
    scans = [s.split("ReadSchema")[0] for s in plan.split("FileScan")[1:] if "PartitionFilters: [pair" in s or "pair#" in s.split("ReadSchema")[0]]
    assert len(scans) >= 2 and not any("k4" in s for s in scans)


@pytest.mark.parametrize("inclusive", [False, True])
def test_bands_by_numbers_and_null_keys(spark, inclusive):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "c", "d", None]), rng.randrange(1000)) for _ in range(400)]
    marks = [("a", 3), ("b", 990), ("c", 700), ("c", 400), (None, 5)]
    got = incremental.above_own_mark(spark.createDataFrame(rows, "k string, n int"), spark.createDataFrame(marks, "k string, n int"), ["k"], "n", inclusive=inclusive)
    top = {"a": 3, "b": 990, "c": 700}
    want = [(k, n) for k, n in rows if k not in top or n > top[k] or (inclusive and n == top[k])]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


# ---- quantiles --------------------------------------------------------------


@pytest.mark.parametrize(("bins", "rows"), [(1024, 100_000), (4, 3), (2, 1)])
def test_quantiles_by_key(spark, bins, rows):
    rng = np.random.default_rng(bins)
    data = {"hot": rng.normal(size=600).round(2).tolist(), "ties": [1.0] * 50 + [2.0], "one": [7.5], "wide": [-1e300, 1e300, 0.0, 1e-300, 5.0],
            "skew": (10 ** rng.uniform(-30, 30, 60)).tolist(), None: [3.0, 1.0]}
    pairs = [(k, v) for k, vs in data.items() for v in vs] + [("hot", None), ("none", None), ("hot", float("nan"))]
    points = [0.0, 0.1, 0.33, 0.5, 0.99, 1.0]
    got = aggregates.quantiles_by_key(spark.createDataFrame(pairs, "k string, v double").repartition(3), ["k"], "v", points, bins, rows).collect()
    assert len(got) == len(data) * len(points)
    for r in got:
        vs, at = sorted(data[r.k]), r.point * (len(data[r.k]) - 1)
        low = math.floor(at)
        want = vs[low] + (vs[math.ceil(at)] - vs[low]) * (at - low)
        assert r.value == pytest.approx(want, rel=1e-12)


def test_quantiles_without_keys_or_rows(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert [(r.point, r.value) for r in aggregates.quantiles_by_key(df, [], "v", [0.25]).collect()] == [(0.25, 25.0)]
    assert aggregates.quantiles_by_key(df.filter("v < 0"), [], "v", [0.25]).collect() == []


# ---- maintained aggregates --------------------------------------------------


def test_maintained_states_equal_a_recompute(spark):
    """Random inserts, corrections and deletes, extremes among them; NULL groups and values; batches that come twice."""
    rng, rows, number = random.Random(8), {}, 0
    schema = "id int, g string, h int, v double"
    df = lambda some: spark.createDataFrame([(i, *rows_of) for i, rows_of in some], schema)
    new = lambda: (rng.choice(["a", "b", None]), rng.choice([1, None]), rng.choice([None, float("nan"), round(rng.uniform(-9, 9), 2), 9.5]))
    now = {}
    m = Maintained(scratch_path(spark, "states"), spark, ["g", "h"], ["v"], lambda groups: changed_groups(df(now.items()), groups, ["g", "h"]))
    now |= {i: new() for i in range(30)}
    m.start(df(now.items()), 0)
    for number in range(1, 5):
        gone = rng.sample(sorted(now), 8) if number < 4 else sorted(now)
        went = [(i, now[i]) for i in gone]
        came = [(i, new()) for i in gone[:4]] + [(100 * number + j, new()) for j in range(5)] if number < 4 else []
        for i in gone:
            del now[i]
        now |= dict(came)
        for _ in range(2):
            m.apply(df(came) if came else None, df(went), number)
        want = {}
        for g, h, v in now.values():
            want.setdefault((g, h), []).append(v)
        got = {(r.g, r.h): r for r in m.read().collect()}
        assert got.keys() == want.keys()
        for k, vs in want.items():
            r, known = got[k], [v for v in vs if v is not None and not math.isnan(v)]
            assert (r.n, r.v_n, r.v_least, r.v_greatest) == (len(vs), len(known), min(known, default=None), max(known, default=None))
            assert (float(r.v_sum) if known else r.v_sum) == (pytest.approx(sum(known), abs=1e-9) if known else None)
            assert (r.v_variance is None) == (len(known) < 2)
            if len(known) > 1:
                assert r.v_variance == pytest.approx(np.var(known, ddof=1), abs=1e-9)


def test_only_groups_that_lost_an_extreme_are_read_again(spark):
    read = []
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 1.0), ("b", 5.0)]
    frame = lambda x: spark.createDataFrame(x, "g string, v double")

    def rows_of(groups):
        read.extend(r.g for r in groups.collect())
        return changed_groups(frame([("b", 1.0)]), groups, ["g"])

    m = Maintained(scratch_path(spark, "states"), spark, ["g"], ["v"], rows_of)
    m.start(frame(rows))
    m.apply(went=frame([("a", 2.0)]))
    assert read == []
    m.apply(went=frame([("b", 5.0)]))
    assert read == ["b"] and {(r.g, r.v_least, r.v_greatest) for r in m.read().collect()} == {("a", 1.0, 3.0), ("b", 1.0, 1.0)}


# ---- correlation ------------------------------------------------------------


def test_sketched_pairs_find_nearly_all(spark):
    """Recall against the exact join, on groups of coins that share a factor; no pair below the threshold leaves."""
    rng, days = np.random.default_rng(2), 400
    series = []
    for group in range(6):
        factor = rng.normal(size=days)
        series += [factor + rng.normal(size=days) * rng.uniform(0.2, 0.9) for _ in range(6)]
    start = dt.date(2023, 1, 1)
    rows = [(f"C{i:02d}", start + dt.timedelta(days=d), 1.0, float(math.exp(x / 100))) for i, s in enumerate(series) for d, x in enumerate(s) if rng.random() < 0.97]
    rows += [("FLAT", start + dt.timedelta(days=d), 1.0, 1.0) for d in range(100)] + [("SHORT", start, 1.0, 2.0)]
    df = stage(spark.createDataFrame(rows, "asset_pair_symbol string, open_date date, open double, close double"), "daily")
    exact = {(r.pair_a, r.pair_b): r.correlation for r in indicators.correlated_pairs(df, 0.8, exact=True).collect()}
    found = {(r.pair_a, r.pair_b): r.correlation for r in indicators.correlated_pairs(df, 0.8).collect()}
    assert len(exact) > 20 and len(found.keys() & exact.keys()) >= 0.9 * len(exact)
    assert found.keys() <= exact.keys() and all(found[k] == pytest.approx(exact[k]) for k in found)


def test_bands_meet_the_recall():
    for threshold in (0.5, 0.7, 0.8, 0.9, 0.99):
        width, count = indicators.bands_for(threshold)
        p = 1 - math.acos(threshold) / math.pi
        assert width * count <= indicators.CODE_BITS and 1 - (1 - p**width) ** count >= 0.97
