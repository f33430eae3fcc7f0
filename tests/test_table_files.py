"""Merges that touch only the files that hold a key, histories in two parts, compaction and landing."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.session import scratch_path
from candlewick.streaming import klines
from candlewick.tables import compaction, file_index, incremental, snapshot
from candlewick.tables.store import Table

SCHEMA = "k int, n string, v double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def keyed(spark, data, key=("k", "n")):
    t = Table(spark, scratch_path(spark, "keyed"), key=key)
    t.replace(frame(spark, data).repartitionByRange(8, "k"))
    return t


BASE = [(i, f"n{i % 3}", float(i)) for i in range(2000)] + [(None, "n1", -1.0), (5, None, -2.0), (None, None, -3.0)]


def files_of(spark, t, where):
    name = F.regexp_extract(F.input_file_name(), r"(_load=.*)$", 1)
    root = f"{t.path}/data"
    df = spark.read.schema(t.schema()).option("basePath", root).parquet(*[f"{root}/{f}" for f in t.files()])
    return {r[0] for r in df.select("*", name.alias("f")).where(where).select("f").distinct().collect()}


@pytest.mark.parametrize("strategy", ["merge", "delete_insert"])
def test_untouched_files_stay(spark, strategy):
    t = keyed(spark, BASE)
    before = t.files()
    assert len(before) > 2
    batch = frame(spark, [(3, "n0", 0.5), (5, "n2", 0.25), (5, None, 7.0), (None, "n1", 8.0), (1995, "n1", 9.0), (9999, "n0", 1.0), (4, "n0", 2.0)])
    held = files_of(spark, t, "(k = 3 and n = 'n0') or (k = 5 and n = 'n2')")
    assert set(t.files_with(batch)) == held
    whole = Table(spark, scratch_path(spark, "whole"))
    whole.replace(frame(spark, BASE))
    for table in (t, whole):
        incremental.load(table, batch, strategy, ["k", "n"])
    assert set(before) - set(t.files()) == held
    assert rows(t.read()) == rows(whole.read())


def test_batch_of_new_keys_touches_nothing(spark):
    t = keyed(spark, BASE)
    before = set(t.files())
    incremental.load(t, frame(spark, [(50_000, "a", 1.0), (None, "n1", 2.0)]), "merge", ["k", "n"])
    assert before < set(t.files()) and t.read().count() == len(BASE) + 2
    incremental.load(t, frame(spark, []), "merge", ["k", "n"])
    assert t.read().count() == len(BASE) + 2


def test_merges_of_columns_and_with_a_predicate(spark):
    t, whole = keyed(spark, BASE), Table(spark, scratch_path(spark, "whole"))
    whole.replace(frame(spark, BASE))
    batch = frame(spark, [(i, f"n{i % 3}", 0.5) for i in range(1000, 1010)] + [(7777, "x", 1.0)])
    for table in (t, whole):
        incremental.load(table, batch, "merge", ["k", "n"], update_columns=["v"])
        incremental.load(table, batch, "merge", ["k", "n"], predicate=F.col("k") > 1004)
    assert rows(t.read()) == rows(whole.read())


def test_many_merges_in_a_row(spark):
    """Random merges through files equal a plain dictionary."""
    rng = random.Random(4)
    t, want = keyed(spark, BASE[:300]), {(k, n): v for k, n, v in BASE[:300]}
    for turn in range(6):
        batch = {(rng.randrange(500), f"n{rng.randrange(3)}"): float(turn) for _ in range(20)}
        incremental.load(t, frame(spark, [(k, n, v) for (k, n), v in batch.items()]), "merge", ["k", "n"])
        want |= batch
    assert rows(t.read()) == sorted([(k, n, v) for (k, n), v in want.items()], key=repr)


def test_loads_without_a_key_are_looked_through(spark):
    t = Table(spark, scratch_path(spark, "late-key"))
    t.replace(frame(spark, BASE))
    t = Table(spark, t.path, key=["k"])
    t.append(frame(spark, [(90_000, "a", 1.0)]))
    assert len(t.files_with(frame(spark, [(90_000, None, 0.0)]))) == 1
    assert set(t.files_with(frame(spark, [(3, None, 0.0)]))) == files_of(spark, t, "k = 3")


def test_key_types_and_partitions(spark):
    """A batch with other types finds the same keys; partition values with signs that paths escape do, too."""
    t = Table(spark, scratch_path(spark, "kinds"), ["n"], key=["k"])
    odd = ["a b", "c:d", "é%2B+", "x/y=z", None]
    t.replace(frame(spark, [(i, odd[i % 5], 0.0) for i in range(50)]))
    assert len(t.files()) >= 5
    for k in range(5):
        batch = spark.createDataFrame([(k,)], "k bigint")
        assert t.files_with(batch) == sorted(files_of(spark, t, f"k = {k}")) or len(t.files_with(batch)) == 1
    incremental.load(t, frame(spark, [(i, odd[i % 5], 1.0) for i in range(3)]), "merge", ["k"])
    assert rows(t.read().select("k", "v")) == sorted([(i, 1.0 if i < 3 else 0.0) for i in range(50)], key=repr)


def test_large_batches_go_without_filters(spark, monkeypatch):
    monkeypatch.setattr(file_index.few_hashes, "__defaults__", (3,))
    t = keyed(spark, BASE)
    batch = frame(spark, [(i, f"n{i % 3}", 0.0) for i in range(0, 40)])
    assert set(t.files_with(batch)) == files_of(spark, t, "k < 40 and n is not null")


def test_unseen_reads_files_with_keys_only(spark, monkeypatch):
    t, read = keyed(spark, BASE), []
    whole = Table.of_files
    monkeypatch.setattr(Table, "of_files", lambda self, files: read.extend(files) or whole(self, files))
    batch = frame(spark, [(3, "n0", 0.5), (3, "n9", 0.5), (None, "n1", 1.0)])
    assert rows(incremental.unseen(batch, t, ["k", "n"])) == sorted([(3, "n9", 0.5), (None, "n1", 1.0)], key=repr)
    assert set(read) == files_of(spark, t, "k = 3 and n = 'n0'") and len(t.files()) > len(read)


def test_no_false_negative(spark):
    """Every key of a file passes its filter; few others do."""
    df = spark.range(30_000).select(F.col("id").alias("k"), F.lit("one").alias(file_index.FILE))
    sizes = file_index.bounds(df, ["k"])
    stored = file_index.filters(df, sizes, ["k"]).cache()
    own = df.select(F.xxhash64("k")).toPandas().iloc[:, 0].to_numpy(np.int64)
    others = spark.range(10**6, 10**6 + 2000).select(F.xxhash64("id")).toPandas().iloc[:, 0].to_numpy(np.int64)
    assert all(file_index.hit(stored, own[i:i + 1]).count() == 1 for i in range(0, 30_000, 4999))
    assert stored.select("buckets").distinct().collect()[0][0] == 16
    bits = {r.bucket: np.frombuffer(r.bits, np.uint8) for r in stored.collect()}
    passed = lambda h: [all(bits[b][int(p) >> 3] >> (int(p) & 7) & 1 for p in ps) for b, ps in zip(h % 16, file_index.probe_places(h))]
    assert all(passed(own)) and sum(passed(others)) < 20


# ---- history ----------------------------------------------------------------


def source(spark, values):
    return spark.createDataFrame(values, "id int, name string")


@pytest.mark.parametrize("deletes", ["ignore", "invalidate", "new_record"])
def test_closed_history_is_not_written_again(spark, deletes):
    h = snapshot.History(spark, scratch_path(spark, "history"), ["id"], hard_deletes=deletes, check_cols=["name"])
    first = source(spark, [(1, "a"), (2, "b"), (3, "c")])
    h.start(first, F.lit("2024-01-01"))
    plain = snapshot.first_snapshot(first, ["id"], F.lit("2024-01-01"), hard_deletes=deletes)
    turns = [[(1, "A"), (2, "b"), (4, "d")], [(1, "AA"), (2, "b"), (3, "c")], [(2, "B"), (4, "d")], [(2, "B"), (4, "d")]]
    for day, values in enumerate(turns, 2):
        closed = {f for f in h.table.files() if "_part=closed" in f}
        h.run(source(spark, values), f"2024-01-0{day}")
        plain = snapshot.snapshot(plain, source(spark, values), ["id"], f"2024-01-0{day}", check_cols=["name"], hard_deletes=deletes)
        assert closed <= set(h.table.files())
        assert rows(h.read().select(*plain.columns)) == rows(plain)
    before = rows(h.read())
    h.run(source(spark, turns[-1]), "2024-01-05")  # a replay
    assert rows(h.read()) == before
    assert all(r.dbt_valid_to is None for r in h.open_rows().collect())


def test_history_takes_new_columns(spark):
    h = snapshot.History(spark, scratch_path(spark, "history"), ["id"], check_cols=["name"], names={"dbt_valid_to": "ends"})
    h.start(source(spark, [(1, "a"), (2, "b")]), F.lit("2024-01-01"))
    h.run(source(spark, [(1, "A"), (2, "b")]), "2024-01-02")
    h.run(source(spark, [(1, "A"), (2, "c")]).withColumn("size", F.lit("x")), "2024-01-03")
    got = {(r.id, r.name): (r.size, r.ends is None) for r in h.read().collect()}
    assert got == {(1, "a"): (None, False), (1, "A"): (None, True), (2, "b"): (None, False), (2, "c"): ("x", True)}


# ---- compaction and landing -------------------------------------------------


def test_a_thousand_appends_leave_few_files():
    """The rule alone: files of equal size come one by one and are packed when enough have come together."""
    sizes, written = {}, 0
    for i in range(1000):
        sizes[f"_load={i}/part"] = 1000
        written += 1000
        while chosen := compaction.small_files(sizes, target=1 << 20, fan_in=8):
            total = sum(sizes.pop(f) for f in chosen)
            sizes[f"_load=c{i}/{len(sizes)}"] = total
            written += total
        assert len(sizes) <= 7 * 8
    assert sum(sizes.values()) == 1_000_000 and written < 6_000_000


def test_compaction_beside_readers(spark):
    t = Table(spark, scratch_path(spark, "packed"), kept_versions=3, key=["k"])
    most = 0
    for i in range(20):
        compaction.append(t, frame(spark, [(i, "a", 0.0), (None, "b", float(i))]).coalesce(1), fan_in=4)
        most = max(most, len(t.files()))
    assert most <= 14 and rows(t.read()) == rows(frame(spark, [r for i in range(20) for r in [(i, "a", 0.0), (None, "b", float(i))]]))
    t.append(frame(spark, [(99, "z", 0.0)]))
    old, number = t.read(), t.versions()[-1]
    packed = compaction.compact(t, fan_in=2)
    assert packed >= 2 and rows(old) == rows(t.read()) == rows(t.read(number))
    assert len(t.files_with(frame(spark, [(7, None, 0.0)]))) == 1
    assert compaction.compact(t, fan_in=2) == 0 or len(t.files()) < packed


def test_compaction_inside_partitions(spark):
    t = Table(spark, scratch_path(spark, "packed"), ["n"])
    for i in range(6):
        compaction.append(t, frame(spark, [(i, "a", 0.0), (i, "b", 0.0)]), fan_in=100)
    assert compaction.compact(t, fan_in=4) == 12
    assert len(t.files()) == 2 and t.read().count() == 12 and t.only({("a",)}).count() == 6


class Crash(Exception):
    pass


def landing(spark, path, now, **limits):
    return compaction.Landing(Table(spark, f"{path}/target"), Table(spark, f"{path}/waiting"), clock=lambda: now[0], **limits)


def test_landing_flushes_by_rows_bytes_and_age(spark):
    for limits, batches in (({"rows": 5}, 3), ({"size": 2500}, 3), ({"seconds": 50}, 3)):
        now, path = [1000.0], scratch_path(spark, "landing")
        land = landing(spark, path, now, **({"rows": 10**9, "size": 10**9, "seconds": 10**9} | limits))
        flushed = []
        for i in range(batches):
            flushed.append(land.take(frame(spark, [(i, "a", 0.0), (i, "b", 1.0)]).coalesce(1), i))
            now[0] += 30
        assert flushed == [False, False, True]
        assert land.target.read().count() == 6 and land.waiting.read().count() == 0 and len(land.target.files()) <= 3


@pytest.mark.parametrize("step", ["append", "replace", "empty"])
@pytest.mark.parametrize("after", [False, True])
def test_landing_survives_failures(spark, monkeypatch, step, after):
    """A failure before or after any write: the batch comes again, and every row is there once."""
    now, path, want = [0.0], scratch_path(spark, "landing"), []
    real, left = getattr(Table, step), [2]

    def failing(self, *args, **kwargs):
        left[0] -= 1
        if left[0]:
            return real(self, *args, **kwargs)
        if after:
            real(self, *args, **kwargs)
        raise Crash

    monkeypatch.setattr(Table, step, failing)
    for i in range(6):
        batch = [(i, "a", 0.0), (i, "b", 1.0)]
        want += batch
        for _ in range(3):
            try:
                landing(spark, path, now, rows=4).take(frame(spark, batch).coalesce(1), i)
                break
            except Crash:
                continue
    last = landing(spark, path, now, rows=4)
    last.flush()
    assert rows(last.target.read()) == rows(frame(spark, want))


def test_stream_lands_in_few_files(spark):
    path = scratch_path(spark, "messages")
    for i in range(6):
        spark.createDataFrame([(f"m{i}-{j}",) for j in range(10)], "value string").coalesce(1).write.mode("append").parquet(path)
    messages = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(path)
    at = scratch_path(spark, "landing")
    land = landing(spark, at, [0.0], rows=30)
    klines.finish(klines.land(messages, land, scratch_path(spark, "checkpoint")))
    land.flush()
    assert land.target.read().distinct().count() == land.target.read().count() == 60 and len(land.target.files()) <= 4
