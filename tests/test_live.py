"""Streams that merge into several tables, merges that touch part of a table, versions that go."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from gamelake.operators import scd
from gamelake.sources import tables
from gamelake.streaming import streams

SCHEMA = "k long, v long, ts timestamp"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def put(spark, src, rows):
    spark.createDataFrame([(k, v, at(m)) for k, v, m in rows], SCHEMA).coalesce(1).write.mode("append").parquet(src)


def test_tables_change_together(spark, tmp_path):
    root, src, ck = str(tmp_path / "t"), str(tmp_path / "in"), tmp_path / "ck"

    def sums(old, batch, _):
        new = batch.groupBy("k").agg(F.sum("v").alias("v"))
        return new if old is None else old.unionByName(new).groupBy("k").agg(F.sum("v").alias("v"))

    def keys(old, batch, number):
        new = scd.scd2_start(batch.select("k"), ["k"], ["k"], "2024-01-01")
        return new if old is None else scd.scd2_merge(old, batch.select("k"), ["k"], ["k"], "2024-01-02")

    def fails(old, batch, number):
        return batch.select(F.raise_error(F.lit("stopped between two writes")).alias("k"))

    def run(second=keys):
        streams.stream_merge_tables(spark.readStream.schema(SCHEMA).parquet(src), root, str(ck), {"sums": sums, "keys": second}, once=True).awaitTermination()

    def seen():
        return {r.k: r.v for r in tables.read_published(spark, root, "sums").collect()}, {r.k for r in tables.read_published(spark, root, "keys").collect()}

    put(spark, src, [(1, 5, 0), (2, 1, 0)])
    run()
    assert seen() == ({1: 5, 2: 1}, {1, 2})
    put(spark, src, [(1, 2, 1), (3, 9, 1)])
    with pytest.raises(Exception, match="stopped between"):
        run(fails)
    assert seen() == ({1: 5, 2: 1}, {1, 2})  # neither table shows the batch
    run()
    assert seen() == ({1: 7, 2: 1, 3: 9}, {1, 2, 3})
    for f in (ck / "commits").glob("*1*"):  # the batch was published, its checkpoint doesn't know
        f.unlink()
    run()
    assert seen() == ({1: 7, 2: 1, 3: 9}, {1, 2, 3})
    assert [r.number for r in tables.published(spark, root).orderBy("number").collect()] == [1, 2]
    before = len(glob.glob(f"{root}/*/v-*"))
    assert tables.drop_old_versions(spark, root, keep=1) == 2 and seen()[1] == {1, 2, 3}
    assert len(glob.glob(f"{root}/*/v-*")) == before - 2  # what the failed batch wrote has no row and stays


def test_query_id_is_needed(spark):
    with pytest.raises(RuntimeError, match="query id"):
        streams._query_id(spark.range(1))


def test_merge_reads_and_writes_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    files = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{path}/{tables.BUCKET}=*/*.parquet")}
    merge = lambda old, new: new if old is None else scd.upsert(old, new, ["k"], [F.col("v").desc()])
    tables.merge_buckets(path, spark.range(200).select(F.col("id").alias("k"), F.lit(0).alias("v")), ["k"], merge, 32)
    before = files()
    touched = tables.merge_buckets(path, spark.createDataFrame([(7, 1), (7, 2), (500, 3), (None, 4)], "k long, v int"), ["k"], merge, 32)
    after = files()
    inside = lambda f: int(f.split(f"{tables.BUCKET}=")[1].split("/")[0]) in touched
    assert len(touched) <= 3 and {f: t for f, t in before.items() if not inside(f)} == {f: t for f, t in after.items() if not inside(f)}
    assert not {f for f in before if inside(f)} & set(after)
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert len(got) == 202 and (got[7], got[500], got[None], got[8]) == (2, 3, 4, 0)
    assert tables.merge_buckets(path, spark.createDataFrame([], "k long, v int"), ["k"], merge, 32) == []
    with pytest.raises(ValueError, match="empty"):
        tables.merge_buckets(path, spark.createDataFrame([(7, 1)], "k long, v int"), ["k"], lambda old, new: new.filter("false"), 32)


def test_scd2_merge_by_bucket_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    for day, rows in (("2024-01-01", [(1, "a"), (2, "a")]), ("2024-01-02", [(1, "b"), (3, "a")]), ("2024-01-02", [(1, "b"), (3, "a")])):
        tables.merge_buckets(path, spark.createDataFrame(rows, "k long, s string"), ["k"], lambda old, new, day=day: scd.scd2_start(new, ["k"], ["s"], day) if old is None else scd.scd2_merge(old, new, ["k"], ["s"], day), 8)
    got = sorted((r.k, r.s, str(r.record_start_date), str(r.record_end_date), r.is_current) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a", "2024-01-01", "2024-01-02", False), (1, "b", "2024-01-02", "None", True), (2, "a", "2024-01-01", "None", True), (3, "a", "2024-01-02", "None", True)]


def test_batches_write_their_own_keys_and_idle_state_goes(spark, tmp_path):
    path, src, ck = str(tmp_path / "t"), str(tmp_path / "in"), str(tmp_path / "ck")
    wrote, states = [], []

    def run():
        totals = streams.session_totals(spark.readStream.schema(SCHEMA).parquet(src), ["k"], "ts", "v", "30 minutes", "5 minutes")
        q = streams.stream_changes(totals, path, ck, ["k", "session_start"], 8, once=True, seen=lambda _, rows: wrote.append(rows))
        q.awaitTermination()
        states.append(max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress[-1:]))

    put(spark, src, [(k, 1, k % 10) for k in range(50)])
    run()
    put(spark, src, [(1, 5, 12), (60, 1, 200)])
    run()
    put(spark, src, [(2, 7, 300)])  # key 2 comes back after its state has gone
    run()
    put(spark, src, [(61, 1, 301)])
    run()
    assert wrote[0] == 50 and all(n <= 2 for n in wrote[1:])
    assert states[0] == 50 and states[-1] <= 3
    rows = spark.read.parquet(path)
    assert {r.k: r.v for r in rows.groupBy("k").agg(F.sum("total").alias("v")).collect()} == {**{k: 1.0 for k in range(50)}, 1: 6.0, 2: 8.0, 60: 1.0, 61: 1.0}
    assert rows.filter("k = 2").count() == 2 and rows.filter("k = 1").count() == 1


def test_scratch_goes(spark):
    df = tables.written(spark.range(5), "gone")
    assert df.count() == 5 and tables.clear_scratch(spark) > 0
    with pytest.raises(Exception, match="(?i)not.exist|FILE_NOT_EXIST|FileNotFound"):
        tables.read_table(spark, df.inputFiles()[0]).count()


def test_sessions_are_chains_of_periods(spark, tmp_path):
    """Sessions that reach over several periods are whole, and rows need no Python worker."""
    path, src, ck = str(tmp_path / "t"), str(tmp_path / "in"), str(tmp_path / "ck")
    put(spark, src, [(1, 1, 5), (1, 2, 29), (1, 4, 31), (1, 8, 58), (1, 16, 88), (2, 1, 10), (2, 2, 70), (3, 1, 0)])
    df = streams.session_totals(spark.readStream.schema(SCHEMA).parquet(src), ["k"], "ts", "v", "30 minutes", "5 minutes")
    q = streams.stream_changes(df, path, ck, ["k", "session_start"], 8, once=True)
    q.awaitTermination()
    assert "Python" not in df._jdf.queryExecution().analyzed().toString()
    got = sorted((r.k, r.session_start, r.n, r.total, r.last_seen) for r in streams.chained(spark.read.parquet(path), ["k"], "30 minutes").collect())
    assert got == [(1, at(5), 4, 15.0, at(58)), (1, at(88), 1, 16.0, at(88)), (2, at(10), 1, 1.0, at(10)), (2, at(70), 1, 2.0, at(70)), (3, at(0), 1, 1.0, at(0))]


def test_sessions_query_has_every_event_whatever_the_ids(spark, sf, tmp_path):
    """Copies with shifted ids: events of a later id are earlier in time than some before them."""
    from gamelake.plans import registry

    e = spark.read.parquet(f"{sf}/events.parquet")
    both = e.unionByName(e.withColumns({"event_id": F.col("event_id") + 1_000_000, "user_id": F.col("user_id") + 1_000_000}))
    both.write.parquet(str(tmp_path / "events.parquet"))
    assert registry.QUERIES["stream_sessions"](spark, str(tmp_path)).agg(F.sum("n")).first()[0] == 2 * e.count()
