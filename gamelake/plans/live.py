"""Queries on streams that merge, and on merges that touch part of a table. The events table plays the stream;
each ``availableNow`` run reads the files that have come since the one before it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gamelake.operators import scd, windows
from gamelake.plans import star
from gamelake.plans.base import ORACLE_SQL, query, table
from gamelake.plans.facts import _batches, _merge_sql
from gamelake.sources import tables
from gamelake.sources.tables import scratch
from gamelake.streaming import streams

S = SparkSession


def _runs(spark: S, events: DataFrame, parts: Sequence[Column], start: Callable[[DataFrame], StreamingQuery], retries: int = 0) -> None:
    """The rows of each part arrive as files of one folder; after each, the stream runs until it has read them. A
    run that fails is started again, ``retries`` times in all."""
    path = scratch(spark, "arrivals")
    for part in parts:
        events.filter(part).write.mode("append").parquet(path)
        while True:
            try:
                start(spark.readStream.schema(events.schema).parquet(path)).awaitTermination()
                break
            except StreamingQueryException:
                if not retries:
                    raise
                retries -= 1


_EVENTS = ("event_id", "event_type", "user_id", "value", "ts")


def _events(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(*(F.col(c) for c in _EVENTS[:4]), F.col("ts").cast("timestamp").alias("ts"))


_PART = "event_id * 3 // ((SELECT max(event_id) FROM events) + 1)"


@query(
    f"""WITH e AS (SELECT *, CAST({_PART} AS INT) AS part FROM events),
d AS (SELECT user_id, part, arg_max(event_type, event_id) AS kind FROM e GROUP BY ALL),
c AS (SELECT *, kind IS DISTINCT FROM lag(kind) OVER w AS changed FROM d WINDOW w AS (PARTITION BY user_id ORDER BY part)),
v AS (SELECT user_id, kind, DATE '2024-01-01' + part AS since, lead(DATE '2024-01-01' + part) OVER (PARTITION BY user_id ORDER BY part) AS until FROM c WHERE changed)
SELECT 'totals' AS kept_in, event_type AS key, CAST(count(*) AS DOUBLE) AS n, CAST(sum(user_id) AS DOUBLE) AS total, NULL AS state, CAST(NULL AS DATE) AS since, CAST(NULL AS DATE) AS until FROM e GROUP BY event_type
UNION ALL SELECT 'averages', CAST(user_id AS VARCHAR), CAST(count(*) AS DOUBLE), CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*), NULL, NULL, NULL FROM e GROUP BY user_id
UNION ALL SELECT 'users', CAST(user_id AS VARCHAR), NULL, NULL, kind, since, until FROM v"""
)
def stream_tables(spark: S, sf: str) -> DataFrame:
    """One stream into a table of totals, one of averages and an SCD2 dimension of users (the type of a user's last
    event in each batch), published together. The second batch fails once between two of the writes."""
    root, failed = scratch(spark, "live"), []

    def totals(old: DataFrame | None, batch: DataFrame, _: int) -> DataFrame:
        new = batch.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("total"))
        return new if old is None else old.unionByName(new).groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    def averages(old: DataFrame | None, batch: DataFrame, number: int) -> DataFrame:
        if number == 1 and not failed:
            failed.append(number)
            return batch.select(F.raise_error(F.lit("a write that fails")).alias("user_id"))
        new = batch.groupBy("user_id").agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("total"))
        return new if old is None else old.select("user_id", "n", "total").unionByName(new).groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    def users(old: DataFrame | None, batch: DataFrame, number: int) -> DataFrame:
        new = windows.dedupe_latest(batch, ["user_id"], [F.col("event_id").desc()]).select("user_id", "event_type")
        at = F.date_add(F.lit("2024-01-01").cast("date"), number)
        return scd.scd2_start(new, ["user_id"], ["event_type"], at) if old is None else scd.scd2_merge(old, new, ["user_id"], ["event_type"], at)

    events = _events(spark, sf)
    part = F.floor(F.col("event_id") * 3 / F.lit(events.agg(F.max("event_id") + 1).first()[0]))
    merges = {"totals": totals, "averages": averages, "users": users}
    _runs(spark, events, [part == k for k in range(3)], lambda df: streams.stream_merge_tables(df, root, f"{root}/checkpoint", merges, once=True), retries=1)
    none = {c: F.lit(None).cast(t) for c, t in (("n", "double"), ("total", "double"), ("state", "string"), ("since", "date"), ("until", "date"))}
    read = lambda name, key, **own: tables.read_published(spark, root, name).select(F.lit(name).alias("kept_in"), F.col(key).cast("string").alias("key"), *(own.get(c, v).alias(c) for c, v in none.items()))
    n, total = F.col("n").cast("double"), F.col("total").cast("double")
    return (
        read("totals", "event_type", n=n, total=total)
        .unionByName(read("averages", "user_id", n=n, total=total / n))
        .unionByName(read("users", "user_id", state=F.col("event_type"), since=F.col("record_start_date"), until=F.col("record_end_date")))
    )


@query("SELECT user_id, count(*) AS n, round(sum(value), 4) AS total, max(ts) AS last_seen FROM events GROUP BY user_id")
def stream_sessions(spark: S, sf: str) -> DataFrame:
    """Running totals of users in update mode, whose state goes with the two days that the watermark has passed: each
    batch writes the users that it has. Events arrive by their time, whatever their ids, so none is late. A user's
    totals are the sums over their sessions, which two days without an event end."""
    root, events = scratch(spark, "sessions"), _events(spark, sf)
    first, last = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    part = F.floor((F.unix_micros("ts") - F.lit(first)) * 4 / F.lit(last - first + 1))
    key = ["user_id", "session_start"]
    _runs(spark, events, [part == k for k in range(4)], lambda df: streams.stream_changes(streams.session_totals(df, ["user_id"], "ts", "value", "2 days"), f"{root}/table", f"{root}/checkpoint", key, 16, once=True))
    sessions = streams.chained(spark.read.parquet(f"{root}/table"), ["user_id"], "2 days")
    return sessions.groupBy("user_id").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"), F.max("last_seen").cast("timestamp_ntz").alias("last_seen"))


@query(
    """WITH a AS (SELECT ts, event_id % 7 = 0 OR ts >= TIMESTAMP '2024-01-16 12:00:00' AS second, time_bucket(INTERVAL 10 MINUTE, ts) AS b FROM events),
w AS (SELECT max(ts) FILTER (NOT second) - INTERVAL 10 MINUTE AS w1, max(ts) - INTERVAL 10 MINUTE AS w2 FROM a)
SELECT CAST(b AS TIMESTAMP) AS window_start, count(*) AS n FROM a, w WHERE (NOT second OR b + INTERVAL 10 MINUTE > w1) AND b + INTERVAL 10 MINUTE <= w2 GROUP BY b"""
)
def stream_lateness(spark: S, sf: str) -> DataFrame:
    """Ten-minute counts in append mode with a watermark of ten minutes. Every seventh event of the first half comes
    with the second half: those whose window had been closed by then aren't counted, and the windows that
    are still open at the end aren't there."""
    root, events = scratch(spark, "late"), _events(spark, sf)
    second = (F.col("event_id") % 7 == 0) | (F.col("ts") >= F.lit("2024-01-16 12:00:00").cast("timestamp"))
    count = lambda df: streams.window_counts(streams.with_lateness(df, "ts", "10 minutes"), "ts", "10 minutes", None)
    _runs(spark, events, [~second, second], lambda df: streams.stream_append(count(df), f"{root}/data", f"{root}/checkpoint", once=True))
    return spark.read.parquet(f"{root}/data").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


@query(
    """SELECT CAST(time_bucket(INTERVAL 5 MINUTE, ts) - k * INTERVAL 5 MINUTE AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events, unnest([0, 1]) AS t(k) GROUP BY ALL"""
)
def stream_sliding(spark: S, sf: str) -> DataFrame:
    """Sliding counts as a stream in update mode: windows that a batch changed are written, closed ones are dropped
    from the state."""
    root, events = scratch(spark, "sliding"), _events(spark, sf)
    half = F.col("ts") < F.lit("2024-01-16 12:00:00").cast("timestamp")
    count = lambda df: streams.window_counts(streams.with_lateness(df, "ts", "10 minutes"), "ts", keys=["event_type"]).drop("window_end")
    _runs(spark, events, [half, ~half], lambda df: streams.stream_changes(count(df), f"{root}/table", f"{root}/checkpoint", ["window_start", "event_type"], 16, once=True))
    return spark.read.parquet(f"{root}/table").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@query(
    """SELECT 'user' AS kept_in, CAST(user_id AS VARCHAR) AS key, count(*) AS n FROM (SELECT DISTINCT user_id FROM events) GROUP BY user_id
UNION ALL SELECT 'type', event_type, 1 FROM (SELECT DISTINCT event_type FROM events) UNION ALL SELECT 'fact', event_type || '-' || user_id, count(*) FROM events GROUP BY event_type, user_id"""
)
def stream_star(spark: S, sf: str) -> DataFrame:
    """Dimensions and facts of a star from one stream, published together after each batch."""
    root, events = scratch(spark, "star"), _events(spark, sf)
    dims = {"user": ["user_id"], "type": ["event_type"]}

    def part(name: str) -> streams.Merge:
        def merge(old: DataFrame | None, batch: DataFrame, _: int) -> DataFrame:
            new = star.split_star(batch, dims, ["event_id", "event_type", "user_id"])[name]
            return new if old is None else old.unionByName(new) if name == "fact" else scd.upsert(old, new, dims[name][:1], [F.lit(1)])

        return merge

    halves = [F.col("event_id") % 2 == k for k in (0, 1)]
    _runs(spark, events, halves, lambda df: streams.stream_merge_tables(df, root, f"{root}/checkpoint", {n: part(n) for n in (*dims, "fact")}, once=True))
    read = lambda name, *key: tables.read_published(spark, root, name).groupBy(F.concat_ws("-", *(F.col(k).cast("string") for k in key)).alias("key")).agg(F.count("*").alias("n")).select(F.lit(name).alias("kept_in"), "key", "n")
    return read("user", "user_id").unionByName(read("type", "event_type")).unionByName(read("fact", "event_type", "user_id"))


@query(_merge_sql("t.hash_val <> u.hash_val"))
def scd2_merge_buckets(spark: S, sf: str) -> DataFrame:
    """Two batches merged into an SCD2 table of which only the buckets of the batch are read and written."""
    path, (b1, b2) = scratch(spark, "buckets"), _batches(spark, sf)
    own = ["id"], ["status", "n"]
    tables.merge_buckets(path, b1, ["id"], lambda _, new: scd.scd2_start(new, *own, "1997-12-31"), 16)
    tables.merge_buckets(path, b2, ["id"], lambda old, new: scd.scd2_start(new, *own, "2001-12-31") if old is None else scd.scd2_merge(old, new, *own, "2001-12-31"), 16)
    return spark.read.parquet(path).drop(tables.BUCKET)


@query(ORACLE_SQL["upsert_two_batches"])
def upsert_buckets(spark: S, sf: str) -> DataFrame:
    path, (b1, b2) = scratch(spark, "buckets"), _batches(spark, sf)
    for batch in (b1, b2):
        tables.merge_buckets(path, batch, ["id"], lambda old, new: new if old is None else scd.upsert(old, new, ["id"], [F.col("n").desc()]), 16)
    return spark.read.parquet(path).drop(tables.BUCKET)
