"""Structured Streaming: parsing, lateness, windows, running aggregates, upserts and fan-out.

Merges run inside foreachBatch. A version of the target and the query's batch that made it are published
in one row, so a batch that is replayed after a failure is skipped if and only if it was applied.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from gamelake.operators import scd
from gamelake.operators.project import extend_schema, parse_json
from gamelake.sources import tables


def stream_parse(records: DataFrame, schema: str, keep: Sequence[str] = ("topic", "partition", "offset", "timestamp")) -> DataFrame:
    """Typed rows of JSON records: the same projection as in a batch."""
    return parse_json(records, schema, [c for c in keep if c in records.columns])


def with_lateness(df: DataFrame, ts: str, delay: str = "10 minutes") -> DataFrame:
    """Rows later than the delay are dropped once the watermark has passed them."""
    return df.withWatermark(ts, delay)


def window_counts(df: DataFrame, ts: str, size: str = "10 minutes", slide: str | None = "5 minutes", keys: Sequence[str] = (), extra: Sequence[Column] = ()) -> DataFrame:
    """Counts in sliding windows, or in tumbling ones without a slide; in batches and in streams."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    out = df.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), *extra)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in out.columns if c != "w"])


def stream_agg(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Running aggregates over all that has come; to be written in complete or update mode."""
    return df.groupBy(*keys).agg(*aggs)


def stream_distinct(df: DataFrame, keys: Sequence[str], watermarked: bool = False) -> DataFrame:
    """The first row of each key; with a watermark the state is bounded by the delay."""
    return df.dropDuplicatesWithinWatermark(list(keys)) if watermarked else df.dropDuplicates(list(keys))


def stream_append(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_complete(df: DataFrame, root: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Each result of a complete-mode aggregate as a new version of the table at root."""
    writer = df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: tables.write_version(batch, root))
    return (writer.trigger(availableNow=True) if once else writer).start()


def _query_id(batch: DataFrame) -> str:
    """The id of the running query: kept in its checkpoint, so a restart has the same one and a query
    with a new checkpoint another."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if found is None:
        raise RuntimeError("no query id: call this inside foreachBatch of a running query")
    return found


def stream_upsert(df: DataFrame, root: str, checkpoint: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame], once: bool = False) -> StreamingQuery:
    """Merge every micro-batch into the versioned table at root: merge(table or None, batch) -> table.

    The row that publishes a version holds the ids of the query and of the batch. A batch that comes
    again after a restart is skipped if its version was published, else it is merged into the version
    before it. With a new checkpoint the query is another one: its batches are new, whatever their
    numbers, and rows that it reads again are merged again."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, query = batch.sparkSession, _query_id(batch)
        known = tables.versions(spark, root)
        if known.filter((F.col("writer") == query) & (F.col("batch") == batch_id)).limit(1).count():
            return
        first = known.isEmpty()
        batch = batch.persist()
        try:
            tables.write_version(merge(None if first else tables.read_version(spark, root), batch), root, query, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(apply)
    return (writer.trigger(availableNow=True) if once else writer).start()


Merge = Callable[[DataFrame | None, DataFrame, int], DataFrame]


def stream_merge_tables(df: DataFrame, root: str, checkpoint: str, merges: Mapping[str, Merge], once: bool = False) -> StreamingQuery:
    """Every micro-batch into several tables at once: table -> merge(its rows or None, batch, batch id) -> its rows.

    The batch is computed once; the new versions of all tables are written, and one row makes them visible
    together with the ids of query and batch (``tables.publish``). If a merge or a write fails, none of the
    batch is visible, and the batch that comes again starts from the tables before it; a batch that was
    published is skipped. So aggregates inside merges count each row once."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, query = batch.sparkSession, _query_id(batch)
        if tables.published(spark, root).filter((F.col("writer") == query) & (F.col("batch") == batch_id)).limit(1).count():
            return
        paths = tables.current_paths(spark, root)
        batch = batch.persist()
        try:
            new = {name: merge(spark.read.parquet(paths[name]) if name in paths else None, batch, batch_id) for name, merge in merges.items()}
            tables.publish(new, root, query, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(apply)
    return (writer.trigger(availableNow=True) if once else writer).start()


def session_totals(df: DataFrame, keys: Sequence[str], ts: str, value: str, gap: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Running count, total, first and last time of each key in each period of ``gap`` of event time, for update
    mode: a row for each key and period that a batch has; ``session_start`` is the period's. The state of periods
    that the watermark has passed is dropped, so state grows with the keys that are alive; rows later than
    ``delay`` that belong to them are, too. A session is a chain of periods, as no two rows of one are ``gap``
    apart: ``chained`` joins them, a key's totals are the sums over them. Null times are left out; null values
    count as 0. No Python runs for a key: one of its own cost some milliseconds in each batch."""
    rows = df.filter(F.col(ts).isNotNull()).select(*keys, F.col(ts).cast("timestamp").alias("_ts"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("_v")).withWatermark("_ts", delay)
    out = rows.groupBy(*keys, F.window("_ts", gap).alias("_w")).agg(F.count("*").alias("n"), F.sum("_v").alias("total"), F.min("_ts").alias("first_seen"), F.max("_ts").alias("last_seen"))
    return out.select(*keys, F.col("_w.start").alias("session_start"), "n", "total", "first_seen", "last_seen")


def chained(periods: DataFrame, keys: Sequence[str], gap: str) -> DataFrame:
    """Sessions of the rows of ``session_totals``: a key's next one opens where ``gap`` or more lies between two
    periods' rows."""
    w = Window.partitionBy(*keys).orderBy("session_start")
    opens = F.coalesce(F.col("first_seen") - F.expr(f"INTERVAL {gap}") >= F.lag("last_seen").over(w), F.lit(True))
    marked = periods.withColumn("_opens", opens.cast("int")).withColumn("_session", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = marked.groupBy(*keys, "_session").agg(F.min("first_seen").alias("session_start"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("last_seen").alias("last_seen"))
    return out.drop("_session")


def stream_changes(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], buckets: int = 64, once: bool = False, seen: Callable[[int, int], None] | None = None) -> StreamingQuery:
    """An update-mode result as a table: each micro-batch has only the groups that changed, and only their buckets
    are read and written (``tables.merge_buckets``), whatever the size of the table. The merge is an upsert by
    key, so a replayed batch changes nothing. seen(batch id, rows written to touched groups), if given."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            tables.merge_buckets(path, batch, keys[:1], lambda old, new: new if old is None else scd.upsert(old, new, keys, [F.lit(1)]), buckets)
            if seen:
                seen(batch_id, batch.count())
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(apply)
    return (writer.trigger(availableNow=True) if once else writer).start()


def fan_out(df: DataFrame, sinks: Mapping[str, Callable[[DataFrame], DataFrame]], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Several tables from one stream: path -> projection. The batch is computed once; a folder for each
    query and batch makes a replay overwrite its own rows only."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        query = _query_id(batch)
        batch = batch.persist()
        try:
            for path, project in sinks.items():
                project(batch).write.mode("overwrite").parquet(f"{path}/query_id={query}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(apply)
    return (writer.trigger(availableNow=True) if once else writer).start()


def widen_batch(batch: DataFrame, base: Sequence[str], value: str = "value") -> DataFrame:
    """Per-batch schema evolution: JSON objects as maps, then a column for each key that the batch has.

    The distinct keys of the batch reach the driver; their number is that of columns, not of rows."""
    maps = batch.select(F.from_json(value, "map<string,string>").alias("m"))
    found = [r["k"] for r in maps.select(F.explode(F.map_keys("m")).alias("k")).distinct().orderBy("k").collect()]
    schema = extend_schema(T.StructType([T.StructField(c, T.StringType()) for c in base]), found)
    return maps.select(*(F.col("m")[f.name].alias(f.name) for f in schema))
