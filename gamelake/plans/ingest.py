"""Queries on sources, streams, texts and data quality. Topic records are made of the events table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.operators import project, quality, text
from gamelake.plans.base import WITH, box, query, scratch, table, written
from gamelake.sources import documents, planning, tables, topics
from gamelake.streaming import streams

S = SparkSession


def records(spark: S, sf: str) -> DataFrame:
    """The events as topic records: three partitions, offsets in order of event id."""
    e = table(spark, sf, "events")
    return e.select(
        F.lit("events").alias("topic"), (F.col("event_id") % 3).cast("int").alias("partition"), F.floor(F.col("event_id") / 3).alias("offset"), F.col("ts").alias("timestamp"),
        F.to_json(F.struct("event_id", "user_id", "event_type", "value", F.from_json("props", "k int").alias("metadata"))).alias("value"),
    )


_SCHEMA = "event_id long, user_id long, event_type string, value double, metadata struct<k:int>"


@query("SELECT CAST(event_id % 3 AS INT) AS partition, CAST(floor(event_id / 3) AS BIGINT) AS \"offset\", event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INT) AS metadata_k FROM events")
def events_json_parse(spark: S, sf: str) -> DataFrame:
    r = records(spark, sf)
    parsed = r.select("partition", "offset", F.from_json("value", _SCHEMA).alias("d")).select("partition", "offset", "d.*")
    return documents.flatten_struct(parsed)


@query("SELECT 'events' AS topic, CAST(event_id % 3 AS INT) AS partition, CAST(max(floor(event_id / 3)) + 1 AS BIGINT) AS next_offset FROM events GROUP BY ALL")
def next_offsets(spark: S, sf: str) -> DataFrame:
    return topics.next_offsets(records(spark, sf))


_LEDGER = "l AS (SELECT CAST(event_id % 3 AS INT) AS p, max(CAST(floor(event_id / 3) AS BIGINT)) // 2 AS nxt FROM events WHERE event_id % 3 <> 2 GROUP BY 1)"


@query(f"WITH {_LEDGER} SELECT CAST(event_id % 3 AS INT) AS partition, CAST(floor(event_id / 3) AS BIGINT) AS \"offset\" FROM events LEFT JOIN l ON event_id % 3 = p WHERE floor(event_id / 3) >= coalesce(nxt, 0)")
def resume_from_offsets(spark: S, sf: str) -> DataFrame:
    """Records after the stored offsets; a partition without any is read from its start."""
    r = records(spark, sf)
    stored = r.filter("partition <> 2").groupBy("topic", "partition").agg(F.floor(F.max("offset") / 2).alias("next_offset"))
    return topics.resume(r, stored).select("partition", "offset")


@query("WITH n AS (SELECT CAST(event_id % 3 AS INT) AS p, CAST(max(floor(event_id / 3)) + 1 AS BIGINT) AS o FROM events GROUP BY 1) SELECT 'events' AS topic, '{' || string_agg('\"' || p || '\":' || o, ',' ORDER BY p) || '}' AS partition_offsets FROM n")
def offsets_ledger(spark: S, sf: str) -> DataFrame:
    """Two ledger entries of the topic; the newest wins."""
    r = records(spark, sf)
    old = topics.partition_offsets(topics.next_offsets(r.filter("offset < 10"))).withColumn("id", F.lit(1))
    new = topics.partition_offsets(topics.next_offsets(r)).withColumn("id", F.lit(2))
    return topics.newest_offsets(old.unionByName(new))


@query("SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS cust_id, o_orderstatus AS status, CAST(year(o_orderdate) AS VARCHAR) AS season FROM orders")
def result_set_decode(spark: S, sf: str) -> DataFrame:
    """Orders as API result sets (one document a customer and year), decoded again."""
    o = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("string"))
    row = F.array(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"))
    docs = o.groupBy("o_custkey", "year").agg(F.collect_list(row).alias("rows")).select(
        F.to_json(F.struct(F.lit("orders").alias("resource"), F.create_map(F.lit("Season"), F.col("year")).alias("parameters"), F.array(F.struct(F.lit("Orders").alias("name"), F.array(F.lit("ORDER_ID"), F.lit("CUST_ID"), F.lit("STATUS")).alias("headers"), F.col("rows").alias("rowSet"))).alias("resultSets"))).alias("value")
    )
    return documents.decode_result_set(docs, "Orders", {"ORDER_ID": "long", "CUST_ID": "long", "STATUS": "string"}, ["Season"])


@query("SELECT o_orderkey AS id, o_custkey AS customer_key, o_orderstatus AS customer_state_code, o_totalprice AS total FROM orders")
def flatten_struct(spark: S, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    nested = o.select(F.col("o_orderkey").alias("id"), F.struct(F.col("o_custkey").alias("key"), F.struct(F.col("o_orderstatus").alias("code")).alias("state")).alias("customer"), F.col("o_totalprice").alias("total"))
    return documents.flatten_struct(nested)


@query("SELECT l_orderkey AS order_id, CAST(l_linenumber AS INT) AS line_id, CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INT) AS quantity FROM lineitem")
def order_documents(spark: S, sf: str) -> DataFrame:
    """Orders with their lines as nested JSON documents, parsed and exploded to the child table."""
    l = table(spark, sf, "lineitem")
    line = F.struct(F.col("l_linenumber").cast("int").alias("line_id"), F.col("l_partkey").cast("string").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").alias("unit_price"))
    docs = l.groupBy("l_orderkey").agg(F.collect_list(line).alias("line_items")).select(F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("order_id"), "line_items")).alias("value"))
    lines = documents.order_lines(documents.parse_orders(docs))
    return lines.select(F.col("order_id").cast("long").alias("order_id"), "line_id", "product_id", "quantity")


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, CAST(json_extract(props, '$.k') AS INT) AS metadata_k, CAST(1 + event_id % 2 AS INT) AS n_filters FROM events")
def click_events(spark: S, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    filters = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("brand"))).otherwise(F.array(F.lit("brand"), F.lit("size")))
    docs = e.select(F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type", F.col("user_id").cast("string").alias("user_id"), filters.alias("filters_applied"), F.from_json("props", "k int").alias("metadata"))).alias("value"))
    return documents.parse_events(docs).select("event_id", "event_type", "user_id", "metadata_k", F.size("filters_applied").alias("n_filters"))


@query(
    """SELECT o_orderkey, array_to_string(list_filter([CASE WHEN NOT o_totalprice < 400000 THEN 'price' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status' END, CASE WHEN NOT o_orderkey % 50 > 0 THEN 'key' END], lambda x: x IS NOT NULL), ',') AS errors
FROM orders WHERE NOT (o_totalprice < 400000 AND o_orderstatus IN ('F', 'O') AND o_orderkey % 50 > 0)"""
)
def validate_rejects(spark: S, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    _, rejects = documents.validate(o, {"price": F.col("o_totalprice") < 400000, "status": F.col("o_orderstatus").isin("F", "O"), "key": F.col("o_orderkey") % 50 > 0})
    return rejects.select("o_orderkey", F.array_join("errors", ",").alias("errors"))


@query("SELECT o_orderstatus AS status, max(CAST(o_orderdate AS DATE)) AS high_water_mark FROM orders GROUP BY 1 UNION ALL SELECT 'none', DATE '1990-01-01'")
def high_water_mark(spark: S, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    wanted = spark.createDataFrame([("F",), ("O",), ("P",), ("none",)], "o_orderstatus string")
    return planning.high_water_marks(o, wanted, "o_orderstatus", "o_orderdate", "1990-01-01").withColumnRenamed("o_orderstatus", "status")


_CHUNKS = """s AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS start_year FROM orders), b AS (SELECT start_year, make_date(start_year, 10, 1) AS season_start, make_date(start_year + 1, 6, 30) AS season_end FROM s),
chunks AS (SELECT start_year, season_start, season_end, CAST(c AS DATE) AS chunk_start, least(CAST(c + INTERVAL 89 DAY AS DATE), season_end) AS chunk_end FROM b, unnest(generate_series(CAST(season_start AS TIMESTAMP), CAST(season_end AS TIMESTAMP), INTERVAL 90 DAY)) AS t(c))"""


@query(f"WITH {_CHUNKS} SELECT * FROM chunks")
def date_chunks(spark: S, sf: str) -> DataFrame:
    seasons = table(spark, sf, "orders").select(F.year("o_orderdate").alias("start_year")).distinct()
    return planning.date_chunks(planning.season_bounds(seasons), "season_start", "season_end", 90)


@query(f"WITH {_CHUNKS} SELECT chunk_start, chunk_end FROM chunks WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 300000 AND CAST(o_orderdate AS DATE) BETWEEN chunk_start AND chunk_end)")
def missing_chunks(spark: S, sf: str) -> DataFrame:
    """Planned chunks without any large order that is in part fulfilled."""
    planned = date_chunks(spark, sf)
    days = table(spark, sf, "orders").filter("o_orderstatus = 'P' and o_totalprice > 300000").select(F.to_date("o_orderdate").alias("day")).distinct()
    years = days.select("day", F.explode(F.array(F.year("day"), F.year("day") - 1)).alias("start_year"))
    loaded = years.join(planned, "start_year").filter(F.col("day").between(F.col("chunk_start"), F.col("chunk_end"))).select("chunk_start", "chunk_end").distinct()
    return planning.missing_chunks(planned.select("chunk_start", "chunk_end"), loaded)


@query("SELECT c_custkey, c_name, c_nationkey, CAST(to_json(struct_pack(c_custkey := c_custkey, c_name := c_name, c_nationkey := c_nationkey)) AS VARCHAR) AS document FROM customer")
def json_documents(spark: S, sf: str) -> DataFrame:
    n = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    docs = documents.to_json_documents(n, F.lit("2024-01-01").cast("timestamp"))
    return docs.select(F.from_json("document", "c_custkey long, c_name string, c_nationkey int").alias("d"), "document").select("d.*", "document")


@query(
    """SELECT CAST(time_bucket(INTERVAL 5 MINUTE, ts) - k * INTERVAL 5 MINUTE AS TIMESTAMP) AS window_start, CAST(time_bucket(INTERVAL 5 MINUTE, ts) - k * INTERVAL 5 MINUTE + INTERVAL 10 MINUTE AS TIMESTAMP) AS window_end, event_type, count(*) AS n
FROM events, unnest([0, 1]) AS t(k) GROUP BY ALL"""
)
def sliding_counts(spark: S, sf: str) -> DataFrame:
    return streams.window_counts(table(spark, sf, "events"), "ts", keys=["event_type"])


@query("SELECT CAST(time_bucket(INTERVAL 1 HOUR, ts) AS TIMESTAMP) AS window_start, CAST(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS TIMESTAMP) AS window_end, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY ALL")
def tumbling_counts(spark: S, sf: str) -> DataFrame:
    return streams.window_counts(table(spark, sf, "events"), "ts", "1 hour", None, extra=[F.sum("user_id").alias("users")])


def _as_stream(spark: S, sf: str) -> DataFrame:
    """The records as a file stream of several micro-batches."""
    path = scratch(spark, "topic")
    records(spark, sf).repartitionByRange(4, "timestamp").write.parquet(path)
    return streams.stream_parse(topics.stream_topic_files(spark, path, 2), _SCHEMA)


@query("SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users, max(event_id) AS last FROM events GROUP BY event_type")
def stream_running_totals(spark: S, sf: str) -> DataFrame:
    """A complete-mode aggregate over a file stream, run to its end."""
    root = scratch(spark, "totals")
    agg = streams.stream_agg(_as_stream(spark, sf), ["event_type"], [F.count("*").alias("n"), F.sum("user_id").alias("users"), F.max("event_id").alias("last")])
    streams.stream_complete(agg, root, f"{root}/checkpoint", once=True).awaitTermination()
    return tables.read_version(spark, root)


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def stream_upsert(spark: S, sf: str) -> DataFrame:
    """The latest event of each user, merged batch by batch."""
    from gamelake.operators import windows

    root = scratch(spark, "latest")

    def merge(old: DataFrame | None, batch: DataFrame) -> DataFrame:
        new = batch.select("user_id", "event_id", "event_type")
        return windows.dedupe_latest(new if old is None else old.unionByName(new), ["user_id"], [F.col("event_id").desc()])

    streams.stream_upsert(_as_stream(spark, sf), root, f"{root}/checkpoint", merge, once=True).awaitTermination()
    return tables.read_version(spark, root)


@query("SELECT DISTINCT event_type, user_id FROM events")
def stream_distinct(spark: S, sf: str) -> DataFrame:
    """A streaming dimension appended to Parquet."""
    root = scratch(spark, "distinct")
    dims = streams.stream_distinct(_as_stream(spark, sf).select("event_type", "user_id"), ["event_type", "user_id"])
    streams.stream_append(dims, f"{root}/data", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{root}/data")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_fan_out(spark: S, sf: str) -> DataFrame:
    """One stream, two sinks; the counts of one of them."""
    root = scratch(spark, "fan")
    sinks = {f"{root}/types": lambda b: b.select("event_id", "event_type"), f"{root}/users": lambda b: b.select("event_id", "user_id")}
    streams.fan_out(_as_stream(spark, sf), sinks, f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{root}/types").groupBy("event_type").agg(F.count("*").alias("n"))


_ORD = "CASE WHEN day(d) % 100 BETWEEN 11 AND 13 THEN 'th' WHEN day(d) % 10 = 1 THEN 'st' WHEN day(d) % 10 = 2 THEN 'nd' WHEN day(d) % 10 = 3 THEN 'rd' ELSE 'th' END"


@query(f"SELECT o_orderkey, strftime(d, '%B') || ' ' || day(d) || {_ORD} || ', ' || year(d) AS date_text FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def date_text(spark: S, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", text.date_text(F.to_date("o_orderdate")).alias("date_text"))


_SENTENCES = {"stl": ("had no steals.", "had one steal.", "had {n} steals."), "ast": ("had no assists.", "had one assist.", "had {n} assists.")}


def _sentence_sql(c: str) -> str:
    none, one, many = _SENTENCES[c]
    before, _, after = many.partition("{n}")
    return f"member_id || ' ' || CASE WHEN coalesce({c}, 0) = 0 THEN '{none}' WHEN {c} = 1 THEN '{one}' ELSE '{before}' || {c} || '{after}' END AS {c}_text"


@query(f"{WITH} SELECT member_id, event_id, season, {', '.join(_sentence_sql(c) for c in _SENTENCES)} FROM box")
def row_sentences(spark: S, sf: str) -> DataFrame:
    return text.row_sentences(box(spark, sf), "member_id", _SENTENCES).select("member_id", "event_id", "season", *(f"{c}_text" for c in _SENTENCES))


@query("SELECT c_custkey, 'Name: ' || c_name || '; Segment: ' || c_mktsegment || '; Good: ' || CASE WHEN c_nationkey > 10 THEN 'Yes' ELSE 'No' END AS profile, c_custkey || ' ' || c_name || ' ' || c_mktsegment AS row_text FROM customer")
def row_text(spark: S, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").withColumn("good", F.col("c_nationkey") > 10)
    out = text.profile_text(c, {"c_name": "Name", "c_mktsegment": "Segment", "good": "Good"})
    return text.row_text(out, ["c_custkey", "c_name", "c_mktsegment"]).select("c_custkey", "profile", "row_text")


@query(
    f"""{WITH} SELECT 'not_null' AS "check", 'member_id' AS "column", CAST(count(*) FILTER (member_id IS NULL) AS BIGINT) AS failed, count(*) AS total FROM box
UNION ALL SELECT 'range', 'pts', CAST(count(*) FILTER (pts < 5 OR pts > 55) AS BIGINT), count(*) FROM box
UNION ALL SELECT 'not_negative', 'plus_minus', CAST(count(*) FILTER (plus_minus < 0) AS BIGINT), count(*) FROM box
UNION ALL SELECT 'unique', 'member_id+season', CAST(count(*) FILTER (n > 1) AS BIGINT), CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM box GROUP BY member_id, season)"""
)
def quality_report(spark: S, sf: str) -> DataFrame:
    b = box(spark, sf)
    return quality.report(quality.run_checks(b, [quality.not_null("member_id"), quality.in_range("pts", 5, 55), quality.not_negative("plus_minus")]), quality.unique(b, ["member_id", "season"]))


@query(
    f"""{WITH}, n AS (SELECT CASE WHEN fga < 0 THEN 0 WHEN fga >= 60 THEN 11 ELSE floor(fga * 10 / 60.0) + 1 END AS bin, greatest(CAST(count(*) FILTER (season < 1998) AS DOUBLE), 0.5) AS x, greatest(CAST(count(*) FILTER (season >= 1998) AS DOUBLE), 0.5) AS y FROM box GROUP BY 1),
t AS (SELECT sum(x) AS sx, sum(y) AS sy FROM n) SELECT 'fga' AS "column", round(sum((x / sx - y / sy) * ln((x / sx) / (y / sy))), 6) AS psi FROM n, t"""
)
def drift_psi(spark: S, sf: str) -> DataFrame:
    return quality.drift_within(box(spark, sf), F.col("season") < 1998, "fga", 0, 60, 10)


@query(f"{WITH}, g AS (SELECT group_id, round(avg(pts), 4) AS average FROM box GROUP BY group_id) SELECT group_id, average, average < 28 AS is_alert FROM g")
def alerts(spark: S, sf: str) -> DataFrame:
    g = box(spark, sf).groupBy("group_id").agg(F.round(F.avg("pts"), 4).alias("average"))
    return quality.alert_below(g, "average", 28)


@query("SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN label + 100 ELSE label END AS label, CASE WHEN vec_id % 4 = 0 THEN 2 ELSE 1 END AS version FROM embeddings")
def vector_upsert(spark: S, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").withColumn("version", F.lit(1))
    new = e.filter("vec_id % 4 = 0").withColumn("label", F.col("label") + 100).withColumn("version", F.lit(2))
    return tables.upsert_vectors(e, new, "vec_id", "version").select("vec_id", "label", "version")


@query(f"{WITH} SELECT member_id, event_id, season, CAST(NULL AS INT) AS missing, pts, CAST(0.0 AS DOUBLE) AS extra FROM box")
def conformed_columns(spark: S, sf: str) -> DataFrame:
    from pyspark.sql import types as T

    kinds = [("member_id", T.LongType()), ("event_id", T.LongType()), ("season", T.IntegerType()), ("missing", T.IntegerType()), ("pts", T.IntegerType())]
    return project.ensure_cols(project.conform(box(spark, sf), T.StructType([T.StructField(n, t) for n, t in kinds])), ["extra"])


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_orderstatus FROM orders")
def partitioned_sinks(spark: S, sf: str) -> DataFrame:
    """Orders appended in two parts to a partitioned table, one partition overwritten, all read back."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch(spark, "sinks")
    tables.append(o.filter("o_orderkey % 2 = 0"), path, ["o_orderstatus"])
    tables.append(o.filter("o_orderkey % 2 <> 0"), path, ["o_orderstatus"])
    tables.overwrite(o.filter("o_orderstatus = 'O'").withColumn("o_custkey", F.col("o_custkey") + 1), path, ["o_orderstatus"])
    return tables.read_table(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("SELECT source_table, o_orderstatus, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS custkeys FROM (SELECT 'first' AS source_table, o_orderstatus, o_custkey FROM orders UNION ALL SELECT 'second', o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 2 = 0) GROUP BY ALL")
def managed_tables(spark: S, sf: str) -> DataFrame:
    """Two managed partitioned tables of a new database, read as one relation; the database is dropped again."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    base = f"lake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base}")
    try:
        for _ in range(2):
            tables.ensure_table(spark, f"{base}.first", o.schema, ["o_orderstatus"])
        tables.append_partitioned(o, f"{base}.first", "o_orderstatus")
        tables.append_partitioned(o.filter("o_orderkey % 2 = 0"), f"{base}.second", "o_orderstatus")
        both = tables.load_database(spark, base)
        return written(both.groupBy("source_table", "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("custkeys")), "managed")
    finally:
        spark.sql(f"DROP DATABASE {base} CASCADE")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders")
def csv_round_trip(spark: S, sf: str) -> DataFrame:
    """Orders exported as CSV with a header, below the size guard, and read back."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    path = scratch(spark, "csv")
    if not tables.export_csv(o, path, 1 << 40):
        raise ValueError("larger than the guard")
    return spark.read.schema(o.schema).option("header", True).csv(path)
