"""Operators on hand-made rows: nulls, ties, empty input, zero denominators, replays."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake.functions import advanced, scalars
from gamelake.operators import aggregates, features, joins, project, quality, scd, sets, spectra, text, windows
from gamelake.operators import ml as M
from gamelake.plans import star
from gamelake.sources import documents, planning, tables, topics
from gamelake.streaming import streams

D = dt.date


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {t}" for k, t in zip(cols, ("string",) * len(cols), strict=True))) if cols else spark.range(1)
    return df.select(expr).first()[0]


def test_home_away(spark):
    df = spark.createDataFrame([("AAA @ BBB",), ("BBB vs. AAA",), ("nothing",), (None,)], "m string")
    home, away = scalars.home_away(F.col("m"))
    assert [tuple(r) for r in df.select(home, away).collect()] == [("BBB", "AAA"), ("BBB", "AAA"), (None, None), (None, None)]


def test_row_hash_keeps_place_of_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    for fn in (scalars.row_hash, scalars.row_hash256):
        a, b = (r[0] for r in df.select(fn(["x", "y", "z"])).collect())
        assert a != b


def test_pct_clean(spark):
    df = spark.createDataFrame([(1.0,), (0.5,), (None,), (0.12345,)], "p double")
    assert [r[0] for r in df.select(scalars.pct_clean(F.col("p"))).collect()] == [1.0, 0.5, 0.0, 0.123]
    assert [r[0] for r in df.select(scalars.pct_clean(F.col("p"), True)).collect()] == [100.0, 0.5, 0.0, 0.123]


def test_ratios_with_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0, 0, 0), (12, 10, 4, 2)], "pts int, fga int, fta int, tov int")
    c = F.col
    assert [r[0] for r in df.select(advanced.true_shooting(c("pts"), c("fga"), c("fta"))).collect()] == [0.0, round(12 / (2 * 11.76), 4)]
    assert df.select(scalars.safe_ratio(c("pts"), c("fga"))).first()[0] is None


@pytest.mark.parametrize("day,want", [(1, "1st"), (2, "2nd"), (3, "3rd"), (4, "4th"), (11, "11th"), (12, "12th"), (13, "13th"), (21, "21st"), (31, "31st")])
def test_ordinal(spark, day, want):
    assert spark.range(1).select(scalars.ordinal(F.lit(day))).first()[0] == want


def test_buckets_and_tiers(spark):
    df = spark.createDataFrame([(-11.0,), (-10.0,), (10.0,), (10.5,), (None,)], "x double")
    assert [r[0] for r in df.select(scalars.bucket3(F.col("x"))).collect()] == ["LOW", "MED", "MED", "HIGH", "HIGH"]
    assert [r[0] for r in spark.createDataFrame([(6,), (7,), (10,), (11,)], "r int").select(scalars.rank_tier(F.col("r"))).collect()] == ["PLAYOFF", "PLAY_IN", "PLAY_IN", "LOTTERY"]


def test_recode_falls_through(spark):
    df = spark.createDataFrame([("Regular%20Season",), ("IST",), ("other",), (None,)], "t string")
    assert [r[0] for r in df.select(scalars.recode(F.col("t"), scalars.SEASON_TYPES)).collect()] == ["regular_season", "nba_cup", "other", None]


def test_clean_doubles_and_fill(spark):
    df = spark.createDataFrame([(float("nan"), None, "x"), (float("inf"), 2, None), (1.5, 3, "y")], "d double, i int, s string")
    assert [r.d for r in project.clean_doubles(df).collect()] == [0.0, 0.0, 1.5]
    assert [(r.i, r.s) for r in project.fill_numeric(df).collect()] == [(0, "x"), (2, None), (3, "y")]


def test_strip_prefix_collision(spark):
    df = spark.createDataFrame([(1, 2)], "home_id int, away_id int")
    with pytest.raises(ValueError):
        project.strip_prefix(df, "home_|away_")
    assert project.strip_prefix(df, "home_").columns == ["id", "away_id"]


def test_conform_extends_and_casts(spark):
    schema = project.extend_schema(T.StructType([T.StructField("a", T.LongType())]), ["a", "b"])
    assert got(project.conform(spark.createDataFrame([("7",)], "a string"), schema)) == [(7, None)]


def test_dots_to_underscores(spark):
    assert project.dots_to_underscores(spark.createDataFrame([(1,)], ["a.b"])).columns == ["a_b"]


def test_scd_join_keeps_fact_rows(spark):
    fact = spark.createDataFrame([(1, D(2024, 1, 5)), (1, D(2024, 3, 1)), (2, D(2024, 1, 1)), (None, None)], "k int, d date")
    dim = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 1, 31), "a"), (1, D(2024, 2, 1), D(9999, 12, 31), "b")], "k int, f date, t date, v string")
    out = joins.scd_join(fact, dim, "k", "d", "f", "t", ["v"])
    assert out.count() == fact.count()
    assert got(out.select("k", "v").filter("k = 1")) == [(1, "a"), (1, "b")]


def test_asof_join_equals_interval_join(spark):
    rows = [(k % 5 if k % 7 else None, D(2024, 1, 1) + dt.timedelta(days=(k * 37) % 300) if k % 11 else None, k) for k in range(200)]
    fact = spark.createDataFrame(rows, "k int, d date, n int")
    cuts = [(k, D(2024, 1, 10) + dt.timedelta(days=20 * i + (k or 0)), i) for k in (0, 1, 2, 4, None) for i in range(8)]
    dim = [(k, a, a + dt.timedelta(days=19 if i != 3 else -1), f"{k}-{i}") for k, a, i in cuts]  # version 3 holds no date
    dims = spark.createDataFrame(dim, "name int, f date, t date, v string")
    want = got(joins.scd_join(fact, dims, "k", "d", "f", "t", ["v"], "name", "x_"))
    assert got(joins.asof_join(fact, dims, "k", "d", "f", "t", ["v"], "name", "x_")) == want and len(want) == 200
    assert got(joins.asof_join(fact, dims.filter("false"), "k", "d", "f", "t", ["v"], "name")) == got(fact.withColumn("v", F.lit(None)))


def test_replace_changed_compares_hashes_of_one_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, h string")
    new = spark.createDataFrame([(2, "a"), (3, "b")], "k int, h string")
    assert got(scd.replace_changed(old, new, "k", "h")) == [(1, "a"), (2, "a"), (3, "b")]


def test_opponents_of_null_keys_and_several_sides(spark):
    df = spark.createDataFrame([("g", 1, 10), ("g", 2, 20), ("g", 3, 30), (None, 4, 1), (None, 5, 2), ("h", None, 7), ("h", 6, 8)], "e string, id int, pts int")
    pairs = got(joins.opponent_join(df, ["e"], "id", ["pts"]).select("id", "opp_id"))
    assert pairs == sorted([(1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2), (4, None), (5, None), (None, None), (6, None)], key=repr)


def test_opponent_and_missing_opponent(spark):
    df = spark.createDataFrame([("g1", 1, 10), ("g1", 2, 20), ("g2", 3, 5)], "e string, id int, pts int")
    out = joins.opponent_join(df, ["e"], "id", ["pts"])
    assert got(out.select("id", "opp_id", "opp_pts")) == [(1, 2, 20), (2, 1, 10), (3, None, None)]


def test_maybe_join(spark):
    df = spark.createDataFrame([(1,)], "k int")
    assert joins.maybe_join(spark, df, "no_such_table", "k").columns == ["k"]


def test_enrich_check(spark):
    df, dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(1,)], "k int")
    assert got(joins.enrich_check(df, dim, "k")) == [(1, "a"), (2, "b")]


def test_dedupe_and_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, None, "c")], "k int, o int, v string")
    assert got(windows.dedupe_latest(df, ["k"], [F.col("o").desc(), F.col("v").desc()])) == [(1, 5, "b"), (2, None, "c")]
    assert windows.top_n_per_group(df, ["k"], [F.col("o").desc()], 1).count() == 3


def test_change_flag_null_safe(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, "a"), (1, 4, None)], "k int, o int, v string")
    assert [r.changed for r in windows.change_flag(df, ["k"], ["o"], ["v"]).orderBy("o").collect()] == [1, 0, 1, 1]


def test_longest_streaks(spark):
    df = spark.createDataFrame([(1, i, w) for i, w in enumerate("WWLWWWL")] + [(2, 0, "L"), (3, 0, None)], "k int, o int, w string")
    assert got(windows.longest_streaks(df, ["k"], ["o"], F.col("w") == "W")) == [(1, 3), (2, 0), (3, 0)]


def test_ema_equals_recursion(spark):
    x = np.random.default_rng(1).integers(0, 50, 200)
    df = spark.createDataFrame([(1, i, int(v)) for i, v in enumerate(x)], "k int, o int, v int")
    out = [r.v_ema3 for r in windows.ema(df, ["k"], ["o"], "v").orderBy("o").collect()]
    s, want = float(x[0]), []
    for v in x:
        s = float(v) if not want else 0.5 * s + 0.5 * v
        want.append(s)
    assert np.allclose(out, want, atol=1e-6)


def test_ema_of_a_long_span_equals_recursion(spark):
    x = [1000.0] + [0.0] * 199
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(x)], "k int, o int, v double")
    out = [r.v_ema100 for r in windows.ema(df, ["k"], ["o"], "v", 100).orderBy("o").collect()]
    assert np.allclose(out, [1000 * (1 - 2 / 101) ** i for i in range(200)], atol=1e-6)


def test_adjust_pvalues(spark):
    p = [0.01, 0.02, 0.03, 0.04, 0.5]
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(p)], "g string, i int, p double")
    out = windows.adjust_pvalues(df, ["g"], "p", "i").orderBy("i").collect()
    assert np.allclose([r.p_bonferroni for r in out], [0.05, 0.1, 0.15, 0.2, 1.0])
    assert np.allclose([r.p_bh for r in out], [0.05, 0.05, 0.05, 0.05, 0.5])


FIXTURE = [
    (1, "AAA", "g1", D(2024, 10, 22)),
    (1, "AAA", "g1", D(2024, 10, 22)),
    (1, "BBB", "g2", D(2024, 11, 1)),
    (1, "AAA", "g3", D(2024, 11, 5)),
    (2, "BBB", "g1", D(2024, 10, 22)),
]


def test_scd2_from_events_blocks(spark):
    df = spark.createDataFrame(FIXTURE, "id int, team string, g string, d date")
    v = star.dim_scd2(df, "id", "d", ["team"], ["g"])
    rows = got(v.filter("id = 1").select("block", "team", "start_date", "valid_to", "is_current"))
    assert rows == [(1, "AAA", D(2024, 10, 22), D(2024, 10, 31), False), (2, "BBB", D(2024, 11, 1), D(2024, 11, 4), False), (3, "AAA", D(2024, 11, 5), D(9999, 12, 31), True)]
    assert quality.unique(v, ["version_key"]).first().failed == 0


BUSINESS = "k int, a string, b int"


def test_scd2_merge_cases(spark):
    b1 = spark.createDataFrame([(1, "x", 1), (2, "x", 1), (3, None, 1), (4, "v", 1), (5, "stay", 1)], BUSINESS)
    b2 = spark.createDataFrame([(1, "x", 1), (2, "y", 1), (3, "n", 1), (4, None, 1), (6, "new", 1), (6, "new", 1)], BUSINESS)
    for detector in ("hash", "columns"):
        t = scd.scd2_start(b1, ["k"], ["a", "b"], "2024-01-01")
        m = scd.scd2_merge(t, b2, ["k"], ["a", "b"], "2024-02-01", detector)
        current = got(m.filter("is_current").select("k", "a"))
        assert current == [(1, "x"), (2, "y"), (3, "n"), (4, None), (5, "stay"), (6, "new")]
        assert got(m.filter("not is_current").select("k", "a", "record_end_date")) == [(2, "x", D(2024, 2, 1)), (3, None, D(2024, 2, 1)), (4, "v", D(2024, 2, 1))]
        again = scd.scd2_merge(m, b2, ["k"], ["a", "b"], "2024-03-01", detector)
        assert got(again) == got(m)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", None]), st.integers(0, 2)), max_size=6), min_size=1, max_size=3))
def test_scd2_merge_invariants(spark, batches):
    t = scd.scd2_start(spark.createDataFrame([], BUSINESS), ["k"], ["a", "b"], "2024-01-01")
    keys = set()
    for i, rows in enumerate(batches):
        keys |= {r[0] for r in rows}
        t = spark.createDataFrame(scd.scd2_merge(t, spark.createDataFrame(rows, BUSINESS), ["k"], ["a", "b"], f"2024-0{i + 2}-01").collect(), t.schema)
    assert sorted(r.k for r in t.filter("is_current").collect()) == sorted(keys)
    spans = [(r.k, r.record_start_date, r.record_end_date or D(9999, 1, 1)) for r in t.collect()]
    for a in spans:
        for b in spans:
            if a is not b and a[0] == b[0]:
                assert a[2] <= b[1] or b[2] <= a[1]


def test_upsert_and_replace(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    u = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e"), (None, "m")], "k int, v string")
    assert got(scd.upsert(t, u, ["k"], [F.col("v").desc()])) == [(1, "a"), (2, "d"), (3, "e"), (None, "m")]
    h = lambda df: df.withColumn("h", scalars.row_hash(["k", "v"]))
    assert got(scd.replace_changed(h(t), h(u.filter("v in ('c', 'e')")), "k", "h").select("k", "v")) == [(1, "a"), (2, "c"), (3, "e"), (None, "n")]


def test_late_events_rebuild_touched_keys(spark):
    df = spark.createDataFrame(FIXTURE, "id int, team string, g string, d date")
    old, late = df.filter("g <> 'g2'"), df.filter("g = 'g2'")
    history = scd.scd2_from_events(old, ["id"], "d", ["team"])
    assert got(scd.merge_events(history, old, late, ["id"], "d", ["team"])) == got(scd.scd2_from_events(df, ["id"], "d", ["team"]))


def test_group_sums_equal_member_sums(spark, sf):
    from gamelake.plans.base import box, group_events

    b = box(spark, sf)
    assert b.agg(F.sum("pts"), F.sum("fga")).first() == group_events(b).agg(F.sum("pts"), F.sum("fga")).first()


def test_sets(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "y int")
    assert got(sets.union_missing([a, b])) == [(1, None), (None, 2)]
    wide = spark.createDataFrame([(1, 10, 20)], "e int, home_id int, away_id int")
    assert got(sets.unpivot_sides(wide, ["e"], ["id"])) == [(1, "away", 20), (1, "home", 10)]


def test_text(spark):
    df = spark.createDataFrame([("P", 0, True, D(2024, 10, 22)), ("P", 1, False, None), ("P", 3, None, None), ("P", None, None, None)], "n string, k int, f boolean, d date")
    out = text.row_sentences(df, "n", {"k": ("had none.", "had one.", "had {n}.")})
    assert [r.k_text for r in out.collect()] == ["P had none.", "P had one.", "P had 3.", "P had none."]
    assert text.profile_text(df, {"n": "Name", "f": "Flag"}).first().profile == "Name: P; Flag: Yes"
    assert df.select(text.date_text(F.col("d"))).first()[0] == "October 22nd, 2024"


def test_quality(spark):
    df = spark.createDataFrame([(1, -1.0), (1, 5.0), (None, None)], "k int, x double")
    assert got(quality.run_checks(df, [quality.not_null("k"), quality.in_range("x", 0, 4), quality.not_negative("x")])) == [("not_negative", "x", 1, 3), ("not_null", "k", 1, 3), ("range", "x", 2, 3)]
    assert quality.unique(df, ["k"]).first().failed == 1
    assert quality.drift(df, df, "x", -2, 6, 4).first().psi == 0.0


def test_aggregates_on_empty(spark):
    df = spark.createDataFrame([], "k int, x int, d date")
    assert aggregates.leaders(df, ["k"], F.sum("x"), "t", 3).count() == 0
    assert aggregates.is_active(df, "k", "d").count() == 0
    assert aggregates.kpi(df, "x").first().n == 0


def test_result_set(spark):
    doc = '{"resource":"r","parameters":{"Season":"2024-25"},"resultSets":[{"name":"Games","headers":["GAME_ID","GAME_DATE","TEAM_ID"],"rowSet":[["12345","2025-02-14","1610612737"],["12346","2025-02-15","1610612738"]]}]}'
    df = spark.createDataFrame([(doc,)], "value string")
    out = documents.decode_result_set(df, "Games", {"GAME_ID": "long", "GAME_DATE": "date", "TEAM_ID": "long"}, ["Season"])
    assert got(out) == [(12345, D(2025, 2, 14), 1610612737, "2024-25"), (12346, D(2025, 2, 15), 1610612738, "2024-25")]
    assert planning.high_water_mark(out, "game_date", "1990-01-01").first()[0] == D(2025, 2, 15)
    bad = '{"resource":"","parameters":{},"resultSets":[{"name":"Games","headers":[],"rowSet":[]}]}'
    both = spark.createDataFrame([(doc,), (bad,), ("no json",)], "value string").select(F.from_json("value", documents.RESULT_SET).alias("d"))
    good, rejects = documents.validate(both, documents.result_set_rules())
    assert good.count() == 1 and rejects.count() == 2


def test_nested_order(spark):
    doc = '{"order_id":"o1","line_items":[{"line_id":1,"product_id":"p","quantity":2,"unit_price":1.5}],"shipments":[{"shipment_id":"s","carrier":"c","items":[{"line_id":1,"quantity":2}]}],"status_history":[{"status":"new","at":"2024-01-01T00:00:00Z"}]}'
    orders = documents.parse_orders(spark.createDataFrame([(doc,), ('{"order_id":"o2"}',)], "value string"))
    assert got(documents.order_lines(orders).select("order_id", "quantity")) == [("o1", 2), ("o2", None)]
    assert got(documents.order_shipments(orders).select("order_id", "carrier", "quantity")) == [("o1", "c", 2), ("o2", None, None)]
    assert got(documents.order_history(orders).select("order_id", "step", "status")) == [("o1", 0, "new"), ("o2", None, None)]
    assert got(documents.explode_path(orders, "line_items", ["order_id"]).select("order_id", "product_id")) == [("o1", "p")]


def test_offsets(spark, tmp_path):
    rec = spark.createDataFrame([("t", 0, 5), ("t", 0, 6), ("t", 1, 2)], "topic string, partition int, offset long")
    nxt = topics.next_offsets(rec)
    topics.save_offsets(nxt.filter("partition = 0"), str(tmp_path / "ledger"), 1)
    topics.save_offsets(nxt, str(tmp_path / "ledger"), 2)
    assert topics.load_offsets(spark, str(tmp_path / "ledger")).first().partition_offsets == '{"0":7,"1":3}'
    assert topics.starting_offsets({"t": {"0": 7}}, "t", [0, 1]) == '{"t": {"0": 7, "1": -2}}'
    more = spark.createDataFrame([("t", 0, 6), ("t", 0, 7), ("t", 2, 0)], "topic string, partition int, offset long")
    assert got(topics.resume(more, nxt).select("partition", "offset")) == [(0, 7), (2, 0)]


def test_chunks(spark):
    r = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 10))], "s date, e date")
    c = planning.date_chunks(r, "s", "e", 4).select("chunk_start", "chunk_end")
    assert got(c) == [(D(2024, 1, 1), D(2024, 1, 4)), (D(2024, 1, 5), D(2024, 1, 8)), (D(2024, 1, 9), D(2024, 1, 10))]
    assert planning.missing_chunks(c, c.limit(1)).count() == 2
    old = spark.createDataFrame([(D(2024, 1, 1),)], "high_water_mark date")
    assert planning.advance_mark(old, r.filter("false"), "s").first()[0] == D(2024, 1, 1)


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "k int, v string, part string")
    path = str(tmp_path / "t")
    tables.append(df, path, ["part"])
    tables.overwrite(df.filter("part = 'q'").withColumn("v", F.lit("c")), path, ["part"])
    assert got(tables.read_table(spark, path).select("k", "v")) == [(1, "a"), (2, "c")]
    root = str(tmp_path / "versions")
    tables.write_version(df, root)
    tables.write_version(tables.read_version(spark, root).filter("k = 1"), root)
    assert got(tables.read_version(spark, root).select("k")) == [(1,)]
    assert tables.export_csv(df, str(tmp_path / "csv"), 10**9) and not tables.export_csv(df, str(tmp_path / "csv2"), 0)
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    tables.ensure_table(spark, "lake.one", df.schema, ["part"])
    tables.ensure_table(spark, "lake.one", df.schema, ["part"])
    tables.append_partitioned(df, "lake.two", "part")
    assert tables.load_database(spark, "lake").filter("source_table = 'two'").count() == 2
    spark.sql("DROP DATABASE lake CASCADE")


class StubReader:
    """Records what a Kafka reader is told; gives the records of a file twin."""

    def __init__(self, df):
        self.df, self.told = df, {}

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def load(self):
        return self.df


def test_kafka_readers_tell_their_options(spark):
    raw = spark.createDataFrame([("t", 0, 5, dt.datetime(2024, 1, 1), bytearray(b"{}"), bytearray(b"k"))], "topic string, partition int, offset long, timestamp timestamp, value binary, key binary")

    class Session:
        read, readStream = StubReader(raw), StubReader(raw)

    out = topics.read_topic_batch(Session, "host:9092", "t", '{"t":{"0":5}}')
    assert out.columns == ["topic", "partition", "offset", "timestamp", "value"] and out.first().value == "{}"
    assert Session.read.told == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "t", "failOnDataLoss": "false", "startingOffsets": '{"t":{"0":5}}', "endingOffsets": "latest"}
    assert topics.read_topic_stream(Session, "host:9092", "t", per_trigger=10).columns == out.columns
    assert Session.readStream.told == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "t", "failOnDataLoss": "false", "startingOffsets": "latest", "maxOffsetsPerTrigger": 10}


def test_numeric_columns(spark):
    df = spark.createDataFrame([(1, "a", 2.0, True)], "k int, s string, d double, b boolean")
    assert project.numeric_cols(df, ["k"]) == ["d"] and project.numeric_cols(df) == ["k", "d"]


def test_series_in_pieces(spark):
    df = spark.createDataFrame([(k, i, 10 * k + i if i != 3 else None) for k in (1, 2) for i in range(5 * k)], "k int, o int, v int")
    out = {(r.k, r.piece): r.series for r in aggregates.collect_series(df, "k", ["o"], "v", 4).collect()}
    assert out == {(1, 0): [10, 11, 12, None], (1, 1): [14], (2, 0): [20, 21, 22, None], (2, 1): [24, 25, 26, 27], (2, 2): [28, 29]}


def test_vectors(spark):
    a = spark.createDataFrame([(1, [1.0], 1), (2, [2.0], 1)], "id int, v array<double>, version int")
    assert got(tables.upsert_vectors(a, spark.createDataFrame([(2, [3.0], 2)], a.schema), "id", "version")) == [(1, [1.0], 1), (2, [3.0], 2)]


def test_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    schema = "id long, ts timestamp"
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, t(1)), (2, t(12)), (3, t(31))], schema).coalesce(1).write.parquet(src)
    counts = streams.window_counts(streams.with_lateness(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), "ts"), "ts")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    streams.stream_append(counts, out, ck, once=True).awaitTermination()
    spark.createDataFrame([(4, t(5)), (5, t(59))], schema).coalesce(1).write.mode("append").parquet(src)
    streams.stream_append(counts, out, ck, once=True).awaitTermination()
    rows = {r.window_start: r.n for r in spark.read.parquet(out).collect()}
    assert rows[dt.datetime(2024, 1, 1, 0, 0)] == 1  # the late row of minute 5 isn't counted
    assert rows[dt.datetime(2024, 1, 1, 0, 10)] == 1


def test_stream_upsert_applies_each_batch_once(spark, tmp_path):
    root, src, ck = str(tmp_path / "t"), str(tmp_path / "in"), tmp_path / "ck"
    add = lambda old, new: new if old is None else old.unionByName(new)

    def put(k):
        spark.createDataFrame([(k, 10 * k)], "k long, v long").coalesce(1).write.mode("append").parquet(src)

    def run(folder, merge=add):
        streams.stream_upsert(spark.readStream.schema("k long, v long").parquet(src), root, str(folder), merge, once=True).awaitTermination()

    def forget(batch):
        """The query stopped after the batch's version was published and before its checkpoint said so."""
        for f in (ck / "commits").glob(f"*{batch}*"):
            f.unlink()

    def ks():
        return sorted(r.k for r in tables.read_version(spark, root).collect())

    put(1)
    run(ck)
    assert ks() == [1] and tables.versions(spark, root).count() == 1
    forget(0)
    run(ck)
    assert ks() == [1] and tables.versions(spark, root).count() == 1

    def fails(old, new):
        raise RuntimeError("stopped before the version was published")

    put(2)
    with pytest.raises(Exception, match="stopped before"):
        run(ck, fails)
    assert ks() == [1]
    run(ck)
    assert ks() == [1, 2]
    put(3)
    run(tmp_path / "new", lambda old, new: old.unionByName(new).distinct())  # a new checkpoint: its batch 0 holds a new row
    assert ks() == [1, 2, 3]


def test_fan_out_keeps_rows_of_other_queries(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in (1, 2):
        spark.createDataFrame([(k,)], "k long").coalesce(1).write.mode("overwrite").parquet(src)
        streams.fan_out(spark.readStream.schema("k long").parquet(src), {out: lambda b: b}, str(tmp_path / f"ck{k}"), once=True).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2]


def test_newest_version_is_the_last_one(spark, tmp_path):
    root = str(tmp_path / "t")
    for k in range(5):
        tables.write_version(spark.range(k, k + 1), root)
    assert tables.read_version(spark, root).first()[0] == 4
    assert [r.number for r in tables.versions(spark, root).orderBy("number").collect()] == [1, 2, 3, 4, 5]


def test_widen_batch(spark):
    df = spark.createDataFrame([('{"a":"1"}',), ('{"b":"2"}',)], "value string")
    assert streams.widen_batch(df, ["z"]).columns == ["z", "a", "b"]


def test_features(spark):
    df = spark.createDataFrame([(1, i, float(i % 4)) for i in range(20)] + [(2, 0, 1.0), (3, 0, None)], "k int, o int, v double")
    waves = {(r.k, r.o): r.v_wave for r in features.wave_features(df, ["k"], ["o"], "v").collect()}
    assert waves[(2, 0)] == [0.0] * 4 and any(waves[(1, 19)])
    s = spectra.spectral_features(df, "k", ["o"], ["v"])
    assert {r.k: r.n for r in s.collect()} == {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    assert features.grouped_ar(df, "k", ["o"], "v").filter("k = 2").count() == 0
    sample = features.stratified_sample(df, ["k"], ["o"], 5)
    assert got(sample.groupBy("k").count()) == [(1, 5), (2, 1), (3, 1)]
    assert got(sample) == got(features.stratified_sample(df.repartition(3), ["k"], ["o"], 5))


def test_models(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    df = spark.createDataFrame([(i, *map(float, r), float(3 * r[0] - r[1]), int(r[0] > 0)) for i, r in enumerate(x)], "id int, a double, b double, c double, y double, win int")
    kept = {r.feature for r in M.lasso_select(df, "y", ["a", "b", "c"], 0.05, 2, (0.01,)).collect()}
    assert {"a", "b"} <= kept and "c" not in kept
    scored = M.score(df, M.fit_classifier(df, "win", ["a", "b", "c"], depths=(2,), rounds=5), "t")
    assert M.auc(scored, "win") > 0.95
    clusters = M.assign_clusters(df, M.fit_kmeans(df, ["a", "b"], [2], [5], 2))
    assert clusters.select("cluster").distinct().count() == 2
    stacked = M.regression_metrics(M.stack_models(df, "y", ["a", "b"], "id"), "y", "stacked").first()
    assert stacked.r2 > 0.9
    m = M.interval_metrics(spark.createDataFrame([(5.0, 0.0, 10.0), (20.0, 0.0, 10.0)], "y double, l double, h double"), "y", "l", "h").first()
    assert (m.picp, m.winkler) == (0.5, 110.0)


def test_whole_ratio_is_the_rounded_ratio(spark):
    """Ties included: odd numbers over 32, 160, 800 and 20,000."""
    df = spark.range(40_000).select((F.col("id") * 7919 % 20_011 - 3000).alias("n"), F.element_at(F.array(*(F.lit(d) for d in (32, 160, 800, 20_000, 0, -32, 7, 9_973))), (F.col("id") % 8 + 1).cast("int")).alias("d"))
    df = df.unionByName(spark.createDataFrame([(None, 3), (3, None)], "n long, d int"))
    slow = F.when(F.col("n").isNull() & F.col("d").isNotNull(), 0.0).otherwise(scalars.safe_ratio(F.col("n"), F.col("d"), 4, 0.0))
    assert df.filter(~scalars.whole_ratio(F.col("n"), F.col("d")).eqNullSafe(slow)).count() == 0


def test_sides_meet_their_versions_once(spark):
    """Versions are found for different sides and dates; sides or dates that are null have none."""
    d = dt.date
    dim = spark.createDataFrame([("x", d(2024, 1, 1), d(2024, 1, 4), "x1"), ("x", d(2024, 1, 5), d(9999, 12, 31), "x2"), ("y", d(2024, 1, 3), d(9999, 12, 31), "y1")], "nick string, start_date date, valid_to date, version_key string")
    events = [(1, d(2024, 1, 4), "x", "y"), (2, d(2024, 1, 5), "y", "x"), (3, d(2024, 1, 2), "y", "x"), (4, None, "x", "y"), (5, d(2024, 1, 5), None, "z"), (6, d(2024, 1, 4), "x", "y")]
    out = star.side_versions(spark.createDataFrame(events, "e int, event_date date, home string, away string"), dim, "nick")
    assert out.columns == ["e", "event_date", "home", "away", "home_version_key", "away_version_key"]
    assert {r.e: r[4:] for r in out.collect()} == {1: ("x1", "y1"), 2: ("y1", "x2"), 3: (None, "x1"), 4: (None, None), 5: (None, None), 6: ("x1", "y1")}
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()  # events pass by: only pairs are ordered
