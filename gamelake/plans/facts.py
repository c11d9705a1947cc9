"""Queries on the star schema, facts, merges and cumulative tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.functions import scalars
from gamelake.operators import aggregates, joins, project, scd, windows
from gamelake.plans import star
from gamelake.plans.base import BOX_SQL, GROUP_SQL, ORDER, STATS, WITH, box, group_events, query, raw, table, written  # noqa: F401

S = SparkSession


def _ratio(n: str, d: str, digits: int = 4, zero: str = "0.0") -> str:
    return f"CASE WHEN coalesce({d}, 0) = 0 THEN {zero} ELSE round(CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE), {digits}) END"


def _poss(p: str = "") -> str:
    return f"(CAST({p}fga AS DOUBLE) + 0.44 * CAST({p}fta AS DOUBLE) + CAST({p}tov AS DOUBLE))"


_TS = _ratio("pts", "(2 * (CAST(fga AS DOUBLE) + 0.44 * CAST(fta AS DOUBLE)))")
_EFG = _ratio("(CAST(fgm AS DOUBLE) + 0.5 * CAST(fg3m AS DOUBLE))", "fga")


@query(
    f"""{WITH}, g AS ({GROUP_SQL})
SELECT group_id, CAST(sum(pts) AS BIGINT) AS pts, CAST(sum(fga) AS BIGINT) AS fga,
  {_ratio('sum(pts)', '(2 * (CAST(sum(fga) AS DOUBLE) + 0.44 * CAST(sum(fta) AS DOUBLE)))')} AS true_shooting,
  {_ratio('100 * sum(pts)', '(CAST(sum(fga) AS DOUBLE) + 0.44 * CAST(sum(fta) AS DOUBLE) + CAST(sum(tov) AS DOUBLE))')} AS offensive_rating
FROM g GROUP BY group_id ORDER BY pts DESC, group_id LIMIT 20"""
)
def group_leaders(spark: S, sf: str) -> DataFrame:
    """Dedupe, roll up to groups, ratios, leaders."""
    from gamelake.functions import advanced

    g = group_events(box(spark, sf)).groupBy("group_id").agg(*(F.sum(s).alias(s) for s in ("pts", "fga", "fta", "tov")))
    top = g.orderBy(F.col("pts").desc(), "group_id").limit(20)
    poss = scalars.possessions(F.col("fga"), F.col("fta"), F.col("tov"))
    return top.select("group_id", "pts", "fga", advanced.true_shooting(F.col("pts"), F.col("fga"), F.col("fta")).alias("true_shooting"), scalars.safe_ratio(100 * F.col("pts"), poss, 4, 0.0).alias("offensive_rating"))


@query(f"{WITH} SELECT member_id, season, event_id, line_no, group_id, fga, cents FROM box")
def dedupe_latest_boxscore(spark: S, sf: str) -> DataFrame:
    return box(spark, sf).select("member_id", "season", "event_id", "line_no", "group_id", "fga", "cents")


@query(f"{WITH} {GROUP_SQL}")
def group_rollup(spark: S, sf: str) -> DataFrame:
    return group_events(box(spark, sf))


@query(
    f"""{WITH}, g AS ({GROUP_SQL}) SELECT group_id, season, event_id, season_type, {_poss()} AS possessions,
  {_ratio('fgm', 'fga', 3, 'NULL')} AS fg_pct, {_ratio('fg3m', 'fg3a', 3, 'NULL')} AS fg3_pct, {_ratio('ftm', 'fta', 3, 'NULL')} AS ft_pct FROM g"""
)
def group_rollup_ratios(spark: S, sf: str) -> DataFrame:
    c = F.col
    return group_events(box(spark, sf)).select(
        "group_id", "season", "event_id", "season_type", scalars.possessions(c("fga"), c("fta"), c("tov")).alias("possessions"),
        *(scalars.safe_ratio(c(a), c(b)).alias(n) for n, a, b in (("fg_pct", "fgm", "fga"), ("fg3_pct", "fg3m", "fg3a"), ("ft_pct", "ftm", "fta"))),
    )


_MATCH = """matches AS (
  SELECT DISTINCT l_orderkey AS event_id, CAST(o_orderdate AS DATE) AS event_date, CAST(year(o_orderdate) AS INT) AS season, o_orderpriority AS season_type,
    cn.n_name || CASE WHEN l_suppkey % 2 = 0 THEN ' @ ' ELSE ' vs. ' END || sn.n_name AS matchup
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey),
parsed AS (SELECT *, CASE WHEN contains(matchup, ' @ ') THEN split_part(matchup, ' @ ', 2) ELSE split_part(matchup, ' vs. ', 1) END AS home,
  CASE WHEN contains(matchup, ' @ ') THEN split_part(matchup, ' @ ', 1) ELSE split_part(matchup, ' vs. ', 2) END AS away FROM matches)"""


def matchups(spark: S, sf: str) -> DataFrame:
    """Events with a matchup text: the customer's nation against the supplier's."""
    lines, orders, nation = table(spark, sf, "lineitem"), table(spark, sf, "orders"), table(spark, sf, "nation")
    cust = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("c_name"))
    supp = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("s_nation"))
    # what a line tells is its supplier's nation and the form of the text: few pairs an order, which meet the orders
    # (those with their customers first) where they lie by order, as does what follows by event
    told = lines.join(supp, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "s_nation", (F.col("l_suppkey") % 2 == 0).alias("away_form")).repartition("l_orderkey").distinct()
    owned = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").join(cust, F.col("o_custkey") == F.col("c_custkey"))
    j = told.join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
    text = F.concat("c_name", F.when(F.col("away_form"), " @ ").otherwise(" vs. "), "s_nation")
    return j.select(F.col("l_orderkey").alias("event_id"), F.to_date("o_orderdate").alias("event_date"), F.year("o_orderdate").alias("season"), F.col("o_orderpriority").alias("season_type"), text.alias("matchup"))


@query(f"WITH {_MATCH} SELECT event_id, matchup, home, away FROM parsed")
def home_away_parse(spark: S, sf: str) -> DataFrame:
    home, away = scalars.home_away(F.col("matchup"))
    return matchups(spark, sf).select("event_id", "matchup", home.alias("home"), away.alias("away"))


@query(
    f"""WITH {_MATCH}, counted AS (SELECT event_id, count(*) AS pairs, min(struct_pack(home := home, away := away)) AS v FROM (SELECT DISTINCT event_id, home, away FROM parsed) GROUP BY event_id)
SELECT event_id, h.n_nationkey AS home_id, a.n_nationkey AS away_id, v.home AS home, v.away AS away FROM counted JOIN nation h ON h.n_name = v.home JOIN nation a ON a.n_name = v.away
WHERE pairs = 1 AND h.n_nationkey <> a.n_nationkey"""
)
def validated_games(spark: S, sf: str) -> DataFrame:
    home, away = scalars.home_away(F.col("matchup"))
    parsed = matchups(spark, sf).select("event_id", home.alias("home"), away.alias("away"))
    counted = aggregates.pick_and_count(parsed, "event_id", ["home", "away"])
    names = table(spark, sf, "nation").select("n_nationkey", "n_name")
    for side in ("home", "away"):
        counted = counted.join(names.select(F.col("n_nationkey").alias(f"{side}_id"), F.col("n_name").alias(side)), side, "left")
    return project.validated_events(counted).select("event_id", "home_id", "away_id", "home", "away")


_SIDES = """sides AS (SELECT o_orderkey AS event_id, CASE WHEN o_orderkey % 3 = 0 THEN 'home' ELSE 'away' END AS side, o_custkey AS id FROM orders
  UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'away' ELSE 'home' END, o_custkey + 1 FROM orders WHERE o_orderkey % 5 <> 0)"""


def _sides(spark: S, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("id"))
    third = F.col("event_id") % 3 == 0
    a = o.select("event_id", F.when(third, "home").otherwise("away").alias("side"), "id")
    b = o.filter(F.col("event_id") % 5 != 0).select("event_id", F.when(third, "away").otherwise("home").alias("side"), (F.col("id") + 1).alias("id"))
    return o.select("event_id", F.lit("home").alias("home"), F.lit("away").alias("away")), a.unionByName(b)


@query(f"WITH {_SIDES} SELECT o_orderkey AS event_id, h.id AS home_id, a.id AS away_id FROM orders LEFT JOIN sides h ON h.event_id = o_orderkey AND h.side = 'home' LEFT JOIN sides a ON a.event_id = o_orderkey AND a.side = 'away'")
def attach_sides(spark: S, sf: str) -> DataFrame:
    events, sides = _sides(spark, sf)
    return joins.attach_sides(events, sides, "event_id", "side", cols=["id"]).select("event_id", "home_id", "away_id")


@query(f"WITH {_MATCH} SELECT md5(CAST(event_id AS VARCHAR)) AS event_key, event_id, event_date, matchup, season, season_type, home, away FROM parsed")
def dim_event(spark: S, sf: str) -> DataFrame:
    return star.dim_event(matchups(spark, sf))


@query(f"{WITH} SELECT md5(CAST(season AS VARCHAR) || '_' || season_type) AS season_key, season, season_type, min(event_date) AS start_date, max(event_date) AS end_date FROM box GROUP BY ALL")
def dim_period(spark: S, sf: str) -> DataFrame:
    return star.dim_period(box(spark, sf))


def _scd_sql(key: str, attr: str, source: str = "box") -> str:
    return f"""flagged AS (SELECT {key}, event_date, {attr}, CASE WHEN row_number() OVER w > 1 AND {attr} IS NOT DISTINCT FROM lag({attr}) OVER w THEN 0 ELSE 1 END AS changed
  FROM (SELECT * FROM {source}) WINDOW w AS (PARTITION BY {key} ORDER BY event_date, event_id, {attr})),
blocked AS (SELECT *, sum(changed) OVER (PARTITION BY {key} ORDER BY event_date, eid, {attr} ROWS UNBOUNDED PRECEDING) AS block FROM (
  SELECT {key}, event_date, event_id AS eid, {attr}, CASE WHEN row_number() OVER w > 1 AND {attr} IS NOT DISTINCT FROM lag({attr}) OVER w THEN 0 ELSE 1 END AS changed FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY event_date, event_id, {attr}))),
ranges AS (SELECT {key}, block, {attr}, min(event_date) AS start_date, max(event_date) AS end_date FROM blocked GROUP BY ALL),
versions AS (SELECT {key}, CAST(block AS BIGINT) AS block, {attr}, start_date, end_date, lead(start_date) OVER (PARTITION BY {key} ORDER BY block) AS next_start,
  lead(block) OVER (PARTITION BY {key} ORDER BY block) IS NULL AS is_current, md5(CAST({key} AS VARCHAR) || '-' || CAST({attr} AS VARCHAR)) AS row_hash, md5(CAST({key} AS VARCHAR) || '_' || CAST(CAST(block AS BIGINT) AS VARCHAR)) AS version_key,
  coalesce(CAST(lead(start_date) OVER (PARTITION BY {key} ORDER BY block) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to FROM ranges)"""


_STATUS = "status_events AS (SELECT group_id, event_date, event_id, min(status) AS status FROM box GROUP BY ALL)"


def _group_versions(events: DataFrame) -> DataFrame:
    return star.dim_scd2(events.select("group_id", "event_date", "event_id", "status"), "group_id", "event_date", ["status"], ["event_id"])


@query(f"{WITH}, {_scd_sql('member_id', 'group_id')} SELECT * FROM versions")
def dim_member_scd2(spark: S, sf: str) -> DataFrame:
    b = written(box(spark, sf).select("member_id", "event_date", "event_id", "group_id"), "box")
    return star.dim_scd2(b, "member_id", "event_date", ["group_id"], ["event_id"])


@query(f"{WITH}, {_STATUS}, {_scd_sql('group_id', 'status', 'status_events')} SELECT * FROM versions")
def dim_group_scd2(spark: S, sf: str) -> DataFrame:
    return _group_versions(written(box(spark, sf).groupBy("group_id", "event_date", "event_id").agg(F.min("status").alias("status")), "statuses"))


_FACT = ("fga", "fgm", "pts", "reb", "ast")


@query(
    f"""{WITH}, b AS (SELECT *, sum(changed) OVER (PARTITION BY member_id ORDER BY event_date, event_id ROWS UNBOUNDED PRECEDING) AS block FROM (
  SELECT *, CASE WHEN group_id IS NOT DISTINCT FROM lag(group_id) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS changed FROM box WINDOW w AS (PARTITION BY member_id ORDER BY event_date, event_id)))
SELECT member_id || '_' || season || '_' || event_id AS fact_key, member_id, group_id, event_id, event_date, season, {', '.join(_FACT)},
  md5({" || '-' || ".join(f'CAST({c} AS VARCHAR)' for c in ('member_id', 'group_id', 'event_id', *_FACT))}) AS row_hash,
  min(event_date) OVER (PARTITION BY member_id, block) AS block_start, max(event_date) OVER (PARTITION BY member_id, block) AS block_end FROM b"""
)
def fact_member(spark: S, sf: str) -> DataFrame:
    return star.fact_member(box(spark, sf), _FACT)


@query(
    f"""{WITH}, {_STATUS}, {_scd_sql('group_id', 'status', 'status_events')}, g AS ({GROUP_SQL}), p AS (SELECT season, season_type, min(event_date) AS s, max(event_date) AS e FROM box GROUP BY ALL)
SELECT g.*, v.version_key, md5(CAST(g.season AS VARCHAR) || '_' || g.season_type) AS season_key, md5(CAST(g.event_id AS VARCHAR)) AS event_key, g.group_id || '_' || g.season || '_' || g.event_id AS fact_key
FROM g LEFT JOIN versions v ON v.group_id = g.group_id AND g.event_date BETWEEN v.start_date AND v.valid_to LEFT JOIN p ON p.season = g.season AND p.season_type = g.season_type AND g.event_date BETWEEN p.s AND p.e"""
)
def fact_group(spark: S, sf: str) -> DataFrame:
    events = table(spark, sf, "orders").select(F.col("o_orderkey").alias("event_id")).distinct().withColumn("event_key", scalars.surrogate_key(["event_id"]))
    # rows lie by event until they are written, so they meet their events where they are
    keyed = joins.dimension_join(group_events(box(spark, sf), F.min("status").alias("status")), events, "event_id", ["event_key"])
    groups = written(keyed, "groups")
    return star.fact_group(groups.drop("status"), written(_group_versions(groups), "versions"), star.dim_period(groups))


_NATIONS = """nation_events AS (SELECT sn.n_name AS nation, CAST(o_orderdate AS DATE) AS event_date, l_orderkey AS event_id, min(l_linestatus) AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY ALL)"""


@query(
    f"""WITH {_MATCH}, {_NATIONS}, {_scd_sql('nation', 'status', 'nation_events')}
SELECT p.event_id, p.event_date, p.home, p.away, h.version_key AS home_version_key, a.version_key AS away_version_key FROM (SELECT DISTINCT event_id, event_date, home, away FROM parsed) p
LEFT JOIN versions h ON h.nation = p.home AND p.event_date BETWEEN h.start_date AND h.valid_to LEFT JOIN versions a ON a.nation = p.away AND p.event_date BETWEEN a.start_date AND a.valid_to"""
)
def fact_sides(spark: S, sf: str) -> DataFrame:
    """The versions of both sides of an event, found by the sides' names."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    supp = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("nation"))
    j = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
    statuses = j.groupBy("nation", F.to_date("o_orderdate").alias("event_date"), F.col("l_orderkey").alias("event_id")).agg(F.min("l_linestatus").alias("status"))
    dim = star.dim_scd2(written(statuses, "statuses"), "nation", "event_date", ["status"], ["event_id"])
    home, away = scalars.home_away(F.col("matchup"))
    events = matchups(spark, sf).select("event_id", "event_date", home.alias("home"), away.alias("away")).distinct()
    return star.side_versions(written(events, "sides"), written(dim, "nations"), "nation")


_SHARE = ", ".join(f"{_ratio('b.' + s, 'g.' + s)} AS {s}_share" for s in STATS)


@query(
    f"""{WITH}, g AS ({GROUP_SQL}) SELECT b.member_id, b.group_id, b.season, b.event_id, b.season_type,
  {_ratio('b.pts', '(2 * (CAST(b.fga AS DOUBLE) + 0.44 * CAST(b.fta AS DOUBLE)))')} AS true_shooting,
  {_ratio('(CAST(b.fgm AS DOUBLE) + 0.5 * CAST(b.fg3m AS DOUBLE))', 'b.fga')} AS effective_fg,
  {_ratio('100 * ' + _poss('b.'), _poss('g.'))} AS usage_pct, {_SHARE}
FROM box b LEFT JOIN g ON b.group_id = g.group_id AND b.season = g.season AND b.event_id = g.event_id AND b.season_type = g.season_type"""
)
def member_advanced(spark: S, sf: str) -> DataFrame:
    b = box(spark, sf)
    return star.member_advanced(b, group_events(b))


_GAME = ", ".join(f"{_ratio('g.' + s, f'(g.{s} + coalesce(o.{s}, 0))')} AS {s}_game_share" for s in STATS)


@query(
    f"""{WITH}, g AS ({GROUP_SQL}) SELECT g.group_id, g.season, g.event_id, g.season_type, coalesce(o.group_id, -1) AS opponent_id,
  {_ratio('g.pts', '(2 * (CAST(g.fga AS DOUBLE) + 0.44 * CAST(g.fta AS DOUBLE)))')} AS true_shooting,
  {_ratio('(CAST(g.fgm AS DOUBLE) + 0.5 * CAST(g.fg3m AS DOUBLE))', 'g.fga')} AS effective_fg,
  {_ratio('g.fg3a', 'g.fga')} AS three_point_rate, {_ratio('g.tov', _poss('g.'))} AS turnover_pct, {_ratio('100 * g.pts', _poss('g.'))} AS offensive_rating, {_ratio('g.fta', 'g.fga')} AS free_throw_rate, {_GAME}
FROM g LEFT JOIN g o ON g.season = o.season AND g.event_id = o.event_id AND g.season_type = o.season_type AND g.group_id <> o.group_id"""
)
def group_advanced(spark: S, sf: str) -> DataFrame:
    return star.group_advanced(group_events(box(spark, sf)))


# Merges: two batches are made of the orders, split at a date; a later batch has other statuses.
_B1 = "b1 AS (SELECT o_custkey AS id, max(o_orderstatus) AS status, CAST(count(*) AS INT) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY o_custkey)"
_B2 = "b2 AS (SELECT o_custkey AS id, max(o_orderstatus) AS status, CAST(count(*) AS INT) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY o_custkey)"
_HASH = "sha256(coalesce(status, '_null_') || '||' || CAST(n AS VARCHAR))"


def _batches(spark: S, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders")
    cut = F.lit("1998-01-01").cast("timestamp")
    return tuple(o.filter(c).groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderstatus").alias("status"), F.count("*").cast("int").alias("n")) for c in (F.col("o_orderdate") < cut, F.col("o_orderdate") >= cut))


def _merge_sql(differs: str) -> str:
    return f"""WITH {_B1}, {_B2}, t AS (SELECT *, {_HASH} AS hash_val FROM b1), u AS (SELECT *, {_HASH} AS hash_val FROM b2)
SELECT t.id, t.status, t.n, DATE '1997-12-31' AS record_start_date, CASE WHEN u.id IS NOT NULL AND ({differs}) THEN DATE '2001-12-31' END AS record_end_date, NOT (u.id IS NOT NULL AND ({differs})) AS is_current, t.hash_val FROM t LEFT JOIN u ON t.id = u.id
UNION ALL SELECT u.id, u.status, u.n, DATE '2001-12-31', NULL, true, u.hash_val FROM u LEFT JOIN t ON t.id = u.id WHERE t.id IS NULL OR ({differs})"""


@query(_merge_sql("t.hash_val <> u.hash_val"))
def scd2_merge_two_batches(spark: S, sf: str) -> DataFrame:
    b1, b2 = _batches(spark, sf)
    return scd.scd2_merge(scd.scd2_start(b1, ["id"], ["status", "n"], "1997-12-31"), b2, ["id"], ["status", "n"], "2001-12-31")


@query(_merge_sql("t.status IS DISTINCT FROM u.status OR t.n IS DISTINCT FROM u.n"))
def scd2_merge_column_compare(spark: S, sf: str) -> DataFrame:
    b1, b2 = _batches(spark, sf)
    return scd.scd2_merge(scd.scd2_start(b1, ["id"], ["status", "n"], "1997-12-31"), b2, ["id"], ["status", "n"], "2001-12-31", detector="columns")


@query(_merge_sql("t.status IS DISTINCT FROM u.status"))
def snapshot_check(spark: S, sf: str) -> DataFrame:
    b1, b2 = _batches(spark, sf)
    start = scd.scd2_start(b1, ["id"], ["status", "n"], "1997-12-31")
    out = scd.snapshot_check(start, b2, ["id"], ["status"], "2001-12-31")
    # hashes of a snapshot cover its check columns; shown here over all columns, as the other merges
    return out.withColumn("hash_val", scalars.row_hash256(["status", "n"]))


@query(f"WITH {_B1}, {_B2} SELECT * FROM b2 UNION ALL SELECT b1.* FROM b1 LEFT JOIN b2 ON b1.id = b2.id WHERE b2.id IS NULL")
def upsert_two_batches(spark: S, sf: str) -> DataFrame:
    b1, b2 = _batches(spark, sf)
    return scd.upsert(b1, b2, ["id"], [F.col("n").desc()])


@query(
    f"""WITH {_B1}, {_B2}, t AS (SELECT *, md5(id || '-' || status) AS h FROM b1), u AS (SELECT *, md5(id || '-' || status) AS h FROM b2),
kept AS (SELECT * FROM t WHERE NOT (id IN (SELECT id FROM u) AND h NOT IN (SELECT h FROM u)))
SELECT * FROM kept UNION ALL SELECT * FROM u WHERE h NOT IN (SELECT h FROM kept)"""
)
def replace_changed(spark: S, sf: str) -> DataFrame:
    t, u = (b.withColumn("h", scalars.row_hash(["id", "status"])) for b in _batches(spark, sf))
    return scd.replace_changed(t, u, "id", "h")


@query(f"{WITH}, {_scd_sql('member_id', 'group_id')} SELECT member_id, block, group_id, start_date, end_date, is_current FROM versions")
def scd2_out_of_order(spark: S, sf: str) -> DataFrame:
    """History of the events before a date, then the later ones merged in: only touched members are built again."""
    b = written(box(spark, sf).select("member_id", "event_date", "event_id", "group_id"), "box")
    late = F.col("event_id") % 10 == 0
    history = scd.scd2_from_events(b.filter(~late), ["member_id"], "event_date", ["group_id"], ["event_id"])
    touched = b.filter(late).select("member_id").distinct()
    again = scd.scd2_from_events(b.join(touched, "member_id", "left_semi"), ["member_id"], "event_date", ["group_id"], ["event_id"])
    return history.join(touched, "member_id", "left_anti").unionByName(again).select("member_id", "block", "group_id", "start_date", "end_date", "is_current")


def _fact_sql(keys: str, sums: tuple, avgs: tuple, bucket: str | None = None, source: str = "box") -> str:
    b = f", {bucket} AS bucket" if bucket else ""
    return f"{WITH} SELECT {keys}{b}, {', '.join(f'CAST(sum({c}) AS BIGINT) AS total_{c}' for c in sums)}, {', '.join(f'avg({c}) AS avg_{c}' for c in avgs)} FROM {source} GROUP BY ALL"


_BUCKET = "CASE WHEN plus_minus < -10 THEN 'LOW' WHEN plus_minus <= 10 THEN 'MED' ELSE 'HIGH' END"


@query(_fact_sql("member_id, season", ("fga", "pts"), ("reb", "ast"), _BUCKET))
def bucketed_fact_members(spark: S, sf: str) -> DataFrame:
    return aggregates.bucketed_fact(box(spark, sf), ["member_id", "season"], ["fga", "pts"], ["reb", "ast"], scalars.bucket3(F.col("plus_minus")))


@query(_fact_sql("group_id, season, season_type", ("fga", "pts", "tov"), ("reb", "ast"), _BUCKET))
def bucketed_fact_groups(spark: S, sf: str) -> DataFrame:
    return aggregates.bucketed_fact(box(spark, sf), ["group_id", "season", "season_type"], ["fga", "pts", "tov"], ["reb", "ast"], scalars.bucket3(F.col("plus_minus")))


@query(
    f"""{WITH}, r AS (SELECT group_id, season, sum(pts) AS pts, rank() OVER (PARTITION BY season ORDER BY sum(pts) DESC) AS rk FROM box GROUP BY group_id, season)
SELECT season, CASE WHEN rk <= 6 THEN 'PLAYOFF' WHEN rk <= 10 THEN 'PLAY_IN' ELSE 'LOTTERY' END AS bucket, CAST(sum(pts) AS BIGINT) AS total_pts, avg(pts) AS avg_pts FROM r GROUP BY ALL"""
)
def rank_tier_fact(spark: S, sf: str) -> DataFrame:
    g = box(spark, sf).groupBy("group_id", "season").agg(F.sum("pts").alias("pts"))
    ranked = g.withColumn("rk", F.rank().over(windows.Window.partitionBy("season").orderBy(F.col("pts").desc())))
    return aggregates.bucketed_fact(ranked, ["season"], ["pts"], ["pts"], scalars.rank_tier(F.col("rk")))


@query(_fact_sql("group_id, season", ("stl", "blk", "tov"), ("stl", "blk", "tov")))
def sum_and_avg_fact(spark: S, sf: str) -> DataFrame:
    return aggregates.sum_and_avg_fact(box(spark, sf), ["group_id", "season"], ["stl", "blk", "tov"])


def _cumulative_sql(entity: str, cols: tuple, scope: str, kind: str) -> str:
    where = "WHERE season = (SELECT max(season) FROM box)" if scope == "current" else ""
    season = ", season" if scope == "current" else ""
    agg = ", ".join(f"CAST(sum({c}) AS BIGINT) AS total_{c}" if kind == "totals" else f"avg({c}) AS avg_{c}" for c in cols)
    return f"{WITH} SELECT {entity}{season}, {agg} FROM box {where} GROUP BY ALL"


_OFFENSE, _DEFENSE = ("fga", "fgm", "pts", "ast"), ("stl", "blk", "dreb")


@query(_cumulative_sql("member_id", _OFFENSE, "current", "totals"))
def cumulative_current_totals(spark: S, sf: str) -> DataFrame:
    return aggregates.cumulative(box(spark, sf), ["member_id"], _OFFENSE, "current", "totals")


@query(_cumulative_sql("member_id", _OFFENSE, "current", "averages"))
def cumulative_current_averages(spark: S, sf: str) -> DataFrame:
    return aggregates.cumulative(box(spark, sf), ["member_id"], _OFFENSE, "current", "averages")


@query(_cumulative_sql("member_id", _OFFENSE, "all", "totals"))
def cumulative_all_totals(spark: S, sf: str) -> DataFrame:
    return aggregates.cumulative(box(spark, sf), ["member_id"], _OFFENSE, "all", "totals")


@query(_cumulative_sql("member_id", _OFFENSE, "all", "averages"))
def cumulative_all_averages(spark: S, sf: str) -> DataFrame:
    return aggregates.cumulative(box(spark, sf), ["member_id"], _OFFENSE, "all", "averages")


@query(_cumulative_sql("group_id", _DEFENSE, "current", "totals"))
def cumulative_defense_split(spark: S, sf: str) -> DataFrame:
    return aggregates.cumulative(box(spark, sf), ["group_id"], _DEFENSE, "current", "totals")


@query(_cumulative_sql("group_id", _OFFENSE, "all", "averages"))
def cumulative_offense_split(spark: S, sf: str) -> DataFrame:
    return aggregates.cumulative(box(spark, sf), ["group_id"], _OFFENSE, "all", "averages")


@query(f"{WITH} SELECT season, group_id, cust_id, CAST(sum(pts) AS BIGINT) AS total_pts, CAST(sum(fga) AS BIGINT) AS total_fga, avg(pts) AS avg_pts, avg(fga) AS avg_fga, bool_or(outcome = 'R') AS any_win, bool_or(outcome = 'A') AS any_loss FROM box GROUP BY season, group_id, cust_id")
def matchup_facts(spark: S, sf: str) -> DataFrame:
    """Sums, averages and any-flags per season and pair of sides."""
    return aggregates.event_facts(box(spark, sf), ["season", "group_id", "cust_id"], ["pts", "fga"], {"any_win": F.col("outcome") == "R", "any_loss": F.col("outcome") == "A"})


@query(f"{WITH} SELECT event_id, season, {', '.join(f'CAST(sum({c}) AS BIGINT) AS total_{c}, avg({c}) AS avg_{c}' for c in ('fga', 'pts', 'reb'))} FROM raw GROUP BY event_id, season")
def play_rollup(spark: S, sf: str) -> DataFrame:
    """Line-by-line rollup per event."""
    return aggregates.event_facts(raw(spark, sf), ["event_id", "season"], ["fga", "pts", "reb"], {})


@query(f"{WITH} SELECT member_id, season, CAST(sum(fgm) AS BIGINT) AS total_fgm, CAST(sum(fga) AS BIGINT) AS total_fga, {_ratio('sum(fgm)', 'sum(fga)', 3, 'NULL')} AS average FROM box GROUP BY member_id, season")
def batting_totals(spark: S, sf: str) -> DataFrame:
    t = aggregates.bucketed_fact(box(spark, sf), ["member_id", "season"], ["fgm", "fga"])
    return t.withColumn("average", scalars.safe_ratio(F.col("total_fgm"), F.col("total_fga")))


@query("SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem")
def enrich_check(spark: S, sf: str) -> DataFrame:
    """Sort-merge left join to a dimension that keeps the left columns only."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return joins.enrich_check(lines, table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey")


@query(f"WITH {_B1}, {_B2}, t AS (SELECT *, md5(id || '-' || status) AS h FROM b1), u AS (SELECT *, md5(id || '-' || status) AS h FROM b2) SELECT * FROM t WHERE NOT (id IN (SELECT id FROM u) AND h NOT IN (SELECT h FROM u))")
def delete_changed(spark: S, sf: str) -> DataFrame:
    t, u = (b.withColumn("h", scalars.row_hash(["id", "status"])) for b in _batches(spark, sf))
    return joins.delete_changed(t, u, "id", "h")


@query(f"{WITH}, d AS (SELECT DISTINCT member_id, event_date FROM box) SELECT *, lead(event_date) OVER (PARTITION BY member_id ORDER BY event_date) AS next_start FROM d")
def next_start(spark: S, sf: str) -> DataFrame:
    return windows.next_start(box(spark, sf).select("member_id", "event_date").distinct(), ["member_id"], "event_date")


@query("SELECT 'customer' AS dim, count(*) AS n FROM (SELECT DISTINCT o_custkey FROM orders) UNION ALL SELECT 'status', count(*) FROM (SELECT DISTINCT o_orderstatus FROM orders) UNION ALL SELECT 'fact', count(*) FROM orders")
def split_star(spark: S, sf: str) -> DataFrame:
    parts = star.split_star(table(spark, sf, "orders"), {"customer": ["o_custkey"], "status": ["o_orderstatus"]}, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    counts = [p.agg(F.count("*").alias("n")).select(F.lit(n).alias("dim"), "n") for n, p in parts.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, coalesce(s.s_acctbal, 0.0) AS balance, coalesce(s.s_suppkey, -1) AS opponent_id FROM customer LEFT JOIN supplier s ON c_custkey = s_suppkey")
def defaults_and_prefixes(spark: S, sf: str) -> DataFrame:
    """Prefix stripping and null-safe defaults after an outer join."""
    c = project.strip_prefix(table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), "c_")
    s = project.rename(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), {"s_suppkey": "opponent_id", "s_acctbal": "balance"})
    return project.with_defaults(c.join(s, F.col("custkey") == F.col("opponent_id"), "left"), {"balance": 0.0, "opponent_id": -1}).select("custkey", "name", "nationkey", "balance", "opponent_id")


@query(f"{WITH} SELECT event_id, member_id, season, 'etl' AS created_by, TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM box WHERE outcome LIKE '%R%'")
def audited_rows(spark: S, sf: str) -> DataFrame:
    """Pattern filter and audit columns."""
    return scd.audit(project.like(box(spark, sf), "outcome", "%R%").select("event_id", "member_id", "season"), "etl", "2024-01-01 00:00:00")


@query(
    f"""WITH {_B1}, {_B2} SELECT id, status, n, true AS is_current FROM b2 UNION ALL SELECT b1.id, b1.status, b1.n, b2.id IS NULL FROM b1 LEFT JOIN b2 ON b1.id = b2.id WHERE b2.id IS NULL OR b1.status <> b2.status OR b1.n <> b2.n"""
)
def scd2_merge_replayed(spark: S, sf: str) -> DataFrame:
    """The second batch applied twice leaves the same current rows and the same history."""
    b1, b2 = _batches(spark, sf)
    once = scd.scd2_merge(scd.scd2_start(b1, ["id"], ["status", "n"], "1997-12-31"), b2, ["id"], ["status", "n"], "2001-12-31")
    return scd.scd2_merge(once, b2, ["id"], ["status", "n"], "2002-12-31").select("id", "status", "n", "is_current")
