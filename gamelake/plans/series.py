"""Window queries: rolling features, lags, streaks, corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.operators import features, scans, windows
from gamelake.operators import ml as M
from gamelake.plans.base import WITH, box, query, written

S = SparkSession
KEY, ORDER = ["member_id"], ["event_date", "event_id"]
_W = "PARTITION BY member_id ORDER BY event_date, event_id"
_ID = "member_id, event_date, event_id"


def _b(spark: S, sf: str, *cols: str) -> DataFrame:
    return box(spark, sf).select("member_id", "event_date", "event_id", *cols)


@query(f"{WITH} SELECT {_ID}, pts, round(avg(pts) OVER ({_W} ROWS 4 PRECEDING), 4) AS pts_avg5 FROM box")
def rolling_5(spark: S, sf: str) -> DataFrame:
    return windows.rolling(_b(spark, sf, "pts"), KEY, ORDER, ["pts"], 5)


@query(f"{WITH} SELECT {_ID}, pts, reb, " + ", ".join(f"round(avg({c}) OVER ({_W} ROWS 2 PRECEDING), 4) AS {c}_avg3, round(coalesce(stddev_samp({c}) OVER ({_W} ROWS 2 PRECEDING), 0), 4) AS {c}_stddev3" for c in ("pts", "reb")) + " FROM box")
def rolling_mean_std_3(spark: S, sf: str) -> DataFrame:
    return windows.rolling(_b(spark, sf, "pts", "reb"), KEY, ORDER, ["pts", "reb"], 3, ("avg", "stddev"), fill=0.0)


@query(f"{WITH} SELECT {_ID}, pts, " + ", ".join(f"lag(pts, {i}) OVER ({_W}) AS pts_lag{i}, pts - lag(pts, {i}) OVER ({_W}) AS pts_diff{i}" for i in range(1, 7)) + " FROM box")
def lags_diffs(spark: S, sf: str) -> DataFrame:
    return windows.lag_features(_b(spark, sf, "pts"), KEY, ORDER, ["pts"])


@query(f"{WITH} SELECT {_ID}, pts, fga, CAST(sum(pts) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS pts_running, CAST(sum(fga) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fga_running FROM box")
def running_totals(spark: S, sf: str) -> DataFrame:
    return windows.running_totals(_b(spark, sf, "pts", "fga"), KEY, ORDER, ["pts", "fga"])


@query(
    f"""WITH RECURSIVE {WITH[5:]}, o AS (SELECT {_ID}, CAST(pts AS DOUBLE) AS x, pts, row_number() OVER ({_W}) AS n FROM box),
e AS (SELECT member_id, n, x AS s FROM o WHERE n = 1 UNION ALL SELECT o.member_id, o.n, 0.5 * e.s + 0.5 * o.x FROM e JOIN o ON o.member_id = e.member_id AND o.n = e.n + 1)
SELECT o.member_id, o.event_date, o.event_id, o.pts, round(e.s, 6) AS pts_ema3 FROM o JOIN e ON e.member_id = o.member_id AND e.n = o.n"""
)
def ema_3(spark: S, sf: str) -> DataFrame:
    return windows.ema(_b(spark, sf, "pts"), KEY, ORDER, "pts", 3)


@query(
    f"""WITH RECURSIVE {WITH[5:]}, o AS (SELECT {_ID}, CAST(pts AS DOUBLE) AS x, pts, row_number() OVER ({_W}) AS n FROM box),
e AS (SELECT member_id, n, x AS s FROM o WHERE n = 1 UNION ALL SELECT o.member_id, o.n, (99.0 / 101) * e.s + (2.0 / 101) * o.x FROM e JOIN o ON o.member_id = e.member_id AND o.n = e.n + 1)
SELECT o.member_id, o.event_date, o.event_id, o.pts, round(e.s, 6) AS pts_ema100 FROM o JOIN e ON e.member_id = o.member_id AND e.n = o.n"""
)
def ema_100(spark: S, sf: str) -> DataFrame:
    return scans.ema(written(_b(spark, sf, "pts"), "points"), KEY, ORDER, "event_date", "pts", 100)


@query(
    f"""{WITH}, m AS (SELECT member_id, CASE WHEN outcome = 'R' THEN 1 ELSE 0 END AS hit, sum(CASE WHEN outcome = 'R' THEN 0 ELSE 1 END) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS breaks FROM box)
SELECT member_id, CAST(max(run) AS BIGINT) AS longest_streak FROM (SELECT member_id, breaks, sum(hit) AS run FROM m GROUP BY ALL) GROUP BY member_id"""
)
def longest_streaks(spark: S, sf: str) -> DataFrame:
    return windows.longest_streaks(_b(spark, sf, "outcome"), KEY, ORDER, F.col("outcome") == "R")


@query(f"{WITH} SELECT {_ID}, array_to_string(list(pts) OVER ({_W} ROWS 6 PRECEDING), ',') AS pts_last7 FROM box")
def trailing_array(spark: S, sf: str) -> DataFrame:
    out = windows.trailing_array(_b(spark, sf, "pts"), KEY, ORDER, "pts").drop("pts")
    return out.withColumn("pts_last7", F.concat_ws(",", F.col("pts_last7").cast("array<string>")))


@query(f"{WITH} SELECT {_ID}, group_id, CASE WHEN row_number() OVER w > 1 AND group_id IS NOT DISTINCT FROM lag(group_id) OVER w THEN 0 ELSE 1 END AS changed FROM box WINDOW w AS ({_W})")
def change_flags(spark: S, sf: str) -> DataFrame:
    return windows.change_flag(_b(spark, sf, "group_id"), KEY, ORDER, ["group_id"])


@query(f"{WITH}, c AS (SELECT quantile_disc(date_diff('day', DATE '1970-01-01', event_date), 0.9) AS cut FROM box) SELECT {_ID}, date_diff('day', DATE '1970-01-01', event_date) > cut AS is_holdout FROM box, c")
def time_holdout(spark: S, sf: str) -> DataFrame:
    return windows.time_holdout(_b(spark, sf), "event_date", 0.1)


# p-values for the corrections are made of order prices
_P = "p AS (SELECT o_orderkey AS id, o_orderpriority AS family, CAST(o_orderkey * 7919 % 10007 AS DOUBLE) / 10007 AS p FROM orders)"


@query(
    f"""WITH {_P}, r AS (SELECT *, count(*) OVER (PARTITION BY family) AS m, row_number() OVER (PARTITION BY family ORDER BY p, id) AS k FROM p)
SELECT id, family, p, least(1.0, p * m) AS p_bonferroni, least(1.0, min(p * m / k) OVER (PARTITION BY family ORDER BY p DESC, id DESC ROWS UNBOUNDED PRECEDING)) AS p_bh FROM r"""
)
def adjust_pvalues(spark: S, sf: str) -> DataFrame:
    from gamelake.plans.base import table

    p = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("family"), ((F.col("o_orderkey") * 7919 % 10007).cast("double") / 10007).alias("p"))
    return windows.adjust_pvalues(p, ["family"], "p", "id")


@query(
    f"""{WITH}, t AS (SELECT {_ID}, (row_number() OVER ({_W}) - 1) / CAST(count(*) OVER (PARTITION BY member_id) AS DOUBLE) AS t FROM box)
SELECT {_ID}, {', '.join(f'round(cos({2 * k} * pi() * t), 6) + 0.0 AS cos{k}, round(sin({2 * k} * pi() * t), 6) + 0.0 AS sin{k}' for k in (1, 2, 3))} FROM t"""
)
def seasonal_terms(spark: S, sf: str) -> DataFrame:
    out = features.seasonal_terms(_b(spark, sf), KEY, ORDER)
    return out.select("member_id", "event_date", "event_id", *((F.col(f"{n}{k}") + 0.0).alias(f"{n}{k}") for k in (1, 2, 3) for n in ("cos", "sin")))


@query(
    f"""{WITH}, y AS (SELECT CAST(pts AS DOUBLE) AS y, CAST(fga AS DOUBLE) AS yhat, pts - 5 + fga % 3 AS lo, pts + 6 - fga % 7 AS hi FROM box)
SELECT round(avg(CASE WHEN y BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END), 6) AS picp, round(avg(CAST(hi - lo AS DOUBLE)) / (max(y) - min(y)), 6) AS pinaw,
  round(avg(hi - lo + CASE WHEN y < lo THEN (lo - y) * 20 WHEN y > hi THEN (y - hi) * 20 ELSE 0 END), 6) AS winkler FROM y"""
)
def interval_metrics(spark: S, sf: str) -> DataFrame:
    y = box(spark, sf).select("pts", (F.col("pts") - 5 + F.col("fga") % 3).alias("lo"), (F.col("pts") + 6 - F.col("fga") % 7).alias("hi"))
    return M.interval_metrics(y, "pts", "lo", "hi")


@query(
    f"""{WITH}, y AS (SELECT CAST(pts AS DOUBLE) AS y, CAST(fga AS DOUBLE) AS h FROM box)
SELECT round(sqrt(avg((y - h) * (y - h))), 6) AS rmse, round(avg(abs(y - h)), 6) AS mae, round(1 - sum((y - h) * (y - h)) / (sum(y * y) - sum(y) * sum(y) / count(y)), 6) AS r2, round(avg(CASE WHEN y <> 0 THEN abs((y - h) / y) END), 6) AS mape FROM y"""
)
def regression_metrics(spark: S, sf: str) -> DataFrame:
    return M.regression_metrics(box(spark, sf), "pts", "fga")


@query(f"{WITH} SELECT CASE WHEN outcome = 'R' THEN 1 ELSE 0 END AS actual, CASE WHEN pts >= 25 THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM box GROUP BY ALL")
def confusion(spark: S, sf: str) -> DataFrame:
    b = box(spark, sf).select((F.col("outcome") == "R").cast("int").alias("y"), (F.col("pts") >= 25).cast("int").alias("h"))
    return M.confusion(b, "y", "h")


@query(
    f"""{WITH}, y AS (SELECT CASE WHEN outcome = 'R' THEN 1 ELSE 0 END AS y, CASE WHEN pts >= 25 THEN 1 ELSE 0 END AS h, pts FROM box),
g AS (SELECT pts, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS m FROM y GROUP BY pts), k AS (SELECT p, sum(m) OVER (ORDER BY pts) - m / 2.0 AS below, m FROM g),
a AS (SELECT sum(p * below) / sum(p) / sum(m) AS auc FROM k),
c AS (SELECT CAST(count(*) AS DOUBLE) AS n, count(*) FILTER (y = h) AS ok, count(*) FILTER (y = 1 AND h = 1) AS tp, count(*) FILTER (y = 0 AND h = 1) AS fp, count(*) FILTER (y = 1 AND h = 0) AS fn FROM y)
SELECT round(ok / n, 6) AS accuracy, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision, round(CAST(tp AS DOUBLE) / (tp + fn), 6) AS recall, round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 6) AS f1, round(auc, 6) AS auc FROM c, a"""
)
def classification_metrics(spark: S, sf: str) -> DataFrame:
    b = box(spark, sf).select((F.col("outcome") == "R").cast("int").alias("y"), (F.col("pts") >= 25).cast("int").alias("h"), "pts")
    return M.classification_metrics(b, "y", "h", score="pts")
