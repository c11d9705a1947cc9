"""Feature and model queries. Fitted values can't be expressed in SQL; tests hold them against numpy and
against what defines them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.functions import scalars
from gamelake.operators import features, project, scd, spectra, vectors, windows
from gamelake.operators import ml as M
from gamelake.plans.base import WITH, box, query, scratch, table, written

S = SparkSession
COLS = ["fga", "fgm", "fg3m", "reb", "ast", "tov"]


def _members(spark: S, sf: str) -> DataFrame:
    """One row of averages per member, written: models read it in every round, and its few files give few tasks."""
    rows = box(spark, sf).groupBy("member_id").agg(*(F.avg(c).alias(c) for c in COLS), F.avg("pts").alias("pts"), F.max("event_date").alias("event_date"), (F.avg((F.col("outcome") == "R").cast("int")) > 0.25).cast("int").alias("win"))
    return written(rows, "members")


@query(f"{WITH}, r AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY md5(concat_ws('-', CAST(member_id AS VARCHAR), CAST(event_id AS VARCHAR), '42')), member_id, event_id) AS n FROM box) SELECT member_id, season, event_id, pts FROM r WHERE n <= 100")
def stratified_sample(spark: S, sf: str) -> DataFrame:
    return features.stratified_sample(box(spark, sf).select("member_id", "season", "event_id", "pts"), ["season"], ["member_id", "event_id"], 100)


@query()
def wave_features(spark: S, sf: str) -> DataFrame:
    return features.wave_features(box(spark, sf).select("member_id", "event_date", "event_id", "pts"), ["member_id"], ["event_date", "event_id"], "pts")


@query()
def spectral_features(spark: S, sf: str) -> DataFrame:
    return spectra.spectral_features(box(spark, sf), "member_id", ["event_date", "event_id"], ["pts", "reb"])


@query()
def grouped_ar(spark: S, sf: str) -> DataFrame:
    return features.grouped_ar(box(spark, sf), "member_id", ["event_date", "event_id"], "pts")


_LAGGED = "z AS (SELECT member_id, CAST(pts AS DOUBLE) AS y, lag(CAST(pts AS DOUBLE)) OVER (PARTITION BY member_id ORDER BY event_date, event_id) AS x, count(*) OVER (PARTITION BY member_id) AS points FROM box)"


@query(
    f"""{WITH}, {_LAGGED}, s AS (
  SELECT member_id, count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, avg(x) AS mx FROM z WHERE x IS NOT NULL AND points >= 4 GROUP BY member_id
), f AS (SELECT *, sqrt(greatest(0.0, syy - b * b * sxx) / (n - 2)) AS sd FROM s WHERE n > 2 AND sxx > 1e-9 AND syy - b * b * sxx > 1e-9 * syy)
SELECT member_id, CAST(1 AS INT) AS ar_order, CAST(0 AS INT) AS term, round(a, 4) AS coefficient, round(a / (sd * sqrt(1.0 / n + mx * mx / sxx)), 3) AS t_value FROM f
UNION ALL SELECT member_id, CAST(1 AS INT), CAST(1 AS INT), round(b, 4), round(b / (sd / sqrt(sxx)), 3) FROM f"""
)
def first_order_ar(spark: S, sf: str) -> DataFrame:
    """The first-order model of every member with variance, which has a closed form."""
    rows = features.grouped_ar(box(spark, sf), "member_id", ["event_date", "event_id"], "pts", 1, 1)
    return rows.filter(F.abs("t_value") < 1e4).select("member_id", "ar_order", "term", F.round("coefficient", 4).alias("coefficient"), F.round("t_value", 3).alias("t_value"))


@query()
def embed_text(spark: S, sf: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    docs = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return features.embed_text(docs, "text").select("conv_id", "turn", vector_to_array("vector").alias("vector"))


@query()
def embed_text_svd(spark: S, sf: str) -> DataFrame:
    """Every document in the space of the leading singular vectors of all documents' words."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return vectors.embed(docs, "text", vectors.fit_text_svd(docs, "text")).select("doc_id", "vector")


@query()
def kmeans_assign(spark: S, sf: str) -> DataFrame:
    m = _members(spark, sf)
    return M.assign_clusters(m, M.fit_kmeans(m, COLS, [2, 3], [5, 10])).select("member_id", "cluster")


@query()
def gmm_assign(spark: S, sf: str) -> DataFrame:
    m = _members(spark, sf)
    return M.assign_clusters(m, M.fit_gmm(m, COLS, [2, 3], 2, [20])).select("member_id", "cluster")


@query()
def clusters_by_time(spark: S, sf: str) -> DataFrame:
    """Assigned clusters, written as historical and future tables and read back."""
    m = _members(spark, sf)
    done = M.assign_clusters(m, M.fit_kmeans(m, COLS, [2], [10], 2)).select("member_id", "event_date", "cluster")
    past, future = M.split_by_time(done, "event_date", "1998-01-01", scratch(spark, "clusters"))
    return past.withColumn("when", F.lit("historical")).unionByName(future.withColumn("when", F.lit("future")))


@query()
def lasso_select(spark: S, sf: str) -> DataFrame:
    return M.lasso_select(_members(spark, sf), "pts", COLS)


@query()
def fit_classifier(spark: S, sf: str) -> DataFrame:
    """Boosted trees on time folds, scored with label texts."""
    m = windows.time_holdout(_members(spark, sf), "event_date", 0.1)
    train = windows.time_folds(m.filter("not is_holdout"), "event_date", 3)
    model = M.fit_classifier(train, "win", COLS, "fold", 3)
    return M.score(m, model, "classification").select("member_id", "is_holdout", "score", "predicted_label", "prediction_type")


@query()
def fit_classifier_shuffled(spark: S, sf: str) -> DataFrame:
    """As ``fit_classifier``, its depth chosen by a shuffled split."""
    m = windows.time_holdout(_members(spark, sf), "event_date", 0.1)
    model = M.fit_classifier(m.filter("not is_holdout"), "win", COLS)
    return M.score(m, model, "classification").select("member_id", "is_holdout", "score", "predicted_label", "prediction_type")


@query()
def search_classifier(spark: S, sf: str) -> DataFrame:
    """Every setting of the search with its rung, fold scores and, for the winner, the hold-out's AUC."""
    m = _members(spark, sf)
    m = windows.time_holdout(m, "event_date", 0.1)
    train = windows.time_folds(m.filter("not is_holdout"), "event_date", 3)
    return M.halving_search(train, m.filter("is_holdout"), "win", COLS, "member_id", "fold", many=6)[1]


@query()
def score_and_store(spark: S, sf: str) -> DataFrame:
    """Scores with label texts, stored as historical and future rows and read back."""
    m = _members(spark, sf)
    model = M.fit_classifier(m, "win", COLS, rounds=5, depths=(2,))
    done = M.score(m, model, "classification").select("member_id", "event_date", "score", "predicted_label", "prediction_type")
    past, future = M.split_by_time(done, "event_date", "1998-01-01", scratch(spark, "scores"))
    return past.withColumn("when", F.lit("historical")).unionByName(future.withColumn("when", F.lit("future")))


@query()
def fit_regressors(spark: S, sf: str) -> DataFrame:
    """Current rows of a history of members, whose points and rebounds are told for 30, 20 and 10 days ahead."""
    m = _members(spark, sf)
    history = scd.scd2_start(m, ["member_id"], ["pts", "reb"], F.col("event_date"))
    now = history.filter("is_current").select("member_id", "event_date", *COLS, "pts")
    x = ["fga", "fgm", "fg3m", "ast", "tov"]
    models, out = M.fit_regressors(now, ["pts", "reb"], x, 5), None
    for days in (30, 20, 10):
        told = M.predict_future(models["reb"].transform(now.select("member_id", "event_date", *x)).drop("features"), models["pts"], "event_date", days, "predicted_pts")
        told = told.select("member_id", F.lit(days).alias("days"), "future_date", "predicted_pts", "predicted_reb")
        out = told if out is None else out.unionByName(told)
    return out


@query()
def fit_categories(spark: S, sf: str) -> DataFrame:
    """Members' points by linear regression and by boosted trees, from numbers and categories of which a chi-square
    test against high points keeps eight. Lines have few different values, so equal ones are counted, by
    validation fold (dealt line by line), and every pass of the fits reads the counts."""
    b = box(spark, sf).select("pts", (F.col("fga") / 10).cast("int").alias("tens"), "line_no", "disc", "season_type", "status", (F.col("pts") > 30).cast("int").alias("high"), "event_date", F.pmod(F.xxhash64("member_id", "event_id"), F.lit(2)).cast("int").alias("fold"))
    sides = M.time_split(written(b, "lines"), "event_date", "1997-01-01")
    train, test = (written(M.counted(side, [c for c in b.columns if c != "event_date"]), "counted") for side in sides)
    out = None
    for kind in ("linear", "gbt"):
        model = M.fit_regression(train, "pts", ["tens", "line_no", "disc"], ["season_type", "status"], kind, 2, 1, 8, "high", "weight", "fold")
        one = M.regression_metrics(model.transform(test), "pts", "prediction", 4, "weight").select(F.lit(kind).alias("kind"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query()
def fit_linear(spark: S, sf: str) -> DataFrame:
    m = _members(spark, sf)
    train, test = M.time_split(m, "event_date", "2001-01-01")
    return M.regression_metrics(M.fit_regression(train, "pts", ["fga", "reb"], folds=2).transform(test), "pts", "prediction", 4)


@query()
def feature_importance(spark: S, sf: str) -> DataFrame:
    return M.important_features(_members(spark, sf), "pts", COLS)


@query()
def compare_models(spark: S, sf: str) -> DataFrame:
    train, test = M.time_split(_members(spark, sf), "event_date", "2001-01-01")
    return M.compare_models(train, test, "pts", COLS[:4])


@query()
def stack_models(spark: S, sf: str) -> DataFrame:
    return M.stack_models(_members(spark, sf), "pts", COLS[:4], "member_id")


_MEMBER_SQL = f"{WITH}, m AS (SELECT member_id, {', '.join(f'avg({c}) AS {c}' for c in COLS)}, avg(pts) AS pts, max(event_date) AS event_date FROM box GROUP BY member_id)"


@query(f"{_MEMBER_SQL} SELECT member_id, {', '.join(f'round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 4) + 0.0 AS {c}' for c in COLS)} FROM m")
def standardised_features(spark: S, sf: str) -> DataFrame:
    """Assembled columns with mean 0 and deviation 1."""
    from pyspark.ml.functions import vector_to_array

    m = _members(spark, sf)
    x = M.feature_pipeline(COLS).fit(m).transform(m).select("member_id", vector_to_array("features").alias("x"))
    return x.select("member_id", *((F.round(F.col("x")[i], 4) + 0.0).alias(c) for i, c in enumerate(COLS)))


@query(
    f"""{_MEMBER_SQL} SELECT member_id, event_date, pts / 60 AS score, CASE WHEN pts / 60 >= 0.5 THEN 'win' ELSE 'loss' END AS predicted_label, 'classification' AS prediction_type,
  CASE WHEN event_date > DATE '2001-07-01' THEN 'future' ELSE 'historical' END AS kept_in FROM m"""
)
def labelled_scores(spark: S, sf: str) -> DataFrame:
    """Scores over a threshold as label texts, stored by time and read back."""
    m = _members(spark, sf).withColumn("score", F.col("pts") / 60)
    told = m.select("member_id", "event_date", "score", scalars.decode_prediction(F.col("score"), 0.5, ("loss", "win")).alias("predicted_label"), F.lit("classification").alias("prediction_type"))
    past, future = M.split_by_time(told, "event_date", "2001-07-01", scratch(spark, "labels"))
    return past.withColumn("kept_in", F.lit("historical")).unionByName(future.withColumn("kept_in", F.lit("future")))


@query(f"{_MEMBER_SQL} SELECT CASE WHEN event_date < DATE '2001-07-01' THEN 'train' ELSE 'test' END AS side, count(*) AS n, min(event_date) AS earliest, max(event_date) AS latest FROM m GROUP BY ALL")
def sides_of_a_split(spark: S, sf: str) -> DataFrame:
    train, test = M.time_split(_members(spark, sf), "event_date", "2001-07-01")
    side = lambda df, name: df.agg(F.count("*").alias("n"), F.min("event_date").alias("earliest"), F.max("event_date").alias("latest")).select(F.lit(name).alias("side"), "*")
    return side(train, "train").unionByName(side(test, "test"))


@query("SELECT c_custkey, c_acctbal FROM customer")
def numeric_columns(spark: S, sf: str) -> DataFrame:
    """The number columns of a table, by its schema, but for one."""
    c = table(spark, sf, "customer")
    return c.select(*project.numeric_cols(c, ["c_nationkey"]))


_PAIRS = "list_transform(range(1, len({0}) // 2 + 1), lambda i: ({0}[2 * i - 1] {1} {0}[2 * i]) / sqrt(2.0))"
_EVEN = "CASE WHEN len({0}) % 2 = 1 THEN list_append({0}, {0}[len({0})]) ELSE {0} END"
_TRANSFORM = "list_transform(range(0, len(x) // 2 + 1), lambda k: sqrt(list_sum(list_transform(range(0, len(x)), lambda j: x[j + 1] * cos(2 * pi() * ((j * k) % len(x)) / len(x)))) ** 2 + list_sum(list_transform(range(0, len(x)), lambda j: x[j + 1] * sin(2 * pi() * ((j * k) % len(x)) / len(x)))) ** 2))"
_LARGEST = "list_concat(list_reverse_sort(list_transform({0}, lambda c: abs(c))), [0.0, 0.0, 0.0])"


def _waves(series: str) -> str:
    """Common tables from ``series`` (v: values in order, x: what is transformed): m1, d1, m2, d2, f."""
    return (
        f"{series}, e1 AS (SELECT *, {_EVEN.format('v')} AS w FROM series), l1 AS (SELECT *, {_PAIRS.format('w', '+')} AS m1, {_PAIRS.format('w', '-')} AS d1 FROM e1), "
        f"e2 AS (SELECT *, {_EVEN.format('m1')} AS u FROM l1), l2 AS (SELECT *, {_PAIRS.format('u', '+')} AS m2, {_PAIRS.format('u', '-')} AS d2, {_TRANSFORM} AS f FROM e2)"
    )


@query(
    f"""{WITH}, {_waves("series AS (SELECT member_id, list(CAST(pts AS DOUBLE) ORDER BY event_date, event_id) AS v, list(CAST(pts AS DOUBLE) ORDER BY event_date, event_id) AS x FROM box GROUP BY member_id)")},
t AS (SELECT *, {_LARGEST.format('f')} AS tf, {_LARGEST.format('d2')} AS t2, {_LARGEST.format('list_concat(m2, d2, d1)')} AS tw FROM l2)
SELECT member_id, len(v) AS n, round(list_reduce(v, lambda a, b: 0.5 * a + 0.5 * b), 4) AS ema,
  {', '.join(f'round(tf[{k}], 3) AS fourier{k}, round(t2[{k}], 4) AS haar{k}, round(tw[{k}], 4) AS wave{k}' for k in (1, 2, 3))} FROM t"""
)
def series_spectra(spark: S, sf: str) -> DataFrame:
    """Whole-series features of the members' points, in columns."""
    got = spectra.spectral_features(box(spark, sf), "member_id", ["event_date", "event_id"], ["pts"])
    return got.select("member_id", "n", F.round("ema", 4).alias("ema"), *(F.round(F.col(c)[k - 1], d).alias(f"{n}{k}") for k in (1, 2, 3) for c, n, d in (("fourier", "fourier", 3), ("haar2", "haar", 4), ("wave", "wave", 4))))


@query(
    f"""{WITH}, last7 AS (SELECT member_id, event_date, event_id, list(CAST(pts AS DOUBLE)) OVER (PARTITION BY member_id ORDER BY event_date, event_id ROWS 6 PRECEDING) AS v FROM box),
{_waves("series AS (SELECT *, list_transform(v, lambda c: c - list_avg(v)) AS x FROM last7)")},
t AS (SELECT *, {_LARGEST.format('f')} AS tf, CASE WHEN len(v) > 2 THEN list_avg(d2) ELSE 0.0 END AS a2 FROM l2)
SELECT member_id, event_id, CASE WHEN len(v) < 2 THEN 0.0 ELSE round(list_avg(d1), 4) END + 0.0 AS detail1, CASE WHEN len(v) < 2 THEN 0.0 ELSE round(a2, 4) END + 0.0 AS detail2,
  CASE WHEN len(v) < 2 THEN 0.0 ELSE round(tf[1], 4) END AS fourier1, CASE WHEN len(v) < 2 THEN 0.0 ELSE round(tf[2], 4) END AS fourier2 FROM t"""
)
def trailing_waves(spark: S, sf: str) -> DataFrame:
    """Haar details and Fourier magnitudes of each row's last seven values, in columns."""
    b = box(spark, sf).select("member_id", "event_date", "event_id", "pts")
    got = features.wave_features(b, ["member_id"], ["event_date", "event_id"], "pts")
    return got.select("member_id", "event_id", *((F.round(F.col("pts_wave")[k], 4) + 0.0).alias(n) for k, n in enumerate(("detail1", "detail2", "fourier1", "fourier2"))))
