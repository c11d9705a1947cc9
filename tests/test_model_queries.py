"""The feature and model queries without SQL, against numpy and against what defines their results."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from gamelake.operators import features, windows
from gamelake.operators import ml as M
from gamelake.plans import base, models, registry
from gamelake.plans.base import box


def haar(x):
    x = np.append(x, x[-1]) if len(x) % 2 else x
    return (x[::2] + x[1::2]) / np.sqrt(2), (x[::2] - x[1::2]) / np.sqrt(2)


@pytest.fixture(scope="module")
def members(spark, sf):
    df = models._members(spark, sf).persist()
    yield df.toPandas().sort_values("member_id").reset_index(drop=True), df
    df.unpersist()


@pytest.fixture(scope="module")
def series(spark, sf):
    out = defaultdict(list)
    for r in box(spark, sf).orderBy("event_date", "event_id").collect():
        out[r.member_id].append(r)
    return out


def test_wave_features(spark, sf, series):
    want = {}
    for rows in series.values():
        x = np.array([r.pts for r in rows], float)
        for i, r in enumerate(rows):
            v = x[max(0, i - 6) : i + 1]
            if len(v) < 2:
                want[r.member_id, r.event_id] = np.zeros(4)
                continue
            a, d1 = haar(v)
            d2 = haar(a)[1] if len(a) > 1 else np.zeros(1)
            top = np.sort(np.abs(np.fft.rfft(v - v.mean())))[::-1][:2]
            want[r.member_id, r.event_id] = np.array([d1.mean(), d2.mean(), *top])
    got = registry.QUERIES["wave_features"](spark, sf).collect()
    assert len(got) == len(want) and all(np.allclose(r.pts_wave, want[r.member_id, r.event_id]) for r in got)


def test_spectral_features(spark, sf, series):
    got = registry.QUERIES["spectral_features"](spark, sf).collect()
    assert len(got) == 2 * len(series)
    for r in got:
        x = np.array([v[r.measure] for v in series[r.member_id]], float)
        pad = lambda v: np.pad(np.sort(np.abs(v))[::-1][:3], (0, max(0, 3 - len(v))))
        a, d1 = haar(x)
        ema = x[0]
        for v in x[1:]:
            ema = 0.5 * ema + 0.5 * v
        assert np.allclose(r.fourier, pad(np.fft.rfft(x))) and np.allclose(r.haar2, pad(haar(a)[1]))
        assert r.n == len(x) and abs(r.ema - ema) < 1e-9 and np.allclose(r.wave, pad(np.concatenate((*haar(a), d1))))


def test_embed_text(spark, sf):
    place = HashingTF(inputCol="w", outputCol="f", numFeatures=64)
    texts = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    of = {}
    for r in registry.QUERIES["embed_text"](spark, sf).collect():
        v = np.zeros(64)
        for w in (texts[r.conv_id, r.turn] or "").lower().split():
            of[w] = of.get(w) if w in of else place.indexOf(w)
            v[of[w]] += 1
        assert np.allclose(r.vector, v / max(1e-12, np.linalg.norm(v)), atol=1e-9)


def standard(x):
    return (x - x.mean(0)) / x.std(0, ddof=1)


def test_kmeans_assigns_to_the_nearest_mean(spark, sf, members):
    m, _ = members
    of = {r.member_id: r.cluster for r in registry.QUERIES["kmeans_assign"](spark, sf).collect()}
    x, c = standard(m[models.COLS].to_numpy()), np.array([of[k] for k in m.member_id])
    assert len(set(c)) in (2, 3)
    means = np.stack([x[c == k].mean(0) for k in sorted(set(c))])
    nearest = ((x[:, None] - means[None]) ** 2).sum(2).argmin(1)
    assert (nearest == c).mean() > 0.97  # the means of the last but one step


def test_gmm_assigns_to_the_likeliest_component(spark, sf, members):
    m, df = members
    model = M.fit_gmm(df, models.COLS[:3], [2, 3])
    mix = model.stages[-1]
    x = standard(m[models.COLS[:3]].to_numpy())
    density = []
    for w, g in zip(mix.weights, mix.gaussiansDF.collect(), strict=True):
        mean, cov = g["mean"].toArray(), g["cov"].toArray()
        d = x - mean
        density.append(np.log(w) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (d @ np.linalg.inv(cov) * d).sum(1))
    of = {r.member_id: r.cluster for r in M.assign_clusters(df, model).collect()}
    got = np.array([of[k] for k in m.member_id])
    assert (np.array(density).argmax(0) == got).mean() > 0.99
    assert registry.QUERIES["gmm_assign"](spark, sf).count() == len(m)


def test_compare_models_linear_errors(spark, sf, members):
    m, _ = members
    day = m.event_date.astype("datetime64[ns]") < np.datetime64("2001-01-01")
    a = np.column_stack([np.ones(len(m)), m[models.COLS[:4]].to_numpy(float)])
    y = m.pts.to_numpy(float)
    got = {r.model: r for r in registry.QUERIES["compare_models"](spark, sf).collect()}
    assert set(got) == {"linear", "forest", "boosted"}
    if not day.any() or day.all():
        pytest.skip("the cut-off leaves one side empty")
    c, *_ = np.linalg.lstsq(a[day], y[day], rcond=None)
    e = y[~day] - a[~day] @ c
    assert abs(got["linear"].rmse - np.sqrt((e**2).mean())) < 1e-3 and abs(got["linear"].mae - np.abs(e).mean()) < 1e-3


def test_fitted_queries_agree_with_the_data(spark, sf, members):
    m, _ = members
    y = dict(zip(m.member_id, m.pts, strict=True))
    stacked = {r.member_id: r.stacked for r in registry.QUERIES["stack_models"](spark, sf).collect()}
    assert set(stacked) == set(y)
    residual = np.array([y[k] - stacked[k] for k in y])
    assert (residual**2).mean() < 0.2 * np.var(list(y.values())) and abs(residual.mean()) < 1e-6
    weights = {r.feature: r.importance for r in registry.QUERIES["feature_importance"](spark, sf).collect()}
    assert set(weights) == set(models.COLS) and abs(sum(weights.values()) - 1) < 1e-9 and max(weights, key=weights.get) in ("fga", "fgm")
    future = registry.QUERIES["fit_regressors"](spark, sf).collect()
    dates = dict(zip(m.member_id, m.event_date, strict=True))
    assert {(r.member_id, r.days) for r in future} == {(k, d) for k in y for d in (30, 20, 10)} and len(future) == 3 * len(y)
    assert all((r.future_date - dates[r.member_id]).days == r.days for r in future)
    assert np.mean([(r.predicted_pts - y[r.member_id]) ** 2 for r in future]) < 0.3 * np.var(list(y.values()))
    (line,) = registry.QUERIES["fit_linear"](spark, sf).collect()
    assert line.r2 > 0.5 and line.mae <= line.rmse


def test_lasso_keeps_what_the_soft_threshold_keeps(spark):
    """Uncorrelated standard columns: a coefficient is the correlation's part above the strength."""
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(np.column_stack([np.ones(400), rng.normal(size=(400, 4))]))
    x = q[:, 1:] * np.sqrt(399)
    y = x @ [3.0, -1.0, 0.2, 0.0] + rng.normal(size=400)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, d double, y double")
    got = {r.feature: r.coefficient for r in M.lasso_select(df, "y", list("abcd"), 1e-4, 2, (0.5,)).collect()}
    plain = x.T @ (y - y.mean()) / 399
    want = {n: np.sign(v) * (abs(v) - 0.5) for n, v in zip("abcd", plain, strict=True) if abs(v) > 0.5}
    assert set(got) == set(want) and all(abs(got[n] - want[n]) < 0.02 for n in want)


def test_time_folds_are_in_order(spark):
    df = spark.range(3000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 7919 % 365).cast("int")).alias("day"))
    rows = windows.time_folds(df, "day", 3).groupBy("fold").agg(F.min("day").alias("a"), F.max("day").alias("z"), F.count("*").alias("n")).orderBy("fold").collect()
    assert [r.fold for r in rows] == [0, 1, 2] and all(x.z < y.a for x, y in zip(rows, rows[1:])) and min(r.n for r in rows) > 900


@pytest.mark.parametrize("name", ["fit_classifier", "fit_classifier_shuffled"])
def test_classifier_queries(spark, sf, members, name):
    m, _ = members
    win = dict(zip(m.member_id, m.win, strict=True))
    rows = registry.QUERIES[name](spark, sf).collect()
    assert {r.member_id for r in rows} == set(win) and all(0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted_label == "win") for r in rows)
    train = [r for r in rows if not r.is_holdout]
    hits = [r.score for r in train if win[r.member_id]], [r.score for r in train if not win[r.member_id]]
    assert np.mean(np.array(hits[0])[:, None] > np.array(hits[1])[None]) > 0.6  # the area under the curve where it was fitted


def test_wave_fft_of_equal_rows():
    assert np.allclose(features.wave_fft(np.ones((3, 5)))[:, 1:], 0)


def test_members_are_written_once(spark, sf):
    """Models read their rows many times: from the written table, not by the join of lines and orders."""
    files = models._members(spark, sf).inputFiles()
    assert files and not any("lineitem" in f or "orders" in f for f in files)


def test_measures_go_through_no_decimals(spark, sf):
    """Measures of lines have the values of their SQL, also at halves, beside them, below zero and for nulls, without a
    decimal for each row."""
    plan = box(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" not in plan and " round(" not in plan and "(round(" not in plan
    x = [v / 1000 for v in range(-60, 61, 5)] + [0.285, 1.005, 1.115, -1.115, *(float(v) for v in (np.nextafter(0.5, 0) / 100, np.nextafter(0.005, 0), np.nextafter(0.005, 1))), 104949.495, 9e13 + 0.005, None]
    lines = spark.createDataFrame([(v, v, v) for v in x], "l_discount double, l_tax double, l_extendedprice double")
    lines = lines.withColumn("l_discount", F.when(F.abs("l_discount") < 1e6, F.col("l_discount"))).withColumn("l_tax", F.col("l_discount"))
    scaled = ("disc", "tax", "cents")
    rows = lines.select(*(F.expr(base.MEASURES[n]).alias(n) for n in scaled), *(F.expr(base.NATIVE[n]).alias(f"own_{n}") for n in scaled)).collect()
    assert len(rows) == len(x) and all(r[n] == r[f"own_{n}"] for r in rows for n in scaled)
    small = spark.createDataFrame([(a, b) for a in (-3, -2, -1, 0, 1, 2, 49, 50, None) for b in (-1, 0, 7, None)], "fga int, tax int")
    derived = ("fgm", "ftm", "pts")
    told = small.select(*(F.expr(base.DERIVED[n]).alias(n) for n in derived), *(F.expr(base.NATIVE[n]).alias(f"own_{n}") for n in derived))
    assert all(dict(told.dtypes)[n] == dict(told.dtypes)[f"own_{n}"] for n in derived) and all(r[n] == r[f"own_{n}"] for r in told.collect() for n in derived)


@pytest.mark.parametrize("fold", ["fold", None])
def test_classifiers_are_fitted_on_kept_rows(spark, members, monkeypatch, fold):
    """Rows are assembled once, and every fit reads those that are kept, not the plan of folds and columns."""
    df, seen, fit = windows.time_folds(members[1], "event_date", 3), [], M.GBTClassifier._fit
    monkeypatch.setattr(M.GBTClassifier, "_fit", lambda self, d: (seen.append(d._jdf.queryExecution().withCachedData().toString()), fit(self, d))[1])
    asked = []
    monkeypatch.setattr(M.VectorAssembler, "transform", lambda self, d, params=None, whole=M.VectorAssembler.transform: (asked.append(1), whole(self, d))[1])
    model = M.fit_classifier(df, "win", models.COLS, fold, rounds=2)
    assert len(seen) == (5 if fold else 3) and all("InMemoryRelation" in p and "features" in p.split("InMemoryRelation")[1] for p in seen)
    assert len(asked) == 1 and len(model.stages) == 2
