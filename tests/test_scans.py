"""Keys of any size: segmented scans, ranks, quantiles; whole-series features; series models."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gamelake.operators import aggregates, features, joins, project, scans, scd, spectra, windows
from gamelake.operators import ml as M

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """One key with most rows, small ones, a null key; repeated days, null attributes."""
    rng = np.random.default_rng(1)
    rows = [(k, DAY + dt.timedelta(days=int(d)), int(i), None if a == 3 else f"a{a}", float(v)) for i, (k, d, a, v) in enumerate(zip(rng.choice([1, 1, 1, 1, 2, 3, 0], 3000), rng.integers(0, 400, 3000), rng.integers(0, 4, 3000), rng.integers(0, 50, 3000), strict=True))]
    return spark.createDataFrame([(int(k) or None, *r) for k, *r in rows], "k int, day date, id int, attr string, v double").cache()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_blocks_of_a_hot_key_lie_in_many_segments(hot):
    cuts = scans.cut_points(hot, "day", 16)
    assert hot.filter("k = 1").select(scans.segment(scans.number(hot, "day"), cuts).alias("s")).distinct().count() >= 10
    order = [F.col("day"), F.col("id")]
    plain = windows.block_id(windows.change_flag(hot, ["k"], order, ["attr"]), ["k"], order).drop("changed")
    for parts in (1, 16):
        assert rows_of(scans.block_ids(hot, ["k"], order, "day", ["attr"], parts=parts).select(plain.columns)) == rows_of(plain)


def test_running_sums_and_row_numbers(hot):
    w = Window.partitionBy("k").orderBy("day", "id")
    plain = hot.select("k", "id", F.row_number().over(w).cast("long").alias("n"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"))
    numbered = scans.row_numbers(hot, ["k"], ["day", "id"], "day", parts=16)
    got = scans.running_sums(numbered, ["k"], ["day", "id"], "day", {"total": F.col("v")}, 16)
    assert rows_of(got.select("k", "id", "n", "total")) == rows_of(plain)
    assert scans.row_numbers(hot.filter("false"), ["k"], ["day", "id"], "day").count() == 0


def test_scd2_of_segments(hot):
    """Versions from segments are those of one ordered pass over each key."""
    order = [F.col("day"), F.col("id"), F.col("attr")]
    marked = windows.block_id(windows.change_flag(hot, ["k"], order, ["attr"]), ["k"], order)
    plain = windows.block_ranges(marked, ["k"], "day", ["attr"]).withColumn("next_start", F.lead("start_date").over(Window.partitionBy("k").orderBy("block")))
    got = scd.scd2_from_events(hot, ["k"], "day", ["attr"], ["id"], parts=16)
    assert rows_of(got.select(plain.columns)) == rows_of(plain)
    assert got.filter("is_current").count() == hot.select("k").distinct().count()


def test_asof_join_of_segments(hot, spark):
    versions = scd.scd2_from_events(hot.filter("id % 40 = 0"), ["k"], "day", ["attr"], ["id"])
    dim = versions.withColumn("valid_to", F.coalesce(F.date_add("next_start", -1), F.lit("9999-12-31").cast("date")))
    fact = hot.select("k", "day", "id").union(spark.createDataFrame([(1, None, -1), (None, None, -2)], "k int, day date, id int"))
    interval = joins.scd_join(fact, dim, "k", "day", "start_date", "valid_to", ["version_key"])
    for parts in (1, 16):
        got = joins.asof_join(fact, dim, "k", "day", "start_date", "valid_to", ["version_key"], parts=parts)
        assert rows_of(got.select("id", "k", "day", "version_key")) == rows_of(interval.select("id", "k", "day", "version_key"))
        assert got.filter("k IS NULL OR day IS NULL").filter("version_key IS NOT NULL").count() == 0


def test_ema_of_segments_equals_recursion(spark, hot):
    df = hot.withColumn("v", F.when((F.col("id") % 11 != 0) & (F.col("day") > F.lit("2024-02-10").cast("date")), F.col("v")))
    for span, parts in ((3, 16), (100, 16), (100, 1)):
        got = {r.id: r[f"v_ema{span}"] for r in scans.ema(df, ["k"], ["day", "id"], "day", "v", span, 9, parts).collect()}
        alpha, state = 2 / (span + 1), {}
        for r in sorted(df.collect(), key=lambda r: (r.day, r.id)):
            s = state.get(r.k)
            if r.v is not None:
                s = state[r.k] = r.v if s is None else alpha * r.v + (1 - alpha) * s
            assert (got[r.id] is None) == (s is None) or got[r.id] == pytest.approx(s, abs=1e-6), r
            assert s is None or got[r.id] == pytest.approx(s, abs=1e-7)
    assert scans.ema(df.filter("false"), ["k"], ["day", "id"], "day", "v").count() == 0


def test_quantiles_equal_percentile(hot):
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    with_null = hot.withColumn("v", F.when(F.coalesce(F.col("k"), F.lit(0)) != 3, F.col("v")))  # key 3 has no value
    plain = {r.k: r.q for r in with_null.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, probabilities))).alias("q")).collect()}
    got = {r.k: r.q for r in scans.quantiles(with_null, ["k"], "v", probabilities, 16).collect()}
    assert set(got) == set(plain) and all(v is None for v in got[3])
    assert all(np.allclose(got[k], plain[k]) for k in plain if k != 3)
    assert aggregates.box_stats(hot.filter("false"), ["k"], "v").count() == 0


def test_dense_ids(hot):
    got = scans.dense_ids(hot, ["day", "id"], parts=7)
    assert [r.row_id for r in got.orderBy("day", "id").collect()] == list(range(1, 3001))
    assert scans.dense_ids(hot.filter("false"), ["day", "id"]).count() == 0
    assert project.row_id(hot, ["id"]).count() == 3000


def test_auc_by_ranks(spark):
    rng = np.random.default_rng(2)
    score, label = np.round(rng.random(800), 2), rng.integers(0, 2, 800)
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(score, label, strict=True)] + [(None, 1)], "s double, y int")
    pairs = score[label == 1][:, None] - score[label == 0][None, :]
    assert abs(M.rank_auc(df, "s", "y", 16).first().auc - ((pairs > 0) + (pairs == 0) / 2).mean()) < 1e-12
    assert M.rank_auc(df.filter("y = 1"), "s", "y").first().auc is None


def test_holdout_is_exact(hot):
    held = windows.time_holdout(hot, "day", 0.1)
    days = np.sort([r.day.toordinal() for r in hot.collect()])
    cut = days[math.ceil(0.9 * len(days)) - 1]
    assert {r.id for r in held.filter("is_holdout").collect()} == {r.id for r in hot.collect() if r.day.toordinal() > cut}


# whole series


@pytest.mark.parametrize("n", [8193, 25_000])
def test_long_spectra_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    x, short = rng.normal(40, 12, n), rng.normal(size=7)
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(x)] + [(2, i, float(v)) for i, v in enumerate(short)] + [(3, 0, None)], "k int, i int, v double")
    got = {r.k: r for r in spectra.spectral_features(df, "k", ["i"], ["v"]).collect()}
    assert len(got) == 3 and got[3].fourier == [0.0] * 3
    for k, series in ((1, x), (2, short)):
        want = np.sort(np.abs(np.fft.rfft(series)))[::-1][:3]
        assert np.allclose(got[k].fourier, want, rtol=0, atol=1e-6) and got[k].n == len(series)
        a, s = np.append(series, series[-1:] if len(series) % 2 else []), series[0]
        a = (a[::2] + a[1::2]) / 2**0.5
        a = np.append(a, a[-1:] if len(a) % 2 else [])
        assert np.allclose(got[k].haar2, np.sort(np.abs(a[::2] - a[1::2]) / 2**0.5)[::-1][: len(a) // 2][:3].tolist() + [0.0] * max(0, 3 - len(a) // 2))
        for v in series[1:]:
            s = 0.5 * s + 0.5 * v
        assert abs(got[k].ema - s) < 1e-9


def test_series_of_one_chunk_stay_where_they_lie(spark, monkeypatch):
    """No shuffle follows the written chunks, whose equal lengths are transformed at once; beside longer series they
    have the same features."""
    rng = np.random.default_rng(7)
    series = {k: rng.normal(3, 40, n) for k, n in enumerate([1, 2, 3, 3, 4, 5, 5, 64, 300])}
    df = spark.createDataFrame([(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)] + [(None, i, float(i)) for i in range(3)], "k int, o int, v double")
    alone = spectra.spectral_features(df, "k", ["o"], ["v"])
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
    got = {r.k: r for r in alone.collect()}
    assert len(got) == len(series) + 1 and got[None].n == 3
    for k, x in series.items():
        assert np.allclose(got[k].fourier, np.append(np.sort(np.abs(np.fft.rfft(x)))[::-1], [0.0, 0.0])[:3]) and got[k].n == len(x)
        s = x[0]
        for v in x[1:]:
            s = 0.5 * s + 0.5 * v
        assert abs(got[k].ema - s) < 1e-9
    monkeypatch.setattr(spectra, "STACK", 7)
    assert {r.k: r for r in spectra.spectral_features(df, "k", ["o"], ["v"]).collect()} == got
    long = spark.createDataFrame([(100, i, float(i % 11)) for i in range(spectra.CHUNK + 5)], "k int, o int, v double")
    both = {r.k: r for r in spectra.spectral_features(df.unionByName(long), "k", ["o"], ["v"]).collect()}
    assert both.pop(100).n == spectra.CHUNK + 5 and both == got


# series models


def noise(spark, series):
    return spark.createDataFrame([(k, i, float(v)) for k, x in enumerate(series) for i, v in enumerate(x)], "k int, o int, v double")


def orders_of(df):
    return {r.k: r.ar_order for r in features.grouped_ar(df, "k", ["o"], "v").collect()}


def test_order_does_not_depend_on_the_unit(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 17, (300, 60))
    of = orders_of(noise(spark, x))
    assert np.mean([p == 0 for p in of.values()]) >= 0.65 and len(of) == 300
    assert orders_of(noise(spark, x / 1000)) == of == orders_of(noise(spark, x * 1e6))
    two = np.zeros((200, 300))
    for t in range(2, 300):
        two[:, t] = 0.5 * two[:, t - 1] - 0.4 * two[:, t - 2] + rng.normal(size=200)
    assert np.mean([p == 2 for p in orders_of(noise(spark, two[:, 50:])).values()]) >= 0.7


def test_grouped_ar_equals_brute_force_on_common_points(spark):
    rng = np.random.default_rng(4)
    long = [500.0, 501.0]
    for t in range(2, 12_000):  # the first 2,000 points follow another rule
        long.append((100 + 0.5 * long[-1] + 0.3 * long[-2] if t > 2000 else 300 + 0.2 * long[-1] + 0.2 * long[-2]) + rng.normal())
    cases = [np.array(long), rng.normal(5, 2, 9), rng.normal(5, 2, 6), rng.normal(5, 2, 3)]
    rows = features.grouped_ar(noise(spark, cases), "k", ["o"], "v").orderBy("k", "term").collect()
    for k, series in enumerate(cases):
        most, fits = min(3, (len(series) - 1) // 2), []
        y = series[most:]
        for p in range(most + 1):
            if len(y) - p - 1 < 1:
                continue
            a = np.column_stack([np.ones(len(y)), *(series[most - i : len(series) - i] for i in range(1, p + 1))])
            c, *_ = np.linalg.lstsq(a, y, rcond=None)
            rss = ((y - a @ c) ** 2).sum()
            se = np.sqrt(np.diag(np.linalg.inv(a.T @ a)) * rss / (len(y) - p - 1))
            fits.append((len(y) * np.log(rss / len(y)) + 2 * (p + 1), p, c, c / se, len(y) - p - 1))
        _, p, c, t, free = min(fits, key=lambda f: f[0])
        mine = [r for r in rows if r.k == k]
        assert [r.ar_order for r in mine] == [p] * (p + 1) and np.allclose([r.coefficient for r in mine], c, rtol=1e-6)
        assert np.allclose([r.t_value for r in mine], t, rtol=1e-5)
        x = np.linspace(0, 1, 400_001)  # Student's distribution by its density, from 0 to t
        for r, v in zip(mine, t, strict=True):
            density = math.exp(math.lgamma((free + 1) / 2) - math.lgamma(free / 2)) / math.sqrt(free * math.pi) * (1 + (x * v) ** 2 / free) ** (-(free + 1) / 2)
            assert abs(r.p_value - (1 - 2 * abs(v) * np.trapezoid(density, x))) < 1e-6
        ps = sorted(r.p_value for r in mine)
        assert all(abs(r.p_bonferroni - min(1, r.p_value * (p + 1))) < 1e-12 for r in mine)
        assert all(abs(r.p_bh - min(min(1, q * (p + 1) / (i + 1)) for i, q in enumerate(ps) if q >= r.p_value)) < 1e-9 for r in mine)


def test_grouped_ar_odd_series(spark):
    df = noise(spark, [np.full(10, 5.0), [1.0, 2.0], np.tile([1.0, 2.0], 10)]).unionByName(spark.createDataFrame([(9, i, None) for i in range(5)], "k int, o int, v double"))
    got = {(r.k, r.term): r for r in features.grouped_ar(df, "k", ["o"], "v").collect()}
    assert {k for k, _ in got} == {0, 2}  # two points, or none, have no model
    assert got[0, 0].ar_order == 0 and abs(got[0, 0].coefficient - 5) < 1e-12
    assert got[2, 1].ar_order == 1 and abs(got[2, 1].coefficient + 1) < 1e-6


def test_only_large_keys_are_cut(hot, monkeypatch):
    """Keys of few rows are one window each, without a join with totals; those above the bound are still cut, and
    both give the same rows."""
    run = [
        lambda: scans.ema(hot, ["k"], ["day", "id"], "day", "v", 100),
        lambda: scans.row_numbers(hot, ["k"], ["day", "id"], "day"),
        lambda: scans.block_ids(hot, ["k"], [F.col("day"), F.col("id")], "day", ["attr"]),
        lambda: scd.scd2_from_events(hot, ["k"], "day", ["attr"], ["id"]),
    ]
    whole = [f() for f in run]
    assert not any("Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in whole)
    monkeypatch.setattr(scans, "WHOLE", 1000)
    cut = [f() for f in run]
    assert all("Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in cut)
    for a, b in zip(whole, cut, strict=True):
        assert rows_of(a) == rows_of(b.select(a.columns))


def test_days_lie_in_the_segments_of_their_numbers(spark):
    """The table of days gives what halving gives, before, at and after all cuts and for nulls, in short code."""
    days = spark.range(400).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") - 100).alias("d"))
    days = days.unionByName(spark.createDataFrame([(None,), (dt.date(1, 1, 1),), (dt.date(9999, 12, 31),)], "d date"))
    cuts = [float(19723 + k * k // 60) for k in range(127)]
    for some in (sorted(set(cuts)), cuts[:1]):
        cut = scans.segmented(days, [], "d", some)
        assert cut.filter(~F.col("_seg").eqNullSafe(scans.segment(scans.number(days, "d"), some))).count() == 0
        assert len(cut._jdf.queryExecution().optimizedPlan().toString()) < 2500
