"""Texts as vectors; searches and splits of models."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gamelake.operators import ml as M
from gamelake.operators import vectors
from gamelake.plans import registry


def dense(counts, model):
    """The weighted rows as numpy sees them."""
    rows = []
    for r in counts:
        row = np.zeros(len(model.idf))
        for i, tf in zip(r["_ids"], r["_tfs"], strict=True):
            row[i] = (1 + np.log(tf)) * model.idf[i]
        rows.append(row / max(np.linalg.norm(row), 1e-300))
    return np.array(rows)


def test_text_svd_equals_numpy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 80").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(1000, None), (1001, ""), (1002, "... !")], "doc_id long, text string"))
    model = vectors.fit_text_svd(docs, "text", rank=4, features=256, more=12, passes=8)
    counted = vectors.word_counts(docs, "text", 256).collect()
    sizes = {r.doc_id: sum(r["_tfs"]) for r in counted}
    assert sizes[1000] == sizes[1001] == sizes[1002] == 0
    a = dense(counted, model)
    present = (a > 0).sum(0)
    some = present > 0
    assert np.allclose(model.idf[some], np.log((1 + (a.any(1)).sum()) / (1 + present[some])) + 1)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(model.values, s[:4], rtol=1e-6)
    assert np.allclose(np.abs(np.sum(model.components * vt[:4].T, axis=0)), 1, atol=1e-4)
    got = {r.doc_id: np.array(r.vector) for r in vectors.embed(docs, "text", model).collect()}
    want = a @ model.components
    for r, w in zip(counted, want, strict=True):
        assert np.allclose(got[r.doc_id], w / max(np.linalg.norm(w), 1e-300))
    again = vectors.fit_text_svd(docs.repartition(3), "text", rank=4, features=256, more=12, passes=8)
    assert np.allclose(again.components, model.components, atol=1e-6)


def test_neighbours_share_their_language(spark, sf):
    sf = sf.replace("0.001", "0.01")
    of = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in registry.QUERIES["embed_text_svd"](spark, sf).collect() if any(r.vector) and of[r.doc_id]]
    v = np.array([r.vector for r in rows])
    near = v @ v.T - 2 * np.eye(len(v))
    same = np.mean([of[rows[i].doc_id] == of[rows[j].doc_id] for i, j in enumerate(near.argmax(1))])
    chance = sum((n / len(rows)) ** 2 for n in Counter(of[r.doc_id] for r in rows).values())
    assert same > 0.9 > chance + 0.3


def test_halving_goes_on_with_the_better_half(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 2))
    df = spark.createDataFrame([(i, float(a), float(b), int(a + 0.3 * rng.normal() > 0), i % 3) for i, (a, b) in enumerate(x)], "id long, a double, b double, y int, fold int")
    model, rows = M.halving_search(df.filter("id < 750"), df.filter("id >= 750"), "y", ["a", "b"], "id", "fold", many=4, rungs=2)
    rows = rows.collect()
    assert Counter(r.rung for r in rows) == {0: 4, 1: 2} and {r.rows for r in rows} == {0.5, 1.0}
    first = sorted((r for r in rows if r.rung == 0), key=lambda r: -r.mean_auc)
    assert {r.setting for r in first[:2]} == {r.setting for r in rows if r.rung == 1} == {r.setting for r in first if r.went_on}
    assert all(abs(r.mean_auc - np.mean(r.fold_auc)) < 1e-12 and len(r.fold_auc) == 2 for r in rows)
    won = [r for r in rows if r.holdout_auc is not None]
    assert len(won) == 1 and won[0].holdout_auc > 0.9 and won[0].mean_auc == max(r.mean_auc for r in rows if r.rung == 1)
    assert M.auc(M.score(df.filter("id >= 750"), model, "t"), "y") == won[0].holdout_auc
    assert len({tuple(sorted(s.items())) for s in M.settings(20)}) == 20 and M.settings(5) == M.settings(5)


def test_split_is_by_the_row(spark):
    df = spark.range(2000).select(F.col("id"), F.lit("2020-01-01").cast("date").alias("d"))
    train, test = M.time_split(df, "d", "1990-01-01")
    again = M.time_split(df.repartition(7), "d", "1990-01-01")
    assert sorted(r.id for r in train.collect()) == sorted(r.id for r in again[0].collect())
    assert train.count() + test.count() == 2000 and 1500 < train.count() < 1700


def test_scores_are_split_by_time(spark, tmp_path):
    df = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-02"), (3, None)], "k int, d string").withColumn("d", F.to_date("d"))
    past, future = M.split_by_time(df, "d", "2020-01-01", str(tmp_path / "s"))
    assert sorted(r.k for r in past.collect()) == [1, 3] and [r.k for r in future.collect()] == [2]


@pytest.mark.parametrize("kind", ["linear", "gbt"])
def test_categories_help(spark, kind):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(int(a), "xyz"[c], float(3 * a + 10 * c), int(c == 2)) for a, c in zip(rng.integers(0, 3, 300), rng.integers(0, 3, 300), strict=True)], "a int, c string, y double, top int")
    model = M.fit_regression(df, "y", ["a"], ["c"], kind, 2, 1, 3, "top")
    assert M.regression_metrics(model.transform(df), "y", "prediction").first().r2 > 0.7


def test_categories_query(spark, sf):
    rows = {r.kind: r for r in registry.QUERIES["fit_categories"](spark, sf).collect()}
    assert set(rows) == {"linear", "gbt"} and all(r.r2 > 0.8 and r.mae <= r.rmse for r in rows.values())


def test_products_take_a_slice_of_texts_at_a_time():
    batch = pa.RecordBatch.from_arrays([pa.array([[i % 7, 8] for i in range(600)], pa.list_(pa.int32())), pa.array([[1, 2]] * 600, pa.list_(pa.int32()))], ["_ids", "_tfs"])
    idf, q = np.arange(1.0, 10.0), np.random.default_rng(1).normal(size=(9, 3))
    pieces = list(vectors.slices(batch))
    assert max(p.num_rows for p in pieces) <= vectors.SLICE < 600
    whole = vectors.times(*vectors.rows_of(batch, idf), 600, q)
    assert np.allclose(np.concatenate([vectors.times(*vectors.rows_of(p, idf), p.num_rows, q) for p in pieces]), whole)


@pytest.mark.parametrize("kind", ["linear", "gbt"])
def test_counted_rows_give_the_fit_of_all_rows(spark, kind):
    """Weights, folds and the chi-square selection: as with every row, in another order of the categories at most."""
    rng = np.random.default_rng(4)
    a, b, c, k = rng.integers(0, 4, 900), rng.integers(0, 9, 900), rng.integers(0, 3, 900), rng.integers(0, 2, 900)
    rows = [(int(x), int(y), "xyz"[z], float(3 * x + y % 4 + 10 * z), int(z == 2), int(f)) for x, y, z, f in zip(a, b, c, k, strict=True)]
    df = spark.createDataFrame(rows, "a int, b int, c string, y double, top int, f int")
    few = M.counted(df, df.columns)
    args = ["a", "b"], ["c"], kind, 2, 1, 3, "top"
    whole, less = M.fit_regression(df, "y", *args, fold="f"), M.fit_regression(few, "y", *args, weight="weight", fold="f")
    assert few.count() < 300 and few.agg({"weight": "sum"}).first()[0] == 900
    one, two = M.regression_metrics(whole.transform(df), "y", "prediction", 4).first(), M.regression_metrics(less.transform(few), "y", "prediction", 4, "weight").first()
    assert np.allclose(one, two, atol=2e-4) and one.r2 > 0.7


def test_chi_square_selection_of_counted_rows(spark):
    from pyspark.ml.feature import ChiSqSelector, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    rng = np.random.default_rng(5)
    y = rng.integers(0, 3, 2000)
    rows = [(int(t), int(rng.integers(0, 4)), int((t + rng.integers(0, 3)) % 5), int(t == 1 and rng.random() < 0.2), int(rng.integers(0, 2))) for t in y]
    df = spark.createDataFrame(rows, "y int, a int, b int, c int, d int")
    to = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="x")
    few = to.transform(M.counted(df, df.columns))
    want = ChiSquareTest.test(to.transform(df), "x", "y", flatten=True).orderBy("featureIndex").collect()
    assert np.allclose([M.chi_square_p(r.statistic, r.degreesOfFreedom) for r in want], [r.pValue for r in want], atol=1e-12)
    assert [M.chi_square_p(s, 5) for s in (0.0, 1e4)] == [1.0, 0.0]
    for top in (1, 2, 3):
        got = M.WeightedChiSq(top, "x", "z", "y", "weight")._fit(few).getIndices()
        assert got == list(ChiSqSelector(numTopFeatures=top, featuresCol="x", outputCol="z", labelCol="y").fit(to.transform(df)).selectedFeatures)
