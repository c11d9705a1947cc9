"""Models on Spark ML: features, clustering, regression, classification, selection, stacking, metrics."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from math import exp, lgamma, log

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.feature import ChiSqSelector, OneHotEncoder, PolynomialExpansion, StandardScaler, StringIndexer, VectorAssembler, VectorIndexer, VectorSlicer, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake.functions.scalars import decode_prediction
from gamelake.operators import scans

SEED = 42


def feature_pipeline(cols: Sequence[str], out: str = "features") -> Pipeline:
    """Assemble and standardise."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="_raw", handleInvalid="keep"), StandardScaler(inputCol="_raw", outputCol=out, withMean=True)])


def counted(df: DataFrame, cols: Sequence[str], name: str = "weight") -> DataFrame:
    """The different rows of some columns and how often each is there, a double: what models read instead of rows
    that repeat, with the same sums."""
    return df.groupBy(*cols).agg(F.count("*").cast("double").alias(name))


def chi_square_p(statistic: float, degrees: int) -> float:
    """1 - the chi-square distribution at a statistic, by the series of the lower or the fraction of the upper
    incomplete gamma function."""
    a, x = degrees / 2.0, statistic / 2.0
    if degrees < 1 or x <= 0:
        return 1.0
    head = exp(a * log(x) - x - lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= x / n
            total += term
        return 1.0 - head * total
    tiny, b = 1e-300, x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        b += 2
        d = 1 / ((-i * (i - a) * d + b) or tiny)
        c = (b - i * (i - a) / c) or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return 1.0 - (1.0 - head * h)  # to the digits of the distribution, as Spark has it, so that ties are the same


class WeightedChiSq(Estimator):
    """``ChiSqSelector`` (numTopFeatures) of rows that each stand for ``weight`` rows. Counts are grouped by feature,
    value and label; a row a feature reaches the driver."""

    def __init__(self, top: int, features: str, out: str, label: str, weight: str) -> None:
        super().__init__()
        self.top, self.features, self.out, self.label, self.weight = top, features, out, label, weight

    def _fit(self, df: DataFrame) -> VectorSlicer:
        each = df.select(F.posexplode(vector_to_array(self.features)).alias("i", "v"), F.col(self.label).alias("y"), F.col(self.weight).alias("w"))
        cells = each.groupBy("i", "v", "y").agg(F.sum("w").alias("o"))
        over = lambda *c: F.sum("o").over(Window.partitionBy("i", *c))
        parts = cells.withColumn("_p", F.col("o") * F.col("o") / over("v") / over("y")).groupBy("i").agg(F.sum("_p").alias("p"), F.sum("o").alias("n"), F.count_distinct("v").alias("r"), F.count_distinct("y").alias("c"))
        told = [(chi_square_p(t["n"] * (t["p"] - 1.0), (t["r"] - 1) * (t["c"] - 1)), t["i"]) for t in parts.collect()]
        return VectorSlicer(inputCol=self.features, outputCol=self.out, indices=sorted(i for _, i in sorted(told)[: self.top]))


def regression_stages(numeric: Sequence[str], categories: Sequence[str], degree: int = 2, top: int | None = None, label: str | None = None, weight: str | None = None) -> list:
    """Index and one-hot the categories, expand the numbers, scale, index small domains, select by chi-square. With
    weights categories are in alphabetic order, and the scale is that of the different rows, a unit on which
    neither the selection nor a standardised or tree model depends."""
    stages: list = []
    if categories:
        stages += [StringIndexer(inputCols=list(categories), outputCols=[f"{c}_ix" for c in categories], handleInvalid="keep", stringOrderType="alphabetAsc" if weight else "frequencyDesc"), OneHotEncoder(inputCols=[f"{c}_ix" for c in categories], outputCols=[f"{c}_hot" for c in categories])]
    stages += [
        VectorAssembler(inputCols=list(numeric), outputCol="_n"),
        PolynomialExpansion(degree=degree, inputCol="_n", outputCol="_p"),
        VectorAssembler(inputCols=["_p", *(f"{c}_hot" for c in categories)], outputCol="_all"),
        StandardScaler(inputCol="_all", outputCol="_s"),
        VectorIndexer(inputCol="_s", outputCol="_x" if top else "features", maxCategories=4, handleInvalid="keep"),
    ]
    if top and weight:
        stages.append(WeightedChiSq(top, "_x", "features", label, weight))
    elif top:
        stages.append(ChiSqSelector(numTopFeatures=top, featuresCol="_x", outputCol="features", labelCol=label))
    return stages


def _cluster(df: DataFrame, cols: Sequence[str], estimator, grid, folds: int) -> PipelineModel:
    prepared = feature_pipeline(cols).fit(df)
    x = prepared.transform(df).select("features").persist()
    model = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ClusteringEvaluator(), numFolds=folds, seed=SEED).fit(x).bestModel
    x.unpersist()
    return PipelineModel([*prepared.stages, model])


def fit_kmeans(df: DataFrame, cols: Sequence[str], ks: Sequence[int], iterations: Sequence[int] = (20,), folds: int = 3) -> PipelineModel:
    """K-means with k and iterations by silhouette in cross-validation."""
    km = KMeans(seed=SEED)
    return _cluster(df, cols, km, ParamGridBuilder().addGrid(km.k, list(ks)).addGrid(km.maxIter, list(iterations)).build(), folds)


def fit_gmm(df: DataFrame, cols: Sequence[str], ks: Sequence[int], folds: int = 3, iterations: Sequence[int] = (100,)) -> PipelineModel:
    gm = GaussianMixture(seed=SEED)
    return _cluster(df, cols, gm, ParamGridBuilder().addGrid(gm.k, list(ks)).addGrid(gm.maxIter, list(iterations)).build(), folds)


def assign_clusters(df: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(df).withColumnRenamed("prediction", "cluster").drop("_raw", "features", "probability")


def time_split(df: DataFrame, date: str, cutoff: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Rows before and from the cutoff; a hash split by row if either side would be empty."""
    before, after = df.filter(F.col(date) < F.lit(cutoff).cast("date")), df.filter(F.col(date) >= F.lit(cutoff).cast("date"))
    if before.limit(1).count() and after.limit(1).count():
        return before, after
    place = F.pmod(F.xxhash64(*df.columns), F.lit(10_000)) < int(10_000 * share)  # by the row, whatever the partitions
    return df.filter(place), df.filter(~place)


def fit_regression(df: DataFrame, target: str, numeric: Sequence[str], categories: Sequence[str] = (), kind: str = "linear", folds: int = 3, degree: int = 2, top: int | None = None, chi_label: str | None = None, weight: str | None = None, fold: str | None = None) -> PipelineModel:
    """Linear or boosted-tree regression; its parameters by cross-validated error. With ``top`` only as many
    features stay, those with the strongest chi-square test against ``chi_label`` (a column of classes). With
    ``weight`` each row stands for so many equal ones (``counted``). ``fold``: a column of fold numbers, which
    rows must have before they are counted."""
    est = LinearRegression(labelCol=target) if kind == "linear" else GBTRegressor(labelCol=target, seed=SEED, maxIter=10)
    grid = ParamGridBuilder().addGrid(est.regParam, [0.0, 0.1]).build() if kind == "linear" else ParamGridBuilder().addGrid(est.maxDepth, [2, 4]).build()
    own = {"weightCol": weight} if weight else {}
    pipe = Pipeline(stages=[*regression_stages(numeric, categories, degree, top, chi_label, weight), est.setParams(**own)])
    dealt = {"foldCol": fold} if fold else {}
    return CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol=target, **own), numFolds=folds, seed=SEED, **dealt).fit(df).bestModel


def lasso_select(df: DataFrame, label: str, cols: Sequence[str], threshold: float = 1e-4, folds: int = 3, strengths: Sequence[float] = (0.01, 0.1, 1.0)) -> DataFrame:
    """feature, coefficient of the columns that an L1 regression keeps above the threshold."""
    x = feature_pipeline(cols).fit(df).transform(df).select("features", F.col(label).cast("double").alias("label"))
    lr = LinearRegression(elasticNetParam=1.0)
    grid = ParamGridBuilder().addGrid(lr.regParam, list(strengths)).build()
    best = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(), numFolds=folds, seed=SEED).fit(x).bestModel
    rows = [(c, float(w)) for c, w in zip(cols, best.coefficients, strict=True) if abs(w) > threshold]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def fit_classifier(df: DataFrame, label: str, cols: Sequence[str], fold: str | None = None, folds: int = 3, depths: Sequence[int] = (2, 4), rounds: int = 10) -> PipelineModel:
    """Boosted trees. The depth is chosen by time folds (a column of fold numbers, see
    ``windows.time_folds``: each fold is judged by a model of the folds before it) or by a shuffled
    validation split; the model is then fitted on all rows. Rows are assembled once and kept while models are
    fitted, so that no pass computes folds or other columns of theirs again."""
    x, gbt = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep"), GBTClassifier(labelCol=label, seed=SEED, maxIter=rounds)
    grid, ev = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).build(), BinaryClassificationEvaluator(labelCol=label)
    ready = x.transform(df).select("features", label, *([fold] if fold else [])).persist()
    if not fold:
        best = TrainValidationSplit(estimator=gbt, estimatorParamMaps=grid, evaluator=ev, trainRatio=0.8, seed=SEED).fit(ready).bestModel
    else:
        merit = [0.0] * len(grid)
        for k in range(1, folds):
            before, now = ready.filter(F.col(fold) < k), ready.filter(F.col(fold) == k)
            merit = [m + ev.evaluate(gbt.fit(before, p).transform(now)) for m, p in zip(merit, grid, strict=True)]
        best = gbt.fit(ready, grid[merit.index(max(merit))])
    ready.unpersist()
    return PipelineModel([x, best])


def settings(many: int, seed: int = SEED) -> list[dict[str, float]]:
    """Different parameter sets of boosted trees in a seeded order."""
    grid = [{"maxDepth": d, "maxIter": i, "stepSize": s, "subsamplingRate": r, "minInstancesPerNode": m} for d in (1, 2, 3, 4, 5) for i in (4, 8, 12) for s in (0.05, 0.1, 0.2, 0.4) for r in (0.6, 0.8, 1.0) for m in (1, 5, 20)]
    return random.Random(seed).sample(grid, many)


def halving_search(train: DataFrame, holdout: DataFrame, label: str, cols: Sequence[str], key: str, fold: str, folds: int = 3, many: int = 8, rungs: int = 3, seed: int = SEED) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees by successive halving: all settings are tried on a share of the rows of each time fold, the
    better half goes on with twice the rows, the last rung has all of them. A fold is judged by a model of the
    folds before it; a setting's figure is its mean AUC. The best one is fitted on all of ``train``.

    Returns that model and a row for every setting and rung: rung, rows (their share), setting, its
    parameters, fold_auc (array), mean_auc, went_on, and the hold-out's AUC on the winner's last row. Shares are
    by a hash of the key, so a larger one holds the smaller. Models are fitted one after the other, each over
    the whole cluster."""
    spark, tried, alive = train.sparkSession, [], list(enumerate(settings(many, seed)))
    place = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    assembler, ev = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep"), BinaryClassificationEvaluator(labelCol=label)
    ready = assembler.transform(train.withColumn("_place", place)).select("features", label, fold, "_place").persist()
    fit = lambda df, p: GBTClassifier(labelCol=label, seed=seed, **p).fit(df)
    for rung in range(rungs):
        share = 0.5 ** (rungs - 1 - rung)
        part = ready.filter(F.col("_place") < share)
        scored = []
        for number, p in alive:
            found = [ev.evaluate(fit(part.filter(F.col(fold) < k), p).transform(part.filter(F.col(fold) == k))) for k in range(1, folds)]
            scored.append((sum(found) / len(found), number, p, found))
        scored.sort(key=lambda s: (-s[0], s[1]))
        stay = 1 if rung == rungs - 1 else max(1, len(scored) // 2)
        tried += [(rung, share, n, {k: float(v) for k, v in p.items()}, f, m, place < stay) for place, (m, n, p, f) in enumerate(scored)]
        alive = [(n, p) for _, n, p, _ in scored[:stay]]
    winner, p = alive[0]
    model = PipelineModel([assembler, fit(ready, p)])
    ready.unpersist()
    reached = auc(score(holdout, model, "holdout"), label)
    rows = [(*t, reached if t[0] == rungs - 1 and t[2] == winner else None) for t in tried]
    return model, spark.createDataFrame(rows, "rung int, rows double, setting int, parameters map<string,double>, fold_auc array<double>, mean_auc double, went_on boolean, holdout_auc double")


def split_by_time(df: DataFrame, date: str, today: str, root: str) -> tuple[DataFrame, DataFrame]:
    """Scored rows as two written tables: those dated up to a day and those after it. Rows without a date are
    historical."""
    later = F.coalesce(F.col(date) > F.lit(today).cast("date"), F.lit(False))
    df.withColumn("when", F.when(later, "future").otherwise("historical")).write.mode("overwrite").partitionBy("when").parquet(root)
    back = df.sparkSession.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, when string").parquet(root)
    return back.filter("when = 'historical'").drop("when"), back.filter("when = 'future'").drop("when")


def fit_regressors(df: DataFrame, targets: Sequence[str], cols: Sequence[str], rounds: int = 10, depth: int = 3) -> dict[str, PipelineModel]:
    """A boosted-tree regressor for each target, on one assembled and persisted table."""
    x = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep")
    ready = x.transform(df).select("features", *targets).persist()
    out = {t: PipelineModel([x, GBTRegressor(labelCol=t, seed=SEED, maxIter=rounds, maxDepth=depth, predictionCol=f"predicted_{t}").fit(ready)]) for t in targets}
    ready.unpersist()
    return out


def predict_future(df: DataFrame, model: PipelineModel, date: str, days: int, prediction: str) -> DataFrame:
    """Predictions with the date that they are for."""
    return model.transform(df).withColumn("future_date", F.date_add(date, days)).select(*df.columns, "future_date", prediction)


def score(df: DataFrame, model: PipelineModel, tag: str, labels: tuple[str, str] = ("loss", "win"), threshold: float = 0.5) -> DataFrame:
    """Probability, label text and a tag of what kind of score it is."""
    p = vector_to_array("probability")[1]
    return model.transform(df).withColumns({"score": p, "predicted_label": decode_prediction(p, threshold, labels), "prediction_type": F.lit(tag)}).drop("features", "rawPrediction", "probability", "prediction")


def regression_metrics(df: DataFrame, y: str, yhat: str, digits: int = 6, weight: str | None = None) -> DataFrame:
    """RMSE, MAE, R2 and MAPE (without zero targets), in one aggregate; with ``weight`` each row stands for so many."""
    w = F.col(weight) if weight else F.lit(1)
    total = (lambda x: F.sum(w * x)) if weight else F.sum
    many = (lambda x: F.sum(F.when(x.isNotNull(), w))) if weight else F.count
    mean: Callable[[Column], Column] = (lambda x: total(x) / many(x)) if weight else F.avg
    e, t = F.col(y).cast("double") - F.col(yhat).cast("double"), F.col(y).cast("double")
    return df.agg(
        F.round(F.sqrt(mean(e * e)), digits).alias("rmse"),
        F.round(mean(F.abs(e)), digits).alias("mae"),
        F.round(1 - total(e * e) / (total(t * t) - total(t) * total(t) / many(t)), digits).alias("r2"),
        F.round(mean(F.when(t != 0, F.abs(e / t))), digits).alias("mape"),
    )


def confusion(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.groupBy(F.col(y).cast("int").alias("actual"), F.col(yhat).cast("int").alias("predicted")).agg(F.count("*").alias("n"))


def rank_auc(df: DataFrame, score: str, label: str, parts: int | None = None) -> DataFrame:
    """One row, auc: the share of pairs of a row with label 1 and one with label 0 that the score puts in order,
    ties as half. Scores are counted by value, and running counts give the negatives below each. Null scores
    are left out; null (not a number) without both labels."""
    hit = (F.col(label) == 1).cast("long")
    each = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).cast("double").alias("_s")).agg(F.sum(hit).alias("_p"), F.sum(1 - hit).alias("_m"))
    below = scans.running_sums(each, [], ["_s"], "_s", {"_upto": F.col("_m")}, parts)
    good = F.sum(F.col("_p") * (F.col("_upto") - F.col("_m") / 2.0))
    return below.agg(F.when((F.sum("_p") > 0) & (F.sum("_m") > 0), good / F.sum("_p") / F.sum("_m")).alias("auc"))


def classification_metrics(df: DataFrame, y: str, yhat: str, digits: int = 6, score: str | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 of label 1; with a score column its AUC, too."""
    tp, fp = F.count_if((F.col(y) == 1) & (F.col(yhat) == 1)), F.count_if((F.col(y) == 0) & (F.col(yhat) == 1))
    fn, n = F.count_if((F.col(y) == 1) & (F.col(yhat) == 0)), F.count("*")
    div = lambda a, b: F.round(F.when(b > 0, a.cast("double") / b).otherwise(0.0), digits)
    out = df.agg(div(F.count_if(F.col(y) == F.col(yhat)), n).alias("accuracy"), div(tp, tp + fp).alias("precision"), div(tp, tp + fn).alias("recall"), div(2 * tp, 2 * tp + fp + fn).alias("f1"))
    return out if score is None else out.withColumn("auc", F.round(rank_auc(df, score, y).scalar(), digits))


def auc(df: DataFrame, label: str, raw: str = "score") -> float:
    return rank_auc(df, raw, label).first()["auc"]


def interval_metrics(df: DataFrame, y: str, low: str, high: str, alpha: float = 0.1, digits: int = 6) -> DataFrame:
    """Coverage (PICP), normalised width (PINAW) and the mean Winkler score."""
    t, a, b = (F.col(c).cast("double") for c in (y, low, high))
    miss = F.when(t < a, (a - t) * (2 / alpha)).when(t > b, (t - b) * (2 / alpha)).otherwise(0.0)
    return df.agg(
        F.round(F.avg(F.when(t.between(a, b), 1.0).otherwise(0.0)), digits).alias("picp"),
        F.round(F.avg(b - a) / (F.max(t) - F.min(t)), digits).alias("pinaw"),
        F.round(F.avg(b - a + miss), digits).alias("winkler"),
    )


def important_features(df: DataFrame, label: str, cols: Sequence[str], trees: int = 10) -> DataFrame:
    x = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep").transform(df)
    m = RandomForestRegressor(labelCol=label, numTrees=trees, seed=SEED).fit(x)
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(cols, m.featureImportances.toArray(), strict=True)], "feature string, importance double")


def _candidates(label: str) -> dict:
    return {
        "linear": LinearRegression(labelCol=label),
        "forest": RandomForestRegressor(labelCol=label, seed=SEED, numTrees=10, maxDepth=4),
        "boosted": GBTRegressor(labelCol=label, seed=SEED, maxIter=5, maxDepth=3),
    }


def compare_models(train: DataFrame, test: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Errors of several models on the same split, as rows of a table."""
    x = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep")
    fit_on, held = x.transform(train).persist(), x.transform(test)
    parts = [regression_metrics(est.fit(fit_on).transform(held), label, "prediction").withColumn("model", F.lit(name)) for name, est in _candidates(label).items()]
    fit_on.unpersist()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stack_models(df: DataFrame, label: str, cols: Sequence[str], key: str, folds: int = 2) -> DataFrame:
    """key, label and the prediction of a linear model over out-of-fold predictions of several models.
    Folds are hashes of the key; predictions of a fold are one projection after another, without a join."""
    x = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep")
    ready = x.transform(df).withColumn("_fold", F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")).persist()
    parts = []
    for k in range(folds):
        out = ready.filter(F.col("_fold") == k)
        for name, est in _candidates(label).items():
            out = est.setPredictionCol(f"p_{name}").fit(ready.filter(F.col("_fold") != k)).transform(out)
        parts.append(out)
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    meta_in = VectorAssembler(inputCols=[f"p_{n}" for n in _candidates(label)], outputCol="_meta").transform(whole)
    meta = LinearRegression(featuresCol="_meta", labelCol=label, predictionCol="stacked").fit(meta_in)
    ready.unpersist()
    return meta.transform(meta_in).select(key, label, "stacked")


def embed_word2vec(df: DataFrame, words: str, dim: int = 32, least: int = 5, name: str = "vector") -> DataFrame:
    """Learned word vectors, averaged per row."""
    return Word2Vec(vectorSize=dim, minCount=least, inputCol=words, outputCol=name, seed=SEED).fit(df).transform(df)
