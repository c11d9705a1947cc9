"""Quality classifier (operator 10): naive Bayes support vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm.common import fold, fresh
from gamelake.llm.nb_linear import Model, Spec, fit, score

#: Case is kept: shouting is a sign of junk.
SPEC = Spec(orders=(1, 2, 3, 4), loss="hinge", lower=False, cost=0.01)
ACCEPT = 0.3


def fit_quality(docs: DataFrame, labels: DataFrame, spec: Spec = SPEC) -> Model:
    """Scale n-gram indicators by class log-count ratios and fit a hinge-loss model by dual
    coordinate descent, on labelled documents outside the held-out fifth.

    Null texts are empty ones; labels that are null or neither 0 nor 1, and rows without an id, take no
    part; of an id's repeated rows one counts. Without labels of both classes every score is the same;
    empty tables give such a model. Other columns are not read."""
    return fit(docs, labels.filter(fold(F.col("doc_id"), 5) != 0), "text", "doc_id", "quality", spec)


def score_quality(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from ``accept`` on): one row per row of docs.

    Null and empty texts get the score of a text without n-grams. Repeated rows are scored alike.
    Null ids are not held out. An empty table gives an empty one; other columns are left out."""
    return docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), score(F.col("text"), model, docs).alias("score")).withColumn(
        "predicted", (F.col("score") >= accept).cast("int")
    )


def keep_good(docs: DataFrame, labels: DataFrame, spec: Spec = SPEC, accept: float = ACCEPT) -> DataFrame:
    """The rows of docs that the classifier accepts, with their columns, whatever their names.

    Null and empty texts are judged as texts without n-grams, rows without an id by their text; repeated
    rows all stay or all go. Without labels of both classes every row has the same score. An empty table
    gives an empty one."""
    (own,) = fresh(docs, "quality_score")
    model = fit_quality(docs, labels, spec)
    return docs.withColumn(own, score(F.col("text"), model, docs)).filter(F.col(own) >= accept).select(*docs.columns)
