"""Toxicity classifier (operator 5): a linear model on character n-grams scaled by naive Bayes ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm.common import fold
from gamelake.llm.nb_linear import Model, Spec, fit, score

#: N-grams show where words begin: what is toxic may differ from clean words in that only.
SPEC = Spec(orders=(4, 6, 8), loss="hinge", bits=20, blank=True, alpha=30.0, cost=1.0, epochs=8, least=5, max_rows=8_000, max_bytes=32_000_000, max_features=60_000_000)


def fit_toxicity(docs: DataFrame, labels: DataFrame, spec: Spec = SPEC) -> Model:
    """Hinge-loss model fitted by dual coordinate descent, with Platt's scaling, on labelled documents outside the
    held-out fifth. Odd rows, empty tables and other columns as in ``quality.fit_quality``."""
    return fit(docs, labels.filter(fold(F.col("doc_id"), 5) != 0), "text", "doc_id", "toxic", spec)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on): one row per row of docs.

    Null and empty texts get the score of a text without n-grams. Repeated rows are scored alike.
    Null ids are not held out. An empty table gives an empty one; other columns are left out."""
    return docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), score(F.col("text"), model, docs).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
