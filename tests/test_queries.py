"""Every registered query against its SQL at the smallest scale; the others must give rows."""

import subprocess
import sys

import pytest

from gamelake.operators import aggregates as A
from gamelake.plans import registry
from tests.oracle import assert_same, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sf, con, name):
    assert_same(registry.QUERIES[name](spark, sf), con, registry.ORACLE_SQL[name])


#: Run and held against numpy or a definition in test_model_queries.py and test_vectors.py.
ELSEWHERE = set("compare_models embed_text embed_text_svd feature_importance fit_categories fit_classifier fit_classifier_shuffled fit_linear fit_regressors gmm_assign kmeans_assign spectral_features stack_models wave_features".split())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL) - ELSEWHERE))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("absent", ["xxhash", "gamelake.llm", "corpus_pipeline"])
def test_entry_module_without_text_operators(absent):
    """A package that only the text operators need is absent: the other queries are there."""
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; from gamelake.plans import registry as r; assert set(r.QUERIES) <= set(e.queries()) and set(r.ORACLE_SQL) <= set(e.oracle_sql()); assert 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_group_advanced_is_compiled(spark, sf):
    """No method over 8,000 bytes, which the JVM would interpret, and no join of the groups with themselves."""
    df = registry.QUERIES["group_advanced"](spark, sf)
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan parquet") == 2  # lines, orders
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = registry.QUERIES["group_advanced"](spark, sf)._jdf.queryExecution().debug().codegenToSeq()
        assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) <= 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_season_summary_groups_no_events(spark, sf):
    """Members' rows have an event once: two groupings, partial and final, and a shuffle beside that of the lines."""
    plan = registry.QUERIES["season_summary"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(") == 2 and plan.count("Exchange hashpartitioning(member_id") == 1
    rows = spark.createDataFrame([(1, 7, 2), (1, 8, 4), (1, None, 3), (2, 7, 1)], "k int, e int, x int")
    both = [sorted(map(tuple, A.summary(rows, ["k"], "e", ["x"], unique=u).collect())) for u in (False, True)]
    assert both[0] == both[1] == [(1, 2, 3.0), (2, 1, 1.0)]
