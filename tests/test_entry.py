import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50


def test_rows_only_queries_are_the_declared_ones():
    qs, sql = entry.queries(), entry.oracle_sql()
    own = {q for q in qs if not q.startswith("op") and q != "pipeline"}
    assert own - set(sql) == {"gbt_train_predict", "feature_importance_topk", "pipeline_metrics", "monitor_pipeline"}
