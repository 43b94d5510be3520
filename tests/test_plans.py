"""The physical plans keep the properties the design relies on at scale."""

import __spark_entry__ as entry_mod
from conftest import SF001

Q = entry_mod.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_aggregates_partially_before_shuffle(spark):
    p = plan(Q["dedup_latest"](spark, SF001))
    assert "partial_max_by" in p


def test_group_sample_limits_each_group_before_shuffle(spark):
    p = plan(Q["group_sample"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_phrase_query_normalises_each_row_once(spark):
    p = plan(Q["bool_should"](spark, SF001))
    assert p.count("regexp_replace(lower(text") == 1


def test_record_pipeline_reads_only_needed_columns(spark):
    p = plan(Q["publication_status"](spark, SF001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in p
    assert "o_totalprice" not in p


def test_bm25_does_not_shuffle_the_corpus(spark):
    p = plan(Q["bm25_topk"](spark, SF001))
    # the only exchanges are the top-k merge and the round-robin spread of a small scan
    assert "Exchange hashpartitioning" not in p


def test_chi_squared_reads_its_source_once(spark):
    """The cells are written once; margins are aggregates of that table, never windows over a pair's cells."""
    p = plan(Q["chi2_pairs"](spark, SF001))
    assert "orders.parquet" not in p and "Window" not in p


def test_export_filter_is_pushed_to_the_stored_table(spark):
    p = plan(Q["stored_export"](spark, SF001))
    assert "PushedFilters: [Or(EqualNullSafe(published,NA),Not(EqualNullSafe(publiStatus,publi_nodate)))]" in p


def test_text_does_not_travel_through_keep_latest(spark):
    """Lengths, status and counts are derived before the de-duplication; its shuffle carries no text."""
    from scholarspark.plans.registry import QUERIES
    for name in ("export_table", "log_features", "metrics_reg"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        aggregates = [line for line in plan.splitlines() if "max_by(" in line]
        assert aggregates and not any("abstract#" in line or "title#" in line for line in aggregates), name


def test_the_model_runs_once_a_row(spark):
    for name in ("first_sentence_vec", "embed_text", "sentence_vectors"):
        p = plan(Q[name](spark, SF001))
        assert p.count("ArrowEvalPython") == 1, name
        assert p.count("regexp_replace") <= 4, name


def test_phrase_join_scans_the_corpus_once(spark):
    p = plan(Q["phrase_search"](spark, SF001))
    assert p.count("documents.parquet") == 1 and "CartesianProduct" not in p and "NestedLoop" not in p
