"""Registered queries: columns of the contracts, and SQL where there is some."""

import duckdb
import pytest

from scholarspark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3": "doc_id held_out score predicted", "op4": "doc_id n_bytes n_tokens over_limit",
    "op5": "doc_id size text_crc32 law shard slot grown_shard", "op6": "doc_id held_out lang_pred score",
    "op8": "doc_id n_tokens ids_sha256 decoded_sha256", "op9": "doc_id start n_tokens ids_crc32",
    "op10": "doc_id n_bytes n_removed n_spans kept_sha256", "op2": "doc_id item_id", "op7": "doc_id class_id n_links",
    "op11": "lang rank phrase a l r n score", "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256", "op13": "page_id host path rule verdict",
}


def test_one_query_an_operator():
    assert sorted(q.split("_")[0] for q in QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    df = QUERIES[name](spark, SF)
    want = COLUMNS[name.split("_")[0]].split()
    assert df.columns[:len(want)] == want
    if not name.startswith(("op2_", "op11_")):
        source = "pages" if name.startswith("op13_") else "documents"
        assert df.count() == spark.read.parquet(f"{SF}/{source}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df, rel = QUERIES[name](spark, SF), con.sql(ORACLE_SQL[name])
    assert df.columns == rel.columns
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())
