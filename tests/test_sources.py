"""Landed pages and lookups: tolerant parsing of missing lists, empty messages and bad numbers."""

import json

from scholarspark.session import shared_path
from scholarspark.sources.lookups import lookup_table, read_citation_responses, read_metadata_responses
from scholarspark.sources.pages import page_completeness, page_records, read_pages


def test_pages_tolerate_missing_parts(spark):
    path = shared_path(spark, "t-pages")
    pages = [
        {"messages": [{"count_new_papers": "2", "total": "2"}],
         "collection": [{"doi": "10.1/1", "version": "1"}, {"doi": "10.1/2", "version": "3"}]},
        {"messages": [], "collection": None},                       # empty messages, no records
        {"messages": [{"count_new_papers": "x", "total": None}]},     # bad numbers, no collection key
    ]
    spark.sparkContext.parallelize([json.dumps(p) for p in pages], 1).saveAsTextFile(path)
    df = read_pages(spark, path)
    recs = sorted((r.doi, r.version) for r in page_records(df).collect())
    assert recs == [("10.1/1", "1"), ("10.1/2", "3")]
    comp = sorted(tuple(r)[1:] for r in page_completeness(df.withColumn("k", df.source_file), "k").collect())
    assert comp == [(0, 0, 0), (0, 0, 0), (2, 2, 2)]


def test_lookup_failures(spark):
    cit_path, meta_path = shared_path(spark, "t-cit"), shared_path(spark, "t-meta")
    spark.sparkContext.parallelize([json.dumps({"doi": "a", "citations": [{"timespan": "P1Y"}]}),
                                    json.dumps({"doi": "b", "citations": None})], 1).saveAsTextFile(cit_path)
    spark.sparkContext.parallelize([json.dumps({"doi": "a", "metadata": [{"pub_date": "2021"}]}),
                                    json.dumps({"doi": "b", "metadata": None}),
                                    json.dumps({"doi": "c", "metadata": [{"pub_date": None}]})], 1).saveAsTextFile(meta_path)
    lk = {r.doi: (r.pub_date, None if r.citations is None else len(r.citations), r.date_ok, r.cit_ok)
          for r in lookup_table(read_citation_responses(spark, cit_path),
                                read_metadata_responses(spark, meta_path)).collect()}
    assert lk == {"a": ("2021", 1, True, True), "b": (None, None, False, False), "c": (None, None, True, False)}


def test_one_response_per_doi_and_missing_sides(spark):
    """Repeated responses do not multiply records; a side that never landed is no success."""
    from scholarspark.operators.records import apply_lookups
    cit = spark.createDataFrame([("a", [("P1Y",)], 1), ("a", [("P2Y",), ("P3Y",)], 2), ("a", None, 3), ("b", [("P1Y",)], 1)],
                                "doi string, citations array<struct<timespan:string>>, landed_at long")
    meta = spark.createDataFrame([("a", [("2020",)], 1), ("a", [("2021",)], 2), ("a", None, 9), ("c", [("2022",)], 1)],
                                 "doi string, metadata array<struct<pub_date:string>>, landed_at long")
    target = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, None), (6, "NA")], "_id long, published string")
    target = target.selectExpr("*", "cast(null as string) publiDate", "cast(null as array<struct<timespan:string>>) citations")
    got = {r["_id"]: (r["publiDate"], r["citations"] and len(r["citations"]), r["enriched"])
           for r in apply_lookups(target, lookup_table(cit, meta)).collect()}
    none = (None, None, False)
    assert got == {1: ("2021", 2, True), 2: ("2021", 2, True), 3: none, 4: none, 5: none, 6: none}
