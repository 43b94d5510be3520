"""Hand-made edge cases for the column functions (FIXTURES section 4)."""

from pyspark.sql import functions as F

from scholarspark.functions.citations import cit_first_year, cit_total, cit_two_years_or_more
from scholarspark.functions.dates import parse_date
from scholarspark.functions.recode import category_group, ln_or_null, publication_status
from scholarspark.functions.text import author_count, code_point_length, padded


def test_timespan_counts(spark):
    df = spark.createDataFrame(
        [([("P0Y3M",), ("-P0Y1M",), ("-P3Y1M",), ("P11M",), ("",), (None,)],), (None,), ([],)],
        "citations array<struct<timespan:string>>")
    got = df.select(cit_total().alias("t"), cit_first_year().alias("a"), cit_two_years_or_more().alias("b")).collect()
    assert [tuple(r) for r in got] == [(6, 1, 1), (None, None, None), (0, 0, 0)]


def test_dates(spark):
    df = spark.createDataFrame([("2021",), ("2021-03",), ("2021-03-04",), ("",), ("zz",), (None,)], "d string")
    got = [r[0] for r in df.select(parse_date("d").cast("string")).collect()]
    assert got == ["2021-01-01", "2021-03-01", "2021-03-04", None, None, None]


def test_log_of_zero_is_null(spark):
    got = [r[0] for r in spark.createDataFrame([(0,), (1,)], "x int").select(ln_or_null("x")).collect()]
    assert got == [None, 0.0]


def test_status_rules(spark):
    rows = [("NA", "2020-01-01", "2020-06-01"), ("10.9/1", None, "2020-06-01"), ("10.9/1", "2020-06-01", "2020-01-01"),
            ("10.9/1", "2020-01-01", "2020-12-30"), ("10.9/1", "2020-01-01", "2021-06-01"),
            ("10.9/1", "2020-01-01", "2023-01-01"), (None, "2020-01-01", "2020-02-01")]
    df = spark.createDataFrame(rows, "p string, a string, b string")
    got = [r[0] for r in df.select(publication_status("p", F.to_date("a"), F.to_date("b"))).collect()]
    assert got == ["NP", "publi_nodate", "year1", "year1", "year2", "year2+", "year1"]


def test_lengths_and_authors(spark):
    df = spark.createDataFrame([("é😀", "a;b;"), ("", ""), (None, None)], "t string, a string")
    got = [tuple(r) for r in df.select(code_point_length("t"), author_count("a")).collect()]
    assert got == [(2, 3), (0, 1), (None, None)]


def test_category_first_listing_wins(spark):
    df = spark.createDataFrame([("systems biology",), ("biophysics",), ("marine biology",), (None,)], "c string")
    got = [r[0] for r in df.select(category_group("c")).collect()]
    assert got == ["Bioinfo", "BioPhySystemsBio", "marine biology", None]


def test_phrase_normalisation(spark):
    df = spark.createDataFrame([("CRISPR-Cas9 gene, editing!",)], "t string")
    p = df.select(padded("t")).first()[0]
    assert p == " crispr cas9 gene editing "
    assert df.select(padded("t").contains(padded(F.lit("Cas9-gene")))).first()[0]


def test_citations_sorted_by_duration_not_text(spark):
    from scholarspark.functions.citations import sort_by_span_desc
    df = spark.createDataFrame([([("P9Y0M",), ("",), ("P10Y0M",), ("-P1Y0M",), ("P0Y11M",)],)],
                               "citations array<struct<timespan:string>>")
    got = [c["timespan"] for c in df.select(sort_by_span_desc().alias("s")).first()["s"]]
    assert got == ["P10Y0M", "P9Y0M", "P0Y11M", "-P1Y0M", ""]


def test_month_one_hot_layout(spark):
    from pyspark.ml.functions import vector_to_array
    from scholarspark.operators.features import feature_pipeline
    enc = [s for s in feature_pipeline().getStages() if type(s).__name__ == "OneHotEncoder"][0]
    df = spark.createDataFrame([(m, 0.0, 0.0) for m in range(1, 13)], "month_upload int, server_index double, "
                                                                      "category_grouped_index double")
    out = enc.fit(df).transform(df).select("month_upload", vector_to_array("month_upload_encoded").alias("v"))
    rows = {r.month_upload: list(r.v) for r in out.collect()}
    assert all(len(v) == 12 for v in rows.values())
    assert all(v[0] == 0.0 for v in rows.values())          # slot 0 never set
    assert rows[12] == [0.0] * 12                             # December is the dropped last category
    assert rows[3][3] == 1.0
