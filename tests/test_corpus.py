"""Dates, filters, distinct rows, samples, queries, files."""

import datetime as dt
import re

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from affinitext.operators import corpus as ops
from affinitext.operators.compare import compare_models, tally
from affinitext.operators.queries import validate_queries
from affinitext.plans.prepare import prepare_eval_set, select_articles
from affinitext.sources.corpus import RAW_CORPUS, read_corpus, spread_out, with_metadata, write_corpus
from affinitext.sources.results import read_results, write_results


@pytest.fixture(scope="module")
def dated(spark):
    rows = [
        (0, "2019-12-31 23:59:59.999999"), (1, "2020-01-01 00:00:00"), (2, "2021-12-31 23:59:59"),
        (3, "2022-01-01 00:00:00.0"), (4, "2020-05-12 00:00:00"), (5, "2021-05-12 00:01:00"),
        (6, None),
    ]
    return ops.with_pub_date(spark.createDataFrame(rows, "id long, pub_date string"))


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


def test_fraction_digits(dated):
    dates = {r["id"]: r["pub_date"] for r in dated.collect()}
    assert dates[0].microsecond == 999999 and dates[3] == dt.datetime(2022, 1, 1)
    assert dates[6] is None


def test_bad_dates_stop_the_job(spark):
    bad = spark.createDataFrame([(1, "yesterday")], "id long, pub_date string")
    with pytest.raises(PySparkException):
        ops.with_pub_date(bad).collect()


def test_years(dated):
    assert ids(ops.filter_years(dated)) == [1, 2, 4, 5]
    assert ids(ops.filter_years(dated, [2019, 2021, 2022])) == [0, 2, 3, 5]
    assert ids(ops.filter_years(ops.with_year(dated))) == [1, 2, 4, 5]
    assert ids(ops.filter_years(dated, [])) == []
    assert ids(ops.filter_before(dated)) == [0]


def test_date_parts(dated):
    assert ids(ops.filter_date_parts(dated, day=12, month=5, year=2020)) == [4]
    assert ids(ops.filter_date_parts(dated, day=12, month=5, year=2020, compat=True)) == [4, 5]
    assert ids(ops.filter_date_parts(dated, year=2020)) == [1, 4]
    assert ids(ops.filter_date_parts(dated)) == [0, 1, 2, 3, 4, 5, 6]


def test_date_range_ends_at_midnight(dated):
    assert ids(ops.filter_date_range(dated, "2020-05-12", "2021-05-12")) == [4]
    assert ids(ops.filter_date_range(dated, dt.datetime(2021, 5, 12))) == [2, 3, 5]
    assert ids(ops.filter_date_range(dated, None, "2020-05-12")) == [0, 1, 4]


def test_year_filters_reach_the_scan(spark, dated, tmp_path):
    path = str(tmp_path / "by_year")
    write_corpus(ops.with_year(dated).filter("id < 6"), path, by_year=True)
    stored = spark.read.parquet(path)
    plan = ops.filter_years(stored)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*year#\d+ IN \(2020,2021\)", plan)
    assert "GreaterThanOrEqual(pub_date" in plan and "LessThan(pub_date" in plan
    assert ids(ops.filter_years(stored)) == [1, 2, 4, 5]


def test_get_document(spark, dated):
    assert ids(ops.get_document(dated, 0)) == [0]
    with pytest.raises(ValueError):
        ops.get_document(dated, 99)
    wanted = spark.createDataFrame([(0,), (99,)], "id long")
    assert ops.get_documents(dated, wanted).count() == 2
    with pytest.raises(PySparkException, match="no document has the id 99"):
        ops.get_documents(dated, wanted, required=True).collect()


def test_sample(spark):
    df = spark.range(1000)
    first = ids(ops.sample_exact(df, 25, "a"))
    assert len(set(first)) == 25
    assert first == ids(ops.sample_exact(df.repartition(7), 25, "a"))
    assert first != ids(ops.sample_exact(df, 25, "b"))
    for too_few in (df.limit(24), df.limit(0)):
        with pytest.raises(ValueError):
            ops.sample_exact(too_few, 25)


RAW = [
    (1, "2020-03-01 10:00:00", "RTBFINFO", "il vit", "<p>", "a"),
    (1, "2020-03-01 10:00:00", "RTBFINFO", "il vit", "<p>", "a"),
    (1, "2020-03-01 10:00:00", "RTBFINFO", "il vit", "<b>", "a"),
    (2, "2021-03-01 10:00:00", "RTBFINFO", "Open Vld vit", "<p>", "a"),
    (3, "2019-03-01 10:00:00", "RTBFINFO", "vieux", "<p>", "a"),
    (4, "2020-03-01 10:00:00", "SPORT", "autre", "<p>", "a"),
    (5, "2018-03-01 10:00:00", "RTBFINFO", "plus vieux", "<p>", "a"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(RAW, RAW_CORPUS)


def test_articles_are_made_distinct_before_columns_go(raw):
    articles = select_articles(raw)
    assert ids(articles) == [1, 1, 2]
    assert "text_html" not in articles.columns and "test_preprocessed" not in articles.columns
    assert ids(select_articles(raw, None, 2020)) == [3, 5]


def test_eval_set(spark, raw):
    lexicon = spark.createDataFrame([("vit", "voir", "VERB")], "form string, lemma string, pos string")
    picked = prepare_eval_set(raw, lexicon, n=2).collect()
    assert sum(r["is_seen"] for r in picked) == 2 and len(picked) == 4
    assert {r["id"] for r in picked if not r["is_seen"]} == {3, 5}


def test_json_corpus(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    extra = raw.withColumn("author", F.when(F.col("id") > 1, "x"))
    write_corpus(extra, path, "json")
    back = read_corpus(spark, path, with_metadata(RAW_CORPUS, author=extra.schema["author"].dataType))
    assert sorted(back.collect(), key=str) == sorted(extra.collect(), key=str)
    (tmp_path / "raw" / "bad.json").write_text('{"id": "x"\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_corpus(spark, path).collect()


def test_results_round_trip(spark, tmp_path):
    path = str(tmp_path / "results")
    rows = [(1, 1, 'a "quoted"\nline, with comma', 0.5, ["x", "y"]), (2, 1, "é", None, [])]
    df = spark.createDataFrame(rows, "query_id long, rank int, text string, score double, tags array<string>")
    write_results(df, path, ["rank", "text", "score", "tags"])
    back = read_results(spark, path, "rank int, text string, score double, tags string, query_id long")
    got = sorted(back.collect(), key=lambda r: r["query_id"])
    assert [(r["query_id"], r["rank"], r["text"], r["score"]) for r in got] == [r[:4] for r in rows]
    assert got[0]["tags"] == "x y"
    assert sorted(p.name for p in (tmp_path / "results").glob("query_id=*")) == ["query_id=1", "query_id=2"]


def test_only_few_files_are_spread_out(spark, tmp_path):
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    spark.range(100).coalesce(1).write.parquet(few)
    spark.range(100).repartition(8).write.parquet(many)
    for path, shuffled in ((few, True), (many, False)):
        plan = spread_out(spark.read.parquet(path))._jdf.queryExecution().toString()
        assert ("Repartition" in plan) is shuffled


@pytest.mark.parametrize(
    "query, reason",
    [
        (dict(text="x"), None),
        (dict(doc_id=0), None),
        (dict(), "either"),
        (dict(text="x", doc_id=1), "either"),
        (dict(text="x", month=0), "month"),
        (dict(text="x", month=13), "month"),
        (dict(text="x", day=0), "day"),
        (dict(text="x", day=31, month=2), None),
        (dict(text="x", year=2019), "year outside"),
        (dict(text="x", year=2020, start_date="2020-01-01"), "exclude"),
        (dict(text="x", start_date="2020-02-01", end_date="2020-02-01"), "before"),
        (dict(text="x", start_date="2019-02-01", end_date="2020-02-01"), "range outside"),
        (dict(text="x", start_date="2019-02-01"), None),
        (dict(text="x", end_date="2030-02-01"), None),
    ],
)
def test_validation(spark, query, reason):
    row = spark.range(1).select(
        F.lit(1).alias("query_id"), *[F.lit(v).alias(k) for k, v in query.items()]
    )
    valid, rejected = validate_queries(row)
    if reason is None:
        assert valid.first()["n"] == 3 and rejected.isEmpty()
    else:
        assert reason in rejected.first()["reason"] and valid.isEmpty()


def test_tally(spark):
    judged = ["simple"] * 85 + ["all"] * 18 + ["pooled"] * 13 + ["tied"] * 9 + ["doc"] * 6
    got = {r["best"]: (r["n"], r["share"]) for r in
           tally(spark.createDataFrame([(x,) for x in judged], "best string"), "best").collect()}
    assert got[None] == (131, 1.0) and got["simple"][0] == 85
    assert got["simple"][1] + got["all"][1] == pytest.approx(0.786259541984733)
    assert got["pooled"][1] + got["all"][1] == pytest.approx(0.236641221374046)


def test_tally_of_unlabelled_rows(spark):
    got = tally(spark.createDataFrame([("a",), (None,)], "best string"), "best").collect()
    assert {(r["best"], r["n"]) for r in got} == {("a", 1), ("(empty)", 1), (None, 2)}


def test_models_side_by_side(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "id long, rank int, shown string")
    b = spark.createDataFrame([(1, 1, "z")], "id long, rank int, shown string")
    rows = compare_models({"a": a, "b": b}).orderBy("rank").collect()
    assert [(r["a"], r["b"]) for r in rows] == [("x", "z"), ("y", None)]
