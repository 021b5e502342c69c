"""Sources and sinks, projections, filters, distinct rows, samples, unions, tallies."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinitext.functions.dates import parse_pub_date
from affinitext.functions.text import lower_words
from affinitext.operators import corpus as ops
from affinitext.operators.compare import tally
from affinitext.operators.doc_vectors import attach_vectors
from affinitext.operators.queries import validate_queries, with_query_columns
from affinitext.sources.corpus import RAW_CORPUS, read_corpus, write_corpus
from affinitext.sources.results import read_results, write_results
from affinitext.sources.vectors import load_vectors, load_words, save_vectors, save_words
from affinitext.session import shared_folder
from checks.inputs import (
    DOCS,
    EMBEDDED,
    WORDS,
    corpus,
    embedding_vectors,
    long_vector,
    rounded,
    shown_time,
    table,
    with_ctes,
    words,
)
from checks.registry import case

SHOWN = "strftime(pub_date, '%Y-%m-%d %H:%M:%S')"


def fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the raw layout, dates as text."""
    return corpus(spark, sf_dir).select(
        "id",
        F.date_format("pub_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("pub_date"),
        "feed",
        "text_cleaned",
        F.concat(F.lit("<p>"), "text_cleaned", F.lit("</p>")).alias("text_html"),
        F.lower("text_cleaned").alias("test_preprocessed"),
    )


def digest(df: DataFrame) -> DataFrame:
    return df.select("id", shown_time("pub_date").alias("pub_date"), "feed",
                     F.md5("text_cleaned").alias("text_md5"))


DIGEST = f"SELECT id, {SHOWN} AS pub_date, feed, md5(text_cleaned) AS text_md5 FROM docs"


@case(with_ctes(DOCS, DIGEST))
def io1_read_corpus(spark, sf_dir):
    path = fresh(spark, "raw")
    write_corpus(raw(spark, sf_dir), path, "json")
    return digest(ops.with_pub_date(read_corpus(spark, path, RAW_CORPUS)))


@case(with_ctes(DOCS, DIGEST + " WHERE year(pub_date) IN (2020, 2021)"))
def io2_read_prepared_corpus(spark, sf_dir):
    path = fresh(spark, "prepared")
    prepared = ops.with_year(corpus(spark, sf_dir))
    write_corpus(prepared, path, by_year=True)
    return digest(ops.filter_years(read_corpus(spark, path, prepared.schema, "parquet")))


@case(with_ctes(DOCS, """
SELECT id, array_to_string(regexp_extract_all(text_cleaned, '[A-Za-z]+'), ' ') AS tokens
FROM docs"""))
def io3_write_corpus(spark, sf_dir):
    path = fresh(spark, "tokens")
    tokens = F.regexp_extract_all("text_cleaned", F.lit("[A-Za-z]+"), F.lit(0))
    prepared = corpus(spark, sf_dir).select("id", tokens.alias("preprocessed_text"))
    write_corpus(prepared, path, "json")
    back = read_corpus(spark, path, prepared.schema)
    return back.select("id", F.array_join("preprocessed_text", " ").alias("tokens"))


@case(with_ctes(DOCS, f"""
SELECT id % 7 AS query_id, id, {SHOWN} AS pub_date, round(id / 7.0::DOUBLE, 6) AS score,
       md5(text_cleaned) AS text_md5, array_to_string([feed, lang], ' ') AS tags FROM docs"""))
def io4_write_results(spark, sf_dir):
    path = fresh(spark, "results")
    results = corpus(spark, sf_dir).select(
        (F.col("id") % 7).alias("query_id"), "id", "pub_date",
        rounded(F.col("id") / F.lit(7.0)).alias("score"), "text_cleaned",
        F.array("feed", "lang").alias("tags"),
    )
    write_results(results, path, ["tags", "id", "score", "pub_date", "text_cleaned"])
    back = read_results(
        spark, path,
        "tags string, id bigint, score double, pub_date timestamp_ntz, text_cleaned string, "
        "query_id bigint",
    )
    return back.select("query_id", "id", shown_time("pub_date").alias("pub_date"), "score",
                       F.md5("text_cleaned").alias("text_md5"), "tags")


@case("""
SELECT vec_id AS id, i - 1 AS i, round(embedding[i]::DOUBLE, 6) + 0.0 AS x
FROM embeddings, range(1, 65) r(i)""")
def io5_document_vectors(spark, sf_dir):
    path = fresh(spark, "vectors")
    save_vectors(embedding_vectors(spark, sf_dir), path)
    return long_vector(load_vectors(spark, path), "id")


@case(with_ctes(WORDS, "SELECT word, i, round(x, 6) + 0.0 AS x FROM comps"))
def io6_word_vectors(spark, sf_dir):
    path = fresh(spark, "words")
    save_words(words(spark, sf_dir), path)
    return long_vector(load_words(spark, path), "word")


@case("""
SELECT event_id,
       strftime(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '%Y-%m-%d %H:%M:%S.%f'),
                '%Y-%m-%d %H:%M:%S.%f') AS pub_date
FROM events""")
def pf1_parse_pub_date(spark, sf_dir):
    """Event times as text, without a fraction where they fall on a whole second."""
    text = F.when(
        F.date_format("ts", "SSSSSS") == "000000", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    ).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    events = table(spark, sf_dir, "events").select("event_id", text.alias("pub_date"))
    parsed = events.select("event_id", parse_pub_date(F.col("pub_date")).alias("pub_date"))
    return parsed.select(
        "event_id", F.date_format("pub_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("pub_date")
    )


@case(with_ctes(DOCS, "SELECT id, year(pub_date)::BIGINT AS year FROM docs"))
def pf2_year(spark, sf_dir):
    dated = ops.with_year(corpus(spark, sf_dir))
    return dated.select("id", F.col("year").cast("bigint").alias("year"))


@case(with_ctes(DOCS, DIGEST + " WHERE year(pub_date) = 2021 OR year(pub_date) = 2020"))
def pf3_filter_years(spark, sf_dir):
    return digest(ops.filter_years(corpus(spark, sf_dir)))


@case(with_ctes(DOCS, DIGEST + " WHERE year(pub_date) < 2020"))
def pf4_filter_before(spark, sf_dir):
    return digest(ops.filter_before(corpus(spark, sf_dir)))


@case(with_ctes(DOCS, DIGEST + " WHERE feed = 'src4'"))
def pf5_filter_feed(spark, sf_dir):
    return digest(ops.filter_feed(corpus(spark, sf_dir), "src4"))


@case("SELECT doc_id, n_chars FROM documents")
def pf6_drop_columns(spark, sf_dir):
    return ops.drop_columns(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


@case("""
SELECT 'day' AS parts, o_orderkey FROM orders WHERE day(o_orderdate) = 12
UNION ALL SELECT 'month', o_orderkey FROM orders WHERE month(o_orderdate) = 5
UNION ALL SELECT 'year', o_orderkey FROM orders WHERE year(o_orderdate) = 1997
UNION ALL SELECT 'day month', o_orderkey FROM orders
          WHERE day(o_orderdate) = 12 AND month(o_orderdate) = 5
UNION ALL SELECT 'day year', o_orderkey FROM orders
          WHERE day(o_orderdate) = 12 AND year(o_orderdate) = 1997
UNION ALL SELECT 'month year', o_orderkey FROM orders
          WHERE month(o_orderdate) = 5 AND year(o_orderdate) = 1997
UNION ALL SELECT 'all', o_orderkey FROM orders
          WHERE day(o_orderdate) = 12 AND month(o_orderdate) = 5 AND year(o_orderdate) = 1997
UNION ALL SELECT 'all compat', o_orderkey FROM orders
          WHERE day(o_orderdate) = 12 AND month(o_orderdate) = 5""")
def pf7_filter_date_parts(spark, sf_dir):
    given = {
        "day": dict(day=12), "month": dict(month=5), "year": dict(year=1997),
        "day month": dict(day=12, month=5), "day year": dict(day=12, year=1997),
        "month year": dict(month=5, year=1997), "all": dict(day=12, month=5, year=1997),
        "all compat": dict(day=12, month=5, year=1997, compat=True),
    }
    return _variants(spark, sf_dir, given, ops.filter_date_parts, "parts", "orders",
                     "o_orderkey", "o_orderdate")


def _variants(spark, sf_dir, given, keep, label, name, key, column):
    rows = table(spark, sf_dir, name)
    kept = [
        keep(rows, column=column, **options).select(F.lit(what).alias(label), key)
        for what, options in given.items()
    ]
    result = kept[0]
    for more in kept[1:]:
        result = result.unionByName(more)
    return result


@case("""
SELECT 'closed' AS ends, event_id FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-09 12:00:00'
UNION ALL SELECT 'from', event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20'
UNION ALL SELECT 'until', event_id FROM events WHERE ts <= TIMESTAMP '2024-01-03'""")
def pf8_filter_date_range(spark, sf_dir):
    given = {
        "closed": dict(start="2024-01-05 00:00:00", end="2024-01-09 12:00:00"),
        "from": dict(start="2024-01-20 00:00:00"),
        "until": dict(end="2024-01-03 00:00:00"),
    }
    return _variants(spark, sf_dir, given, ops.filter_date_range, "ends", "events",
                     "event_id", "ts")


@case(with_ctes(DOCS, """
SELECT l.doc_id AS id, l.quality::BIGINT AS quality, d.feed, md5(d.text_cleaned) AS text_md5
FROM labels l LEFT JOIN docs d ON d.id = l.doc_id"""))
def pf9_get_documents(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    found = ops.get_documents(corpus(spark, sf_dir), labels, required=True)
    return found.join(labels, "id").select(
        "id", F.col("quality").cast("bigint").alias("quality"), "feed",
        F.md5("text_cleaned").alias("text_md5"),
    )


@case(with_ctes(DOCS, """
SELECT id, md5(text_cleaned) AS text_md5, feed FROM docs WHERE id = 17"""))
def pf9_get_document(spark, sf_dir):
    return ops.get_document(corpus(spark, sf_dir), 17).select(
        "id", F.md5("text_cleaned").alias("text_md5"), "feed"
    )


@case(with_ctes(DOCS, "SELECT id AS doc, feed AS source_feed, lang FROM docs"))
def pf12_select_columns(spark, sf_dir):
    names = {"id": "doc", "feed": "source_feed", "lang": "lang"}
    return ops.select_columns(corpus(spark, sf_dir), names)


@case("""
SELECT count(*) AS n_rows, 'id, pub_date, feed, text_cleaned, lang' AS columns FROM documents""")
def pf13_profile(spark, sf_dir):
    return ops.profile(corpus(spark, sf_dir))


def made_queries(spark, sf_dir):
    """One query per document; some of them break one rule or two."""
    kind = F.col("doc_id") % 13
    day = F.expr("timestampadd(DAY, cast(doc_id % 400 as int), timestamp_ntz'2020-01-01 00:00:00')")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("query_id"),
        F.when(kind != 1, F.col("text")).alias("text"),
        F.when(kind.isin(1, 2), F.col("doc_id")).alias("doc_id"),
        F.when(kind == 3, 0).when(kind == 4, 32).when(kind == 5, 31).alias("day"),
        F.when(kind == 5, 12).when(kind == 6, 13).when(kind == 7, 0).alias("month"),
        F.when(kind == 7, 2020).when(kind == 8, 2019).when(kind == 9, 2021).alias("year"),
        F.when(kind.isin(9, 10, 11), day).alias("start_date"),
        F.when(kind == 10, F.expr("timestampadd(DAY, 300, timestamp_ntz'2020-12-01 00:00:00')"))
        .when(kind == 11, F.expr("timestamp_ntz'2022-06-01 00:00:00'"))
        .when(kind == 12, F.expr("timestamp_ntz'2030-01-01 00:00:00'"))
        .alias("end_date"),
    )


MADE_QUERIES = """made AS (
  SELECT doc_id AS query_id, doc_id % 13 AS kind,
    CASE WHEN doc_id % 13 <> 1 THEN text END AS text,
    CASE WHEN doc_id % 13 IN (1, 2) THEN doc_id END AS doc_id,
    CASE doc_id % 13 WHEN 3 THEN 0 WHEN 4 THEN 32 WHEN 5 THEN 31 END AS day,
    CASE doc_id % 13 WHEN 5 THEN 12 WHEN 6 THEN 13 WHEN 7 THEN 0 END AS month,
    CASE doc_id % 13 WHEN 7 THEN 2020 WHEN 8 THEN 2019 WHEN 9 THEN 2021 END AS year,
    CASE WHEN doc_id % 13 IN (9, 10, 11)
         THEN TIMESTAMP '2020-01-01' + to_days((doc_id % 400)::INT) END AS start_date,
    CASE doc_id % 13 WHEN 10 THEN TIMESTAMP '2020-12-01' + to_days(300)
         WHEN 11 THEN TIMESTAMP '2022-06-01'
         WHEN 12 THEN TIMESTAMP '2030-01-01' END AS end_date
  FROM documents),
judged AS (
  SELECT *, CASE
    WHEN (text IS NULL) = (doc_id IS NULL) THEN 'give either a text or an id'
    WHEN (day IS NOT NULL OR month IS NOT NULL OR year IS NOT NULL)
         AND (start_date IS NOT NULL OR end_date IS NOT NULL)
      THEN 'date parts and a date range exclude each other'
    WHEN month < 1 OR month > 12 THEN 'month must be 1 to 12'
    WHEN day < 1 OR day > 31 THEN 'day must be 1 to 31'
    WHEN year NOT IN (2020, 2021) THEN 'year outside the corpus'
    WHEN start_date >= end_date THEN 'start must be before end'
    WHEN start_date IS NOT NULL AND end_date IS NOT NULL
         AND (year(start_date) NOT IN (2020, 2021) OR year(end_date) NOT IN (2020, 2021))
      THEN 'range outside the years of the corpus' END AS reason
  FROM made)"""


@case(with_ctes(MADE_QUERIES, "SELECT query_id, reason FROM judged WHERE reason IS NOT NULL"))
def pf14_rejected_queries(spark, sf_dir):
    _, rejected = validate_queries(made_queries(spark, sf_dir))
    return rejected.select("query_id", "reason")


@case(with_ctes(MADE_QUERIES, """
SELECT query_id, doc_id, md5(text) AS text_md5, 3::BIGINT AS n FROM judged WHERE reason IS NULL"""))
def pf14_valid_queries(spark, sf_dir):
    valid, _ = validate_queries(made_queries(spark, sf_dir))
    return valid.select("query_id", "doc_id", F.md5("text").alias("text_md5"),
                        F.col("n").cast("bigint").alias("n"))


@case(with_ctes(EMBEDDED, """
SELECT id, lang, round(v[1], 6) + 0.0 AS first, round(v[64], 6) + 0.0 AS last FROM embedded"""))
def j1_attach_vectors(spark, sf_dir):
    joined = attach_vectors(corpus(spark, sf_dir), embedding_vectors(spark, sf_dir))
    return joined.select("id", "lang", rounded(F.get("vector", 0)).alias("first"),
                         rounded(F.get("vector", 63)).alias("last"))


@case("SELECT DISTINCT text, lang, source AS feed FROM documents")
def a1_dedup_rows(spark, sf_dir):
    return ops.dedup_rows(corpus(spark, sf_dir).select(F.col("text_cleaned").alias("text"),
                                                       "lang", "feed"))


@case("""
WITH doubled AS (SELECT *, 'raw' AS text_html FROM documents
                 UNION ALL SELECT *, 'other' FROM documents UNION ALL SELECT *, 'raw' FROM documents),
  distinct_rows AS (SELECT DISTINCT * FROM doubled)
SELECT doc_id, md5(text) AS text_md5 FROM distinct_rows""")
def a1_dedup_before_drop(spark, sf_dir):
    """Exact copies go, rows that differ only in a column dropped afterwards stay."""
    docs = table(spark, sf_dir, "documents")
    marked = [docs.withColumn("text_html", F.lit(mark)) for mark in ("raw", "other", "raw")]
    rows = marked[0].unionByName(marked[1]).unionByName(marked[2])
    kept = ops.drop_columns(ops.dedup_rows(rows))
    return kept.select("doc_id", F.md5("text").alias("text_md5"))


@case(with_ctes(DOCS, "SELECT id FROM docs ORDER BY md5('7' || id), id LIMIT 25"))
def a7_sample_exact(spark, sf_dir):
    return ops.sample_exact(corpus(spark, sf_dir), 25, "7").select("id")


@case(with_ctes(DOCS, """
(SELECT id, true AS is_seen FROM docs WHERE year(pub_date) IN (2020, 2021)
 ORDER BY md5('7' || id), id LIMIT 25)
UNION ALL
(SELECT id, false FROM docs WHERE year(pub_date) < 2020 ORDER BY md5('7' || id), id LIMIT 25)"""))
def u1_build_eval_set(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    both = ops.build_eval_set(ops.filter_years(docs), ops.filter_before(docs), 25, "7")
    return both.select("id", "is_seen")


@case("""
WITH named AS (SELECT CASE quality * 2 + toxic WHEN 0 THEN 'neither' WHEN 1 THEN 'second'
                      WHEN 2 THEN 'first' ELSE 'all' END AS best FROM labels)
SELECT best, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM named), 6) AS share
FROM named GROUP BY ROLLUP (best)""")
def a6_tally(spark, sf_dir):
    code = F.col("quality") * 2 + F.col("toxic")
    best = F.when(code == 0, "neither").when(code == 1, "second").when(code == 2, "first")
    judged = table(spark, sf_dir, "labels").select(best.otherwise("all").alias("best"))
    return tally(judged, "best").select("best", "n", rounded("share").alias("share"))


@case("""
SELECT item_id AS query_id, 'benchmark' AS origin, md5(text) AS text_md5, 3::BIGINT AS n
FROM benchmark
UNION ALL SELECT conv_id * 1000 + turn, 'conversations', md5(text), 3 FROM conversations""")
def u2_append_queries(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), "text", F.lit("benchmark").alias("origin"))
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text",
        F.lit("conversations").alias("origin"))
    both = with_query_columns(items.unionByName(turns))
    return both.select("query_id", "origin", F.md5("text").alias("text_md5"),
                       F.col("n").cast("bigint").alias("n"))


@case("""
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '[A-Za-z]+'),
       lambda t: lower(t)), ' ') AS words FROM documents""")
def f21_lower_words(spark, sf_dir):
    found = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(lower_words(found), " ").alias("words"))
