"""Scoring, ranking, searches and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinitext.functions.text import plain_tokens
from affinitext.operators.compare import compare_models, self_hits
from affinitext.operators.corpus import ROW_KEY, build_eval_set, filter_before, filter_years, with_row_key
from affinitext.operators.doc_vectors import attach_vectors, build_index, mean_vectors
from affinitext.operators.lookup import rows_by_id
from affinitext.operators.queries import with_query_columns
from affinitext.operators.rank import clamp_n, exclude_self, rank_per_query, top_n
from affinitext.operators.score import best_candidates, score_all
from affinitext.plans.evaluate import evaluate, rank_by_model
from affinitext.plans.search import batch_search, resolve_queries, search
from checks.inputs import (
    DATE,
    DIMS,
    DOCS,
    EMBEDDED,
    MEANS,
    corpus,
    doc_vectors,
    embedding_vectors,
    lexicon,
    mean_index,
    plain_list,
    pooled,
    quoted,
    rounded,
    stored,
    table,
    tokens,
    with_ctes,
    words,
)
from checks.registry import case
from checks.texts import preprocessed_sql
from checks.vectors import ALL_WORDS


@case("""
SELECT e.vec_id AS id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6)
       + 0.0 AS score
FROM embeddings e, embeddings q WHERE q.vec_id = 0""")
def j4_one_query_all_documents(spark, sf_dir):
    vectors = embedding_vectors(spark, sf_dir)
    scored = score_all(vectors, vectors.filter("id = 0"))
    return scored.select("id", rounded("score").alias("score"))


@case("""
SELECT vec_id AS id, round(score, 6) + 0.0 AS score FROM (
  SELECT e.vec_id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score
  FROM embeddings e, embeddings q WHERE q.vec_id = 7)
ORDER BY round(score, 9) DESC, vec_id LIMIT 10""")
def t1_top_n(spark, sf_dir):
    vectors = embedding_vectors(spark, sf_dir)
    scored = score_all(vectors, vectors.filter("id = 7"))
    return top_n(scored, 10).select("id", rounded("score").alias("score"))


ALL_PAIRS = """pairs AS (
  SELECT q.vec_id AS query_id, e.vec_id AS id,
         list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score
  FROM embeddings e, embeddings q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank
  FROM pairs)"""


@case(with_ctes(ALL_PAIRS, """
SELECT query_id, id, rank, round(score, 6) + 0.0 AS score FROM ranked WHERE rank <= 5"""))
def j5_many_queries_all_documents(spark, sf_dir):
    """Every vector is a query against every vector."""
    vectors = embedding_vectors(spark, sf_dir)
    queries = with_query_columns(vectors.select(F.col("id").alias("query_id"), "vector"))
    found = best_candidates(queries, vectors, 5)
    return found.select("query_id", "id", F.col("rank").cast("bigint").alias("rank"),
                        rounded("score").alias("score"))


@case(with_ctes(ALL_PAIRS, """
SELECT query_id, id, rank, round(score, 6) + 0.0 AS score FROM ranked WHERE rank <= 5"""))
def j5_queries_in_blocks(spark, sf_dir):
    """The way for more queries than one block holds."""
    vectors = embedding_vectors(spark, sf_dir)
    queries = with_query_columns(vectors.select(F.col("id").alias("query_id"), "vector"))
    found = best_candidates(queries, vectors, 5, block_bytes=256 * 1024)
    return found.select("query_id", "id", F.col("rank").cast("bigint").alias("rank"),
                        rounded("score").alias("score"))


@case("""
SELECT l_suppkey AS query_id, l_orderkey * 10 + l_linenumber AS id,
       row_number() OVER (PARTITION BY l_suppkey
         ORDER BY round(l_extendedprice, 9) DESC, l_orderkey * 10 + l_linenumber) AS rank
FROM lineitem QUALIFY rank <= 4""")
def w1_rank_per_query(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("query_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_extendedprice").alias("score"))
    return rank_per_query(scored, 4).select(
        "query_id", "id", F.col("rank").cast("bigint").alias("rank"))


@case("""
WITH counted AS (SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey)
SELECT o_custkey, n_rows, CASE WHEN n_rows > 0 AND n_rows < 12 THEN 1 ELSE 12 END::BIGINT AS shown
FROM counted""")
def t3_clamp_n(spark, sf_dir):
    counted = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_rows"))
    shown = clamp_n(F.lit(12), F.col("n_rows")).cast("bigint")
    return counted.select("o_custkey", "n_rows", shown.alias("shown"))


@case(with_ctes(DOCS, """
SELECT id, feed, 0.5::DOUBLE AS cosine_sim_score, 'une question' AS query FROM docs"""))
def pf10_constant_columns(spark, sf_dir):
    marked = corpus(spark, sf_dir).withColumns(
        {"cosine_sim_score": F.lit(0.5), "query": F.lit("une question")})
    return marked.select("id", "feed", "cosine_sim_score", "query")


SELF = """scored AS (
  SELECT q.vec_id AS query_id, e.vec_id AS id, qd.text AS query, d.text AS text_cleaned,
         list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score
  FROM embeddings q JOIN documents qd ON qd.doc_id = q.vec_id,
       embeddings e JOIN documents d ON d.doc_id = e.vec_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS r
  FROM scored),
flagged AS (
  SELECT *, max(CASE WHEN r = 1 AND query = text_cleaned THEN 1 ELSE 0 END)
            OVER (PARTITION BY query_id) AS self FROM placed)"""


@case(with_ctes(SELF, """
SELECT query_id, id, r - self AS rank FROM flagged WHERE r - self BETWEEN 1 AND 3"""))
def t2_exclude_self(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("text_cleaned"))
    vectors = embedding_vectors(spark, sf_dir).join(docs.select("id"), "id")
    queries = with_query_columns(vectors.select(F.col("id").alias("query_id"), "vector"))
    best = best_candidates(queries, vectors, 4).join(docs, "id")
    asked = docs.select(F.col("id").alias("query_id"), F.col("text_cleaned").alias("query"))
    kept = exclude_self(best.join(asked, "query_id")).filter("rank <= 3")
    return kept.select("query_id", "id", F.col("rank").cast("bigint").alias("rank"))


SEARCH_BY_ID = f"""{EMBEDDED},
q AS (SELECT v, text_cleaned AS query FROM embedded WHERE id = 0),
placed AS (
  SELECT e.*, q.query, list_cosine_similarity(e.v, q.v) AS score,
         row_number() OVER (ORDER BY round(list_cosine_similarity(e.v, q.v), 9) DESC NULLS LAST, id)
           AS r, count(*) OVER () AS c
  FROM embedded e, q WHERE year(pub_date) = 2020),
flagged AS (
  SELECT *, max(CASE WHEN r = 1 AND query = text_cleaned THEN 1 ELSE 0 END) OVER () AS self
  FROM placed)"""


@case(with_ctes(SEARCH_BY_ID, """
SELECT r - self AS rank, id, strftime(pub_date, '%Y-%m-%d %H:%M:%S') AS pub_date, feed, lang,
       text_cleaned, round(score, 6) + 0.0 AS cosine_sim_score, query
FROM flagged
WHERE r - self BETWEEN 1 AND CASE WHEN c < 3 THEN 1 ELSE 3 END AND score IS NOT NULL"""))
def e1_search_by_id(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    index = attach_vectors(docs.select("id", "pub_date"), embedding_vectors(spark, sf_dir))
    return _shown(search(index, docs, doc_id=0, year=2020))


def _shown(found):
    return found.withColumns({
        "rank": F.col("rank").cast("bigint"),
        "pub_date": F.date_format("pub_date", "yyyy-MM-dd HH:mm:ss"),
        "cosine_sim_score": rounded("cosine_sim_score"),
    })


ASKED_TEXT = "pour la tion, the which is and les M. Dupont à 5 kilomètres"

SEARCH_BY_TEXT = f"""{DOCS}, {MEANS},
asked AS (SELECT 0 AS id, {quoted(ASKED_TEXT)} AS text_cleaned),
{preprocessed_sql('asked')},
asked_sums AS (SELECT i, avg(x) AS m FROM singles JOIN units ON units.word = w GROUP BY i),
q AS (SELECT list(m ORDER BY i) AS v FROM asked_sums),
answers AS (
  SELECT d.*, list_cosine_similarity(m.v, q.v) AS score,
         row_number() OVER (ORDER BY round(list_cosine_similarity(m.v, q.v), 9) DESC NULLS LAST, id)
           AS rank, count(*) OVER () AS c
  FROM docs d LEFT JOIN mean_vecs m USING (id), q
  WHERE pub_date BETWEEN TIMESTAMP '2020-03-01' AND TIMESTAMP '2021-06-01')"""


@case(with_ctes(SEARCH_BY_TEXT, f"""
SELECT rank, id, strftime(pub_date, '%Y-%m-%d %H:%M:%S') AS pub_date, feed, lang, text_cleaned,
       round(score, 6) + 0.0 AS cosine_sim_score, {quoted(ASKED_TEXT)} AS query
FROM answers WHERE rank <= CASE WHEN c < 5 THEN 1 ELSE 5 END AND score IS NOT NULL"""))
def e1_search_by_text(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    known = words(spark, sf_dir)
    found = search(mean_index(spark, sf_dir), docs, text=ASKED_TEXT, words=known,
                   lexicon=lexicon(spark, sf_dir), start_date="2020-03-01 00:00:00",
                   end_date="2021-06-01 00:00:00", n=5)
    return _shown(found)


def many_queries(spark, sf_dir):
    """Every document asks by its id, with one of eight date conditions and its own n."""
    kind = F.col("doc_id") % 8
    own = F.expr(DATE)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("query_id"), "doc_id",
        F.when(kind.isin(3, 4), F.dayofmonth(own)).alias("day"),
        F.when(kind.isin(2, 3), F.month(own)).alias("month"),
        F.when(kind.isin(1, 2, 4), F.year(own)).alias("year"),
        F.when(kind.isin(5, 6), own).alias("start_date"),
        F.when(kind == 5, F.expr(f"timestampadd(DAY, 200, {DATE})"))
        .when(kind == 7, own).alias("end_date"),
        (F.col("doc_id") % 5 + 1).cast("int").alias("n"),
    )


MANY = f"""{DOCS}, {MEANS},
asked AS (
  SELECT doc_id AS query_id, doc_id % 5 + 1 AS n, text AS query, m.v, doc_id % 8 AS kind, pub_date
  FROM documents JOIN docs ON docs.id = doc_id LEFT JOIN mean_vecs m ON m.id = doc_id),
cand AS (SELECT d.*, m.v FROM docs d LEFT JOIN mean_vecs m USING (id)),
scored AS (
  SELECT a.query_id, a.query, a.n, c.id, c.text_cleaned, list_cosine_similarity(a.v, c.v) AS score
  FROM asked a JOIN cand c ON
    CASE a.kind WHEN 1 THEN year(c.pub_date) = year(a.pub_date)
      WHEN 2 THEN month(c.pub_date) = month(a.pub_date) AND year(c.pub_date) = year(a.pub_date)
      WHEN 3 THEN day(c.pub_date) = day(a.pub_date) AND month(c.pub_date) = month(a.pub_date)
      WHEN 4 THEN day(c.pub_date) = day(a.pub_date) AND year(c.pub_date) = year(a.pub_date)
      WHEN 5 THEN c.pub_date BETWEEN a.pub_date AND a.pub_date + to_days(200)
      WHEN 6 THEN c.pub_date >= a.pub_date
      WHEN 7 THEN c.pub_date <= a.pub_date ELSE true END
  WHERE a.v IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id
                               ORDER BY round(score, 9) DESC NULLS LAST, id) AS r,
         count(*) OVER (PARTITION BY query_id) AS c FROM scored),
flagged AS (
  SELECT *, max(CASE WHEN r = 1 AND query = text_cleaned THEN 1 ELSE 0 END)
            OVER (PARTITION BY query_id) AS self FROM placed)"""


@case(with_ctes(MANY, """
SELECT query_id, r - self AS rank, id, round(score, 6) + 0.0 AS cosine_sim_score
FROM flagged WHERE r - self BETWEEN 1 AND CASE WHEN c < n THEN 1 ELSE n END
  AND score IS NOT NULL"""))
def e2_batch_search(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    index = mean_index(spark, sf_dir)
    queries = resolve_queries(many_queries(spark, sf_dir), index, docs)
    return batch_search(queries, index, docs).select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "id",
        rounded("cosine_sim_score").alias("cosine_sim_score"))


TURNS = f"""{MEANS},
turns AS (SELECT conv_id * 1000 + turn AS query_id, text FROM conversations
          UNION ALL SELECT -1 - item_id, text FROM benchmark),
turn_toks AS (SELECT query_id, unnest({plain_list('text')}) AS word FROM turns),
turn_sums AS (SELECT query_id, i, avg(x) AS m FROM turn_toks JOIN units USING (word)
              GROUP BY query_id, i),
turn_vecs AS (SELECT query_id, list(m ORDER BY i) AS v FROM turn_sums GROUP BY query_id),
placed AS (
  SELECT query_id, id, list_cosine_similarity(t.v, m.v) AS score, row_number() OVER (
    PARTITION BY query_id ORDER BY round(list_cosine_similarity(t.v, m.v), 9) DESC, id) AS rank
  FROM turn_vecs t, mean_vecs m)"""


@case(with_ctes(TURNS, """
SELECT query_id, id, rank, round(score, 6) + 0.0 AS cosine_sim_score FROM placed WHERE rank <= 3"""))
def e2_batch_search_by_text(spark, sf_dir):
    """Every conversation turn and benchmark text asks by what it says."""
    known, docs = words(spark, sf_dir), corpus(spark, sf_dir)
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("text").alias("query"))
    items = table(spark, sf_dir, "benchmark").select(
        (F.lit(-1) - F.col("item_id")).alias("query_id"), F.col("text").alias("query"))
    asked = turns.unionByName(items)
    asked_tokens = asked.select("query_id", plain_tokens(F.col("query")).alias("preprocessed_text"))
    queries = asked.join(mean_vectors(asked_tokens, known, "query_id"), "query_id")
    found = batch_search(queries, mean_index(spark, sf_dir), docs, "none")
    return found.select("query_id", "id", F.col("rank").cast("bigint").alias("rank"),
                        rounded("cosine_sim_score").alias("cosine_sim_score"))


def eval_inputs(spark, sf_dir):
    """25 + 25 sampled documents and two models, mean and pooled vectors."""
    docs = corpus(spark, sf_dir)
    picked = build_eval_set(filter_years(docs), filter_before(docs), 25, "7")
    picked = rows_by_id(tokens(spark, sf_dir), picked)
    simple, improved = doc_vectors(spark, sf_dir), pooled(spark, sf_dir)
    models = {"simple_w2v_results": (simple, simple), "improved_w2v_results": (improved, improved)}
    return picked, docs, models


EVALUATED = f"""{DOCS}, {ALL_WORDS},
means AS (
  SELECT id, i, avg(x) AS x FROM toks JOIN units USING (word) GROUP BY id, i),
pools AS (
  SELECT id, i, avg(x) AS x FROM toks JOIN either USING (word) GROUP BY id, i
  UNION ALL
  SELECT id, i + {DIMS}, max(x) FROM toks JOIN either USING (word) GROUP BY id, i),
vecs AS (
  SELECT 'simple_w2v_results' AS model, id, list(x ORDER BY i) AS v FROM means GROUP BY id
  UNION ALL
  SELECT 'improved_w2v_results', id, list(x ORDER BY i) FROM pools GROUP BY id),
picked AS (
  (SELECT id FROM docs WHERE year(pub_date) IN (2020, 2021) ORDER BY md5('7' || id), id LIMIT 25)
  UNION ALL
  (SELECT id FROM docs WHERE year(pub_date) < 2020 ORDER BY md5('7' || id), id LIMIT 25)),
scored AS (
  SELECT a.model, a.id, b.id AS hit, list_cosine_similarity(a.v, b.v) AS score
  FROM picked p JOIN vecs a ON a.id = p.id JOIN vecs b ON b.model = a.model),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY model, id ORDER BY round(score, 9) DESC, hit) AS rank
  FROM scored),
best AS (
  SELECT model, placed.id, rank, hit, score, d.text_cleaned AS hit_text, q.text_cleaned AS query_doc
  FROM placed JOIN docs d ON d.id = hit JOIN docs q ON q.id = placed.id WHERE rank <= 3
  UNION ALL
  SELECT model, id, 1, NULL, NULL, NULL, text_cleaned
  FROM picked JOIN docs USING (id), (SELECT DISTINCT model FROM vecs)
  WHERE (model, id) NOT IN (SELECT (model, id) FROM vecs))"""


@case(with_ctes(EVALUATED, f"""
SELECT id, rank, any_value(query_doc) AS query_doc,
       (SELECT array_to_string({plain_list('text')}, ' ') FROM documents WHERE doc_id = best.id)
         AS query_tokens,
       max(shown) FILTER (model = 'simple_w2v_results') AS simple_w2v_results,
       max(shown) FILTER (model = 'improved_w2v_results') AS improved_w2v_results
FROM (SELECT *, 'TEXT : ' || chr(10) || hit_text || chr(10) || chr(10) || ' SCORE : ' || chr(10)
             || (round(score, 2) + 0.0)::VARCHAR AS shown FROM best) best
GROUP BY id, rank"""))
def e3_evaluate(spark, sf_dir):
    found = evaluate(*eval_inputs(spark, sf_dir))
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@case(with_ctes(EVALUATED, """
SELECT model, count(*) AS n_queries,
       round(avg(coalesce((hit_text = query_doc)::INT, 0)), 6) AS self_hit_rate
FROM best WHERE rank = 1 GROUP BY model"""))
def e3_self_hits(spark, sf_dir):
    rates = self_hits(rank_by_model(*eval_inputs(spark, sf_dir)))
    return rates.withColumn("self_hit_rate", rounded("self_hit_rate"))


@case(with_ctes(EVALUATED, """
SELECT id, rank, max(hit) FILTER (model = 'simple_w2v_results') AS simple_w2v_results,
       max(hit) FILTER (model = 'improved_w2v_results') AS improved_w2v_results
FROM best GROUP BY id, rank"""))
def j6_compare_models(spark, sf_dir):
    ranked = rank_by_model(*eval_inputs(spark, sf_dir))
    wide = compare_models(ranked, "hit_id")
    return wide.withColumn("rank", F.col("rank").cast("bigint"))


def shared_ids(spark, sf_dir):
    """The corpus with every two documents under one id, each a row of its own."""
    docs = corpus(spark, sf_dir).withColumnRenamed("id", "doc_id").withColumn("id", F.floor(F.col("doc_id") / 2))
    return stored(spark, sf_dir, "shared-ids", lambda: with_row_key(docs))


def shared_index(spark, sf_dir):
    """Mean vectors by row key, and the index of the corpus whose ids repeat."""
    docs = shared_ids(spark, sf_dir)
    toks = docs.select(ROW_KEY, plain_tokens(F.col("text_cleaned")).alias("preprocessed_text"))
    return stored(spark, sf_dir, "shared-index", lambda: build_index(
        docs, mean_vectors(toks, words(spark, sf_dir), ROW_KEY), key=ROW_KEY))


@case(with_ctes(f"""{DOCS}, {MEANS},
asked AS (
  SELECT d.id AS query_id, d.id % 5 + 1 AS n, d.text_cleaned AS query, m.v
  FROM docs d JOIN mean_vecs m USING (id)),
cand AS (SELECT d.id // 2 AS id, d.text_cleaned, m.v FROM docs d LEFT JOIN mean_vecs m USING (id)),
placed AS (
  SELECT a.query_id, a.query, a.n, c.id, c.text_cleaned, list_cosine_similarity(a.v, c.v) AS score,
         row_number() OVER (PARTITION BY a.query_id
                            ORDER BY round(list_cosine_similarity(a.v, c.v), 9) DESC NULLS LAST, c.id) AS r,
         count(*) OVER (PARTITION BY a.query_id) AS c
  FROM asked a, cand c),
flagged AS (
  SELECT *, max(CASE WHEN r = 1 AND query = text_cleaned THEN 1 ELSE 0 END)
            OVER (PARTITION BY query_id) AS self FROM placed)""", """
SELECT query_id, r - self AS rank, id, round(score, 6) + 0.0 AS cosine_sim_score
FROM flagged WHERE r - self BETWEEN 1 AND CASE WHEN c < n THEN 1 ELSE n END AND score IS NOT NULL"""))
def e2_search_shared_ids(spark, sf_dir):
    """Every document asks by its own row, against a corpus in which each id names two rows."""
    docs, index = shared_ids(spark, sf_dir), shared_index(spark, sf_dir)
    queries = docs.join(index.select(ROW_KEY, "vector"), ROW_KEY).select(
        F.col("doc_id").alias("query_id"), F.col("text_cleaned").alias("query"), "vector",
        (F.col("doc_id") % 5 + 1).cast("int").alias("n"),
    )
    found = batch_search(queries, index, docs)
    return found.select("query_id", F.col("rank").cast("bigint").alias("rank"), "id",
                        rounded("cosine_sim_score").alias("cosine_sim_score"))


@case(with_ctes(EVALUATED, f"""
SELECT id, rank, any_value(query_doc) AS query_doc,
       (SELECT array_to_string({plain_list('text')}, ' ') FROM documents WHERE doc_id = best.id)
         AS query_tokens,
       max(shown) FILTER (model = 'simple_w2v_results') AS simple_w2v_results,
       max(shown) FILTER (model = 'improved_w2v_results') AS improved_w2v_results,
       NULL::VARCHAR AS "BEST", bool_or(coalesce(hit_text = query_doc, false)) AS is_self
FROM (SELECT *, 'TEXT : ' || chr(10) || hit_text || chr(10) || chr(10) || ' SCORE : ' || chr(10)
             || (round(score, 2) + 0.0)::VARCHAR AS shown FROM best) best
GROUP BY id, rank"""))
def e3_judging_sheet(spark, sf_dir):
    """The sheet a judge fills: shown texts per model, an empty BEST and is_self."""
    found = evaluate(*eval_inputs(spark, sf_dir), sheet=True)
    return found.withColumn("rank", F.col("rank").cast("bigint"))
