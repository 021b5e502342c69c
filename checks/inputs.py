"""Inputs the checks derive from the test tables, in Spark and in SQL.

Each SQL constant is a list of CTEs; `with_ctes` puts those a query names in front of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinitext.functions.text import TOKEN_PATTERN, plain_tokens, tokenize
from affinitext.operators.doc_vectors import (
    build_index,
    build_vocab,
    mean_vectors,
    pooled_vectors,
)
from affinitext.operators.words import missing_words, oov_vectors
from affinitext.session import free_shuffles, shared_folder
from affinitext.sources.corpus import spread_out

DIMS = 16
PART = 6  # places that floating-point results are compared to


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    read = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_out(read) if name == "documents" else read


_STORED: dict[tuple[str, str, str], str] = {}


def stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], spread: bool = True
) -> DataFrame:
    """A table worked out once per session and read back, as word vectors and indexes are.

    Unless `spread`, `build` deals its rows to files itself, before it makes them wide."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        cores = spark.sparkContext.defaultParallelism
        # Token lists and vectors take about half the space they take by default.
        (build().repartition(cores) if spread else build()).write.parquet(path, compression="zstd")
        free_shuffles(spark)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "(" + ", ".join(quoted(value) for value in values) + ")"


def rounded(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, PART) + F.lit(0.0)


def shown_time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def long_vector(df: DataFrame, key: str, column: str = "vector") -> DataFrame:
    """(key, i, x) rows: vectors compare component by component."""
    return df.select(key, F.posexplode(column).alias("i", "x")).select(
        key, F.col("i").cast("bigint").alias("i"), rounded("x").alias("x")
    )


# --- documents as a dated corpus -------------------------------------------------------

DATE = "timestampadd(HOUR, cast(doc_id*1237%35064 as int), timestamp_ntz'2018-01-01 00:00:00')"


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.expr(DATE).alias("pub_date"),
        F.col("source").alias("feed"),
        F.col("text").alias("text_cleaned"),
        "lang",
    )


DOCS = """docs AS (
  SELECT doc_id AS id, TIMESTAMP '2018-01-01' + to_hours((doc_id*1237%35064)::INT) AS pub_date,
         source AS feed, text AS text_cleaned, lang
  FROM documents)"""

# --- French phrases the synthetic texts lack, one per document -------------------------

PHRASES = [
    " M. Dupont et ém. ou ²m. M.M. disent",
    " Mmes et Mme Durand, m.mme",
    " 5 kilomètres carrés à 90 kilomètres par heure",
    " 10 m2. et 3 m2m2, 2 centimètres cubes",
    " Open Vld et N-VA, open Vld open",
    " 1.000 fois 50 pourcents, 20 euros ou dollars, 5% n’est",
    " porte-parole d'aujourd'hui -- a- l’homme n'y (x²)",
    " 4 centimètres carrés, 7 centimères carrés 8 mètres cubes",
    " 20\u00a0km et 1\u202f000 pas, page\x0csuivante",
]


def phrase_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, whole, with one of the phrases at its end."""
    number = F.col("id") % len(PHRASES)
    phrase = F.element_at(F.array(*map(F.lit, PHRASES)), (number + 1).cast("int"))
    return corpus(spark, sf_dir).withColumn("text_cleaned", F.concat("text_cleaned", phrase))


PHRASE_DOCS = f"""{DOCS}, phrase_docs AS (
  SELECT id, text_cleaned || [{", ".join(map(quoted, PHRASES))}][id % {len(PHRASES)} + 1]
         AS text_cleaned FROM docs)"""

# --- a lexicon from the corpus's own words ---------------------------------------------

DETERMINERS = ["le", "la", "les", "un", "une", "des", "the", "der", "die", "das", "el", "los"]
PRONOUNS = ["il", "elle", "qui", "that", "he", "it", "sie", "l’", "n'"]


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "lexicon", lambda: make_lexicon(spark, sf_dir))


def make_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms seen twice; lemma without a final s, part of speech by list."""
    form = F.col("form")
    return (
        table(spark, sf_dir, "documents")
        .select(F.explode(tokenize(F.col("text"))).alias("form"))
        .groupBy("form")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n >= 2")
        .select(
            "form",
            F.regexp_replace(F.lower("form"), "s$", "").alias("lemma"),
            F.when(F.lower("form").isin(DETERMINERS), "DET")
            .when(F.lower("form").isin(PRONOUNS), "PRON")
            .when(form.rlike(r"^[^\p{L}\p{N}_]$"), "PUNCT")
            .otherwise("NOUN")
            .alias("pos"),
        )
    )


LEXICON = f"""forms AS (
  SELECT unnest(regexp_extract_all(text, {quoted(TOKEN_PATTERN)})) AS form FROM documents),
lexicon AS (
  SELECT form, regexp_replace(lower(form), 's$', '') AS lemma,
         CASE WHEN lower(form) IN {sql_list(DETERMINERS)} THEN 'DET'
              WHEN lower(form) IN {sql_list(PRONOUNS)} THEN 'PRON'
              WHEN regexp_matches(form, '^[^\\p{{L}}\\p{{N}}_]$') THEN 'PUNCT'
              ELSE 'NOUN' END AS pos
  FROM forms GROUP BY form HAVING count(*) >= 2)"""

# --- plain tokens, and word vectors by hash --------------------------------------------


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every document, read by each step over the corpus, like a prepared one."""
    return stored(spark, sf_dir, "tokens", lambda: make_tokens(spark, sf_dir), spread=False)


def make_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select(
        "id", plain_tokens(F.col("text_cleaned")).alias("preprocessed_text")
    )


def plain_list(column: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{Nl}}\\p{{No}}_]+'), "
        "lambda t: length(t) BETWEEN 2 AND 25 AND NOT starts_with(t, '_'))"
    )


TOKENS = f"toks AS (SELECT doc_id AS id, unnest({plain_list('text')}) AS word FROM documents)"


def hash_component(word: Column, i: Column, mark: str = "#") -> Column:
    digits = F.substring(F.md5(F.concat(word, F.lit(mark), i.cast("string"))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(2147483648.0) - F.lit(1.0)


def hash_vector(word: Column, mark: str = "#", dims: int = DIMS) -> Column:
    places = F.sequence(F.lit(0), F.lit(dims - 1))
    return F.transform(places, lambda i: hash_component(word, i, mark))


def words(spark: SparkSession, sf_dir: str, mark: str = "#") -> DataFrame:
    name = "words" if mark == "#" else "other-words"
    return stored(spark, sf_dir, name, lambda: make_words(spark, sf_dir, mark), spread=False)


def make_words(spark: SparkSession, sf_dir: str, mark: str = "#", dims: int = DIMS) -> DataFrame:
    """A vector for every token seen twice; the others stay unknown words."""
    vocab = build_vocab(tokens(spark, sf_dir)).select("word")
    dealt = vocab.repartition(spark.sparkContext.defaultParallelism)
    return dealt.select("word", hash_vector(F.col("word"), mark, dims).alias("vector"))


def hash_sql(word: str, i: str, mark: str = "#") -> str:
    return (
        f"(('0x'||substr(md5({word}||'{mark}'||{i}),1,8))::BIGINT/2147483648.0::DOUBLE - 1)"
    )


WORDS = f"""{TOKENS},
vocab AS (SELECT word, count(*) AS n FROM toks GROUP BY word HAVING count(*) >= 2),
comps AS (SELECT word, i, {hash_sql('word', 'i')} AS x FROM vocab, range({DIMS}) r(i)),
units AS (SELECT word, i, x / sqrt(sum(x*x) OVER (PARTITION BY word)) AS x FROM comps),
word_vecs AS (SELECT word, list(x ORDER BY i) AS v FROM comps GROUP BY word),
word_units AS (SELECT word, list(x ORDER BY i) AS v FROM units GROUP BY word)"""

MEANS = f"""{WORDS},
sums AS (SELECT id, i, avg(x) AS m FROM toks JOIN units USING (word) GROUP BY id, i),
means AS (SELECT id, i, m / sqrt(sum(m*m) OVER (PARTITION BY id)) AS x FROM sums),
mean_vecs AS (SELECT id, list(x ORDER BY i) AS v FROM means GROUP BY id)"""


def fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subword vectors of the tokens without a word vector."""

    def build() -> DataFrame:
        known = words(spark, sf_dir)
        return oov_vectors(known, missing_words(tokens(spark, sf_dir), known))

    return stored(spark, sf_dir, "fallback", build)


def doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark, sf_dir, "doc-vectors",
        lambda: mean_vectors(tokens(spark, sf_dir), words(spark, sf_dir)),
    )


def pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark, sf_dir, "pooled-vectors",
        lambda: pooled_vectors(
            tokens(spark, sf_dir), words(spark, sf_dir), fallback(spark, sf_dir)
        ),
    )


def mean_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus's search index on mean vectors."""
    return stored(
        spark, sf_dir, "mean-index",
        lambda: build_index(corpus(spark, sf_dir), doc_vectors(spark, sf_dir)),
    )


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector")
    )


EMBEDDED = f"""{DOCS}, embedded AS (
  SELECT d.*, e.embedding::DOUBLE[] AS v FROM docs d LEFT JOIN embeddings e ON e.vec_id = d.id)"""


def with_ctes(ctes: str, query: str) -> str:
    return f"WITH {ctes}\n{query}"
