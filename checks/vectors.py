"""Vocabulary, vectors, pooling, the word space and training."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinitext.functions.vectors import concat_vectors, cosine, unit
from affinitext.operators.doc_vectors import (
    build_vocab,
    lookup_tokens,
    mean_vectors,
    pooled_vectors,
    space_profile,
)
from affinitext.operators.training import train_words
from affinitext.operators.words import (
    analogy,
    apply_rotation,
    closer_than,
    cross_covariance,
    doesnt_match,
    fit_rotation,
    missing_words,
    most_similar,
    oov_vectors,
)
from affinitext.sources.vectors import model_words
from checks.inputs import (
    make_words,
    stored,
    DIMS,
    MEANS,
    TOKENS,
    WORDS,
    embedding_vectors,
    fallback,
    hash_component,
    hash_sql,
    long_vector,
    rounded,
    tokens,
    with_ctes,
    words,
)
from checks.registry import case


@case(with_ctes(TOKENS, """
SELECT word, count(*) AS n FROM toks GROUP BY word HAVING count(*) >= 2"""))
def a4_build_vocab(spark, sf_dir):
    return build_vocab(tokens(spark, sf_dir))


@case(with_ctes(WORDS, f"""
SELECT {DIMS}::BIGINT AS dims, (SELECT count(*) FROM vocab) AS n_words,
       (SELECT count(*) FROM documents) AS n_docs"""))
def a5_space_profile(spark, sf_dir):
    found = space_profile(words(spark, sf_dir), tokens(spark, sf_dir))
    return found.withColumn("dims", F.col("dims").cast("bigint"))


LOOKED_UP = with_ctes(WORDS, """
SELECT id, word, tf, unnest(range(len(v))) AS i, round(unnest(v), 6) + 0.0 AS x
FROM (SELECT id, word, count(*) AS tf FROM toks GROUP BY id, word) JOIN word_vecs USING (word)""")


def each_component(found):
    x = F.posexplode("vector").alias("i", "x")
    return found.select("id", "word", "tf", x).select(
        "id", "word", "tf", F.col("i").cast("bigint").alias("i"), rounded("x").alias("x"))


def looked_up(spark, sf_dir, broadcast):
    found = lookup_tokens(tokens(spark, sf_dir), words(spark, sf_dir), broadcast=broadcast)
    return each_component(found)


@case(LOOKED_UP)
def j2_lookup_tokens(spark, sf_dir):
    return looked_up(spark, sf_dir, None)


@case(LOOKED_UP)
def j2_lookup_tokens_by_shuffle(spark, sf_dir):
    """The way for a vocabulary too large to broadcast."""
    return looked_up(spark, sf_dir, False)


MEAN_ROWS = with_ctes(MEANS, "SELECT id, i, round(x, 6) + 0.0 AS x FROM means")


@case(MEAN_ROWS)
def a2_mean_vectors(spark, sf_dir):
    return long_vector(mean_vectors(tokens(spark, sf_dir), words(spark, sf_dir)), "id")


@case(MEAN_ROWS)
def a2_mean_vectors_by_shuffle(spark, sf_dir):
    found = mean_vectors(tokens(spark, sf_dir), words(spark, sf_dir), broadcast=False)
    return long_vector(found, "id")


GRAMS = """lengths AS (SELECT unnest([3, 4, 5, 6]) AS n),
piece AS (
  SELECT DISTINCT word, substr('<' || word || '>', s::INT, n) AS gram
  FROM every_word, lengths, LATERAL (SELECT unnest(range(1, length(word) + 4 - n)) AS s)
  WHERE n <= length(word) + 2)"""

OOV = f"""{WORDS},
every_word AS (SELECT DISTINCT word FROM toks), {GRAMS},
gram_vecs AS (
  SELECT gram, i, avg(x) AS x FROM piece JOIN comps USING (word) GROUP BY gram, i),
oov AS (
  SELECT word, i, avg(x) AS x FROM piece JOIN gram_vecs USING (gram)
  WHERE word NOT IN (SELECT word FROM vocab) GROUP BY word, i)"""


@case(with_ctes(OOV, "SELECT word, i, round(x, 6) + 0.0 AS x FROM oov"))
def v5_oov_vectors(spark, sf_dir):
    known = words(spark, sf_dir)
    missing = missing_words(tokens(spark, sf_dir), known)
    return long_vector(oov_vectors(known, missing), "word")


ALL_WORDS = f"""{OOV},
either AS (SELECT word, i, x FROM comps UNION ALL SELECT word, i, x FROM oov)"""


@case(with_ctes(ALL_WORDS, """
SELECT id, word, count(*) AS tf, i, round(x, 6) + 0.0 AS x
FROM toks JOIN either USING (word) GROUP BY id, word, i, x"""))
def j3_lookup_tokens_with_fallback(spark, sf_dir):
    found = lookup_tokens(
        tokens(spark, sf_dir), words(spark, sf_dir), fallback(spark, sf_dir))
    return each_component(found)


@case(with_ctes(ALL_WORDS, f"""
SELECT id, i, round(avg(x), 6) + 0.0 AS x FROM toks JOIN either USING (word) GROUP BY id, i
UNION ALL
SELECT id, i + {DIMS}, round(max(x), 6) + 0.0 FROM toks JOIN either USING (word) GROUP BY id, i"""))
def a3_pooled_vectors(spark, sf_dir):
    found = pooled_vectors(
        tokens(spark, sf_dir), words(spark, sf_dir), fallback(spark, sf_dir))
    return long_vector(found, "id")


@case("""
SELECT vec_id AS id, i - 1 AS i, round(x / sqrt(sum(x*x) OVER (PARTITION BY vec_id)), 6) + 0.0 AS x
FROM (SELECT vec_id, i, embedding[i]::DOUBLE AS x FROM embeddings, range(1, 65) r(i))""")
def f18_unit(spark, sf_dir):
    vectors = embedding_vectors(spark, sf_dir)
    return long_vector(vectors.select("id", unit("vector").alias("vector")), "id")


@case("""
SELECT a.vec_id AS id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]),
       6) + 0.0 AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def f19_cosine(spark, sf_dir):
    """Each vector with the next one."""
    a = embedding_vectors(spark, sf_dir)
    b = a.select((F.col("id") - 1).alias("id"), F.col("vector").alias("next"))
    return a.join(b, "id").select(
        "id", rounded(cosine(F.col("vector"), F.col("next"))).alias("score"))


@case("""
SELECT vec_id AS id, i - 1 AS i, round(twice[i]::DOUBLE, 6) + 0.0 AS x
FROM (SELECT vec_id, embedding || list_reverse(embedding) AS twice FROM embeddings), range(1, 129) r(i)""")
def f20_concat_vectors(spark, sf_dir):
    vectors = embedding_vectors(spark, sf_dir)
    both = concat_vectors(F.col("vector"), F.reverse("vector"))
    return long_vector(vectors.select("id", both.alias("vector")), "id")


# Words that every scale of the test texts has.
POSITIVE = ["The", "with", "que"]
NEGATIVE = ["and", "Les"]
ODD = ["the", "and", "with", "que", "les"]


def target_sql(signs: dict[str, int]) -> str:
    cases = " ".join(f"WHEN '{word}' THEN {sign}" for word, sign in signs.items())
    return f"""{WORDS},
weighted AS (SELECT i, sum(x * CASE word {cases} END) AS x FROM units
             WHERE word IN ({", ".join(f"'{w}'" for w in signs)}) GROUP BY i),
target AS (SELECT list(x ORDER BY i) AS v FROM weighted),
scored AS (SELECT word, list_cosine_similarity(word_units.v, target.v) AS score
           FROM word_units, target)"""


def nearest_sql(signs: dict[str, int], n: int) -> str:
    return with_ctes(target_sql(signs), f"""
SELECT word, round(score, 6) + 0.0 AS score FROM scored
WHERE word NOT IN ({", ".join(f"'{w}'" for w in signs)})
ORDER BY round(scored.score, 9) DESC, word LIMIT {n}""")


def shown(df):
    return df.select("word", rounded("score").alias("score"))


@case(nearest_sql({"the": 1, "with": 1, "que": 1}, 10))
def v1_most_similar(spark, sf_dir):
    return shown(most_similar(words(spark, sf_dir), POSITIVE, 10))


@case(with_ctes(target_sql(dict.fromkeys(ODD, 1)), f"""
SELECT word, round(score, 6) + 0.0 AS score FROM scored
WHERE word IN ({", ".join(f"'{w}'" for w in ODD)}) ORDER BY round(scored.score, 9), word LIMIT 1"""))
def v2_doesnt_match(spark, sf_dir):
    return shown(doesnt_match(words(spark, sf_dir), ODD))


@case(nearest_sql({"the": 1, "with": 1, "que": 1, "and": -1, "les": -1}, 10))
def v3_analogy(spark, sf_dir):
    return shown(analogy(words(spark, sf_dir), POSITIVE, NEGATIVE))


@case(with_ctes(target_sql({"the": 1}), """
SELECT word, round(score, 6) + 0.0 AS score FROM scored
WHERE word <> 'the' AND score > (SELECT score FROM scored WHERE word = 'with')"""))
def v4_closer_than(spark, sf_dir):
    return shown(closer_than(words(spark, sf_dir), "The", "with"))


def hash_matrix(spark):
    places = F.sequence(F.lit(0), F.lit(DIMS - 1))
    return (
        spark.range(DIMS)
        .select(F.col("id").cast("int").alias("i"), F.explode(places).alias("j"))
        .withColumn("x", hash_component(F.concat(F.lit("row"), F.col("i")), F.col("j")))
    )


@case(with_ctes(f"""{WORDS},
matrix AS (SELECT a AS i, b AS j, {hash_sql("'row'||a", 'b')} AS m
           FROM range({DIMS}) ra(a), range({DIMS}) rb(b))""", """
SELECT word, j AS i, round(sum(x * m), 6) + 0.0 AS x FROM comps JOIN matrix USING (i)
GROUP BY word, j"""))
def v6_apply_rotation(spark, sf_dir):
    return long_vector(apply_rotation(words(spark, sf_dir), hash_matrix(spark)), "word")


@case(with_ctes(f"""{WORDS},
other AS (SELECT word, i AS j, {hash_sql('word', 'i', '@')} AS y FROM vocab, range({DIMS}) r(i))""",
    """
SELECT i, j, round(sum(x * y), 6) + 0.0 AS x FROM comps JOIN other USING (word) GROUP BY i, j"""))
def v7_cross_covariance(spark, sf_dir):
    found = cross_covariance(words(spark, sf_dir), words(spark, sf_dir, "@"))
    return found.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
                        rounded("x").alias("x"))


@case(
    f"""SELECT i::BIGINT AS i, j::BIGINT AS j,
       CASE WHEN i + j = {DIMS - 1} THEN 1.0 - 2 * (j % 2) ELSE 0.0 END::DOUBLE AS x
FROM range({DIMS}) a(i), range({DIMS}) b(j)"""
)
def v7_fit_rotation(spark, sf_dir):
    """The other space is the first with its components in reverse, every second one negated."""
    a = words(spark, sf_dir)
    turned = F.transform(F.reverse("vector"), lambda x, j: x * (F.lit(1.0) - 2 * (j % 2)))
    found = fit_rotation(a, a.select("word", turned.alias("vector")))
    return found.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
                        rounded("x").alias("x"))


@case(
    with_ctes(
        TOKENS,
        "SELECT word, 100::BIGINT AS dims, true AS finite FROM toks GROUP BY word HAVING count(*) >= 2",
    )
)
def a8_train_words(spark, sf_dir):
    """All dimensions and epochs; the numbers depend on partitioning, so words and shape count."""
    model = model_words(train_words(tokens(spark, sf_dir), seed=1))
    finite = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return model.select("word", F.size("vector").cast("bigint").alias("dims"), finite.alias("finite"))


# --- the same vectors at the widths of real models -----------------------------------------


def wide_words(spark, sf_dir, dims):
    """Word vectors of `dims` components, stored like the narrow ones."""
    return stored(
        spark, sf_dir, f"words-{dims}", lambda: make_words(spark, sf_dir, dims=dims), spread=False)


def wide_sql(dims: int, query: str) -> str:
    return with_ctes(MEANS.replace(f"range({DIMS})", f"range({dims})"), query)


@case(wide_sql(100, "SELECT id, i, round(x, 6) + 0.0 AS x FROM means"))
def a2_mean_vectors_100(spark, sf_dir):
    return long_vector(mean_vectors(tokens(spark, sf_dir), wide_words(spark, sf_dir, 100)), "id")


@case(wide_sql(200, "SELECT id, i, round(x, 6) + 0.0 AS x FROM means"))
def a2_mean_vectors_200_by_shuffle(spark, sf_dir):
    found = mean_vectors(tokens(spark, sf_dir), wide_words(spark, sf_dir, 200), broadcast=False)
    return long_vector(found, "id")


POOLED_WIDE = """
SELECT id, i, round(avg(x), 6) + 0.0 AS x FROM toks JOIN comps USING (word) GROUP BY id, i
UNION ALL
SELECT id, i + {dims}, round(max(x), 6) + 0.0 FROM toks JOIN comps USING (word) GROUP BY id, i"""


@case(wide_sql(100, POOLED_WIDE.format(dims=100)))
def a3_pooled_vectors_100_by_shuffle(spark, sf_dir):
    found = pooled_vectors(tokens(spark, sf_dir), wide_words(spark, sf_dir, 100), broadcast=False)
    return long_vector(found, "id")


@case(wide_sql(200, POOLED_WIDE.format(dims=200)))
def a3_pooled_vectors_200(spark, sf_dir):
    return long_vector(pooled_vectors(tokens(spark, sf_dir), wide_words(spark, sf_dir, 200)), "id")
