"""Text functions, annotation and the whole preprocessing."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinitext.functions import text as t
from affinitext.operators.corpus import fix_party_names
from affinitext.operators.lookup import entries_by_key
from affinitext.operators.tokens import (
    annotate,
    normalize,
    preprocess,
    preprocess_annotated,
)
from affinitext.plans.prepare import prepare_corpus
from checks.inputs import (
    DOCS,
    LEXICON,
    PHRASE_DOCS,
    corpus,
    lexicon,
    phrase_corpus,
    plain_list,
    quoted,
    sql_list,
    table,
    with_ctes,
)
from checks.registry import case


def sir_sql(text: str) -> str:
    """Without lookbehind: hide the dots after a word character, replace, unhide."""
    hidden = f"regexp_replace({text}, '([\\p{{L}}\\p{{N}}_][Mm])\\.', '\\1' || chr(1), 'g')"
    return f"replace(replace(regexp_replace({hidden}, '[Mm]\\.', 'monsieur', 'g'), " \
           "chr(1), '.'), 'Mme', 'madame')"


def units_sql(text: str) -> str:
    """Without lookaround: take the neighbours along, twice as they may be shared."""
    for name, symbol in t.UNITS.items():
        find = quoted(f"(^|[^\\p{{L}}\\p{{N}}_]){name}([^\\p{{L}}\\p{{N}}_]|$)")
        put = quoted(f"\\1{symbol}\\2")
        for _ in range(2):
            text = f"regexp_replace({text}, {find}, {put}, 'g')"
    return text


STRIP = quoted(t.STRIP_CHARS)
DIGITS = quoted(t.DIGITS_PATTERN)
PATTERN = quoted(t.TOKEN_PATTERN)
GAPS = quoted(t.LEMMA_PUNCTUATION)
BLANKS = quoted(" " * len(t.LEMMA_PUNCTUATION))
ANY_SPACE = r"'[\p{Z}\x{09}-\x{0D}\x{1C}-\x{1F}\x{85}]'"


def tokens_of(column: str) -> str:
    return f"regexp_extract_all({column}, {PATTERN})"


@case(with_ctes(PHRASE_DOCS, f"SELECT id, {sir_sql('text_cleaned')} AS text FROM phrase_docs"))
def f1_expand_honorifics(spark, sf_dir):
    return phrase_corpus(spark, sf_dir).select(
        "id", t.expand_honorifics(F.col("text_cleaned")).alias("text"))


@case(with_ctes(PHRASE_DOCS, f"SELECT id, {units_sql('text_cleaned')} AS text FROM phrase_docs"))
def f2_abbreviate_units(spark, sf_dir):
    return phrase_corpus(spark, sf_dir).select(
        "id", t.abbreviate_units(F.col("text_cleaned")).alias("text"))


FORMS = f"""{PHRASE_DOCS}, forms_of AS (
  SELECT id, unnest({tokens_of('text_cleaned')}) AS form FROM phrase_docs)"""


def forms(spark, sf_dir):
    return phrase_corpus(spark, sf_dir).select(
        "id", F.explode(t.tokenize(F.col("text_cleaned"))).alias("form"))


@case(with_ctes(PHRASE_DOCS, """
SELECT id, trim(text_cleaned, """ + STRIP + """) AS text,
       trim('-"' || text_cleaned || '.)%', """ + STRIP + """) AS dressed FROM phrase_docs"""))
def f3_strip_chars(spark, sf_dir):
    docs = phrase_corpus(spark, sf_dir)
    dressed = F.concat(F.lit('-"'), "text_cleaned", F.lit(".)%"))
    return docs.select("id", t.strip_chars(F.col("text_cleaned")).alias("text"),
                       t.strip_chars(dressed).alias("dressed"))


@case(with_ctes(FORMS, f"""
SELECT form, regexp_matches(trim(form, {STRIP}), {DIGITS}) AS is_number, count(*) AS n
FROM forms_of GROUP BY ALL"""))
def f4_is_number(spark, sf_dir):
    number = t.is_number(t.strip_chars(F.col("form"))).alias("is_number")
    return forms(spark, sf_dir).groupBy("form", number).agg(F.count(F.lit(1)).alias("n"))


@case(with_ctes(PHRASE_DOCS, f"""
SELECT id, array_to_string(list_filter(string_split(regexp_replace(translate(text_cleaned,
       {GAPS}, {BLANKS}), {ANY_SPACE}, ' ', 'g'), ' '), lambda p: p <> ''), '|') AS parts
FROM phrase_docs"""))
def f5_split_lemma(spark, sf_dir):
    parts = t.split_lemma(F.col("text_cleaned"))
    return phrase_corpus(spark, sf_dir).select("id", F.array_join(parts, "|").alias("parts"))


SYMBOLS = """CASE WHEN lower(form) IN ('pourcent', 'pourcents') THEN '%'
    WHEN lower(form) IN ('dollar', 'dollars') THEN '$'
    WHEN lower(form) IN ('euro', 'euros') THEN '€' END"""


@case(with_ctes(FORMS, f"""
SELECT coalesce({SYMBOLS}, '') AS symbol, count(*) AS n, count(DISTINCT id) AS n_docs
FROM forms_of GROUP BY ALL"""))
def f6_symbols(spark, sf_dir):
    symbol = F.coalesce(t.symbol_for(F.lower("form")), F.lit("")).alias("symbol")
    return forms(spark, sf_dir).groupBy(symbol).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_docs"))


@case(with_ctes(FORMS, """
SELECT form, CASE WHEN form IN ('n’', 'n''') THEN 'ne' END AS negation, count(*) AS n
FROM forms_of GROUP BY ALL"""))
def f7_negation(spark, sf_dir):
    negation = t.negation_for(F.col("form")).alias("negation")
    return forms(spark, sf_dir).groupBy("form", negation).agg(F.count(F.lit(1)).alias("n"))


@case(with_ctes(FORMS, f"""
SELECT id, count(*) AS n_tokens,
       count(*) FILTER (form IN {sql_list(t.STOP_LEMMAS)}) AS n_stopped
FROM forms_of GROUP BY id"""))
def f8_stop_lemmas(spark, sf_dir):
    stopped = F.count_if(t.is_stop_lemma(F.col("form")))
    return forms(spark, sf_dir).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_tokens"), stopped.alias("n_stopped"))


TAGGED = f"""{PHRASE_DOCS}, {LEXICON},
tagged AS (
  SELECT f.id, f.form, coalesce(l.lemma, f.form) AS lemma, coalesce(l.pos, 'X') AS pos
  FROM (SELECT id, unnest({tokens_of('text_cleaned')}) AS form FROM phrase_docs) f
  LEFT JOIN lexicon l ON l.form = f.form)"""


def tagged_lists(spark, sf_dir, **options):
    docs = phrase_corpus(spark, sf_dir).select(
        "id", t.tokenize(F.col("text_cleaned")).alias("tokens"))
    return annotate(docs, lexicon(spark, sf_dir), **options)


def tagged(spark, sf_dir):
    annotated = tagged_lists(spark, sf_dir)
    return annotated.select("id", F.explode("annotated").alias("a")).select("id", "a.*")


@case(with_ctes(TAGGED, f"""
SELECT id, pos, count(*) AS n,
       count(*) FILTER (pos IN {sql_list(t.EXCLUDED_POS)}) AS n_excluded
FROM tagged GROUP BY ALL"""))
def f9_excluded_pos(spark, sf_dir):
    excluded = F.count_if(t.is_excluded_pos(F.col("pos")))
    return tagged(spark, sf_dir).groupBy("id", "pos").agg(
        F.count(F.lit(1)).alias("n"), excluded.alias("n_excluded"))


@case(with_ctes(PHRASE_DOCS, f"""
SELECT id, array_to_string(list_filter(list_transform(list_filter(
         {tokens_of('text_cleaned')}, lambda p: length(p) > 1),
         lambda p: trim(lower(p), {STRIP})), lambda p: p <> ''), ' ') AS tokens
FROM phrase_docs"""))
def f10_finish_parts(spark, sf_dir):
    finished = t.finish_parts(t.tokenize(F.col("text_cleaned")))
    return phrase_corpus(spark, sf_dir).select("id", t.join_tokens(finished).alias("tokens"))


PARTY_LISTS = f"""{PHRASE_DOCS}, lists AS (
  SELECT id, text_cleaned, list_transform({tokens_of('text_cleaned')}, lambda p: lower(p)) AS l
  FROM phrase_docs),
single AS (SELECT id, text_cleaned, unnest(l) AS w, generate_subscripts(l, 1) AS p FROM lists),
near AS (
  SELECT *, lag(w) OVER (PARTITION BY id ORDER BY p) AS before,
         lead(w) OVER (PARTITION BY id ORDER BY p) AS after FROM single),
merged AS (
  SELECT id, text_cleaned, p, w,
         CASE WHEN w = 'open' AND after = 'vld' THEN 'Open VLD' ELSE w END AS one,
         w = 'vld' AND coalesce(before, '') = 'open' AS gone FROM near)"""


def party_lists(spark, sf_dir):
    return phrase_corpus(spark, sf_dir).withColumn(
        "preprocessed_text", t.lower_words(t.tokenize(F.col("text_cleaned"))))


@case(with_ctes(PARTY_LISTS, """
SELECT id, string_agg(one, ' ' ORDER BY p) AS tokens FROM merged WHERE NOT gone GROUP BY id"""))
def f11_merge_party_name(spark, sf_dir):
    merged = t.merge_party_name(F.col("preprocessed_text"))
    return party_lists(spark, sf_dir).select("id", t.join_tokens(merged).alias("tokens"))


@case(with_ctes(PARTY_LISTS, """
SELECT id, string_agg(CASE WHEN regexp_matches(text_cleaned, 'Open Vld|N-VA') THEN one ELSE w END,
                      ' ' ORDER BY p) AS tokens
FROM merged WHERE NOT (gone AND regexp_matches(text_cleaned, 'Open Vld|N-VA')) GROUP BY id"""))
def pf11_fix_party_names(spark, sf_dir):
    fixed = fix_party_names(party_lists(spark, sf_dir))
    return fixed.select("id", t.join_tokens(F.col("preprocessed_text")).alias("tokens"))


@case(with_ctes(DOCS, f"""
SELECT id, array_to_string({plain_list('text_cleaned')}, ' ') AS tokens FROM docs"""))
def f12_plain_tokens(spark, sf_dir):
    tokens = t.plain_tokens(F.col("text_cleaned"))
    return corpus(spark, sf_dir).select("id", t.join_tokens(tokens).alias("tokens"))


@case(with_ctes(PHRASE_DOCS, """
SELECT id, regexp_matches(text_cleaned, 'Open Vld|N-VA') AS mentions,
       contains(text_cleaned, 'tion') AS has_tion FROM phrase_docs"""))
def f13_contains(spark, sf_dir):
    return phrase_corpus(spark, sf_dir).select(
        "id", F.col("text_cleaned").rlike(t.PARTY_TEXT).alias("mentions"),
        F.col("text_cleaned").contains("tion").alias("has_tion"))


@case(with_ctes(DOCS, f"""
SELECT id, array_to_string({tokens_of('text_cleaned')}, ' ') AS tokens FROM docs"""))
def f14_join_tokens(spark, sf_dir):
    tokens = t.tokenize(F.col("text_cleaned"))
    return corpus(spark, sf_dir).select("id", t.join_tokens(tokens).alias("tokens"))


@case(with_ctes(DOCS, """
SELECT id, 'TEXT : ' || chr(10) || text_cleaned || chr(10) || chr(10) || ' SCORE : ' || chr(10)
       || round((id % 997) / 997.0::DOUBLE, 2)::VARCHAR AS shown FROM docs"""))
def f15_display_text(spark, sf_dir):
    score = F.col("id") % 997 / F.lit(997.0)
    return corpus(spark, sf_dir).select(
        "id", t.display_text(F.col("text_cleaned"), score).alias("shown"))


@case("""
SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%y') AS shown_date,
       format('{:8.2f}', o_totalprice) AS shown_price FROM orders""")
def f16_display_formats(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", t.display_date(F.col("o_orderdate")).alias("shown_date"),
        t.display_score(F.col("o_totalprice")).alias("shown_price"))


@case("SELECT doc_id::VARCHAR AS given, doc_id AS id FROM documents")
def f17_cast_id(spark, sf_dir):
    given = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("given"))
    return given.select("given", F.col("given").cast("bigint").alias("id"))


ANNOTATED = """
SELECT id, form, lemma, pos, count(*) AS n FROM tagged GROUP BY ALL"""


def counted(df):
    return entries_by_key(df, "id", "annotated", "a", "n").select("id", "a.*", "n")


@case(with_ctes(TAGGED, ANNOTATED))
def j7_annotate(spark, sf_dir):
    return counted(tagged_lists(spark, sf_dir))


@case(with_ctes(TAGGED, ANNOTATED))
def j7_annotate_by_join(spark, sf_dir):
    """The way for a lexicon too large to travel to the tasks."""
    return counted(tagged_lists(spark, sf_dir, limit=0))


def preprocessed_sql(source: str) -> str:
    """CTEs from (id, text_cleaned) rows of `source` to their lexical tokens."""
    return f"""{LEXICON},
norm AS (SELECT id, text_cleaned, {units_sql(sir_sql('text_cleaned'))} AS t FROM {source}),
lists AS (SELECT id, text_cleaned, {tokens_of('t')} AS l FROM norm),
placed AS (SELECT id, unnest(l) AS form, generate_subscripts(l, 1) AS p FROM lists),
known AS (
  SELECT id, p, placed.form, trim(placed.form, {STRIP}) AS bare,
         coalesce(lemma, placed.form) AS lemma, coalesce(pos, 'X') AS pos
  FROM placed LEFT JOIN lexicon ON lexicon.form = placed.form),
kept AS (
  SELECT * FROM known WHERE pos NOT IN {sql_list(t.EXCLUDED_POS)}
  AND lemma NOT IN {sql_list(t.STOP_LEMMAS)}),
parts AS (
  SELECT id, p, CASE WHEN regexp_matches(bare, {DIGITS}) THEN [bare] ELSE
    list_filter(list_transform(list_filter(
      CASE WHEN lemma IN ('pourcent', 'pourcents') THEN ['%']
           WHEN lemma IN ('dollar', 'dollars') THEN ['$']
           WHEN lemma IN ('euro', 'euros') THEN ['€']
           WHEN form IN ('n’', 'n''') THEN ['ne']
           ELSE string_split(regexp_replace(translate(lemma, {GAPS}, {BLANKS}), {ANY_SPACE}, ' ', 'g'), ' ') END,
      lambda x: length(x) > 1), lambda x: trim(lower(x), {STRIP})), lambda x: x <> '') END AS ws
  FROM kept),
singles AS (SELECT id, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS s FROM parts),
marked AS (
  SELECT singles.*, regexp_matches(text_cleaned, 'Open Vld|N-VA') AS mentions
  FROM singles JOIN lists USING (id)),
near AS (
  SELECT *, lag(w) OVER (PARTITION BY id ORDER BY p, s) AS before,
         lead(w) OVER (PARTITION BY id ORDER BY p, s) AS after FROM marked)"""


PREPROCESSED = f"{PHRASE_DOCS}, {preprocessed_sql('phrase_docs')}"


P1_ROWS = with_ctes(PREPROCESSED, """
SELECT lists.id, coalesce(string_agg(w, ' ' ORDER BY p, s), '') AS tokens
FROM lists LEFT JOIN singles USING (id) GROUP BY lists.id""")


@case(P1_ROWS)
def p1_preprocess(spark, sf_dir):
    done = preprocess(phrase_corpus(spark, sf_dir), lexicon(spark, sf_dir))
    return done.select("id", t.join_tokens(F.col("preprocessed_text")).alias("tokens"))


@case(P1_ROWS)
def p1_preprocess_by_join(spark, sf_dir):
    """The way for a lexicon too large to travel to the tasks."""
    done = preprocess(phrase_corpus(spark, sf_dir), lexicon(spark, sf_dir), limit=0)
    return done.select("id", t.join_tokens(F.col("preprocessed_text")).alias("tokens"))


@case(P1_ROWS)
def p1_preprocess_annotated(spark, sf_dir):
    """The way for a user who brings annotated tokens."""
    docs = normalize(phrase_corpus(spark, sf_dir), into="text")
    tokens = docs.select("id", t.tokenize(F.col("text")).alias("tokens"))
    done = preprocess_annotated(annotate(tokens, lexicon(spark, sf_dir)))
    return done.select("id", t.join_tokens(F.col("preprocessed_text")).alias("tokens"))


@case(with_ctes(PREPROCESSED, """
SELECT lists.id, coalesce(string_agg(
    CASE WHEN mentions AND w = 'open' AND after = 'vld' THEN 'Open VLD' ELSE w END,
    ' ' ORDER BY p, s) FILTER (NOT (mentions AND w = 'vld' AND coalesce(before, '') = 'open')),
    '') AS tokens
FROM lists LEFT JOIN near USING (id) GROUP BY lists.id"""))
def p1_prepare_corpus(spark, sf_dir):
    done = prepare_corpus(phrase_corpus(spark, sf_dir), lexicon(spark, sf_dir))
    return done.select("id", t.join_tokens(F.col("preprocessed_text")).alias("tokens"))


@case(with_ctes(PHRASE_DOCS, f"""
SELECT id, {units_sql(sir_sql('text_cleaned'))} AS text FROM phrase_docs"""))
def p1_normalize(spark, sf_dir):
    return normalize(phrase_corpus(spark, sf_dir), into="text").select("id", "text")
