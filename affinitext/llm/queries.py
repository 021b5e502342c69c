"""The operators of this folder as queries on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinitext.llm import (
    chat, cotraining, jaccard, language, manifest, mixing, neighbours, packing, quality, secrets, suffixes, trie, warc,
)
from affinitext.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


@query()
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query()
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed_repeats(table(spark, sf_dir, "documents"))


@query()
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


@query()
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query()
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.verdicts(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", *[F.col(c).alias(c[1:]) for c in quality.MEASURES],
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
    )


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


_CONTROL = r"(\\|</?s>|\[/?INST\]|\[TEXT\])"
_ESCAPED = rf"length(regexp_replace({{0}}, '{_CONTROL}', '\\\1', 'g'))"


@query(
    rf"""
    with said as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
      union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    )
    select conv_id, count(*) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
      coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
      sum(13 + {_ESCAPED.format('role')} + {_ESCAPED.format('text')})::bigint as formatted_chars
    from said group by conv_id
    """
)
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string"
    )
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    paths = chat.best_paths(stored(chat.from_turns(said)))
    return chat.digests(stored(chat.format_paths(paths)))


@query()
def op9_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(index).drop("payload")


@query()
def op10_kmeans_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query()
def op4_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    docs = docs.withColumn("_tampered", manifest.leaf_hash(*[tampered if f == "n_chars" else F.col(f) for f in manifest.FIELDS]))
    rows = manifest.manifest(docs, carry=["_tampered"])
    folded = manifest.fold(F.col("_tampered"), F.col("path"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )


@query()
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


@query()
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = secrets.base_only(F.col("spans"))

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"),
    )
