"""Vectors, pooling, the word space: against numpy on small fixtures."""

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from affinitext.functions import vectors as v
from affinitext.operators import word_sums
from affinitext.operators.doc_vectors import (
    attach_vectors,
    build_vocab,
    mean_vectors,
    pooled_vectors,
    space_profile,
    with_fallback,
)
from affinitext.operators.training import train_words
from affinitext.operators.words import (
    analogy,
    apply_rotation,
    closer_than,
    doesnt_match,
    fit_rotation,
    matrix_table,
    missing_words,
    most_similar,
    oov_vectors,
    subwords,
)
from affinitext.sources.vectors import (
    load_model,
    load_words,
    model_words,
    save_model,
    save_words,
)
from checks.inputs import make_tokens, tokens

rng = np.random.default_rng(7)
SPACE = {w: rng.normal(size=5) for w in "chat chien chaton maison route pont".split()}
DOCS = {
    1: ["chat", "chat", "chien"],
    2: ["inconnu"],
    3: [],
    4: ["pont", "inconnu", "route"],
    5: None,
    0: ["chat", "chat", "chien"],
}


@pytest.fixture(scope="module")
def words(spark):
    rows = [(w, x.tolist()) for w, x in SPACE.items()]
    return spark.createDataFrame(rows, "word string, vector array<double>")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(DOCS.items()), "id long, preprocessed_text array<string>")


def unit(x):
    return x / np.linalg.norm(x)


def by_key(df, key):
    return {r[key]: r["vector"] for r in df.collect()}


def test_unit_and_cosine(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    got = df.select(v.unit("a").alias("u"), v.cosine(F.col("a"), F.col("b")).alias("c")).collect()
    assert got[0]["u"] == [0.6, 0.8] and got[0]["c"] == pytest.approx(0.96)
    assert [(r["u"], r["c"]) for r in got[1:]] == [(None, None), (None, None)]


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_mean_counts_occurrences_of_unit_vectors(docs, words, broadcast):
    got = by_key(mean_vectors(docs, words, broadcast=broadcast), "id")
    assert set(got) == {0, 1, 4}
    want = unit((2 * unit(SPACE["chat"]) + unit(SPACE["chien"])) / 3)
    assert np.allclose(got[1], want) and np.allclose(got[0], want)
    assert np.linalg.norm(got[4]) == pytest.approx(1)


def test_documents_without_known_words_get_null(docs, words):
    got = by_key(attach_vectors(docs, mean_vectors(docs, words)), "id")
    assert set(got) == set(DOCS) and got[2] is None and got[3] is None and got[5] is None


@pytest.mark.parametrize("broadcast", [True, False])
def test_pooling_uses_raw_vectors_and_fallback(spark, docs, words, broadcast):
    spare = [9.0] * 5
    oov = spark.createDataFrame([("inconnu", spare), ("chat", spare)], words.schema)
    got = by_key(pooled_vectors(docs, words, oov, broadcast=broadcast), "id")
    chat, chien = SPACE["chat"], SPACE["chien"]
    assert np.allclose(got[1], np.r_[(2 * chat + chien) / 3, np.maximum(chat, chien)])
    assert np.allclose(got[2], spare + spare)
    assert set(got) == {0, 1, 2, 4}


def test_vocabulary(docs):
    assert {(r["word"], r["n"]) for r in build_vocab(docs).collect()} == {
        ("chat", 4), ("chien", 2), ("inconnu", 2)}


def test_profile(docs, words):
    row = space_profile(words, docs).first()
    assert (row["dims"], row["n_words"], row["n_docs"]) == (5, 6, 6)


def neighbours(positive, negative=()):
    target = sum(unit(SPACE[w]) for w in positive) - sum(unit(SPACE[w]) for w in negative)
    scores = {w: unit(x) @ unit(target) for w, x in SPACE.items()}
    return sorted(
        ((s, w) for w, s in scores.items() if w not in (*positive, *negative)), reverse=True)


def test_most_similar_and_analogy(words):
    got = [(r["score"], r["word"]) for r in most_similar(words, ["CHAT", "pont"], 2).collect()]
    want = neighbours(["chat", "pont"])[:2]
    assert [w for _, w in got] == [w for _, w in want]
    assert np.allclose([s for s, _ in got], [s for s, _ in want])
    got = [r["word"] for r in analogy(words, ["chat", "pont"], ["route"]).collect()]
    assert got == [w for _, w in neighbours(["chat", "pont"], ["route"])]


def test_unknown_words_in_a_query_raise(words):
    with pytest.raises((PySparkException, Py4JJavaError), match="not all in the vocabulary"):
        most_similar(words, ["chat", "inconnu"], 2).collect()
    with pytest.raises((PySparkException, Py4JJavaError), match="not in the vocabulary"):
        closer_than(words, "chat", "inconnu").collect()


def test_odd_one_out(words):
    names = ["chat", "chien", "maison", "pont"]
    mean = unit(np.mean([unit(SPACE[w]) for w in names], axis=0))
    want = min(names, key=lambda w: unit(SPACE[w]) @ mean)
    assert doesnt_match(words, names + ["Inconnu"]).first()["word"] == want


def test_closer_than(words):
    score = {w: unit(x) @ unit(SPACE["chat"]) for w, x in SPACE.items()}
    want = {w for w, s in score.items() if s > score["route"] and w not in ("chat", "route")}
    assert {r["word"] for r in closer_than(words, "Chat", "Route").collect()} == want


def test_subwords_of_short_words(spark):
    df = spark.createDataFrame([("",), ("a",), ("ab",), ("aaaa",)], "w string")
    got = {r["w"]: sorted(r["g"]) for r in df.select("w", subwords(F.col("w")).alias("g")).collect()}
    assert got[""] == [] and got["a"] == ["<a>"] and got["ab"] == ["<ab", "<ab>", "ab>"]
    assert got["aaaa"] == sorted({"<aa", "aaa", "aa>", "<aaa", "aaaa", "aaa>", "<aaaa", "aaaa>", "<aaaa>"})


def grams(word):
    marked = f"<{word}>"
    return {marked[i:i + n] for n in range(3, 7) for i in range(len(marked) - n + 1)}


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_words_outside_the_vocabulary(spark, words, broadcast):
    missing = spark.createDataFrame([("chats",), ("zzz",), ("ponton",)], "word string")
    got = by_key(oov_vectors(words, missing, broadcast=broadcast), "word")
    assert got["zzz"] is None
    for word in ("chats", "ponton"):
        means = []
        for gram in grams(word):
            holders = [x for w, x in SPACE.items() if gram in grams(w)]
            if holders:
                means.append(np.mean(holders, axis=0))
        assert np.allclose(got[word], np.mean(means, axis=0))


def test_missing_words(docs, words):
    assert [r["word"] for r in missing_words(docs, words).collect()] == ["inconnu"]


def test_rotation(spark, words):
    turn = np.linalg.qr(rng.normal(size=(5, 5)))[0]
    turned = apply_rotation(words, matrix_table(spark, turn))
    got = by_key(turned, "word")
    assert all(np.allclose(got[w], x @ turn) for w, x in SPACE.items())
    fitted = fit_rotation(words, turned).toPandas().pivot(index="i", columns="j", values="x")
    assert np.allclose(fitted.to_numpy(), turn)


def test_rotation_keeps_missing_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>").coalesce(1)
    got = by_key(apply_rotation(df, matrix_table(spark, np.array([[0.0, 1.0], [1.0, 0.0]]))), "id")
    assert got == {1: [2.0, 1.0], 2: None, 3: [4.0, 3.0]}


def test_training_and_stored_models(spark, tmp_path):
    text = ["chat", "chien", "chaton", "maison"] * 5
    df = spark.createDataFrame([(text,)] * 20 + [(["rare"],)], "preprocessed_text array<string>")
    model = train_words(df, dims=8, epochs=2, seed=1, partitions=2)
    trained = model_words(model)
    assert {r["word"]: len(r["vector"]) for r in trained.collect()} == dict.fromkeys(text, 8)
    save_model(model, str(tmp_path / "model"))
    save_words(trained, str(tmp_path / "words"))
    again = model_words(load_model(str(tmp_path / "model")))
    stored = load_words(spark, str(tmp_path / "words"))
    key = lambda r: r["word"]
    assert sorted(again.collect(), key=key) == sorted(stored.collect(), key=key)


def test_aggregate_vectors_against_brute_force(spark):
    """Partial sums per batch merged over arrays: nulls, short vectors, zero weights, many batches."""
    import math

    from affinitext.operators.doc_vectors import aggregate_vectors

    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        key = None if i % 97 == 0 else ("k" + str(i % 13))
        vec = None if i % 31 == 0 else rng.normal(size=3 if i % 17 == 0 else 5).round(3).tolist()
        rows.append((key, vec, None if i % 23 == 0 else int(i % 4)))
    rows.append(("zero", [1.0, 2.0, 3.0, 4.0, 5.0], 0))
    df = spark.createDataFrame(rows, "key string, vector array<double>, tf long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        ways = [{r["key"]: r["vector"] for r in aggregate_vectors(df, "key", 5, "tf", pooled=True, by_batches=b).collect()}
                for b in (True, False)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for got in ways:
        check_means(rows, got)


def check_means(rows, got):
    import math

    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        total = sum(r[2] or 0 for r in mine)
        if total == 0:
            assert got[key] is None
            continue
        sums = [sum((r[1][i] if r[1] and i < len(r[1]) else 0.0) * (r[2] or 0) for r in mine) for i in range(5)]
        tops = [max((r[1][i] for r in mine if r[1] and i < len(r[1])), default=None) for i in range(5)]
        want = [s / total for s in sums] + tops
        assert all((a is None and b is None) or math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[key], want))


@pytest.mark.parametrize("pooled", [False, True])
@pytest.mark.parametrize("travel, block", [(0, 400), (300, 10**6), (10**6, 10**6)])
def test_sums_per_row_whatever_travels(spark, pooled, travel, block):
    """Brute force: repeated and null ids, null words and texts, 60 components in 3 slices, and
    blocks that hold a few words each; no occurrence is ever joined with its vector."""
    from affinitext.operators.word_sums import sums_per_row

    space = {f"w{i}": rng.normal(size=60) for i in range(40)}
    texts = [[f"w{j}" for j in rng.integers(0, 50, size=rng.integers(0, 30))] for _ in range(60)]
    texts += [None, [], ["w1", None, "w1"], ["unknown"]]
    ids = [None if i == 7 or i == 8 else i // 2 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts)), "id long, words array<string>")
    words = spark.createDataFrame([(w, x.tolist()) for w, x in space.items()], "word string, vector array<double>")
    found = sums_per_row(docs, words, "id", "words", 60, 40 * 540, pooled, travel, block)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(get(" not in plan and "get(vector" not in plan
    want = {}
    for i, text in zip(ids, texts):
        want.setdefault(i, []).extend(space[w] for w in text or [] if w in space)
    want = {i: np.array(vs) for i, vs in want.items() if vs}
    got = {row["id"]: row["vector"] for row in found.collect()}
    assert set(got) == set(want) and found.count() == len(want)
    for i, vs in want.items():
        expected = np.r_[vs.mean(axis=0), vs.max(axis=0)] if pooled else vs.mean(axis=0)
        np.testing.assert_allclose(got[i], expected, atol=1e-12)


def test_large_vocabulary_does_not_meet_occurrences(spark, docs, words):
    """Vectors once were joined with every (document, word) and summed after a shuffle."""
    for found in (mean_vectors(docs, words, broadcast=False), pooled_vectors(docs, words, broadcast=False)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "get(vector" not in plan
    got = {row["id"]: row["vector"] for row in pooled_vectors(docs, words, broadcast=False).collect()}
    pair = np.array([SPACE["chat"], SPACE["chat"], SPACE["chien"]])
    np.testing.assert_allclose(got[1], np.r_[pair.mean(axis=0), pair.max(axis=0)], atol=1e-12)
    assert set(got) == {0, 1, 4}


def test_repeated_words_still_count_each_time(spark, docs):
    """Such a vocabulary is joined row by row as before."""
    twice = spark.createDataFrame([("chat", [1.0, 0.0]), ("chat", [0.0, 3.0])], "word string, vector array<double>")
    got = {row["id"]: row["vector"] for row in pooled_vectors(docs, twice).collect()}
    assert got[1] == [0.5, 1.5, 1.0, 3.0]


def test_missing_words_do_not_shuffle_a_vector_per_subword(spark, words):
    """The vectors of a missing word's subwords once were joined one by one and summed after."""
    missing = spark.createDataFrame([("chats",), ("zzz",), ("ponton",), (None,)], "word string")
    found = oov_vectors(words, missing, broadcast=False)
    assert "sum(get(" not in found._jdf.queryExecution().optimizedPlan().toString()
    near = by_key(found, "word")
    other = by_key(oov_vectors(words, missing, broadcast=True), "word")
    assert near.keys() == other.keys() and near[None] is None and near["zzz"] is None
    for word in ("chats", "ponton"):
        assert np.allclose(near[word], other[word])


def test_missing_words_read_the_corpus_once(spark, words):
    """The words to make vectors for once were found anew for every step."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(i, ["chat", "chatte", f"chien{i}"]) for i in range(20)]
    docs = spark.createDataFrame(rows, "id long, preprocessed_text array<string>")
    docs = docs.mapInArrow(counted, docs.schema)
    for broadcast in (True, False):
        before = read.value
        found = oov_vectors(words, missing_words(docs, words), broadcast=broadcast)
        assert found.count() == 21
        assert read.value - before == 20


def test_counting_words_makes_no_row_per_occurrence(spark, docs, words):
    for counted in (build_vocab(docs), missing_words(docs, words)):
        assert "Generate" not in counted._jdf.queryExecution().optimizedPlan().toString()
    gone = spark.createDataFrame([(["a", None, "a"],), ([],), (None,), ([None, "é"],)], "w array<string>")
    assert {(r["word"], r["n"]) for r in build_vocab(gone, 1, "w").collect()} == {
        ("a", 2), (None, 2), ("é", 1)}


def test_words_with_fallback_are_joined_once(spark, words):
    """Vocabulary and fallback once were joined again by every step over the words."""
    oov = spark.createDataFrame([("chat", [9.0] * 5), ("chatte", [1.0] * 5)], words.schema)
    either = with_fallback(words, oov)
    assert "Join" not in either._jdf.queryExecution().optimizedPlan().toString()
    assert {r["word"]: r["vector"] for r in either.collect()} == {
        **{w: x.tolist() for w, x in SPACE.items()}, "chatte": [1.0] * 5}


def test_no_list_is_missing_where_blocks_are_summed(spark, docs, words, monkeypatch):
    """Arrow goes over a run of missing lists again for every row of it."""
    seen = spark.sparkContext.accumulator(0)
    summed = word_sums._block_sums

    def watched(*given):
        run = summed(*given)

        def watch(batches):
            for batch in batches:
                seen.add(sum(batch.column(c).null_count for c in ("_rest", "_s", "_m")))
                yield batch

        return lambda batches: run(watch(batches))

    monkeypatch.setattr(word_sums, "_block_sums", watched)
    found = pooled_vectors(docs, words, broadcast=False)
    got = {r["id"]: r["vector"] for r in found.collect()}
    chosen = np.array([SPACE[w] for w in DOCS[1]])
    assert np.allclose(got[1], np.r_[chosen.mean(axis=0), chosen.max(axis=0)])
    assert seen.value == 0


def test_checks_tokenize_the_documents_once(spark):
    """Every step over the words of the documents once worked the tokens out anew."""
    kept = tokens(spark, "/root/testdata/sf0.001")
    assert "regexp" not in kept._jdf.queryExecution().optimizedPlan().toString()
    made = make_tokens(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, made.collect()))


def test_subword_vectors_are_written_before_words_meet_them(spark):
    """All shuffles from the vocabulary's subwords on lay on disk until the last step was over."""
    from affinitext.operators.words import oov_vectors

    words = spark.createDataFrame([("chat", [1.0, 2.0]), ("chats", [3.0, 4.0])], "word string, vector array<double>")
    missing = spark.createDataFrame([("chatte",), ("zzz",)], "word string")
    both = [oov_vectors(words, missing, broadcast=b) for b in (True, False)]
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))
    assert "LogicalRDD" not in both[0]._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("pooled", [False, True])
def test_sums_in_turns_leave_no_parts_behind(spark, pooled, tmp_path, monkeypatch):
    """The parts, pieces and sums of all documents lay on disk at once."""
    from affinitext.operators import word_sums

    written, real = [], word_sums.cut_lineage
    monkeypatch.setattr(word_sums, "cut_lineage", lambda df, **o: written.append(real(df, **o)) or written[-1])
    docs = [(i % 23 if i % 9 else None, [f"w{(i * j) % 31}" for j in range(7)]) for i in range(60)]
    docs = spark.createDataFrame(docs, "id long, words array<string>")
    words = spark.createDataFrame([(f"w{i}", rng.normal(size=30).tolist()) for i in range(28)],
                                  "word string, vector array<double>")
    one, many = (
        {r["id"]: r["vector"] for r in word_sums.sums_per_row(
            docs, words, "id", "words", 30, 10**4, pooled, 900, 10**6, turn).collect()}
        for turn in (10**6, 100))
    assert set(one) == set(many) and len(one) == 24
    for i in one:
        np.testing.assert_allclose(one[i], many[i], atol=1e-12)
    kept = [df for df in written if "_rest" in df.columns]
    there = [spark._jvm.java.io.File(df.inputFiles()[0].removeprefix("file:")).exists() for df in kept]
    assert len(kept) == 6 and there == [True] + [False] * 5
