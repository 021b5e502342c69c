"""Lookups by shuffle, with hot keys, rows without a key and keys without a row."""

import pytest

from affinitext.operators.lookup import entries_by_key, lookup_join


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_keep_their_rows(spark, how):
    pairs = [(i, "hot") for i in range(300)] + [(i, f"w{i}") for i in range(20)] + [(7, None), (8, None)]
    rows = spark.createDataFrame(pairs, "id bigint, word string")
    table = spark.createDataFrame([("hot", 1)] + [(f"w{i}", i) for i in range(5, 25)], "word string, x int")
    plain = sorted(rows.join(table, "word", how).select("id", "word", "x").collect(), key=str)
    for least in (0, 50, 10_000):
        found = lookup_join(rows, table, "word", "id", how, broadcast=False, salts=8, hot_rows=least)
        assert found.columns == ["word", "id", "x"]
        assert sorted(found.select("id", "word", "x").collect(), key=str) == plain


def test_every_hot_key_is_salted_in_proportion(spark):
    from affinitext.operators import lookup

    pairs = [(i, "hot") for i in range(300)] + [(i, "warm") for i in range(120)] + [(i, f"w{i}") for i in range(40)]
    rows = spark.createDataFrame(pairs, "id bigint, word string")
    got = {r["word"]: r["_salts"] for r in lookup._hot_keys(rows, "word", 50).collect()}
    assert got == {"hot": 6, "warm": 3}
    assert lookup._hot_keys(rows.limit(0), "word", 50).count() == 0


@pytest.mark.parametrize("head_bytes", [0, 200, 10**6])
def test_the_rows_used_most_are_broadcast_and_none_is_lost(spark, head_bytes):
    """A table too large to broadcast sent every row of the other side through the shuffle."""
    pairs = [(i, f"w{i % 7 if i % 3 else i}") for i in range(400)] + [(7, None), (8, None)]
    rows = spark.createDataFrame(pairs, "id bigint, word string")
    table = spark.createDataFrame([(f"w{i}", i) for i in range(0, 390)], "word string, x int")
    plain = sorted(rows.join(table, "word").select("id", "word", "x").collect())
    found = lookup_join(rows, table, "word", "id", broadcast=False, head_bytes=head_bytes)
    assert found.columns == ["word", "id", "x"]
    assert sorted(found.select("id", "word", "x").collect()) == plain
    assert ("Union" in found._jdf.queryExecution().optimizedPlan().toString()) == (head_bytes > 0)


def _pairs(df, key="id", lists="words"):
    plain = df.selectExpr(key, f"explode({lists}) AS word").groupBy(key, "word").count()
    return sorted(map(str, map(tuple, plain.collect())))


@pytest.mark.parametrize("entry", ["string", "struct<form:string,pos:string>"])
@pytest.mark.parametrize("ids", [range(6), [1, 1, 2, None, None, 3]])
def test_entries_by_key_counts_all_lists_of_a_key(spark, entry, ids, monkeypatch):
    """Every pair of id and word went through a shuffle to be counted."""
    from affinitext.operators import lookup

    monkeypatch.setattr(lookup, "CELLS", 4)
    names = [["a", "b", "a", None], [], None, ["b"], ["b", "b", "c"], ["a"]]
    odd = {"a": ("a", None), "b": ("a", "X"), "c": (None, None)}
    if entry != "string":
        names = [n if n is None else [odd.get(w) for w in n] for n in names]
    df = spark.createDataFrame(list(zip(ids, names)), f"id bigint, words array<{entry}>").coalesce(1)
    found = entries_by_key(df, "id", "words")
    assert found.columns == ["id", "word", "tf"]
    assert sorted(map(str, map(tuple, found.collect()))) == _pairs(df)
    if len(set(ids)) == 6:
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_lookup_tokens_moves_no_pairs_to_a_broadcast_vocabulary(spark):
    from affinitext.operators.doc_vectors import lookup_tokens

    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "z"])], "id bigint, preprocessed_text array<string>")
    words = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "word string, vector array<double>")
    found = lookup_tokens(docs, words)
    assert sorted(map(tuple, found.collect())) == [(1, "a", 2, [1.0]), (1, "b", 1, [2.0]), (2, "b", 1, [2.0])]
    assert "Exchange hash" not in found._jdf.queryExecution().executedPlan().toString()
