"""The text rules that are easy to get wrong, each against its literal examples."""

import pytest
from pyspark.sql import functions as F

from affinitext.functions import text as t
from affinitext.operators.corpus import fix_party_names
from affinitext.operators.tokens import annotate, normalize, preprocess

LEXICON = [
    ("le", "le", "DET"),
    ("l’", "le", "DET"),
    ("il", "il", "PRON"),
    ("pourcents", "pourcent", "NOUN"),
    ("vit", "voir", "VERB"),
    ("que", "que", "SCONJ"),
    ("parcequ", "parce que", "SCONJ"),
]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "form string, lemma string, pos string")


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(expression(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("M. Dupont", "monsieur Dupont"),
        ("m. x", "monsieur x"),
        ("ém.", "ém."),
        ("²m.", "²m."),
        ("_m.", "_m."),
        ("M.M.", "monsieurmonsieur"),
        ("Mmes", "madames"),
        ("xMme", "xmadame"),
        ("(m.)", "(monsieur)"),
        ("am.m.", "am.monsieur"),
        ("mme", "mme"),
        ("𝐀m.", "𝐀m."),
        ("🙂m.", "🙂monsieur"),
    ],
)
def test_honorifics(spark, text, expected):
    assert one(spark, text, "string", t.expand_honorifics) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("5 kilomètres carrés", "5 km carrés"),
        ("90 kilomètres par heure", "90 km par heure"),
        ("centimètres carrés", "centimètres carrés"),
        ("centimères carrés", "cm²"),
        ("2 centimètres cubes", "2 km³"),
        ("3 décimètres cubes", "3 km³"),
        ("10 m2.", "10 m²."),
        ("m2m2", "m2m2"),
        ("10m2", "10m2"),
        ("m2 m2", "m² m²"),
        ("ékilomètres", "ékilomètres"),
        ("𝐀m2", "𝐀m2"),
        ("m2𝐀", "m2𝐀"),
        ("🙂m2🙂", "🙂m²🙂"),
        ("", ""),
    ],
)
def test_units(spark, text, expected):
    assert one(spark, text, "string", t.abbreviate_units) == expected


def test_units_are_a_parameter(spark):
    replaced = one(spark, "3 miles", "string", lambda c: t.abbreviate_units(c, {"miles": "mi"}))
    assert replaced == "3 mi"


@pytest.mark.parametrize(
    "text, expected",
    [("--", ""), ("a-", "a"), ("5%", "5"), ("\\x\\", "x"), ("[a,b]", "a,b"), ("’a’", "’a’")],
)
def test_strip(spark, text, expected):
    assert one(spark, text, "string", t.strip_chars) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("5", True), ("²", True), ("1.000", False), ("", False), ("5a", False), ("٣", True)],
)
def test_number(spark, text, expected):
    assert one(spark, text, "string", t.is_number) is expected


def test_lemma_punctuation(spark):
    kept = "# $ % - \\ ’"
    assert one(spark, kept, "string", t.split_lemma) == kept.split()
    for mark in t.LEMMA_PUNCTUATION:
        assert one(spark, f"a{mark}b", "string", t.split_lemma) == ["a", "b"]


def test_plain_tokens(spark):
    text = "L'Été _x y 2024 " + "z" * 26 + " ab_c"
    assert one(spark, text, "string", t.plain_tokens) == ["été", "ab_c"]


@pytest.mark.parametrize(
    "tokens, expected",
    [
        (["open", "vld"], ["Open VLD"]),
        (["a", "open"], ["a", "open"]),
        (["open", "open", "vld"], ["open", "Open VLD"]),
        (["vld", "open"], ["vld", "open"]),
        (["open", "vld", "open", "vld"], ["Open VLD", "Open VLD"]),
        (["n-va"], ["n-va"]),
        ([], []),
        (None, None),
    ],
)
def test_party_names(spark, tokens, expected):
    assert one(spark, tokens, "array<string>", t.merge_party_name) == expected


def test_party_names_only_where_the_text_mentions_one(spark):
    df = spark.createDataFrame(
        [(1, "Open Vld", ["open", "vld"]), (2, "open vld", ["open", "vld"]), (3, None, ["open", "vld"])],
        "id long, text_cleaned string, preprocessed_text array<string>",
    )
    got = {r["id"]: r["preprocessed_text"] for r in fix_party_names(df).collect()}
    assert got == {1: ["Open VLD"], 2: ["open", "vld"], 3: ["open", "vld"]}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", []),
        (None, None),
        ("le le", []),
        ("5", ["5"]),
        ("x", []),
        ("--", []),
        ("1.000", ["000"]),
        ("50 pourcents", ["50"]),
        ("20 euros", ["20"]),
        ("n’est", ["ne", "est"]),
        ("porte-parole", ["porte-parole"]),
        ("N-VA", ["n-va"]),
        ("il vit", ["voir"]),
        ("l’homme", ["homme"]),
        ("parcequ", ["parce", "que"]),
        ("M. Dupont", ["monsieur", "dupont"]),
        ("aujourd'hui", ["aujourd", "hui"]),
        ("5 kilomètres", ["5", "km"]),
    ],
)
def test_preprocess(spark, lexicon, text, expected):
    df = spark.createDataFrame([(1, text)], "id long, text_cleaned string")
    assert preprocess(df, lexicon).first()["preprocessed_text"] == expected


def test_both_ways_to_look_tokens_up_agree(spark, lexicon):
    texts = ["il vit l’homme", "", None, "le le inconnu", "il vit l’homme"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text_cleaned string")
    by_batch = preprocess(df, lexicon).orderBy("id").collect()
    by_join = preprocess(df, lexicon, limit=0).orderBy("id").collect()
    assert by_batch == by_join
    tokens = normalize(df, into="n").select("id", t.tokenize(F.col("n")).alias("tokens"))
    assert (
        annotate(tokens, lexicon).orderBy("id").collect()
        == annotate(tokens, lexicon, limit=0).orderBy("id").collect()
    )


def test_an_empty_lexicon_leaves_every_form_unknown(spark, lexicon):
    df = spark.createDataFrame([(1, "il vit")], "id long, text_cleaned string")
    assert preprocess(df, lexicon.limit(0)).first()["preprocessed_text"] == ["il", "vit"]


def test_rows_with_one_id_and_different_texts_stay_apart(spark, lexicon):
    df = spark.createDataFrame([(1, "vit"), (1, "homme")], "id long, text_cleaned string")
    for limit in (0, 10**9):
        rows = preprocess(df, lexicon, limit=limit).collect()
        assert sorted(r["preprocessed_text"] for r in rows) == [["homme"], ["voir"]]


def test_display(spark):
    df = spark.createDataFrame([("x", 0.125, "2020-03-01 10:00:00")], "a string, s double, d string")
    row = df.select(
        t.display_text(F.col("a"), F.col("s")).alias("text"),
        t.display_score(F.col("s")).alias("score"),
        t.display_date(F.col("d").cast("timestamp_ntz")).alias("date"),
    ).first()
    assert row["text"] == "TEXT : \nx\n\n SCORE : \n0.13"
    assert row["score"] == "    0.13" and row["date"] == "01-03-20"


def test_a_lexicon_too_large_to_travel_moves_rare_forms_only(spark, lexicon):
    """Tokens once were all exploded, shuffled and collected again; now the rows stay whole and
    only forms that do not travel are asked for, once per list. Copies, nulls and empty lists."""
    from affinitext.operators.tokens import values_by_parts

    table = spark.createDataFrame([(f"f{i}", i) for i in range(50)], "form string, value int")
    lists = [[f"f{(i * j) % 60}" for j in range(9)] for i in range(40)] * 2
    lists += [None, [], [None, "f1", None], ["unknown"], ["f49"]]
    df = spark.createDataFrame(list(enumerate(lists)), "id long, tokens array<string>")
    want = {i: None if l is None else [int(x[1:]) if x and x[1:].isdigit() and int(x[1:]) < 50 else None for x in l]
            for i, l in enumerate(lists)}
    for travel in (0, 300, 10**6):
        found = values_by_parts(df, table, "tokens", "out", travel)
        assert found.columns == ["id", "tokens", "out"]
        assert "_pos" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert {r["id"]: r["out"] for r in found.collect()} == want


def test_packed_lists_come_back_whole():
    """Lists of tokens moved as rows of strings, three times the size of the texts."""
    import pyarrow as pa

    from affinitext.operators.tokens import _packed, _unpacked

    lists = [["a", None, "", "é\x00,\"", "b" * 300], [], None, [None], ["x"] * 5000]
    kind = pa.list_(pa.string())
    for some in (lists, [], [[]], [None]):
        assert _unpacked(_packed(pa.array(some, kind))).to_pylist() == some
    cut = pa.array(lists, kind).slice(1, 3)
    assert _unpacked(_packed(cut)).to_pylist() == lists[1:4]
    assert len(_packed(pa.array(lists[4:], kind))[0].as_py()) < 500


def test_by_parts_moves_packed_lists_and_no_pairs_to_count(spark):
    """Annotated tokens were shuffled one by one to be counted."""
    from affinitext.operators.lookup import entries_by_key
    from affinitext.operators.tokens import annotate

    entries = spark.createDataFrame([("a", "A", "N"), ("b", "B", None)], "form string, lemma string, pos string")
    df = spark.createDataFrame([(1, ["a", "b", "a", "z"]), (2, None), (3, ["b"])], "id long, tokens array<string>")
    for limit in (0, 10**6):
        found = annotate(df, entries, limit=limit)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert ("_packed" in plan) == (limit == 0)
        counts = entries_by_key(found, "id", "annotated", "a", "n").select("id", "a.*", "n")
        assert sorted(map(str, map(tuple, counts.collect()))) == sorted(map(str, [
            (1, "a", "A", "N", 2), (1, "b", "B", "X", 1), (1, "z", "z", "X", 1), (3, "b", "B", "X", 1)]))
