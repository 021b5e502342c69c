"""Ranking and search against brute force, skewed and broken inputs included."""

import datetime as dt

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from affinitext.operators.doc_vectors import build_index, mean_vectors
from affinitext.operators.queries import with_query_columns
from affinitext.operators.rank import exclude_self, rank_per_query, top_n
from affinitext.operators.score import best_candidates
from affinitext.plans.evaluate import evaluate, rank_by_model
from affinitext.plans.search import batch_search, resolve_queries, search
from affinitext.streaming.session import answer_stream, read_queries
from affinitext.operators.tokens import preprocess

rng = np.random.default_rng(3)
N = 300
DAY0 = dt.datetime(2020, 1, 1)


def make_vectors():
    """A third of the documents are copies of one; some have no vector, one is zero."""
    vectors = [rng.normal(size=4).tolist() for _ in range(N)]
    for i in range(0, N, 3):
        vectors[i] = vectors[0]
    for i in (10, 100, 200):
        vectors[i] = None
    vectors[20] = [0.0] * 4
    return vectors


VECTORS = make_vectors()
DATES = [None if i == 50 else DAY0 + dt.timedelta(hours=53 * i) for i in range(N)]


@pytest.fixture(scope="module")
def index(spark):
    rows = [(i, DATES[i], VECTORS[i]) for i in range(N)]
    return spark.createDataFrame(rows, "id long, pub_date timestamp_ntz, vector array<double>")


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, DATES[i], f"text {i % 250}", ["t"]) for i in range(N)]
    return spark.createDataFrame(
        rows, "id long, pub_date timestamp_ntz, text_cleaned string, preprocessed_text array<string>")


def score(a, b):
    if a is None or b is None or not np.any(a) or not np.any(b):
        return None
    return float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))


def admitted(date, q):
    if any(q.get(k) for k in ("day", "month", "year", "start_date", "end_date")) and date is None:
        return False
    return all((
        not q.get("day") or date.day == q["day"],
        not q.get("month") or date.month == q["month"],
        not q.get("year") or date.year == q["year"],
        not q.get("start_date") or date >= q["start_date"],
        not q.get("end_date") or date <= q["end_date"],
    ))


def brute_force(q, exclude=True, clamp=True):
    vector = VECTORS[q["doc_id"]]
    if vector is None or not np.any(vector):
        return []
    found = [(i, score(vector, VECTORS[i])) for i in range(N) if admitted(DATES[i], q)]
    n = q["n"]
    if clamp and 0 < len(found) < n:
        n = 1
    ranked = sorted((f for f in found if f[1] is not None), key=lambda f: (-round(f[1], 9), f[0]))
    if exclude and ranked and ranked[0][0] % 250 == q["doc_id"] % 250:
        ranked = ranked[1:]
    return [i for i, _ in ranked[:n]]


def make_queries():
    day = dt.timedelta(days=1)
    conditions = [
        {}, dict(year=2020), dict(month=5), dict(day=3), dict(day=7, month=2), dict(month=4, year=2021),
        dict(day=1, month=1, year=2020), dict(start_date=DAY0 + 40 * day, end_date=DAY0 + 60 * day),
        dict(start_date=DAY0 + 500 * day), dict(end_date=DAY0 + 9 * day),
        dict(start_date=DAY0 + 9000 * day), dict(end_date=DAY0),
    ]
    picks = [0, 3, 5, 10, 20, 50, 251, 299]
    return [
        dict(query_id=100 * j + p, doc_id=p, n=1 + (p + j) % 5, **c)
        for j, c in enumerate(conditions) for p in picks
    ]


QUERY_SCHEMA = (
    "query_id long, doc_id long, n int, day int, month int, year int, "
    "start_date timestamp_ntz, end_date timestamp_ntz"
)


def as_table(spark, queries):
    names = [f.split()[0] for f in QUERY_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(q.get(n) for n in names) for q in queries], QUERY_SCHEMA)


def hits(df):
    got = {}
    for row in df.orderBy("query_id", "rank").collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["id"]))
    return got


@pytest.mark.parametrize("exclude", ["drop_if_best_is_self", "none"])
def test_batch_search_is_brute_force(spark, index, corpus, exclude):
    queries = make_queries()
    resolved = resolve_queries(as_table(spark, queries), index, corpus)
    got = hits(batch_search(resolved, index, corpus, exclude))
    for q in queries:
        want = brute_force(q, exclude != "none")
        assert got.get(q["query_id"], []) == list(enumerate(want, 1)), q


def test_result_does_not_depend_on_layout(spark, index, corpus):
    resolved = resolve_queries(as_table(spark, make_queries()), index, corpus)
    one = batch_search(resolved, index.coalesce(1), corpus).orderBy("query_id", "rank").collect()
    many = batch_search(
        resolved.repartition(5), index.orderBy(F.desc("id")).repartition(8), corpus.repartition(3)
    ).orderBy("query_id", "rank").collect()
    key = [(r["query_id"], r["rank"], r["id"]) for r in one]
    assert key == [(r["query_id"], r["rank"], r["id"]) for r in many]
    assert np.allclose([r["cosine_sim_score"] for r in one], [r["cosine_sim_score"] for r in many])


def test_queries_in_several_blocks(spark, index, corpus):
    resolved = resolve_queries(as_table(spark, make_queries()), index, corpus)
    whole = best_candidates(resolved, index, 4)
    parts = best_candidates(resolved, index, 4, block_bytes=2000)
    key = ["query_id", "rank", "id"]
    assert sorted(whole.select(key).collect()) == sorted(parts.select(key).collect())


def test_small_batches_and_many_of_them(spark, index, corpus):
    queries = with_query_columns(index.filter("vector is not null").select(
        F.col("id").alias("query_id"), "vector"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = best_candidates(queries, index.coalesce(1), 4).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for q in (0, 5, 299):
        mine = sorted((r["rank"], r["id"]) for r in got if r["query_id"] == q)
        ranked = sorted(range(N), key=lambda i: (
            -round(score(VECTORS[q], VECTORS[i]) or -2, 9), i))
        assert [i for _, i in mine] == ranked[:4]


def test_search_equals_batch_of_one(spark, index, corpus):
    q = dict(query_id=0, doc_id=5, n=4, year=2021)
    got = search(index, corpus, doc_id=5, year=2021, n=4).orderBy("rank").collect()
    assert [r["id"] for r in got] == brute_force(q)
    assert got[0]["query"] == "text 5" and "preprocessed_text" not in got[0].asDict()
    assert search(index, corpus, doc_id=0).count() == 3


def test_refused_searches(spark, index, corpus):
    with pytest.raises(ValueError, match="month"):
        search(index, corpus, doc_id=1, month=13)
    with pytest.raises(ValueError, match="either"):
        search(index, corpus)
    with pytest.raises(ValueError, match="words"):
        search(index, corpus, text="x")
    with pytest.raises(PySparkException, match="no document has the id 999"):
        search(index, corpus, doc_id=999).collect()


def test_month_and_day_make_compat_ignore_the_year(spark, index, corpus):
    own = DATES[7]
    got = search(index, corpus, doc_id=5, day=own.day, month=own.month, year=2021, n=1, compat=True)
    want = brute_force(dict(doc_id=5, day=own.day, month=own.month, n=1))
    assert [r["id"] for r in got.collect()] == want


def test_date_conditions_reach_the_scan(spark, index, corpus, tmp_path):
    path = str(tmp_path / "index")
    index.withColumn("year", F.year("pub_date")).write.partitionBy("year").parquet(path)
    queries = resolve_queries(
        as_table(spark, [dict(query_id=1, doc_id=5, n=3, year=2020), dict(query_id=2, doc_id=6, n=3, year=2020)]),
        index, corpus)
    plan = best_candidates(queries, spark.read.parquet(path), 4)._jdf.queryExecution().executedPlan().toString()
    # The year's hull ends at its last instant, so the next year's folder is not read.
    assert "GreaterThanOrEqual(pub_date,2020-01-01" in plan and "LessThanOrEqual(pub_date,2020-12-31T23:59:59.999999" in plan
    folders = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year#" in folders and "<= 2020" in folders


def test_no_pairs_are_joined(spark, index, corpus):
    resolved = resolve_queries(as_table(spark, make_queries()), index, corpus)
    for df in (best_candidates(resolved, index, 4), batch_search(resolved, index, corpus)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_top_n(spark):
    rows = [(1, 0.5), (2, float("nan")), (3, 0.5 + 1e-12), (4, None), (5, 0.9)]
    df = spark.createDataFrame(rows, "id long, score double")
    assert [r["id"] for r in top_n(df, 2).collect()] == [5, 1]
    assert [r["id"] for r in top_n(df, 9).collect()] == [5, 1, 3]


def test_rank_of_a_hot_query(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("query_id"),
        "id", (F.hash("id") % 100 / 100.0).alias("score"))
    kept = rank_per_query(df, 3).select("query_id", "rank", "id")
    groups = {}
    for r in df.collect():
        groups.setdefault(r["query_id"], []).append((-r["score"], r["id"]))
    whole = [(q, i, r[1]) for q, rows in groups.items() for i, r in enumerate(sorted(rows)[:3], 1)]
    assert sorted(map(tuple, kept.collect())) == sorted(whole)


def test_only_the_best_hit_can_be_the_query(spark):
    rows = [(1, 1, "b"), (1, 2, "a"), (2, 1, "a"), (2, 2, "a"), (3, 1, None)]
    df = spark.createDataFrame(rows, "query_id long, rank int, text_cleaned string").withColumn("query", F.lit("a"))
    got = sorted((r["query_id"], r["rank"]) for r in exclude_self(df).collect())
    assert got == [(1, 1), (1, 2), (2, 1), (3, 1)]
    with pytest.raises(ValueError):
        exclude_self(df, "all")


WORDS = {w: rng.normal(size=4).tolist() for w in "chat chien pont route mer".split()}
TEXTS = ["le chat et le chien", "un pont", "la route", "la mer", "chat chien mer", "rien", "le chat et le chien"]


@pytest.fixture(scope="module")
def library(spark):
    lexicon = spark.createDataFrame(
        [("le", "le", "DET"), ("la", "le", "DET"), ("un", "un", "DET")], "form string, lemma string, pos string")
    words = spark.createDataFrame(list(WORDS.items()), "word string, vector array<double>")
    rows = [(i, DAY0 + dt.timedelta(days=i), text) for i, text in enumerate(TEXTS)]
    docs = preprocess(
        spark.createDataFrame(rows, "id long, pub_date timestamp_ntz, text_cleaned string"), lexicon)
    return docs, build_index(docs, mean_vectors(docs, words)), words, lexicon


def test_search_by_text(library):
    docs, index, words, lexicon = library
    got = search(index, docs, text=TEXTS[0], words=words, lexicon=lexicon).orderBy("rank").collect()
    assert got[0]["id"] == 6 and got[0]["cosine_sim_score"] == pytest.approx(1)
    assert got[0]["query"] == TEXTS[0] and len(got) == 3
    other = search(index, docs, text="chien chat", words=words, lexicon=lexicon).orderBy("rank").collect()
    assert [r["id"] for r in other][:2] == [0, 6]
    assert search(index, docs, text="inconnu", words=words, lexicon=lexicon).isEmpty()


def test_evaluation(spark, library):
    docs, index, words, _ = library
    picked = docs.filter("id in (1, 6)")
    models = {"simple": (index.select("id", "vector").dropna(), index), "again": (index.select("id", "vector").dropna(), index)}
    wide = evaluate(picked, docs, models, 2).orderBy("id", "rank").collect()
    assert [(r["id"], r["rank"]) for r in wide] == [(1, 1), (1, 2), (6, 1), (6, 2)]
    assert wide[0]["simple"] == "TEXT : \nun pont\n\n SCORE : \n1.0" == wide[0]["again"]
    assert wide[2]["query_tokens"] == "chat et chien"
    ranked = rank_by_model(picked, docs, models, 2)["simple"]
    assert {(r["id"], r["rank"], r["hit_id"], r["is_self"]) for r in ranked.collect()} >= {(6, 1, 0, True), (6, 2, 6, True)}


def test_session_as_a_stream(spark, library, tmp_path):
    docs, index, words, lexicon = library
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.json").write_text(
        '{"query_id": 1, "text": "le chat"}\n{"query_id": 2, "doc_id": 99}\n{"query_id": 3, "doc_id": 1, "month": 13}\n'
        '{"query_id": 4, "doc_id": 0, "start_date": "2020-01-01T00:00:00", "end_date": "2020-01-05T00:00:00", "n": 2}\n')
    out = str(tmp_path / "out")
    run = answer_stream(read_queries(spark, str(inbox)), index, docs, words, lexicon, out, str(tmp_path / "cp"))
    run.trigger(availableNow=True).start().awaitTermination()
    (inbox / "b.json").write_text('{"query_id": 5, "text": "la mer"}\n')
    run.trigger(availableNow=True).start().awaitTermination()
    answers = spark.read.option("header", True).csv(f"{out}/answers")
    got = {(r["query_id"], r["rank"]): r["id"] for r in answers.collect()}
    assert {q for q, _ in got} == {1, 4, 5} and got[(5, "1")] is not None and len(got) == 8
    refused = {r["query_id"]: r["reason"] for r in spark.read.json(f"{out}/rejected").collect()}
    assert refused == {2: "no document has this id", 3: "month must be 1 to 12"}


def test_repeated_ids_are_candidates_of_their_own(spark):
    """Two rows of one id are two candidates, each ranked once; internal names do not clash."""
    from affinitext.operators.corpus import ROW_KEY, one_per_id, with_row_key

    vectors = [[1.0, 0.0], [0.9, 0.1], [0.8, 0.3], [0.9, 0.1], [0.1, 1.0], None]
    ids = [1, 2, 2, 3, 3, 4]
    rows = [(i, f"t{k}", 7, 8.0, "x", v) for k, (i, v) in enumerate(zip(ids, vectors))]
    raw = spark.createDataFrame(
        rows, "id long, text_cleaned string, rank int, score double, __key string, vector array<double>")
    docs = with_row_key(raw.drop("vector"))
    keys = docs.select(ROW_KEY, "id", "text_cleaned").collect()
    assert len({r[ROW_KEY] for r in keys}) == len(rows)
    assert [r["id"] for r in sorted(keys, key=lambda r: r[ROW_KEY])] == sorted(ids)
    vecs = docs.join(raw.select("text_cleaned", "vector"), "text_cleaned").select(ROW_KEY, "vector")
    index = build_index(docs, vecs, key=ROW_KEY)
    queries = spark.createDataFrame([(0, "q", [1.0, 0.0], 3), (1, "t4", [0.1, 1.0], 5)],
                                    "query_id long, query string, vector array<double>, n int")
    found = batch_search(queries, index, docs).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r["query_id"], []).append(r)
    want0 = sorted(((-round(score([1.0, 0.0], v), 9), i, t) for i, t, v in
                    zip(ids, [f"t{k}" for k in range(6)], vectors) if v), key=lambda x: (x[0], x[1]))
    assert [(r["rank"], r["id"]) for r in sorted(by_query[0], key=lambda r: r["rank"])] == \
        [(k + 1, w[1]) for k, w in enumerate(want0[:3])]
    assert sorted(r["rank"] for r in by_query[1]) == [1, 2, 3, 4]  # its own text, best, is left out
    assert {r["rank"] for r in found} and all(r["score"] == 8.0 and r["__key"] == "x" for r in found)
    with pytest.raises(PySparkException):
        build_index(docs, vecs).collect()
    kept, others = one_per_id(raw.drop("vector"))
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3, 4] and others.count() == 2
    with pytest.raises(PySparkException):
        build_index(docs.union(docs), vecs, key=ROW_KEY).collect()


def test_blocks_one_at_a_time_with_own_k(spark, index, monkeypatch):
    """Many blocks give the rows of one, each block is on the driver alone, and each query
    keeps as many as it asks for."""
    from affinitext.operators import score as scoring

    rows = [(q, VECTORS[q] or [1.0, 0, 0, 0], q % 4 + 1) for q in range(0, N, 7)]
    queries = with_query_columns(spark.createDataFrame(rows, "query_id long, vector array<double>, k int"))
    whole = {tuple(r) for r in best_candidates(queries, index, 4, k_col="k").collect()}
    sizes, real = [], scoring._collect_block

    def counted(df):
        block = real(df)
        sizes.append(0 if block is None else len(block.ids))
        return block

    monkeypatch.setattr(scoring, "_collect_block", counted)
    parts = {tuple(r) for r in best_candidates(queries, index, 4, block_bytes=1500, k_col="k").collect()}
    assert parts == whole and len(sizes) > 3 and max(sizes) < len(rows) / 2
    ks = dict((q, k) for q, _, k in rows)
    per = {}
    for q, _, _, rank in whole:
        per.setdefault(q, []).append(rank)
    assert all(sorted(r) == list(range(1, ks[q] + 1)) for q, r in per.items())


def test_typed_dates_and_unreadable_ones(spark):
    """dd-MM-yyyy reads like ISO; what cannot be read is a rejected row, not a failed batch."""
    from affinitext.operators.queries import BAD_DATE, validate_queries

    rows = [(1, "a", "01-03-2020", "15-06-2021"), (2, "b", "2020-03-01", "2021-06-15 00:00:00"),
            (3, "c", "31-02-2020", None), (4, "d", "soon", None), (5, "e", None, None)]
    queries = spark.createDataFrame(rows, "query_id long, text string, start_date string, end_date string")
    valid, rejected = validate_queries(queries)
    got = {r["query_id"]: (r["start_date"], r["end_date"]) for r in valid.collect()}
    assert got[1] == got[2] == (dt.datetime(2020, 3, 1), dt.datetime(2021, 6, 15)) and got[5] == (None, None)
    assert {r["query_id"]: r["reason"] for r in rejected.collect()} == {3: BAD_DATE, 4: BAD_DATE}
    with pytest.raises(PySparkException):
        with_query_columns(queries).collect()


def test_year_hull_ends_inside_its_year(spark):
    """The dates a block of year queries reaches stop before the next year, folder included."""
    from affinitext.operators import score as scoring

    rows = [(1, dt.datetime(2020, 12, 31, 23, 59, 59), 2020), (2, dt.datetime(2021, 1, 1), 2021),
            (3, dt.datetime(2020, 1, 1), 2020), (4, dt.datetime(2019, 12, 31, 23), 2019)]
    candidates = spark.createDataFrame(rows, "id long, pub_date timestamp_ntz, year int")
    nat = np.array(["NaT"], dtype="datetime64[us]")
    block = scoring.QueryBlock(ids=np.array([0]), vectors=np.ones((1, 2)), start=nat, end=nat,
                               day=np.array([0]), month=np.array([0]), year=np.array([2020]))
    assert sorted(r["id"] for r in scoring._within_reach(candidates, block).collect()) == [1, 3]


def test_many_blocks_are_dealt_to_tasks(spark, index, corpus, monkeypatch):
    """Queries of many blocks are answered in one job, without a block on the driver, and
    give the rows of one block: dates, copies, missing vectors and own k included."""
    from affinitext.operators import score as scoring

    resolved = resolve_queries(as_table(spark, make_queries()), index, corpus).withColumn(
        "k", (F.col("query_id") % 4 + 1).cast("int"))
    whole = sorted(tuple(r) for r in best_candidates(resolved, index, 4, k_col="k").collect())
    monkeypatch.setattr(scoring, "_collect_block", lambda df: pytest.fail("a block came to the driver"))
    found = best_candidates(resolved, index, 4, block_bytes=300, k_col="k")
    assert sorted(tuple(r) for r in found.collect()) == whole
    years = resolved.filter("year is not null").withColumn("start_date", F.lit(None).cast("timestamp_ntz")).withColumn(
        "end_date", F.col("start_date"))
    assert years.count() > 0
    some = sorted(r["query_id"] for r in best_candidates(years, index, 4, block_bytes=100, k_col="k").collect())
    assert some == sorted(q for q, *_ in whole if q in {r["query_id"] for r in years.collect()})


def test_rough_scores_lose_no_hit(spark):
    """Scores nearer to each other than single precision tells still rank by double precision."""
    base = np.random.default_rng(1).normal(size=32)
    rows = [(i, (base + 1e-7 * np.random.default_rng(i).normal(size=32)).tolist()) for i in range(400)]
    rows += [(900, [float("inf")] * 32), (901, [float("nan")] * 32), (902, [0.0] * 32)]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>")
    queries = with_query_columns(vectors.filter("id < 20").select(F.col("id").alias("query_id"), "vector"))
    for size in (8 * 2**20, 300):
        found = best_candidates(queries, vectors.coalesce(1), 5, block_bytes=size).collect()
        for q in range(20):
            want = sorted(range(400), key=lambda i: (-round(score(rows[q][1], rows[i][1]), 9), i))[:5]
            assert [r["id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == want


def test_evaluate_works_out_the_evaluation_set_once(spark):
    """However many steps and models use it, the evaluation set is computed once."""
    from pyspark.sql import functions as F

    from affinitext.plans.evaluate import evaluate

    worked_out = spark.sparkContext.accumulator(0)

    def cleaned(i):
        worked_out.add(1)
        return f"text {i}"

    text = F.udf(cleaned, "string")
    ids = spark.range(1, 4)
    asked = ids.select("id", text("id").alias("text_cleaned"), F.array(F.lit("text")).alias("preprocessed_text"))
    docs = spark.range(1, 7).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("text_cleaned"))
    vectors = spark.range(1, 7).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    sheet = evaluate(asked, docs, {"a": (vectors, vectors), "b": (vectors, vectors)}, 2, sheet=True).collect()
    assert len(sheet) == 6 and sum(r.is_self for r in sheet) == 3
    assert worked_out.value == 3
