"""Every operator against brute force on a few rows with nulls, ties, repeats and long texts."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from affinitext.llm import (
    chat, cotraining, jaccard, language, mixing, neighbours, packing, quality, suffixes, warc,
)
from affinitext.llm.queries import ORACLES, QUERIES
from checks.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, size int, kept int, token int"
WORDS = r"[^\x20\x09-\x0D]+"


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(n))


LONG = sentence(1, 3000)
NEAR = LONG.replace(" ", "\n", 3) + " end"
PASSAGE = sentence(2, 90)
ROWS = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "Word", "en", None),
    (5, LONG, "en", "a"), (6, LONG, "fr", "b"), (6, LONG, "fr", "b"), (7, NEAR, "fr", "c"),
    (None, sentence(3, 30), "fr", "c"), (8, sentence(4, 40) + PASSAGE + sentence(5, 40), "de", "b"),
    (9, sentence(6, 10) + PASSAGE + PASSAGE, "de", "b"), (10, "x" * 900, "de", ""),
    (11, "one two three", "en", "a"), (12, "One  two three", "en", "a"), (13, " a" * 50, "en", "a"),
    (14, "<|endoftext|> é 　 x  y \n", "fr", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), "n", 1, 0, 2) for r in ROWS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_packing(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack(docs).toPandas()
    want = []
    for doc_id, text, *_ in ROWS:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [2]
        at = packing.cut(len(ids), 1024)
        for k, (a, b) in enumerate(zip(at, at[1:])):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    have = [(None if np.isnan(r[0]) else int(r[0]), *map(int, r[1:5])) for r in got.itertuples(index=False)]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    got = got.sort_values(["sequence_id", "offset"])
    ends = (got.offset + got.length).groupby(got.sequence_id)
    assert ends.max().max() <= 1024
    assert (got.offset.values == ends.shift(1).fillna(0).values).all()
    assert packing.pack(none).count() == 0


def test_packing_plan_places_every_piece_once():
    rng = np.random.default_rng(3)
    sizes, counts = np.unique(rng.integers(1, 1025, 4000), return_counts=True)
    plan = packing.Plan(dict(zip(sizes.tolist(), counts.tolist())), 1024, 64, 1 / 16)
    filled = {}
    for s, lo, hi, sequence, offset in plan.ranges:
        for k in range(hi - lo):
            filled.setdefault(sequence + k, []).append((offset, s))
    assert sum(map(len, filled.values())) == counts.sum()
    for parts in filled.values():
        at = 0
        for offset, s in sorted(parts):
            assert offset == at
            at += s
        assert at <= 1024
    assert len(filled) <= 1.06 * (sizes * counts).sum() / 1024


def test_suffix_dedup(docs, none):
    data = [(i, (t or "").encode()) for i, t, *_ in ROWS]
    seen = {}
    for _, b in data:
        for k in range(len(b) - 399):
            seen[b[k : k + 400]] = seen.get(b[k : k + 400], 0) + 1
    want = []
    for i, b in data:
        cut = bytearray(len(b))
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                cut[k : k + 400] = b"\1" * 400
        kept = bytes(x for x, c in zip(b, cut) if not c)
        want.append((i, len(b), sum(cut), len(re.findall(b"\1+", bytes(cut))), hashlib.sha256(kept).hexdigest()))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows_of(suffixes.removed_repeats(docs), *columns) == sorted(want, key=repr)
    cut = suffixes.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    assert suffixes.removed_repeats(none).count() == 0


def test_merge_of_front_coded_runs():
    rng = random.Random(5)
    runs, everything = [], []
    for _ in range(7):
        own = sorted({bytes(rng.choices(b"ab\0", k=rng.randint(0, 9))) for _ in range(rng.randint(0, 60))})
        overlap = suffixes.shared_prefixes(own, 16)
        tails = b"".join(s[n:] for s, n in zip(own, overlap.tolist()))
        sizes = np.array([len(s) for s in own], np.uint16)
        pack = suffixes._zip
        runs.append(suffixes.Run(0, pack(overlap.tobytes()), pack(sizes.tobytes()), pack(bytes(len(own))), pack(tails)))
        everything += own
    out, last = [], b""
    for r, n in suffixes.merged(runs):
        assert n == (suffixes.shared(last, runs[r].value) if out else 0)
        last = runs[r].value
        out.append(last)
    assert out == sorted(everything)


def test_mixing(docs, none):
    got = mixing.taken_words(mixing.mix(docs)).toPandas()
    assert len(got) == len(ROWS)
    assert (got["size"].sum(), got.taken.le(2 * got["size"]).all()) == (
        sum(len(re.findall(WORDS, t or "")) for _, t, *_ in ROWS), True)
    by = got.groupby(got.source.fillna("-"))
    assert (by.taken.sum() - by.target.first()).abs().max() < 1
    again = mixing.taken_words(mixing.mix(docs.repartition(5))).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(repr, again[key].values.tolist())) == sorted(map(repr, got[key].values.tolist()))
    assert mixing.repeat_documents(docs).columns == docs.columns
    assert mixing.taken_words(mixing.mix(none)).count() == 0
    targets = {t.source: t.target for t in mixing.source_targets([("b", 10), (None, 10), ("a", 1000), ("c", 0)])}
    assert targets[None] == 20 and targets["b"] == 20 and targets["c"] == 0
    assert sum(targets.values()) == pytest.approx(1530)


def test_jaccard(docs, none):
    sets = []
    for i, t, *_ in ROWS:
        w = re.findall(WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    name = list(range(len(ROWS)))
    for _ in name:
        for a in range(len(ROWS)):
            for b in range(len(ROWS)):
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    name[a] = name[b] = min(name[a], name[b])
    want = []
    for k, (i, *_) in enumerate(ROWS):
        ids = [ROWS[j][0] for j in range(len(ROWS)) if name[j] == name[k] and ROWS[j][0] is not None]
        want.append((i, len(sets[k]), (min(ids) if ids else None) if sets[k] else i))
    got = jaccard.near_duplicates(docs)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 2, 3, 4, 5, 8, 9, 10, 11, 13, 14, None], key=repr)
    assert jaccard.near_duplicates(none).count() == 0


def test_quality(docs, none):
    def base(t):
        w, at, covered = re.findall(WORDS, t or ""), {}, set()
        for i in range(len(w) - 7):
            at.setdefault(tuple(w[i : i + 8]), []).append(i)
        for places in at.values():
            if len(places) > 1:
                covered.update(x for i in places for x in range(i, i + 8))
        lines = [x for x in (t or "").split("\n") if re.search(WORDS, x)]
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))

    got = quality.verdicts(docs)
    assert rows_of(got, "doc_id", *quality.MEASURES) == sorted(((i, *base(t)) for i, t, *_ in ROWS), key=repr)
    assert {r.doc_id for r in got.filter("not _base_failed and not _kept").collect()} == set()
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.verdicts(none).count() == 0


def test_quality_rejects_outliers_only(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 1")
    judged = quality.verdicts(table)
    assert judged.join(good, "doc_id").filter("not _base_failed and not _kept").count() == 0
    junk = table.filter("text like '%&&&%'").select("doc_id")
    assert judged.join(junk, "doc_id").filter("_kept").count() == 0


def test_language(spark, docs, none):
    lattice = language.Lattice(["a", "b", "ab", "aba"])
    ends = lattice.of("aba")
    a, b, ab, aba = 0.4, 0.3, 0.2, 0.1
    assert language.forward(ends, [a, b, ab, aba])[-1] == pytest.approx(a * b * a + ab * a + aba)
    used = dict.fromkeys(range(4), 0.0)
    for piece, n in language.expected(ends, [a, b, ab, aba]):
        used[piece] += n
    total = a * b * a + ab * a + aba
    assert used[0] == pytest.approx((2 * a * b * a + ab * a) / total) and used[3] == pytest.approx(aba / total)
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert got[1].lang_pred == got[3].lang_pred == "und" and got[1].score == 0
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == r.held_out for i, r in got.items() if i is not None)
    assert all(0 <= r.score <= 1 for r in got.values())
    signs = [(1, "\u00bd \u00b2 12 !", "fr"), (2, "\u00bd x", "fr")]
    got = {r.doc_id: r.lang_pred for r in language.identify(spark.createDataFrame(signs, "doc_id bigint, text string, lang string")).collect()}
    assert got == {1: "und", 2: "fr"}
    assert language.identify(none).count() == 0


def test_language_on_held_out_documents(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = language.identify(table).join(table.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.95


def test_chat(spark):
    rows = [
        (1, 1, None, "user", "q \\ <s>", 0.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", "</s>good\n", 0.5),
        (1, 4, 3, "user", None, 0.0), (1, 5, 2, "user", "x", None), (1, 6, 99, "user", "lost", 9.0), (2, 1, None, None, "", 0.0),
    ]
    messages = spark.createDataFrame(rows, "tree bigint, node bigint, parent bigint, role string, text string, score double")
    got = {r.tree: r for r in chat.format_paths(chat.best_paths(messages)).collect()}
    assert chat.parse(got[1].formatted) == [("user", "q \\ <s>"), ("assistant", "</s>good\n"), ("user", "")]
    assert chat.unescape(got[1].formatted[got[1].loss[0].start : got[1].loss[0].end]) == "</s>good\n"
    assert chat.parse(got[2].formatted) == [("", "")] and got[2].loss == []
    assert chat.format_paths(chat.best_paths(messages.limit(0))).count() == 0
    # A repeated row, rows without tree or node, a cycle, a chain deeper than many doublings.
    odd = [(3, 1, None, "user", "once", 0.0)] * 2 + [(3, None, 1, "user", "x", 9.0), (None, 1, None, "user", "x", 9.0)]
    odd += [(4, 1, 2, "user", "x", 1.0), (4, 2, 1, "user", "y", 1.0)]
    odd += [(5, i, i - 1 or None, "user", str(i), 0.1) for i in range(1, 301)]
    extra = spark.createDataFrame([(*r, 0, 0, 0) for r in odd], messages.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", depth int, above int, steps int")
    got = {r.tree: r for r in chat.format_paths(chat.best_paths(extra)).collect()}
    assert set(got) == {3, 5} and chat.parse(got[3].formatted) == [("user", "once")]
    assert [t for _, t in chat.parse(got[5].formatted)] == [str(i) for i in range(1, 301)]
    rng = random.Random(1)
    bits = ["\\", "<s>", "</s>", "[TEXT]", "[INST]", "[/INST]", "a", "\n"]
    for _ in range(300):
        turns = [tuple("".join(rng.choices(bits, k=rng.randint(0, 6))) for _ in range(2)) for _ in range(3)]
        assert chat.parse(chat.render(turns)[0]) == turns


def test_chat_query(spark):
    rows = QUERIES["op8_chat_formatting"](spark, SF_DIR).toPandas()
    assert difference(rows, connect(SF_DIR).execute(ORACLES["op8_chat_formatting"]).df()) is None


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, 1), (2, "u", "", 1), (3, None, "é" * 9, 1), (7, "a\r\nb", "é" * 9, 1), (5, "u", "long " * 300_000, 1), (None, "u", "q", 1)],
        "page_id bigint, url string, html string, frame int",
    )
    index = warc.write_archives(pages)
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    got = {r.page_id: r for r in warc.read_archives(index).collect()}
    for i, payload in html.items():
        assert got[i].payload_bytes == len(payload)
        assert got[i].payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert {i: r.refers_to for i, r in got.items()} == {1: None, 2: 1, 3: None, 7: 3, 5: None, None: None}
    assert {i for i, r in got.items() if r.record_type == "revisit"} == {2, 7}
    assert all(bytes(r.payload) == html[i] for i, r in got.items() if r.record_type == "response")
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(600, 8)).astype(np.float32)
    vectors[100:300] = vectors[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    rows += [(1000, None, 0), (1050, [0.0] * 8, 0), (1100, [float("nan")] * 8, 0), (1150, [None] * 8, 0), (1200, [1.0], 0), (None, [1.0] * 8, 0)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int").repartition(4)
    got = neighbours.nearest(table).toPandas()
    x = vectors.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 600, 50):
        scores = x @ x[q]
        scores[q] = -9
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == [1, 2, 3, 4, 5]
        assert np.allclose(own.score, scores[own.vec_id], atol=1e-9)
        hits += len(set(np.lexsort([np.arange(600), -np.round(scores, 12)])[:5]) & set(own.vec_id))
    assert hits / 60 >= 0.9 and set(got.query_id) == set(range(0, 600, 50))
    assert got[got.query_id == 150].vec_id.tolist() == [100, 101, 102, 103, 104]
    assert neighbours.nearest(table.limit(0)).count() == 0


def test_cotraining(spark, docs, none):
    folder = SF_DIR.replace("0.001", "0.01")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = cotraining.score(table, labels).join(labels, "doc_id").toPandas()
    assert got[(got.quality == 1) & (got.toxic == 0)].kept.mean() > 0.9
    assert got[got.quality == 0].kept.mean() < 0.1
    assert got[got.toxic == 1].kept.mean() < 0.2
    unlabelled = cotraining.score(docs, labels.limit(0)).collect()
    assert len(unlabelled) == len(ROWS) and all(r.kept and r.score == 0.5 for r in unlabelled)
    assert cotraining.score(none, labels).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert packed.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 0 < packed.select("doc_id").distinct().count() <= table.count()
    assert packed.select("doc_id").join(table, "doc_id", "left_anti").count() == 0
    assert [k for k, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "suffix_dedup", "source_mixing", "best_fit_packing"]


def test_mixing_rows_that_differ_in_source_only(spark):
    """Two sources holding one text under one id are two documents; clashing names survive."""
    rows = [(1, "a b c d", "x", 5, 6, 7, 8, 9, 10), (1, "a b c d", "y", 5, 6, 7, 8, 9, 10),
            (2, "e f g h i j", "x", 5, 6, 7, 8, 9, 10), (3, "k l", "z", 5, 6, 7, 8, 9, 10)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, source string, _k1 bigint, _k2 bigint, _n int, _rows int, _i int, _kept int")
    got = mixing.taken_words(mixing.mix(docs)).collect()
    assert len(got) == 4 and all(r["taken"] <= 2 * r["size"] for r in got)
    per = {}
    for r in got:
        per[r["source"]] = per.get(r["source"], 0) + r["taken"]
    targets = {r["source"]: r["target"] for r in got}
    assert all(abs(per[s] - targets[s]) <= 1 for s in per)
    out = mixing.repeat_documents(docs).collect()
    assert out and all(tuple(r)[3:] == (5, 6, 7, 8, 9, 10) for r in out)
    assert {r["source"] for r in out} <= {"x", "y", "z"}


def test_neighbours_with_repeated_rows(spark):
    """A repeated query asks once, repeated candidates count once: five different neighbours."""
    rng = np.random.default_rng(4)
    vecs = {i: rng.normal(size=6).tolist() for i in range(1, 120)}
    rows = [(i, v) for i, v in vecs.items()] + [(50, vecs[50]), (4, vecs[4]), (4, vecs[4]), (30, vecs[30])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(table).toPandas()
    for q, hits in got.groupby("query_id"):
        assert sorted(hits["rank"]) == [1, 2, 3, 4, 5] and hits["vec_id"].is_unique
        x = np.array(vecs[q])
        want = sorted((i for i in vecs if i != q), key=lambda i: (-np.dot(vecs[i], x) / np.linalg.norm(vecs[i]) / np.linalg.norm(x), i))[:5]
        assert list(hits.sort_values("rank")["vec_id"]) == want


def test_suffix_dedup_reads_copied_slices_once(spark, monkeypatch):
    """Of an anchor in very many slices each different slice is looked at once: the windows
    made grow with the different slices, not with the copies, and the result is the same."""
    draw = random.Random(5)
    own = ["".join(draw.choice("abcdefgh ") for _ in range(900)) for _ in range(4)]
    texts = [own[i % 3] for i in range(60)] + [own[3], own[0][200:700] + own[3][:300], "x" * 1500, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = rows_of(suffixes.removed_repeats(docs), *columns)
    assert sum(r[2] for r in want) > 60 * 800
    looked_at, real = [], suffixes._windows

    def counted(slices, length, back):
        looked_at.append(slices.count())
        return real(slices, length, back)

    monkeypatch.setattr(suffixes, "HOT_SLICES", 3)
    monkeypatch.setattr(suffixes, "_windows", counted)
    assert rows_of(suffixes.removed_repeats(docs), *columns) == want
    assert looked_at and max(looked_at) < 40, looked_at


def test_suffix_dedup_leaves_out_windows_no_other_slice_has(spark, monkeypatch):
    """Of a passage in very many texts that differ left of it, windows that begin in what is a
    text's own are not looked at; the exact ends are the same."""
    draw = random.Random(6)
    words = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage, shared = words(450), words(60)
    texts = [words(700) + (shared if i % 4 == 0 else "") + passage + words(700) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = rows_of(suffixes.removed_repeats(docs), *columns)

    windows, real = [], suffixes._windows

    def counted(slices, length, back):
        windows.append(slices.selectExpr(f"sum(octet_length(bytes) - {length} + 1)").first()[0] or 0)
        return real(slices, length, back)

    monkeypatch.setattr(suffixes, "HOT_SLICES", 3)
    monkeypatch.setattr(suffixes, "_windows", counted)
    assert rows_of(suffixes.removed_repeats(docs), *columns) == want
    plain = {i: len(passage) + (len(shared) if i % 4 == 0 else 0) for i in range(60)}
    assert all(0 <= r[2] - plain[r[0]] < 8 for r in want)
    assert sum(windows) and max(windows) < 60 * 100
