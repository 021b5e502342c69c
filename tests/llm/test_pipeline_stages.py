"""The pipeline against brute force: every stage on what the stages before it kept."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from affinitext.llm import quality
from affinitext.llm.common import stored

WORDS = r"[^\x20\x09-\x0D]+"


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghiké", k=rng.randint(2, 8))) for _ in range(n))


def documents():
    """Prose of four sources with shared passages, copies, near copies, junk and odd rows."""
    passages = [sentence(s, 110) for s in (1, 2)]
    rows = []
    for i in range(48):
        text = sentence(100 + i, 60 + 29 * i % 400)
        if i % 4 == 1:
            text += " " + passages[i % 8 > 3] + " " + sentence(500 + i, 50)
        rows.append((i, text, "abc"[i % 3] if i % 7 else None))
    rows += [(50 + i, rows[4 * i][1], "a") for i in range(3)]
    rows += [(60 + i, rows[4 * i][1] + " and one end", "b") for i in range(3)]
    rows += [(70, " ".join(f"%&&&%{i}<|>$$" for i in range(60)), "c"), (71, "too short", "a"), (72, None, None),
             (73, "", "b"), (74, "the same eight words over and over again " * 9, "a"), (75, sentence(9, 2500), "b")]
    return [*rows, rows[3]]


def words(text):
    return re.findall(WORDS, text or "")


def repeated_words(own):
    places = {}
    for i in range(len(own) - 7):
        places.setdefault(tuple(own[i : i + 8]), []).append(i)
    return len({x for at in places.values() if len(at) > 1 for i in at for x in range(i, i + 8)})


def quality_kept(texts):
    """Base rules, then four concentration steps over one group of all that pass them."""
    stats, passed = [], []
    for k, text in enumerate(texts):
        own = words(text)
        again, chars = repeated_words(own), sum(map(len, own))
        if len(own) < 20 or 100 * again > 30 * len(own):
            continue
        lines = [x for x in text.split("\n") if words(x)]
        passed.append(k)
        stats.append([math.log1p(len(own)), math.log(chars / len(own)),
                      math.log1p(sum(c in "#*$%&|<>" for c in text) * 1000 / chars),
                      math.log1p(len(lines) - len(set(lines))), math.log1p(again * 100 / len(own))])
    x = np.array(stats)
    least = np.diag(np.array(list(quality.STATS.values())) ** 2)

    def at(values, share):
        return np.sort(values, axis=0)[math.ceil(share * len(values)) - 1]

    def distance(centre, spread):
        return np.einsum("ij,ij->i", x - centre, np.linalg.solve(spread, (x - centre).T).T)

    centre, spread = at(x, 0.5), np.diag(((at(x, 0.75) - at(x, 0.25)) / 1.349) ** 2) + least
    for _ in range(4):
        d2 = distance(centre, spread)
        inner = x[d2 <= at(d2, 0.75) * (1 + 1e-12)]
        centre, spread = inner.mean(axis=0), np.cov(inner.T, bias=True) * 1.78 + least
    return {k for k, d in zip(passed, distance(centre, spread)) if d <= 30.86}


def check_quality(before, after):
    kept = quality_kept([r.text for r in before])
    assert Counter(after) == Counter(r for k, r in enumerate(before) if k in kept)
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone == {70, 71, 72, 73, 74}


def check_near_duplicates(before, after):
    sets = []
    for r in before:
        w = re.findall(WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    group = list(range(len(before)))
    for _ in before:
        for a in group[:]:
            for b in range(len(before)):
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    assert len(after) == len(set(group)) < len(before)
    texts = {r.text: group[i] for i, r in enumerate(before)}
    assert Counter(texts[r.text] for r in after) == Counter(set(group))


def check_suffix(before, after):
    from corpus_pipeline import PASSAGE_BYTES as n

    seen = Counter()
    data = [(r.text or "").encode() for r in before]
    for b in data:
        seen.update(b[k : k + n] for k in range(len(b) - n + 1))
    want = Counter()
    for r, b in zip(before, data):
        cut = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if seen[b[k : k + n]] > 1:
                cut[k : k + n] = b"\1" * n
        kept = bytes(x for x, c in zip(b, cut) if not c).decode(errors="ignore")
        want[r.doc_id, kept if r.text is not None or any(cut) else r.text] += 1
    assert Counter((r.doc_id, r.text) for r in after) == want
    assert any(len(r.text) < len(x.text) for r in after for x in before if r.doc_id == x.doc_id)


def check_mixing(before, after):
    size = Counter()
    for r in before:
        size[r.source] += len(words(r.text))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, rest, open_ = {}, 1.5 * size.total(), set(order)
    while open_:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        target |= {s: 2 * size[s] for s in full} if full else share
        rest -= sum(2 * size[s] for s in full)
        open_ = open_ - full if full else set()
    copies = Counter(after)
    assert set(copies) <= set(before)
    for s in order:
        own = [r for r in before if r.source == s]
        passes, left = divmod(int(target[s]), size[s])
        more = [r for r in own if copies[r] > passes]
        assert all(copies[r] in (passes, passes + 1) for r in own)
        read = sum(len(words(r.text)) for r in more)
        assert left <= read < left + max(len(words(r.text)) for r in own)


def check_packing(before, after):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for r in before:
        ids = coder.encode(r.text or "", add_special_tokens=False).ids + [2]
        at = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        want.update((r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                    for k, (a, b) in enumerate(zip(at, at[1:])))
    assert Counter(tuple(r[:5]) for r in after) == want
    filled = {}
    for r in sorted(after, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 1024
    free = []  # best fit of the pieces in falling order of length
    for n in sorted((r.length for r in after), reverse=True):
        at = min((k for k, f in enumerate(free) if f >= n), key=free.__getitem__, default=None)
        if at is None:
            free.append(1024 - n)
        else:
            free[at] -= n
    assert len(filled) <= len(free) + 1


CHECKS = {
    "quality_rules": check_quality, "near_duplicates": check_near_duplicates, "suffix_dedup": check_suffix,
    "source_mixing": check_mixing, "best_fit_packing": check_packing,
}


def test_stages_against_brute_force(spark):
    import corpus_pipeline

    rows = [(i, text, "en", source, len(text or "")) for i, text, source in documents()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    columns, current = docs.columns, stored(docs.repartition(3))
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, current, ""))
        assert name == "best_fit_packing" or after.columns == columns
        CHECKS[name](current.collect(), after.collect())
        current = after


def test_stages_on_an_empty_table(spark):
    import corpus_pipeline

    current = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        current = stored(stage(spark, current, ""))
        assert current.count() == 0


def test_suffix_stage_cuts_passages_of_51_short_words(spark):
    """A passage of 51 words in under 400 bytes, shared by two texts, goes from both."""
    import corpus_pipeline

    passage = " ".join(f"w{i % 7}x" for i in range(51))
    assert len(passage.encode()) < 400
    rows = [(1, sentence(31, 40) + " " + passage + " " + sentence(32, 30), "a"),
            (2, sentence(33, 25) + " " + passage, "b"), (3, sentence(34, 60), "a"), (4, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    after = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, docs, "").collect()}
    assert passage not in after[1] and passage not in after[2]
    assert after[3] == rows[2][1] and after[4] is None
    check_suffix(docs.collect(), corpus_pipeline.suffix_dedup(spark, docs, "").collect())
