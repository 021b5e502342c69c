"""Links between sets that share little more than they must, against brute force."""

import random

import pytest

from affinitext.llm import jaccard
from affinitext.llm.components import components


def families(rng):
    """Pairs near the threshold, and thirds without tokens of their own that hold all they share."""
    made, fresh, pool = [], iter(range(1000, 10**7)), range(400)
    for _ in range(60):
        shared = [next(fresh) for _ in range(rng.randint(3, 60))]
        spare = len(shared) // 6
        made += [shared + [next(fresh) for _ in range(rng.randint(0, spare + 1))] for _ in range(2)]
        made.append(shared + rng.sample(pool, 2 * len(shared)))
    return made


def windows(rng):
    """Chains of overlapping windows: each is similar to its neighbours at most."""
    made = []
    for k in range(12):
        size = rng.randint(4, 60)
        step = max(1, size // 7)
        long = [10**6 * (k + 1) + x for x in range(size + 12 * step)]
        made += [long[at : at + size] for at in range(0, 12 * step, step)]
    return made


def small(rng):
    return [rng.sample(range(k * 7, k * 7 + 7), rng.randint(3, 6)) for k in range(25) for _ in range(3)]


def names(n, pairs):
    name = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if name[a] != name[b]:
                name[a] = name[b] = min(name[a], name[b])
                changed = True
    return name


@pytest.mark.parametrize("kind", [families, windows, small])
def test_links_join_every_similar_pair(spark, kind):
    rng = random.Random(11)
    code = {}
    made = sorted({tuple(sorted(code.setdefault(x, rng.getrandbits(62)) for x in s)) for s in kind(rng)})
    sets = [set(s) for s in made]
    similar = [
        (a, b) for a in range(len(sets)) for b in range(a)
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    table = spark.createDataFrame(list(enumerate(map(list, made))), "node bigint, tokens array<bigint>")
    found = jaccard.links(table.repartition(4), 75)
    root = {r.node: r.root for r in components(found).collect()}
    got = [root.get(k, k) for k in range(len(made))]
    assert got == names(len(made), similar)
