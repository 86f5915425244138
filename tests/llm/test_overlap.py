"""Near duplicates by shingle sets against all pairs."""

import random

import numpy as np

from chronopanel.llm import overlap, simhash


def texts():
    """Originals and copies with 1 to 6 % of their words replaced."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    out = []
    for k in range(40):
        base = [word() for _ in range(rng.randint(250, 400))]
        out.append((10 * k, " ".join(base)))
        for c in range(1, 5):
            copy = list(base)
            for at in rng.sample(range(len(base)), max(1, int(len(base) * rng.uniform(0.005, 0.05)))):
                copy[at] = word()
            out.append((10 * k + c, " ".join(copy)))
    return out + [(900, ""), (901, None), (902, "one two"), (903, "One  two"), (904, "x y z")]


def first_ones(rows):
    """The smallest ids of components over all pairs of fingerprints within six bits or sets at 0.8."""
    prints = [simhash.fingerprint(t, 5) for _, t in rows]
    sets = [set(overlap.shingles(t, 5).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    missed = 0
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            alike = both > 0 and both >= 0.8 * len(sets[i] | sets[j])
            near = (prints[i] ^ prints[j]).bit_count() <= 6
            missed += alike and not near
            if alike or near:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted(rows[i][0] for i in range(len(rows)) if find(i) == i), missed


def test_stage_against_all_pairs(spark):
    rows = texts()
    want, missed = first_ones(rows)
    assert missed > 20  # what fingerprints alone do not link
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r["doc_id"] for r in simhash.keep_first(df).collect()) == want


def test_blocks_lose_no_link(spark):
    """One cluster in many blocks gives the same components as one block."""
    rows = [(i, t) for i, t in texts() if i < 20]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for block in (2, 1024):
        _, e = overlap.links(df, "doc_id", "text", 5, block=block)
        root = {}

        def find(x, root=root):
            while root.get(x, x) != x:
                x = root[x]
            return x

        for r in e.collect():
            a, b = find(r["a"]), find(r["b"])
            if a != b:
                root[max(a, b)] = min(a, b)
        got.append({x: find(x) for r in e.collect() for x in (r["a"], r["b"])})
    assert got[0] == got[1] and got[0]


def test_pairs_are_exact():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 30, 60).astype(np.uint64)) for _ in range(60)]
    i, j = overlap.pairs(sets, 0.8)
    want = {(a, b) for a in range(60) for b in range(a) if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and want
