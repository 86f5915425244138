"""The corpus pipeline on a small table against a brute-force version of its stages."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from chronopanel.llm import language, mixing, overlap, simhash
from chronopanel.llm.common import written


@pytest.fixture(scope="module")
def stages(spark, sf):
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for name, f in P.STAGES:
        out.append(written(f(spark, out[-1], sf), f"test-{name}"))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_language_keeps_clean_documents(stages):
    gone = ids(stages[0]) - ids(stages[1])
    assert len(gone) <= 0.02 * stages[0].count()
    assert ids(stages[1]) <= ids(stages[0]) and stages[1].where("lang IS NULL").count() == 0


def test_language_stage_by_brute_force(spark, sf, stages):
    """Each text by itself, by the network that the stage trains: which are kept, and the language of those without one."""
    net = language.fit(stages[0])
    rows = {r["doc_id"]: r for r in stages[1].collect()}
    for r in stages[0].collect():
        good = bool(r["text"]) and language._LETTER.search(r["text"]) is not None
        q = net.documents([r["text"].encode()])[0] if good else np.zeros(1)
        if abs(q.max() - P.LEAST_CERTAIN) > 1e-4:
            assert (r["doc_id"] in rows) == (good and q.max() >= P.LEAST_CERTAIN)
        if r["doc_id"] in rows:
            assert rows[r["doc_id"]]["lang"] == (r["lang"] or net.langs[int(q.argmax())])


def test_exact_stage(stages):
    rows = stages[1].collect()
    first = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r["doc_id"])
    assert ids(stages[2]) == set(first.values()) and stages[2].count() == len(first)


def test_near_stage(stages):
    """All pairs: fingerprints within six bits, or shingle sets at a Jaccard similarity of 0.8."""
    rows = sorted((r["doc_id"], simhash.fingerprint(r["text"], 5), set(overlap.shingles(r["text"], 5).tolist())) for r in stages[2].collect())
    root = {i: i for i, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a, s) in enumerate(rows):
        for j, b, t in rows[:k]:
            both = len(s & t)
            if (a ^ b).bit_count() <= simhash.STAGE["most"] or (both and both >= 0.8 * (len(s) + len(t) - both)):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert ids(stages[3]) == {i for i in root if find(i) == i}


def slow_mix(rows):
    """Copies of each (doc_id, text, source), as the contract of the mix says it."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = Counter()
    for _, t, s in rows:
        total[s] += size(t)
    goal = mixing.targets(list(total.items()))
    out = Counter()
    for s in total:
        rate = goal[s] / total[s] if total[s] else 0
        whole, before = math.floor(rate + 1e-9), 0
        missing = max(0.0, goal[s] - whole * total[s])
        for key, n, row in sorted((hashlib.md5(str(i).encode()).hexdigest() if i is not None else "", size(t), (str(i), t or "")) for i, t, x in rows if x == s):
            out[key, n, row] += whole + (before + n / 2 < missing)
            before += n
    return out


def test_mixing_stage(stages):
    copies = Counter(r["doc_id"] for r in stages[4].select("doc_id").collect())
    assert set(copies) <= ids(stages[3]) and max(copies.values()) <= 3
    want = slow_mix([tuple(r) for r in stages[3].select("doc_id", "text", "source").collect()])
    assert Counter({str(i): n for i, n in copies.items()}) == Counter({row[0]: n for (_, _, row), n in want.items() if n})


def test_packing_stage(stages):
    pieces = stages[5].collect()
    assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(r["doc_id"] for r in stages[4].select("doc_id").collect())
    full = Counter()
    for r in pieces:
        full[r["sequence_id"]] += r["length"]
    assert max(full.values()) <= 1024 and len(full) <= 1.05 * -(-sum(full.values()) // 1024) + 1


def test_run_is_the_stages(spark, sf, stages):
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, P.run(spark, sf).select(cols).collect())) == sorted(map(tuple, stages[5].select(cols).collect()))


ODD = "doc_id long, text string, lang string, source string, n_chars long, __row int, copies int, size string"


def test_odd_rows_pass(spark, sf, tmp_path):
    """Null and repeated ids, repeated rows, null sources, a very long text and extra columns with clashing names, stage by stage."""
    base = "the quick brown fox jumps over the lazy dog near the river bank while seven old sailors sing about their voyage home"
    long = " ".join(f"word{k} and" for k in range(60_000))
    rows = [(None, base + " one", "en", "a", 1, 0, 0, "x"), (None, base.upper() + " two three four", "en", None, 1, 0, 0, "x"), (5, "x " + base[::-1], "en", "a", 1, 0, 0, "x")]
    rows += [(5, "x " + base[::-1], "en", "a", 1, 0, 0, "x")] * 2 + [(5, "quite another text under the same id with several words", "en", "b", 1, 0, 0, "x"), (6, long, "en", "b", 1, 0, 0, "x")]
    rows += [(7, None, None, "a", 0, 0, 0, "x"), (8, "", "en", "b", 0, 0, 0, "x"), (9, "42", "en", "b", 0, 0, 0, "x")]
    df = spark.createDataFrame(rows, ODD)
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    deduped = written(P.exact(spark, docs, sf).select(*P.COLUMNS), "odd")
    assert Counter(r["doc_id"] for r in deduped.collect()) == Counter([None, None, 5, 5, 6, 7, 9])  # 7 and 8 are both empty
    near = written(P.near(spark, docs, sf), "odd")
    assert Counter(r["doc_id"] for r in near.collect()) == Counter(r[0] for r in rows if r[0] != 8)  # no words, as 7
    mixed = P.mix(spark, docs, sf)
    assert mixed.columns == P.COLUMNS
    want = Counter()
    for (_, _, row), n in slow_mix([(r[0], r[1], r[3]) for r in rows]).items():
        want[row] += n
    got = Counter((str(r["doc_id"]), r["text"] or "") for r in mixed.collect())
    assert got == Counter({k: n for k, n in want.items() if n})
    packed = P.pack(spark, docs, sf).collect()
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0) == Counter(r[0] for r in rows)
    assert P.language_id(spark, docs, sf).count() == 0  # one language only: none is learned


def test_an_empty_table_passes(spark, sf, tmp_path):
    df = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for k, (_, f) in enumerate(P.STAGES):
        df.write.parquet(str(tmp_path / str(k)))
        df = f(spark, spark.read.schema(df.schema).parquet(str(tmp_path / str(k))), sf)
    assert df.count() == 0
