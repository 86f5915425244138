"""Each operator on small hand-made tables: null and empty texts, very long texts, ties, repeated rows, empty tables, clashing columns;
against brute force, an exact round trip, or held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from chronopanel.llm import components, exact_dedup, fingerprints, induced, language, licenses, mixing, packing, quality, scoring, simhash, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, target string, __id int, kept int"
LOW = {c: c + 32 for c in range(65, 91)}


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


def corpus():
    """(doc_id, text): nulls, empties, copies, near copies, a long text, repeated rows, odd white space."""
    rng = random.Random(4)
    base = [words(rng, rng.randint(1, 120)) for _ in range(40)]
    out = [(k, t) for k, t in enumerate(base)]
    out += [(100, None), (101, ""), (102, " \t\n"), (103, base[0]), (104, base[0].replace(" ", "  ")), (105, base[1] + " x"), (106, base[0]), (106, base[0])]
    out += [(107, words(rng, 6000)), (108, "a" * 3000), (109, base[2].upper()), (110, base[2][:-3]), (111, "Zeile mit\x85Rest \x00 Ende"), (None, base[3])]
    return out


def frame(spark, rows, **more):
    full = [(i, t, more.get("lang"), more.get("source", f"s{(i or 0) % 3}"), None, "x", "y", 1, 2) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus())


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [(1, "x")]).limit(0)


# 1 near duplicates


def slow_print(text):
    w = WORD.findall((text or "").translate(LOW))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(prints):
    """(id, fp) to smallest id reachable, over all pairs."""
    n, root = len(prints), list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
                root[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(prints):
        low.setdefault(find(k), []).append(i)
    return sorted((i, min((x for x in low[find(k)] if x is not None), default=None)) for k, (i, _) in enumerate(prints) if i is not None)


@pytest.mark.parametrize("block", [3, 2048])
def test_simhash_against_all_pairs(spark, docs, block):
    got = simhash.near_groups(docs, block=block).collect()
    prints = [(i, slow_print(t)) for i, t in corpus()]
    assert sorted((r["id"], r["fp"] % 2**64) for r in got if r["id"] is not None) == sorted(p for p in prints if p[0] is not None)
    assert sorted((r["id"], r["component_id"]) for r in got if r["id"] is not None) == slow_groups(prints)


def test_simhash_links_by_a_chain(spark):
    """Fingerprints a few bits apart: a large dense group in small blocks, as all pairs say."""
    rng = np.random.default_rng(0)
    base = int(rng.integers(0, 2**63))
    fps = {base}
    while len(fps) < 150:
        x = rng.choice(sorted(fps))
        fps.add(int(x) ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(1, 6))))
    rows = [(simhash._signed(f % 2**64), k) for k, f in enumerate(sorted(fps))]
    got = {r["node"]: r["root"] for r in simhash.link_groups(spark.createDataFrame(rows, "fp long, rep long"), block=16).collect()}
    want = dict(slow_groups([(k, f % 2**64) for f, k in rows]))
    assert {k: got.get(k, k) for k in want} == want


def test_simhash_keeps_one_and_clean_ones(spark, docs, none):
    kept = sorted(r["doc_id"] for r in simhash.keep_first(docs).collect() if r["doc_id"] is not None)
    assert 0 in kept and not {103, 104} & set(kept) and set(range(2, 40)) <= set(kept) | {100}
    assert simhash.near_groups(none).count() == 0 and simhash.keep_first(none).columns == none.columns


def test_pivots_lose_no_pair():
    p, masks = simhash.pivots()
    a = np.random.default_rng(1).integers(0, 2**64, 300, dtype=np.uint64)
    c = simhash.coordinates(a, p, masks).astype(int)
    d = np.bitwise_count(a[:, None] ^ a[None, :])
    total = c.sum(axis=1)
    assert (np.abs(total[:, None] - total[None, :]).max(axis=2) <= d).all()
    for s, m in enumerate(masks):
        same = (c[:, None, s] == c[None, :, s]).all(axis=2)
        assert (same == ((a[:, None] ^ a[None, :]) & m == 0)).all()


def test_components(spark):
    rng = random.Random(2)
    e = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(500, k) for k in range(501, 540)]
    root = {x: x for p in e for x in p}
    for _ in range(60):
        for a, b in e:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert {k: got.get(k, k) for k in root} == root


# 2 substring dedup


def slow_substrings(rows, window):
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        cov, end = bytearray(len(b)), 0
        for p in range(len(b) - window + 1):
            s = b[p : p + window]
            if s in seen:
                for q in range(max(p, end), p + window):
                    cov[q] = 1
                end = p + window
            seen.add(s)
        kept = bytes(x for x, c in zip(b, cov) if not c)
        spans = sum(1 for k in range(len(cov)) if cov[k] and (k == 0 or not cov[k - 1]))
        out.append((i, len(b), sum(cov), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def passages():
    rng = random.Random(8)
    shared = words(rng, 90)
    rows = [(i, t) for i, t in corpus() if i is not None and i != 106]
    return rows + [(200 + k, words(rng, 30) + shared[k : 300 + 3 * k] + words(rng, 30)) for k in range(8)] + [(300, shared * 3), (301, "ab" * 400)]


@pytest.mark.parametrize("chunk,memory,hot,group,shard", [(1 << 18, 1 << 20, 20_000, 6 << 20, 1 << 25), (256, 50, 20_000, 900, 2_000), (256, 50, 1, 900, 10_000), (1 << 18, 50, 1, 6 << 20, 1 << 25)])
def test_substrings_against_brute_force(spark, monkeypatch, chunk, memory, hot, group, shard):
    """Small chunks, queues, groups and shards; anchors whose windows are dealt one by one."""
    monkeypatch.setattr(substrings, "_CHUNK", chunk)
    monkeypatch.setattr(substrings, "GROUP_BYTES", group)
    rows = sorted(passages())
    got = substrings.dedup(frame(spark, rows), memory=memory, hot=hot, shard_bytes=shard).collect()
    assert sorted(tuple(r) for r in got) == slow_substrings(rows, 100)


@pytest.mark.parametrize("partitions", [1, 2, 4])
def test_substrings_edges(spark, none, partitions):
    assert substrings.dedup(none).count() == 0
    rows = [(5, "q" * 150), (5, "q" * 150), (5, "x"), (None, "z" * 120), (7, "q" * 99), (8, None), (8, None)]
    twice = substrings.dedup(frame(spark, rows).repartition(partitions)).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in twice) == [(0, 0), (0, 0), (1, 0), (99, 0), (120, 19 + 100), (150, 149), (150, 150)]
    kept = substrings.dedup(frame(spark, passages()), texts=True)
    assert kept.where("length(kept) + 0 > n_bytes").count() == 0


@pytest.mark.parametrize("files", [1, 2, 4])
def test_registered_substrings_keep_repeated_rows(spark, tmp_path, files):
    """Equal rows in several files, and a whole corpus, by the registered query."""
    rows = sorted(passages())
    spark.createDataFrame([(5, "q" * 150)] * 4, "doc_id long, text string").repartition(files).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    got = substrings.op2_suffix_dedup(spark, str(tmp_path / "a")).collect()
    assert sorted(r["n_removed"] for r in got) == [149, 150, 150, 150]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(files).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert sorted(tuple(r) for r in substrings.op2_suffix_dedup(spark, str(tmp_path / "b")).collect()) == slow_substrings(rows, 100)


@pytest.mark.parametrize("memory", [3, 10**6])
def test_induced_order_and_prefixes(memory):
    rng = random.Random(memory)
    for _ in range(150):
        s = bytes(rng.randint(1, rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(1, 70))) * rng.randint(1, 3)
        cap = rng.choice([4, 10, 100])
        order, lcp = induced.suffixes(np.frombuffer(s, np.uint8), cap, memory)
        got = [(p, n) for p, n in zip(order.tolist(), lcp.tolist()) if p < len(s)]
        keys = [s[p : p + cap] for p, _ in got]
        assert keys == sorted(keys) and sorted(p for p, _ in got) == list(range(len(s)))
        for (a, _), (b, n) in zip(got, got[1:]):
            x, y = s[a : a + cap], s[b : b + cap]
            assert n == next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))


# 3 packing


def test_packing_is_gapless_and_tight(spark, docs):
    path = packing.default_vocabulary()
    got = [tuple(r) for r in packing.pack(docs, path, capacity=64).collect()]
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(path)
    tk.encode_special_tokens = True
    want = []
    for i, t in corpus():
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(first, len(ids) + 1, 64)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((g[:5] for g in got), key=key) == sorted(want, key=key)
    bins = {}
    for g in got:
        bins.setdefault(g[5], []).append((g[6], g[3]))
    for content in bins.values():
        at = 0
        for off, n in sorted(content):
            assert off == at
            at += n
        assert at <= 64
    assert len(bins) <= 1.05 * -(-sum(g[3] for g in got) // 64) + 1


def test_ids_are_those_of_tokenizers():
    """The ids of the vocabulary file by its own library, on odd texts."""
    from tokenizers import Tokenizer

    path = packing.default_vocabulary()
    tk = Tokenizer.from_file(path)
    tk.encode_special_tokens = True
    rng = random.Random(1)
    bits = ["a", "B", "word", " ", "  ", "\n", "\t", "'s", "'ll", "'S", "é", "ß", "1", "½", "²", ".", "!?", "中文", " ", "\u3000", "\x85", "\xa0", "'", "<|endoftext|>", "😀", "e\u0301", "\x00"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["x" * 50_000, " " * 20_000, "ab " * 20_000]
    for t, got in zip(texts, packing.token_bytes(texts, path), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tk.encode(t, add_special_tokens=False).ids


def test_two_small_documents_replace_one():
    # greedily 6+3 leaves a gap of 1; the smallest (3) gives way to 2+2
    assert packing.plan({6: 1, 3: 1, 2: 2}, 10)[0] == ([6, 2, 2], 1)
    for seed in range(30):
        rng = random.Random(seed)
        counts = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(rng.randint(1, 40))}
        plan, used = packing.plan(counts, 100), Counter()
        for content, times in plan:
            assert sum(content) <= 100
            used.update({n: c * times for n, c in Counter(content).items()})
        assert used == Counter(counts)


def test_packing_of_nothing(none):
    assert packing.pack(none, packing.default_vocabulary()).count() == 0


# 4 exact dedup


@pytest.mark.parametrize("keys", [0, 10**6])
def test_exact_groups(spark, docs, none, monkeypatch, keys):
    monkeypatch.setattr(exact_dedup, "BROADCAST_KEYS", keys)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    by = {}
    for i, t in corpus():
        by.setdefault(norm(t), []).append(i)
    got = exact_dedup.exact_groups(docs, exact_dedup.normalised())
    want = []
    for i, t in corpus():
        ids = by[norm(t)]
        low = min((x for x in ids if x is not None), default=None)
        want.append((i, low if len(ids) > 1 else i, len(ids), i == (low if len(ids) > 1 else i)))
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert exact_dedup.exact_groups(none, exact_dedup.normalised()).count() == 0
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(by)
    low = lambda t: min((x for x in by[t] if x is not None), default=None)
    assert sorted(((r["doc_id"], norm(r["text"])) for r in kept.collect()), key=key) == sorted(((low(t), t) for t in by), key=key)
    clash = docs.withColumn("__row", docs.doc_id).withColumn("__len", docs.doc_id).withColumn("__full", docs.text).withColumn("__keep", docs.text)
    assert exact_dedup.keep_first(clash).count() == len(by)


def test_exact_groups_by_sql(spark, tmp_path):
    import duckdb

    path = str(tmp_path / "documents.parquet")
    frame(spark, [r for r in corpus() if r[0] is not None]).select("doc_id", "text").coalesce(1).write.parquet(path)
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = [tuple(r) for r in exact_dedup.op4_exact_dedup(spark, str(tmp_path)).select(cols).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(got) == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({exact_dedup.SQL['op4_exact_dedup']})").fetchall())


# 5 phrase fingerprints


def slow_phrases(t):
    seen, out, w = set(), [], ""
    for c in t:
        w += c
        if w not in seen:
            seen.add(w)
            out.append(w)
            w = ""
    return out + [w] * bool(w)


def test_phrases_and_edits():
    rng = random.Random(1)
    for _ in range(500):
        t = "".join(rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 60)))
        assert fingerprints.phrases(t) == slow_phrases(t)
        new = fingerprints.edit(t, "".join(rng.choice("abc") for _ in range(40)))
        assert (fingerprints._Parsed(t).edited(new, len(t) - len(t) // 2) == fingerprints.fingerprint(new)).all()


def test_compared_texts(spark, docs, none):
    got = sorted(((-(2**63) if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"]) for r in fingerprints.compared(docs).collect()))
    rows = sorted(((-(2**63) if i is None else i, t or "") for i, t in corpus()))
    want = []
    for k, (i, t) in enumerate(rows):
        new = fingerprints.edit(t, rows[(k + 1) % len(rows)][1])
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), fingerprints.fingerprint(t).tobytes().hex()))
    assert got == sorted(want)
    likes = {}
    for r in fingerprints.compared(docs).collect():
        likes.setdefault((-(2**63) if r["doc_id"] is None else r["doc_id"], r["fingerprint"], r["edited_fingerprint"]), []).append((r["near_edited"], r["near_next"]))

    def alike(a, b):
        pairs = [(x, y) for x, y in zip(a, b) if x or y]
        same = sum(x == y for x, y in pairs) / len(pairs) if pairs else 1.0
        return same if same == 1 else max(0.0, (same - 1 / 255) / (1 - 1 / 255))

    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        a, e, b = (fingerprints.signature(fingerprints.hashes(slow_phrases(x))).tolist() for x in (t, fingerprints.edit(t, nxt), nxt))
        assert any(x == pytest.approx((alike(a, e), alike(a, b))) for x in likes[i, bytes(a).hex(), bytes(e).hex()])
    one = fingerprints.compared(frame(spark, [(7, "abcabcd")])).first()
    assert one["near_next"] == 1.0 and fingerprints.compared(none).count() == 0
    assert fingerprints.likeness(fingerprints.fingerprint(""), fingerprints.fingerprint(None)) == 1.0
    assert fingerprints.likeness(fingerprints.fingerprint(""), fingerprints.fingerprint("abc")) == 0.0


def test_halves_are_closer_than_strangers(spark, sf):
    r = fingerprints.op5_lz_fingerprint(spark, sf).toPandas()
    assert (r["near_edited"] > r["near_next"]).mean() > 0.98


# 6 quality


def test_quality_is_learned(spark):
    """Held-out labels at sf0.1: the order of scores, and the decision at the threshold."""
    sf = "/root/testdata/sf0.1"
    r = quality.op6_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    good, bad = r.loc[r.quality == 1, "score"], r.loc[r.quality == 0, "score"]
    assert np.mean([(g > bad).mean() for g in good]) > 0.97 and r["score"].between(0, 1).all() and len(r) > 500
    assert (r["predicted"] == r["quality"]).mean() > 0.95


def labelled(spark):
    rng = random.Random(9)
    clean = ["".join(rng.choice("aeioust") for _ in range(5)) for _ in range(40)]
    junk = ["".join(rng.choice("#$%&0159") for _ in range(5)) for _ in range(40)]
    text = lambda vocabulary: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(50, 900)))
    rows = [(k, text(clean if k % 2 else junk)) for k in range(200)] + [(400, None), (401, ""), (402, text(clean) * 300), (403, "x"), (7, text(clean)), (None, text(junk))]
    return rows, spark.createDataFrame([(k, k % 2) for k in range(200)] + [(3, 1), (None, 1), (400, None), (9, 7)], "doc_id long, quality int")


def test_quality_of_odd_texts(spark):
    """A fitted model on null, empty, very long, repeated and short texts, against one text after the other."""
    import zstandard

    rows, labels = labelled(spark)
    docs = frame(spark, rows)
    model = quality.fit(docs, labels)
    got = quality.scored(docs, model).collect()
    assert len(got) == len(rows)

    def slow(text):
        b, gap = (text or "").encode(), 0
        for k in range(0, len(b), quality.FRAME):
            for sign, raw in ((1, model.bad), (-1, model.good)):
                one = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=False, write_dict_id=False)
                gap += sign * len(one.compress(b[k : k + quality.FRAME]))
        z = model.coef[0] + 10 * model.coef[1] * gap / max(1, len(b))
        return round(1 / (1 + math.exp(-max(-30, min(30, z)))), 3)

    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(slow(t))
    for i, scores in want.items():
        assert sorted(r["score"] for r in got if r["doc_id"] == i) == pytest.approx(sorted(scores), abs=0.01)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["score"])
    right = [(by[k][0] >= 0.5) == (k % 2 == 1) for k in range(200)]
    assert np.mean(right) > 0.97 and by[402][0] > 0.5 and by[400] == by[401] and len(by[7]) == 2


def test_quality_edges(spark, docs, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    flat = quality.scored(docs, quality.fit(docs, labels)).collect()
    assert {r["score"] for r in flat} == {0.5} and len(flat) == len(corpus())
    assert quality.scored(none, quality.fit(none, labels)).count() == 0
    few = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")  # too few to train a dictionary on
    assert all(0 <= r["score"] <= 1 for r in quality.scored(docs, quality.fit(docs, few)).collect())


# 7 mixing


def test_targets():
    t = mixing.targets([("a", 10), ("b", 100), (None, 890)])
    assert t["a"] == 30 and sum(t.values()) == pytest.approx(1000) and t["b"] == 300 and t[None] == pytest.approx(670)
    assert mixing.targets([("a", 0)]) == {"a": 0}


def test_targets_against_rounds():
    """As the contract says it: share by weight, stop at the bound, share the excess again until none is above."""
    rng = random.Random(3)
    for _ in range(200):
        totals = [(f"s{k:03}", rng.choice([0, 1, rng.randint(0, 50), rng.randint(0, 10_000)])) for k in range(rng.randint(1, 12))] + [(None, 5)] * rng.randint(0, 1)
        weight = {s: (5, 2, 1)[k % 3] for k, (s, _) in enumerate(totals)}
        left, open_, want = sum(n for _, n in totals), dict(totals), {}
        while True:
            share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            over = [s for s in open_ if share[s] > 3 * open_[s]]
            if not over:
                break
            for s in over:
                want[s] = 3 * open_.pop(s)
                left -= want[s]
        assert mixing.targets(totals) == pytest.approx(want | share if open_ else want)


def test_constraints_that_interact(spark):
    """Sources and languages at once: every constraint is met, rates have the dual's form, and no other rates that meet the
    constraints are nearer to the corpus."""
    rng = random.Random(6)
    rows = [(rng.choice("abc"), rng.choice(["x", "y", None]), rng.randint(1, 400)) for _ in range(400)]
    df = spark.createDataFrame(rows, "source string, lang string, size long")
    true = {s: {"a": 0.4, "b": 1.3, "c": 2.0}[s] for s in "abc"}
    tilt = {"x": 1.6, "y": 0.7, None: 1.0}
    goals = [{s: sum(n * min(3.0, true[s] * tilt[l]) for t, l, n in rows if t == s) for s in "abc"}, {l: sum(n * min(3.0, true[s] * tilt[l]) for s, m, n in rows if m == l) for l in tilt}]
    lam = mixing.balance(df, ["source", "lang"], goals)
    rate = [min(3.0, math.exp(lam[0][s] + lam[1][l])) for s, l, _ in rows]
    for k, g in enumerate(goals):
        for v, want in g.items():
            assert sum(r * row[2] for r, row in zip(rate, rows) if row[k] == v) == pytest.approx(want, rel=1e-9)
    assert rate == pytest.approx([min(3.0, true[s] * tilt[l]) for s, l, _ in rows], rel=1e-6)
    with pytest.raises(RuntimeError):
        mixing.balance(df, ["source"], [{s: 10 * goals[0][s] for s in "abc"}], steps=30)


@pytest.mark.parametrize("share", [(0.999, 0.3, 2.99), (2.5, 2.9, 0.05), (3.0, 3.0, 0.001), (2.9999, 1e-5, 1.0)])
def test_one_constraint_a_source(spark, share):
    """Shares near the bound, at it, and near zero."""
    df = spark.createDataFrame([(s, n) for s in "abc" for n in (1, 20, 300, 4000)], "source string, size long")
    lam = mixing.balance(df, ["source"], [{s: 4321 * x for s, x in zip("abc", share)}])[0]
    assert [min(3.0, math.exp(lam[s])) for s in "abc"] == pytest.approx(list(share), rel=1e-9)


def test_mix_by_sql(spark, tmp_path):
    import duckdb

    path = str(tmp_path / "documents.parquet")
    frame(spark, [r for r in corpus() if r[0] not in (None, 106)]).select("doc_id", "text", "source").coalesce(1).write.parquet(path)
    cols = ["doc_id", "size", "source_size", "target", "taken", "copies"]
    got = [tuple(r) for r in mixing.op7_mixing(spark, str(tmp_path)).select(cols).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(got) == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({mixing.SQL['op7_mixing']})").fetchall())


@pytest.mark.parametrize("rows_a_bucket", [5, 4000])
def test_mix(spark, docs, none, monkeypatch, rows_a_bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", rows_a_bucket)
    r = mixing.mix(docs, mixing.word_count()).toPandas()
    assert len(r) == len(corpus()) and (r["taken"] <= 3 * r["size"]).all()
    for _, g in r.groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= g["size"].max() / 2 + 1
    again = mixing.mix(docs.repartition(5), mixing.word_count()).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(tuple, r[key].fillna(-1).values)) == sorted(map(tuple, again[key].fillna(-1).values))
    assert mixing.mix(none, mixing.word_count()).count() == 0


# 8 licenses


def slow_licenses(text):
    """Best window of each license, by all windows that start at a bigram of its templates."""
    g = licenses.plain_bigrams(text or "")
    out = {}
    for name, body in licenses.TEMPLATES:
        t = licenses.plain_bigrams(body)
        own = set(t)
        for i in (i for i, x in enumerate(g) if x in own):
            part = set(g[i : i + len(t)])
            dice = 2.0 * len(part & own) / (len(own) + len(part))
            if dice >= 0.8 and (dice, -i) > out.get(name, (0, 0)):
                out[name] = (dice, -i)
    return sorted((n, -k, d) for n, (d, k) in out.items())


def license_rows():
    rng = random.Random(5)
    whole = dict(licenses.TEMPLATES)
    mit = whole["MIT"].split(" ")
    worn = " ".join(w for w in mit if rng.random() > 0.04)
    wrapped = "\n".join(" * " + " ".join(mit[k : k + 9]) for k in range(0, len(mit), 9))
    return [
        (1, "x y\nReleased under the MIT  License!\nend"), (2, "licensed under the gnu general public license version 3"), (3, "the MIT license is released"), (4, None), (5, ""), (5, "word"),
        (6, "This work is licensed under the GNU General Public License, version 3."), (6, "word"), (None, "Released under the MIT License."), (7, "// Licensed under the Apache License,\n// Version 2.0."),
        (8, "Copyright 2024 A. Author. Released under the MIT License. All rights reserved."), (9, words(rng, 300) + " " + wrapped + " " + words(rng, 300)), (10, worn),
        (11, "Released under the MIT License."), (11, "Released under the MIT License."), (12, ("of the software and to the " * 1500) + whole["BSD-3-Clause"]), (13, whole["Zlib"] + " " + whole["ISC"]),
    ]


def test_licenses(spark, none):
    rows = license_rows()
    got = licenses.scan(frame(spark, rows)).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r["doc_id"], [tuple(m) for m in r["matches"]]) for r in got), key=key) == sorted(((i, slow_licenses(t)) for i, t in rows), key=key)
    names = {(r["doc_id"], m["license"]) for r in got for m in r["matches"] if m["dice"] >= 0.9}
    assert {(1, "MIT"), (6, "GPL-3.0"), (7, "Apache-2.0"), (8, "MIT"), (9, "MIT"), (10, "MIT"), (12, "BSD-3-Clause"), (13, "ISC"), (13, "Zlib")} <= names
    assert licenses.scan(none).count() == 0 and all(m["dice"] <= 1 for r in got for m in r["matches"])


def test_licenses_by_sql(spark, tmp_path):
    """The registered query and its SQL on repeated rows, null ids, wrapped and embedded notices."""
    import duckdb

    path = str(tmp_path / "documents.parquet")
    frame(spark, license_rows()).select("doc_id", "text").coalesce(1).write.parquet(path)
    cols = ["doc_id", "license", "dice", "start", "n_licenses"]
    got = [tuple(r) for r in licenses.op8_license_scan(spark, str(tmp_path)).select(cols).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(got, key=str) == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({licenses.SQL['op8_license_scan']})").fetchall(), key=str)


# 9 language


def test_gradients():
    net = language.Network(["a", "b", "c"])
    x = np.random.default_rng(0).integers(0, 257, (9, 5))
    y = np.array([0, 1, 2, 1, 0])
    _, g = net.gradients(x, y)
    for k, v in g.items():
        i = np.unravel_index(np.abs(v).argmax(), v.shape)
        old, e = net.p[k][i], 1e-2
        net.p[k][i] = old + e
        up = net.gradients(x, y)[0]
        net.p[k][i] = old - e
        down = net.gradients(x, y)[0]
        net.p[k][i] = old
        assert (up - down) / (2 * e) == pytest.approx(v[i], rel=0.02, abs=1e-4)


def slow_language(net, text):
    """Mean probabilities of a text's positions, one byte and one window after the other."""
    def gate(v):
        return 1 / (1 + np.exp(-v))

    def states(w, u, seq):
        h, h_dim, out = np.zeros(len(u)), len(u), []
        for b in seq:
            g, r = w[b], h @ u
            reset, keep = gate(g[:h_dim] + r[:h_dim]), gate(g[h_dim : 2 * h_dim] + r[h_dim : 2 * h_dim])
            new = np.tanh(g[2 * h_dim :] + reset * r[2 * h_dim :])
            h = (1 - keep) * new + keep * h
            out.append(h)
        return out

    p = {k: v.astype(float) for k, v in net.p.items()}
    total = np.zeros(len(net.langs))
    for at in range(0, len(text), language.WINDOW):
        n, c = min(language.WINDOW, len(text) - at), language.CONTEXT
        before, after = text[max(0, at - c) : at], text[at + n : at + n + c]
        fwd = states(p["wf"], p["uf"], before + text[at : at + n])[len(before) :]
        back = states(p["wb"], p["ub"], (text[at : at + n] + after)[::-1])[len(after) :][::-1]
        for f, b in zip(fwd, back):
            z = np.concatenate([f, b]) @ p["v"] + p["c"]
            total += np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    return total / max(1, len(text))


def test_windows_against_single_steps():
    rng = np.random.default_rng(2)
    net = language.Network(["a", "b", "c"])
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 31, 511, 512, 513, 1300, 40)]
    got = net.documents(texts)
    for t, q in zip(texts, got, strict=True):
        assert q == pytest.approx(slow_language(net, t), abs=1e-4)
    assert np.concatenate([x for x in map(language.training_windows, texts)]).size - sum((language.training_windows(t) == 256).sum() for t in texts) == sum(map(len, texts))
    again = np.zeros_like(got)
    for owners, x in language._windows(texts, rows=2):
        inside = x[language.CONTEXT : len(x) - language.CONTEXT] != 256
        np.add.at(again[:, 0], owners, inside.sum(axis=0))
    assert (again[:, 0] >= [len(t) for t in texts]).all()


def test_languages_are_told_apart(spark, sf):
    r = language.op9_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (r["lang"] == r["lang_pred"]).mean() > 0.9


def test_fit_takes_an_id_once(spark):
    """Repeated and unlabelled rows, few languages: the sample is bounded and its texts are whole."""
    rows = [(k, ("ab " if k % 2 else "cd ") * 900, "x" if k % 2 else "y", None, None, "", "", 0, 0) for k in range(40)]
    df = spark.createDataFrame(rows + rows[:7] + [(99, "zz", None, None, None, "", "", 0, 0)], SCHEMA)
    net = language.fit(df, sample=12, steps=30)
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(df, net).collect()}
    assert net.langs == ["x", "y"] and all(got[k] == ("x" if k % 2 else "y") for k in range(40))


def test_language_edges(spark, docs, none):
    net = language.Network(["a", "b"])
    got = {r["doc_id"]: r for r in language.predict(frame(spark, [(1, None), (2, "12 :"), (3, "wort"), (4, "½ ² ① Ⅰ"), (5, ""), (6, "x" * 300_000), (7, "1é")]), net).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (1, 2, 4, 5)) and all(got[k]["lang_pred"] in "ab" for k in (3, 6, 7))
    twice = language.predict(frame(spark, [(1, "wort"), (1, "wort"), (None, "wort")]), net).collect()
    assert len(twice) == 3 and len({(r["lang_pred"], round(r["score"], 5)) for r in twice}) == 1
    even = language.Network(["b2", "a1"][::-1])
    even.p = {k: np.zeros_like(v) for k, v in even.p.items()}
    assert language.predict(frame(spark, [(1, "wort")]), even).first()["lang_pred"] == "a1"
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(docs)).collect()} == {"und"}
    assert language.predict(none, net, keep=True).columns == [*none.columns, "lang_pred", "score"]


# 10 language-model scores


def slow_scores(rows):
    """A walk over an explicit automaton: states are tuples of words, arcs and failure arcs dictionaries."""
    tok = [(i, [*WORD.findall((t or "").translate(LOW)), None]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    train = [w for i, w in tok if not held(i)]
    c = Counter()
    for w in train:
        run = ["<", *w]
        c.update((x,) for x in w)
        for k in (2, 3):
            c.update(tuple(run[j : j + k]) for j in range(len(run) - k + 1))
    n, v = sum(c[k] for k in c if len(k) == 1), sum(len(k) == 1 for k in c)
    c["<",] = len(train)
    z = n + 0.5 * (v + 1)

    def prob(state, x):
        if not state:
            return ((c[x,] if x != "<" else 0) + 0.5) / z
        m = scoring.MASS[len(state)]
        return (c[(*state, x)] + m * prob(state[1:], x)) / (c[state] + m)

    out = []
    for i, w in tok:
        state, total = ("<",) if c["<",] else (), 0.0
        for x in w:
            last = state
            while state and not c[(*state, x)]:
                m = scoring.MASS[len(state)]
                total += math.log10(m / (c[state] + m))
                state = state[1:]
            total += math.log10(prob(state, x))
            state = next(s for s in ((*last, x)[-2:], (x,), ()) if not s or c[s]) if len((*last, x)) > 1 else ((x,) if c[x,] else ())
        base = sum(math.log10((c[x,] + 0.5) / z) for x in w)
        out.append((-1 if i is None else i, len(w), sum(c[x,] > 0 for x in w), n, round(base, 6), round(total, 6)))
    return sorted(out)


@pytest.mark.parametrize("group", [200, 2_000_000])
def test_scores_against_brute_force(spark, docs, none, monkeypatch, group):
    monkeypatch.setattr(scoring, "GROUP_TOKENS", group)
    got = [tuple(r) for r in scoring.score(docs).collect()]
    assert sorted((-1 if r[0] is None else r[0], *r[1:4], round(r[4], 6), round(r[5], 6)) for r in got) == slow_scores(corpus())
    assert scoring.score(none).count() == 0


def test_probabilities_of_a_state_add_up():
    text = ["a b a c", "a b", "b b a", "a b c"]
    toks = [scoring.tokens(t) for t in text]
    first = np.cumsum([len(t) for t in toks]) - [len(t) for t in toks]
    flat = np.concatenate(toks)
    two, three = scoring.arcs(flat, first)
    model = scoring.Automaton(*map(scoring._distinct, (flat, two, np.delete(three, first))), len(flat), len(np.unique(flat)))
    for begin in ("a", "a b", "c c"):
        start = scoring.tokens(begin)[:-1]
        one = float(model.traverse(start, np.array([0]))[2][0])
        after = [np.concatenate([start, [x]]).astype(np.uint64) for x in [*np.unique(flat), np.uint64(12345)]]
        assert sum(10 ** (float(model.traverse(t, np.array([0]))[2][0]) - one) for t in after) == pytest.approx(1.0)


def test_counts_above_32_bits():
    h, n = np.array([1, 5], np.uint64), np.array([2**40, 1])
    got = scoring._unpacked(scoring._packed(n, h))
    assert got[1].tolist() == [1, 5] and got[0].tolist() == [2**40, 1] and scoring._unpacked(scoring._packed(n))[1] is None


def test_registered_scores_of_repeated_rows(spark, tmp_path):
    """The registered query over several files with equal rows and groups of equal content."""
    rows = corpus() + [(7, "ab cd ab cd")] * 4
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = scoring.op10_backoff_lm(spark, str(tmp_path)).collect()
    key = lambda r: (-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
    assert sorted(map(key, got)) == slow_scores(rows)


def test_held_out_texts_score_better_than_words_alone(spark, sf):
    r = scoring.op10_backoff_lm(spark, sf).where("held_out").toPandas()
    assert r["score"].sum() > r["base_score"].sum()
