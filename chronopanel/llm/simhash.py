"""SimHash near-dedup with pivot distance tables.

A text's fingerprint has a bit set where over half of its shingles' hashes have it set. Fingerprints link if they differ in
at most `most` bits; a document's group is the connected component.

Links are found through distances to reference fingerprints (pivots). The distances of all fingerprints to all pivots are computed once,
for each of `segments` bit ranges and in total. By the triangle inequality two fingerprints within `most` bits differ by
at most `most` in every total coordinate; and since at most `most` ranges can differ, at least
`segments - most` ranges have equal coordinates for every pivot. So fingerprints are dealt by the coordinates of each choice of
`segments - most` ranges; pairs that meet are discarded by their maximum coordinate difference, and survivors are verified by
their exact distance. No link is lost: this is exact for any data.

Equal fingerprints are one row before anything is dealt. A meeting place with more than `block` fingerprints is cut into blocks, and
each pair of blocks is a row range of its own, so that its work is spread over tasks; what comes out of a range is a
spanning forest of its links (one edge a fingerprint at most), never all pairs.

Defined results: null and empty texts, and texts without a word, have fingerprint 0 and are linked like any other; texts shorter
than a shingle are one shingle; repeated rows share their fingerprint and group; rows with a null id keep their
fingerprint, and get the smallest other id of their group, or null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import overlap
from .common import bounded_batches, documents, parts, shuffled, slices, written
from .components import components, roots

SHINGLE = 4
MOST = 4
SEGMENTS = 6
PIVOTS = 16
BLOCK = 2048
SEED = 42
_PART = 1 << 15


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """64 majority bits over the XXH64 hashes of a text's word shingles."""
    tok = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tok:
        return 0
    joined = b" ".join(tok)
    ends = np.cumsum(np.fromiter(map(len, tok), np.int64, len(tok)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(tok))
    a, b = starts[: len(tok) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(a)
    for at in range(0, n, _PART):
        h = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(a[at : at + _PART], b[at : at + _PART], strict=True)), np.uint64, min(_PART, n - at))
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """(id, fp): fingerprints as signed 64-bit numbers."""

    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fp = [_signed(fingerprint(t, words)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, "id long, fp long")


def pivots(n: int = PIVOTS, segments: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Reference fingerprints and the masks of the bit ranges; in each range the pivots' distances tell all patterns apart."""
    edges = np.linspace(0, 64, segments + 1).astype(int)
    masks = np.array([sum(1 << b for b in range(a, e)) for a, e in zip(edges, edges[1:], strict=False)], dtype=np.uint64)
    for seed in range(1000):
        p = np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64)
        p[0] = 0
        signs = 1 - 2 * ((p[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(int)
        if all(np.linalg.matrix_rank(signs[:, a:e]) == e - a for a, e in zip(edges, edges[1:], strict=False)):
            return p, masks
    raise ValueError("more pivots are needed for ranges of this width")


def coordinates(fp: np.ndarray, p: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Distances to every pivot in every range [n, ranges, pivots]."""
    return np.bitwise_count((fp[:, None, None] ^ p[None, None, :]) & masks[None, :, None])


def _dealt(segments: int, most: int, n_pivots: int):
    p, masks = pivots(n_pivots, segments)
    choices = list(combinations(range(segments), segments - most))
    mix = np.random.default_rng(11).integers(0, 2**63, (segments, n_pivots), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows = coordinates(fp, p, masks).astype(np.uint64) * mix
            cell = rows.sum(axis=2, dtype=np.uint64)
            keys = []
            for k, c in enumerate(choices):
                x = np.full(len(fp), 0x9E3779B97F4A7C15 * (k + 1) % 2**64, np.uint64)
                for s in c:
                    x = (x ^ cell[:, s]) * np.uint64(0xD6E8FEB86659FD93)
                    x ^= x >> np.uint64(32)
                keys.append(x)
            n = len(choices)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(fp.view(np.int64), n)), pa.array(np.tile(batch.column(1).to_numpy(zero_copy_only=False), n))],
                names=["key", "fp", "rep"],
            )

    return run


def _linked(most: int, segments: int, n_pivots: int):
    """Edges (a, b) of a spanning forest of the links within each sorted run of (key, i, j)."""
    p, _ = pivots(n_pivots, segments)

    def total(fp: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fp[:, None] ^ p[None, :]).astype(np.int8)

    def links(run_id: np.ndarray, fp: np.ndarray, rep: np.ndarray):
        """All runs at once: neighbours at distance 1, 2, ... within a run."""
        n, table = len(fp), total(fp)
        parent = np.arange(n)
        live = np.arange(n - 1)
        step = 1
        while len(live):
            live = live[live + step < n]
            live = live[run_id[live] == run_id[live + step]]
            for at in range(0, len(live), 1 << 18):
                a = live[at : at + (1 << 18)]
                b = a + step
                near = np.abs(table[a] - table[b]).max(axis=1) <= most
                a, b = a[near], b[near]
                hit = np.bitwise_count(fp[a] ^ fp[b]) <= most
                if hit.any():
                    parent = roots(n, a[hit], b[hit], parent)
            step += 1
        moved = np.flatnonzero(parent != np.arange(n))
        return rep[moved], rep[parent[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            if tail is not None:
                cols = [np.concatenate([t, c]) for t, c in zip(tail, cols, strict=True)]
            change = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])) + 1
            end = int(change[-1]) if len(change) else 0
            tail = [c[end:] for c in cols]
            if end:
                yield edges([c[:end] for c in cols])
        if tail is not None and len(tail[0]):
            yield edges(tail)

    def edges(cols):
        new = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
        run_id = np.concatenate([[0], np.cumsum(new)])
        a, b = links(run_id, cols[3].view(np.uint64), cols[4])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def link_groups(distinct: DataFrame, most: int = MOST, segments: int = SEGMENTS, n_pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(node, root) over (fp, rep) rows with different fingerprints; only nodes with a link to another fingerprint."""
    n = parts(distinct.sparkSession)
    dealt = distinct.select("fp", "rep").mapInArrow(_dealt(segments, most, n_pivots), "key long, fp long, rep long")
    sizes = dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = written(sizes, "pivot-cells")
    met = dealt.join(shuffled(sizes), "key")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    met = met.withColumn("m", blocks).withColumn("own", own)
    # a row goes to every pair of blocks that has its own: m pairs, one for a place of ordinary size
    ranged = met.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).select(
        "key", F.least("own", "o").cast("int").alias("i"), F.greatest("own", "o").cast("int").alias("j"), "fp", "rep"
    )
    found = ranged.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "fp").mapInArrow(_linked(most, segments, n_pivots), "a long, b long")
    return components(found)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE, most: int = MOST, **tuning) -> DataFrame:
    """(id, fp, component_id) of every row; component_id is the smallest id reachable over links."""
    marked = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("id").alias("low")).select("fp", "low"), "distinct-fingerprints")
    named = distinct.where("low IS NOT NULL").select("fp", F.col("low").alias("rep"))
    groups = link_groups(named, most, **tuning)
    roots = distinct.join(shuffled(groups), distinct.low == groups.node, "left").select("fp", F.coalesce("root", "low").alias("component_id"))
    return marked.join(roots, "fp").select("id", "fp", "component_id")


#: Near duplicates of the pipeline: five words, and six bits besides the similarity of shingle sets.
STAGE = {"words": 5, "most": 6, "segments": 8}


def overlap_groups(docs: DataFrame, id_col: str, text_col: str, words: int, most: int, least: float, **tuning) -> DataFrame:
    """(id, component_id) of every row: components over links by fingerprints and links by the similarity of shingle sets."""
    groups = written(near_groups(docs, id_col, text_col, words, most, **tuning).where("component_id IS NOT NULL"), "near-groups")
    sets, links = overlap.links(docs, id_col, text_col, words, least)
    # nodes are fingerprint groups and shingle sets, marked apart; a row ties its group to its set
    group, shingle_set = F.xxhash64(F.lit("group"), "component_id"), F.xxhash64(F.lit("set"), "sid")
    ties = groups.where("id IS NOT NULL").select("id", "component_id").join(sets, "id").select(group.alias("a"), shingle_set.alias("b")).distinct()
    linked = links.select(*[F.xxhash64(F.lit("set"), c).alias(c) for c in ("a", "b")])
    shared = ties.groupBy("b").agg(F.count("*").alias("__n")).where("__n > 1").select("b")
    useful = ties.join(shared.unionByName(linked.select("b")).unionByName(linked.select(F.col("a").alias("b"))).distinct(), "b", "left_semi")
    roots = written(components(useful.select("a", "b").unionByName(linked)), "near-roots")
    rooted = groups.withColumn("__g", group).join(roots, F.col("__g") == F.col("node"), "left").select("id", F.coalesce("root", "__g").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    return rooted.join(lows, "root").select("id", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = overlap.LEAST, **rule) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its group of near duplicates: texts that link by their fingerprints, or whose sets
    of shingles have a Jaccard similarity of `least` or more. Rows that share an id are one document: they stay if any of them is
    first. All columns are kept."""
    groups = overlap_groups(docs.select(id_col, text_col), id_col, text_col, least=least, **(STAGE | rule))
    rest = groups.where("id IS NOT NULL").groupBy("id").agg(F.max(F.col("id") == F.col("component_id")).alias("first")).where("NOT first")
    return docs.join(rest.select(F.col("id").alias(id_col)), id_col, "left_anti")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_groups(documents(spark, sf_dir, "doc_id", "text"))
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op1_simhash": op1_simhash}
SQL: dict[str, str] = {}
