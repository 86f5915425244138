"""Near duplicates by the Jaccard similarity of their sets of word shingles.

Candidates come from banded minimum hashes: 20 bands of 5. A pair at similarity 0.8 shares no band with probability 4e-4, one at 0.85 with
1e-5. Texts that share a band are joined into clusters; each text goes with its shingles to its cluster once, where every pair is verified
by the exact similarity, so a link is never wrong, and only a pair whose texts meet in no chain of bands is lost.

Equal sets are one row before anything is dealt. A cluster is cut into blocks by rows and by shingles, and each pair of blocks is a
row range of its own; what comes out of a range is a spanning forest of its links, never all pairs.

Defined results: null and empty texts, and texts without a word, have no shingle and no link; texts shorter than a shingle are one shingle;
rows with a null id are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import among, bounded_batches, parts, shuffled, slices, written
from .components import components, roots

BANDS, ROWS = 20, 5
LEAST = 0.8
SEED = 42
#: Rows and shingles of a block at most (a longer text is a block of its own).
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
_CHUNK = 512


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted set of the XXH64 hashes of a text's word shingles."""
    tok = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tok:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tok)
    ends = np.cumsum(np.fromiter(map(len, tok), np.int64, len(tok)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(tok))
    n = len(tok) - k + 1
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[i:j], SEED) for i, j in zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, n))


def set_id(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), SEED)).view(np.int64))


def _band_keys():
    rng = np.random.default_rng(7)
    a = rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    c = rng.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)

    def keys(s: np.ndarray) -> np.ndarray:
        low = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
        for at in range(0, len(s), _CHUNK):
            np.minimum(low, ((s[at : at + _CHUNK, None] ^ c) * a).min(axis=0), out=low)
        bands = low.reshape(BANDS, ROWS)
        return np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(bands)], np.uint64).view(np.int64)

    return keys


def _marked(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, sid, n, bands) of every row with a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _band_keys()
        for batch in slices(batches):
            ids, sid, n, bands = [], [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = shingles(t, words)
                if i is not None and len(s):
                    ids.append(i), sid.append(set_id(s)), n.append(len(s)), bands.append(keys(s))
            flat = pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64), pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * BANDS, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sid, pa.int64()), pa.array(n, pa.int64()), lists], names=["id", "sid", "n", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, "id long, sid long, n long, bands array<long>")


def _with_shingles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            sets = [shingles(t, words) for t in batch.column(0).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array([set_id(s) for s in sets], pa.int64()), lists], names=["cluster", "m", "sid", "s"])

    return run


def pairs(sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Every pair (i, j), j < i, of sets whose Jaccard similarity is at least so much, by counts over postings."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    _, inv = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    by = np.argsort(inv, kind="stable")
    first = np.searchsorted(inv[by], np.arange(inv.max() + 2)) if len(inv) else np.zeros(1, np.int64)
    posted = owner[by]
    ends = np.cumsum(sizes)
    out_i, out_j = [], []
    for i in range(1, len(sets)):
        mine = inv[ends[i] - sizes[i] : ends[i]]
        both = np.zeros(i, np.int64)
        for at in range(0, len(mine), 1024):
            a, b = first[mine[at : at + 1024]], first[mine[at : at + 1024] + 1]
            n = b - a
            places = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            both += np.bincount(posted[places], minlength=len(sets))[:i]
        j = np.flatnonzero(both >= least * (sizes[:i] + sizes[i] - both) - 1e-9)
        out_i.append(np.full(len(j), i)), out_j.append(j)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_i]), np.concatenate([none, *out_j])


def _verified(least: float):
    """Edges (a, b) of a spanning forest of the links within each sorted run of (cluster, i, j)."""
    def edges(sid: list[int], sets: list[np.ndarray]):
        a, b = pairs(sets, least)
        parent = roots(len(sets), a, b)
        moved = np.flatnonzero(parent != np.arange(len(sets)))
        ids = np.array(sid, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids[moved], pa.int64()), pa.array(ids[parent[moved]], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sid, sets = None, [], []
        for batch in slices(batches):
            lists = batch.column(4)
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            where = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            for k, (key, x) in enumerate(zip(where, batch.column(3).to_pylist(), strict=True)):
                if key != last:
                    if len(sid) > 1:
                        yield edges(sid, sets)
                    last, sid, sets = key, [], []
                sid.append(x), sets.append(flat[ends[k] : ends[k + 1]].copy())
        if len(sid) > 1:
            yield edges(sid, sets)

    return run


def links(docs: DataFrame, id_col: str, text_col: str, words: int, least: float = LEAST, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """(id, sid) of every row with a shingle, and edges (a, b) between the sids of linked sets: a spanning forest of each row range."""
    spark = docs.sparkSession
    bounded_batches(spark)
    n = parts(spark)
    marked = written(_marked(docs, id_col, text_col, words), "shingle-bands")
    sets = written(marked.groupBy("sid").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "shingle-sets")
    met = sets.select("sid", F.explode("bands").alias("key"))
    low = written(met.groupBy("key").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low < high").select("key", "low"), "shingle-cells")
    clusters = components(met.join(shuffled(low), "key").where("sid <> low").select(F.col("sid").alias("a"), F.col("low").alias("b")))
    members = written(sets.select("sid", "id", "n").join(shuffled(clusters.select(F.col("node").alias("sid"), F.col("root").alias("cluster"))), "sid"), "shingle-clusters")
    sizes = members.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / F.lit(block)), F.ceil(F.sum("n") / F.lit(block_shingles))).cast("int").alias("m"))
    # an id with several texts brings all of them to each of its clusters; pairs are verified, so that does no harm
    mine = members.join(sizes, "cluster").select(F.col("id").alias("__i"), "cluster", "m").distinct()
    texts = among(docs.select(F.col(id_col).cast("long").alias("__i"), F.col(text_col).alias("__t")), "__i", members.select("id"), members.count())
    texts = texts.join(mine, "__i").select("__t", "cluster", "m")
    dealt = texts.mapInArrow(_with_shingles(words), "cluster long, m int, sid long, s array<long>").where(F.size("s") > 0)
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("sid"), F.col("m")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    ranged = dealt.select("cluster", F.least("own", "o").cast("int").alias("i"), F.greatest("own", "o").cast("int").alias("j"), "sid", "s")
    found = ranged.repartition(n, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(_verified(least), "a long, b long")
    return marked.select("id", "sid"), written(found.where("a <> b"), "shingle-links")
