"""Best-two-fit packing of token sequences into bins of a fixed capacity.

Documents become token ids (a byte-level BPE vocabulary, then one end id). Those longer than the capacity are cut
into pieces of exactly the capacity; the first piece takes the remainder. Packing only depends on lengths, and there are
at most `capacity` different ones, so the bins are planned on the histogram of lengths: a plan is a list of
bin contents with a number of repetitions. A bin is filled greedily with the longest pieces that fit; then its
smallest piece is given up if two unpacked pieces fill the gap that this opens more tightly. The plan
is bounded by the capacity, not by the corpus; counting, ranking and placing the pieces is distributed.

Pieces are ranked within their length by hash buckets of a bounded number of rows plus the buckets' offsets, so one
frequent length is no single task. Ranks map to bins by intervals of the plan.

Defined results: null and empty texts are one piece of one token (the end id); repeated rows are packed as often as they
occur, with equal piece numbers; an empty table gives an empty result; other columns are ignored; texts of
any length are tokenised whole.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, documents, slices, written

CAPACITY = 1024
END_ID = 2
BUCKET_ROWS = 4_000
#: How a byte-level vocabulary divides a text, and its characters for bytes that are none: fixed values of the public format.
_DIVIDE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_OF = {chr(b): b for b in _PRINTED} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


@lru_cache(maxsize=4)
def _encoder(path: str):
    """The vocabulary of a tokenizer file. Its ids stand in the order of its merges, so that tiktoken, which merges the pair of the
    lowest id, gives the ids that tokenizers gives, several times as fast."""
    import tiktoken
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(path)
    added = {t.content for t in tk.get_added_tokens_decoder().values()}
    ranks = {bytes(map(_BYTE_OF.__getitem__, t)): i for t, i in tk.get_vocab().items() if t not in added}
    return tiktoken.Encoding(path, pat_str=_DIVIDE, mergeable_ranks=ranks, special_tokens={})


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_bytes(texts: list[str], path: str) -> Iterator[bytes]:
    """Little-endian 32-bit ids of each text."""
    encode = _encoder(path).encode_to_numpy
    for t in texts:
        yield encode(t, disallowed_special=()).astype("<u4").tobytes()


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Documents as pieces of at most `capacity` tokens."""
    bounded_batches(docs.sparkSession)
    last = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), token_bytes(texts, path), strict=True):
                ids += last
                n = len(ids) // 4
                first = n - (n - 1) // capacity * capacity
                bounds = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    out.append((doc, k, a, b - a, zlib.crc32(memoryview(ids)[4 * a : 4 * b])))
            cols = list(zip(*out, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as (lengths, repetitions), by best-two-fit on the histogram of lengths."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    out = []

    def largest(most: int, used: dict[int, int]) -> int | None:
        k = bisect_right(lengths, most) - 1
        while k >= 0:
            n = lengths[k]
            if left[n] > used.get(n, 0):
                return n
            k -= 1
        return None

    while lengths:
        used: dict[int, int] = {}
        bin_, gap = [], capacity
        while gap and (n := largest(gap, used)) is not None:
            bin_.append(n)
            used[n] = used.get(n, 0) + 1
            gap -= n
        need = dict(used)
        if gap and len(bin_) > 1:
            small = bin_[-1]
            room, best = gap + small, (small, 0, 0)
            for a in reversed(lengths[: bisect_right(lengths, room - 1)]):
                if 2 * a <= best[0]:
                    break
                if left[a] <= used.get(a, 0):
                    continue
                with_a = used | {a: used.get(a, 0) + 1}
                b = largest(min(a, room - a), with_a)
                if b is not None and a + b > best[0]:
                    best = (a + b, a, b)
                    if a + b == room:
                        break
            if best[1]:
                bin_ = [*bin_[:-1], best[1], best[2]]
                for n in best[1:]:
                    need[n] = need.get(n, 0) + 1
        used = {}
        for n in bin_:
            used[n] = used.get(n, 0) + 1
        times = max(1, min(left[n] // c for n, c in need.items()))
        out.append((bin_, times))
        for n, c in used.items():
            left[n] -= c * times
            if not left[n]:
                del lengths[bisect_right(lengths, n) - 1]
    return out


def intervals(bins: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks, first bins and offsets of its places."""
    taken: dict[int, int] = {}
    places: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for lengths, times in bins:
        at = 0
        for n in lengths:
            places.setdefault(n, []).append((taken.get(n, 0), base, at))
            taken[n] = taken.get(n, 0) + times
            at += n
        base += times
    return {n: tuple(np.asarray(x, dtype=np.int64) for x in zip(*p, strict=True)) for n, p in places.items()}


def place(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ...). `rows` is read several times."""
    spark = rows.sparkSession
    buckets = max(1, rows.count() // BUCKET_ROWS)
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    cells = rows.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    counts = {int(r["length"]): int(r["n"]) for r in cells.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    where = spark.sparkContext.broadcast(intervals(plan(counts, capacity)))
    ahead = W.partitionBy("length").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = cells.select("length", "__bucket", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"))
    within = W.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("__rank", F.row_number().over(within)).join(offsets, ["length", "__bucket"])

    @F.pandas_udf("sequence_id long, offset long")
    def put(length, rank):
        import pandas as pd

        n, r = length.to_numpy(), rank.to_numpy()
        seq, off = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for k in np.unique(n):
            hit = n == k
            first, base, at = where.value[int(k)]
            i = np.searchsorted(first, r[hit], side="right") - 1
            seq[hit], off[hit] = base[i] + r[hit] - first[i], at[i]
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    return ranked.withColumn("__put", put("length", F.col("__before") + F.col("__rank") - 1)).select(
        *[c for c in rows.columns if c != "__bucket"], "__put.sequence_id", "__put.offset"
    )


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, **names) -> DataFrame:
    return place(written(pieces(docs, path, capacity=capacity, **names), "pieces"), capacity)


def op3_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir, "doc_id", "text"), default_vocabulary())


QUERIES = {"op3_best_two_fit": op3_best_two_fit}
SQL: dict[str, str] = {}
