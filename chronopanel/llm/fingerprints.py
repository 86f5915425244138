"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into dictionary phrases: each is the shortest string from where the last one ended that is not in the
dictionary yet, and enters it. The set of phrases is hashed, and the smallest hash in each of `BINS` bins is the signature, of
which 8 bits a bin are kept. Texts that compress well with each other's dictionary share phrases; the share
of equal bins estimates how many.

Parsing is sequential in a text and runs once over each, whatever its length. The comparison with the next text needs order, not a
global sort of texts: ids are dealt into ranges by quantiles, a range's first text is also given to the range before it, and
each range is read in order, one text at a time. There is one shuffle of texts.

Defined results: null and empty texts have the empty fingerprint (all zeros) and are alike (1) to each other and unlike (0) to
all others; repeated ids are ordered by text, null ids come first; the only text is its own next; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, parts, slices

BINS = 128
#: Bytes of text for each range of ids, on average.
RANGE_BYTES = 32 << 20
_FIRST = -(2**63)


def phrases(text: str, known: list[str] | None = None, at: int = 0) -> list[str]:
    """Phrases of text[at:], after those in `known`; the last may be known already."""
    out: list[str] = []
    seen = set(known) if known else set()
    add, put = seen.add, out.append
    i, n = at, len(text)
    while i < n:
        j = i + 3
        p = text[i:j]
        if p in seen:
            while j < n:
                j += 1
                p = text[i:j]
                if p not in seen:
                    break
        else:
            # the dictionary holds all beginnings of its phrases: go down to the shortest that is new
            j -= 1
            q = text[i:j]
            if q not in seen:
                p = q
                q = text[i]
                if q not in seen:
                    p = q
        add(p)
        put(p)
        i += len(p)
    return out


def hashes(found: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def signature(h: np.ndarray, bins: int = BINS) -> np.ndarray:
    """8 bits of the smallest hash in each bin, 1 to 255; 0 for an empty bin."""
    low = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, (h % np.uint64(bins)).astype(np.int64), h // np.uint64(bins))
    empty = np.ones(bins, bool)
    empty[(h % np.uint64(bins)).astype(np.int64)] = False
    out = (low % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    out[empty] = 0
    return out


def fingerprint(text: str | None) -> np.ndarray:
    return signature(hashes(phrases(text or "")))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common phrases, 0 to 1: equal bins among those that either text has, less chance."""
    either = (a != 0) | (b != 0)
    n = int(either.sum())
    if not n:
        return 1.0
    same = int(((a == b) & either).sum()) / n
    return max(0.0, (same - 1 / 255) / (1 - 1 / 255)) if same < 1 else 1.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint): the signature as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], names=[id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, fingerprint binary")


def ordered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (range, ghost, id, text) sorted within ranges; a ghost is the first text of the next range (after the last: of the first)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_FIRST)).alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(parts(docs.sparkSession), -(-size // RANGE_BYTES))
    ids = rows.select("id")
    quantiles = ids.select(F.percentile_approx("id", [k / n for k in range(1, n)], 10_000)).first()[0] or []
    edges = np.array(sorted(set(quantiles)), np.int64)

    def deal(k: pd.Series) -> np.ndarray:
        return np.searchsorted(edges, k.to_numpy(np.int64), side="left")

    ranged = F.pandas_udf(lambda k: pd.Series(deal(k).astype(np.int32)), "int")
    firsts = sorted((r["range"], r["low"]) for r in ids.groupBy(ranged("id").alias("range")).agg(F.min("id").alias("low")).collect())
    before = {low: firsts[k - 1][0] for k, (_, low) in enumerate(firsts)}
    marks = np.array(sorted(before), np.int64)

    @F.pandas_udf("own int, before int")
    def both(k: pd.Series) -> pd.DataFrame:
        x = k.to_numpy(np.int64)
        at = np.minimum(np.searchsorted(marks, x), max(0, len(marks) - 1))
        hit = marks[at] == x if len(marks) else np.zeros(len(x), bool)
        return pd.DataFrame({"own": deal(k).astype(np.int32), "before": np.array([before[int(v)] if h else -1 for v, h in zip(x, hit, strict=True)], np.int32)})

    place = F.struct(F.col("w.own").alias("range"), F.lit(0).alias("ghost"))
    ghost = F.struct(F.col("w.before").alias("range"), F.lit(1).alias("ghost"))
    return (
        rows.withColumn("w", both("id"))
        .withColumn("p", F.explode(F.when(F.col("w.before") >= 0, F.array(place, ghost)).otherwise(F.array(place))))
        .select("p.range", "p.ghost", "id", "text")
        .repartitionById(n, "range")
        .sortWithinPartitions("range", "ghost", "id", "text")
    )


class _Parsed:
    """A text with its phrases; the fingerprint of an edit of its end parses only what changes."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""
        self.found = phrases(self.text)
        self.hash = hashes(self.found)
        self.mark = signature(self.hash)

    def edited(self, new: str, cut: int) -> np.ndarray:
        """Fingerprint of new, which agrees with the text up to `cut`."""
        ends = np.cumsum(np.fromiter(map(len, self.found), np.int64, len(self.found)))
        k = int(np.searchsorted(ends, cut, side="right"))
        # a phrase that ends at the end of a text may be cut short; up to the cut all are whole
        if k == len(self.found) and k:
            k -= 1
        more = phrases(new, self.found[:k], int(ends[k - 1]) if k else 0)
        return signature(np.concatenate([self.hash[:k], hashes(more)]))


def edit(text: str, following: str) -> str:
    """The last half of a text replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's fingerprint, that of its edit with the next text, and both likenesses."""

    def line(doc: int, a: _Parsed, b: _Parsed) -> tuple:
        new = edit(a.text, b.text)
        mark = a.edited(new, len(a.text) - len(a.text) // 2)
        return (
            None if doc == _FIRST else doc, len(a.text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
            a.mark.tobytes().hex(), mark.tobytes().hex(), likeness(a.mark, mark), likeness(a.mark, b.mark),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [x.split()[0] for x in _OUT.split(", ")]
        at, doc, last, done = None, None, None, False
        for batch in slices(batches):
            out = []
            for where, is_ghost, i, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if where == at and done:
                    continue
                now = _Parsed(text)
                if where != at:
                    at, done = where, False
                else:
                    out.append(line(doc, last, now))
                    done = bool(is_ghost)
                doc, last = i, now
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return ordered(docs, id_col, text_col).mapInArrow(run, _OUT)


def op5_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(documents(spark, sf_dir, "doc_id", "text"))


QUERIES = {"op5_lz_fingerprint": op5_lz_fingerprint}
SQL: dict[str, str] = {}
