"""Quality by compression: zstandard dictionaries of good and bad labelled text.

Two dictionaries are trained on whole labelled texts, one a class, by zstandard's own method, which looks for what recurs in all parts of them. A
text is compressed under both, in frames of `FRAME` bytes so that a dictionary counts in every part of a long text alike; the difference of the
compressed sizes, divided by the length, becomes a score by logistic regression on labelled training texts that neither dictionary
has seen, whole and in the same frames.

Only the fit is bounded: `sample` labelled rows a class (those with the smallest hash of the id), with their whole texts, half of them for the
dictionaries of at most `dict_bytes`. Scoring reads every text whole, in one pass without a shuffle; the broadcast model is as large as two
dictionaries, whatever the corpus.

Defined results: null and empty texts get the calibrated share of good labels (difference 0); with fewer than four texts of a class, every score is the
smoothed share of good labels; an id with several rows gives one training text; equal texts get equal scores; repeated rows are scored each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FOLDS, bounded_batches, documents, fold, slices

SAMPLE = 1200
DICT_BYTES = 112 << 10
LEVEL = 3
FRAME = 2048
CUT = 0.3


def sampled(docs: DataFrame, labels: DataFrame, label_col: str, n: int) -> list[tuple[bytes, int]]:
    """Up to n whole training texts a class, by the order of a hash of the id."""
    known = labels.where(F.col(label_col).isin(0, 1) & (fold() != 0)).select("doc_id", F.col(label_col).alias("y")).distinct()
    keys = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        keys = part if keys is None else keys.unionByName(part)
    rows = docs.where(fold() != 0).join(F.broadcast(keys), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("t")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").collect()
    return [((r["t"] or "").encode("utf-8", "replace"), int(r["y"])) for r in rows]


def frames(text: bytes) -> list[bytes]:
    return [text[k : k + FRAME] for k in range(0, len(text), FRAME)]


def dictionary(texts: list[bytes], size: int) -> bytes:
    """A dictionary trained on whole texts; if they are too few to train on, the texts themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, [f for t in texts for f in frames(t) if len(f) >= 8], level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(texts)[-size:]


class Model:
    """Two dictionaries and the calibration."""

    def __init__(self, good: bytes, bad: bytes, coef: np.ndarray, prior: float) -> None:
        self.good, self.bad, self.coef, self.prior = good, bad, coef, prior
        self._ready = None

    def __getstate__(self):
        return {**self.__dict__, "_ready": None}

    def _compressors(self):
        if self._ready is None:
            import zstandard as z

            made = []
            for raw in (self.good, self.bad):
                d = z.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                made.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))
            self._ready = made
        return self._ready

    def feature(self, text: bytes) -> float:
        """Bytes that the good dictionary saves against the bad one, for each byte of the text."""
        if not text or not self.good or not self.bad:
            return 0.0
        good, bad = self._compressors()
        return sum(len(bad.compress(f)) - len(good.compress(f)) for f in frames(text)) / len(text)

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.coef is None:
            return np.full(len(features), self.prior)
        z = _terms(features) @ self.coef
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _terms(gaps: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(gaps)), 10 * np.asarray(gaps)])


def _logistic(a: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-10:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE, dict_bytes: int = DICT_BYTES) -> Model:
    rows = sampled(docs, labels, label_col, sample)
    n_good = labels.where(fold() != 0).agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)), F.count(label_col)).first()
    prior = ((n_good[0] or 0) + 1) / ((n_good[1] or 0) + 2)
    by = {y: [b for b, v in rows if v == y and b] for y in (0, 1)}
    if min(map(len, by.values())) < 4:
        return Model(b"", b"", None, prior)
    model = Model(dictionary(by[1][0::2], dict_bytes), dictionary(by[0][0::2], dict_bytes), None, prior)
    held = [(model.feature(t), y) for y in (0, 1) for t in by[y][1::2]]
    x, y = np.array([v for v, _ in held]), np.array([float(v) for _, v in held])
    coef = _logistic(_terms(x), y)
    # classes have their own numbers in the sample: move the intercept to the share of good labels
    mean = y.mean()
    coef[0] += np.log(prior / (1 - prior)) - np.log(mean / (1 - mean))
    model.coef = coef
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id and score of every row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches):
            x = np.array([m.feature((t or "").encode("utf-8", "replace")) for t in batch.column(1).to_pylist()], dtype=float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m.score(x))], names=[id_col, "score"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


assert FOLDS == 5
QUERIES = {"op6_quality": op6_quality}
SQL: dict[str, str] = {}
