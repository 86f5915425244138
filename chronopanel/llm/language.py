"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on windows of whole labelled training texts, and labels
every byte position. For prediction a document is cut into windows of `WINDOW` bytes; each direction enters a window with the state
that the `CONTEXT` bytes beside it leave, so positions at an edge see their neighbours across it, and the document's
probabilities are the means over all its positions. Windows of many documents are processed together, longest first, so a step of the
recurrence is one matrix product for thousands of windows and little is padding.

Only the fit is bounded: at most `SAMPLE` training documents, dealt over the languages (those with the smallest hash of the id), with
their whole texts. Prediction reads every text whole in one pass without a shuffle; the model is a few kilobytes, whatever the corpus.

Defined results: a null text or one without a letter (Unicode category L) is `und` with score 0; without any training label every text is `und`;
ties go to the alphabetically first language; equal texts get equal predictions up to float32 rounding; repeated rows are predicted each, and
an id with several rows gives one training document; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, documents, fold, release, slices

WINDOW = 512
CONTEXT = 32
TRAIN_WINDOW = 64
HIDDEN = 8
SAMPLE = 1200
BATCH = 256
STEPS = 200
ROWS = 1024  # windows at once in prediction
UNKNOWN = "und"
HASH_BITS = 12
_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.clip(x, -60, 60, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _direction(w: np.ndarray, u: np.ndarray, x: np.ndarray, keep: bool = False):
    """States of one direction. x: bytes [T, B], 256 for padding (state stays zero there)."""
    t_all, b = x.shape
    h = u.shape[0]
    out = np.empty((t_all, b, h), np.float32)
    state = np.zeros((b, h), np.float32)
    tape = []
    for t in range(t_all):
        g, r = w[x[t]], state @ u
        rz = _sigmoid(g[:, : 2 * h] + r[:, : 2 * h])
        n = g[:, 2 * h :] + rz[:, :h] * r[:, 2 * h :]
        n *= 2
        n = _sigmoid(n)
        n *= 2
        n -= 1
        new = n + rz[:, h:] * (state - n)
        pad = x[t] == 256
        if pad.any():
            new[pad] = 0
        if keep:
            tape.append((state, rz, n, r[:, 2 * h :], pad))
        state = out[t] = new
    return (out, tape) if keep else out


def _scan(w: np.ndarray, u: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The states of one direction [T, H, B], as `_direction` computes them, with units before windows and no memory of the way: a sigmoid is a
    hyperbolic tangent of half its argument, so gates need one pass of it."""
    t_all, b = x.shape
    h = u.shape[0]
    half = np.repeat(np.array([0.5, 0.5, 1.0], np.float32), h)[:, None]
    wt, ut = np.ascontiguousarray(w.T) * half, np.ascontiguousarray(u.T) * half
    out = np.empty((t_all, h, b), np.float32)
    state, g, r = np.zeros((h, b), np.float32), np.empty((3 * h, b), np.float32), np.empty((3 * h, b), np.float32)
    pads = (x == 256).any(axis=1)
    for t in range(t_all):
        np.take(wt, x[t], axis=1, out=g, mode="clip")
        np.dot(ut, state, out=r)
        gates, new = g[: 2 * h], r[2 * h :]
        gates += r[: 2 * h]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        new *= gates[:h]
        new += g[2 * h :]
        np.tanh(new, out=new)
        state = np.subtract(state, new, out=out[t])
        state *= gates[h:]
        state += new
        if pads[t]:
            state[:, x[t] == 256] = 0
    return out


def _back(w: np.ndarray, u: np.ndarray, x: np.ndarray, tape: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of input table and recurrent matrix, through time."""
    h = u.shape[0]
    dw, du = np.zeros_like(w), np.zeros_like(u)
    carry = np.zeros_like(d_out[0])
    for t in range(len(tape) - 1, -1, -1):
        state, rz, n, rn, pad = tape[t]
        d = d_out[t] + carry
        d[pad] = 0
        r, z = rz[:, :h], rz[:, h:]
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (state - n) * z * (1 - z)
        dr = dn * rn * r * (1 - r)
        gate = np.concatenate([dr, dz, dn], axis=1)
        inner = np.concatenate([dr, dz, dn * r], axis=1)
        np.add.at(dw, x[t], gate)
        du += state.T @ inner
        carry = d * z + inner @ u.T
    return dw, du


class Network:
    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7) -> None:
        self.langs = langs
        rng = np.random.default_rng(seed)
        h, k = hidden, max(1, len(langs))
        f = np.float32
        self.p = {
            "wf": (rng.standard_normal((257, 3 * h)) * 0.3).astype(f), "uf": (rng.standard_normal((h, 3 * h)) * 0.3).astype(f),
            "wb": (rng.standard_normal((257, 3 * h)) * 0.3).astype(f), "ub": (rng.standard_normal((h, 3 * h)) * 0.3).astype(f),
            "v": (rng.standard_normal((2 * h, k)) * 0.3).astype(f), "c": np.zeros(k, f),
        }

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of every position [T, languages, B] for bytes x [T, B]."""
        p, h = self.p, self.p["uf"].shape[0]
        logits = np.matmul(p["v"][:h].T, _scan(p["wf"], p["uf"], x))
        logits += np.matmul(p["v"][h:].T, _scan(p["wb"], p["ub"], x[::-1])[::-1])
        logits += p["c"][:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of positions that are not padding, and its gradients. y: language of each window."""
        p = self.p
        h = p["uf"].shape[0]
        f, tape_f = _direction(p["wf"], p["uf"], x, keep=True)
        b, tape_b = _direction(p["wb"], p["ub"], x[::-1], keep=True)
        s = np.concatenate([f, b[::-1]], axis=2)
        logits = s @ p["v"] + p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        q = np.exp(logits)
        q /= q.sum(axis=2, keepdims=True)
        live = (x != 256)[..., None]
        n = max(1, int(live.sum()))
        hot = np.eye(len(p["c"]), dtype=np.float32)[y][None]
        loss = float(-(np.log(q + 1e-12) * hot * live).sum() / n)
        d = ((q - hot) * live / n).astype(np.float32)
        flat = d.reshape(-1, d.shape[2])
        ds = d @ p["v"].T
        out = {"v": s.reshape(-1, 2 * h).T @ flat, "c": flat.sum(0)}
        out["wf"], out["uf"] = _back(p["wf"], p["uf"], x, tape_f, ds[..., :h])
        out["wb"], out["ub"] = _back(p["wb"], p["ub"], x[::-1], tape_b, ds[::-1, :, h:])
        return loss, out

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.02, seed: int = 3) -> float:
        """Adam on random batches; windows [n, T]. Returns the last loss."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        by = [np.flatnonzero(labels == k) for k in range(len(self.langs))]
        loss = 0.0
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(ix, max(1, batch // len(by))) for ix in by if len(ix)])
            loss, g = self.gradients(windows[pick].T.astype(np.int64), labels[pick])
            lr = rate * (1 - 0.9 * step / steps)
            for k, v in g.items():
                np.clip(v, -1, 1, out=v)
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.99 * s[k] + 0.01 * v * v
                self.p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return loss

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each text [n, languages]."""
        k = len(self.langs)
        sums = np.zeros((len(texts), k))
        for owners, x in _windows(texts):
            q = self.positions(x)[CONTEXT : len(x) - CONTEXT]
            q *= (x[CONTEXT : len(x) - CONTEXT] != 256)[:, None, :]
            np.add.at(sums, owners, q.sum(axis=0, dtype=np.float64).T)
        return sums / np.maximum(1, [len(t) for t in texts])[:, None]


def _windows(texts: list[bytes], rows: int = ROWS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of the texts in blocks of at most `rows`, by length: owners [B] and bytes [CONTEXT + T + CONTEXT, B], 256 outside a text
    and, before and after the last bytes of a window's context, beyond the window's own length."""
    owner, start, size = [], [], []
    for i, t in enumerate(texts):
        at = np.arange(0, len(t), WINDOW)
        owner.append(np.full(len(at), i))
        start.append(at)
        size.append(np.minimum(WINDOW, len(t) - at))
    if not texts:
        return
    owner, start, size = map(np.concatenate, (owner, start, size))
    order = np.argsort(-size, kind="stable")
    for k in range(0, len(order), rows):
        own = order[k : k + rows]
        block = np.full((len(own), int(size[own[0]]) + 2 * CONTEXT), 256, np.int64)
        for line, w in zip(block, own.tolist(), strict=True):
            a, n, text = int(start[w]), int(size[w]), texts[owner[w]]
            low, high = max(0, a - CONTEXT), min(len(text), a + n + CONTEXT)
            line[CONTEXT - (a - low) : CONTEXT + high - a] = np.frombuffer(text, np.uint8, high - low, low)
        yield owner[own], np.ascontiguousarray(block.T)


def training_windows(text: bytes) -> np.ndarray:
    """A whole text as windows [n, TRAIN_WINDOW], the last one padded."""
    n = -(-len(text) // TRAIN_WINDOW)
    out = np.full(n * TRAIN_WINDOW, 256, np.int16)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, TRAIN_WINDOW)


def fit(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> Network:
    """Trains on a bounded sample of labelled documents outside the held-out fold, dealt over the languages in turn."""
    known = docs.where((fold() != 0) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    # the smallest hashes of each language: first a histogram of their upper bits, so that no language is ranked whole
    marked = known.select("doc_id", "lang", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - HASH_BITS).alias("__bin"))
    bins = W.partitionBy("lang").orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    counts = marked.groupBy("lang", "__bin").agg(F.count("*").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(bins), F.lit(0)))
    last = counts.where(F.col("__before") < sample).groupBy("lang").agg(F.max("__bin").alias("__last"))
    order = W.partitionBy("lang").orderBy("__bin", F.xxhash64("doc_id"), "doc_id")
    few = marked.join(last, "lang").where("__bin <= __last").withColumn("__k", F.row_number().over(order))
    ids = few.where(F.col("__k") <= sample).orderBy("__k", "lang").limit(sample)
    rows = (
        known.where("text IS NOT NULL")
        .join(F.broadcast(ids.select("doc_id", F.col("lang").alias("__lang")).distinct()), "doc_id")
        .where(F.col("lang") == F.col("__lang"))
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("t"))
        .orderBy("doc_id", "lang")
        .collect()
    )
    rows = [(r["lang"], r["t"].encode("utf-8", "replace")) for r in rows if _LETTER.search(r["t"])]
    net = Network(sorted({lang for lang, _ in rows}))
    if len(net.langs) < 2:
        return net
    xs = [training_windows(t) for _, t in rows]
    ys = [np.full(len(x), net.langs.index(lang)) for x, (lang, _) in zip(xs, rows, strict=True)]
    net.train(np.concatenate(xs), np.concatenate(ys), steps)
    del rows, xs, ys
    release()
    return net


def predict(docs: DataFrame, net: Network, text_col: str = "text", id_col: str = "doc_id", names: tuple[str, str] = ("lang_pred", "score"), keep: bool = False) -> DataFrame:
    """Predicted language and its probability; with `keep`, beside all columns of the input."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            good = [bool(t and model.langs and _LETTER.search(t)) for t in texts]
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if any(good):
                q = model.documents([t.encode("utf-8", "replace") for t, g in zip(texts, good, strict=True) if g])
                best = q.argmax(axis=1)
                for i, b, s in zip(np.flatnonzero(good), best, q.max(axis=1), strict=True):
                    langs[i], scores[i] = model.langs[b], min(1.0, float(s))
            cols = list(batch.columns) if keep else [batch.column(batch.schema.get_field_index(id_col))]
            kept = batch.schema.names if keep else [id_col]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(langs, pa.string()), pa.array(scores)], names=[*kept, *names])

    if keep:
        schema = f"{', '.join(f'`{c}` {k}' for c, k in docs.dtypes)}, {names[0]} string, {names[1]} double"
        return docs.mapInArrow(run, schema)
    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {names[0]} string, {names[1]} double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    return predict(docs, fit(docs)).select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")


QUERIES = {"op9_language_id": op9_language_id}
SQL: dict[str, str] = {}
