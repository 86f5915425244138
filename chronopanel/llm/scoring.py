"""Language-model scores by a weighted backoff automaton over words.

All training texts are counted: words, and runs of two and three words (a text starts in a begin state and ends with an end token).
A state is what was read last: the root (nothing), one word v, or two words uv that follow each other in the training texts. From a state h, the
words w that follow it are arcs, of weight

    P(w | h) = (c(hw) + MASS[h] * P(w | h')) / (c(h) + MASS[h])

where h' is h without its first word; the arc leads to the longest state that h and w end with. A failure arc of weight MASS[h] / (c(h) + MASS[h])
leads from h to h'. The root's arcs carry P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), one of them for all words outside the training
texts. The probabilities of a state add up to 1. A traversal from left to right carries the state and adds up log10 weights: while the
state has no arc for a word it follows the failure arc, then it takes the arc.

The automaton of a corpus grows with it and is never in one place. Texts are scored in groups of bounded size. A group asks
for the counts of its own words, pairs and triples; requests are dealt by hash to reducers, which sum the counts of all
training texts and answer each group with the counts of what it asked for, in the order of the question. So each group gets its part of the
automaton, and no table is broadcast or collected; the number of reducers follows the bytes of the table. Requests travel as sorted
arrays, each entry once a group, which also bounds the share of a frequent word. Counts are 64-bit. Words are known by 64-bit hashes, pairs and triples by 56 bits: a run
of words that no text has is taken for one of n others with probability n / 2^56.

A group is known by its partition and its number there, and carries a hash of its content: answers to another content, or none, are an
error, so a changed partitioning between both passes over the texts cannot go unnoticed.

Defined results: null and empty texts have one token, the end; without training texts every count is zero; repeated rows are counted and
scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, fold, parts, release, slices, written

#: Weight of the shorter state's probabilities in a state of one and of two words.
MASS = (0.0, 20.0, 4.0)
#: Tokens a group at most (a longer text is a group of its own); bytes of text for each reducer.
GROUP_TOKENS = 1_200_000
REDUCER_BYTES = 24 << 20
#: Words whose hashes a worker remembers.
CACHE_WORDS = 400_000
#: Bits of a pair's or triple's hash that are kept.
ARC_BITS = np.uint64(56)
BEGIN, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_A, _B, _C = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word, 1)
        return h


_WORDS = _Hashes()


def tokens(text: str | None) -> np.ndarray:
    """Hashes of a text's words and the end token."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: only A-Z change, only ASCII white space divides
    if len(_WORDS) > CACHE_WORDS:
        _WORDS.clear()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def _joined(state: np.ndarray, tok: np.ndarray) -> np.ndarray:
    """Hashes of states followed by a token."""
    x = state * _A
    x ^= x >> np.uint64(29)
    x += tok * _B
    x ^= x >> np.uint64(32)
    x *= _C
    x ^= x >> np.uint64(31)
    x >>= np.uint64(64) - ARC_BITS
    return x


def arcs(tok: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of (state, token) for states of one word and of two, at each position. first: where texts begin; there the state of one
    word is the begin state, and there is none of two (the hash is 0)."""
    before = np.empty_like(tok)
    before[1:] = tok[:-1]
    before[first] = BEGIN
    two = _joined(before, tok)
    state = np.empty_like(two)
    state[1:] = two[:-1]
    three = _joined(state ^ _C, tok)
    three[first] = 0
    return two, three


def _columns(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _rows(raw: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _packed(n: np.ndarray, h: np.ndarray | None = None) -> bytes:
    """Counts, and sorted hashes as differences; bytes of equal place together."""
    body = _columns(n) + (_columns(np.diff(h, prepend=np.uint64(0))) if h is not None else b"")
    return struct.pack("<I", len(n)) + zstandard.ZstdCompressor(level=1).compress(body)


def _unpacked(b: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    n = struct.unpack_from("<I", b)[0]
    raw = zstandard.ZstdDecompressor().decompress(b[4:], max_output_size=16 * n)
    return _rows(raw[: 8 * n], "<i8"), np.cumsum(_rows(raw[8 * n :], "<u8"), dtype=np.uint64) if len(raw) > 8 * n else None


class _Group:
    """Texts of one fold that are scored together."""

    def __init__(self, key: int) -> None:
        self.key, self.ids, self.texts, self.toks, self.n = key, [], [], [], 0

    def add(self, doc_id, text, tok) -> None:
        self.ids.append(doc_id)
        self.texts.append(text or "")
        self.toks.append(tok)
        self.n += len(tok)

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(t) for t in self.toks])
        return np.concatenate(self.toks), np.cumsum(sizes) - sizes

    def proof(self) -> int:
        x = xxhash.xxh64()
        for i, t in zip(self.ids, self.toks, strict=True):
            x.update(b"%d,%d;" % (-1 if i is None else i, len(t)))
            x.update(t)
        return x.intdigest() >> 1


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, _Group]]:
    open_, n = {}, 0
    for batch in slices(batches):
        for doc_id, text, held, part in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
            tok = tokens(text)
            g = open_.get(held)
            if g is not None and g.n + len(tok) > GROUP_TOKENS:
                yield held, g
                g = None
            if g is None:
                g = open_[held] = _Group((part << 32) + n)
                n += 1
            g.add(doc_id, text, tok)
    yield from open_.items()


_REQUEST = "reducer int, grp long, proof long, held boolean, kind int, body binary"
_REQUEST_ARROW = pa.schema([("reducer", pa.int32()), ("grp", pa.int64()), ("proof", pa.int64()), ("held", pa.bool_()), ("kind", pa.int32()), ("body", pa.binary())])
_ANSWER = "reducer int, grp long, proof long, kind int, n long, v long, body binary"
_ANSWER_ARROW = pa.schema([("reducer", pa.int32()), ("grp", pa.int64()), ("proof", pa.int64()), ("kind", pa.int32()), ("n", pa.int64()), ("v", pa.int64()), ("body", pa.binary())])


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + 64], strict=True), schema, strict=True)], schema=schema)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    new = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[new], np.diff(np.concatenate([new, [len(values)]]))


def _lists(tok: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The distinct words (kind 1), pairs (2) and triples (3) of a group, and how often each occurs."""
    two, three = arcs(tok, first)
    for kind, values in ((1, tok), (2, two), (3, np.delete(three, first))):
        if len(values):
            yield kind, *_distinct(values)


def _ask(reducers: int):
    """Requests of every group: its distinct words, pairs and triples with their counts, by reducer."""
    whole = (np.arange(1, reducers, dtype=object) * (2**64 // reducers)).astype(np.uint64)
    edges = {1: whole, 2: whole >> np.uint64(64) - ARC_BITS, 3: whole >> np.uint64(64) - ARC_BITS}

    def run(batches):
        for held, g in _groups(batches):
            proof = g.proof()
            for kind, h, n in _lists(*g.joined()):
                cut = [0, *np.searchsorted(h, edges[kind]).tolist(), len(h)]
                yield from _batches([(r, g.key, proof, held, kind, _packed(n[a:b], h[a:b])) for r, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a], _REQUEST_ARROW)
            release()

    return run


def _summed(reducer: int, kind: int, rows: list[tuple]) -> list[tuple]:
    """Sums the counts of training groups over all requests of a reducer and kind and answers each."""
    ns, hs = zip(*[_unpacked(r[5]) for r in rows], strict=True)
    ends = np.cumsum([0, *map(len, ns)])
    flat, train = np.concatenate(hs), np.concatenate([np.zeros_like(n) if r[3] else n for n, r in zip(ns, rows, strict=True)])
    del ns, hs
    order = np.argsort(flat)
    new = np.concatenate([[True], np.diff(flat[order]) != 0])
    total = np.add.reduceat(train[order], np.flatnonzero(new))
    of = np.empty(len(flat), np.int64)
    of[order] = np.cumsum(new) - 1
    out = [(reducer, -1, 0, kind, int(total.sum()), int((total > 0).sum()), None)]
    return out + [(reducer, r[1], r[2], kind, None, None, _packed(total[of[a:b]])) for r, a, b in zip(rows, ends, ends[1:], strict=False)]


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (reducer, kind)."""
    at, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (row[0], row[4]) != at:
                if held:
                    yield from _batches(_summed(*at, held), _ANSWER_ARROW)
                at, held = (row[0], row[4]), []
            held.append(row)
    if held:
        yield from _batches(_summed(*at, held), _ANSWER_ARROW)


class Automaton:
    """Sorted hashes and counts of some words, pairs and triples, as states, arcs and failure arcs. Others have no count."""

    def __init__(self, words, pairs, triples, n: int, v: int) -> None:
        self.tables, self.n, self.v = (words, pairs, triples), n, v

    def _count(self, kind: int, h: np.ndarray) -> np.ndarray:
        keys, counts = self.tables[kind]
        if not len(keys):
            return np.zeros(len(h))
        k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[k] == h, counts[k], 0).astype(float)

    def traverse(self, tok: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known tokens, log10 probability by the root alone, and by the automaton, of each text.

        A state is its number of words, `level`, at a position. All positions move at once: which state an arc leads to does not
        depend on the failure arcs that were followed before it."""
        two, three = arcs(tok, first)
        c1, c2, c3 = self._count(0, tok), self._count(1, two), self._count(2, three)
        c3[first] = 0

        def held(c: np.ndarray, begin: float) -> np.ndarray:
            out = np.empty_like(c)  # the count of the state before each token
            out[1:] = c[:-1]
            out[first] = begin
            return out

        # the begin state is entered once a text, as the end token
        in_state = (None, held(c1, float(self._count(0, np.array([END], np.uint64))[0])), held(c2, 0.0))
        level = np.where(in_state[2] > 0, 2, np.where(in_state[1] > 0, 1, 0))
        arc = [(c1 + 0.5) / (self.n + 0.5 * (self.v + 1))]
        for k, c in ((1, c2), (2, c3)):
            arc.append((c + MASS[k] * arc[k - 1]) / (in_state[k] + MASS[k]))
        weight, open_ = np.zeros(len(tok)), np.ones(len(tok), bool)
        for k, c in ((2, c3), (1, c2)):
            here = open_ & (level == k)
            found = here & (c > 0)
            weight[found] += np.log10(arc[k][found])
            open_ &= ~found
            fails = here & ~found
            weight[fails] += np.log10(MASS[k] / (in_state[k][fails] + MASS[k]))
            level[fails] = k - 1
        base = np.log10(arc[0])
        weight[open_] += base[open_]
        add = np.add.reduceat
        return add((c1 > 0).astype(np.int64), first), add(base, first), add(weight, first)


_TEXTS = 4  # kind of a row that carries a group's texts
_SCORE = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, held_out=None, id_col: str = "doc_id", text_col: str = "text", stable: bool = False) -> DataFrame:
    """Scores of all texts by a model of those where `held_out` is false.

    `stable`: the table can be read twice with equal partitions (a bare file scan); else it is written first.
    """
    bounded_batches(docs.sparkSession)
    held_out = fold(id_col) == 1 if held_out is None else held_out
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    if not stable:
        rows = written(rows, "lm-texts")
    rows = rows.withColumn("part", F.spark_partition_id())  # of the scan, also beneath a union
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    reducers = max(parts(docs.sparkSession), -(-size // REDUCER_BYTES))
    asked = rows.mapInArrow(_ask(reducers), _REQUEST).repartitionById(reducers, "reducer").sortWithinPartitions("reducer", "kind")
    answers = written(asked.mapInArrow(_answer, _ANSWER), "lm-counts")
    totals = answers.where("grp = -1 AND kind = 1").agg(F.sum("n"), F.sum("v")).first()
    n, v = int(totals[0] or 0), int(totals[1] or 0)

    def send(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for _, g in _groups(batches):
            raw = [t.encode("utf-8", "surrogatepass") for t in g.texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g.key], pa.int64()), pa.array([g.proof()], pa.int64()), pa.array([squeeze(b"".join(raw))], pa.binary()), pa.array([g.ids], pa.list_(pa.int64())), pa.array([[len(t) for t in raw]], pa.list_(pa.int64()))],
                names=["grp", "proof", "body", "ids", "sizes"],
            )

    sent = rows.mapInArrow(send, "grp long, proof long, body binary, ids array<long>, sizes array<long>")
    none = F.lit(None).cast("array<long>")
    both = (
        answers.where("grp <> -1").select("grp", "proof", "kind", "reducer", "body", none.alias("ids"), none.alias("sizes"))
        .unionByName(sent.select("grp", "proof", F.lit(_TEXTS).alias("kind"), F.lit(0).alias("reducer"), "body", "ids", "sizes"))
        .repartition(reducers, "grp")
        .sortWithinPartitions("grp", "kind", "reducer")
    )

    def run(batches):
        at, told = None, {}
        for batch in batches:
            for grp, proof, kind, _, body, ids, sizes in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if grp != at:
                    at, told = grp, {1: [], 2: [], 3: []}
                if kind != _TEXTS:
                    told[kind].append((proof, body))
                    continue
                raw = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                ends = np.cumsum([0, *sizes]).tolist()
                toks = [tokens(raw[a:b].decode("utf-8", "surrogatepass")) for a, b in zip(ends, ends[1:], strict=False)]
                many = np.array([len(t) for t in toks])
                tok, first = np.concatenate(toks), np.cumsum(many) - many
                tables = {k: (np.empty(0, np.uint64), np.empty(0, np.int64)) for k in told}
                for k, h, _ in _lists(tok, first):
                    counts = [_unpacked(b)[0] for p, b in told[k] if p == proof]
                    if sum(map(len, counts)) != len(h) or len(counts) != len(told[k]):
                        raise RuntimeError("the texts were dealt otherwise in the second pass")
                    tables[k] = h, np.concatenate(counts)
                known, base, total = Automaton(*(tables[k] for k in (1, 2, 3)), n, v).traverse(tok, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(many), pa.array(known), pa.array(np.full(len(ids), n)), pa.array(base), pa.array(total)],
                    names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )
                told, toks, tables = {1: [], 2: [], 3: []}, [], {}
                release()

    return both.mapInArrow(run, _SCORE)


def op10_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score(documents(spark, sf_dir, "doc_id", "text"), stable=True)
    return rows.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op10_backoff_lm": op10_backoff_lm}
SQL: dict[str, str] = {}
