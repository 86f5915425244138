"""Exact substring dedup with suffix arrays: bytes that a `window`-byte string covers which also starts earlier are removed.

Suffixes are sharded so that equal windows meet. Each window has an anchor, the leftmost smallest hash of the `gram`-byte strings in it,
which depends on its content only; windows of one anchor are neighbours, and their union is a block. Requests (anchor hash, two
block hashes, place) are dealt by anchor hash. There four exact rules hold: an anchor that occurs once has no repeated
window; a block with the same content as an earlier one is repeated throughout; of all others the first block of each content
is sent to a suffix shard; and if an anchor has more than `hot` contents, their windows are dealt one by one, by their own hashes.
A shard sorts the suffixes of its blocks by external induced sorting with common-prefix values (`induced`); runs of suffixes
with a common prefix of `window` bytes are equal windows, and all but the earliest are repeated. The answers return to the
texts, where the covered bytes are joined and removed. Equal content means an equal anchor hash and two equal 64-bit hashes of
different kinds (a polynomial and XXH3), 128 bits for each block.

Copies are reduced to one block before the sort, first within a group of texts and then among groups, so a large group of copies costs one entry
a group; a place in a shard is a block of at most 2*window bytes; texts travel compressed in groups of bounded size and are
never joined with all places. The number of reducers and shards follows the bytes of the table, so a task's part stays bounded.
A group is known by its partition and its number there, and carries a hash of its content: a group that meets other content, or
none, in the second pass over the texts is an error.

Earlier means: smaller id (null is smallest), then the order of partitions and rows for repeated ids. Strings are judged on
the input. Defined results: one row for each input row, repeated rows included; null and empty texts have no bytes and keep the
SHA-256 of nothing; texts shorter than the window lose nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, parts, release, slices, written
from .induced import MEMORY_ENTRIES, suffixes

WINDOW = 100
GRAM = 48
GROUP_BYTES = 6 << 20
#: Bytes of text for each reducer and suffix shard; contents of an anchor from which its windows are dealt one by one.
SHARD_BYTES = 48 << 20
HOT = 20_000
_CHUNK = 1 << 18
_NULL = -(2**63)
_R = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _POWERS:
        p, q = np.full(n, _R, np.uint64), np.full(n, np.uint64(pow(int(_R), -1, 2**64)), np.uint64)
        p[0] = q[0] = 1
        np.multiply.accumulate(p, out=p)
        np.multiply.accumulate(q, out=q)
        _POWERS[n] = p, q
    return _POWERS[n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def blocks(text: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Blocks of a text: anchor hash, two block hashes, first window, number of windows."""
    out = []
    for at in range(0, max(0, len(text) - window + 1), _CHUNK):
        part = text[at : at + _CHUNK + window - 1]
        a, b, j, m = _blocks(part, window, gram)
        out.append((a, b, _digests(part, j, j + m - 1 + window), j + at, m))
    if not out:
        e = np.empty(0, np.uint64)
        return e, e, e, np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _digests(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(text[i:j]) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))


def _blocks(text: bytes, window: int, gram: int):
    p, q = _powers(_CHUNK + window)
    n, span = len(text), window - gram + 1
    s = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * p[:n], out=s[1:])
    m = n - gram + 1
    h = _mix((s[gram:] - s[:-gram]) * q[:m])
    # leftmost smallest hash of every `span` neighbours, by doubling
    low, at, step = h, np.arange(m, dtype=np.int32), 1
    while 2 * step <= span:
        right = low[step:] < low[:-step]
        low = np.where(right, low[step:], low[:-step])
        at = np.where(right, at[step:], at[:-step])
        step *= 2
    if rest := span - step:
        right = low[rest:] < low[: len(low) - rest]
        at = np.where(right, at[rest:], at[: len(at) - rest])
    cut = np.flatnonzero(at[1:] != at[:-1]) + 1
    j0 = np.concatenate([[0], cut])
    count = np.diff(np.concatenate([j0, [len(at)]]))
    end = j0 + count - 1 + window
    body = _mix((s[end] - s[j0]) * q[j0] + count.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    # smallest hashes are small: mixed again, they deal evenly
    return _mix(h[at[j0]] * _R), body, j0, count


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length, bytes of equal place together."""
    raw = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays]
    return len(arrays[0]).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(raw))


def _unpack(b: bytes, *kinds: str) -> list[np.ndarray]:
    n = int.from_bytes(b[:4], "little")
    sizes = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[4:], max_output_size=max(1, n * sum(sizes))), np.uint8)
    out, at = [], 0
    for k, s in zip(kinds, sizes, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + s * n].reshape(s, n).T).view(k).ravel())
        at += s * n
    return out


class _Group:
    """Texts of neighbouring rows of a partition, in the order of their ids."""

    def __init__(self, key: int) -> None:
        self.key, self.ids, self.texts, self.n = key, [], [], 0

    def settle(self) -> _Group:
        order = sorted(range(len(self.ids)), key=self.ids.__getitem__)
        self.ids, self.texts = [self.ids[k] for k in order], [self.texts[k] for k in order]
        return self

    def proof(self) -> int:
        x = xxhash.xxh64(b"g")
        for i, t in zip(self.ids, self.texts, strict=True):
            x.update(b"%d,%d;" % (i, len(t)))
            x.update(t)
        return x.intdigest() >> 1


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[_Group]:
    g, key = None, 0
    for batch in slices(batches):
        if g is None and batch.num_rows:
            key = batch.column(2)[0].as_py() << 32
            g = _Group(key)
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            t = (t or "").encode("utf-8", "surrogatepass")
            if g.ids and g.n + len(t) > GROUP_BYTES:
                yield g.settle()
                key += 1
                g = _Group(key)
            g.ids.append(_NULL if i is None else i)
            g.texts.append(t)
            g.n += len(t) + 64
    if g is not None:
        yield g.settle()


def _rows(schema: pa.Schema, rows: list[tuple], at_once: int = 32) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), at_once):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + at_once], strict=True), schema, strict=True)], schema=schema)


_PLACES = "to int, grp long, proof long, kind int, body binary"
_PLACES_ARROW = pa.schema([("to", pa.int32()), ("grp", pa.int64()), ("proof", pa.int64()), ("kind", pa.int32()), ("body", pa.binary())])
_ASKED, _TOLD, _SPANS, _TEXTS = range(4)  # kinds of rows
_ASK = ("<u8", "<u8", "<u8", "<i8", "<u4", "<u4", "<u2")  # anchor, two block hashes, id, row in group, first window, windows
_TELL = ("<u4", "<u4", "<u2", "<i4")  # row in group, first window, windows, shard + 1 (0: repeated, -1: window by window)


def _edges(reducers: int) -> np.ndarray:
    return (np.arange(1, reducers, dtype=object) * (2**64 // reducers)).astype(np.uint64)


def _requests(cols: list[np.ndarray], edges: np.ndarray, key: int, proof: int) -> list[tuple]:
    """Requests of a group, dealt by anchor hash. What recurs in the group is asked once, for its first place."""
    order = np.argsort(cols[0], kind="stable")
    anchor = cols[0][order]
    same = anchor[1:] == anchor[:-1]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    k = order[again]
    k = k[np.lexsort((cols[2][k], cols[1][k], cols[0][k]))]  # stable: places stay in order
    copy = np.zeros(len(order), bool)
    copy[k[1:][(cols[0][k[1:]] == cols[0][k[:-1]]) & (cols[1][k[1:]] == cols[1][k[:-1]]) & (cols[2][k[1:]] == cols[2][k[:-1]])]] = True
    rows = []
    if copy.any():
        n = int(copy.sum())
        rows.append((key % (len(edges) + 1), key, proof, _TOLD, _pack(cols[4][copy], cols[5][copy], cols[6][copy], np.zeros(n, "<i4"))))
    order = order[~copy[order]]
    cols = [c[order] for c in cols]
    cut = [0, *np.searchsorted(cols[0], edges).tolist(), len(order)]
    for r, (x, y) in enumerate(zip(cut, cut[1:], strict=False)):
        if y > x:
            rows.append((r, key, proof, _ASKED, _pack(np.diff(cols[0][x:y], prepend=np.uint64(0)), *[c[x:y] for c in cols[1:]])))
    return rows


def _ask(reducers: int, window: int, gram: int):
    edges = _edges(reducers)

    def run(batches):
        for g in _groups(batches):
            cols = []
            for row, (i, t) in enumerate(zip(g.ids, g.texts, strict=True)):
                a, b, x, j, m = blocks(t, window, gram)
                if len(a):
                    cols.append((a, b, x, np.full(len(a), i, "<i8"), np.full(len(a), row, "<u4"), j.astype("<u4"), m.astype("<u2")))
            if not cols:
                continue
            rows = _requests([np.concatenate(c) for c in zip(*cols, strict=True)], edges, g.key, g.proof())
            del cols
            yield from _rows(_PLACES_ARROW, rows)
            release()

    return run


def _runs(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of each value of a column, which come sorted."""
    at, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[by] != at and held:
                yield at, held
                held = []
            at = row[by]
            held.append(row)
    if held:
        yield at, held


def _new(*cols: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the one before."""
    out = np.ones(len(cols[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return out


def _settled(rows: list[tuple], shards: int, hot: int) -> Iterator[tuple]:
    """Applies the rules to the requests of a reducer: what every group is told about its places."""
    if not rows:
        return
    cols = [_unpack(r[4], *_ASK) for r in rows]
    for c in cols:
        c[0] = np.cumsum(c[0], dtype=np.uint64)
    source = np.repeat(np.arange(len(rows)), [len(c[0]) for c in cols])
    group = np.array([r[1] for r in rows], np.int64)
    anchor, body, body2, ids, row, first, count = (np.concatenate(x) for x in zip(*cols, strict=True))
    del cols
    order = np.argsort(anchor)
    again = np.zeros(len(order), bool)
    same = anchor[order[1:]] == anchor[order[:-1]]
    again[1:] |= same
    again[:-1] |= same
    k = order[again]  # places of anchors that occur again
    if not len(k):
        return
    # of those, by anchor, content and place
    k = k[np.lexsort((first[k], row[k], group[source[k]], ids[k], body2[k], body[k], anchor[k]))]
    a = anchor[k]
    new_a, new_b = _new(a), _new(a, body[k], body2[k])
    contents = np.bincount(np.cumsum(new_a) - 1, weights=new_b)[np.cumsum(new_a) - 1]
    tell = ~new_b | (contents > 1)
    shard = np.where(contents > hot, -1, (a % np.uint64(shards)).astype(np.int64) + 1)
    k, shard = k[tell], np.where(new_b, shard, 0)[tell].astype("<i4")
    by = np.argsort(source[k], kind="stable")
    cut = np.searchsorted(source[k][by], np.arange(len(rows) + 1))
    for s, r in enumerate(rows):
        x = k[by[cut[s] : cut[s + 1]]]
        if len(x):
            yield (r[0], r[1], r[2], _TOLD, _pack(row[x], first[x], count[x], shard[by[cut[s] : cut[s + 1]]]))


def _decide(shards: int, hot: int):
    """Tells every group what concerns it; what groups know by themselves passes through."""

    def run(batches):
        for _, rows in _runs(batches, 0):
            yield from _rows(_PLACES_ARROW, [r for r in rows if r[3] == _TOLD])
            yield from _rows(_PLACES_ARROW, list(_settled([r for r in rows if r[3] == _ASKED], shards, hot)))

    return run


def _send(batches):
    """Texts of a group as one compressed row."""
    for g in _groups(batches):
        sizes = np.array([len(t) for t in g.texts], "<u4")
        body = zstandard.ZstdCompressor(level=1).compress(b"".join(g.texts))
        head = _pack(np.array(g.ids, "<i8"), sizes)
        yield from _rows(_PLACES_ARROW, [(0, g.key, g.proof(), _TEXTS, len(head).to_bytes(4, "little") + head + body)])


def _own_text(rows: list[tuple]) -> bytes:
    """The texts of a group, which must be those that its places were told for."""
    texts = [r for r in rows if r[3] == _TEXTS]
    if len(texts) != 1 or any(r[2] != texts[0][2] for r in rows):
        raise RuntimeError("the texts were dealt otherwise in the second pass")
    return texts[0][4]


def _texts(body: bytes) -> tuple[np.ndarray, list[bytes]]:
    n = int.from_bytes(body[:4], "little")
    ids, sizes = _unpack(body[4 : 4 + n], "<i8", "<u4")
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(body[4 + n :])
    ends = np.cumsum(sizes)
    return ids, [raw[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


_BLOCK = ("<i8", "<u4", "<u4", "<u2")  # id, row in group, first window, windows


def _windows_of(raw: list[bytes], ids, row, first, count, window: int) -> list[np.ndarray]:
    """The windows of some blocks as requests of their own."""
    out = []
    for i, r, f, c in zip(ids.tolist(), row.tolist(), first.tolist(), count.tolist(), strict=True):
        text = raw[r][f : f + c - 1 + window]
        p, q = _powers(_CHUNK + window)
        s = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * p[: len(text)], out=s[1:])
        body = _mix((s[window:] - s[:-window]) * q[:c])
        at = np.arange(c)
        out.append((_mix(body * _R), body, _digests(text, at, at + window), np.full(c, i, "<i8"), np.full(c, r, "<u4"), (f + at).astype("<u4"), np.ones(c, "<u2")))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _cut(window: int, reducers: int):
    """Blocks that go to suffix shards, and windows that are dealt by themselves, cut from the texts of each group."""
    edges = _edges(reducers)

    def run(batches):
        for key, rows in _runs(batches, 1):
            text = _own_text(rows)
            wanted = [_unpack(r[4], *_TELL) for r in rows if r[3] == _TOLD]
            if not wanted:
                continue
            row, first, count, shard = (np.concatenate(x) for x in zip(*wanted, strict=True))
            keep = np.flatnonzero(shard > 0)
            keep = keep[np.argsort(shard[keep], kind="stable")]
            single = np.flatnonzero(shard < 0)
            if not len(keep) and not len(single):
                continue
            ids, raw = _texts(text)
            out = []
            cut = np.concatenate([np.flatnonzero(np.diff(shard[keep], prepend=-1)), [len(keep)]])
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                k = keep[x:y]
                body = [raw[r][f : f + c - 1 + window] for r, f, c in zip(row[k].tolist(), first[k].tolist(), count[k].tolist(), strict=True)]
                head = _pack(ids[row[k]], row[k], first[k], count[k])
                data = zstandard.ZstdCompressor(level=1).compress(b"".join(body))
                out.append((int(shard[k[0]]) - 1, key, rows[0][2], _SPANS, len(head).to_bytes(4, "little") + head + data))
            if len(single):
                single = single[np.lexsort((first[single], row[single]))]
                out += _requests(_windows_of(raw, ids[row[single]], row[single], first[single], count[single], window), edges, key, rows[0][2])
            yield from _rows(_PLACES_ARROW, out)

    return run


def repeated(texts: list[bytes], rank: np.ndarray, window: int = WINDOW, memory: int = MEMORY_ENTRIES) -> list[np.ndarray]:
    """For blocks with a rank in the order of places: which of their windows also start in a block or place of smaller rank,
    or earlier in the same block. From the suffix array of the blocks."""
    sizes = np.array([len(t) for t in texts])
    flat = np.ones(int(sizes.sum()) + len(texts), np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    of = np.repeat(np.arange(len(texts)), sizes + 1)
    inside = np.arange(len(flat)) - starts[of]
    flat[inside < sizes[of]] = np.frombuffer(b"".join(texts), np.uint8) + 2  # UTF-8 has no byte above 0xF4
    pos, lcp = suffixes(flat, window, memory)
    run = np.cumsum(lcp < window)
    real = pos < len(flat)
    pos, run = pos[real], run[real]
    is_window = inside[pos] + window <= sizes[of[pos]]
    pos, run = pos[is_window], run[is_window]
    order = np.lexsort((inside[pos], rank[of[pos]], run))
    pos, run = pos[order], run[order]
    dup = np.zeros(len(flat), bool)
    dup[pos[1:][run[1:] == run[:-1]]] = True
    return [dup[s : s + n - window + 1] for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


def _sorted_spans(rows: list[tuple], window: int, memory: int) -> Iterator[tuple]:
    """Repeated windows of the blocks of a shard, for each group."""
    heads, texts, source = [], [], []
    for s, r in enumerate(rows):
        n = int.from_bytes(r[4][:4], "little")
        ids, row, first, count = _unpack(r[4][4 : 4 + n], *_BLOCK)
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(r[4][4 + n :])
        ends = np.cumsum(count.astype(np.int64) - 1 + window)
        texts += [raw[e - c + 1 - window : e] for e, c in zip(ends.tolist(), count.tolist(), strict=True)]
        heads.append((ids, row, first, count))
        source.append(np.full(len(ids), s))
    if not rows:
        return
    ids, row, first, count = (np.concatenate(x) for x in zip(*heads, strict=True))
    source = np.concatenate(source)
    group = np.array([r[1] for r in rows], np.int64)
    rank = np.empty(len(ids), np.int64)
    rank[np.lexsort((first, row, group[source], ids))] = np.arange(len(ids))
    found: dict[int, list] = {}
    for k, dup in enumerate(repeated(texts, rank, window, memory)):
        if dup.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[0], dup.view(np.int8), [0]])))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                found.setdefault(int(source[k]), []).append((int(row[k]), int(first[k]) + a, b - a))
    for s, spans in found.items():
        r, f, c = zip(*spans, strict=True)
        yield (0, rows[s][1], rows[s][2], _SPANS, _pack(np.array(r, "<u4"), np.array(f, "<u4"), np.array(c, "<u2"), np.zeros(len(r), "<i4")))


def _sort(window: int, memory: int):
    def run(batches):
        for _, rows in _runs(batches, 0):
            yield from _rows(_PLACES_ARROW, [r for r in rows if r[3] == _TOLD])
            # windows by themselves: an anchor hash has one content, so no shard is asked for
            yield from _rows(_PLACES_ARROW, list(_settled([r for r in rows if r[3] == _ASKED], 1, 2**62)))
            yield from _rows(_PLACES_ARROW, list(_sorted_spans([r for r in rows if r[3] == _SPANS], window, memory)))
            release()

    return run


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _remove(window: int, texts_too: bool):
    schema = _OUT_ARROW.append(pa.field("kept", pa.string())) if texts_too else _OUT_ARROW

    def run(batches):
        for _, rows in _runs(batches, 1):
            spans = [_unpack(r[4], *_TELL) for r in rows if r[3] != _TEXTS]
            ids, raw = _texts(_own_text(rows))
            row, first, count, shard = (np.concatenate(x) for x in zip(*spans, strict=True)) if spans else (np.zeros(0, int),) * 4
            hit = np.flatnonzero(shard == 0)  # repeated throughout; the blocks that were sorted came back as spans
            hit = hit[np.lexsort((first[hit], row[hit]))]
            cut = np.searchsorted(row[hit], np.arange(len(ids) + 1))
            out = []
            for k, text in enumerate(raw):
                doc = None if ids[k] == _NULL else int(ids[k])
                own = hit[cut[k] : cut[k + 1]]
                lost = n_spans = 0
                kept = text
                if len(own):
                    a = first[own].astype(np.int64)
                    b = np.maximum.accumulate(a + count[own] - 1 + window)
                    new = np.concatenate([[True], a[1:] > b[:-1]])
                    starts, ends = a[new], b[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(a) - 1]])]
                    n_spans, lost = len(starts), int((ends - starts).sum())
                    kept = b"".join(text[x:y] for x, y in zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True))
                line = (doc, len(text), lost, n_spans, hashlib.sha256(kept).hexdigest())
                out.append((*line, kept.decode("utf-8", "replace")) if texts_too else line)
            yield from _rows(schema, out, 512)

    return run


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, stable: bool = False, texts: bool = False, memory: int = MEMORY_ENTRIES,
    shard_bytes: int = SHARD_BYTES, hot: int = HOT,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, and with `texts` what is kept.

    `stable`: the table can be read twice with equal partitions (a bare file scan); else it is written first.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if not stable:
        rows = written(rows, "sub-texts")
    rows = rows.withColumn("part", F.spark_partition_id())  # of the scan, also beneath a union
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(parts(docs.sparkSession), -(-size // shard_bytes))

    def by_reducer(df: DataFrame) -> DataFrame:
        return df.repartitionById(n, "to").sortWithinPartitions("to")

    def by_group(df: DataFrame) -> DataFrame:
        return df.repartition(n, "grp").sortWithinPartitions("grp", "kind")

    told = written(by_reducer(rows.mapInArrow(_ask(n, window, gram), _PLACES)).mapInArrow(_decide(n, hot), _PLACES), "sub-places")
    sent = rows.mapInArrow(_send, _PLACES)
    cut = by_group(told.unionByName(sent)).mapInArrow(_cut(window, n), _PLACES)
    spans = written(by_reducer(cut).mapInArrow(_sort(window, memory), _PLACES), "sub-spans")
    out = by_group(told.unionByName(spans).unionByName(sent)).mapInArrow(_remove(window, texts), _OUT + (", kept string" if texts else ""))
    return out.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else out


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir, "doc_id", "text"), stable=True)


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
SQL: dict[str, str] = {}
