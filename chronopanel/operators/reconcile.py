"""Comparing two sources: restatements, nearest events, one-to-one matching, agreement of returns, identity by correlation."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import HALF, ratio


def restatement(old: DataFrame, new: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """Every key of either build: new, gone, changed (relative difference above the tolerance) or same."""
    a = old.select(*keys, F.col(value).alias("old"), F.lit(True).alias("__a"))
    b = new.select(*keys, F.col(value).alias("new"), F.lit(True).alias("__b"))
    status = (
        F.when(F.col("__a").isNull(), "new").when(F.col("__b").isNull(), "gone")
        .when(F.abs(ratio("new", "old") - 1.0) > tolerance, "changed").otherwise("same")
    )
    return a.join(b, keys, "full").select(*keys, "old", "new", status.alias("status"))


def nearest(a: DataFrame, b: DataFrame, key: str, date: str, ident: str, days: int) -> DataFrame:
    """For each event of a the nearest event of b with its key within some days: (id, other, gap), other NULL if there is none.

    A band join by equal keys: dates fall into bands of the width of the tolerance, each a row meets three bands, so a frequent
    key does not meet all its dates. Ties: earlier date, then smaller id.
    """
    width = days + 1
    band = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / width)
    left = a.select(F.col(key).alias("__k"), F.col(date).alias("__d"), F.col(ident).alias("id")).withColumn("__b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: i + band("__d"))))
    # of the events of a key and date only the smallest id can be nearest: a row meets as many as the window has dates
    right = b.groupBy(F.col(key).alias("__k"), F.col(date).alias("__e")).agg(F.min(ident).alias("other")).withColumn("__b", band("__e"))
    gap = F.datediff("__e", "__d")
    hits = left.join(right, ["__k", "__b"]).where(F.abs(gap) <= days)
    best = hits.groupBy("id").agg(F.min_by(F.struct("other", gap.alias("gap")), F.struct(F.abs(gap), "__e", "other")).alias("m"))
    return a.select(F.col(ident).alias("id")).join(best, "id", "left").select("id", "m.other", "m.gap")


def _kept(df: DataFrame) -> DataFrame:
    """Cuts lineage by a checkpoint, in the folder that the session names; in one of this machine only where driver and executors are one."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="chronopanel-"))
    return df.checkpoint()


def mutual_best(pairs: DataFrame, left: str, right: str, cost: list[str]) -> DataFrame:
    """One-to-one matches: pairs that are each other's best are taken, their members leave, and again until no pair is left. That is the
    greedy matching by cost, left, right; a chain of pairs, each better than the next, takes a round for each second one."""
    once = F.row_number().over(W.partitionBy(left, right).orderBy(*cost))
    rest, out = _kept(pairs.withColumn("__n", once).where("__n = 1").drop("__n")), None
    while out is None or not rest.isEmpty():
        a = F.row_number().over(W.partitionBy(left).orderBy(*cost, right))
        b = F.row_number().over(W.partitionBy(right).orderBy(*cost, left))
        got = _kept(rest.withColumn("__a", a).withColumn("__b", b).where("__a = 1 AND __b = 1").drop("__a", "__b"))
        if out is not None and got.isEmpty():
            raise RuntimeError("no pair is both members' best")
        out = got if out is None else _kept(out.unionByName(got))
        rest = _kept(rest.join(got.select(left), left, "left_anti").join(got.select(right), right, "left_anti"))
    return out


#: Labels of a block; rows of a block that meet another block at once; meetings of values that are counted at once.
LABELS, STRIP, MEETINGS = 4096, 128, 1 << 21


def _labels(panel: DataFrame, value: str, least: int) -> DataFrame:
    """A row for each label with its dates and values, of labels with at least so many dates; kept, so that it is made once. `panel` has one row a label and date."""
    rows = panel.where(F.col("date").isNotNull() & F.col("ticker").isNotNull()).groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("date", F.col(value).cast("double").alias("x")))).alias("s"))
    return _kept(rows.where(F.size("s") >= least).select("ticker", F.col("s.date").alias("dates"), F.col("s.x").alias("values")))


def _by_blocks(rows: DataFrame, m: int, run, schema: str) -> DataFrame:
    """What `run` makes of each pair of blocks (i, j): rows with own, ticker, dates and values."""
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), m)
    return rows.select("i", "j", "own", "ticker", "dates", "values").repartition(n, "i", "j").sortWithinPartitions("i", "j").mapInArrow(run, schema)


def _all_blocks(panel: DataFrame, value: str, least: int, labels: int, run, schema: str) -> DataFrame:
    """Every pair of blocks of a panel's labels with a value. What is shuffled is every label once for each block."""
    rows = _labels(panel.where(F.col(value).isNotNull()), value, least)
    m = max(1, -(-rows.count() // labels))
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("ticker"), F.lit(m)).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    return _by_blocks(dealt.withColumn("i", F.least("own", "o").cast("int")).withColumn("j", F.greatest("own", "o").cast("int")), m, run, schema)


def _runs(pairs):
    """Hands each sorted run of (i, j) over: the blocks of its labels, the labels, their dates and values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, ([], [], [], [])
        for batch in batches:
            lists = [batch.column(c) for c in (4, 5)]
            flat = [lists[0].values.cast(pa.int32()).to_numpy(), lists[1].values.to_numpy(zero_copy_only=False)]
            void = lists[1].values.is_null().to_numpy(zero_copy_only=False)
            ends = [x.offsets.to_numpy() for x in lists]
            where = zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)
            for row, (i, j, own, name) in enumerate(where):
                if (i, j) != last:
                    if last is not None:
                        yield from pairs(*held)
                    last, held = (i, j), ([], [], [], [])
                held[0].append(own), held[1].append(name)
                for to, f, e in zip(held[2:], flat, ends, strict=True):
                    to.append(f[e[row] : e[row + 1]].copy())
                if (gap := void[ends[1][row] : ends[1][row + 1]]).any():
                    held[3][-1] = np.ma.array(held[3][-1], mask=gap)
        if last is not None:
            yield from pairs(*held)

    return run


def _exact_correlation(x: np.ndarray, y: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Of row pairs, from differences to the first common value: 0 / 0 exactly where a side does not vary."""
    first, n = both.argmax(axis=1)[:, None], both.sum(axis=1, keepdims=True)

    def centred(v: np.ndarray) -> np.ndarray:
        v = np.where(both, v - np.take_along_axis(v, first, 1), 0.0)
        return np.where(both, v - v.sum(axis=1, keepdims=True) / n, 0.0)

    x, y = centred(x), centred(y)
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def _correlations(dates: list[np.ndarray], values: list[np.ndarray], left: np.ndarray, right: np.ndarray, least: int, digits: int, strip: int, kept) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, row, rounded correlation) of the pairs of rows of two blocks with at least so many common dates, of those that `kept(a)` marks, a strip of rows a
    of the left block at a time. A pair without a common date that has both values is left out, an undefined correlation is NaN."""
    k = float(10**digits)
    days = np.unique(np.concatenate(dates))
    v, m, there = (np.zeros((len(dates), len(days))) for _ in range(3))
    for row, x in enumerate(values):
        at = np.searchsorted(days, dates[row])
        there[row, at] = 1.0
        if isinstance(x, np.ma.MaskedArray):
            at, x = at[~x.mask], x.data[~x.mask]
        if len(x):
            # about its median a label's values are small beside those of other dates, so sums lose no digits
            mid = np.median(x)
            v[row, at], m[row, at] = x - (mid if np.isfinite(mid) else 0.0), 1.0
    odd = (~np.isfinite(v)).astype(float)
    v[odd > 0] = 0.0
    gaps = (there != m).any()
    w, u, q = v[right].T, m[right].T, (v[right] ** 2).T
    strange, days_of = odd[right].T, there[right].T if gaps else u
    for at in range(0, len(left), strip):
        a = left[at : at + strip]
        n = m[a] @ u
        keep = ((there[a] @ days_of if gaps else n) >= least) & (n > 0) & kept(a)
        i, j = np.nonzero(keep)
        if not len(i):
            continue
        n, sx, sy = n[i, j], (v[a] @ u)[i, j], (m[a] @ w)[i, j]
        sxx, syy = (v[a] ** 2 @ u)[i, j], (m[a] @ q)[i, j]
        dx, dy = n * sxx - sx * sx, n * syy - sy * sy
        with np.errstate(all="ignore"):
            c = (n * (v[a] @ w)[i, j] - sx * sy) / (np.sqrt(dx) * np.sqrt(dy))
            flat = np.flatnonzero(~((dx > 1e-6 * n * sxx) & (dy > 1e-6 * n * syy) & np.isfinite(c)))
            for part in np.array_split(flat, len(flat) // 4096 + 1):
                x, y = a[i[part]], right[j[part]]
                c[part] = _exact_correlation(v[x], v[y], (m[x] > 0) & (m[y] > 0))
            if odd.any():
                c[((odd[a] @ u) + (m[a] @ strange))[i, j] > 0] = np.nan
        yield a[i], right[j], np.floor(c * k + HALF) / k


def _best(least: int, digits: int, strip: int, but_itself: bool, nan: bool):
    """(a, b, c) of the best b among those of a block, for each a of another block; own is 0 for an a and 1 for a b."""

    def pairs(own: list[int], names: list[str], dates: list[np.ndarray], values: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        order = sorted(range(len(names)), key=names.__getitem__)
        names, side = np.array([names[o] for o in order], object), np.array([own[o] for o in order])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return
        kept = (lambda a: names[a][:, None] != names[right][None, :]) if but_itself else (lambda a: True)
        for a, b, c in _correlations([dates[o] for o in order], [values[o] for o in order], left, right, least, digits, strip, kept):
            if not nan:
                a, b, c = (x[~np.isnan(c)] for x in (a, b, c))
            # labels are sorted: the first of the highest; NaN is above all
            best = np.lexsort((b, -np.where(np.isnan(c), np.inf, c), ~np.isnan(c), a))
            best = best[np.flatnonzero(np.diff(a[best], prepend=-1))]
            yield pa.RecordBatch.from_arrays([pa.array(names[a[best]], pa.string()), pa.array(names[b[best]], pa.string()), pa.array(c[best], pa.float64())], names=["a", "b", "c"])

    return _runs(pairs)


def best_correlated(mine: DataFrame, theirs: DataFrame, value: str, least: int, digits: int = 6, but_itself: bool = False, nan: bool = False, labels: int = LABELS, strip: int = STRIP) -> DataFrame:
    """For each label the other source's label with the highest correlation over at least so many common dates. With `nan` an undefined one
    counts as the highest, as in an ORDER BY; else it is left out. Blocks of labels are multiplied as matrices, as in `correlated_pairs`, and give
    the best of a block for each label: no pair is shuffled. Both tables have one row a label and date."""
    a, b = _labels(mine, value, least), _labels(theirs, value, least)
    m, n = (max(1, -(-x.count() // labels)) for x in (a, b))
    block = lambda k: F.pmod(F.xxhash64("ticker"), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    rows = a.withColumn("i", block(m)).withColumn("j", every(n)).withColumn("own", F.lit(0)).unionByName(b.withColumn("i", every(m)).withColumn("j", block(n)).withColumn("own", F.lit(1)))
    c = _by_blocks(rows, max(m, n), _best(least, digits, strip, but_itself, nan), "a string, b string, c double")
    return c.groupBy("a").agg(F.max("c").alias("c"), F.min_by("b", F.struct(~F.isnan("c"), -F.col("c"), F.col("b"))).alias("b")).select("a", "b", "c")


def _two_blocks(own: list[int], names: list[str], dates: list[np.ndarray], values: list[np.ndarray]):
    """Labels in their order, dates and values in that order, rows of the two blocks (the same rows twice if they are one)."""
    order = sorted(range(len(names)), key=names.__getitem__)
    block = np.array([own[o] for o in order])
    return pa.array([names[o] for o in order], pa.string()), [dates[o] for o in order], [values[o] for o in order], np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max()), block.min() == block.max()


def _batch(label: pa.Array, x: np.ndarray, y: np.ndarray, **what: np.ndarray) -> pa.RecordBatch:
    columns = [label.take(pa.array(np.minimum(x, y))), label.take(pa.array(np.maximum(x, y))), *(pa.array(v) for v in what.values())]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", *what])


def _block_pairs(least: int, digits: int, strip: int):
    """(a, b, c) of the label pairs of each sorted run of (i, j)."""

    def pairs(*held) -> Iterator[pa.RecordBatch]:
        label, dates, values, left, right, one = _two_blocks(*held)
        kept = (lambda a: a[:, None] < right[None, :]) if one else (lambda a: True)
        for x, y, c in _correlations(dates, values, left, right, least, digits, strip, kept):
            yield _batch(label, x, y, c=c)

    return _runs(pairs)


def correlated_pairs(panel: DataFrame, value: str, least: int, digits: int, labels: int = LABELS, strip: int = STRIP) -> DataFrame:
    """(a, b, c): the correlation of every pair of labels, a < b, over their common dates, at least so many; NaN where it is undefined.

    A label is one row with its dates and values. Labels are dealt to blocks and each pair of blocks is multiplied as matrices in one task, so what
    is shuffled is every label once for each block, and no pair is shuffled or held. `panel` has one row a label and date.
    """
    return _all_blocks(panel, value, least, labels, _block_pairs(least, digits, strip), "a string, b string, c double")


def _block_shared(least: int, strip: int, meetings: int):
    """(a, b, n) of the label pairs of each sorted run of (i, j): counts over postings of (date, value)."""

    def pairs(*held) -> Iterator[pa.RecordBatch]:
        label, dates, values, left, right, one = _two_blocks(*held)
        sizes = np.array([len(d) for d in dates])
        x = np.concatenate(values) + 0.0  # zero has no sign, and there is one NaN
        x[np.isnan(x)] = np.nan
        kinds, kind = np.unique(x.view(np.int64), return_inverse=True)
        days, day = np.unique(np.concatenate(dates), return_inverse=True)
        code, first = day.astype(np.int64) * len(kinds) + kind, np.concatenate([[0], np.cumsum(sizes)])
        of = lambda rows: np.concatenate([code[first[r] : first[r + 1]] for r in rows])
        theirs, who = of(right), np.repeat(np.arange(len(right)), sizes[right])
        by = np.argsort(theirs, kind="stable")
        theirs, who = theirs[by], who[by]
        for at in range(0, len(left), strip):
            a = left[at : at + strip]
            mine, row = of(a), np.repeat(np.arange(len(a)) * len(right), sizes[a])
            low = np.searchsorted(theirs, mine)
            n = np.searchsorted(theirs, mine, side="right") - low
            counts, upto = np.zeros(len(a) * len(right), np.int64), np.cumsum(n)
            edges = np.unique(np.searchsorted(upto, np.arange(meetings, int(upto[-1]), meetings)))
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(n)], strict=True):
                many = n[s:e]
                place = np.repeat(low[s:e] - np.concatenate([[0], np.cumsum(many)])[:-1], many) + np.arange(many.sum())
                counts += np.bincount(np.repeat(row[s:e], many) + who[place], minlength=len(counts))
            hit = np.flatnonzero(counts >= least)
            x, y = a[hit // len(right)], right[hit % len(right)]
            if one:
                hit, x, y = (z[x < y] for z in (hit, x, y))
            if len(hit):
                yield _batch(label, x, y, n=counts[hit])

    return _runs(pairs)


def shared_values(panel: DataFrame, value: str, least: int, labels: int = LABELS, strip: int = STRIP, meetings: int = MEETINGS) -> DataFrame:
    """(a, b, n): on how many dates two labels, a < b, have an equal value, for every pair with at least so many. Blocks of labels meet as in
    `correlated_pairs`, so no pair is shuffled or held; NaN equals NaN. `panel` has one row a label and date."""
    return _all_blocks(panel, value, least, labels, _block_shared(least, strip, meetings), "a string, b string, n long")


def agreement(a: DataFrame, b: DataFrame, value: str, within: float, by_year: bool = False) -> DataFrame:
    """Per label (and year): common days, share of days on which two sources' values agree, largest difference."""
    x = a.select("ticker", "date", F.col(value).alias("x")).join(b.select("ticker", "date", F.col(value).alias("y")), ["ticker", "date"])
    x = x.where("x IS NOT NULL AND y IS NOT NULL").withColumn("d", F.abs(F.col("x") - F.col("y")))
    return x.groupBy("ticker", *([F.year("date").cast("long").alias("year")] if by_year else [])).agg(F.count("*").alias("days"), F.avg((F.col("d") < within).cast("double")).alias("share"), F.max("d").alias("largest"))


def within_days(a: DataFrame, b: DataFrame, key: str, date: str, other: str, days: int) -> DataFrame:
    """Pairs of rows with equal keys whose dates are at most so many days apart: joined on key and band of dates, so that a frequent key does not
    meet all its dates."""
    width = max(1, days)
    band = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / width)
    left = a.withColumn("__band", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: i + band(date))))
    return left.join(b.withColumn("__band", band(other)), [key, "__band"]).where(F.abs(F.datediff(other, date)) <= days).drop("__band")


def audit(mine: DataFrame, theirs: DataFrame, days: int, tolerance: float) -> DataFrame:
    """Amounts of dated events in two sources (ticker, date, amount): match, amount, date, missing or extra."""
    a, b = mine.select("ticker", "date", "amount"), theirs.select("ticker", F.col("date").alias("other"), F.col("amount").alias("theirs"))
    gap = F.datediff("other", "date")
    pairs = within_days(a, b, "ticker", "date", "other", days)
    pairs = pairs.withColumn("l", F.struct("ticker", "date")).withColumn("r", F.struct("ticker", "other")).withColumn("gap", F.abs(gap)).withColumn("off", F.abs(F.col("amount") - F.col("theirs")))
    got = mutual_best(pairs, "l", "r", ["gap", "off"])
    matched = got.select("ticker", "date", "other", "amount", "theirs", F.when(F.col("off") > tolerance, "amount").when(F.col("gap") > 0, "date").otherwise("match").alias("status"))
    lost = b.join(got.select("ticker", "other"), ["ticker", "other"], "left_anti").select("ticker", F.lit(None).cast("date").alias("date"), "other", F.lit(None).cast("double").alias("amount"), "theirs", F.lit("missing").alias("status"))
    more = a.join(got.select("ticker", "date"), ["ticker", "date"], "left_anti").select("ticker", "date", F.lit(None).cast("date").alias("other"), "amount", F.lit(None).cast("double").alias("theirs"), F.lit("extra").alias("status"))
    return matched.unionByName(lost).unionByName(more)
