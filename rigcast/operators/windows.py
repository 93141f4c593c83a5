"""E: lookback / horizon windows over a dense index, as halo blocks.

A global series ordered by ``idx`` would make ``Window.orderBy('idx')`` a
single-task plan. Instead anchors are grouped into blocks of ``block`` rows;
every row is copied to each block whose anchors need it (anchor ``a`` needs
rows ``a - before .. a + after``), so a block holds at most
``block + before + after`` rows whatever the data size or key skew. The
window then runs per ``(series, block)`` and only the block's own anchors are
kept. Copy factor: ``1 + (before + after) / block``.

Frames use ``rangeBetween`` on ``idx``, so a gap in the index can never make
a window take a wrong row: an incomplete window fails the size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigcast.operators.clean import col


def default_block(before: int, after: int, minimum: int = 1024) -> int:
    return max(minimum, 20 * (before + after + 1))


def _div(expr: str, block: int) -> Column:
    return F.expr(f"({expr}) div {int(block)}")


def halo_blocks(df: DataFrame, before: int, after: int, block: int | None = None,
                idx: str = "idx") -> tuple[DataFrame, int]:
    """Copy each row to every block that needs it; adds ``_blk`` and ``_own``
    (the row's own block). Returns the frame and the block size used."""
    if before < 0 or after < 0:
        raise ValueError("before and after must be >= 0")
    b = block or default_block(before, after)
    qi = f"`{idx}`"
    lo = _div(f"greatest({qi} - {after}, 0)", b)
    hi = _div(f"{qi} + {before}", b)
    out = (df.withColumn("_own", _div(qi, b))
           .withColumn("_blk", F.explode(F.sequence(lo, hi))))
    return out, b


def _series_blocks(df: DataFrame, fields: dict[str, Column], before: int, after: int, series: Sequence[str], idx: str,
                   block: int | None) -> DataFrame:
    """One row per (series, block): arrays of the block's rows with its halo, in
    the order of ``idx``: ``_i`` (index), ``_own`` (whether the row is the
    block's own) and one array per field, with a mark ``<field>_null`` for blocks that hold a null."""
    blocks, _ = halo_blocks(df, before, after, block, idx)
    item = F.struct(F.col(idx).alias("_i"), *[c.alias(n) for n, c in fields.items()], (F.col("_blk") == F.col("_own")).alias("_own"))
    keys = [col(s) for s in series]
    rows = blocks.select(*keys, "_blk", item.alias("_r")).groupBy(*keys, "_blk").agg(F.sort_array(F.collect_list("_r")).alias("_r"))
    # the arrays are taken out of the rows once: below a generator they are not taken out again for each use
    names = ("_i", *fields, "_own")
    arrays = rows.select(*keys, F.explode(F.array(F.struct(*[F.col(f"_r.{n}").alias(n) for n in names],
                                                           *[F.exists(f"_r.{n}", lambda v: v.isNull()).alias(f"{n}_null") for n in fields]))).alias("_a"))
    return arrays.select(*keys, *[F.col(f"_a.{n}").alias(n) for n in (*names, *[f"{n}_null" for n in fields])])


def _full(lo: Column, hi: Column) -> Column:
    """Rows at positions ``lo .. hi`` are there and follow one another."""
    return (lo >= 1) & (hi <= F.size("_i")) & (F.get("_i", hi - 1) - F.get("_i", lo - 1) == hi - lo)


def _no_null(values: str, lo: Column, size: int) -> Column:
    """No null among ``size`` values from position ``lo``; looked at only in blocks that hold one."""
    return ~F.col(f"{values}_null") | F.forall(F.sequence(lo, lo + (size - 1)), lambda p: F.get(values, p - 1).isNotNull())


def _at_each(rows: DataFrame, series: Sequence[str], keep, **made: Column) -> DataFrame:
    """One row per position ``_p`` of a block that ``keep`` accepts, with the columns ``made`` of it. The
    generators take the values out as compiled code, one row after the other: inside a
    lambda every slice would copy its whole block, and a block's windows would be held at once."""
    keys = [col(s) for s in series]
    placed = rows.withColumn("_p", F.filter(F.sequence(F.lit(1), F.size("_i")), keep))
    placed = placed.select(*keys, *[c for c in rows.columns if c in ("_i", "_x", "_y")], F.explode("_p").alias("_p"))
    return placed.select(*keys, F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


def _windowed(df: DataFrame, x_value: Column, y_value: Column | None, lookback: int,
              horizon: int, series: Sequence[str], idx: str, block: int | None,
              y_scalar: bool) -> DataFrame:
    """Windows as slices of a block's arrays: rows are gathered once per block, not once per window.
    A window that is not complete, has a gap or holds a null value is left out."""
    after = max(horizon - 1, 0)
    rows = _series_blocks(df, {"_x": x_value, "_y": y_value}, lookback, after, series, idx, block)

    def keep(p: Column) -> Column:
        ok = F.get("_own", p - 1) & _full(p - lookback, p + after) & _no_null("_x", p - lookback, lookback)
        return ok if y_scalar else ok & _no_null("_y", p, horizon)

    p = F.col("_p")
    y = F.get("_y", p - 1) if y_scalar else F.slice("_y", p, horizon)
    return _at_each(rows, series, keep, **{idx: F.get("_i", p - 1), "x": F.slice("_x", p - lookback, lookback), "y": y})


def lookback_windows(df: DataFrame, value: str, lookback: int, series: Sequence[str] = (),
                     idx: str = "idx", block: int | None = None) -> DataFrame:
    """For every anchor ``a`` with ``lookback`` predecessors:
    ``x = value[a-lookback .. a-1]`` (array<double>), ``y = value[a]``."""
    return _windowed(df, col(value), col(value), lookback, 1, series, idx, block, True)


def multivar_windows(df: DataFrame, features: Sequence[str], target: str, lookback: int,
                     series: Sequence[str] = (), idx: str = "idx",
                     block: int | None = None) -> DataFrame:
    """``x`` = all ``features`` over the lookback (array<array<double>>,
    one inner array per time step), ``y`` = ``target`` at the anchor."""
    return _windowed(df, F.array(*[col(c) for c in features]), col(target), lookback, 1,
                     series, idx, block, True)


def seq2seq_windows(df: DataFrame, x_value: str | Sequence[str], y_value: str | Sequence[str],
                    seq_len: int, pred_len: int, series: Sequence[str] = (),
                    idx: str = "idx", block: int | None = None) -> DataFrame:
    """``x = [s, s+seq_len)``, ``y = [s+seq_len, s+seq_len+pred_len)``;
    the row carries the anchor ``idx = s + seq_len``. Count ``n-seq_len-pred_len+1``.
    Several columns give arrays of per-step arrays."""
    def v(c):
        return col(c) if isinstance(c, str) else F.array(*[col(x) for x in c])
    return _windowed(df, v(x_value), v(y_value), seq_len, pred_len, series, idx, block, False)


def inference_windows(df: DataFrame, value: str | Sequence[str], lookback: int, n: int,
                      horizon: int = 1, include_latest: bool = False, idx: str = "idx",
                      block: int | None = None, series: Sequence[str] = ()) -> DataFrame:
    """Input windows only. A window ends at row ``r`` (``x = [r-lookback+1, r]``).
    With the reference rule the newest ``horizon`` windows are not emitted
    (``r <= n - 1 - horizon``); ``include_latest`` emits them all."""
    v = col(value) if isinstance(value, str) else F.array(*[col(c) for c in value])
    rows = _series_blocks(df, {"_x": v}, lookback - 1, 0, series, idx, block)
    last = n - 1 if include_latest else n - 1 - horizon
    first = lookback - 1

    def keep(p: Column) -> Column:
        return F.get("_own", p - 1) & (F.get("_i", p - 1) <= last) & _full(p - first, p) & _no_null("_x", p - first, lookback)

    p = F.col("_p")
    return _at_each(rows, series, keep, end_idx=F.get("_i", p - 1), x=F.slice("_x", p - first, lookback))


def lookback_stats(df: DataFrame, value: str, lookback: int, series: Sequence[str] = (),
                   idx: str = "idx", block: int | None = None) -> DataFrame:
    """E1 where only the newest value and the mean of a window are needed:
    ``last``, ``mean`` and the anchor's ``y`` for every full window."""
    w = lookback_windows(df, value, lookback, series, idx, block)
    mean = F.aggregate("x", F.lit(0.0), lambda a, v: a + v) / F.lit(float(lookback))
    return w.select(*[col(s) for s in series], col(idx), F.element_at("x", -1).alias("last"), mean.alias("mean"), "y")


def batch_windows(windows: DataFrame, batch_size: int, first: int, count: int,
                  pos: Column | None = None, idx: str = "idx") -> DataFrame:
    """E5: ``batch_id = window_no div batch_size``; the incomplete last batch
    is dropped. ``window_no`` defaults to ``idx - first``."""
    wn = pos if pos is not None else (F.col(idx) - F.lit(first))
    full = count // batch_size
    out = windows.withColumn("window_no", wn).withColumn(
        "batch_id", F.floor(F.col("window_no") / F.lit(batch_size)).cast("long"))
    return out.where(F.col("batch_id") < full)


ROUNDS = 4           # of the keyed permutation


def _round(j: int, left: Column, right: Column, a: Column, b: Column, key: Column) -> Column:
    """The new right half of round ``j`` of a Feistel network over mixed radices."""
    mixed = F.conv(F.substring(F.md5(F.concat_ws(":", key, F.lit(str(j)), right.cast("string"))), 1, 8), 16, 10).cast("long")
    return (left + mixed) % (a if j % 2 == 0 else b)


def _permuted(x: Column, a: Column, b: Column, key: Column) -> Column:
    """One pass of the network: a bijection of ``0 .. a b - 1``."""
    left, right = x % a, F.floor(x / a)
    for j in range(ROUNDS):
        left, right = right, _round(j, left, right, a, b, key)
    return a * right + left if ROUNDS % 2 == 0 else a * left + right


def _radices(n: Column) -> tuple[Column, Column]:
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    return a, F.ceil(n / a).cast("long")


def _back(once: Column, n: Column, a: Column, b: Column, key: Column) -> Column:
    """``once``, permuted again while it lies outside ``0 .. n - 1``."""
    walk = F.aggregate(F.sequence(F.lit(1).cast("long"), a), once, lambda y, _: F.when(y < n, y).otherwise(_permuted(y, a, b, key)))
    return F.when(once < n, once).otherwise(walk)


def keyed_position(x: Column, n: Column, key: Column) -> Column:
    """A permutation of ``0 .. n - 1`` chosen by the text ``key``, as a projection:
    no row has to see another. The network's domain ``a b`` (``a`` the root of
    ``n``, rounded up) exceeds ``n`` by less than ``a``; the few positions that
    leave ``0 .. n - 1`` are permuted again until they are back."""
    a, b = _radices(n)
    return _back(_permuted(x, a, b, key), n, a, b, key)


def _with_position(rows: DataFrame, name: str) -> DataFrame:
    """:func:`keyed_position` of ``_pos`` among ``_n`` by ``_key`` as a column. Every round is a
    generator of one element, so no later use of its result works it out again: written as
    one expression, the halves that two rounds share double its work in every round."""
    a, b = _radices(F.col("_n"))

    def step(df: DataFrame, **made: Column) -> DataFrame:
        kept = [col(c) for c in df.columns if c not in made]
        return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))

    rows = step(rows, _key=F.col("_key"), _a=a, _b=b)
    rows = step(rows, _left=F.col("_pos") % F.col("_a"), _right=F.floor(F.col("_pos") / F.col("_a")))
    parts = tuple(F.col(c) for c in ("_left", "_right", "_a", "_b", "_key"))
    for j in range(ROUNDS):
        rows = step(rows, _left=F.col("_right"), _right=_round(j, *parts))
    left, right, a, b, key = parts
    once = a * right + left if ROUNDS % 2 == 0 else a * left + right
    rows = step(rows, _once=once)
    # stored by a generator as well: the filter on it is not pushed below, where it would be worked out twice
    rows = rows.withColumn(name, F.array(_back(F.col("_once"), F.col("_n"), a, b, key)))
    return rows.withColumn(name, F.explode(name)).drop("_left", "_right", "_a", "_b", "_once")


def shuffled_batches(windows: DataFrame, batch_size: int, seed: int | str, idx: str = "idx",
                     series: Sequence[str] = ()) -> DataFrame:
    """Repeatable shuffle of every series on its own, batched as E5; each
    series drops its own incomplete last batch. ``seed`` may name a column, so
    that repeats are one more series key. The place of a window in the shuffled
    order is a keyed permutation of its position (``idx`` less the series' first,
    so ``idx`` must have no gaps within a series): a projection, without a sort."""
    keys = list(series)
    keyed = windows if keys else windows.withColumn("_all", F.lit(0))
    by = keys or ["_all"]
    span = keyed.groupBy(*[col(k) for k in by]).agg(F.min(idx).alias("_first"), F.max(idx).alias("_last"), F.count(F.lit(1)).alias("_n"))
    size = F.when(F.col("_last") - F.col("_first") + 1 == F.col("_n"), F.col("_n")).otherwise(
        F.raise_error(F.lit("the index of a series has gaps or repeats")).cast("long"))
    span = span.select(*[col(k) for k in by], "_first", size.alias("_n"))
    seeded = F.col(seed) if isinstance(seed, str) else F.lit(seed)
    key = F.concat_ws(":", seeded.cast("string"), *[col(k).cast("string") for k in keys])
    placed = keyed.join(span, by).withColumn("_key", key).withColumn("_pos", F.col(idx) - F.col("_first"))
    placed = _with_position(placed, "window_no").withColumn("batch_id", F.expr(f"window_no div {int(batch_size)}"))
    return placed.where(F.expr(f"batch_id < _n div {int(batch_size)}")).drop("_key", "_pos", "_first", "_n", "_all")


def horizon_slice(c: Column | str, pred_len: int) -> Column:
    """The last ``pred_len`` steps of a prediction array."""
    c = F.col(c) if isinstance(c, str) else c
    return F.slice(c, -pred_len, pred_len)
