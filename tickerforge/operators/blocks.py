"""Scans of long series in blocks of time: a summary of each block, a carry into it, then its rows.

A series is cut into blocks of ``width`` days (or units of a numeric order), each of which is scanned on its own.
What a block does to a running value is a small summary: its sum, its product, or for exponential means the linear
map from the value that enters it to the value that leaves it. Summaries are combined along each series, a row a
block, and every row takes the carry of its block. So no task holds a whole series, however long or hot it is.

Rows of one series and time follow each other in any order. Null and NaN values are no observations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Days in a block: some 2,500 trading days.
WIDTH = 3650
BLOCK = "_block"
#: Series and block in one value, never null: windows and joins by it take the rows as they were dealt once.
EACH = "_each"


def block_of(frame: DataFrame, order: str, width: int) -> Column:
    """The block of a date, a time or a number."""
    kind = dict(frame.dtypes)[order]
    at = F.datediff(order, F.lit("1970-01-01").cast("date")) if kind == "date" else F.unix_seconds(F.col(order).cast("timestamp")) / 86_400 if kind.startswith("timestamp") else F.col(order)
    return F.floor(at / width).cast("long")


def in_blocks(frame: DataFrame, order: str, width: int) -> DataFrame:
    return frame if BLOCK in frame.columns else frame.withColumn(BLOCK, block_of(frame, order, width))


def with_each(frame: DataFrame, key: str, order: str, width: int) -> DataFrame:
    rows = in_blocks(frame, order, width)
    return rows if EACH in rows.columns else rows.withColumn(EACH, F.struct(key, BLOCK))


def carried(rows: DataFrame, carry: DataFrame, key: str) -> DataFrame:
    """Rows with the columns of their block's carry."""
    if EACH in rows.columns:
        named = carry.where(F.col(BLOCK).isNotNull()).withColumn("_e", F.struct(key, BLOCK)).drop(key, BLOCK)
        return rows.join(named, F.col(EACH) == F.col("_e"), "left").drop("_e")
    named = carry.withColumnsRenamed({key: "_k", BLOCK: "_b"})
    return rows.join(named, F.col(key).eqNullSafe(F.col("_k")) & (F.col(BLOCK) == F.col("_b")), "left").drop("_k", "_b")


def previous(frame: DataFrame, columns: list[str], key: str = "security_id", order: str = "trade_date", width: int = WIDTH) -> DataFrame:
    """The frame in blocks with ``{c}_before``: the value of the row before, null at a series' start."""
    rows = with_each(frame, key, order, width)
    last = rows.groupBy(key, BLOCK).agg(F.max_by(F.struct(*columns), order).alias("_last"))
    carry = last.select(key, BLOCK, F.lag("_last").over(Window.partitionBy(key).orderBy(BLOCK)).alias("_last"))
    inside = Window.partitionBy(EACH).orderBy(order)
    first = F.row_number().over(inside) == 1
    lagged = rows.withColumns({"_first": first} | {f"{c}_before": F.lag(c).over(inside) for c in columns})
    return carried(lagged, carry, key).withColumns({f"{c}_before": F.when(F.col("_first"), F.col("_last")[c]).otherwise(F.col(f"{c}_before")) for c in columns}).drop("_first", "_last")


def running(frame: DataFrame, made: Mapping[str, tuple[str, str]], key: str = "security_id", order: str = "trade_date", width: int = WIDTH) -> DataFrame:
    """The frame in blocks with a column for each name in ``made``: the "sum", "product" or "count" of a column so far; null values are passed over."""
    rows, kinds = with_each(frame, key, order, width), {"sum": F.sum, "product": F.product, "count": F.count}
    totals = rows.groupBy(key, BLOCK).agg(*[kinds[kind](c).alias(f"_t_{n}") for n, (c, kind) in made.items()])
    before = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(key, BLOCK, *[kinds["sum" if kind == "count" else kind](f"_t_{n}").over(before).alias(f"_c_{n}") for n, (_, kind) in made.items()])
    so_far = Window.partitionBy(EACH).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    scanned = carried(rows.withColumns({n: kinds[kind](c).over(so_far) for n, (c, kind) in made.items()}), carry, key)

    def joined(name: str, kind: str) -> Column:
        own, carried = F.col(name), F.col(f"_c_{name}")
        return F.coalesce(own * carried if kind == "product" else own + carried, own, carried)

    return scanned.withColumns({n: joined(n, kind) for n, (_, kind) in made.items()}).drop(*[f"_c_{n}" for n in made])


#: What a block's scan tells of the block: the weight that its first observation has in its last mean and what the others add
#: to it (over ``d``, their weight, if adjusted), observations, rows before the first one, its value, and rows after the last one.
_TOLD = ("m", "n", "d", "seen", "lead", "first", "trail")
#: What a block starts from: the mean before it, its weight at the row before, and observations so far.
_ENTERS = ("state", "weight", "had")


def _same(a: object, b: object) -> bool:
    return a == b or (a != a and b != b)


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def _parts(batch: pa.RecordBatch, by: list[str]) -> np.ndarray:
    """Where the runs of equal values of ``by`` start in a sorted batch."""
    changed = np.zeros(batch.num_rows, bool)
    changed[:1] = True
    for c in by:
        code = _codes(batch.column(c))
        changed[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(changed)


def _values(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return pc.fill_null(batch.column(name), float("nan")).to_numpy(zero_copy_only=False)


def _means(x: np.ndarray, starts: np.ndarray, alpha: float, adjust: bool, state: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Exponential means of many runs at once: at each observation the mean, its weight and that of the run's mean before, and the observations' places and runs.

    A run starts at each of ``starts``, from a mean (NaN: none) and its weight at the row before. Each observation is
    a linear map of the mean before it; maps are composed over distances that double.
    """
    seen, lengths = ~np.isnan(x), np.diff(np.append(starts, len(x)))
    at = np.flatnonzero(seen)
    run = np.repeat(np.arange(len(starts)), lengths)[at]
    first = np.ones(len(at), bool)
    first[1:] = run[1:] != run[:-1]
    gap = np.diff(at, prepend=0).astype(float)
    gap[first] = (at - starts[run] + 1)[first]
    entering = first & ~np.isnan(state[run])
    old = (1 - alpha) ** gap
    old[first] = np.where(entering, weight[run] * old, 0.0)[first]
    new = 1.0 if adjust else alpha
    value = x[at]
    if adjust:
        a, n, d = np.where(first, 0.0, old), value + np.where(entering, old * np.where(entering, state[run], 0.0), 0.0), np.where(first, 1.0 + old, 1.0)
    else:
        a, n, d = np.where(first, 0.0, old / (old + new)), np.where(first & ~entering, value, (old * np.where(entering, state[run], 0.0) + new * value) / (old + new)), np.ones(len(at))
    own = np.where(entering, (1 - alpha) ** gap if adjust else old / (old + new), np.where(first, 1.0, a))
    reach, longest = 1, int(np.bincount(run).max()) if len(run) else 0
    while reach < longest:
        n[reach:] += a[reach:] * n[:-reach]
        if adjust:
            d[reach:] += a[reach:] * d[:-reach]
        a[reach:] = a[reach:] * a[:-reach]
        reach *= 2
    return (n / d if adjust else n), d, own, at, run


def _summaries(key: str, specs: list[tuple[str, float]], adjust: bool, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row a block from rows that are sorted by series, block and time; a block may go on from batch to batch."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*[(k, b, *[v for t in each for v in t]) for k, b, each in rows]), schema)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            starts = _parts(batch, [key, BLOCK])
            ends = np.append(starts[1:], batch.num_rows)
            names = list(zip(*[batch.column(c).take(pa.array(starts)).to_pylist() for c in (key, BLOCK)]))
            on = held is not None and _same(held[0], names[0][0]) and held[1] == names[0][1]
            columns = []
            for i, (c, alpha) in enumerate(specs):
                x = _values(batch, c)
                m0, n0, d0, seen0, lead0, first0, trail0 = held[2][i] if on else (1.0, 0.0, 0.0, 0.0, 0.0, np.nan, 0.0)
                goes_on = on and seen0 > 0
                seen = np.add.reduceat((~np.isnan(x)).astype(float), starts)
                at = np.flatnonzero(~np.isnan(x))
                run = np.searchsorted(starts, at, "right") - 1
                lead, first, trail = (ends - starts).astype(float), np.full(len(starts), np.nan), (ends - starts).astype(float)
                trail[run] = (ends[run] - 1 - at).astype(float)  # of several writes to a run the last counts
                lead[run[::-1]], first[run[::-1]] = (at - starts[run]).astype(float)[::-1], x[at][::-1]
                opening = at[np.append(True, run[1:] != run[:-1])] if len(at) else at
                rest, state, weight = x.copy(), np.full(len(starts), np.nan), np.zeros(len(starts))
                rest[opening[1:] if goes_on and seen[0] > 0 else opening] = 0.0
                if goes_on:
                    total = m0 + d0 if adjust else 1.0
                    state[0], weight[0] = n0 / total, total * (1 - alpha) ** trail0
                mean, d, own, _, _ = _means(rest, starts, alpha, adjust, state, weight)
                m, n, all_d = np.ones(len(starts)), np.zeros(len(starts)), np.zeros(len(starts))
                if len(at):
                    some = np.flatnonzero(seen > 0)
                    last = np.append(np.flatnonzero(run[1:] != run[:-1]), len(run) - 1)
                    m[some] = np.multiply.reduceat(own, np.searchsorted(run, some))
                    n[some] = mean[last] * d[last]
                    if goes_on and seen[0] > 0:
                        m[0] *= m0 if not adjust else m0 * (1 - alpha) ** trail0
                    all_d[some] = d[last] - m[some] if adjust else 0.0
                if on:
                    if goes_on:
                        if not seen[0]:
                            m[0], n[0], all_d[0], trail[0] = m0, n0, d0, trail0 + trail[0]
                        first[0], lead[0] = first0, lead0
                    else:
                        lead[0] += lead0
                    seen[0] += seen0
                columns.append(list(zip(m.tolist(), n.tolist(), all_d.tolist(), seen.tolist(), lead.tolist(), first.tolist(), trail.tolist())))
            rows = [(k, b, each) for (k, b), each in zip(names, zip(*columns))]
            if held is not None and not on:
                rows = [held, *rows]
            held = rows[-1]
            if len(rows) > 1:
                yield made(rows[:-1])
        if held is not None:
            yield made([held])

    return told


def _carries(key: str, specs: list[tuple[str, float]], adjust: bool, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What enters each block, from the blocks' summaries sorted by series and block."""

    def carried_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = [(np.nan, 0.0, 0.0)] * len(specs)
        before, now = None, start
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for k, b, *told in zip(*[c.to_pylist() for c in batch.columns]):
                now = now if before is not None and _same(before[0], k) else start
                before, following = (k,), []
                for c, v in zip(out, (k, b, *[v for each in now for v in each])):
                    c.append(v)
                for i, (_, alpha) in enumerate(specs):
                    (state, weight, had), (m, n, d, seen, lead, first, trail) = now[i], told[i * len(_TOLD) : (i + 1) * len(_TOLD)]
                    if not seen:
                        following.append((state, weight * (1 - alpha) ** lead, had))
                        continue
                    old, new, value, entered = weight * (1 - alpha) ** (lead + 1), 1.0 if adjust else alpha, first, 1.0
                    if not np.isnan(state):
                        value, entered = (old * state + new * first) / (old + new), old + new if adjust else 1.0
                    total = m * entered + d if adjust else 1.0
                    following.append(((m * entered * value + n) / total, total * (1 - alpha) ** trail, had + seen))
                now = following
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return carried_on


def _rows(key: str, kept: list[str], specs: list[tuple[str, float, int]], adjust: bool, schema: pa.Schema, at0: int = 0) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The means of rows that are sorted by series, block and time and know what enters their block (in columns numbered from ``at0``)."""

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = _parts(batch, [key, BLOCK])
            name = tuple(batch.column(c)[0].as_py() for c in (key, BLOCK))
            on = held is not None and _same(held[0][0], name[0]) and held[0][1] == name[1]
            found, left = [], []
            run_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, batch.num_rows)))
            for i, (c, alpha, warm) in enumerate(specs):
                x = _values(batch, c)
                state, weight, had = (_values(batch, f"_{k}{at0 + i}")[starts] for k in _ENTERS)
                weight, had = np.nan_to_num(weight), np.nan_to_num(had)
                if on:
                    state[0], weight[0], had[0] = held[1][i]
                mean, d, _, at, run = _means(x, starts, alpha, adjust, state, weight)
                seen = ~np.isnan(x)
                count = np.cumsum(seen)
                in_run = count - (count[starts] - seen[starts])[run_of]
                out = np.where(in_run > 0, mean[np.maximum(count - 1, 0)] if len(mean) else np.nan, state[run_of])
                found.append(np.where(had[run_of] + in_run >= warm, out, np.nan))
                s, n = len(starts) - 1, int(in_run[-1])
                rows = batch.num_rows - starts[s]
                left.append((mean[-1], (d[-1] if adjust else 1.0) * (1 - alpha) ** (batch.num_rows - 1 - at[-1]), had[s] + n) if n else (state[s], weight[s] * (1 - alpha) ** rows, had[s]))
            held = (tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in (key, BLOCK)), left)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[pa.array(f, from_pandas=True) for f in found]], schema=pa.schema([*[batch.schema.field(c) for c in kept], *list(schema)]))

    return means


def _differences(pairs: list[tuple[str, str]], kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches with what each pair of columns differs by beside the kept columns, named ``_x_{one}-{other}``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pa.array(_values(batch, a) - _values(batch, b), from_pandas=True) for a, b in pairs]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *found], [*kept, *[f"_x_{a}-{b}" for a, b in pairs]])

    return made


def exponential_means(
    frame: DataFrame, made: Mapping[str, tuple[str, float, int]], adjust: bool = False, keep: tuple[str, ...] = (), key: str = "security_id", order: str = "trade_date", width: int = WIDTH, of: Mapping[str, tuple[tuple[str, str], float, int]] | None = None
) -> DataFrame:
    """(key, order, kept columns, one column for each name in ``made`` and ``of``) in blocks.

    ``made`` has column, weight of the newest value, and observations until which the mean is null; ``of`` has the same
    with two names of ``made`` as column, for means of what these differ by. Weights keep decaying over nulls, where the
    mean stays what it was.

    Rows are dealt by series and block once and sorted; the blocks' summaries and, with what enters the blocks beside
    them, the rows' means are made from them a batch of many series at a time. Means of means take one more scan of the
    same rows, which goes through the means to the summaries of their differences and gives a row a block.
    """
    specs, of = [(f"_x_{c}", alpha, warm) for c, alpha, warm in made.values()], of or {}
    second, pairs = [(f"_x_{a}-{b}", alpha, warm) for (a, b), alpha, warm in of.values()], list(dict.fromkeys(p for p, *_ in of.values()))
    columns, kept = list(dict.fromkeys(c for c, *_ in made.values())), [key, order, BLOCK, *keep]
    values = in_blocks(frame, order, width).select(*kept, *[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"_x_{c}") for c in columns])
    kinds, each = dict(values.dtypes), F.struct(key, BLOCK)
    dealt = values.repartition(each)

    def fields(names: Iterable[str], numbers: range) -> tuple[str, pa.Schema]:
        typed = [f"_{n}{i}" for i in numbers for n in names]
        spark_type = values.schema[key].dataType
        return ", ".join([f"`{key}` {kinds[key]}", f"{BLOCK} bigint", *[f"{n} double" for n in typed]]), pa.schema([pa.field(key, to_arrow_type(spark_type)), pa.field(BLOCK, pa.int64()), *[pa.field(n, pa.float64()) for n in typed]])

    def doubles(names: Iterable[str]) -> pa.Schema:
        return pa.schema([pa.field(n, pa.float64()) for n in names])

    def entering(rows: DataFrame, scan: Callable[[list[tuple[str, float]], pa.Schema], Callable], of_these: list[tuple[str, float, int]], numbers: range) -> DataFrame:
        alphas = [(c, alpha) for c, alpha, _ in of_these]
        (told, told_arrow), (enters, enters_arrow) = fields(_TOLD, numbers), fields(_ENTERS, numbers)
        ends = rows.sortWithinPartitions(key, BLOCK, order).drop(*[c for c in (order, *keep) if c != key]).mapInArrow(scan(alphas, told_arrow), told)
        carry = ends.where(F.col(BLOCK).isNotNull()).repartition(key).sortWithinPartitions(key, BLOCK).mapInArrow(_carries(key, alphas, adjust, enters_arrow), enters)
        return carry.select(F.struct(key, BLOCK).alias("_each"), *enters_arrow.names[2:])

    def beside(carry: DataFrame) -> DataFrame:
        return dealt.join(carry.hint("shuffle_hash"), each == F.col("_each"), "left").drop("_each")  # a row a block: no reason to sort the rows for it

    carry = entering(dealt, lambda alphas, told: _summaries(key, alphas, adjust, told), specs, range(len(specs)))
    if not of:
        scan = _rows(key, kept, specs, adjust, doubles(made))
    else:
        first, further = _rows(key, [key, BLOCK], specs, adjust, doubles(made)), range(len(specs), len(specs) + len(second))
        lines = _differences(pairs, [key, BLOCK])

        def through(alphas: list[tuple[str, float]], told: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
            summaries = _summaries(key, alphas, adjust, told)
            return lambda batches: summaries(lines(first(batches)))

        carry = carry.join(entering(beside(carry), through, second, further), "_each", "left")
        enters2 = [f"_{n}{i}" for i in further for n in _ENTERS]
        means, differ, last = _rows(key, [*kept, *enters2], specs, adjust, doubles(made)), _differences(pairs, [*kept, *made, *enters2]), _rows(key, [*kept, *made], second, adjust, doubles(of), len(specs))
        scan = lambda batches: last(differ(means(batches)))
    shown = ", ".join([*[f"`{c}` {kinds[c]}" for c in kept], *[f"`{n}` double" for n in [*made, *of]]])
    return beside(carry).sortWithinPartitions(key, BLOCK, order).mapInArrow(scan, shown)
