"""Statistics of whole series, many series at a time, on Arrow batches.

Spark partitions the rows by series, sorts them and numbers them (``row_number`` in the series
window); a task then reads its sorted rows batch by batch and computes lags, rolling statistics,
moving averages and fills on the arrays of all series in a batch at once.  Spark's window operator
evaluates every function row by row, about 0.5 microseconds each, and there are some 200 of them
in the feature catalogue.

A series is held whole in its task: callers bound its length (daily bars: one row per calendar
day).  Raw-row series, which have no such bound, are cut into chunks first (``windows.by_chunk``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

RADIX = 4                # rows of a level's window / rows of the window one level below
FLAT = 1e-14             # a deviation below this share of the mean is rounding: 0
TOL = 1e-18              # moving averages: weight of what is left out


def whole_series(batches: Iterator, at: str) -> Iterator:
    """The rows of ``batches`` again, cut so that no series is divided; ``at`` is its row's number, from 1."""
    import numpy as np
    import pyarrow as pa
    held, last = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        number = batch.column(at).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(number == 1)
        if not ((number == 1) | (number == np.append(last, number[:-1]) + 1)).all():
            raise ValueError("the rows are not in order of their series")
        last = number[-1]
        if not len(starts):
            held.append(batch)
            continue
        cut = int(starts[-1])
        done = held + ([batch.slice(0, cut)] if cut else [])
        if done:
            yield pa.concat_batches(done)
        held = [batch.slice(cut)]
    if held:
        yield pa.concat_batches(held)


def levels_for(span: int, tol: float = TOL) -> int:
    beta = 1.0 - 2.0 / (span + 1.0)
    need = math.log(tol) / math.log(beta)          # rows until beta^rows < tol
    return max(1, math.ceil(math.log(need, 4)))


class SeriesArrays:
    """Columns of the series in a batch as arrays, and statistics of them.

    A value is (array, run): ``run`` counts the non-null rows up to each row without a gap, so a
    window of the last n rows is complete where run >= n.  What lies outside complete windows is
    arbitrary in the array.
    """

    def __init__(self, batch, number: str):
        import numpy as np
        self.batch = batch
        self.pos = batch.column(number).to_numpy(zero_copy_only=False).astype(np.int64) - 1
        self.rows = np.arange(len(self.pos))
        self.values: dict[str, tuple] = {}
        self.kept: dict[tuple, object] = {}

    def value(self, c: str) -> tuple:
        import numpy as np
        if c not in self.values:
            column = self.batch.column(c)
            run = self.pos + 1
            if column.null_count:
                valid = column.is_valid().to_numpy(zero_copy_only=False)
                gap = np.maximum.accumulate(np.where(valid, -1, self.rows))
                run = np.minimum(run, self.rows - gap)
            self.values[c] = (column.to_numpy(zero_copy_only=False).astype(np.float64), run)
        return self.values[c]

    def back(self, x, k: int):
        """``x`` as of ``k`` rows earlier."""
        import numpy as np
        if not k:
            return x
        out = np.full_like(x, 0)
        if k < len(x):
            out[k:] = x[:-k]
        return out

    def _level(self, c: str, kind: str, size: int, k: int = 0):
        """Sum (s), squares around the mean (q), minimum (lo) or maximum (hi) of the ``size`` rows that end
        ``k`` rows back, built from windows of a quarter of the rows."""
        import numpy as np
        name = (c, kind, size, k)
        if name in self.kept:
            return self.kept[name]
        if k:
            out = self.back(self._level(c, kind, size), k)
        elif size == 1:
            x = self.value(c)[0]
            out = 0.0 * x if kind == "q" else x
        else:
            part = size // RADIX
            at = [i * part for i in range(RADIX)]
            if kind == "s":
                s = [self._level(c, "s", part, a) for a in at]
                out = (s[0] + s[1]) + (s[2] + s[3])
            elif kind == "q":
                out = _merged([self._level(c, "q", part, a) for a in at], [self._level(c, "s", part, a) for a in at],
                              [part] * RADIX, self._level(c, "s", size) / float(size))
            else:
                pick, ends = (np.fmin if kind == "lo" else np.maximum), [self._level(c, kind, part, a) for a in at]
                out = pick(pick(ends[0], ends[1]), pick(ends[2], ends[3]))
        self.kept[name] = out
        return out

    def _parts(self, n: int, shift: int = 0) -> list[tuple[int, int]]:
        """The last ``n`` rows as (size, rows back), the largest first."""
        size, parts, at = RADIX ** int(math.log(n, RADIX) + 1e-9), [], shift
        while n:
            while size > n:
                size //= RADIX
            parts.append((size, at))
            at, n = at + size, n - size
        return parts

    def rolling(self, c: str, n: int, fn: str, shift: int = 0) -> tuple:
        """Statistic of the last ``n`` rows as of ``shift`` rows earlier and where it is valid."""
        import numpy as np
        run = self.value(c)[1]
        valid = (self.back(run, shift) >= n) & (self.pos >= shift)
        if fn in ("min", "max"):
            kind, pick = ("lo", np.fmin) if fn == "min" else ("hi", np.maximum)
            size = RADIX ** int(math.log(n, RADIX) + 1e-9)
            ends = [self._level(c, kind, size, k + shift) for k in [*range(0, n - size, size), n - size]]
            out = ends[0]
            for e in ends[1:]:
                out = pick(out, e)
            return out, valid
        parts = self._parts(n, shift)
        total, *others = [self._level(c, "s", size, k) for size, k in parts]
        for s in others:
            total = total + s
        mean = total / float(n)
        if fn == "mean":
            return mean, valid
        if fn == "sum":
            return mean * float(n), valid
        if n == 1:
            return mean, np.zeros(len(mean), bool)
        q = _merged([self._level(c, "q", size, k) for size, k in parts],
                    [self._level(c, "s", size, k) for size, k in parts], [size for size, _ in parts], mean)
        deviation = np.sqrt(q / float(n - 1))
        return np.where(deviation <= np.abs(mean) * FLAT, 0.0, deviation), valid

    def lag(self, c: str, k: int) -> tuple:
        x, run = self.value(c)
        return self.back(x, k), (self.pos >= k) & (self.back(run, k) > 0)

    def ema(self, c: str, span: int, tol: float = TOL) -> tuple:
        """y_0 = x_0, y_t = b y_{t-1} + a x_t by recursive quadrupling; see ``ema``."""
        import numpy as np
        x, run = self.value(c)
        x0 = x[self.rows - self.pos]
        b = (2.0 / (span + 1.0)) * x
        for level in range(levels_for(span, tol)):
            d = 4 ** level
            beta_d = (1.0 - 2.0 / (span + 1.0)) ** d
            start = x0 * (1.0 - beta_d)
            total = b
            for k in (1, 2, 3):
                total = total + beta_d ** k * np.where(self.pos >= k * d, self.back(b, k * d), start)
            b = total
        return b, run > self.pos

    def minus(self, a: str, b: str) -> tuple:
        (x, m), (y, n) = self.value(a), self.value(b)
        import numpy as np
        return x - y, np.minimum(m, n) > 0

    def add(self, name: str, c: str, n, fn: str, *more):
        """Compute one statistic as an Arrow array; later ones may build on averages and differences."""
        import pyarrow as pa
        if fn == "lag":
            out, valid = self.lag(c, n)
        elif fn == "ema":
            out, valid = self.ema(c, n, *more)
        elif fn == "minus":
            out, valid = self.minus(c, n)
        else:
            out, valid = self.rolling(c, n, fn, *more)
        if fn in ("ema", "minus"):
            self.values[name] = (out, (self.pos + 1) * valid)
        return pa.array(out, mask=~valid) if not valid.all() else pa.array(out)


def _merged(squares: list, sums: list, sizes: list[int], mean):
    """Sum of squares around ``mean`` of parts with their own sums and sums of squares."""
    total = None
    for q, s, n in zip(squares, sums, sizes):
        apart = s / float(n) - mean
        part = q + float(n) * apart * apart
        total = part if total is None else total + part
    return total


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` with the row's number in its series, in a task per part of the series and in order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def with_statistics(df: DataFrame, wanted: dict[str, tuple], number: str) -> DataFrame:
    """``df`` with a double column per name of ``wanted``, name -> (column, n, fn, ...):

    * (c, n, "mean" | "std" | "sum" | "min" | "max"): of the last n rows, NULL unless all are non-null;
      (c, n, "mean", k): as of k rows earlier;
    * (c, k, "lag"): the value k rows earlier;
    * (c, span, "ema") or (c, span, "ema", tol): moving average of a column without NULLs;
    * (a, b, "minus"): difference of two columns, also of averages named before.

    ``df`` comes straight from ``numbered`` (or a window of the same keys and order) and projections:
    its rows are in order and ``number`` is their number in the series.
    """
    before = df.columns

    def run(batches):
        import numpy as np
        import pyarrow as pa
        with np.errstate(all="ignore"):
            for batch in whole_series(batches, number):
                s = SeriesArrays(batch, number)
                new = [s.add(name, *spec) for name, spec in wanted.items()]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*before, *wanted])

    schema = StructType([*df.schema.fields, *[StructField(name, DoubleType()) for name in wanted]])
    return df.mapInArrow(run, schema)


def cells(array):
    """The values of an Arrow array of equally long lists of doubles, and where they are valid: one row of
    the matrices per place in the list."""
    import numpy as np
    n, flat = len(array), array.flatten()
    width = len(flat) // n
    valid = flat.is_valid().to_numpy(zero_copy_only=False).reshape(n, width) if flat.null_count else None
    # copies: Arrow's own memory is read-only
    return np.array(flat.to_numpy(zero_copy_only=False).reshape(n, width).T, order="C"), (
        np.ones((width, n), bool) if valid is None else np.ascontiguousarray(valid.T))


def packed(df: DataFrame, columns: Sequence[str], number: str | None, others: Sequence[str], name: str = "__cells") -> DataFrame:
    """``others`` (with ``number``, if any, first) and ``columns`` as one array of doubles, for Python: Spark looks
    at every field for every row it hands over."""
    # Spark fuses a plain projection into one method, which the JVM interprets when it is as long as this one;
    # beside a higher-order function every expression is compiled on its own
    apart = lambda c: F.transform(F.array(c), lambda x: x)[0]
    first = [apart(F.col(number)).alias(number)] if number else [apart(F.lit(0)).alias("__apart")]
    return df.select(*first, *[F.col(f"`{c}`") for c in others],
                     F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias(name))


def matrices(batches: Iterator) -> Iterator:
    """(matrix, batch) per batch of ``packed`` rows: a row of the matrix per column, NaN where it is NULL."""
    import numpy as np
    for batch in batches:
        if batch.num_rows:
            x, valid = cells(batch.column("__cells"))
            x[~valid] = np.nan
            yield x, batch


def over_cells(rows, columns: Sequence[str], fn, schema: str, others: Sequence[str] = ()) -> DataFrame:
    """What ``fn`` yields in each task from its (matrix, batch) pairs: ``columns`` as a matrix, ``others`` in the batch.

    ``rows`` is a DataFrame, or a function of the other parameters that computes the columns in the same
    pass, so that they never leave the task (``features.feature_cells``)."""
    if not isinstance(rows, DataFrame):
        return rows(columns, fn, schema, others)
    return packed(rows, columns, None, others).mapInArrow(lambda batches: fn(matrices(batches)), schema)


def _filled(batches: Iterator, number: str, back: bool) -> Iterator:
    """(matrix, batch) of whole series with the gaps of every column filled."""
    import numpy as np
    for batch in whole_series(batches, number):
        pos = batch.column(number).to_numpy(zero_copy_only=False).astype(np.int64) - 1
        rows = np.arange(len(pos))
        first = rows - pos
        starts = np.flatnonzero(pos == 0)
        end = np.repeat(np.append(starts[1:], len(rows)), np.diff(np.append(starts, len(rows))))
        values, valid = cells(batch.column("__cells"))
        sources: dict[bytes, tuple] = {}
        for x, known in zip(values, valid):
            if known.all():
                continue
            gaps = np.packbits(known).tobytes()
            if gaps not in sources:
                last = np.maximum.accumulate(np.where(known, rows, -1))
                inside = last >= first
                # the next known row, where none came before, is the first of the series
                after = np.minimum.accumulate(np.where(known, rows, len(rows))[::-1])[::-1]
                follows = (after < end) & back
                to = np.flatnonzero(~known)
                sources[gaps] = (to, np.where(inside, last, np.where(follows, after, 0))[to], ~(inside | follows)[to])
            to, at, none = sources[gaps]
            x[to] = np.where(none, 0.0, x[at])
        yield values, batch


def filled(df: DataFrame, columns: Sequence[str], number: str, back: bool = True) -> DataFrame:
    """``df`` with ``columns`` (doubles) filled forward, then (``back``) by the first value of the series, then
    by 0.  Rows come as for ``with_statistics``; columns of the same gaps share one computation."""
    named = [c for c in df.columns if c in set(columns)]
    everything = df.columns
    if not named:
        return df

    def run(batches):
        import pyarrow as pa
        for values, batch in _filled(batches, number, back):
            known = dict(zip(named, values))
            yield pa.RecordBatch.from_arrays([pa.array(known[c]) if c in known else batch.column(c) for c in everything],
                                             everything)

    rows = packed(df, named, number, [c for c in everything if c not in {*named, number}])
    # back as columns of their own, which needs no expression for each
    return rows.mapInArrow(run, StructType([StructField(c, DoubleType()) if c in set(named) else df.schema[c]
                                            for c in everything]))


def filled_cells(df: DataFrame, columns: Sequence[str], number: str, fn, schema: str, others: Sequence[str] = (),
                 back: bool = True) -> DataFrame:
    """What ``fn`` yields in each task from the (matrix, batch) pairs of ``columns`` filled as by ``filled``."""
    return packed(df, columns, number, others).mapInArrow(lambda batches: fn(_filled(batches, number, back)), schema)
