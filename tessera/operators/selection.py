"""Feature ranking and selection (K1-K3).

K1 comes in two forms, both on all rows.  ``knn_mutual_information`` is the
nearest-neighbour estimator of the reference.  ``binned_mutual_information``
is the cheap one, from an equal-width binning of each feature: (min, max) per
feature in one pass, then contingency counts of (feature, bin,
class) that each task sums before the shuffle.  Its numbers differ; the ranking
role is the same.

K2 multiplies the rows of each task around their means and merges the parts (a
single pass, numerically stable) and K3 works on the two small result tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MI_BINS = 20
LOW_MI = 0.001          # fixed values of the selection rule
CORR_LIMIT = 0.95
TOP_BY_MI = 85
MIN_KEEP = 70
ALWAYS_KEEP = "ticker_mean_return_30d"


def long_format(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot a few columns to (keep..., feature, x)."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])
    return wide.unpivot(list(keep), list(features), "feature", "x")


def _moments(matrices):
    """Count, mean, sum of squares around it, minimum and maximum per column of the task's rows."""
    import numpy as np
    import pyarrow as pa
    n = 0
    for x, _ in matrices:
        m, mean, lo, hi = _centred(x)
        if np.isnan(lo).any():
            raise ValueError("a NULL or NaN among the columns to summarise")
        m2 = (x ** 2).sum(1)
        if not n:
            n, to, total, low, high = m, mean, m2, lo, hi
            continue
        apart = mean - to
        total = total + m2 + apart ** 2 * (n * m / (n + m))
        to, n = to + apart * (m / (n + m)), n + m
        low, high = np.minimum(low, lo), np.maximum(high, hi)
    if n:
        k = len(to)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(np.full(k, n)), pa.array(to), pa.array(total),
                                          pa.array(low), pa.array(high)], ["f", "n", "mean", "m2", "lo", "hi"])


def _centred(x) -> tuple:
    """Subtract its mean from every row of ``x``; (columns, means, minima, maxima).  Constant rows become 0."""
    lo, hi = x.min(1), x.max(1)
    first = x[:, 0].copy()
    x -= first[:, None]
    mean = x.mean(1)
    x -= mean[:, None]
    return x.shape[1], first + mean, lo, hi


MOMENTS = "f long, n long, mean double, m2 double, lo double, hi double"


def column_moments(rows, features: Sequence[str]) -> DataFrame:
    """(f, n, mean, m2, lo, hi), f the number of the column from 0: rows, mean, sum of squares around it, least
    and greatest value, in one pass over ``rows`` (a DataFrame or ``feature_cells``); each task hands on one row per
    column.  A NULL or NaN fails the job."""
    from tessera.operators.series import over_cells
    return merged_moments(over_cells(rows, features, _moments, MOMENTS))


def merged_moments(parts: DataFrame) -> DataFrame:
    """The moments of all rows from those of each task."""
    w = Window.partitionBy("f")
    to = F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w)
    return (parts.withColumn("_to", to).groupBy("f")
            .agg(F.sum("n").alias("n"), F.first("_to").alias("mean"),
                 F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_to")) * (F.col("mean") - F.col("_to"))).alias("m2"),
                 F.min("lo").alias("lo"), F.max("hi").alias("hi")))


def feature_ranges(rows, features: Sequence[str]) -> dict[str, tuple]:
    got = {r["f"]: (r["lo"], r["hi"]) for r in column_moments(rows, features).collect()}
    return {c: got.get(i, (None, None)) for i, c in enumerate(features)}


def _bin_counts(ranges: list[tuple], bins: int, target: str):
    """Contingency counts of (feature, bin, class) per task: one row per cell, not per value."""
    import numpy as np
    import pyarrow as pa
    lo = np.array([0.0 if a is None else a for a, _ in ranges])
    width = np.array([0.0 if b is None else (b - a) / bins for a, b in ranges])

    def count(matrices):
        found = {}
        for x, batch in matrices:
            y = np.asarray(batch.column(target).cast(pa.int64(), safe=False))
            at = np.zeros(x.shape, np.int64)
            wide = width > 0
            at[wide] = np.minimum(np.floor((x[wide] - lo[wide, None]) / width[wide, None]), bins - 1).astype(np.int64)
            at += (np.arange(len(x)) * bins)[:, None]
            for k in np.unique(y).tolist():
                n = np.bincount(at[:, y == k].ravel(), minlength=len(x) * bins)
                found[k] = found.get(k, 0) + n
        for k, n in found.items():
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(hit // bins), pa.array(hit % bins),
                                              pa.array(np.full(len(hit), k)), pa.array(n[hit])],
                                             ["f", "bin", "y", "n"])
    return count


def binned_mutual_information(rows, features: Sequence[str], target: str = "target",
                              bins: int = MI_BINS, ranges: dict[str, tuple] | None = None) -> DataFrame:
    """K1: (feature, mutual_info) in nats from equal-width bins.

    Two passes over ``rows`` (ranges, unless they are known, then counts).  Each task counts its rows
    into one array of #features x #bins per class; only those counts are shuffled.
    """
    from tessera.operators.series import over_cells
    rng = feature_ranges(rows, features) if ranges is None else ranges
    partial = over_cells(rows, features, _bin_counts([rng[c] for c in features], bins, target),
                         "f long, bin long, y long, n long", [target])
    counts = partial.groupBy("f", "bin", "y").agg(F.sum("n").alias("n"))
    n = F.sum("n").over(Window.partitionBy("f")).cast("double")
    nb = F.sum("n").over(Window.partitionBy("f", "bin")).cast("double")
    ny = F.sum("n").over(Window.partitionBy("f", "y")).cast("double")
    c = F.col("n").cast("double")
    term = (c / n) * F.log(c * n / (nb * ny))
    name = F.element_at(F.array(*[F.lit(x) for x in features]), (F.col("f") + 1).cast("int"))
    # rounded so that exactly duplicated features tie (then list order decides)
    return (counts.select("f", term.alias("t")).groupBy("f").agg(F.sum("t").alias("mi"))
            .select(name.alias("feature"), (F.round("mi", 12) + F.lit(0.0)).alias("mutual_info")))


MI_NEIGHBOURS = 3
MAX_CLASSES = 1000


def digamma(m, log=F.log):
    """The digamma function of whole numbers from 1 (a column, or a float with ``math.log``)."""
    z = m + 10.0
    r = 1.0 / (z * z)
    tail = r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132))))
    return log(z) - 0.5 / z - tail - sum(1.0 / (m + float(i)) for i in range(10))


def _with_radius(near: DataFrame, k: int, wanted) -> DataFrame:
    """``near`` with d, the distance of the ``wanted``-th neighbour (at most ``k``) of a distinct value
    ``x`` of ``n`` copies, and with the open interval (lo, hi) that it bounds; ``lx1``, ``ln1``, ``rx1``, ...
    are the next distinct values on both sides and their copies."""
    x, zero = F.col("x"), F.lit(0).cast("long")
    apart = {s: [F.lit(0.0)] + [F.abs(x - F.col(f"{s}x{j}")) for j in range(1, k + 1)] for s in "lr"}
    copies = {"l": [zero], "r": [zero]}
    for s, sums in copies.items():
        for j in range(1, k + 1):
            sums.append(sums[-1] + F.col(f"{s}n{j}"))
    # i values to the left and j to the right suffice; each has a copy or more, so i + j <= k
    reach = [F.when(F.col("n") - 1 + copies["l"][i] + copies["r"][j] >= wanted,
                    F.greatest(apart["l"][i], apart["r"][j])) for i in range(k + 1) for j in range(k + 1 - i)]
    # the neighbour's own value bounds its side, so that no rounding of x +- d moves it in or out
    end = lambda s, far: F.coalesce(*[F.when(apart[s][j] == F.col("d"), F.col(f"{s}x{j}"))
                                      for j in range(1, k + 1)], far)
    return near.withColumn("d", F.least(*reach)).select("feature", "y", "x", "n", "todo", "d", end("l", x - F.col("d")).alias("lo"),
                                                        end("r", x + F.col("d")).alias("hi"))


BLOCK_ROWS = 1 << 17     # values of a block, settled on arrays
RANGE_ROWS = 1 << 20     # rows of a feature that are sorted in one task
PIECE_CELLS = 1 << 22    # values that a task sorts before it hands them on
CELLS_AT_ONCE = 1 << 27  # values on disk at once: about 1 GB, sorted and then in blocks


def _inside(x, y, n, k: int, wanted):
    """Of a block's values ``x`` in order, with class ``y`` and copies ``n``: the numbers of those that have ``k``
    distinct values of their class on both sides in the block, and m of each; then the numbers of the first and
    last 2 ``k`` of each class.  Same steps as ``_with_radius``."""
    import numpy as np
    by = np.argsort(y, kind="stable")
    xs, ns = x[by], n[by]
    new = np.append(True, y[by][1:] != y[by][:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(x)))
    at = np.arange(len(x)) - np.repeat(starts, sizes)
    after = np.repeat(sizes, sizes) - 1 - at
    edge = by[(at < 2 * k) | (after < 2 * k)]
    i = np.flatnonzero((at >= k) & (after >= k))
    near = {"l": [xs[i - j] for j in range(k + 1)], "r": [xs[i + j] for j in range(k + 1)]}
    apart = {s: [np.zeros(len(i))] + [np.abs(xs[i] - v) for v in values[1:]] for s, values in near.items()}
    copies = {"l": [np.zeros(len(i), np.int64)], "r": [np.zeros(len(i), np.int64)]}
    for j in range(1, k + 1):
        copies["l"].append(copies["l"][-1] + ns[i - j])
        copies["r"].append(copies["r"][-1] + ns[i + j])
    least = wanted[y[by][i]]
    d = np.full(len(i), np.nan)
    for a in range(k + 1):
        for b in range(k + 1 - a):
            reach = np.maximum(apart["l"][a], apart["r"][b])
            d = np.fmin(d, np.where(ns[i] - 1 + copies["l"][a] + copies["r"][b] >= least, reach, np.nan))
    lo, hi = xs[i] - d, xs[i] + d
    for j in range(k, 0, -1):
        lo = np.where(apart["l"][j] == d, near["l"][j], lo)
        hi = np.where(apart["r"][j] == d, near["r"][j], hi)
    sums = np.append(0, np.cumsum(n))
    up_to = lambda v, side: sums[np.searchsorted(x, v, side)]
    m = np.where(d > 0, up_to(hi, "left") - up_to(lo, "right"), up_to(xs[i], "right") - up_to(xs[i], "left"))
    todo = np.ones(len(x), bool)
    todo[by[i]] = False
    return by[i], m, edge, todo


def _planes(values) -> bytes:
    """Eight-byte numbers as bytes, all first bytes first: neighbours in order share most of them, which compresses."""
    import numpy as np
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(data: bytes, kind):
    """The numbers of ``_planes``."""
    import numpy as np
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _runs(*columns):
    """Where rows of the sorted ``columns`` differ from the one before."""
    import numpy as np
    return np.flatnonzero(np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])))


_PIECE = "feature int, place int, x binary, y binary, n binary"


def _pieces(target: str, classes, bounds: list, piece_cells: int = PIECE_CELLS):
    """Values of a task in order, a row per feature and range: distinct values by class, (class, how many) pairs
    and the copies of each, unless all are single.  ``bounds`` are the upper ends of a feature's ranges."""
    import numpy as np
    offsets = np.cumsum([0, *[len(b) + 1 for b in bounds]])

    def cut(held):
        import pyarrow as pa
        y = np.concatenate([y for _, y in held])
        for f in range(len(bounds)):
            x = np.concatenate([x[f] for x, _ in held]) + 0.0
            if np.isnan(x).any():
                raise ValueError("mutual information needs a value in every row")
            by = np.argsort(x)
            x, of = x[by], y[by]
            ends = np.append(np.searchsorted(x, bounds[f], "left"), len(x))
            rows = {c: [] for c in ("feature", "place", "x", "y", "n")}
            for r, (a, b) in enumerate(zip(np.append(0, ends[:-1]), ends)):
                if a == b:
                    continue
                order = a + np.argsort(of[a:b], kind="stable")
                xs, ys = x[order], of[order]
                first = _runs(ys, xs)
                xs, ys, n = xs[first], ys[first], np.diff(np.append(first, b - a))
                seen, many = np.unique(ys, return_counts=True)
                for c, v in (("feature", f), ("place", int(offsets[f] + r)), ("x", _planes(xs)),
                             ("y", np.stack([seen, many]).astype(np.int64).tobytes()),
                             ("n", None if len(xs) == b - a else _planes(n.astype(np.int64)))):
                    rows[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["feature"], pa.int32()), pa.array(rows["place"], pa.int32()),
                 *[pa.array(rows[c], pa.binary()) for c in ("x", "y", "n")]], list(rows))

    def run(matrices):
        import pyarrow as pa
        import pyarrow.compute as pc
        held, n = [], 0
        for x, batch in matrices:
            number = pc.index_in(batch.column(target), value_set=pa.array(classes, batch.column(target).type))
            takes = number.is_valid().to_numpy(zero_copy_only=False)
            y = number.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int32)
            held.append((x, y) if takes.all() else (x[:, takes], y[takes]))
            n += held[-1][0].size
            if n >= piece_cells:
                yield from cut(held)
                held, n = [], 0
        if n:
            yield from cut(held)
    return run


def _points(most: int):
    """Per column, up to ``most`` values of the task at even distances in their order, and the task's rows."""
    def run(matrices):
        import numpy as np
        import pyarrow as pa
        held = [x for x, _ in matrices]
        if held:
            x = np.sort(np.concatenate(held, axis=1), axis=1)
            at = np.linspace(0, x.shape[1] - 1, min(most, x.shape[1])).round().astype(int)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), pa.array(np.full(len(x), x.shape[1])),
                                              pa.array(x[:, at].tolist())], ["f", "rows", "x"])
    return run


def range_bounds(sample, features: Sequence[str], rows: int, range_rows: int = RANGE_ROWS) -> list:
    """Per feature the values that cut its ``rows`` values into ranges of about ``range_rows``, from the rows that
    ``sample`` (of a share of them) gives.  Ranges decide where values are sorted, never what comes of them."""
    import numpy as np

    from tessera.operators.series import over_cells
    ranges = -(-rows // range_rows)
    if ranges == 1:
        return [np.zeros(0) for _ in features]
    share, found, seen = 2000 * ranges / rows, [], 0
    while seen < 200 * ranges:
        found = over_cells(sample(min(share, 1.0)), features, _points(4 * max(ranges, 16)),
                           "f long, rows long, x array<double>").collect()
        seen = sum(r["rows"] for r in found if r["f"] == 0)
        if share >= 1.0:
            break
        share *= 8
    out = []
    for f in range(len(features)):
        points = [(np.array(r["x"]), r["rows"]) for r in found if r["f"] == f]
        x = np.concatenate([p for p, _ in points] or [np.zeros(0)])
        weight = np.concatenate([np.full(len(p), n / len(p)) for p, n in points] or [np.zeros(0)])
        by = np.argsort(x)
        x, up_to = x[by], np.cumsum(weight[by])
        cuts = np.searchsorted(up_to, up_to[-1] * np.arange(1, ranges) / ranges) if len(x) else []
        out.append(np.unique(x[cuts]) if len(x) else x)
    return out


_BLOCK = ("feature int, block long, first double, total long, settled double, "
          "edge array<struct<y: int, x: double, n: long, todo: boolean>>, x binary, up_to binary")


def _blocks(k: int, wanted, size: int):
    """The pieces of a feature's range merged and cut into blocks of about ``size`` values, a row each: what is
    settled inside the block, its values at the edges, and the values with the counts up to each."""
    import numpy as np

    def merged(pieces):
        """Values in order, classes and copies of the pieces of one range, equal rows as one."""
        x = np.concatenate([_numbers(p["x"], np.float64) for p in pieces])
        of = [np.frombuffer(p["y"], np.int64).reshape(2, -1) for p in pieces]
        y = np.concatenate([np.repeat(seen, many) for seen, many in of]).astype(np.int32)
        n = np.concatenate([np.ones(int(many.sum()), np.int64) if p["n"] is None else _numbers(p["n"], np.int64)
                            for p, (_, many) in zip(pieces, of)])
        by = np.argsort(y, kind="stable")
        by = by[np.argsort(x[by], kind="stable")]
        x, y, n = x[by], y[by], n[by]
        first = _runs(x, y)
        return x[first], y[first], np.add.reduceat(n, first)

    def cuts(x) -> list[int]:
        """Where to cut; equal values stay together."""
        starts, at = np.append(_runs(x), len(x)), [0]
        while at[-1] < len(x):
            at.append(int(starts[min(np.searchsorted(starts, at[-1] + size), len(starts) - 1)]))
        return at

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        names = ["feature", "block", "first", "total", "settled", "edge", "x", "up_to"]

        def block(f, x, y, n):
            inside, m, edge, todo = _inside(x, y, n, k, wanted)
            settled = float((n[inside] * digamma(m.astype(np.float64), np.log)).sum())
            up_to = np.cumsum(n)
            edge = pa.StructArray.from_arrays([pa.array(y[edge], pa.int32()), pa.array(x[edge]), pa.array(n[edge]),
                                               pa.array(todo[edge])], ["y", "x", "n", "todo"])
            return pa.RecordBatch.from_arrays(
                [pa.array([f], pa.int32()), pa.array([number], pa.int64()), pa.array([x[0]]), pa.array([up_to[-1]], pa.int64()),
                 pa.array([settled]), pa.ListArray.from_arrays(pa.array([0, len(edge)], pa.int32()), edge),
                 pa.array([_planes(x)], pa.binary()),
                 pa.array([None if up_to[-1] == len(x) else _planes(up_to)], pa.binary())], names)

        ranges: dict[int, list] = {}
        for batch in batches:
            for piece in batch.to_pylist():
                ranges.setdefault(piece["place"], []).append(piece)
        for place in sorted(ranges):
            f = ranges[place][0]["feature"]
            x, y, n = merged(ranges.pop(place))
            at = cuts(x)
            for a, b in zip(at, at[1:]):
                number += 1
                yield block(f, x[a:b], y[a:b], n[a:b])
    return run


def _counted(batches):
    """Ends of intervals in a block, with the count of the block's values below each."""
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        for i in range(batch.num_rows):
            ends = batch.column(0).slice(i, 1).flatten()
            x, up_to = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
            x = _numbers(x, np.float64)
            up_to = np.append(0, np.arange(1, len(x) + 1) if up_to is None else _numbers(up_to, np.int64))
            v, kind = ends.field("v").to_numpy(), ends.field("kind").to_numpy()
            below = np.where(kind == 2, np.searchsorted(x, v, "right"), np.searchsorted(x, v, "left"))
            yield pa.RecordBatch.from_arrays([*[ends.field(c) for c in ("feature", "y", "x", "n", "sign")],
                                              pa.array(ends.field("before").to_numpy() + up_to[below])],
                                             ["feature", "y", "x", "n", "sign", "c"])


def knn_mutual_information(rows, features: Sequence[str], target: str = "target", k: int = MI_NEIGHBOURS,
                           chunk_rows: int = BLOCK_ROWS, labels: DataFrame | None = None, sample=None,
                           range_rows: int = RANGE_ROWS, cells_at_once: int = CELLS_AT_ONCE) -> DataFrame:
    """K1 by nearest neighbours: (feature, mutual_info) in nats between a continuous feature and a class.

    For a value with class c, d is the distance of its ``k``-th neighbour among the values of c (all of
    them, where c has no more) and m the number of values of any class nearer than d, itself
    included; the estimate is psi(N) + mean psi(k) - mean psi(N_c) - mean psi(m), at least 0.  Values
    are not disturbed by noise: where the k-th neighbour has the same value, m counts the equal ones.

    Features are taken so many at a time that about ``cells_at_once`` values are on disk, and what was written for
    them is removed before the next ones.  ``rows`` is a DataFrame or ``feature_cells``, which compute only
    the features of the turn; then ``labels`` has the target of the same rows, and ``sample`` gives some
    share of them (see ``range_bounds``).

    Each task sorts its values and hands on a row per feature and range with all of them, rows equal in
    feature, value and class counted.  A range of about ``range_rows`` is merged in one task and cut into blocks of
    about ``chunk_rows``.  A value with ``k`` distinct values of its class on both sides in its block has
    its whole interval there: m comes from arrays.  The others, at most 2 ``k`` a class and block, find
    their neighbours by ``lag`` and ``lead`` over the edges of all blocks, and the ends of their intervals
    are counted in the blocks that hold them.  So neither a feature nor a class meets in one task.
    Classes of one row, and rows without a class, take no part; a NULL or NaN value fails the job;
    without rows the result is empty.
    """
    from tessera.session import intermediates
    if isinstance(rows, DataFrame):
        labels, sample = rows, lambda share: rows.sample(share, seed=1)
    spark = labels.sparkSession
    found = (labels.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("y")).agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1).limit(MAX_CLASSES + 1).collect())
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    sizes = {r["y"]: r["n"] for r in found}
    out = []
    if sizes:
        turn = max(1, cells_at_once // sum(sizes.values()))
        for i in range(0, len(features), turn):
            some = list(features[i:i + turn])
            with intermediates(spark):
                bounds = range_bounds(sample, some, sum(sizes.values()), range_rows)
                out += _knn_estimates(rows, some, target, k, chunk_rows, sizes, bounds).collect()
    return spark.createDataFrame(out, "feature string, mutual_info double")


def _knn_estimates(rows, features: Sequence[str], target: str, k: int, chunk_rows: int, sizes: dict, bounds: list) -> DataFrame:
    """One turn of ``knn_mutual_information``: ``sizes`` are the rows of each class, ``bounds`` those of the ranges."""
    import math

    import numpy as np

    from tessera.operators.ranges import carry
    from tessera.operators.series import over_cells
    from tessera.operators.windows import by_chunk
    from tessera.session import materialize
    total = sum(sizes.values())
    psi = lambda m: digamma(float(m), math.log)
    fixed = psi(total) + sum(n * (psi(min(k, n - 1)) - psi(n)) for n in sizes.values()) / total
    least = np.array([min(k, n - 1) for n in sizes.values()])
    wanted = F.lit(k)
    for y in np.flatnonzero(least < k).tolist():
        wanted = F.when(F.col("y") == y, F.lit(int(least[y]))).otherwise(wanted)

    # features and classes by number
    pieces = over_cells(rows, features, _pieces(target, list(sizes), bounds), _PIECE, [target])
    placed = pieces.repartitionById(sum(len(b) + 1 for b in bounds), "place")
    blocks = materialize(placed.mapInArrow(_blocks(k, least, chunk_rows), _BLOCK))

    beside = lambda w: [step(c, j).over(w).alias(f"{s}{c}{j}")
                        for s, step in (("l", F.lag), ("r", F.lead)) for c in ("x", "n") for j in range(1, k + 1)]
    edges = blocks.select("feature", F.inline("edge"))
    near = by_chunk(edges, lambda w: [F.col("n"), F.col("todo"), *beside(w)], ["feature", "y"], ["x"], k, k)
    near = _with_radius(near, k, wanted).where("todo")
    # counts of smaller values (0) or of values up to it (2) at both ends
    apart = F.col("d") > 0
    end = lambda v, kind, sign: F.struct(v.alias("v"), kind.alias("kind"), F.lit(sign).alias("sign"))
    ends = near.withColumn("_e", F.explode(F.array(
        end(F.when(apart, F.col("hi")).otherwise(F.col("x")), F.when(apart, 0).otherwise(2), 1),
        end(F.when(apart, F.col("lo")).otherwise(F.col("x")), F.when(apart, 2).otherwise(0), -1))))
    ends = ends.select("feature", "y", "x", "n", "_e.v", "_e.kind", "_e.sign")
    # the last block that starts before an end holds it
    before = F.coalesce(F.sum("total").over(Window.partitionBy("feature").orderBy("first").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("feature", F.col("first").alias("v"), F.lit(1).alias("kind"),
                           F.struct("block", before.alias("before")).alias("at"))
    held = carry(ends.withColumn("at", F.lit(None).cast(starts.schema["at"].dataType))
                 .unionByName(starts, allowMissingColumns=True), "at", ["feature"], ["v", "kind"])
    asked = (held.where(F.col("sign").isNotNull() & F.col("at").isNotNull()).groupBy(F.col("at.block").alias("block"))
             .agg(F.collect_list(F.struct("feature", "y", "x", "n", "sign", "v", "kind", "at.before")).alias("ends")))
    # written, so that Spark knows its size: where it is small the blocks are not shuffled
    ranked = (materialize(asked).join(blocks.select("block", "x", "up_to"), "block").select("ends", "x", "up_to")
              .mapInArrow(_counted, "feature int, y int, x double, n long, sign int, c long"))
    counts = ranked.groupBy("feature", "y", "x").agg(F.sum(F.col("sign") * F.col("c")).alias("m"), F.first("n").alias("n"))
    terms = counts.select("feature", (F.col("n") * digamma(F.col("m").cast("double"))).alias("t")).unionByName(
        blocks.select("feature", F.col("settled").alias("t")))
    mean = F.sum("t") / F.lit(float(total))
    name = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("feature") + 1)
    # rounded so that exactly duplicated features tie
    return terms.groupBy("feature").agg((F.round(F.greatest(F.lit(fixed) - mean, F.lit(0.0)), 9) + F.lit(0.0))
                                        .alias("mutual_info")).select(name.alias("feature"), "mutual_info")


def _comoments(matrices):
    """Per pair i <= j of columns: the task's rows, their means and the sum of products around them; for a column
    with itself its minimum and maximum, too."""
    import numpy as np
    import pyarrow as pa
    n = 0
    for x, _ in matrices:
        m, mean, lo, hi = _centred(x)
        products = x @ x.T
        if not n:
            n, to, total, low, high = m, mean, products, lo, hi
            continue
        apart = mean - to
        total = total + products + np.outer(apart, apart) * (n * m / (n + m))
        to, n = to + apart * (m / (n + m)), n + m
        low, high = np.minimum(low, lo), np.maximum(high, hi)
    if n:
        i, j = np.triu_indices(len(to))
        own = lambda v: pa.array(v[i], mask=i != j)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(np.full(len(i), n)), pa.array(to[i]),
                                          pa.array(to[j]), pa.array(total[i, j]), own(low), own(high)],
                                         ["i", "j", "n", "a", "b", "c", "lo", "hi"])


def column_products(rows, features: Sequence[str]) -> DataFrame:
    """The co-moments of the columns per task (see ``_comoments``), from one pass, written once."""
    from tessera.operators.series import over_cells
    from tessera.session import materialize
    return materialize(over_cells(rows, features, _comoments,
                                  "i long, j long, n long, a double, b double, c double, lo double, hi double"))


def product_ranges(parts: DataFrame, features: Sequence[str]) -> dict[str, tuple]:
    """``feature_ranges`` from ``column_products``; a NULL or NaN among the values is an error."""
    import math
    # NaN is the greatest of doubles
    found = parts.where("i = j").groupBy("i").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    got = {r["i"]: (r["lo"], r["hi"]) for r in found}
    if any(math.isnan(hi) for _, hi in got.values()):
        raise ValueError("a NULL or NaN among the columns to summarise")
    return {c: got.get(i, (None, None)) for i, c in enumerate(features)}


def correlation_matrix(rows, features: Sequence[str], parts: DataFrame | None = None):
    """Pearson correlation matrix (numpy, #features^2) from one distributed pass (``parts``, unless it was
    made before): each task multiplies its own rows around their means, and the parts are merged
    around the means of all rows.  NaN for constant columns and for columns with a NULL or NaN."""
    import numpy as np

    parts = column_products(rows, features) if parts is None else parts
    w = Window.partitionBy("i", "j")
    mean = lambda c: F.sum(F.col("n") * F.col(c)).over(w) / F.sum("n").over(w)
    merged = (parts.withColumn("_a", mean("a")).withColumn("_b", mean("b")).groupBy("i", "j")
              .agg(F.sum("n").alias("n"), F.sum(F.col("c") + F.col("n") * (F.col("a") - F.col("_a")) * (F.col("b") - F.col("_b")))
                   .alias("c")))
    out = np.full((len(features), len(features)), np.nan)
    rows = 0
    for r in merged.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["c"]
        rows = r["n"]
    with np.errstate(all="ignore"):
        deviation = np.sqrt(np.diag(out))
        deviation[~(deviation / np.sqrt(max(rows - 1, 1)) > 1e-12)] = np.nan
        return out / np.outer(deviation, deviation)


def correlated_pairs(rows, features: Sequence[str], limit: float = CORR_LIMIT, parts: DataFrame | None = None) -> DataFrame:
    """K2: feature pairs (in list order) with |Pearson r| > limit (NaN, from a
    constant feature, never qualifies)."""
    import math
    m = correlation_matrix(rows, features, parts)
    found = []
    for i in range(len(features)):
        for j in range(i + 1, len(features)):
            r = float(m[i][j])
            if not math.isnan(r) and abs(r) > limit:
                found.append((features[i], features[j], i, j, abs(r)))
    schema = "feature1 string, feature2 string, i int, j int, correlation double"
    return SparkSession.active().createDataFrame(found, schema)


def select_features(mi: DataFrame, pairs: DataFrame, features: Sequence[str], low: float = LOW_MI,
                    top: int = TOP_BY_MI, min_keep: int = MIN_KEEP, always: str | None = ALWAYS_KEEP) -> DataFrame:
    """K3 on the small MI and pair tables.

    Drop MI < ``low``; from each correlated pair drop the one with lower MI
    (the second on ties); keep the top ``top`` by MI minus the dropped; if
    fewer than ``min_keep`` remain, top up from the top list in rank order;
    always append ``always``.  Returns (feature, mutual_info, rank, position)
    with ``position`` the order of the selected list.
    """
    order = {f: i for i, f in enumerate(features)}
    spark = mi.sparkSession
    pos = spark.createDataFrame([(f, i) for f, i in order.items()], "feature string, list_pos int")
    ranked = (mi.join(pos, "feature")
              .withColumn("rank", F.row_number().over(Window.orderBy(F.col("mutual_info").desc(), "list_pos"))))
    low_mi = ranked.where(F.col("mutual_info") < low).select("feature")
    m1 = ranked.select(F.col("feature").alias("feature1"), F.col("mutual_info").alias("m1"))
    m2 = ranked.select(F.col("feature").alias("feature2"), F.col("mutual_info").alias("m2"))
    loser = (pairs.join(m1, "feature1").join(m2, "feature2")
             .select(F.when(F.col("m1") < F.col("m2"), F.col("feature1")).otherwise(F.col("feature2")).alias("feature")))
    removed = low_mi.unionByName(loser).distinct()
    topk = ranked.where(F.col("rank") <= top)
    kept = topk.join(removed, "feature", "left_anti")
    dropped_top = topk.join(removed, "feature", "left_semi")
    # top-up: the best-ranked dropped features, as many as needed to reach min_keep
    kept_n = kept.select("feature", "mutual_info", "rank", F.lit(0).alias("_src"))
    extra = dropped_top.select("feature", "mutual_info", "rank", F.lit(1).alias("_src"))
    both = kept_n.unionByName(extra)
    sel = (both.withColumn("_k", F.count_if(F.col("_src") == 0).over(Window.partitionBy()))
           .withColumn("_e", F.row_number().over(Window.partitionBy("_src").orderBy("rank")))
           .where((F.col("_src") == 0) | (F.col("_e") <= F.greatest(F.lit(min_keep) - F.col("_k"), F.lit(0))))
           .drop("_k", "_e"))
    sel = sel.withColumn("position", F.row_number().over(Window.orderBy("_src", "rank"))).drop("_src")
    if always:
        tail = (ranked.where(F.col("feature") == always).join(sel.select("feature"), "feature", "left_anti")
                .select("feature", "mutual_info", "rank",
                        (F.lit(1000000)).alias("position")))
        sel = sel.unionByName(tail)
        sel = sel.withColumn("position", F.row_number().over(Window.orderBy("position")))
    return sel
