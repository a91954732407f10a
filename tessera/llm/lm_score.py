"""Language-model scoring with Brown class-based bigrams.

Tokens: a text's words, A-Z lower-cased, then one end token.  All training
documents are counted whole: every distinct token's count, in Spark.  Every
token gets its class from its neighbours, in three steps:

1. The ``cluster_words`` most frequent tokens are put into ``classes`` classes
   by exchange clustering: a token moves to the class that raises the
   class-bigram likelihood most, sweep after sweep.
2. The next tokens, to ``class_words``, are exchanged once, each into the class
   that raises the likelihood most.
3. All remaining tokens likewise: their contexts are grouped by token in Spark,
   and a task that holds only the class table chooses each one's class.

No bigram is left out: in each step the tokens that have no class yet are one
open class, which counts as a neighbour but takes no token.  Class-to-class
transitions are then counted over all training tokens with every token's own
class.  The model is P(w | v) = P(class w | class v) * P(w | class w), both
smoothed by additive counts, starting each text after an end token.

Texts are cut into tokens twice: to count them, and to number those of the (at
most) ``table_words`` most frequent counts, which have a bounded broadcast
table.  All later passes read the numbers.  The other tokens are kept as words,
leave the task with their neighbours and are joined with the full table of
counts and classes, so both are exact for any vocabulary.

Defined results: a null text is empty and has only its end token; rows with
a null id are learnt from and not held out; a token never seen in training
has count 0 and no class: it takes the one place for the unseen in each class,
weighted by the class's probability, and is followed by each class as often as
the class occurs; with nothing to learn from all counts are 0; repeated rows
get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_batches, materialize, slices, text_bytes

END = b"\n"                    # no word holds white space
FLUSH = 200_000                # distinct tokens a task holds before it hands on its counts
HELD = 2_000_000               # places of tokens a task holds before it hands on their neighbours


def tokens(text: bytes) -> list[bytes]:
    words = text.lower().split()
    words.append(END)
    return words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())],
                                          ["w", "n"])
    for batch in batches:
        for text in batch.column(0):
            seen.update(tokens(text.as_py()))
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
    if seen:
        yield out()


def token_counts(texts: DataFrame) -> DataFrame:
    """(w binary, n) of all tokens of ``texts`` (t binary)."""
    return texts.select("t").mapInArrow(_count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The end token, then all tokens with a count of at least the smallest bound that leaves at most
    ``most`` of them."""
    spread = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.col("n").desc()).limit(most).collect()
    total, least = 0, None
    for r in spread:
        total += r["k"]
        if total > most:
            break
        least = r["n"]
    often = F.lit(False) if least is None else F.col("n") >= least
    rows = counts.where(often | (F.col("w") == F.lit(END))).collect()      # <= most + 1 rows
    return sorted(((bytes(r["w"]), r["n"]) for r in rows), key=lambda x: (x[0] != END, -x[1], x[0]))


def _numbers(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        size = len(index)
        for batch in slices(batches, 64):
            words, lengths = [], []
            for text in batch.column(batch.num_columns - 1):
                own = tokens(text.as_py())
                lengths.append(len(own))
                words += own
            ids = np.fromiter(map(index.get, words, repeat(size)), np.int32, len(words))
            end = np.cumsum(lengths)
            at = np.flatnonzero(ids == size)
            packed = pa.Array.from_buffers(pa.binary(), len(end), [
                None, pa.py_buffer(np.append(0, end * ids.itemsize).astype(np.int32)), pa.py_buffer(ids)])
            rest = pa.ListArray.from_arrays(pa.array(np.append(0, np.searchsorted(at, end)), pa.int32()),
                                            pa.array([words[i] for i in at.tolist()], pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed, rest], [*batch.schema.names[:-1], "ids", "rest"])
    return run


def number_tokens(texts: DataFrame, index: dict[bytes, int]) -> DataFrame:
    """``texts``, whose last column is t, with ids and rest for it: a text's tokens as 32-bit numbers, and
    those outside ``index``, whose number is ``len(index)``, in order."""
    shared = texts.sparkSession.sparkContext.broadcast(index)
    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in texts.schema.fields[:-1])
    return texts.mapInArrow(_numbers(shared), own + "ids binary, rest array<binary>")


def _ids(column: pa.Array) -> np.ndarray:
    """The tokens of a batch's texts in one row.  Each text ends with an end token, so the next one starts
    after it, and the first one after the last one's."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).astype(np.int64)


def _bigrams(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size + 1) * (size + 1), np.int64)
        for batch in slices(batches):
            ids = np.minimum(_ids(batch.column(0)), size)
            np.add.at(sums, np.roll(ids, 1) * (size + 1) + ids, 1)
        at = np.flatnonzero(sums)
        for i in range(0, len(at), 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(sums[part])], ["pair", "n"])
    return run


def pair_counts(numbered: DataFrame, size: int) -> np.ndarray:
    """(size + 1)^2 counts of neighbouring tokens; tokens with other numbers are number ``size``."""
    return pair_table(numbered.select("ids").mapInArrow(_bigrams(size), "pair long, n long"), size + 1)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def _gains(table: np.ndarray, r: np.ndarray, l: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Gain in likelihood of adding each of some tokens to each class of ``table``.

    ``r`` and ``l`` (tokens x classes) count a token's followers and predecessors by
    class, ``same`` its pairs with itself.  Row d of the table gets r, column d gets
    l, and the corner both and the token's own pairs.
    """
    r3, l3 = r[:, None, :], l[:, :, None]
    corner = np.diagonal(table)
    own = same[:, None]
    base, base_corner = _xlogx(table), _xlogx(corner)
    gain = (_xlogx(table + r3) - base).sum(axis=2) + (_xlogx(table + l3) - base).sum(axis=1)
    gain += _xlogx(corner + r + l + own) - _xlogx(corner + r) - _xlogx(corner + l) + base_corner
    # totals of the classes with what precedes and follows the token, wherever it goes
    rows, cols = table.sum(axis=1) + l, table.sum(axis=0) + r
    gain -= _xlogx(rows + r.sum(axis=1, keepdims=True) + own) - _xlogx(rows)
    return gain - _xlogx(cols + l.sum(axis=1, keepdims=True) + own) + _xlogx(cols)


def exchange_classes(pairs: np.ndarray, classes: int, sweeps: int = 4,
                     fixed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Class of each token and the class-bigram table: a local maximum of the likelihood
    sum N(c, d) log N(c, d) - sum N(c) log N(c) - sum N(., d) log N(., d).  The last
    ``fixed`` tokens are classes of their own, after the others, and stay."""
    n = len(pairs) - fixed
    classes = max(1, min(classes, n))
    group = np.append(np.arange(n) % classes, classes + np.arange(fixed))      # frequent tokens start apart
    onehot = np.zeros((n + fixed, classes + fixed))
    onehot[np.arange(n + fixed), group] = 1
    right, left = pairs @ onehot, pairs.T @ onehot      # counts of a token's followers / predecessors by class
    table = onehot.T @ right
    for _ in range(sweeps):
        moved = 0
        for w in range(n):
            own, r, l, same = group[w], right[w].copy(), left[w].copy(), pairs[w, w]
            r[own] -= same
            l[own] -= same                              # neighbours other than itself
            table[own] -= r
            table[:, own] -= l
            table[own, own] -= same
            gain = _gains(table, r[None], l[None], np.array([same]))[0]
            best = int(gain[:classes].argmax())
            if gain[best] <= gain[own] + 1e-9:
                best = own
            table[best] += r
            table[:, best] += l
            table[best, best] += same
            if best != own:
                moved += 1
                right[:, own] -= pairs[:, w]
                right[:, best] += pairs[:, w]
                left[:, own] -= pairs[w]
                left[:, best] += pairs[w]
                group[w] = best
        if not moved:
            break
    return group[:n], table


def _place(table: np.ndarray, token: np.ndarray, right: bool, near: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per entry (a token's n neighbours of class ``near`` on one side) the gain of the row's or column's cell."""
    lines = (table[:-1] if right else table[:, :-1].T).T                # [near, class]
    few = _xlogx(lines[None] + np.arange(17)[:, None, None]) - _xlogx(lines)
    out = few[np.minimum(n, 16).astype(np.int64), near]
    many = np.flatnonzero(n > 16)
    base = lines[near[many]]
    out[many] = _xlogx(base + n[many][:, None]) - _xlogx(base)
    return out


def best_classes(table: np.ndarray, right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """One exchange step for further tokens, each on its own against the table as it is.

    ``right`` and ``left`` (tokens x classes) count followers and predecessors.  With two
    more columns than classes, the table's last class is the open one, which holds the
    tokens, and the columns count neighbours in the open class and the token itself."""
    is_open = right.shape[1] > len(table)
    if not is_open:                                      # tokens that the table does not count
        table = np.pad(table, (0, 1))
        right, left = np.pad(right, ((0, 0), (0, 2))), np.pad(left, ((0, 0), (0, 2)))
    k = len(table) - 1
    rows, cols, corner = table.sum(axis=1)[:-1], table.sum(axis=0)[:-1], np.diagonal(table)[:-1]
    group = [np.zeros(0, np.int64)]
    for at in range(0, len(right), 256):
        r, l = right[at:at + 256], left[at:at + 256]
        gain = np.zeros((len(r), k))
        for counts, side in ((r, True), (l, False)):
            token, near = np.nonzero(counts[:, :k])
            if len(token):
                first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
                gain[token[first]] += np.add.reduceat(_place(table, token, side, near, counts[token, near]), first)
        own, total = r[:, k + 1:], r.sum(axis=1, keepdims=True)
        rc, lc = r[:, :k], l[:, :k]
        # the corner is in the row and in the column
        gain += _xlogx(corner + rc + lc + own) - _xlogx(corner + rc) - _xlogx(corner + lc) + _xlogx(corner)
        # cells with the open class, which the token leaves
        after, before = (table[:-1, k] - lc, table[k, :-1] - rc) if is_open else (table[:-1, k], table[k, :-1])
        gain += _xlogx(after + r[:, k:k + 1]) - _xlogx(after) + _xlogx(before + l[:, k:k + 1]) - _xlogx(before)
        row, col = (rows, cols) if is_open else (rows + lc, cols + rc)
        gain -= _xlogx(row + total) - _xlogx(row)
        gain -= _xlogx(col + l.sum(axis=1, keepdims=True)) - _xlogx(col)
        group.append(gain.argmax(axis=1))
    return np.concatenate(group)


def _contexts(shared, size: int, classes: int, with_open: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = shared.value                            # ids below len(group) have a class
        first = len(group)
        of = np.concatenate((group, np.full(size + 1 - first, classes if with_open else -1)))
        wide = classes + 2 * with_open
        sums = np.zeros((size - first) * 2 * wide, np.int64)
        for batch in slices(batches):
            ids = np.minimum(_ids(batch.column(0)), size)
            at = np.flatnonzero((ids >= first) & (ids < size))
            for side, by in ((0, ids[(at + 1) % len(ids)]), (1, ids[at - 1])):
                near = np.where(ids[at] == by, classes + 1, of[by]) if with_open else of[by]
                hit = near >= 0
                np.add.at(sums, ((ids[at[hit]] - first) * 2 + side) * wide + near[hit], 1)
        at = np.flatnonzero(sums)
        for i in range(0, len(at), 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(sums[part])], ["key", "n"])
    return run


def numbered_contexts(numbered: DataFrame, size: int, group: np.ndarray, classes: int,
                      with_open: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``context_counts`` of numbered texts, for the numbers below ``size``."""
    shared = numbered.sparkSession.sparkContext.broadcast(group)
    total = numbered.select("ids").mapInArrow(_contexts(shared, size, classes, with_open), "key long, n long") \
        .groupBy("key").agg(F.sum("n").alias("n")).toArrow()             # <= 2 * (classes + 2) rows per token
    wide = classes + 2 * with_open
    out = np.zeros((size - len(group)) * 2 * wide)
    out[total.column("key").to_numpy()] = total.column("n").to_numpy()
    out = out.reshape(-1, 2, wide)
    return out[:, 0], out[:, 1]


def context_counts(texts: DataFrame, index: dict[bytes, int], group: np.ndarray, classes: int,
                   with_open: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Followers and predecessors by class (tokens x classes) of the tokens of ``index`` without a class;
    ``with_open`` adds the columns of the neighbours without a class and of the token itself."""
    return numbered_contexts(number_tokens(texts.select("t"), index), len(index), group, classes, with_open)


def _class_pairs(shared, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, sums = shared.value, np.zeros(classes * classes, np.int64)
        for batch in slices(batches):
            c = of[_ids(batch.column(0))]
            before = np.roll(c, 1)
            both = (before >= 0) & (c >= 0)
            sums += np.bincount(before[both] * classes + c[both], minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["pair", "n"])
    return run


def class_pairs(numbered: DataFrame, of: np.ndarray, classes: int) -> DataFrame:
    """(pair, n) of the classes of neighbouring tokens, where both have one; of some tasks each."""
    shared = numbered.sparkSession.sparkContext.broadcast(of)
    return numbered.select("ids").mapInArrow(_class_pairs(shared, classes), "pair long, n long")


def pair_table(pairs: DataFrame, classes: int) -> np.ndarray:
    total = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()      # <= classes^2 rows
    out = np.zeros(classes * classes)
    out[total.column("pair").to_numpy()] = total.column("n").to_numpy()
    return out.reshape(classes, classes)


class _Numbers(dict):
    """Numbers given to words as they are met."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _code_type(classes: int) -> np.dtype:
    return np.min_scalar_type((classes + 2) * (classes + 2) - 1)


def _open_contexts(shared, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, group = shared.value                     # ids below len(group) have a class
        first, size, wide = len(group), len(names), classes + 2
        of = np.append(group, np.full(size + 1 - first, classes))
        others, held, many = _Numbers(), [], 0

        def out() -> pa.RecordBatch:
            token, code = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(token, kind="stable")
            token, code = token[order], code[order]
            start = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            words = list(others)
            w = pa.array([names[i] if i < size else words[i - size] for i in token[start].tolist()], pa.binary())
            codes = pa.Array.from_buffers(pa.binary(), len(start), [
                None, pa.py_buffer((np.append(start, len(code)) * code.itemsize).astype(np.int32)), pa.py_buffer(code)])
            return pa.RecordBatch.from_arrays([w, codes], ["w", "codes"])

        for batch in slices(batches):
            ids, rest = _ids(batch.column(0)), batch.column(1).flatten().to_pylist()
            ids[ids == size] = size + np.fromiter(map(others.__getitem__, rest), np.int64, len(rest))
            c = of[np.minimum(ids, size)]
            at = np.flatnonzero(ids >= first)
            token, after = ids[at], (at + 1) % len(ids)
            code = np.where(token == ids[at - 1], classes + 1, c[at - 1]) * wide \
                + np.where(token == ids[after], classes + 1, c[after])
            held.append((token, code.astype(_code_type(classes))))
            many += len(at)
            if many > HELD or len(others) > FLUSH:
                yield out()
                others, held, many = _Numbers(), [], 0
        if many:
            yield out()
    return run


def open_contexts(numbered: DataFrame, names: list[bytes], group: np.ndarray, classes: int) -> DataFrame:
    """(w, codes) of the tokens without a number below ``len(group)``, once per task (more often if it holds
    many): the classes before and after each of its places."""
    shared = numbered.sparkSession.sparkContext.broadcast((names, group))
    return numbered.select("ids", "rest").mapInArrow(_open_contexts(shared, classes), "w binary, codes binary")


def _choose(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        wide, kind = len(table) + 1, _code_type(len(table) - 1)
        held, size, most = [], 0, 1 << 17
        single = np.full(wide * wide, -1)               # class of a token that occurs once, by its code

        def once(code: np.ndarray) -> np.ndarray:
            new = np.unique(code[single[code] < 0])
            single[new] = best_classes(table, *(np.eye(wide)[near] for near in (new % wide, new // wide)))
            return single[code]

        def out(go_on: bool):
            """Tokens of the held rows; the last one's rows are held on if more may follow."""
            nonlocal held, size, most
            all_ = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            w, codes = all_.column(0), all_.column(1)
            n = pc.binary_length(codes).to_numpy() // kind.itemsize
            start = np.append(0, np.flatnonzero(pc.not_equal(w.slice(1), w.slice(0, len(w) - 1)).to_numpy(zero_copy_only=False)) + 1)
            stop = start[-1] if go_on else len(w)
            held, size = ([all_.slice(stop)], int(n[stop:].sum())) if go_on else ([], 0)
            most = max(1 << 17, 2 * size)
            start = start[start < stop]
            code = np.frombuffer(b"".join(codes.slice(0, stop).to_pylist()), kind).astype(np.int64)
            to = np.append(0, np.cumsum(n))
            many = np.diff(np.append(to[start], len(code)))
            group = np.zeros(len(start), np.int64)
            group[many == 1] = once(code[to[start[many == 1]]])
            code, more = code[np.repeat(many > 1, many)], np.flatnonzero(many > 1)
            to = np.append(0, np.cumsum(many[more]))
            for a in range(0, len(more), 4096):
                b = min(a + 4096, len(more))
                part, own = code[to[a]:to[b]], np.repeat(np.arange(b - a), many[more[a:b]])
                count = lambda near: np.bincount(own * wide + near, minlength=(b - a) * wide).reshape(-1, wide).astype(float)  # noqa: E731,B023
                group[more[a:b]] = best_classes(table, count(part % wide), count(part // wide))
            if len(start):
                yield pa.RecordBatch.from_arrays([w.take(pa.array(start)), pa.array(many), pa.array(group, pa.int32())], ["w", "n", "c"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column(1))).as_py() // kind.itemsize
            if size >= most:
                yield from out(True)
        if held:
            yield from out(False)
    return run


def open_classes(numbered: DataFrame, names: list[bytes], group: np.ndarray, classes: int) -> DataFrame:
    """(w, n, c) of all tokens without a number below ``len(group)``: count and best class."""
    of = np.append(group, np.full(len(names) + 1 - len(group), classes))
    table = pair_table(class_pairs(numbered, of, classes + 1), classes + 1)
    table = numbered.sparkSession.sparkContext.broadcast(table)
    return materialize(open_contexts(numbered, names, group, classes).repartition("w").sortWithinPartitions("w")
                       .mapInArrow(_choose(table), "w binary, n long, c int"))


class ClassModel:
    """What scoring needs, bounded by the size of the frequent-token table."""

    def __init__(self, frequent: list[tuple[bytes, int]], group: np.ndarray, mass: np.ndarray, types: np.ndarray):
        self.mass, self.types, self.classes = mass, types, len(mass)
        self.unseen = self.classes                      # number of the class of a token never seen
        self.n_tokens, self.n_types = int(mass.sum()), int(types.sum())
        self.index = numbers(frequent)
        self.of = np.append(group, -1)                  # -1: not in the table
        counted = np.log10(np.array([n for _, n in frequent], np.float64) + 1)
        self.base = float(np.log10(self.n_tokens + self.n_types + 1))
        # add-one emission, one place for the unseen; a token never seen has it in its transition
        self.class_base = np.log10(mass + types + 1)
        self.known_base = np.append(counted - self.base, 0.0)
        self.emission = np.append(counted - self.class_base[group], 0.0)

    def transitions(self, pairs: np.ndarray, alpha: float = 0.1) -> np.ndarray:
        """log10 of the next class's probability by class, the unseen last."""
        used = np.count_nonzero(self.types) + 1
        pairs = np.vstack([pairs, self.mass])           # after a token never seen: as often as the class occurs
        p = (pairs + alpha) / (pairs.sum(axis=1, keepdims=True) + alpha * used)
        return np.log10(np.hstack([p, p @ (1 / (self.mass + self.types + 1))[:, None]]))


def fit(texts: DataFrame, counts: DataFrame, table_words: int, cluster_words: int, class_words: int, classes: int,
        sweeps: int) -> tuple[ClassModel, DataFrame]:
    """The model without its transitions, and (w, n, c) of the tokens from ``class_words`` on."""
    frequent = most_frequent(counts, table_words)
    numbered = materialize(number_tokens(texts.select("t"), numbers(frequent)))
    return fit_numbered(numbered, frequent, cluster_words, class_words, classes, sweeps)


def numbers(frequent: list[tuple[bytes, int]]) -> dict[bytes, int]:
    return {w: i for i, (w, _) in enumerate(frequent)}


def fit_numbered(numbered: DataFrame, frequent: list[tuple[bytes, int]], cluster_words: int, class_words: int,
                 classes: int, sweeps: int) -> tuple[ClassModel, DataFrame]:
    """``fit`` of texts whose ``frequent`` tokens are numbered in that order."""
    top, more = frequent[:cluster_words], frequent[:max(cluster_words, class_words)]
    group, classes = np.zeros(0, np.int64), max(1, min(classes, len(top)))
    if top:
        group, table = exchange_classes(pair_counts(numbered, len(top)), classes, sweeps, fixed=1)
        if len(more) > len(top):
            right, left = numbered_contexts(numbered, len(more), group, classes, True)
            group = np.concatenate((group, best_classes(table, right, left)))
    others = open_classes(numbered, [w for w, _ in frequent], group, classes)
    mass, types = np.zeros(classes), np.zeros(classes)
    np.add.at(mass, group, [n for _, n in more])
    np.add.at(types, group, 1)
    for r in others.groupBy("c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect():
        mass[r["c"]] += r["n"]
        types[r["c"]] += r["k"]
    if len(frequent) > len(more):
        least = min(n for _, n in frequent[1:])
        of = {bytes(r["w"]): r["c"] for r in others.where(F.col("n") >= least).collect()}     # <= table_words rows
        group = np.append(group, np.array([of[w] for w, _ in frequent[len(more):]], np.int64))
    return ClassModel(frequent, group, mass, types), others


def _rare(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in slices(batches):
            c, lists = of[_ids(batch.column(2))], batch.column(3)
            at, words = np.flatnonzero(c < 0), lists.flatten()
            p = c[at - 1]
            before = words.take(pa.array(np.arange(len(at)) - 1 + len(at) * (np.arange(len(at)) == 0), mask=p >= 0))
            text = pa.array(np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(text), batch.column(1).take(text), words, pa.array(p, pa.int32()),
                 pa.array(c[(at + 1) % len(c)], pa.int32()), before], ["row", "held_out", "w", "p", "q", "v"])
    return run


def rare_tokens(numbered: DataFrame, of: np.ndarray) -> DataFrame:
    """(row, held_out, w, p, q, v) of all tokens without a number: the classes before and after (-1: none),
    and the token before if it has no number either."""
    shared = numbered.sparkSession.sparkContext.broadcast(of)
    return numbered.where(F.size("rest") > 0).select("row", "held_out", "ids", "rest").mapInArrow(
        _rare(shared), "row long, held_out boolean, w binary, p int, q int, v binary")


def _known(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, known_base, emission, step = shared.value
        for batch in slices(batches):
            ids = _ids(batch.column(3))
            lengths = pc.binary_length(batch.column(3)).to_numpy() // 4
            first = np.append(0, np.cumsum(lengths)[:-1])
            c = of[ids]
            before = np.roll(c, 1)
            steps = np.where((before >= 0) & (c >= 0), step[before, c], 0.0)
            summed = lambda x: pa.array(np.add.reduceat(x, first))  # noqa: E731,B023
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(lengths, pa.int64()), summed((c >= 0).astype(np.int64)),
                 summed(known_base[ids]), summed(emission[ids]), summed(steps)],
                [*batch.schema.names[:3], "n_tokens", "known", "base", "steps", "known_steps"])
    return run


def score_documents(docs: DataFrame, held_out: Column, table_words: int = 1 << 17, cluster_words: int = 2000,
                    class_words: int = 20_000, classes: int = 64, sweeps: int = 4) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of
    ``docs`` (doc_id, text); learns from rows not ``held_out``."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       text_bytes(F.col("text")).alias("t"))
    train = rows.where(~F.col("held_out"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    with arrow_batches(spark):
        counts = materialize(token_counts(train))
        frequent = most_frequent(counts, table_words)
        numbered = materialize(number_tokens(rows, numbers(frequent)).withColumn("row", F.monotonically_increasing_id()))
        learnt_from = numbered.where(~F.col("held_out"))
        model, others = fit_numbered(learnt_from, frequent, cluster_words, class_words, classes, sweeps)
        # each token outside the table with its class c, and the class p before it
        k, unseen = model.classes, F.lit(model.unseen)
        found = materialize(rare_tokens(numbered, model.of).join(others, "w", "left")
                            .select("row", "held_out", "p", F.coalesce("c", unseen).alias("c"), "q",
                                    F.coalesce("n", F.lit(0)).alias("n"), "v"))
        before = others.select(F.col("w").alias("v"), F.col("c").alias("_p"))
        rare = found.where(F.col("v").isNull()).drop("v").unionByName(
            found.where(F.col("v").isNotNull()).join(before, "v", "left")
            .withColumn("p", F.coalesce("_p", unseen)).drop("v", "_p"))
        learnt = rare.where(~F.col("held_out")).groupBy("p", "c", "q").agg(F.count(F.lit(1)).alias("n"))
        pairs = pair_table(
            class_pairs(learnt_from, model.of, k)
            .unionByName(learnt.select((F.col("p") * k + F.col("c")).cast("long").alias("pair"), "n"))
            .unionByName(learnt.where(F.col("q") >= 0).select((F.col("c") * k + F.col("q")).cast("long").alias("pair"), "n")), k)
        step = model.transitions(pairs)
        shared = spark.sparkContext.broadcast((model.of, model.known_base, model.emission, step))
        known = numbered.select("doc_id", "held_out", "row", "ids").mapInArrow(
            _known(shared), f"doc_id {kind}, held_out boolean, row long, n_tokens long, known long, base double, "
                            "steps double, known_steps double")
    table = F.lit(step.ravel())
    at = lambda a, b: F.get(table, F.col(a) * (k + 1) + F.col(b))
    log = F.log10(F.col("n") + F.lit(1.0))
    emission = F.when(F.col("c") == unseen, 0.0).otherwise(log - F.get(F.lit(model.class_base), F.col("c")))
    summed = rare.groupBy("row").agg(
        F.count_if(F.col("n") > 0).alias("known_rare"), F.sum(log - F.lit(model.base)).alias("base_rare"),
        F.sum(at("p", "c") + F.when(F.col("q") >= 0, at("c", "q")).otherwise(0.0) + emission).alias("steps_rare")) \
        .withColumnRenamed("row", "_row")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return known.join(summed, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("known_rare")).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("base_rare")).alias("base_score"),
        (F.col("steps") + F.col("known_steps") + zero("steps_rare")).alias("score"))
