"""Conversation structure repair by secondary-sorted streaming.

A conversation's rows, in order of turn, are edited at the least cost until
their role initials read ``(s?(ua)+)?``.  Where a row stands in that pattern
is one of four states (nothing yet, after s, after u, after a); the cheapest
way on from each state is a dynamic program from the last row to the first.

First pass: rows are partitioned by conversation, sorted by turn from the last
to the first, and streamed through Arrow batches; the four costs are the only
state that is carried from batch to batch.  Relative to their smallest they
take few values, so a step is a table lookup.  A row's best edits, two bits for
each of the four states, are its backpointer: one byte, spilled with the row to
a table in the shared folder.  Second pass: the table is partitioned by
conversation and sorted from the first row to the last, and the backpointers
are followed.  A conversation of any length needs the memory of one batch (and
a byte a row for its audit), and a lost executor's tasks start from the table.

Edits: Keep 0, Rerole to user or assistant 3, Delete 4, Insert an empty user or
assistant row 3; a row with the fault truncated costs 3 more unless it is
deleted, and blank or duplicate rows must be deleted.  Among equal costs the
audit, the string of the edits' initials, is the ASCII-least: a step takes the
least letter that some cheapest way on begins with, and a letter determines its
state and role.

Faults of a row, the first that applies: blank (no character but white space),
duplicate (role and text seen in an earlier row), truncated (the last character
that is not white space is not one of ``.!?``).  First occurrences are found by
aggregating (conversation, hash of role and text) before the rows meet.

Defined results: a null role or text is one space, null turns come first, rows
of one turn are ordered by role and text, of equal rows all but the first are
duplicates; rows with a null conversation id are one conversation; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_batches, materialize, slices

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3           # fixed values: costs
LETTERS = "DIKR"                                         # a backpointer's two bits, in ASCII order
NONE, BLANK, DUPLICATE, CUT = range(4)                   # faults
# state -> {initial: next state}; 0 nothing yet, 1 after s, 2 after u, 3 after a
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLES = {"u": "user", "a": "assistant"}
# cost and letter at the end of a conversation: states 0 and 3 may end there
END = (0, 2 * INSERT, INSERT, 0)
WHITE = " \t\n\x0b\x0c\r"


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) damaged by crc32(``conv_id:turn``) modulo 20: 0 drops the
    row, 1 empties its text, 2 takes ``.!?`` out, 3 repeats it, 4 makes its role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(k == 1, F.lit("")).when(k == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    role = F.when(k == 4, F.lit("user")).otherwise(space("role"))
    times = F.when(k == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (turns.where(k != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))
            .withColumn("times", F.explode("times")).drop("times"))


def with_faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, h1, h2, later, fault): ``later`` where role and text were seen in
    an earlier turn; of equal rows of one turn the streaming pass leaves out the first."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = turns.select("conv_id", "turn", space("role"), space("text")).select(
        "*", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("second"), "text", "role").alias("h2"))
    # a null turn comes before all others
    first = rows.groupBy("conv_id", "h1", "h2").agg(F.min("turn").alias("_t"), F.count_if(F.col("turn").isNull()).alias("_z"))
    first = first.withColumnsRenamed({"conv_id": "_c", "h1": "_1", "h2": "_2"})
    later = F.col("turn").isNotNull() & ((F.col("_z") > 0) | (F.col("turn") > F.col("_t")))
    last = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), NONE).otherwise(CUT)
    return rows.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("h1") == F.col("_1"))
                     & (F.col("h2") == F.col("_2"))).select(
        "conv_id", "turn", "role", "text", "h1", "h2", later.alias("later"), fault.cast("byte").alias("fault"))


class Steps:
    """The dynamic program's steps, each computed once: costs from a row on, given those from the
    next row on, for a row of a role initial and fault."""

    def __init__(self):
        self.known = {}

    def __call__(self, after: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
        """(costs from the row on, relative to the smallest; the row's backpointers)."""
        key = (after, initial, fault)
        if key not in self.known:
            self.known[key] = self.step(*key)
        return self.known[key]

    @staticmethod
    def step(after: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
        more = TRUNCATED if fault == CUT else 0
        ways = []                                        # per state: letter -> cost, the row being used
        for state, to in enumerate(NEXT):
            way = {"D": DELETE + after[state]}
            if fault not in (BLANK, DUPLICATE):
                if initial in to:
                    way["K"] = more + after[to[initial]]
                made = "a" if state == 2 else "u"
                way["R"] = REROLE + more + after[to[made]]
            ways.append(way)
        plain = [min(w.values()) for w in ways]
        # an insert leads to another state before the same row; two in a row at most pay
        cost = list(plain)
        cost[2], cost[3] = min(plain[2], INSERT + plain[3]), min(plain[3], INSERT + plain[2])
        for state in (0, 1):
            cost[state] = min(plain[state], INSERT + cost[2])
        packed = 0
        for state, way in enumerate(ways):
            way["I"] = INSERT + cost[3 if state == 2 else 2]
            packed |= LETTERS.index(min(c for c, x in way.items() if x == cost[state])) << 2 * state
        least = min(cost)
        return tuple(c - least for c in cost), packed


def _backpointers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, role, text, h1, h2, later, fault) from the last of a conversation to
    its first, with the final fault and the backpointers."""
    step, costs, held = Steps(), END, None
    same = lambda t, c: pc.fill_null(pc.equal(t.column(c)[:-1], t.column(c)[1:]), False)
    both_null = lambda t, c: pc.and_(pc.is_null(t.column(c)[:-1]), pc.is_null(t.column(c)[1:]))

    def finished(table: pa.Table, last: bool) -> pa.RecordBatch:
        """``table``'s rows but for the last, whose earlier neighbour is yet to come, unless it is the end."""
        nonlocal costs
        conv = pc.or_(same(table, "conv_id"), both_null(table, "conv_id"))
        copy = pc.and_(pc.and_(conv, pc.or_(same(table, "turn"), both_null(table, "turn"))),
                       pc.and_(same(table, "h1"), same(table, "h2")))
        goes_on = conv.to_pylist() + [False] * last
        repeated = np.append(copy.to_numpy(zero_copy_only=False), [False] * last).astype(bool)
        rows = table.slice(0, len(goes_on))
        fault = rows.column("fault").to_numpy()
        later = rows.column("later").to_numpy().astype(bool) | repeated
        fault = np.where((fault != BLANK) & later, DUPLICATE, fault)
        out = bytearray(len(goes_on))
        initials = pc.utf8_slice_codeunits(rows.column("role"), 0, 1).to_pylist()
        for i, (initial, f, on) in enumerate(zip(initials, fault.tolist(), goes_on)):
            costs, out[i] = step(costs, initial, f)
            if not on:
                costs = END
        columns = [rows.column(c).combine_chunks() for c in ("conv_id", "turn", "role", "text")]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(fault.astype(np.int8)), pa.array(np.frombuffer(bytes(out), np.uint8).astype(np.int16))],
            ["conv_id", "turn", "role", "text", "fault", "back"])

    for batch in batches:
        if batch.num_rows:
            now = pa.Table.from_batches([batch])
            table = now if held is None else pa.concat_tables([held, now])
            if table.num_rows > 1:
                yield finished(table, False)
            held = table.slice(table.num_rows - 1)
    if held is not None:
        yield finished(held, True)


def backpointers(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault, back) per row of ``turns``, written to the shared folder."""
    kinds = {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    order = [F.col("conv_id").desc(), F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text").desc()]
    with arrow_batches(turns.sparkSession):
        return materialize(with_faults(turns).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(
            _backpointers, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, "
                           "fault byte, back short"))


class Walk:
    """Follows the backpointers of one conversation after another."""

    def __init__(self):
        self.state = 0

    def row(self, back: int) -> tuple[list[str], str, str | None]:
        """(initials of rows to insert before this one, its edit, its new initial or None)."""
        inserted = []
        while (letter := LETTERS[back >> 2 * self.state & 3]) == "I":
            inserted.append(self.end_of_turn())
        made = None
        if letter == "R":
            made = self.end_of_turn()
        return inserted, letter, made

    def end_of_turn(self) -> str:
        """The initial that an insert or a new role has here, after which the state is the next."""
        made = "a" if self.state == 2 else "u"
        self.state = NEXT[self.state][made]
        return made

    def keep(self, initial: str) -> None:
        self.state = NEXT[self.state][initial]

    def close(self) -> list[str]:
        """Initials of the rows to insert at the end; the next conversation may begin."""
        inserted = []
        while self.state in (1, 2):
            inserted.append(self.end_of_turn())
        self.state = 0
        return inserted


class Digest:
    """What ``digest`` returns of one conversation, row by row."""

    def __init__(self, conv):
        self.conv, self.sha, self.rows, self.audit = conv, hashlib.sha256(), 0, bytearray()
        self.faults, self.illegal, self.cost, self.before = [0] * 4, 0, 0, None
        self.turns, self.first, self.last = 0, None, None

    def put(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.rows else ''}{role}:{text}".encode())
        self.rows += 1

    def insert(self, initials: list[str]) -> None:
        for made in initials:
            self.put(ROLES[made], "")
        self.audit += b"I" * len(initials)
        self.cost += INSERT * len(initials)

    def see(self, walk: Walk, turn, role: str, text: str, fault: int, back: int) -> None:
        initial = role[:1]
        self.faults[fault] += 1
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if turn is not None:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        inserted, letter, made = walk.row(back)
        self.insert(inserted)
        self.audit += letter.encode()
        if letter == "D":
            self.cost += DELETE
            return
        if letter == "K":
            walk.keep(initial)
        else:
            self.cost += REROLE
        self.cost += TRUNCATED * (fault == CUT)
        self.put(ROLES[made] if made else role, text)

    def values(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, self.cost,
                self.audit.decode(), self.sha.hexdigest())


DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _digest(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, now = Walk(), None

        def done() -> tuple:
            now.insert(walk.close())
            return now.values()

        for batch in slices(batches, 4096):
            out = []
            for conv, *row in zip(*[batch.column(c).to_pylist() for c in range(6)]):
                if now is None or now.conv != conv:
                    if now is not None:
                        out.append(done())
                    now = Digest(conv)
                now.see(walk, *row)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, done()))], schema)
    return run


def _repaired(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, now, place, before = Walk(), None, 0, False

        def inserts(initials: list[str]) -> list[tuple]:
            nonlocal place
            made = [(now, place + i, None, ROLES[x], "", "I") for i, x in enumerate(initials)]
            place += len(made)
            return made

        for batch in slices(batches, 4096):
            out = []
            for conv, turn, role, text, _, back in zip(*[batch.column(c).to_pylist() for c in range(6)]):
                if not before or now != conv:
                    out += inserts(walk.close()) if before else []
                    now, place, before = conv, 0, True
                inserted, letter, made = walk.row(back)
                out += inserts(inserted)
                if letter == "K":
                    walk.keep(role[:1])
                if letter != "D":
                    out.append((conv, place, turn, ROLES[made] if made else role, text, letter))
                    place += 1
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
        if before:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in inserts(walk.close())], schema)
    return run


def _in_order(turns: DataFrame) -> DataFrame:
    order: list[Column] = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"),
                           F.col("fault") == DUPLICATE]             # of equal rows the first is no duplicate
    return backpointers(turns).repartition("conv_id").sortWithinPartitions(*order).select(
        "conv_id", "turn", "role", "text", "fault", "back")


def _schemas(turns: DataFrame, columns: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    spark, kinds = turns.sparkSession, {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    text = columns.format(**kinds)
    return text, to_arrow_schema(spark.createDataFrame([], text).schema)


def repair(turns: DataFrame) -> DataFrame:
    """(conv_id, position, turn, role, text, edit): the repaired conversations; edit is K, R or I,
    and an inserted row has no turn."""
    text, schema = _schemas(turns, "conv_id {conv_id}, position long, turn {turn}, role string, text string, edit string")
    with arrow_batches(turns.sparkSession):
        return materialize(_in_order(turns).mapInArrow(_repaired(schema), text))


def digest(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for every
    conv_id of ``conversations``; one without rows in ``turns`` has zeros and the hash of nothing."""
    text, schema = _schemas(turns, "conv_id {conv_id}, " + DIGEST)
    with arrow_batches(turns.sparkSession):
        found = materialize(_in_order(turns).mapInArrow(_digest(schema), text)).withColumnRenamed("conv_id", "_c")
    names = [c.split()[0] for c in DIGEST.split(", ")]
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return (conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
            .select("conv_id", *[F.coalesce(F.col(c), empty.get(c, F.lit(0))).alias(c) for c in names]))
