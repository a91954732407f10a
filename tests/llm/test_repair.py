import hashlib
import random
import re
import zlib
from itertools import product

from tessera.llm import repair

PATTERN = re.compile(r"(s?(ua)+)?")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen
                   else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """(cost, audit, repaired) by trying everything: shortest paths over (row, output so far as state)."""
    import heapq
    heap, done = [(0, "", 0, "", ())], {}
    best = None
    while heap:
        cost, audit, i, out, texts = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if i == len(rows) and PATTERN.fullmatch(out):
            best = min(best, (cost, audit, texts)) if best else (cost, audit, texts)
        state = (i, out[-1:], )
        if done.get(state, (cost, audit)) < (cost, audit) and done[state][0] < cost:
            continue
        done[state] = min(done.get(state, (cost, audit)), (cost, audit))

        def go(more, letter, j, initial, row):
            new = out + initial
            if not initial or re.fullmatch(r"s?(ua)*u?", new):
                heapq.heappush(heap, (cost + more, audit + letter, j, new, texts + row))
        for x, name in (("u", "user"), ("a", "assistant")):
            go(3, "I", i, x, ((name, ""),))
        if i < len(rows):
            _, _, role, text = rows[i]
            go(4, "D", i + 1, "", ())
            if marks[i] not in ("blank", "duplicate"):
                more = 3 * (marks[i] == "truncated")
                if role[:1]:
                    go(more, "K", i + 1, role[:1], ((role, text),))
                for x, name in (("u", "user"), ("a", "assistant")):
                    go(3 + more, "R", i + 1, x, ((name, text),))
    return best


def brute(original, damaged):
    out = {}
    for conv in {r[0] for r in original}:
        rows = sorted((r for r in damaged if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        marks = faults(rows)
        turns = {r[1] for r in rows if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, texts = cheapest(rows, marks) if rows else (0, "", ())
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in texts).encode()).hexdigest()
        out[conv] = (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return out


def conversations(seed=1, n=120):
    rng = random.Random(seed)
    texts = ["", " \n", None, "ok.", "ok", "why?\t", "no end", "é!", "a. b", "same."]
    rows = []
    for conv in [None, *range(n)]:
        turn = 0
        for _ in range(rng.choice([1, 2, 3, 5, 8])):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            rows.append((conv, None if rng.random() < 0.05 else turn, role, rng.choice(texts)))
            turn += rng.choice([0, 1, 1, 1, 3])
    return rows + rows[:6] + [(-1, t, r, f"{t}.") for t, r in enumerate(["system"] + ["user", "assistant"] * 3)]


def found(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


SCHEMA = "conv_id long, turn long, role string, text string, fault int, back string, h1 int"


def test_against_brute_force(spark):
    rows = conversations()
    turns = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(7)
    damaged = repair.damage(turns)
    assert sorted(map(tuple, damaged.collect()), key=repr) == sorted(brute_damage(rows), key=repr)
    assert found(repair.digest(damaged, turns)) == brute(rows, brute_damage(rows))
    plain = found(repair.digest(turns, turns))
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert plain == brute(rows, spaced)
    assert plain[-1][5:7] == (0, "KKKKKKK")


def test_repaired_rows(spark):
    rows = conversations(3, 40)
    turns = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    by_conv = {}
    for r in repair.repair(turns).collect():
        by_conv.setdefault(r.conv_id, []).append(r)
    want = found(repair.digest(turns, turns))
    for conv, digest in want.items():
        own = sorted(by_conv.get(conv, []), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(len(own)))
        assert PATTERN.fullmatch("".join(r.role[:1] for r in own))
        text = "\n".join(f"{r.role}:{r.text}" for r in own)
        assert hashlib.sha256(text.encode()).hexdigest() == digest[-1]
        assert "".join(r.edit for r in own) == digest[-2].replace("D", "")


def test_state_crosses_batches(spark):
    """A long conversation beside short ones, in batches of three rows: as in one batch."""
    rng = random.Random(9)
    rows = [(0, t, rng.choice(["user", "assistant"]), rng.choice(["a.", f"{t}.", f"{t}", ""])) for t in range(3000)]
    rows += [(c, t, "user", "x.") for c in range(1, 30) for t in range(2)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    whole = found(repair.digest(turns, turns))
    was, repair_batches = spark.conf.get(name), repair.arrow_batches
    try:
        repair.arrow_batches = lambda spark: repair_batches(spark, 3)
        assert found(repair.digest(turns, turns)) == whole
    finally:
        repair.arrow_batches = repair_batches
    assert spark.conf.get(name) == was
    assert len(whole[0][6]) >= 3000 and whole[1] == brute(rows, [r for r in rows if r[0] == 1])[1]


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.digest(turns, turns).collect() == []
    one = spark.createDataFrame([(5, 0, "user", "x.")], turns.schema)
    assert found(repair.digest(turns, one)) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_steps_take_the_ascii_least_of_the_cheapest():
    """All conversations of up to five rows over small alphabets."""
    for n in range(5):
        for kinds in product([("user", "a."), ("assistant", "b"), ("system", "c.")], repeat=n):
            rows = [(0, i, role, f"{i}{text}") for i, (role, text) in enumerate(kinds)]
            marks = faults(rows)
            step, costs, back = repair.Steps(), repair.END, []
            for (_, _, role, _), m in zip(rows[::-1], marks[::-1]):
                costs, b = step(costs, role[:1], ["", "blank", "duplicate", "truncated"].index(m))
                back.append(b)
            walk, audit = repair.Walk(), ""
            for (_, _, role, _), b in zip(rows, back[::-1]):
                inserted, letter, _ = walk.row(b)
                audit += "I" * len(inserted) + letter
                if letter == "K":
                    walk.keep(role[:1])
            audit += "I" * len(walk.close())
            assert audit == cheapest(rows, marks)[1], kinds
