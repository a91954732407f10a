import random
import re

from tessera.llm import line_dedup

SCHEMA = "doc_id long, text string, covered string, n int, row string"


def brute(rows, min_chars=40):
    """Sequentially, in the order of first occurrences."""
    docs = sorted({(d, t) for d, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = {r: re.split(r"(?<=\n)|(?<=[.!?] )", r[1]) for r in docs}
    lines = {r: [y for y in x if y] for r, x in lines.items()}
    first, removed = {}, {r: set() for r in docs}
    for r in docs:
        for i in range(len(lines[r]) - 2):
            w = "\n".join(x.rstrip(" \r\n") for x in lines[r][i:i + 3])
            if len(w) < min_chars + 2:
                continue
            if w not in first:
                first[w] = (r, i)
            else:
                start = max(i, first[w][1] + 3) if first[w][0] == r else i
                removed[r].update(range(start, i + 3))
    return [(d, t if t is None else "".join(x for i, x in enumerate(lines[d, t]) if i not in removed[d, t]),
             0 if t is None else len(removed[d, t])) for d, t in rows]


def test_against_brute_force(spark):
    rng = random.Random(5)
    line = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(40)) for _ in range(rng.randint(1, 9)))
    passages = [[line() for _ in range(rng.randint(3, 7))] for _ in range(5)]
    rows = []
    for i in range(80):
        parts = [line() for _ in range(rng.randint(0, 8))]
        if rng.random() < .6:
            at = rng.randint(0, len(parts))
            parts[at:at] = rng.choice(passages)
        rows.append((i, rng.choice(["\n", ". ", "\n\n"]).join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(10)]                       # exact copies
    rows += [(300, "\n".join(["the same long line again and again"] * 9)), (301, None), (302, ""), (303, "\n\n\n\n"),
             (304, "x. y. z. x. y. z. x. y. z."), (306, "Mark \x01 inside. " + rows[1][1]), (307, "Ends here. And so on and on. Until. "), (305, "very long line. " * 20000), (200, rows[0][1]), (302, "")]
    docs = spark.createDataFrame([(*r, "c", 1, "r") for r in rows], SCHEMA)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_removed"]
    assert sorted(((r.doc_id, r.text, r.n_removed) for r in got.collect()), key=repr) == sorted(brute(rows), key=repr)
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []


def test_passage_inside_one_physical_line(spark):
    passage = "One sentence of the passage. Another one that follows it. A third that ends it here. And a fourth, too. "
    rows = [(1, "Intro of one. " + passage + "Then its end."), (2, "Quite another start! " + passage + "Different end."),
            (None, "No id. " + "But clean text, which stays. As it is, all of it.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got[1] == rows[0][1] and got[None] == rows[2][1]
    assert got[2] == "Quite another start! Different end."


def test_short_passages_between_different_neighbours(spark):
    rng = random.Random(8)
    words = lambda n: [f"{rng.choice('bcdfg')}{rng.randrange(10 ** 6)}" for _ in range(n)]
    rows, passages = [], {}
    for i in range(0, 200, 2):
        passage = words(60)
        if i % 4:
            passage[30] += "."                                   # parts of two sentences, else of one
        passages[i + 1] = set(passage)
        rows += [(j, " ".join(words(20) + passage + words(20)) + ".") for j in (i, i + 1)]
    rows += [(500, "a \x01 b, c; d. " * 9 + "e  f\r\ng"), (501, None), (502, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = dict(rows)
    assert all(r.text == whole[r.doc_id] for r in line_dedup.dedup_lines(docs.where("doc_id < 500")).collect())
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, word_ends=5).collect()}
    assert got[501] is None and got[502] == ""
    assert all(got[i] == whole[i] for i in range(0, 200, 2))     # first occurrences stay
    left = {i: len(passages[i] & set(got[i].split())) for i in passages}
    assert sum(n < 30 for n in left.values()) >= 95
    for i in passages:                                           # nothing but the passage goes
        assert set(whole[i].split()) - set(got[i].split()) <= passages[i]
    lines = docs.where("text is not null").select("text", line_dedup.lines_of(docs.text, 5).alias("l")).collect()
    assert all("".join(r.l) == r.text for r in lines)
