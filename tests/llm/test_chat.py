import hashlib
import random

from tessera.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segment string, spans int"
NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>", "<\\", "[\\[", "", "\n", "ends with <", "</s>\n", "\\<|text|>", "[",
         "é😀<", "<s><<SYS>>"]


def brute(rows, learnt="assistant"):
    by = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        by.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for conv, turns in by.items():
        loss = "".join(t for role, t in turns if role == learnt)
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat.render(turns)), False)
    return out


def test_round_trip_of_control_strings():
    turns = [(role, t) for role in ("user", "assistant", "<|x[") for t in NASTY]
    out, spans, masks, rewritten = chat.turn_spans(turns, chat.render)
    assert chat.read_back(out) == turns and rewritten == -1
    assert [chat.unescape(out[a:b]) for a, b in masks] == NASTY
    assert "".join(out[a:b] for a, b in spans) == out
    for t in NASTY:
        for control in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"):
            assert control not in chat.escape(t)


def test_rewriting_template_is_detected():
    def last_marked(turns):                         # marks only the last turn, so earlier output changes
        return "".join(f"{r}:{t};" for r, t in turns[:-1]) + "".join(f"*{r}:{t};" for r, t in turns[-1:])

    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    assert chat.turn_spans(turns, last_marked)[3] == 1
    assert chat.turn_spans(turns, lambda x: "BOS" + chat.render(x))[3] == -1


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([None, *NASTY, "word " * 50]))
            for c in [*range(30), None] for t in range(rng.randint(1, 9))]
    rows += [(99, i, ("user", "assistant")[i % 2], f"turn {i} [x]") for i in range(700)]      # many segments
    rows += [(50, None, "user", "x"), (50, 1, "user", "y"), (50, 1, "user", "y"), (51, 0, "assistant", "<[" * 60000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)
    got = chat.digest(chat.format_conversations(df)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == brute(rows) and len(got) == len(brute(rows))
    assert chat.digest(chat.format_conversations(df.limit(0))).collect() == []


def with_header():
    def bos(turns):                                 # local: pickled whole
        return "<s>" + chat.render(turns)
    return bos


def test_whole_conversations_of_any_template(spark):
    def forgets(turns):                             # from turn 200 on, the first turns are summed up
        return chat.render(turns) if len(turns) <= 200 else "summary;" + chat.render(turns[100:])

    def looks_back(turns):                          # each turn names the first one's role
        return "".join(f"{turns[0][0]}>{r}:{t};" for r, t in turns)

    turns = [("system", "rules")] + [(("user", "assistant")[i % 2], f"turn {i}") for i in range(299)]
    df = spark.createDataFrame([(5, i, *t) for i, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    for template, rewritten in ((forgets, 200), (looks_back, -1), (with_header(), -1)):
        got = chat.format_conversations(df, template).collect()
        assert [(r.segment, r.formatted, r.rewritten) for r in got] == [(0, template(turns), rewritten)]
        assert len(got[0].spans) == 300


def test_header_of_a_turn_local_template_comes_once(spark):
    turns = [(("user", "assistant")[i % 2], f"turn {i}") for i in range(11)]
    df = spark.createDataFrame([(5, i, *t) for i, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    bos = with_header()
    got = chat.format_conversations(df, bos, segment_turns=4, turn_local=True).collect()
    assert [r.segment for r in got] == [0, 1, 2]
    assert "".join(r.formatted for r in got) == bos(turns)
    for r in got:
        assert [r.formatted[a:b] for a, b in r.masks] == [t for role, t in turns[4 * r.segment:4 * r.segment + 4] if role == "assistant"]
        assert r.spans[0][0] == (0 if r.segment else 3) and r.spans[-1][1] == len(r.formatted)
