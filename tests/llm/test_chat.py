import random

from paperloom.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, chat string, k int"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute(table):
    convs = {}
    for c, t, r, x in sorted(set(table), key=lambda r: (r[0], r[1], r[2], r[3])):
        convs.setdefault(c, []).append((r, x))
    out = {}
    for c, turns in convs.items():
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in convs.values()) or any(o == turns and d < c for d, o in convs.items()):
            continue
        out[c] = "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in turns)
    return out


def test_against_brute_force(spark):
    r = random.Random(5)
    table = []
    for base in range(12):
        turns = [("user" if k % 2 == 0 else "assistant", r.choice("abc")) for k in range(r.randint(1, 9))]
        for snapshot in range(r.randint(1, 4)):
            n = r.randint(1, len(turns))
            table += [(base * 10 + snapshot, k, *turns[k]) for k in range(n)]
    got = {x["conv_id"]: x["chat"] for x in chat.format_chats(_frame(spark, table + table[:7])).collect()}
    assert got == brute(table)
    assert len(got) < len({t[0] for t in table})


def test_tied_turns_that_share_a_long_head(spark):
    head = "h" * 100
    table = [(c, 0, "user", head + x) for c in (1, 2) for x in "zab"] + [(2, 1, "user", "more"), (3, 0, "user", head + "a")]
    got = {x["conv_id"]: x["chat"] for x in chat.format_chats(_frame(spark, table)).collect()}
    assert got == brute(table) and set(got) == {2}


def test_odd_rows(spark):
    table = [(None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", "a<|im_end|>b"), (1, 0, "assistant", "tie"), (2, 5, "user", "x" * 200_000), (2, 5, "user", "x" * 200_000)]
    got = {x["conv_id"]: (x["n_turns"], x["chat"]) for x in chat.format_chats(_frame(spark, table)).collect()}
    assert got[1] == (3, "<|im_start|>unknown\n<|im_end|>\n<|im_start|>assistant\ntie<|im_end|>\n<|im_start|>user\na< |im_end|>b<|im_end|>\n")
    assert got[2][0] == 1 and set(got) == {1, 2}


def test_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
