"""Chat windows against plain Python, and exact round trips."""

import hashlib
import math
import random

from assortment.llm import chat_windows
from assortment.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
KIND = "conv_id long, turn long, role string, text string, window int, formatted string"


def escape(text):
    return text.replace("\\", "\\s").replace("<", "\\l").replace(">", "\\g")


def plain_windows(turns, budget, history):
    """turns: (role, text) in order; windows as (formatted, loss texts, turns, repeated)."""
    heads = [f"<turn {escape(r)}>" for r, _ in turns]
    bodies = [h + escape(t) + "</turn>\n" for h, (_, t) in zip(heads, turns)]
    tokens = [math.ceil(len(b.encode()) / 4) for b in bodies]
    lead = next((i for i, (r, _) in enumerate(turns) if r != "system"), len(turns))
    fixed, out, at, first = sum(tokens[:lead]), [], lead, True
    while first or at < len(turns):
        shown, used = at, fixed
        if not first:
            room = max(0, min(history, budget - fixed - tokens[at]))
            while shown > lead and sum(tokens[shown - 1:at]) <= room:
                shown -= 1
            used += sum(tokens[shown:at])
        stop = at
        while stop < len(turns) and (stop == at or used + sum(tokens[at:stop + 1]) <= budget):
            stop += 1
        numbers = [*range(lead), *range(shown, stop)]
        new = [*range(lead if not first else 0), *range(at, stop)] if first else list(range(at, stop))
        if first:
            new = [*range(lead), *range(at, stop)]
        loss = [turns[i][1] for i in new if turns[i][0] == "assistant"]
        out.append(("".join(bodies[i] for i in numbers), loss, len(numbers), 0 if first else lead + at - shown))
        at, first = stop, False
    return out


def test_windows_against_plain_python(spark):
    rng, rows, expected = random.Random(2), [], {}
    for conv in [None, *range(12)]:
        turns = [("system", "be <brief> \\ok")] * (rng.random() < 0.5)
        turns += [(rng.choice(["user", "assistant", "assistant", "tool<", "system"]), "\\<é>s\\l " * rng.randint(0, 12)) for _ in range(rng.randint(0, 25))]
        turns = turns or [("system", "alone")]
        rows += [(conv, i, r, t, 1, "x") for i, (r, t) in enumerate(turns)]
        expected[conv] = plain_windows(turns, 100, 40)
    frame = spark.createDataFrame(rows, KIND).repartition(5)
    made = chat_windows.formatted(frame, budget=100, history=40)
    got = {}
    for r in sorted(made.collect(), key=lambda r: r["window"]):
        loss = [r["formatted"][s["start"]:s["stop"]] for s in r["loss"]]
        got.setdefault(r["conv_id"], []).append((r["formatted"], loss, r["n_turns"], r["n_repeated"]))
        assert r["n_tokens"] == sum(math.ceil(len((x + "</turn>\n").encode()) / 4) for x in r["formatted"].split("</turn>\n")[:-1])
    for conv, windows in expected.items():
        assert [(f, [escape(x) for x in loss], n, k) for f, loss, n, k in windows] == got[conv]
    assert max(map(len, expected.values())) > 3
    back = {r["conv_id"]: r for r in chat_windows.read_back(made).collect()}
    for conv in expected:
        own = sorted((r[1], r[2], r[3]) for r in rows if r[0] == conv)
        assert back[conv]["turns"] == "".join(f"{r}\n{t}\n" for _, r, t in own)
        assert back[conv]["loss_text"] == "".join(t for _, r, t in own if r == "assistant")


def test_query_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    expected = set()
    for conv in {r[0] for r in rows}:
        turns = [(r[2], r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
        loss = "".join(t for r, t in turns if r == "assistant")
        windows = plain_windows(turns, chat_windows.BUDGET, chat_windows.HISTORY)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.add((
            conv, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss), sum(len(w[0]) for w in windows)
        ))
    assert {tuple(r) for r in QUERIES["op10_chat"](spark, DATA).collect()} == expected


def test_hard_rows(spark):
    rows = [(1, None, None, None, 1, ""), (1, None, None, None, 1, ""), (1, 3, "assistant", "", 1, ""), (None, 1, "assistant", "z" * 100_000, 1, "")]
    back = {r["conv_id"]: r for r in chat_windows.read_back(chat_windows.formatted(spark.createDataFrame(rows, KIND))).collect()}
    assert back[1]["turns"] == "\n\n" * 2 + "assistant\n\n" and back[1]["loss_text"] == ""
    assert back[None]["loss_text"] == "z" * 100_000
    assert chat_windows.formatted(spark.createDataFrame([], KIND)).count() == 0


def test_native_plan(spark):
    plan = QUERIES["op10_chat"](spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
