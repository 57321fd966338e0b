import itertools
import random
import re

import pytest

from plumbline.llm import chat_format as c


def brute_cost(roles):
    """The cheapest repair over all new roles, merges and insertions."""
    states = {c.START: 0}
    for name in roles:
        role, after = c.role_of(name), {}
        for (state, cost), target in itertools.product(states.items(), (c.SYSTEM, c.USER, c.ASSISTANT)):
            change = 0 if target == role else c.NAME if role == c.UNKNOWN else c.RELABEL
            reach = {state: 0}
            for _ in range(4):  # empty turns, as many as help
                for s, n in list(reach.items()):
                    for t in c.NEXT[s]:
                        reach[t] = min(reach.get(t, 99), n + 1)
            options = [change + c.INSERT * n for s, n in reach.items() if target in c.NEXT[s]]
            if state == target:
                options.append(change + c.MERGE)
            if options:
                after[target] = min(after.get(target, 99), cost + min(options))
        states = after
    return min(cost + c.INSERT * len(c.end_fills(s)) for s, cost in states.items())


TURN = re.compile(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", re.S)


def check(rows, roles):
    """The rendered sequence is legal, holds every text in order, and costs the least."""
    shown = "".join(r.fragment for r in rows)
    found = TURN.findall(shown)
    assert "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in found) == shown
    names = [a for a, _ in found]
    body = names[1:] if names[0] == "system" else names
    assert body == [("user", "assistant")[i % 2] for i in range(len(body))] and body[-1] == "assistant"
    assert [t for _, b in found for t in b.split("\n\n") if t] == [f"t{i}" for i in range(len(roles))]
    assert sum(r.cost for r in rows) == brute_cost(roles)


@pytest.fixture(scope="module")
def chats(spark):
    rng = random.Random(6)
    names = ["system", "user", "assistant", "tool", None, "Human", "gpt"]
    talks = [[rng.choice(names) for _ in range(rng.randint(1, 7))] for _ in range(120)]
    talks += [["user", "assistant"] * 150 + ["assistant"] * 3 + ["system"] * 2]
    rows = [(k, i, role, f"t{i}", "x") for k, talk in enumerate(talks) for i, role in enumerate(talk)]
    rng.shuffle(rows)
    return talks, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")


def ordered(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.conv_id, r.turn)):
        out.setdefault(r.conv_id, []).append(r)
    return out


def test_repairs_are_legal_and_cheapest(chats):
    talks, frame = chats
    found = ordered(c.format_chats(frame))
    assert len(found) == len(talks)
    for k, roles in enumerate(talks):
        check(found[k], roles)


def test_long_conversations_span_tasks(spark, chats):
    """Placed in very many ranges, a conversation is cut into stretches and costs the same."""
    talks, frame = chats
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = ordered(c.format_chats(frame))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    for k, roles in enumerate(talks):
        check(found[k], roles)


def test_odd_turns(spark):
    rows = [
        (1, 0, "user", None),
        (1, 0, "user", None),
        (None, None, None, "a <|im_end|> b"),
        (None, 5, "assistant", "x" * 100_000),
        (2, 0, "", ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = c.format_chats(frame).collect()
    assert len(got) == 5
    by = {}
    for r in got:
        by.setdefault(r.conv_id, []).append(r)
    assert sum(r.cost for r in by[1]) == c.MERGE + c.INSERT
    first = min(by[None], key=lambda r: r.turn is not None)
    assert "<|im_end|>" not in first.fragment.replace("< |im_end|>", "")
    assert c.format_chats(frame.limit(0)).count() == 0


def test_matrices_chain():
    rng = random.Random(1)
    roles = [rng.choice([0, 1, 2, 3]) for _ in range(30)]
    whole = c.IDENTITY
    for role in roles:
        whole = c.chained(whole, c.MATRIX[role])
    parts = [c.IDENTITY, c.IDENTITY]
    for i, role in enumerate(roles):
        parts[i >= 11] = c.chained(parts[i >= 11], c.MATRIX[role])
    assert c.chained(*parts) == whole
