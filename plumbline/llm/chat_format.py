"""Chat formatting with minimum-cost role repair.

A legal conversation is a walk of a small automaton: an optional system turn, then user and
assistant in turn, ending with the assistant. Every turn as found keeps its role, is
relabelled or is merged into the turn before it, and may have empty turns put in front of it.
Dynamic programming over the automaton's states finds the cheapest repair, which is then
rendered.

The costs of a stretch of turns form a small (min, +) matrix, and such matrices multiply. So a
conversation needs not fit into one task: turns are placed in ranges of (conversation, turn),
each task multiplies up its stretch, the stretches of a conversation are chained, and each
task then repairs its own stretch between the states it was given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.sizing import broadcast_if_small, materialize
from plumbline.llm.common import small_batches, sorted_groups
from plumbline.llm.linking import in_batches

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
# Other names of the roles, taken as the role itself.
NAMES = {
    "system": SYSTEM, "developer": SYSTEM,
    "user": USER, "human": USER, "prompter": USER,
    "assistant": ASSISTANT, "bot": ASSISTANT, "gpt": ASSISTANT, "model": ASSISTANT,
}
UNKNOWN = 0

# Which turn may follow which state, and where a conversation may end.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = ASSISTANT

MERGE, INSERT, NAME, RELABEL = 1, 2, 1, 3
NEVER = 1 << 40

OPEN, CLOSE, JOIN = "<|im_start|>", "<|im_end|>\n", "\n\n"


@dataclass(frozen=True)
class Step:
    cost: int
    action: str
    inserted: tuple[int, ...]


def _fills(state: int, role: int) -> tuple[int, ...] | None:
    """The fewest empty turns after which ``role`` may follow ``state``."""
    reach: list[tuple[int, tuple[int, ...]]] = [(state, ())]
    for at, path in reach:
        if role in NEXT[at]:
            return path
        if len(path) < 3:
            reach += [(turn, (*path, turn)) for turn in NEXT[at]]
    return None


def _steps(role: int) -> dict[tuple[int, int], Step]:
    """The cheapest way for a turn of this role to lead from one state to another."""
    out: dict[tuple[int, int], Step] = {}
    for state, target in product(range(4), (SYSTEM, USER, ASSISTANT)):
        change = 0 if target == role else NAME if role == UNKNOWN else RELABEL
        options = []
        fills = _fills(state, target)
        if fills is not None:
            options.append(Step(change + INSERT * len(fills), "relabel" if change else "keep", fills))
        if state == target:
            options.append(Step(change + MERGE, "merge", ()))
        if options:
            out[state, target] = min(options, key=lambda s: s.cost)
    return out


STEPS = {role: _steps(role) for role in (UNKNOWN, SYSTEM, USER, ASSISTANT)}
MATRIX = {
    role: [[steps[a, b].cost if (a, b) in steps else NEVER for b in range(4)] for a in range(4)]
    for role, steps in STEPS.items()
}


def end_fills(state: int) -> tuple[int, ...]:
    """Empty turns that end a conversation; one without turns stays empty."""
    if state in (START, FINAL):
        return ()
    fills = _fills(state, FINAL)
    return (*fills, FINAL)


def chained(left: list[list[int]], right: list[list[int]]) -> list[list[int]]:
    """The (min, +) product."""
    return [[min(a + r[k] for a, r in zip(row, right)) for k in range(4)] for row in left]


IDENTITY = [[0 if a == b else NEVER for b in range(4)] for a in range(4)]


def cheapest(roles: list[int], start: int, end: int) -> list[Step]:
    """The cheapest steps from one state to another; ties go to the lower state, last turn first."""
    costs = [[0 if s == start else NEVER for s in range(4)]]
    for role in roles:
        m, before = MATRIX[role], costs[-1]
        costs.append([min(before[a] + m[a][b] for a in range(4)) for b in range(4)])
    steps, state = [], end
    for i in range(len(roles) - 1, -1, -1):
        m = MATRIX[roles[i]]
        before = min(range(4), key=lambda a: (costs[i][a] + m[a][state], a))
        steps.append((STEPS[roles[i]][before, state], state))
        state = before
    return steps[::-1]


def role_of(name: str | None) -> int:
    return NAMES.get((name or "").strip().lower(), UNKNOWN)


def chain(matrices: list[list[list[int]]]) -> list[tuple[int, int]]:
    """The state before and after each stretch of one conversation; ties go to the lower."""
    costs = [[0 if s == START else NEVER for s in range(4)]]
    for m in matrices:
        costs.append([min(costs[-1][a] + m[a][b] for a in range(4)) for b in range(4)])
    state = min(range(4), key=lambda s: (costs[-1][s] + INSERT * len(end_fills(s)), s))
    out = []
    for i in range(len(matrices) - 1, -1, -1):
        before = min(range(4), key=lambda a: (costs[i][a] + matrices[i][a][state], a))
        out.append((before, state))
        state = before
    return out[::-1]


def _plain(text: str | None) -> str:
    """The text, with nothing in it that reads as a marker."""
    return (text or "").replace("<|", "< |")


def _empty(role: int) -> str:
    return f"{OPEN}{ROLES[role]}\n{CLOSE}"


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation and task: the costs of its stretch, as 16 numbers. Rows come
    sorted, and only the running product is held."""
    schema = pa.schema([("talk", pa.string()), ("part", pa.int32()), ("costs", pa.list_(pa.int64()))])

    def rows():
        key, product_ = None, IDENTITY
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("talk", "part", "role")]
            for talk, part, role in zip(*columns):
                if (talk, part) != key:
                    if key is not None:
                        yield *key, sum(product_, [])
                    key, product_ = (talk, part), IDENTITY
                product_ = chained(product_, MATRIX[role_of(role)])
        if key is not None:
            yield *key, sum(product_, [])

    yield from in_batches(schema, rows())


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states between the stretches of each conversation."""
    schema = pa.schema(
        [
            ("talk", pa.string()),
            ("part", pa.int32()),
            ("before", pa.int32()),
            ("after", pa.int32()),
            ("last", pa.bool_()),
        ]
    )

    def rows():
        for group in sorted_groups(batches, ["talk"]):
            parts = group.column("part").to_pylist()
            grids = [[c[i : i + 4] for i in range(0, 16, 4)] for c in group.column("costs").to_pylist()]
            for part, (before, after) in zip(parts, chain(grids)):
                yield group.column("talk")[0].as_py(), part, before, after, part == parts[-1]

    yield from in_batches(schema, rows())


def _repaired(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for group in sorted_groups(batches, ["talk", "part"]):
                names = group.column("role").to_pylist()
                before, after = group.column("before")[0].as_py(), group.column("after")[0].as_py()
                steps = cheapest([role_of(name) for name in names], before, after)
                opened, last = before != START, group.column("last")[0].as_py()
                ids, turns = group.column("conv_id").to_pylist(), group.column("turn").to_pylist()
                for at, (step, state) in enumerate(steps):
                    text = _plain(group.column("text")[at].as_py())
                    if step.action == "merge":
                        shown = JOIN + text
                    else:
                        shown = CLOSE * opened + "".join(map(_empty, step.inserted)) + f"{OPEN}{ROLES[state]}\n{text}"
                    opened = True
                    added = end_fills(state) if last and at == len(steps) - 1 else ()
                    if last and at == len(steps) - 1:
                        shown += CLOSE + "".join(map(_empty, added))
                    inserted = len(step.inserted) + len(added)
                    cost = step.cost + INSERT * len(added)
                    yield ids[at], turns[at], names[at], ROLES[state], step.action, inserted, cost, shown

        yield from in_batches(schema, rows())

    return run


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id``, ``turn``, ``role``, ``new_role``, ``action`` (keep,
    relabel or merge), ``inserted`` (empty turns added before it, and after a last one),
    ``cost`` and ``fragment``. A conversation's fragments in order are its rendered sequence,
    so that none has to fit into one row.

    Turns are ordered by ``turn``, then role and a hash of the text; repeated rows are turns of
    their own. A null or unknown role can become any role, a null text is empty, null turns come
    first, and rows with a null ``conv_id`` form one conversation. Other columns are ignored.
    """
    small_batches(turns.sparkSession)
    chosen = turns.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("talk"),
        F.xxhash64("text").alias("tie"),
    )
    order = ["talk", "turn", "role", "tie"]
    placed = chosen.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    placed = materialize(placed, "turns")
    stretches = ["talk", "part"]
    sort = ["talk", "part", "turn", "role", "tie"]
    costs = placed.select(*sort).repartition(*stretches).sortWithinPartitions(*sort).select("talk", "part", "role")
    costs = costs.mapInArrow(_matrices, "talk string, part int, costs array<bigint>")
    ends = costs.repartition("talk").sortWithinPartitions(*stretches)
    ends = ends.mapInArrow(_ends, "talk string, part int, before int, after int, last boolean")
    hinted, _ = broadcast_if_small(materialize(ends, "turn-ends"))
    joined = placed.join(hinted, stretches).repartition(*stretches).sortWithinPartitions(*sort)
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema.fields}
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema(
        [
            ("conv_id", arrow[kinds["conv_id"]]),
            ("turn", arrow[kinds["turn"]]),
            ("role", pa.string()),
            ("new_role", pa.string()),
            ("action", pa.string()),
            ("inserted", pa.int32()),
            ("cost", pa.int32()),
            ("fragment", pa.string()),
        ]
    )
    return joined.mapInArrow(
        _repaired(schema),
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, new_role string, action string, "
        "inserted int, cost int, fragment string",
    )
