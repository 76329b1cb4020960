"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system message, then user and assistant in turn, ending with the assistant. Each
turn is kept, merged into the message before (MERGE), relabelled (RELABEL; an unknown role RENAME) or preceded by an
empty message (INSERT). Dynamic programming over the states of that automaton finds the least cost, with fewest
insertions, then fewest merges among equals. The repaired sequence is rendered turn by turn.

Costs of a stretch of turns from each state to each other form a matrix, and stretches combine by (min, +) products.
So conversations are range-partitioned by (conversation, turn), and a long one may span many partitions: only the
first and the last stretch of each partition, two small matrices, go to the driver, which chooses the states at the
seams. The partitioned turns are cut off in the shared folder, so that both passes see the same stretches.

Defined results. Null or unknown role: renamed to what fits. Null text: empty. Null conversation id: one more
conversation. Null turn: after all turns. Equal turns: ordered by a hash of role and text. Repeated rows: all stay.
Turns are integers, or text that holds one; any other is an error. Very long texts are carried whole. Empty table: no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.durable import checkpoint

ROLES = ("system", "user", "assistant")
MERGE, RELABEL, RENAME, INSERT = 1, 2, 1, 3

#: States: nothing yet, then after a message of each role. New messages may follow so:
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}

#: A cost counts price, insertions and merges in one number, in that order of weight.
_PRICE, _INSERTED, _MERGED = 1 << 80, (1 << 40) + INSERT * (1 << 80), 1 + MERGE * (1 << 80)
NEVER = 1 << 200

Step = tuple[int, tuple[int, ...], int, bool]  # cost, inserted roles, role taken, merged


def _steps(role: str | None) -> list[list[Step | None]]:
    """The cheapest way to take a turn of this role from each state to each other."""
    out: list[list[Step | None]] = [[None] * 4 for _ in STATES]
    for state in STATES:
        befores = [((), state)] + [((new,), new) for new in NEXT[state]]
        for inserted, at in befores:
            for taken in (SYSTEM, USER, ASSISTANT):
                relabel = 0 if role == ROLES[taken - 1] else RELABEL if role in ROLES else RENAME
                base = len(inserted) * _INSERTED + relabel * _PRICE
                options = [(base, inserted, taken, False)] if taken in NEXT[at] else []
                if taken == at and not inserted:
                    options.append((base + _MERGED, inserted, taken, True))
                for step in options:
                    if out[state][taken] is None or step < out[state][taken]:
                        out[state][taken] = step
    return out


STEPS = {role: _steps(role) for role in (*ROLES, None)}
#: What closing a conversation in each state inserts.
CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def _known(role: str | None) -> str | None:
    role = (role or "").strip().lower()
    return role if role in ROLES else None


def costs_from(entry: int, roles: list[str | None]) -> list[int]:
    """The least costs of the turns from state `entry` to each state."""
    now = [0 if s == entry else NEVER for s in STATES]
    for role in roles:
        steps = STEPS[role]
        now = [min((now[s] + steps[s][t][0] for s in STATES if steps[s][t] and now[s] < NEVER), default=NEVER) for t in STATES]
    return now


def close(costs: list[int]) -> tuple[int, int]:
    """(cost, state) of the cheapest end."""
    return min((costs[s] + len(CLOSING[s]) * _INSERTED, s) for s in STATES)


def path(entry: int, roles: list[str | None], leave: int | None) -> tuple[list[Step], int]:
    """The cheapest steps from `entry` to `leave`, or to the cheapest end, and the last state."""
    tables = [[0 if s == entry else NEVER for s in STATES]]
    for role in roles:
        steps, now = STEPS[role], tables[-1]
        tables.append([min((now[s] + steps[s][t][0] for s in STATES if steps[s][t] and now[s] < NEVER), default=NEVER) for t in STATES])
    state = close(tables[-1])[1] if leave is None else leave
    end, out = state, []
    for role, now, then in zip(reversed(roles), reversed(tables[:-1]), reversed(tables[1:]), strict=True):
        before = next(s for s in STATES if STEPS[role][s][state] and now[s] < NEVER and now[s] + STEPS[role][s][state][0] == then[state])
        out.append(STEPS[role][before][state])
        state = before
    return out[::-1], end


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, list[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for (part, conv), own in groupby(rows, key=lambda r: (r["part"], r["conv"])):
        yield part, conv, list(own)


_SEAMS = pa.schema([("part", pa.int32()), ("conv", pa.int64()), ("turns", pa.int64()), ("matrix", pa.string())])


def _seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matrices of a partition's first and last stretch."""
    first, last = None, None
    for part, conv, rows in _stretches(batches):
        last = (part, conv, [_known(r["role"]) for r in rows])
        first = first or last
    for part, conv, roles in [first, last][: 1 + (first is not last)] if first else []:
        matrix = ",".join(str(c) for s in STATES for c in costs_from(s, roles))
        yield pa.RecordBatch.from_pylist([{"part": part, "conv": conv, "turns": len(roles), "matrix": matrix}], schema=_SEAMS)


def _entries(seams: list) -> dict[tuple[int, int | None], tuple[int, int | None, int, int]]:
    """Of each stretch at a seam: the states it begins and ends in (None: the conversation ends), and the fragments
    and messages before it."""
    out = {}
    for conv, own in groupby(sorted(seams, key=lambda r: (r.conv is not None, r.conv, r.part)), key=lambda r: r.conv):
        own = list(own)
        matrices = [[[int(x) for x in r.matrix.split(",")][4 * s : 4 * s + 4] for s in STATES] for r in own]
        to_go = [[len(CLOSING[s]) * _INSERTED for s in STATES]]
        for m in reversed(matrices[1:]):
            to_go.append([min(m[s][t] + to_go[-1][t] for t in STATES) for s in STATES])
        state, fragments, messages = START, 0, 0
        for i, (r, m, after) in enumerate(zip(own, matrices, reversed(to_go), strict=True)):
            leave = min(STATES, key=lambda t: (m[state][t] + after[t], t))
            out[r.part, conv] = (state, None if i == len(own) - 1 else leave, fragments, messages)
            inserted, merged = (m[state][leave] >> 40) % (1 << 40), m[state][leave] % (1 << 40)
            fragments += r.turns + inserted
            messages += r.turns + inserted - merged
            state = leave
    return out


_FRAGMENTS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("message_no", pa.int64()), ("turn", pa.int64()), ("action", pa.string()), ("role", pa.string()), ("text", pa.string()), ("rendered", pa.string())])


def _render(entries: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, conv, rows in _stretches(batches):
            entry, leave, place, message = entries.get((part, conv), (START, None, 0, 0))
            steps, end = path(entry, [_known(r["role"]) for r in rows], leave)
            out = []

            def add(role: int, action: str, turn: int | None, text: str, merged: bool = False) -> None:
                nonlocal place, message
                message += not merged
                head = "\n" if merged else ("<|end|>\n" if message > 1 else "") + f"<|{ROLES[role - 1]}|>\n"
                out.append({"conv_id": conv, "place": place, "message_no": message - 1, "turn": turn, "action": action, "role": ROLES[role - 1], "text": text, "rendered": head + text})  # noqa: B023
                place += 1

            for row, (_, inserted, taken, merged) in zip(rows, steps, strict=True):
                for role in inserted:
                    add(role, "insert", None, "")
                same = _known(row["role"]) == ROLES[taken - 1]
                add(taken, ("" if same else "relabel+") * merged + "merge" if merged else "keep" if same else "relabel", row["turn"], row["text"] or "", merged)
            if leave is None:
                for role in CLOSING[end]:
                    add(role, "insert", None, "")
                out[-1]["rendered"] += "<|end|>\n"
            for start in range(0, len(out), 4096):
                yield pa.RecordBatch.from_pylist(out[start : start + 4096], schema=_FRAGMENTS)

    return run


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Fragments of the repaired conversations: conv_id, place (order), message_no, turn (null if inserted), action,
    role, text and rendered. A conversation's rendered fragments in order are its formatted text."""
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    own = own.withColumn("tie", F.xxhash64("role", "text"))
    order = ["conv", F.col("turn").asc_nulls_last(), "tie", "row"]
    dealt = own.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    dealt = checkpoint(dealt.select(F.spark_partition_id().alias("part"), "conv", "turn", "role", "text"))
    seams = dealt.select("part", "conv", "role").mapInArrow(_seams, "part int, conv long, turns long, matrix string").collect()
    return dealt.mapInArrow(_render(_entries(seams)), "conv_id long, place long, message_no long, turn long, action string, role string, text string, rendered string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: every conversation repaired and rendered, a row for each fragment."""
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
