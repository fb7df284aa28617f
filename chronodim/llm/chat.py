"""Chat formatting with minimum-cost role repair.

A conversation is legal if it may open with one system turn and then
alternates user, assistant, user, ... up to an assistant turn.  A turn can be
kept, merged into the turn before it (same role), relabelled, or preceded by
inserted empty turns; dynamic programming over the states of the automaton
(start, system, user, assistant) finds the cheapest choice for the whole
conversation, and the repaired sequence is rendered.

A step of the program is a matrix of costs from state to state, and steps
compose, so a long conversation is solved in chunks of turns: first the
matrix of each chunk (roles only), then the states between chunks, then the
choices inside each chunk given its entry and exit state.  No conversation is
gathered whole.

Turns are ordered by (turn, role, text), null turns first.  Of ways of equal
cost the one with the smaller state at the end of each chunk is taken, then
inside the chunk, from its end.  Edge cases: roles are compared trimmed and in lower
case, common other names count as the role they mean; a null or unknown role
must be relabelled (cheaply); a null text renders as empty; repeated rows are
turns of their own; a conversation with a null id is one conversation; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from chronodim.llm.common import column, map_arrow, stage, table

STATES = ("start", "system", "user", "assistant")
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant"}
#: turns that may follow each state
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
MERGE, RELABEL, UNKNOWN, INSERT = 1, 3, 1, 2
FINAL = 3
CHUNK = 256
INF = 1 << 40


def role_number(role) -> int:
    r = (role or "").strip().lower()
    r = ALIASES.get(r, r)
    return STATES.index(r) if r in STATES[1:] else 0


def insertions() -> dict[tuple[int, int], tuple[int, ...]]:
    """Shortest sequences of inserted turns between two states so that the
    second may come next."""
    out = {}
    for s in range(4):
        paths, seen = [((), s)], {s}
        while paths:
            path, at = paths.pop(0)
            for t in NEXT[at]:
                out.setdefault((s, t), path)
                if t not in seen:
                    seen.add(t)
                    paths.append(((*path, t), t))
    return out


BEFORE = insertions()


def step_costs(role: int) -> np.ndarray:
    """Cost from each state to each state by a turn of ``role``."""
    m = np.full((4, 4), INF, np.int64)
    for s in range(4):
        for t in range(1, 4):
            change = 0 if t == role else RELABEL if role else UNKNOWN
            if (s, t) in BEFORE:
                m[s, t] = change + INSERT * len(BEFORE[s, t])
            if s == t:
                m[s, t] = min(m[s, t], change + MERGE)
    return m


STEPS = np.stack([step_costs(r) for r in range(4)])


def merges(role: int, s: int, t: int) -> bool:
    """Whether the cheapest way from s to t is a merge."""
    return s == t and MERGE <= INSERT * len(BEFORE.get((s, t), (0,) * 9))


def final_costs(final: int = FINAL) -> np.ndarray:
    """Cost to close from each state: nothing at the final state or before any
    turn, else insertions."""
    return np.array([0 if s in (0, final) else INSERT * (len(BEFORE[s, final]) + 1) for s in range(4)], np.int64)


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(INF, (a[:, :, None] + b[None, :, :]).min(axis=1))


def chunk_matrix(roles: list[int]) -> np.ndarray:
    m = np.full((4, 4), INF, np.int64)
    np.fill_diagonal(m, 0)
    for r in roles:
        m = compose(m, STEPS[r])
    return m


def path_through(mats: list[np.ndarray], entry: int, leave: np.ndarray) -> list[int]:
    """States after each matrix on the cheapest way from ``entry``; ``leave``:
    cost of each state at the end."""
    cost, back = np.full(4, INF, np.int64), []
    cost[entry] = 0
    for m in mats:
        ways = cost[:, None] + m
        back.append(ways.argmin(axis=0))
        cost = np.minimum(INF, ways.min(axis=0))
    state = int((cost + leave).argmin())
    out = []
    for b in reversed(back):
        out.append(state)
        state = int(b[state])
    return out[::-1]


def render_piece(previous: int, state: int, role: int, text: str, first: bool) -> tuple[list[tuple[str, str]], str, str]:
    """Inserted (role, rendered) pieces, the turn's action and its rendering."""
    if merges(role, previous, state):
        return [], "merge" if role == state else "relabel+merge", f"\n\n{text}"
    before, open_ = [], first
    for t in BEFORE[previous, state]:
        before.append((STATES[t], ("" if open_ else "<|end|>\n") + f"<|{STATES[t]}|>\n"))
        open_ = False
    return before, "keep" if role == state else "relabel", ("" if open_ else "<|end|>\n") + f"<|{STATES[state]}|>\n{text}"


def closing(state: int, final: int = FINAL) -> list[tuple[str, str]]:
    turns = () if state in (0, final) else (*BEFORE[state, final], final)
    return [(STATES[t], f"<|end|>\n<|{STATES[t]}|>\n") for t in turns]


def turns_of(df: DataFrame, chunk: int) -> DataFrame:
    """conv_id, chunk key (c1, c2), turn, role, text, order hash.  A chunk
    spans ``chunk`` turn numbers; one that ties still overfill is split by the
    order within the tie."""
    rows = df.select(column("conv_id").alias("conv_id"), column("turn").cast("long").alias("turn"), column("role").cast("string").alias("role"), column("text").cast("string").alias("text"))
    rows = rows.withColumn("c1", F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-(1 << 62))).cast("long"))
    crowded = rows.groupBy("conv_id", "c1").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 8 * chunk) \
        .select(F.col("conv_id").alias("k"), F.col("c1").alias("k1"))
    least = F.lit("\x01")  # sorts before any character of a role
    split = F.concat(F.lpad(F.coalesce(F.pmod("turn", F.lit(chunk)), F.lit(0)).cast("string"), 20, "0"), least, F.coalesce("role", F.lit("")), least, F.substring(F.coalesce("text", F.lit("")), 1, 24))
    return rows.join(crowded, F.col("conv_id").eqNullSafe(F.col("k")) & (F.col("c1") == F.col("k1")), "left") \
        .withColumn("c2", F.when(F.col("k1").isNotNull(), split).otherwise("")).drop("k", "k1")


def in_order(rows: list[tuple]) -> list[tuple]:
    """(turn, role, text) rows of a chunk in the order of the conversation."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))


def by_group(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """``fn(key, rows)`` gives output tuples for the rows of each key, which
    lie together in a partition; groups stream through a task one by one."""
    kinds = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kinds)
    n = len(keys)

    def run(batches):
        out = []
        stream = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True))
        for key, rows in itertools.groupby(stream, key=lambda r: r[:n]):
            out += fn(key, [r[n:] for r in rows])
            if len(out) > 4000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    rest = [c for c in df.columns if c not in keys]
    return map_arrow(df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys), run, kinds)


def repair(df: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each piece of each repaired conversation: conv_id, pos
    (order of the turn in the conversation), part (order within the turn),
    turn and from_role (as given; null for inserted turns), role, action (keep, merge, relabel,
    relabel+merge, insert, close) and rendered.  The pieces in order of (pos,
    part) are the rendered conversation."""
    conv = df.schema["conv_id"].dataType.simpleString()
    rows = turns_of(df, chunk)

    # 1. the matrix of each chunk; the order of a tie in role needs no text
    def matrices(key, found):
        m = chunk_matrix([role_number(r[1]) for r in in_order([(*r, "") for r in found])])
        return [(*key, len(found), m.ravel().tolist())]

    chunks = by_group(rows.select("conv_id", "c1", "c2", "turn", "role"), ["conv_id", "c1", "c2"], matrices,
                      f"conv_id {conv}, c1 long, c2 string, n long, m array<long>")

    # 2. the states between the chunks of a conversation
    def between(key, found):
        found = sorted(found, key=lambda r: r[:2])
        states = path_through([np.array(r[3], np.int64).reshape(4, 4) for r in found], 0, final_costs())
        out, start = [], 0
        for k, (c1, c2, n, _) in enumerate(found):
            out.append((*key, c1, c2, states[k - 1] if k else 0, states[k], start, k == len(found) - 1))
            start += n
        return out

    ends = stage(by_group(chunks, ["conv_id"], between, f"k {conv}, k1 long, k2 string, entry int, leave int, start long, last boolean"), "chat-chunks")

    # 3. the choices inside each chunk
    def choices(key, rows_):
        entry, leave, start, last = rows_[0][3:]
        found = in_order([r[:3] for r in rows_])
        numbers = [role_number(r[1]) for r in found]
        exit_ = np.full(4, INF, np.int64)
        exit_[leave] = 0
        states = path_through([STEPS[r] for r in numbers], entry, exit_)
        out, before = [], entry
        for k, ((turn, given, text), number, state) in enumerate(zip(found, numbers, states, strict=True)):
            inserted, action, rendered = render_piece(before, state, number, text or "", start + k == 0)
            out += [(key[0], start + k, i, None, None, r, "insert", x) for i, (r, x) in enumerate(inserted)]
            out.append((key[0], start + k, len(inserted), turn, given, STATES[state], action, rendered))
            before = state
        if last:
            close = closing(before)
            out += [(key[0], start + len(found), i, None, None, r, "insert", x) for i, (r, x) in enumerate(close)]
            out.append((key[0], start + len(found), len(close), None, None, STATES[FINAL], "close", "<|end|>\n"))
        return out

    met = rows.join(ends, F.col("conv_id").eqNullSafe(F.col("k")) & (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2"))) \
        .select("conv_id", "c1", "c2", "turn", "role", "text", "entry", "leave", "start", "last")
    return by_group(met, ["conv_id", "c1", "c2"], choices,
                    f"conv_id {conv}, pos long, part int, turn long, from_role string, role string, action string, rendered string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: the repaired and rendered pieces of every conversation."""
    return repair(table(spark, sf_dir, "conversations"))
