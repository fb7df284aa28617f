import itertools
import random

from chronodim.llm import chat


def cost_of(roles, choice, final=3):
    """Cost of choosing for each turn a role and whether it merges, or None."""
    cost, state = 0, 0
    for r, (t, merge) in zip(roles, choice, strict=True):
        cost += 0 if t == r else chat.RELABEL if r else chat.UNKNOWN
        if merge:
            if t != state:
                return None
            cost += chat.MERGE
        elif (state, t) in chat.BEFORE:
            cost += chat.INSERT * len(chat.BEFORE[state, t])
        else:
            return None
        state = t
    return cost + int(chat.final_costs(final)[state])


def test_dynamic_program_is_optimal():
    rng = random.Random(1)
    for _ in range(60):
        roles = [rng.randrange(4) for _ in range(rng.randint(1, 4))]
        options = list(itertools.product((1, 2, 3), (False, True)))
        best = min(c for ch in itertools.product(options, repeat=len(roles)) if (c := cost_of(roles, ch)) is not None)
        states = chat.path_through([chat.STEPS[r] for r in roles], 0, chat.final_costs())
        at, total = 0, 0
        for r, s in zip(roles, states, strict=True):
            total += int(chat.STEPS[r][at, s])
            at = s
        assert total + int(chat.final_costs()[at]) == best


def rendered(out):
    text = {}
    for r in sorted(out.collect(), key=lambda r: (str(r.conv_id), r.pos, r.part)):
        text[r.conv_id] = text.get(r.conv_id, "") + r.rendered
    return text


ROWS = [(1, 0, "user", "a"), (1, 1, "assistant", "b"),
        (2, 0, "Human", "a"), (2, 1, "user", "b"), (2, 2, "GPT", None), (2, 3, "system", "late"),
        (3, 0, "assistant", "first"), (None, None, None, ""), (5, 0, "system", "s"),
        (6, 0, "user", "x"), (6, 0, "user", "x"), (6, 1, "bot", "y")]


def test_rendering_and_chunks(spark):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "conv_id long, turn long, role string, text string, pos int")
    whole = rendered(chat.repair(df))
    assert whole[1] == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n"
    assert whole[3] == "<|user|>\n<|end|>\n<|assistant|>\nfirst<|end|>\n"
    assert whole[5] == "<|system|>\ns<|end|>\n<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert whole[6] == "<|user|>\nx\n\nx<|end|>\n<|assistant|>\ny<|end|>\n"
    assert len(whole) == 6
    assert rendered(chat.repair(df, chunk=1)) == whole
    assert chat.repair(df.limit(0)).count() == 0


def total_cost(out):
    cost = {"keep": 0, "close": 0, "merge": chat.MERGE, "insert": chat.INSERT}
    total = 0
    for r in out.collect():
        if "relabel" in r.action:
            total += (chat.RELABEL if chat.role_number(r.from_role) else chat.UNKNOWN) + (chat.MERGE if "merge" in r.action else 0)
        else:
            total += cost[r.action]
    return total


def legal(text):
    import re

    roles = re.findall(r"<\|(system|user|assistant)\|>", text)
    body = roles[1:] if roles[0] == "system" else roles
    return len(body) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body))


def test_long_conversation_in_chunks(spark):
    rng = random.Random(7)
    rows = [(1, i // 3, rng.choice(["user", "assistant", "system", "odd", None]), f"t{rng.randrange(9)}") for i in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    crowded = spark.createDataFrame([(1, 0, r, t) for _, _, r, t in rows], df.schema)  # every turn number the same
    for frame, small in ((df, 7), (crowded, 4)):
        a, b = chat.repair(frame, chunk=1000), chat.repair(frame, chunk=small)
        assert total_cost(a) == total_cost(b)
        assert legal(rendered(a)[1]) and legal(rendered(b)[1])
