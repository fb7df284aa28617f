import hashlib
import random
import zlib

import pytest

from chronodim.llm import art, prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}
    members, ends = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        seq = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    kids = {}
    for s in members:
        if s:
            kids.setdefault(s[:-1], []).append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        below = kids.get(s, [])
        leaves[s] = sum(leaves[x] for x in below) if below else 1
        saved[s] = sum(saved[x] for x in below) + ((len(members[s]) - 1) * len(s[-1][1]) if s else 0)
    return sorted((min(m), len(s), min(members[s[:-1]]) if s else -1, len(m), len(kids.get(s, [])), leaves[s], saved[s],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(s, [])))).encode()).hexdigest()) for s, m in members.items())


def nodes(spark, rows):
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, node string").repartition(3)
    got = prefix_trie.trie(*prefix_trie.rebuild(df)).select(*COLUMNS).fillna(-1, ["parent_conv_id"]).collect()
    return sorted(tuple(r) for r in got)


def conversations(rng, n, longest, words):
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        k = 1 if rng.random() < 0.2 else rng.randint(1, longest)
        rows += [(c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.3 else "user", rng.choice(words)) for t in range(k)]
    return rows


@pytest.mark.parametrize("turns,slab,block", [(64, 20_000, 4096), (2, 7, 3), (3, 2, 1), (1, 5, 2)])
def test_against_brute_force(spark, monkeypatch, turns, slab, block):
    monkeypatch.setattr(prefix_trie, "TURNS", turns)
    monkeypatch.setattr(prefix_trie, "SLAB", slab)
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "SUPER", 2)
    rng = random.Random(5)
    rows = conversations(rng, 260, 9, ["a", "bé", "中文字", "dd dd"])
    rows += [(1000 + i, t, "user", f"same {t}") for i in range(60) for t in range(12)]  # copies, longer than their neighbours
    rows += [(2000, t, "user", f"same {t}") for t in range(14)]
    assert nodes(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_negative_ids(spark):
    rows = [(0, None, "u", "first"), (0, 1, None, None), (0, 1, "a", "x"), (0, 1, "a", "w"), (0, 1, "a", "w"), (1, 0, "u", ""), (1, 2, "u", "first"), (None, 0, "u", "lost"),
            (-5, 0, "u", "n"), (-5, 1, "u", "m"), (-100, 0, "u", "first"), (-100, 1, "", ""), (37, 5, "u", None), (90, 0, "u", "x" * 200_000), (91, 0, "u", "x" * 200_000)]
    assert nodes(spark, rows) == brute(rows)


def test_one_long_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TURNS", 4)
    monkeypatch.setattr(prefix_trie, "SUPER", 3)
    rows = [(7, t, "u", str(t % 3)) for t in range(90)] + [(8, t, "u", str(t % 3)) for t in range(70)] + [(9, 0, "u", "0")]
    assert nodes(spark, rows) == brute(rows)


def test_empty_table_has_no_nodes(spark):
    assert nodes(spark, [(None, 1, "u", "x")]) == []


def test_layouts_grow_and_find():
    rng = random.Random(1)
    tree, keys = art.Tree(), set()
    for n in (3, 10, 30, 200):
        keys |= {bytes([n, b]) + rng.randbytes(rng.randint(0, 6)) for b in rng.sample(range(256), n)}
    keys |= {k[:2] for k in keys}
    for k in keys:
        tree.insert(k, k)
    kinds = set()

    def walk(node, path):
        path += node.prefix
        assert node.value is None or node.value == path
        seen = [path] if node.value is not None else []
        if node.below:
            kinds.add((type(node.below).__name__, getattr(node.below, "room", 0)))
            for b, kid in node.below.items():
                assert node.below.find(b) is kid
                seen += walk(kid, path + bytes([b]))
        return seen

    assert walk(tree.root, b"") == sorted(keys)
    assert kinds == {("Sorted", 4), ("Sorted", 16), ("Indexed", 0), ("Direct", 0)}
