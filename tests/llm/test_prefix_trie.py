"""The prefix trie against tries built in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

from feedflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, owner string, at string, part int"


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in turns.items()}
    rebuilt = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + x[h:])
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own_members in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(own_members) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, own_members in members.items():
        ends = ",".join(str(c) for c in own_members if len(rebuilt[c]) == len(node))
        out.append((own_members[0], len(node), members[node[:-1]][0] if node else None, len(own_members), children[node], leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    assert sorted(map(tuple, prefix_trie.trie(df).collect()), key=str) == plain(rows)


def made(rng, convs, longest=7):
    rows = []
    for c in convs:
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(["hi", "ok, then", "", "ü", "more"])))
    return rows


def test_equals_plain_tries(spark):
    rng = random.Random(3)
    odd = [(700, None, None, None), (701, None, "user", None), (701, None, "user", None), (None, 0, "user", "x"), (702, 3, "user", "a"), (702, 3, "user", "b"), (702, 3, "a", "ub")]
    check(spark, made(rng, range(250)) + made(rng, range(300, 320), 2) + odd)


def test_deep_conversations_cross_many_bands(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BAND", 3)
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 2)
    long = [(turn, "user", f"turn {turn}") for turn in range(40)]
    rows = [(c, *turn) for c in range(40) for turn in (long if c % 2 else long[: 5 + c])] + [(60 + c, *turn) for c in range(6) for turn in long[:30] + [(40 + c, "user", str(c))]]
    check(spark, rows)


def test_copies_and_empty_tables(spark):
    check(spark, [(c, turn, "user", "same") for c in range(5000, 5090) for turn in range(3)])
    check(spark, [])
    check(spark, [(None, 1, "user", "x")])
