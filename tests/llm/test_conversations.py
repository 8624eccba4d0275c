"""The prefix trie against brute force: ties, nulls, repeated rows, copies, long conversations, slices of few rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from urbanlake.llm import conversations

R = random.Random(5)
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(paths):
    """(conv_id, sequence of turns) pairs to rows, from the definition."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, seq in paths:
        for d in range(len(seq) + 1):
            members[seq[:d]].add(c)
        ends[seq].append(c)
    rows, inner = [], {n[:-1] for n in members if n}
    for node, who in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if n not in inner]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        sha = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        rows.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children), len(leaves), saved, sha))
    return rows


def rebuilt(turns):
    """Conversations led by the first turns of the one that begins their twenty."""
    own = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()[:32], (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    out = []
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = abs(c) // 20 * 20 * (1 if c >= 0 else -1)
        out.append((c, tuple(own.get(base, [])[:h] + seq[h:])))
    return out


def key(row):
    return tuple("" if v is None else str(v) for v in row)


@pytest.mark.parametrize(("slice_rows", "last_rows"), [(1 << 15, 512), (1, 40), (3, 7), (5, 500)])
def test_trie_equals_brute_force(spark, slice_rows, last_rows):
    turns = []
    for c in [*range(100), -5, -40, 10**12]:
        if c % 20 == 0 and c % 40:
            continue  # some families have no conversation of their own
        for t in range(R.choice((1, 2, 3, 5, 9))):
            turns.append((c, R.choice((t, t, None)), R.choice(("user", None)), R.choice(("a b", "a  b\tc", None, "", "x", f"own {c}" if t > 3 else "d"))))
    for t in range(60):
        turns += [(7, t, "user", "go on"), (9, t, "user", "go on" if t != 50 else "stop")]
    turns += turns[:4] + [(None, 1, "user", "x")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as path", "2 as words", "3 as family")
    paths = conversations.conversation_paths(table, family=conversations.F.expr("conv_id - conv_id % 20"))
    paths = conversations.with_family_heads(paths, conversations.F.expr("crc32(cast(string(conv_id) as binary)) % 4"), 3)
    got = [key(r[c] for c in COLUMNS) for r in conversations.prefix_trie(paths, slice_rows, last_rows).collect()]
    assert sorted(got) == sorted(map(key, trie(rebuilt(turns))))


def test_copies_of_one_conversation_in_blocks_and_turnless_ones(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK", 10)
    rows = [(i, bytes(32) if i % 3 else b"", [2, 3] if i % 3 else []) for i in range(100)]
    got = [key(r[c] for c in COLUMNS) for r in conversations.prefix_trie(spark.createDataFrame(rows, "conv_id long, path binary, words array<int>")).collect()]
    assert sorted(got) == sorted(map(key, trie([(i, (("", "a b"), ("", "a b c")) if i % 3 else ()) for i in range(100)])))


def test_no_rows_and_texts_of_nodes(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.prefix_trie(conversations.conversation_paths(empty).select("conv_id", "path", "words")).collect() == []
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "bot", None), (2, 0, "user", "hi")], empty.schema)
    nodes = conversations.prefix_trie(conversations.conversation_paths(turns).select("conv_id", "path", "words"))
    got = {(r.conv_id, r.depth, r.n_convs, r.role, r.text) for r in conversations.node_turns(nodes, turns).collect()}
    assert got == {(1, 0, 2, None, None), (1, 1, 2, "user", "hi"), (1, 2, 1, "bot", "")}
