import hashlib
import random
import re
import zlib

import pytest

from compare import connect, differences
from sluicebox.llm import conversation_trie, ordered_hash
from sluicebox.llm.conversation_trie import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns.setdefault(conv, []).append((turn is not None, turn or 0, tie, (role, text)))
    turns = {conv: [x[3] for x in sorted(some)] for conv, some in turns.items()}
    whole = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        whole[conv] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for conv, sequence in whole.items():
        for depth in range(len(sequence) + 1):
            members.setdefault(sequence[:depth], []).append(conv)
    found = []
    for node, convs in members.items():
        below = [other for other in members if other[: len(node)] == node]
        leaves = [other for other in below if not any(x[:-1] == other and x for x in members)]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        ends = ",".join(str(conv) for conv in sorted(convs) if whole[conv] == node)
        children = sum(len(x) == len(node) + 1 for x in below)
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(convs), len(node), parent, len(convs), children, len(leaves), saved, sha))
    return sorted(found, key=str)


def trie_of(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA) if rows else spark.createDataFrame([], SCHEMA)
    return sorted((tuple(row) for row in prefix_trie(df).select(COLUMNS).collect()), key=str)


def test_equals_sql(spark):
    assert differences(spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01", "op13_conversation_trie") == []


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, seed, monkeypatch):
    """Few texts, so that conversations share beginnings; ties, repeated rows, NULLs, negative ids, one long conversation."""
    monkeypatch.setattr(conversation_trie, "BLOCK", 4)
    monkeypatch.setattr(ordered_hash, "CHUNK", 3)
    draw = random.Random(seed)
    rows = []
    for conv in [None, *range(-25, 60)]:
        if conv is None or draw.random() < 0.8:
            for turn in range(draw.choice([1, 2, 3, 5])):
                text = draw.choice(["a", "a", "b b", "", None, "  x\ty "])
                rows.append((conv, draw.choice([turn, turn, 0, None]), draw.choice(["user", "user", None]), text))
    rows += [(61, turn, "user", draw.choice(["a", "b b"])) for turn in range(40)] + rows[:7]
    assert trie_of(spark, rows) == brute_force(rows)


def test_edges(spark):
    assert trie_of(spark, []) == [] and trie_of(spark, [(None, 1, "user", "a")]) == []
    # 3 takes its first two turns from a conversation that is not there, and has no more of its own.
    assert zlib.crc32(b"3") % 4 >= 1
    assert trie_of(spark, [(3, 0, "user", "x")]) == brute_force([(3, 0, "user", "x")])
    assert len(trie_of(spark, [(3, 0, "user", "x")])) == 1
    long = [(40, turn, "user", "word " * 50_000) for turn in range(2)]
    assert trie_of(spark, long) == brute_force(long)
    df = spark.createDataFrame([(*row, 7, "x") for row in long], SCHEMA + ", depth long, n_convs string")
    assert sorted((tuple(row) for row in prefix_trie(df).collect()), key=str) == brute_force(long)


def test_joined_sha256(spark):
    rows = [("x", i) for i in (10, 9, 100, -1)] * 2 + [("y", 5)]
    found = dict(ordered_hash.joined_sha256(spark.createDataFrame(rows, "key string, value long")).collect())
    assert found == {"x": hashlib.sha256(b"-1,-1,9,9,10,10,100,100").hexdigest(), "y": hashlib.sha256(b"5").hexdigest()}
