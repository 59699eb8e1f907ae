"""The prefix trie against a plain one, over shards of every size."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from orewright.llm.prefix_trie import COLUMNS, conversation_paths, prefix_trie, regrown_paths

SCHEMA = "conv_id long, turn long, role string, text string, n_convs int, key string, ids string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(rows):
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append((t is not None, t or 0, role, digest, text))
    return {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in convs.items()}


def regrown(convs):
    out = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(int(c - math.fmod(c, 100)), [])[:h] + v[h:]
    return out


def brute(convs):
    members, kids = collections.defaultdict(list), collections.Counter()
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    leaves, saved = collections.Counter(), collections.Counter()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not kids[p]
        saved[p] += (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        if p:
            kids[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        above = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), above, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def nodes(df):
    return sorted((tuple(r) for r in df.select(NODE).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "i") for r in rows], SCHEMA)


def odd_conversations():
    draw = random.Random(12)
    rows = []
    for c in range(-150, 450):
        for t in range(draw.choice([0, 0, 1, 1, 2, 3, 4, 6, 9])):
            rows.append((c, t if draw.random() < 0.95 else None, draw.choice(["user", "assistant", None]), draw.choice(["a", "bb", None, "é𝄞" * 9])))
    rows += [(c, t, "user", "same") for c in range(1000, 1300) for t in range(3)]  # a hot conversation
    long = 2 * COLUMNS + 6
    rows += [(c, t, "u", f"x{t % 3}") for c, n in ((2000, long), (2001, long), (2002, long - 30), (2003, COLUMNS)) for t in range(n)]
    rows += [(2004, 0, "u", "y" * 100_000), (None, 0, "u", "nobody"), rows[3], rows[3]]
    return rows


@pytest.mark.parametrize("turns", [1_000_000, 500, 40])
def test_trie_equals_brute_force(ready, turns):
    rows = odd_conversations()
    got = nodes(prefix_trie(regrown_paths(conversation_paths(frame(ready, rows))), turns))
    assert got == brute(regrown(turns_of(rows)))


def test_trie_of_conversations_as_they_are(ready):
    rows = odd_conversations()
    assert nodes(prefix_trie(conversation_paths(frame(ready, rows)), 300)) == brute(turns_of(rows))


def test_one_conversation_over_many_shards(ready):
    """All shards but the outer ones hold nothing but one path."""
    ids = np.arange(5000).tolist()
    rows = [(c, t, "u", "x" * t) for c in ids for t in range(3)] + [(6000, 0, "u", ""), (6001, 0, "a", "z")]
    got = nodes(prefix_trie(conversation_paths(frame(ready, rows)), 700))
    assert got == brute(turns_of(rows))


def test_nothing_and_only_turnless(ready):
    assert nodes(prefix_trie(conversation_paths(frame(ready, [])))) == []
    assert nodes(prefix_trie(conversation_paths(frame(ready, [(None, 1, "u", "x")])))) == []
    paths = ready.createDataFrame([(5, [], []), (3, [], [])], "conv_id long, ids array<string>, sizes array<int>")
    assert nodes(prefix_trie(paths)) == brute({3: [], 5: []})
