"""The conversation trie against a dictionary of all beginnings."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from bloomline.llm import prefix_trie as pt


def plain_rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    lists = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = lists.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain_trie(sequences):
    members, ends = defaultdict(list), defaultdict(list)
    for c, items in sequences.items():
        for d in range(len(items) + 1):
            members[tuple(items[:d])].append(c)
        ends[tuple(items)].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        listed = ",".join(map(str, sorted(ends[node])))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids), leaves, saved,
                    hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, frame, rebuild=True, **settings):
    turns = pt.encode_turns(frame)
    nodes = pt.prefix_trie(pt.shared_sequences(turns) if rebuild else pt.own_sequences(turns), **settings).select(*COLUMNS).collect()
    return sorted(map(tuple, nodes), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for c in rng.sample(range(0, 400), 150):
        for t in range(rng.randint(1, 11)):
            out.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "long " * 50])))
    for c in range(500, 620):  # copies, with one common first turn
        out += [(c, t, "user", "same") for t in range(3)]
    out += [(700, t, "user", f"turn {t % 7}") for t in range(300)]  # a long one
    out += [(5, 0, "user", "x"), (5, 0, "user", "x"), (6, 0, "user", "x"), (None, 0, "user", "x"), (-3, 1, "user", "y"), (-5, 1, "user", "z")]
    rng.shuffle(out)
    return out


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


@pytest.mark.parametrize("settings", [{}, {"shard_bytes": 200, "last_bytes": 3000}, {"shard_bytes": 2000, "last_bytes": 20_000}])
@pytest.mark.parametrize("rebuild", [True, False])
def test_trie(spark, rows, settings, rebuild):
    sequences = plain_rebuilt(rows) if rebuild else plain_sequences(rows)
    assert found(spark, frame_of(spark, rows), rebuild, **settings) == plain_trie(sequences)


def plain_sequences(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}


def test_turnless_conversation_belongs_to_the_root(spark):
    # Of 3 (h = 3) nothing is left: its own turns are within the head, and conversation 0 doesn't exist.
    rows = [(3, 0, "user", "a"), (11, 0, "user", "b")]
    sequences = plain_rebuilt(rows)
    assert [] in sequences.values()
    assert found(spark, frame_of(spark, rows)) == plain_trie(sequences)


def test_empty_and_clashing_columns(spark, rows):
    frame = frame_of(spark, rows)
    assert found(spark, frame.limit(0)) == []
    clash = frame.selectExpr("*", "1 AS pos", "'x' AS digest", "2 AS size", "'p' AS path", "3 AS base", "4 AS key")
    assert found(spark, clash) == plain_trie(plain_rebuilt(rows))


def test_trees_of_sorted_sequences_are_balanced():
    tree = pt.SearchTree()
    sequences = [[i] for i in range(1023)]
    for i in pt.medians(1023):
        tree.insert(sequences[i])
    height, level = 0, [tree.inner[0]]
    while level:
        height, level = height + 1, [n for x in level for n in (tree.lower[x], tree.higher[x]) if n >= 0]
    assert height == 10
    order = tree.preorder()
    assert sorted(order) == list(range(1024)) and order[0] == 0
