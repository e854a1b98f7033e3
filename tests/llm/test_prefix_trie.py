"""The trie against a dictionary of all prefixes."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from nightgrid.llm import prefix_trie as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows):
    own = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            own[r.conv_id].append(((r.turn is not None, r.turn or 0), r.role or "", r.text or ""))
    for turns in own.values():
        turns.sort()
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(t[1:] for t in own.get(base, [])[:h] + own[c][h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[: d - 1]].add(s[:d])
    leaves, saved, out = {}, {}, []
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[x] for x in children[s]) if children[s] else 1
        mine = (len(members[s]) - 1) * (len(WORD.findall(s[-1][1])) if s else 0)
        saved[s] = mine + sum(saved[x] for x in children[s])
        ends = ",".join(str(c) for c in sorted(c for c in members[s] if len(whole[c]) == len(s)))
        up = min(members[s[:-1]]) if s else None
        out.append((min(members[s]), len(s), up, len(members[s]), len(children[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("where", ["odd", "sf0.001", "sf0.01"])
def test_nodes_equal_brute_force(spark, odd_dir, where):
    path = odd_dir if where == "odd" else f"/root/testdata/{where}"
    table = spark.read.parquet(f"{path}/conversations.parquet")
    found = sorted((tuple(r) for r in T.op12_conversation_prefix_trie(spark, path).collect()), key=repr)
    assert found == brute_force(table.collect())


def hot_rows():
    """One conversation of most turns, one repeated by hundreds, one first turn before many others."""
    rows = [(20_000, i, "user", f"turn {i % 7}") for i in range(1500)]
    rows += [(c, i, "user", f"same {i}") for c in range(20, 620) for i in range(2)]
    rows += [(c, i, "bot", "opening" if not i else f"different {c}") for c in range(1000, 1400) for i in range(3)]
    return rows


def test_hot_conversations_and_members(spark, monkeypatch):
    monkeypatch.setattr(T, "SEGMENT_IDS", 16)
    table = spark.createDataFrame(hot_rows(), "conv_id long, turn long, role string, text string")
    trie = T.prefix_trie(table)
    assert sorted((tuple(r) for r in trie.nodes.collect()), key=repr) == brute_force(table.collect())
    sequences = trie.sequences.collect()
    assert sum(r.weight for r in sequences) == 1 + 600 + 400
    listed = [int(x) for r in trie.members.collect() for x in r.ids.split(",")]
    assert sorted(listed) == sorted({r[0] for r in hot_rows()})
    assert max(r.n for r in trie.members.collect()) <= 600


def test_other_families(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in range(12) for t in range(3)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    # Nothing is taken from others: twelve paths of three turns.
    nodes = T.prefix_trie(table, family=5, most=1).nodes
    assert nodes.count() == 1 + 36 and nodes.where("n_convs > 1").count() == 1
