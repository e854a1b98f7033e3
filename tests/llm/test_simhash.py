import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from nightgrid.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_components(prints, distance=3):
    """Smallest reachable position of each."""
    label = list(range(len(prints)))
    codes = np.array(prints, np.uint64)
    changed = True
    while changed:
        changed = False
        for i in range(len(codes)):
            near = np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= distance)
            low = min(label[j] for j in near)
            for j in near:
                if label[j] > low:
                    label[j], changed = low, True
    return label


def test_against_brute_force(spark, any_dir, texts):
    rows = sorted(((i, t) for i, t in texts(any_dir) if i is not None), key=lambda r: r[0])
    prints = [brute_fingerprint(t) for _, t in rows]
    label = brute_components(prints)
    want = {(rows[k][0], f"{prints[k]:016x}", rows[label[k]][0]) for k in range(len(rows))}
    got = {tuple(r) for r in simhash.op1_simhash_near_dedup(spark, any_dir).collect() if r.doc_id is not None}
    assert got == want


@pytest.fixture(scope="module")
def clustered():
    """Clusters around random codes, chains among them, and one dense group."""
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 60, dtype=np.uint64) << np.uint64(1)
    codes = [int(c) ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for c in centres for _ in range(8)]
    codes += [int(centres[0]) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))]
    return sorted(set(codes))


@pytest.mark.parametrize("group_rows", [1 << 14, 10])
def test_links_of_codes(spark, clustered, monkeypatch, group_rows):
    """Also where a key's group is cut into tiles."""
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    signed = np.array(clustered, np.uint64).view(np.int64).tolist()
    rows = spark.createDataFrame(list(enumerate(signed)), "id long, code long")
    got = {r.id: r.component_id for r in simhash.link_fingerprints(rows, "id").collect()}
    assert got == dict(enumerate(brute_components(clustered)))


def test_gray_order_keeps_leading_bits_together():
    codes = np.arange(256, dtype=np.uint64)
    order = codes[np.argsort(simhash.gray_rank(codes))]
    assert all(bin(int(a) ^ int(b)).count("1") == 1 for a, b in zip(order, order[1:], strict=False))


def test_long_chain_of_links(spark):
    links = spark.range(60).select(F.col("id").alias("node"), (F.col("id") + 1).alias("root"))
    assert {tuple(r) for r in simhash.components(links).collect()} == {(k, 0) for k in range(61)}


def test_similar_documents(spark):
    base = [f"w{i * 7919 % 1000}" for i in range(300)]
    near = base[:150] + ["changed"] + base[151:]
    far = base[:100] + [f"z{i}" for i in range(200)]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (9, " ".join(far)), (7, " ".join(base).upper()), (1, "short"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(docs).collect()}
    assert got == {5: 3, 3: 3, 7: 3, 9: 9, 1: 1, 2: 2}
