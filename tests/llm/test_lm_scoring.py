"""Counts and base scores against brute force; the model against its own definition and held-out texts."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightgrid.llm import pitman_yor as P
from nightgrid.llm.lm_scoring import op13_lm_scoring, score_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7


def test_counts_and_base_scores(spark, any_dir):
    docs = spark.read.parquet(f"{any_dir}/documents.parquet").select("doc_id", "text").collect()
    tokens = [[*WORD.findall((r.text or "").translate(LOWER)), None] for r in docs]
    counts = Counter(w for r, t in zip(docs, tokens, strict=True) if fold(r.doc_id) not in (None, 2) for w in t)
    n = sum(counts.values())
    expected = sorted(
        (repr(r.doc_id), fold(r.doc_id) == 2, len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in t))
        for r, t in zip(docs, tokens, strict=True)
    )
    rows = op13_lm_scoring(spark, any_dir).collect()
    found = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows)
    assert [f[:5] for f in found] == [e[:5] for e in expected]
    assert np.allclose([f[5] for f in found], [e[5] for e in expected], rtol=1e-9)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in rows)


def test_better_than_single_words_on_held_out_texts(spark):
    rows = op13_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > 0.93 * sum(r.base_score for r in rows)


def scored(spark, texts, learned, **options):
    rows = [(i, t, i < learned, i >= learned) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean, held_out boolean").repartition(3)
    return {r.doc_id: r for r in score_documents(df, **options).collect()}


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 60])
def test_probabilities_add_up(spark, bucket_bytes):
    """Of all texts of up to six words; most of the learned ones are shorter, so little is left for longer ones."""
    words = ["a", "b", "c", "unknown"]  # an unknown word stands for all of them
    learned = ["a", "b", "a b", "c", "b c", ""] * 8
    asked = [" ".join(p) for n in range(6) for p in itertools.product(words, repeat=n)]
    found = scored(spark, learned + asked, len(learned), bucket_bytes=bucket_bytes)
    total = sum(10 ** found[len(learned) + i].score for i in range(len(asked)))
    assert 0.97 < total < 1.000001


def test_same_scores_however_rows_are_dealt_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (F.col("doc_id") % 3 > 0).alias("learn"), (F.col("doc_id") % 3 == 0).alias("held_out"))
    one = {r.doc_id: r.score for r in score_documents(docs.repartition(1), bucket_bytes=20_000).collect()}
    many = {r.doc_id: r.score for r in score_documents(docs.repartition(7), bucket_bytes=20_000).collect()}
    assert one.keys() == many.keys() and np.allclose([one[k] for k in sorted(one)], [many[k] for k in sorted(one)], rtol=1e-6)


def test_a_hot_context_is_split(spark):
    texts = [" ".join(f"the w{(7 * i + k) % 211}" for k in range(120)) for i in range(60)]
    split = scored(spark, texts, 50, bucket_bytes=2000)
    whole = scored(spark, texts, 50, bucket_bytes=1 << 30)
    gap = [abs(split[i].score - whole[i].score) / abs(whole[i].score) for i in split]
    assert max(gap) < 0.02 and all(split[i].base_score == pytest.approx(whole[i].base_score) for i in split)


def test_nothing_to_learn_from(spark):
    found = scored(spark, ["a b", "", None], 0)
    assert [found[i].train_tokens for i in range(3)] == [0, 0, 0]
    assert [found[i].score for i in range(3)] == [pytest.approx(0)] * 3


# Seating ------------------------------------------------------------------------------------


def seatings(c, discount):
    """S(c, t) by seating customers one after the other."""
    weights = {((1,)): 1.0}
    for _ in range(c - 1):
        new = Counter()
        for sizes, w in weights.items():
            for i, n in enumerate(sizes):
                new[tuple(sorted((*sizes[:i], n + 1, *sizes[i + 1 :])))] += w * (n - discount)
            new[tuple(sorted((*sizes, 1)))] += w
        weights = new
    out = Counter()
    for sizes, w in weights.items():
        out[len(sizes)] += w
    return out


def test_weights_of_seatings():
    for c in (1, 2, 5, 7):
        for t, w in seatings(c, 0.6).items():
            assert math.isclose(math.exp(P.log_stirling(0.6)[c, t]), w, rel_tol=1e-9)


def test_tables_are_drawn_from_their_conditional():
    c, q, others, d, s = 6, 0.05, 9, 0.6, 2.0
    weights = {t: w * q**t * math.prod(s + d * (others + i) for i in range(t)) for t, w in seatings(c, d).items()}
    n = 40_000
    drawn = P.draw_tables(np.full(n, c), np.full(n, q), np.full(n, others), d, s, np.random.default_rng(1))
    for t, w in weights.items():
        p = w / sum(weights.values())
        assert abs((drawn == t).mean() - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_many_customers():
    drawn = P.draw_tables(np.array([1, 2, 300, 10_000_000]), np.full(4, 0.01), np.full(4, 50), 0.7, 1.0, np.random.default_rng(1))
    assert drawn[0] == 1 and 1 <= drawn[1] <= 2 and (drawn >= 1).all() and drawn[3] < 1_000_000


def test_log_gamma():
    x = np.array([0.05, 0.7, 1, 3.3, 40, 1e6])
    assert np.allclose(P.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)
