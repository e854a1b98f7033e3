"""Near duplicates at similarity 0.8 against all pairs."""

import random

import numpy as np
import pytest

from nightgrid.llm import simhash as S


def shingles(text):
    words = (text or "").encode().translate(S._LOWER).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def linked(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return {r.doc_id: r.component_id for r in S.similar_documents(df).collect()}


def words(rng, n):
    return [f"{rng.choice('bcdfgklm')}{rng.choice('aeiou')}{rng.randrange(400)}" for _ in range(n)]


def test_a_word_more_is_always_linked(spark):
    """Texts that differ little often share the first 64 bits."""
    rng = random.Random(5)
    texts = []
    for n in (60, 300, 1500, 4000):
        for _ in range(40):
            text = words(rng, n)
            texts += [" ".join(text), " ".join([*text, "more"])]
    found = linked(spark, texts)
    assert all(found[i] == i for i in range(0, len(texts), 2))
    assert [i for i in range(0, len(texts), 2) if found[i + 1] != i] == []


@pytest.mark.parametrize("size", [8, 12, 20])
def test_short_texts_at_the_bound(spark, size):
    """One more word: of ``size - 4`` and ``size - 3`` shingles all of the smaller set are shared."""
    rng = random.Random(size)
    texts = [t for _ in range(150) for w in [words(rng, size)] for t in (" ".join(w), " ".join([*w, "end"]))]
    assert jaccard(shingles(texts[0]), shingles(texts[1])) >= 0.8
    found = linked(spark, texts)
    assert sum(found[i + 1] == i for i in range(0, len(texts), 2)) >= 0.95 * 150


def test_nothing_below_the_bound(spark):
    """A word changed in the middle of 45: similarity below 0.8; longer ones above."""
    rng = random.Random(9)
    texts, expected = [], {}
    for n in (30, 45, 60, 200):
        for _ in range(30):
            w = words(rng, n)
            other = [*w[: n // 2], "changed", *w[n // 2 + 1 :]]
            i = len(texts)
            texts += [" ".join(w), " ".join(other)]
            expected[i + 1] = i if jaccard(shingles(texts[-1]), shingles(texts[-2])) >= 0.8 else i + 1
    found = linked(spark, texts)
    assert {k: found[k] for k in expected} == expected


def test_all_pairs_of_a_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    sets = [shingles(r.text) for r in rows]
    a, b = [], []
    for i in range(len(rows)):
        for j in range(i):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if small >= 0.8 * large and jaccard(sets[i], sets[j]) >= 0.8:
                a.append(i)
                b.append(j)
    label = S.roots(len(rows), np.array(a), np.array(b))
    df = spark.createDataFrame([(i, r.text) for i, r in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in S.similar_documents(df).collect()}
    assert len(a) > 50
    assert [i for i in range(len(rows)) if found[i] < label[i]] == []  # nothing that brute force keeps apart
    assert sum(found[i] != label[i] for i in range(len(rows))) <= 1


def test_large_groups_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_SHINGLES", 900)
    rng = random.Random(3)
    base = words(rng, 90)
    texts = []
    for _ in range(60):
        w = list(base)
        w[rng.randrange(90)] = f"x{rng.random()}"
        texts.append(" ".join(w))
    texts += [" ".join(words(rng, 90)) for _ in range(10)]
    found = linked(spark, texts)
    assert {found[i] for i in range(60)} == {0} and all(found[i] == i for i in range(60, 70))


def test_odd_texts(spark):
    texts = [None, "", " \n ", "one", "One", "two words", "a" * 100_000, "x " * 50_000, "x " * 49_000]
    assert linked(spark, texts) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 7}
