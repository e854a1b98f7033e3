import hashlib
import random
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightgrid.llm import bpe, token_counts
from nightgrid.llm.common import tokenizer_path


def test_token_counts_are_the_librarys(spark, any_dir, texts):
    model = token_counts.processor(tokenizer_path(token_counts.MODEL))
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.op9_token_counts(spark, any_dir).collect()}
    want = {(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in texts(any_dir)}
    assert got == want


def test_token_counts_of_random_texts():
    model = token_counts.processor(tokenizer_path(token_counts.MODEL))
    lengths, rng = token_counts.Lengths({}, model), random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "é", "▁", "the", "ing", "!", "7", "漢", "\t", "😀", "<s>", "</s>", "<0x0A>", "\x00"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(25)))
        assert lengths.count(text) == len(model.encode(text)), text


def test_full_cache_and_clashing_columns(spark, odd_dir, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 3)
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    found = token_counts.count_tokens(docs, frequent=[" the"])
    assert [c for c in found.columns if c == "n_tokens"] == ["n_tokens"] and found.where("n_tokens > 0").count() > 0


def test_bpe_is_the_librarys(spark, any_dir, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path(bpe.TOKENIZER))
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for i, t in texts(any_dir):
        ids = whole.encode(t or "", add_special_tokens=False).ids
        back = whole.decode(ids, skip_special_tokens=False)
        want.add((i, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(back.encode())))
    assert {tuple(r) for r in bpe.op2_bpe(spark, any_dir).collect()} == want


@pytest.mark.parametrize("size", [2, 20, 60])
def test_joints_of_any_chunks(size):
    coder, rng = bpe.coder(tokenizer_path(bpe.TOKENIZER)), random.Random(size)
    parts = ["a", "don't", "'re", "'", " ", "  ", "\n\n", "é", "the", "ing ", "!", "7", "漢", "\t", "😀", "<|endoftext|>",
             "<|endof", "text|>", "\x00", "　", "\x1c", "²", "a" * 70, "\u0300", "\x85", "\xa0", "______"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randrange(90)))
        cuts = sorted({0, len(text), *(rng.randrange(len(text) + 1) for _ in range(len(text) // size))})
        ids = coder.encode([text[a:b] for a, b in pairwise(cuts)])
        want = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert coder.decode(ids) == coder.tokenizer.decode(want, skip_special_tokens=False)


def test_shared_passages_give_shared_chunks():
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh ", k=100_000))
    one, two = (np.frombuffer((head + passage).encode(), np.uint8) for head in ("xy", "something else "))
    chunks = [set(next(bpe.chunks_of(d, np.array([0, len(d)])))) for d in (one, two)]
    assert len(chunks[0] & chunks[1]) >= 3


def test_texts_come_back(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    found = bpe.encode_documents(docs)
    assert found.where(F.coalesce("text", F.lit("")) != F.col("decoded")).count() == 0
    assert found.where(F.size("token_ids") != F.col("n_tokens")).count() == 0


def test_short_chunks_and_chunks_met_again(monkeypatch, texts, odd_dir, sf_dir):
    """With chunks of some sixty bytes nearly every text has joints; repeated chunks come from the worker's memory."""
    import pyarrow as pa

    from nightgrid.llm import bpe
    from nightgrid.llm.common import tokenizer_path
    from nightgrid.llm.words import blocks

    monkeypatch.setattr(bpe, "CHUNK_BITS", 5)
    monkeypatch.setattr(bpe, "LEAST_CHUNK", 16)
    monkeypatch.setattr(bpe, "CACHE_TOKENS", 10_000_000)
    coder = bpe.Coder(tokenizer_path(bpe.TOKENIZER))
    whole = [t or "" for path in (odd_dir, sf_dir) for _, t in texts(path)]
    whole = [t[:3_000] for t in whole[:120]] * 4
    found = []
    for _, _, data, offsets in blocks(pa.array(whole), bpe.BLOCK_BYTES):
        found += [coder.encode(chunks) for chunks in bpe.chunks_of(data, offsets)]
    expected = coder.tokenizer.encode_batch(whole, add_special_tokens=False)
    assert [list(memoryview(f).cast("I")) for f in found] == [e.ids for e in expected]
    assert coder.reused > 0.5 * coder.encoded
