"""Token counts by a map-side lookup in two tiers.

A piece model whose pieces hold the space mark only at their start never merges across
the start of a space run, so a text's count is the sum over its pre-tokens (a run of
spaces and what follows up to the next space).  The first tier is a broadcast table of
the lengths of frequent pre-tokens, the second a cache in each Python worker that
encodes what the table lacks.  No pre-token is shuffled: the frequent ones come from a
summary of fixed size per task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from nightgrid.llm.common import replaced, table, tokenizer_path

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
#: Entries of the broadcast table; 2**14 short words are below 2 MB.
TABLE_ENTRIES = 1 << 14
#: Words that a task reports, and distinct words after which it forgets the rare ones.
TASK_ENTRIES, TASK_DISTINCT = 1 << 11, 1 << 17
#: Bounds of a worker's cache: entries, and code points of a cached word.
CACHE_ENTRIES, CACHE_CHARS = 1 << 19, 64

MARK = "▁"
_PRE_TOKENS = re.compile(r" +[^ ]*").findall


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, each with the leading space that the model puts there."""
    return _PRE_TOKENS(" " + text.replace(MARK, " ")) if text else []


@lru_cache(maxsize=4)
def processor(path: str):
    """The model at ``path``; refuses models for which the sum rule does not hold."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = map(model.id_to_piece, range(model.get_piece_size()))
    if any(MARK in piece.lstrip(MARK) for piece in pieces):
        raise ValueError("the model has pieces that reach across spaces")
    if model.decode(model.encode(" a  b ")) != " a  b ":
        raise ValueError("the model changes white space before encoding")
    return model


class Lengths(dict):
    """Lengths in tokens: the broadcast table, then a bounded cache, then the model."""

    def __init__(self, frequent: dict[str, int], model):
        super().__init__(frequent)
        self.frequent, self.model = frequent, model

    def __missing__(self, word: str) -> int:
        encode = self.model.encode
        # A single space at the end of a text: the model adds none to an empty text.
        n = len(encode(word[1:])) if len(word) > 1 else len(encode("a ")) - len(encode("a"))
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
                self.update(self.frequent)
            self[word] = n
        return n

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, pre_tokens(text)))


_LENGTHS: dict[tuple, Lengths] = {}


def _lengths(path: str, table: Broadcast) -> Lengths:
    key = (path, id(table.value))
    if key not in _LENGTHS:
        _LENGTHS.clear()
        _LENGTHS[key] = Lengths(table.value, processor(path))
    return _LENGTHS[key]


def frequent_words(docs: DataFrame, text: str = "text", entries: int = TABLE_ENTRIES) -> list[str]:
    """The most frequent pre-tokens over all documents, by a bounded summary per task.

    Each task counts the words of all its texts and halves its table to the more
    frequent words whenever it outgrows ``TASK_DISTINCT``; it reports at most
    ``TASK_ENTRIES`` words.  This only steers the cache: no count of tokens depends on it.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                seen.update(pre_tokens(value or ""))
                if len(seen) > TASK_DISTINCT:
                    seen = Counter(dict(seen.most_common(TASK_DISTINCT // 8)))
        top = [(w, n) for w, n in seen.most_common(TASK_ENTRIES) if len(w) <= CACHE_CHARS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            ["word", "n"],
        )

    counts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(summary, "word string, n bigint")
    top = counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(entries)
    return [row.word for row in top.collect()]


def count_tokens(
    docs: DataFrame, text: str = "text", model: str | None = None, limit: int = TOKEN_LIMIT,
    frequent: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` of each whole text.

    A null or empty text has 0 bytes and 0 tokens.  Columns of these names are replaced.
    ``frequent`` takes a list of pre-tokens kept from an earlier run in place of a pass
    over the texts; at most ``TABLE_ENTRIES`` of it are used.
    """
    spark = docs.sparkSession
    path = model or tokenizer_path(MODEL)
    words = frequent_words(docs, text) if frequent is None else frequent[:TABLE_ENTRIES]
    lengths = Lengths({}, processor(path))
    broadcast = spark.sparkContext.broadcast({word: lengths[word] for word in words})

    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _lengths(path, broadcast)
        for batch in batches:
            yield pa.array([known.count(value) if value else 0 for value in batch.to_pylist()], pa.int64())

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    n = n_tokens(whole)
    return replaced(
        docs,
        {"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": n, "over_limit": n > limit},
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")
