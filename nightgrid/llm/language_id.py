"""Language identification by compression.

For each language a raw-content dictionary is made of labelled text.  A text is encoded
with every dictionary, and the language whose dictionary gives the fewest bytes wins; if
the second is hardly longer, the text is rejected.  Case, digits and punctuation say
nothing about the language, so dictionaries and texts hold lower-case letters alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from nightgrid.llm.common import replaced, table

UNKNOWN = "und"
#: Bounds of the labelled sample: texts of a language, code points of each, and bytes of a dictionary.
SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES = 128, 4096, 1 << 16
LEVEL = 6
#: Bytes of letters that are compressed at a time.  A dictionary saves only so many bytes of
#: one output, so of a long text in one piece the margin would fall with its length.
PIECE_BYTES = 1 << 13
#: Reject when the second language needs less than this share more than the first.
LEAST_MARGIN = 0.005
FOLDS = 5

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode()


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> list[tuple[str, bytes]]:
    """(language, dictionary) of each language of ``labelled``, the most frequent first.

    A language's sample are its ``SAMPLE_TEXTS`` different texts with the smallest
    hashes, so it is the same in every run and copies don't crowd it.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(text).cast("string")).alias("h"),
    )
    counts = rows.groupBy("lang", "h").agg(F.count("*").alias("n"))
    # The smallest of each of 64 parts of a language first: then no task gets more than
    # 64 * SAMPLE_TEXTS rows of one, however many tasks have read it.
    smallest = counts.select("lang", "h", F.pmod("h", F.lit(64)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("h"))
        smallest = smallest.withColumn("place", place).where(F.col("place") <= SAMPLE_TEXTS).drop("place")
    sizes = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    # At most SAMPLE_TEXTS rows of two words for each language.
    chosen = F.broadcast(smallest.drop("part"))
    excerpts = rows.join(chosen, ["lang", "h"]).groupBy("lang", "h").agg(
        F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text")
    )
    found: dict[str, list] = {}
    for row in excerpts.collect():
        found.setdefault(row.lang, []).append((row.h, letters(row.text)))
    order = sorted(found, key=lambda name: (-sizes[name], name))
    contents = [(name, b" ".join(x for _, x in sorted(found[name]))[:DICTIONARY_BYTES]) for name in order]
    return [(name, content) for name, content in contents if len(content) >= 8]


@lru_cache(maxsize=2)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...]) -> list:
    import zstandard

    out = []
    for _, content in dictionaries:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=known, level=LEVEL))
    return out


def classify(text: str | None, dictionaries: tuple[tuple[str, bytes], ...]) -> tuple[str, float]:
    """(language, margin): the share by which the second language needs more bytes.

    Pieces of the text are compressed each by itself, and their sizes added up.
    """
    if not text or not dictionaries or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    content = letters(text)
    pieces = [content[k : k + PIECE_BYTES] for k in range(0, len(content), PIECE_BYTES)]
    sizes = [sum(len(c.compress(piece)) for piece in pieces) for c in _compressors(dictionaries)]
    best = min(range(len(sizes)), key=sizes.__getitem__)  # of equal sizes the more frequent language
    second = min((s for k, s in enumerate(sizes) if k != best), default=None)
    return dictionaries[best][0], 1.0 if second is None else 1 - sizes[best] / second


def identify(
    docs: DataFrame, dictionaries: list[tuple[str, bytes]], text: str = "text", least_margin: float = LEAST_MARGIN
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1, the margin) and ``rejected``.

    A null text, one without a letter, and any text where nothing was learned are
    ``und`` with score 0 and rejected; so is a text whose margin is narrow, which keeps
    its best language.  Columns of the result's names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(dictionaries))

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for batch in batches:
            found = [classify(value, known) for value in batch.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang", "score"],
            )

    found = replaced(docs, {"__llm_found": predict(F.col(text).cast("string"))})
    lang, score = F.col("__llm_found.lang"), F.col("__llm_found.score")
    return replaced(
        found, {"lang_pred": lang, "score": score, "rejected": (lang == UNKNOWN) | (score < least_margin)}
    ).drop("__llm_found")


def held_out(key: str = "doc_id"):
    """Whether crc32 of the key as text is divisible by ``FOLDS``; a null key is not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == 0, F.lit(False))


def learn_outside_fold(docs: DataFrame) -> list[tuple[str, bytes]]:
    """Learn from the rows with a key that are not held out."""
    return learn(docs.where(F.col("doc_id").isNotNull() & ~held_out()))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, learn_outside_fold(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
