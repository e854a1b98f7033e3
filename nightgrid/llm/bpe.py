"""BPE encoding and decoding with reuse of content-defined chunks.

Texts are cut where a rolling hash of their last bytes says so, so equal passages give
equal chunks wherever they stand.  Documents with a chunk in common are sent to the same
tasks, where each chunk is encoded once.  Two chunks side by side are then repaired at
their joint: the text around it is encoded again, in a growing window, until a token
boundary of the window agrees with one of the chunk to the right.  From an agreed
boundary on, encoding goes on in the same way, so the ids are those of the whole text.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightgrid.llm.common import replaced, table, tokenizer_path
from nightgrid.llm.words import blocks, mix

TOKENIZER = "byte_bpe_50k.json"
#: A chunk ends where the rolling hash of ``ROLL_BYTES`` bytes has this many zero bits.
#: Joints cost a window each, so chunks are much longer than windows; most texts are one chunk.
ROLL_BYTES, CHUNK_BITS, LEAST_CHUNK = 16, 13, 2048
#: A boundary is settled when this many characters of text are known after it: more than
#: the longest special token and the longest look ahead of the pattern.
SETTLED_CHARS = 32
FIRST_WINDOW = 64
#: Bounds of a worker's memory: words, tokens of chunks, and hashes of chunks met once.
CACHE_WORDS, CACHE_WORD_CHARS, CACHE_TOKENS, CACHE_SEEN = 100_000, 64, 300_000, 1 << 16
#: Bytes of texts that are cut into chunks together.
BLOCK_BYTES = 1 << 20

_LETTERS, _NUMBERS, _SPACES = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t\n\x0b\x0c\r \x85\xa0"
#: The byte-level pattern for texts within Latin-1; other texts go through the library.
_LATIN = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
).findall
_BEYOND_LATIN = re.compile("[^\x00-\xff]")


class Chunk(NamedTuple):
    """An encoded text: ids, and the character counts and bytes of ids at the end of each word."""

    ids: bytes  #: little-endian unsigned 32-bit integers
    ends: array
    tokens: array


class Words(dict):
    """The ids of words, as bytes; bounded, and encoded by the library where missing."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> bytes:
        found = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= CACHE_WORD_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found


class Coder:
    """Encodes and decodes with a byte-level BPE tokenizer file; keeps words and chunks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.normalizer is not None:
            raise ValueError("the tokenizer changes texts before encoding")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("special tokens that take in their surroundings are not supported")
        if any(len(t.content) >= SETTLED_CHARS // 2 for t in added.values()):
            raise ValueError("a special token is too long")
        self.special = {t.content for t in added.values()}
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.split = re.compile("(" + "|".join(names) + ")").split if names else lambda text: [text]
        self.bytes_of = self._byte_table()
        self.words = Words(self.tokenizer)
        self.chunks: dict[str, Chunk] = {}
        self.seen: set[int] = set()
        self.held = 0
        #: Characters encoded as chunks, and taken from chunks encoded before.
        self.encoded = self.reused = 0

    def _byte_table(self) -> list[bytes]:
        """The bytes of each id; the vocabulary writes bytes as printable characters."""
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        letter = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
        table = []
        for i in range(self.tokenizer.get_vocab_size()):
            token = self.tokenizer.id_to_token(i) or ""
            known = token not in self.special and all(c in letter for c in token)
            table.append(bytes(letter[c] for c in token) if known else token.encode())
        return table

    def _words_of(self, text: str) -> list[str]:
        if not _BEYOND_LATIN.search(text):
            return _LATIN(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _split(self, text: str) -> list[str]:
        """The words of a text.  A special token is a word by itself, and the library encodes it as such."""
        parts = self.split(text)
        if len(parts) == 1:
            return self._words_of(text)
        words = []
        for k, part in enumerate(parts):
            if k % 2:
                words.append(part)
            elif part:
                words += self._words_of(part)
        return words

    def plain(self, text: str, ends: bool = True) -> Chunk:
        """Encode a text by its words, without regard to what stands around it; ``ends`` may be left out."""
        words = self._split(text)
        ids = list(map(self.words.__getitem__, words))
        if not ends:
            return Chunk(b"".join(ids), array("q"), array("q"))
        return Chunk(b"".join(ids), array("q", accumulate(map(len, words))), array("q", accumulate(map(len, ids))))

    def chunk(self, text: str, whole: bool = False) -> Chunk:
        """``plain``, once for each chunk that the worker remembers: those that it met before.

        A ``whole`` text has no joints and needs no ends of words.
        """
        found = self.chunks.get(text)
        if found is not None and (whole or found.ends):
            self.reused += len(text)
            return found
        found = self.plain(text, not whole)
        self.encoded += len(text)
        known = hash(text)
        if known not in self.seen:
            if len(self.seen) >= CACHE_SEEN:
                self.seen.clear()
            self.seen.add(known)
            return found
        if self.held + len(found.ids) // 4 > CACHE_TOKENS:
            self.chunks.clear()
            self.held = 0
        self.chunks[text] = found
        self.held += len(found.ids) // 4 + 64
        return found

    def encode(self, chunks: list[str]) -> bytes:
        """The ids of the text that the chunks make up, the joints repaired."""
        if len(chunks) < 2:
            return self.chunk(chunks[0], whole=True).ids if chunks else b""
        text = "".join(chunks)
        edges = np.cumsum([0, *map(len, chunks)]).tolist()
        coded = [self.chunk(c) for c in chunks]
        out: list[bytes] = []
        k, done = 0, 0  # the chunk, and the settled boundary inside it
        while True:
            base, now = edges[k], coded[k]
            first = now.tokens[bisect_left(now.ends, done - base)] if done > base else 0
            if edges[k + 1] == len(text):
                out.append(now.ids[first:])
                return b"".join(out)
            place = bisect_right(now.ends, edges[k + 1] - base - SETTLED_CHARS) - 1
            start = done
            if place >= 0 and base + now.ends[place] > done:
                start = base + now.ends[place]
                out.append(now.ids[first : now.tokens[place]])
            k, done = self._repair(text, edges, coded, k, start, out)
            if done == len(text):
                return b"".join(out)

    def _repair(self, text: str, edges: list[int], coded: list[Chunk], k: int, start: int, out: list) -> tuple[int, int]:
        """Encode from ``start`` over the end of chunk ``k`` until a boundary agrees."""
        size = FIRST_WINDOW
        while True:
            end = min(edges[k + 1] + size, len(text))
            window = self.plain(text[start:end])
            for at, tokens in zip(window.ends, window.tokens, strict=True):
                at += start
                if at <= edges[k + 1]:
                    continue
                if end < len(text) and at > end - SETTLED_CHARS:
                    break
                owner = bisect_right(edges, at) - 1 if at < len(text) else len(coded) - 1
                inside = at - edges[owner]
                ends = coded[owner].ends
                if at == len(text) or inside and ends[min(bisect_left(ends, inside), len(ends) - 1)] == inside:
                    out.append(window.ids[:tokens])
                    return owner, at
            size *= 2

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, numbers)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def _rolling(data: np.ndarray) -> np.ndarray:
    """A hash of the last ``ROLL_BYTES`` bytes at each byte."""
    values = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))[data]
    total = np.zeros(len(data) + ROLL_BYTES, np.uint64)
    for k in range(ROLL_BYTES):
        total[k : k + len(data)] += values << np.uint64(2 * k)
    return total[: len(data)]


def cut_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of chunks, as byte places: where the content says so, and at the ends of texts.

    A cut comes after the byte whose hash has ``CHUNK_BITS`` zero bits and stands before
    the first byte of a character; texts' first ``ROLL_BYTES`` bytes have none.
    """
    if not len(data):
        return np.unique(offsets)
    hit = (mix(_rolling(data)) >> np.uint64(64 - CHUNK_BITS)) == 0
    cut = np.flatnonzero(hit[:-1] & ((data[1:] & 0xC0) != 0x80)) + 1
    owner = np.searchsorted(offsets, cut, side="right") - 1
    cut = cut[cut - offsets[owner] >= max(LEAST_CHUNK, ROLL_BYTES)]
    return np.unique(np.concatenate([cut, offsets]))


def chunks_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[list[str]]:
    """The chunks of each text."""
    cuts = cut_points(data, offsets)
    raw = data.tobytes()
    first = np.searchsorted(cuts, offsets)
    for k in range(len(offsets) - 1):
        edges = cuts[first[k] : first[k + 1] + 1].tolist()
        yield [raw[a:b].decode() for a, b in zip(edges, edges[1:], strict=False)]


def _route(text: Column) -> Column:
    """The smallest hash of a text's chunks: equal for most texts with most chunks in common."""

    @F.arrow_udf("long")
    def route(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found: list[int] = []
            for _, _, data, offsets in blocks(batch, BLOCK_BYTES):
                cuts = cut_points(data, offsets)
                raw = data.tobytes()
                first = np.searchsorted(cuts, offsets)
                for k in range(len(offsets) - 1):
                    edges = cuts[first[k] : first[k + 1] + 1].tolist()
                    found.append(min(
                        (int.from_bytes(hashlib.blake2b(raw[a:b], digest_size=8).digest(), "little", signed=True)
                         for a, b in zip(edges, edges[1:], strict=False)),
                        default=0,
                    ))
            yield pa.array(found, pa.int64())

    return route(text)


def encode_documents(
    docs: DataFrame, text: str = "text", tokenizer: str | None = None, ids: bool = True, share: bool = True
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``token_ids`` (array), ``decoded``, and the digests of both.

    ``ids_sha256``: of the ids as little-endian unsigned 32-bit integers;
    ``decoded_sha256``: of the decoded text in UTF-8.  A null text counts as an empty one.
    ``ids=False`` leaves out ids and decoded text.  ``share`` sends documents with chunks
    in common to the same tasks; it only saves work.  Columns of the result's names are replaced.

    Documents move by a rebalance on the smallest chunk hash, which Spark splits where a
    partition gets too large: a group of copies of any size is spread over tasks, and
    each of these encodes its chunks once.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    fields = "n_tokens:bigint,ids_sha256:string,decoded_sha256:string" + (",token_ids:array<bigint>,decoded:string" if ids else "")

    @F.arrow_udf(f"struct<{fields}>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = coder(path)
        for batch in batches:
            n, one, two, full, texts = [], [], [], [], []
            for _, _, data, offsets in blocks(batch, BLOCK_BYTES):
                for chunks in chunks_of(data, offsets):
                    found = known.encode(chunks)
                    decoded = known.decode(found)
                    n.append(len(found) // 4)
                    one.append(hashlib.sha256(found).hexdigest())
                    two.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if ids:
                        full.append(np.frombuffer(found, "<u4").astype(np.int64))
                        texts.append(decoded)
            arrays, names = [pa.array(n, pa.int64()), pa.array(one), pa.array(two)], ["n_tokens", "ids_sha256", "decoded_sha256"]
            if not n:
                arrays = [pa.array([], pa.int64()), pa.array([], pa.string()), pa.array([], pa.string())]
            if ids:
                arrays += [pa.array(full, pa.list_(pa.int64())), pa.array(texts, pa.string())]
                names += ["token_ids", "decoded"]
            yield pa.StructArray.from_arrays(arrays, names)

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    if share:
        docs = replaced(docs, {"__llm_route": _route(whole)}).hint("rebalance", "__llm_route").drop("__llm_route")
    found = replaced(docs, {"__llm_coded": encode(whole)})
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + (["token_ids", "decoded"] if ids else [])
    return replaced(found, {name: F.col(f"__llm_coded.{name}") for name in names}).drop("__llm_coded")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
