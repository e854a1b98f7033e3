"""Scores of texts under a hierarchical Pitman-Yor model, sampled by Gibbs.

The model.  A word is drawn in the restaurant of the word before it; tables of these restaurants are
customers of one restaurant of single words, their common parent; its tables are drawn from
the uniform distribution over the known words and one for all unknown ones.  A text begins and ends with the end mark.
Tables are drawn anew for every (context, word) in each sweep; predictions are averaged
over the sweeps after the first ``burn_in``, level by level.

The work.  Everything travels in packets: arrays of whole blocks of texts, packed as bytes.
Texts are turned into blocks of word numbers once.  A block sends its distinct words to word buckets, its
distinct (context, word) pairs with counts to the context's bucket; a context with
a large share of all words is split over several buckets by the next word.  Buckets answer with
probabilities, and the block adds up its texts.  A sweep sends tables to word buckets and word
probabilities back, for pairs that occur at least twice (the others have no choice).  Buckets see the
totals of split contexts, and the parent's, as of the last sweep.

What reaches the driver: counts, likelihoods of a few strengths per bucket (added up by Spark), and the split contexts, fewer than
four per bucket.

Cases: a null text is empty and has the end mark alone.  Rows without an id are scored, not learned from and not held
out.  Equal rows count each.  Without training texts every word has probability 1.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from nightgrid.llm import pitman_yor as P
from nightgrid.llm.common import SPACES, dropped, freed, new_path, table
from nightgrid.llm.words import blocks, byte_tables, find_words, mix

#: The hash of the end mark.
END = np.uint64(0x5BD1E995D3A2646C)
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Blocks meet their answers in so many portions, so that the disk holds one portion's shuffle at a time.
PORTIONS = 4

PACKET = "key bigint, src bigint, kind string, parts array<binary>, nums array<double>"
_NAMES = ["key", "src", "kind", "parts", "nums"]
_RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"

_KINDS = (np.uint8, np.uint16, np.uint32, np.uint64)


def _planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second ones: they compress better so."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers of at least 0, with as few bytes each as the largest needs."""
    top = int(values.max(initial=0))
    size = next(i for i, kind in enumerate(_KINDS) if top <= np.iinfo(kind).max)
    return bytes([size]) + _planes(np.ascontiguousarray(values, _KINDS[size]))


def _unpack(data: bytes) -> np.ndarray:
    kind = np.dtype(_KINDS[data[0]])
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1).astype(np.int64)


def _pack_values(values: np.ndarray) -> bytes:
    """Single-precision numbers, of which many are equal: the different ones and which is where."""
    different, which = np.unique(values.astype(np.float32), return_inverse=True)
    return len(different).to_bytes(4, "little") + different.tobytes() + _pack(which)


def _unpack_values(data: bytes) -> np.ndarray:
    end = 4 + 4 * int.from_bytes(data[:4], "little")
    return np.frombuffer(data[4:end], np.float32)[_unpack(data[end:])].astype(np.float64)


def _pack_rising(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=0))


def _unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data))


def _hashes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _codes(hashes: np.ndarray) -> np.ndarray:
    """The upper 48 bits, which stand for a word in pairs; counts of words go by all 64."""
    return hashes >> np.uint64(16)


def _pack_codes(codes: np.ndarray) -> bytes:
    return np.ascontiguousarray(codes, np.uint64).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack_codes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).reshape(-1)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_NAMES)


def _rows(data: pa.Table | pa.RecordBatch) -> list[dict]:
    """Packets in the order of their source."""
    return sorted(data.to_pylist(), key=lambda r: r["src"])


def _slices(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, start, end) of runs in sorted keys."""
    if len(keys):
        starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
            yield int(keys[a]), int(a), int(b)


# Texts to blocks ---------------------------------------------------------------------------


def _blocks_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    member, fold = byte_tables(SPACES)
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids, learn, held = (batch.column(i) for i in (0, 2, 3))
        for first, end, data, offsets in blocks(batch.column(1)):
            words = find_words(data, offsets, member, fold)
            n = end - first
            tokens = np.full(len(words.hash) + n, END, np.uint64)
            tokens[np.arange(len(words.hash)) + words.owner] = words.hash
            lengths = np.diff(words.first, append=len(words.hash))[:n] + 1
            known, place = np.unique(tokens, return_inverse=True)
            learned = np.asarray(learn[first:end].to_numpy(zero_copy_only=False), bool)
            # Frequent words get small numbers.
            ranked = np.argsort(-np.bincount(place), kind="stable")
            rank = np.empty(len(ranked), np.int64)
            rank[ranked] = np.arange(len(ranked))
            known, place = known[ranked], rank[place]
            counts = np.bincount(place[np.repeat(learned, lengths)], minlength=len(known))
            doc_ids = ids[first:end]
            parts = [
                _pack(place), known.tobytes(), _pack(counts), _pack(lengths),
                np.asarray(doc_ids.fill_null(0)).astype(np.int64).tobytes(), np.asarray(doc_ids.is_null().to_numpy(zero_copy_only=False), np.uint8).tobytes(),
                learned.astype(np.uint8).tobytes(), np.asarray(held[first:end].to_numpy(zero_copy_only=False), np.uint8).tobytes(),
            ]
            yield _batch([(number, 0, "text", parts, None)])
            number += 1


class _Block:
    """A block of texts and the order of its words and pairs in packets."""

    def __init__(self, row: dict, n_buckets: int, split: dict[int, int]) -> None:
        place, known, counts, lengths, ids, nulls, learned, held = row["parts"]
        order = np.argsort(_hashes(known))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        self.place, self.known, self.counts, self.lengths = number[_unpack(place)], _hashes(known)[order], _unpack(counts)[order], _unpack(lengths)
        self.ids, self.nulls = np.frombuffer(ids, np.int64), np.frombuffer(nulls, np.uint8).astype(bool)
        self.learned, self.held = (np.frombuffer(x, np.uint8).astype(bool) for x in (learned, held))
        self.n_buckets, self.split = n_buckets, split
        self.codes = _codes(self.known)
        bucket = (self.codes % np.uint64(n_buckets)).astype(np.int64)
        #: Words by bucket, then hash.
        self.word_order = np.argsort(bucket, kind="stable")
        self.word_bucket = bucket[self.word_order]

    def pairs(self) -> None:
        end = int(np.searchsorted(self.known, END))
        before = np.empty(len(self.place), np.int64)
        before[1:] = self.place[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = end
        keys, which = np.unique(before * len(self.known) + self.place, return_inverse=True)
        context, word = keys // len(self.known), keys % len(self.known)
        bucket = mix(self.codes[context]) % np.uint64(self.n_buckets)
        if self.split:
            heavy = np.array(sorted(self.split), np.uint64)
            at = np.minimum(np.searchsorted(heavy, self.codes), len(heavy) - 1)
            ways = np.where(heavy[at] == self.codes, np.array([self.split[int(h)] for h in heavy], np.uint64)[at], np.uint64(1))
            some = np.flatnonzero(ways[context] > 1)
            part = mix(self.codes[word[some]]) % ways[context[some]]
            bucket[some] = mix(self.codes[context[some]] + part * _STEP) % np.uint64(self.n_buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.context, self.word, self.bucket = context[order], word[order], bucket[order].astype(np.int64)
        self.pair = place[which]
        self.pair_counts = np.bincount(self.pair[np.repeat(self.learned, self.lengths)], minlength=len(order))


def _send_words(n_buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                b = _Block(row, n_buckets, {})
                hashes, counts = b.known[b.word_order], b.counts[b.word_order]
                yield _batch([(k, row["key"], "words", [hashes[i:j].tobytes(), _pack(counts[i:j])], None) for k, i, j in _slices(b.word_bucket)])

    return run


def _send_pairs(n_buckets: int, split: dict[int, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                b = _Block(row, n_buckets, split)
                b.pairs()
                out = []
                for k, i, j in _slices(b.bucket):
                    starts = np.flatnonzero(np.diff(b.context[i:j], prepend=-1))
                    parts = [
                        _pack_codes(b.codes[b.context[i:j][starts]]), _pack(np.diff(starts, append=j - i)),
                        _pack_codes(b.codes[b.word[i:j]]), _pack(b.pair_counts[i:j]),
                    ]
                    out.append((k, row["key"], "pairs", parts, None))
                yield _batch(out)

    return run


# Word buckets ------------------------------------------------------------------------------


def _gather_words(group: pa.Table) -> pa.Table:
    """The words of a bucket with their counts, and where each block's words are among them."""
    rows = _rows(group)
    each = [_hashes(r["parts"][0]) for r in rows]
    known, place = np.unique(np.concatenate(each), return_inverse=True)
    counts = np.bincount(place, np.concatenate([_unpack(r["parts"][1]) for r in rows]), len(known)).astype(np.int64)
    key, at, out = rows[0]["key"], 0, []
    for r, h in zip(rows, each, strict=True):
        out.append((key, r["src"], "word_asks", [_pack_rising(place[at : at + len(h)])], None))
        at += len(h)
    out.append((key, 0, "words", [known.tobytes(), _pack(counts)], [float(counts.sum()), float((counts > 0).sum())]))
    return pa.Table.from_batches([_batch(out)])


def _word_step(seed: int, step: int, n_known: int, customers: float, tables: float, discount: float, strength: float, keep: bool) -> Callable:
    """Takes tables of contexts as customers, draws tables, and answers with the words' own part of their probability."""

    def run(group: pa.Table) -> pa.Table:
        rows = _rows(group)
        key = rows[0]["key"]
        one = {r["kind"]: r["parts"] for r in rows}
        codes = _codes(_hashes(one["words"][0]))
        out = []
        if "word_fixed" in one:
            fixed = _unpack(one["word_fixed"][0])
        else:
            fixed = np.zeros(len(codes), np.int64)
            for r in rows:
                if r["kind"] == "singles":
                    fixed[np.searchsorted(codes, _unpack_codes(r["parts"][0]))] += _unpack(r["parts"][1])
            out.append((key, 0, "word_fixed", [_pack(fixed)], None))
        here, asked = fixed.copy(), []
        for r in rows:
            if r["kind"] == "tables":
                asked.append((r["src"], np.searchsorted(codes, _unpack_codes(r["parts"][0]))))
                here[asked[-1][1]] += _unpack(r["parts"][1])
        kept = np.zeros(len(codes))
        if "word_state" in one:
            old, kept = _unpack(one["word_state"][0]), np.frombuffer(one["word_state"][1], np.float64)
            rng = np.random.default_rng([seed, step, 1, key])
            uniform = np.full(len(codes), 1 / (n_known + 1))
            drawn = P.draw_tables(here, uniform, np.maximum(tables - old, 0), discount, strength, rng)
        else:
            drawn = np.minimum(here, 1)
        own = (here - discount * drawn) / (strength + customers)
        kept = kept + own if keep else kept
        once, twice = float((here == 1).sum()), float((here == 2).sum())
        out.append((key, 0, "word_state", [_pack(drawn), kept.tobytes()], [float(drawn.sum()), once, twice]))
        out += [(src, key, "replies", [own[at].tobytes()], None) for src, at in asked]
        return pa.Table.from_batches([_batch(out)])

    return run


def _answer_words(samples: int, rest: float) -> Callable:
    """Counts and probabilities of the words that each block asked for."""

    def run(group: pa.Table) -> pa.Table:
        rows = _rows(group)
        own = np.frombuffer(next(r for r in rows if r["kind"] == "word_state")["parts"][1], np.float64) / samples
        counts = _unpack(next(r for r in rows if r["kind"] == "words")["parts"][1])
        out = []
        for r in rows:
            if r["kind"] == "word_asks":
                at = _unpack_rising(r["parts"][0])
                out.append((r["src"], r["key"], "word_answers", [_pack(counts[at]), _pack_values(own[at] + rest)], None))
        return pa.Table.from_batches([_batch(out)])

    return run


# Context buckets ---------------------------------------------------------------------------


class _Contexts:
    """The pairs of a bucket: counts by context, and the words of pairs that occur at least twice."""

    def __init__(self, row: dict) -> None:
        hashes, sizes, counts, words, which = row["parts"]
        self.hashes, self.counts, self.words, self.which = _unpack_codes(hashes), _unpack(counts), _unpack_codes(words), _unpack(which)
        sizes = _unpack(sizes)
        self.context = np.repeat(np.arange(len(sizes)), sizes)
        self.n = len(sizes)
        self.often = np.flatnonzero(self.counts > 1)
        self.customers = np.bincount(self.context, self.counts, self.n).astype(np.int64)
        self.single_tables = np.bincount(self.context[self.counts == 1], minlength=self.n)

    def tables(self, often: np.ndarray) -> np.ndarray:
        return self.single_tables + np.bincount(self.context[self.often], often, self.n).astype(np.int64)

    def messages(self, key: int, often: np.ndarray, n_buckets: int) -> list[tuple]:
        """Tables of each word of frequent pairs, to the words' buckets."""
        sums = np.bincount(self.which, often, len(self.words)).astype(np.int64)
        bucket = (self.words % np.uint64(n_buckets)).astype(np.int64)
        return [(k, key, "tables", [_pack_codes(self.words[i:j]), _pack(sums[i:j])], None) for k, i, j in _slices(bucket)]

    def at(self, some: dict[int, object]) -> np.ndarray:
        """Which contexts are among ``some``."""
        return np.flatnonzero(np.isin(self.hashes, np.array(list(some), np.uint64))) if some else np.zeros(0, np.int64)

    def split_totals(self, key: int, often: np.ndarray, split: dict[int, object]) -> list[tuple]:
        at = self.at(split)
        if not len(at):
            return []
        return [(key, 0, "split", [_pack_codes(self.hashes[at]), _pack(self.customers[at]), _pack(self.tables(often)[at])], None)]


def _by_word_bucket(words: np.ndarray, n_buckets: int) -> np.ndarray:
    """Sorted words in the order of (bucket, hash)."""
    return np.argsort((words % np.uint64(n_buckets)).astype(np.int64), kind="stable")


def _gather_pairs(n_buckets: int, split: dict[int, int]) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        rows = _rows(group)
        key = rows[0]["key"]
        contexts = [_unpack_codes(r["parts"][0]) for r in rows]
        sizes = [_unpack(r["parts"][1]) for r in rows]
        words = [_unpack_codes(r["parts"][2]) for r in rows]
        known, context = np.unique(np.concatenate(contexts), return_inverse=True)
        vocabulary, word = np.unique(np.concatenate(words), return_inverse=True)
        full = np.repeat(context, np.concatenate(sizes))
        pairs, place = np.unique(full * len(vocabulary) + word, return_inverse=True)
        counts = np.bincount(place, np.concatenate([_unpack(r["parts"][3]) for r in rows]), len(pairs)).astype(np.int64)
        out, at, head = [], 0, 0
        for r, c, w in zip(rows, contexts, words, strict=True):
            out.append((key, r["src"], "pair_asks", [_pack_rising(place[at : at + len(w)]), _pack_rising(context[head : head + len(c)])], None))
            at, head = at + len(w), head + len(c)
        second = pairs % len(vocabulary)
        often = np.unique(second[counts > 1])
        often = often[_by_word_bucket(vocabulary[often], n_buckets)]
        number = np.zeros(len(vocabulary), np.int64)
        number[often] = np.arange(len(often))
        parts = [
            _pack_codes(known), _pack(np.bincount(pairs // len(vocabulary), minlength=len(known))), _pack(counts),
            _pack_codes(vocabulary[often]), _pack(number[second[counts > 1]]),
        ]
        once, n = np.unique(second[counts == 1], return_counts=True)
        order = _by_word_bucket(vocabulary[once], n_buckets)
        once, n = vocabulary[once[order]], n[order]
        bucket = (once % np.uint64(n_buckets)).astype(np.int64)
        out += [(k, key, "singles", [_pack_codes(once[i:j]), _pack(n[i:j])], None) for k, i, j in _slices(bucket)]
        row = (key, 0, "contexts", parts, [float((counts > 0).sum()), float((counts == 1).sum()), float((counts == 2).sum())])
        model = _Contexts({"parts": parts})
        ones = np.ones(len(model.often), np.int64)
        out += [row, *model.messages(key, ones, n_buckets), *model.split_totals(key, ones, split)]
        return pa.Table.from_batches([_batch(out)])

    return run


def _context_step(
    seed: int, step: int, n_buckets: int, rest: float, discount: float, strength: float, split: dict[int, tuple[int, int]], keep: bool
) -> Callable:
    """Draws the tables of a bucket's contexts given the words' probabilities, ``own part + rest``."""

    def run(group: pa.Table) -> pa.Table:
        rows = _rows(group)
        row = next((r for r in rows if r["kind"] == "contexts"), None)
        key, model = row["key"], _Contexts(row)
        state = next((r for r in rows if r["kind"] == "context_state"), None)
        often, kept = np.ones(len(model.often), np.int64), []
        if state is not None:
            often, kept = _unpack(state["parts"][0]), state["parts"][1:]
        replies = [np.frombuffer(r["parts"][0], np.float64) for r in rows if r["kind"] == "replies"]
        parent = (np.concatenate(replies) if replies else np.zeros(0))[model.which] + rest
        mine = model.tables(often)
        everywhere, customers = mine.copy(), model.customers.copy()
        shared = np.zeros(model.n, bool)
        for i in model.at(split):
            customers[i], everywhere[i] = split[int(model.hashes[i])]
            shared[i] = True
        rng = np.random.default_rng([seed, step, 2, key])
        often, everywhere = P.draw_restaurants(
            model.context[model.often], model.counts[model.often], often, everywhere, parent, discount, strength, rng
        )
        kept = [*kept, _pack(often)] if keep else kept
        scores = P.strength_scores(customers[~shared], everywhere[~shared], discount)
        total = float(model.tables(often).sum())
        out = [(key, 0, "context_state", [_pack(often), *kept], [total, *map(float, scores)])]
        out += [*model.messages(key, often, n_buckets), *model.split_totals(key, often, split)]
        return pa.Table.from_batches([_batch(out)])

    return run


def _answer_pairs(discount: float, strengths: list[float], totals: list[dict[int, tuple[int, int]]]) -> Callable:
    """Each asked pair's own part of its probability, and each asked context's share for the parent.

    Averaged over the kept sweeps, whose strengths and totals of split contexts are given.
    """

    def run(group: pa.Table) -> pa.Table:
        rows = _rows(group)
        model = _Contexts(next(r for r in rows if r["kind"] == "contexts"))
        own, share = np.zeros(len(model.counts)), np.zeros(model.n)
        kept = next(r for r in rows if r["kind"] == "context_state")["parts"][1:]
        for drawn, strength, split in zip(kept, strengths, totals, strict=True):
            often = _unpack(drawn)
            customers, tables = model.customers.copy(), model.tables(often)
            for i in model.at(split):
                customers[i], tables[i] = split[int(model.hashes[i])]
            seats = model.counts - discount * np.minimum(model.counts, 1)
            seats[model.often] = model.counts[model.often] - discount * often
            own += seats / (strength + customers)[model.context] / len(kept)
            # Without customers a context leaves everything to the parent: its share is 1.
            share += (strength + discount * tables) / (strength + customers) / len(kept)
        out = []
        for r in rows:
            if r["kind"] == "pair_asks":
                at, contexts = (_unpack_rising(x) for x in r["parts"])
                out.append((r["src"], r["key"], "pair_answers", [_pack_values(own[at]), _pack_values(share[contexts])], None))
        return pa.Table.from_batches([_batch(out)])

    return run


# Scores ------------------------------------------------------------------------------------


def _scores(n_buckets: int, split: dict[int, int], all_tokens: int, n_known: int) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        rows = _rows(group)
        b = _Block(next(r for r in rows if r["kind"] == "text"), n_buckets, split)
        b.pairs()
        counts, words = np.zeros(len(b.known), np.int64), np.zeros(len(b.known))
        answers = [r["parts"] for r in rows if r["kind"] == "word_answers"]
        counts[b.word_order] = np.concatenate([_unpack(x) for x, _ in answers])
        words[b.word_order] = np.concatenate([_unpack_values(x) for _, x in answers])
        answers = [r["parts"] for r in rows if r["kind"] == "pair_answers"]
        own = np.concatenate([_unpack_values(x) for x, _ in answers])
        shares = np.concatenate([_unpack_values(x) for _, x in answers])
        heads = np.diff(b.bucket, prepend=-1).astype(bool) | np.diff(b.context, prepend=-1).astype(bool)
        probability = own + shares[np.cumsum(heads) - 1] * words[b.word]
        starts = np.cumsum(b.lengths) - b.lengths
        base = np.log10((counts + 1) / (all_tokens + n_known + 1))
        sums = [np.add.reduceat(x, starts) for x in (np.log10(probability)[b.pair], base[b.place], (counts > 0).astype(np.int64)[b.place])]
        return pa.table(
            {
                "doc_id": pa.array(b.ids, mask=b.nulls), "held_out": pa.array(b.held), "n_tokens": pa.array(b.lengths),
                "n_known": pa.array(sums[2]), "base_score": pa.array(sums[1]), "score": pa.array(sums[0]),
            }
        )

    return run


class _Store:
    """Packets in the shared folder, a folder per kind; all are removed at the end."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def put(self, packets: DataFrame, name: str) -> str:
        path = new_path(self.spark, name)
        packets.write.partitionBy("kind").option("compression", "zstd").parquet(path)
        self.paths.append(path)
        freed(self.spark)
        return path

    def get(self, path: str, *kinds: str) -> DataFrame:
        found = self.spark.read.schema(PACKET).parquet(path)
        return found.where(F.col("kind").isin(*kinds)).select(*_NAMES) if kinds else found.select(*_NAMES)

    def sums(self, path: str, kind: str, n: int) -> list[float]:
        row = self.get(path, kind).agg(*[F.sum(F.get("nums", F.lit(i))) for i in range(n)]).first()
        return [x or 0.0 for x in row]

    def drop(self, *paths: str) -> None:
        for p in paths:
            if p in self.paths:
                self.paths.remove(p)
                dropped(self.spark, p)


def _grouped(packets: DataFrame, step: Callable, schema: str = PACKET) -> DataFrame:
    return packets.groupBy("key").applyInArrow(step, schema)


def _split_totals(store: _Store, path: str, split: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Customers and tables of the contexts that lie in several buckets."""
    out = dict.fromkeys(split, (0, 0))
    if split:
        for r in store.get(path, "split").select("parts").toLocalIterator():
            for h, c, t in zip(_unpack_codes(r.parts[0]), _unpack(r.parts[1]), _unpack(r.parts[2]), strict=True):
                out[int(h)] = (out[int(h)][0] + int(c), out[int(h)][1] + int(t))
    return out


def score_documents(
    docs: DataFrame, learn: str = "learn", held_out: str = "held_out", burn_in: int = 2, samples: int = 3, seed: int = 7,
    bucket_bytes: int = 4 << 20,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, score, train_tokens) of every row of (doc_id, text, learn, held_out).

    ``score`` is the model's log10 probability of the text, ``base_score`` that of single words with one added to each count.
    Words are lower-cased (A-Z), divided at blanks, and an end mark is a word.  Results don't depend on how rows are dealt out.
    """
    spark = docs.sparkSession
    store = _Store(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(learn, F.lit(False)), F.coalesce(held_out, F.lit(False)))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, math.ceil(size / bucket_bytes))
    texts = store.put(rows.mapInArrow(_blocks_of_texts, PACKET), "texts")

    words = store.put(_grouped(store.get(texts, "text").mapInArrow(_send_words(n_buckets), PACKET), _gather_words), "words")
    all_tokens, n_known = (int(x) for x in store.sums(words, "words", 2))
    split = _heavy_contexts(store.get(words, "words"), all_tokens, n_buckets)
    pairs = store.put(
        _grouped(store.get(texts, "text").mapInArrow(_send_pairs(n_buckets, split), PACKET), _gather_pairs(n_buckets, split)), "pairs"
    )
    customers, once, twice = store.sums(pairs, "contexts", 3)
    discount, strength = P.estimated_discount(once, twice), 1.0
    upper_discount, upper_strength = 0.8, 1.0
    rng = np.random.default_rng([seed, 0])

    def words_step(step: int, inputs: DataFrame, tables: float, keep: bool) -> tuple[str, list[float]]:
        run = _word_step(seed, step, n_known, customers, tables, upper_discount, upper_strength, keep)
        path = store.put(_grouped(inputs, run), f"word-step-{step}")
        return path, store.sums(path, "word_state", 3)

    first = store.get(words, "words").unionByName(store.get(pairs, "singles", "tables"))
    start, (tables, once, twice) = words_step(0, first, 0.0, False)
    for kind in ("singles", "tables"):
        dropped(spark, f"{pairs}/kind={kind}")
    above = start
    rest = (upper_strength + upper_discount * tables) / (upper_strength + customers) / (n_known + 1)
    upper_discount = P.estimated_discount(once, twice)
    kept_rest, strengths, kept_totals, below = 0.0, [], [], pairs
    totals = _split_totals(store, pairs, split)
    for step in range(1, burn_in + samples + 1):
        keep = step > burn_in
        inputs = store.get(pairs, "contexts").unionByName(store.get(above, "replies"))
        if below != pairs:
            inputs = inputs.unionByName(store.get(below, "context_state"))
        new_below = store.put(_grouped(inputs, _context_step(seed, step, n_buckets, rest, discount, strength, totals, keep)), f"context-step-{step}")
        if below != pairs:
            store.drop(below)
        below = new_below
        customers, *scores = store.sums(below, "context_state", 1 + len(P.STRENGTHS))
        totals = _split_totals(store, below, split)
        if keep:
            strengths.append(strength)
            kept_totals.append(totals)
        whole = np.array(list(totals.values()), np.int64).reshape(-1, 2)
        strength = P.draw_strength(np.array(scores) + P.strength_scores(whole[:, 0], whole[:, 1], discount), rng)
        inputs = store.get(words, "words").unionByName(store.get(start, "word_fixed")).unionByName(store.get(above, "word_state"))
        new_above, (tables, *_) = words_step(step, inputs.unionByName(store.get(below, "tables")), tables, keep)
        if above != start:
            store.drop(above)
        above = new_above
        rest = (upper_strength + upper_discount * tables) / (upper_strength + customers) / (n_known + 1)
        kept_rest += rest if keep else 0.0
        upper_strength = P.draw_strength(P.strength_scores(np.array([customers]), np.array([tables]), upper_discount), rng)

    answers = store.put(
        _grouped(store.get(pairs, "contexts", "pair_asks").unionByName(store.get(below, "context_state")), _answer_pairs(discount, strengths, kept_totals))
        .unionByName(_grouped(store.get(words, "words", "word_asks").unionByName(store.get(above, "word_state")), _answer_words(samples, kept_rest / samples))),
        "answers",
    )
    store.drop(pairs, words, start, above, below)
    asked = store.get(texts, "text").unionByName(store.get(answers, "word_answers", "pair_answers"))
    path = new_path(spark, "scores")
    for portion in range(PORTIONS):
        some = asked.where(F.pmod(F.xxhash64("key"), F.lit(PORTIONS)) == portion)
        _grouped(some, _scores(n_buckets, split, all_tokens, n_known), _RESULT).write.mode("append").parquet(path)
        freed(spark)
    store.drop(texts, answers)
    found = spark.read.schema(_RESULT).parquet(path)
    return found.withColumn("train_tokens", F.lit(all_tokens).cast("long"))


def _heavy_contexts(words: DataFrame, all_tokens: int, n_buckets: int) -> dict[int, int]:
    """Words with more than a quarter of a bucket's share of all tokens, and over how many buckets they go: fewer than four per bucket."""
    least = max(all_tokens / (4 * n_buckets), 1)
    if n_buckets == 1:
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                hashes, counts = _hashes(row["parts"][0]), _unpack(row["parts"][1])
                at = np.flatnonzero(counts > least)
                yield pa.RecordBatch.from_arrays([pa.array(_codes(hashes[at]).astype(np.int64)), pa.array(counts[at])], names=["word", "n"])

    found = words.mapInArrow(run, "word bigint, n bigint").collect()
    return {r.word: math.ceil(r.n / least) for r in found}


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``: scores of all texts, learned from those whose crc32(doc_id) mod 7 is not 2."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 7
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold != 2).alias("learn"), (fold == 2).alias("held_out"))
    return score_documents(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
