"""Passages that near-duplicate a passage of another document, by compact windows.

A passage is at least 50 words, compared by the set of its five-word shingles.  For each
of a few hash functions, a Cartesian tree over a text's shingle hashes splits all its
runs of at least a passage's length into compact windows (l, c, r): every run that
starts in [l, c] and ends in [c, r] has its smallest hash at c.  Two near-duplicate
passages have the same smallest shingle with a probability of their similarity, so
windows with equal smallest shingles are joined.  Every two places of such a shingle are
compared by the shingles around them: equal neighbourhoods, known by a code that goes with
each place, are linked as they are, and only different ones are sent to be compared.
Of a group of many, the runs of 50 words at one place are put into classes of copies, whose
members are linked to one of them, and every two similar classes are linked; counts and
sketches rule out pairs that share too few shingles.  What is compared says which runs are
similar there; the runs of two texts at one shift are put together to passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from nightgrid.llm.common import SPACES, table
from nightgrid.llm.simhash import _grouped
from nightgrid.llm.words import blocks, byte_tables, find_words, mix, shingle_hashes

MEMBER, FOLD = byte_tables(SPACES)
PASSAGE_WORDS, SHINGLE_WORDS, SIMILARITY = 50, 5, 0.8
#: Windows must agree in one function of five.  A pair at similarity 0.8 fails that with
#: probability 0.2 ** 5 = 0.0003, an exact repeat never; the comparison decides.
FUNCTIONS = 5
#: Smallest shingles are told apart by 45 bits above the function's number, which save room
#: where most of the rows are; others of the same bits are taken for candidates and compared.
_KEY_SHIFT = 16
_FUNCTION_BITS = (1 << _KEY_SHIFT + 3) - 1
#: Words by which insertions may shift two passages against each other.
SHIFT = 5
#: Shingles of a passage.
RUN = PASSAGE_WORDS - SHINGLE_WORDS + 1
#: Rows that a task holds while it looks for shingles of several documents, and links of
#: equal neighbourhoods that it puts together.
SHARED_ROWS, LINK_ROWS = 1 << 16, 1 << 18
#: Texts unpacked at a time.
UNPACKED_ROWS = 1 << 10
#: Rows that a task holds while it compares places of equal shingles, places of a shingle
#: that one task compares (more are cut into tiles), and pairs compared at a time.
STREAM_ROWS, GROUP_ROWS, PAIRS = 1 << 14, 1 << 13, 1 << 13
#: Rows of a group that are compared two by two, and pairs of classes of a larger group looked at at a time.
FEW, CLASS_PAIRS = 3, 1 << 17

_LOW = np.uint64(0xFFFFFFFF)
#: Bits of a side of a window, at most RUN - 1, in the low bits of a neighbourhood's code.
_SIDE_BITS = 6
#: An odd number and its inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def least_shared(size: int, similarity: float = SIMILARITY) -> int:
    """Shingles that two sets of ``size`` must share for a Jaccard similarity."""
    return int(np.ceil(2 * size * similarity / (1 + similarity) - 1e-9))


def compact_windows(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(l, c, r) of all compact windows of ``width`` or more within the ranges [start, end).

    Ranges come in order and don't overlap.  The centres are the smallest hashes of all runs
    of ``width``; whatever bounds a centre's window is a smaller centre or the range's end.
    Of equal hashes the leftmost is the centre.
    """
    wide = end - start >= width
    start, end = start[wide], end[wide]
    if not len(start):
        return (np.zeros(0, np.int64),) * 3
    keys = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    least, span = keys, 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    edge = np.zeros(len(hashes) + 1, np.int8)
    edge[start] += 1
    edge[end - width + 1] -= 1
    least = least[np.cumsum(edge, dtype=np.int8)[: len(least)] > 0]
    centre = (least[np.append(True, least[1:] != least[:-1])] & _LOW).astype(np.int64)
    text = np.searchsorted(start, centre, side="right") - 1
    left, right = _smaller(keys[centre], text, -1), _smaller(keys[centre], text, 1)
    bounds = np.append(centre, -1)
    return (
        np.where(left < 0, start[text], bounds[left] + 1), centre, np.where(right < 0, end[text], bounds[right]) - 1,
    )


def _smaller(keys: np.ndarray, text: np.ndarray, step: int) -> np.ndarray:
    """The nearest place of a smaller key of the same text in the direction of ``step``, or -1."""
    n = len(keys)
    near = np.arange(n) + step
    outside = (near < 0) | (near >= n)
    near[outside] = -1
    near[text[near] != text] = -1
    open_rows = np.flatnonzero(near >= 0)
    while True:
        # What stands between a place and its pointer is larger, so pointers can be followed.
        open_rows = open_rows[keys[near[open_rows]] > keys[open_rows]]
        if not len(open_rows):
            return near
        near[open_rows] = near[near[open_rows]]
        open_rows = open_rows[near[open_rows] >= 0]


def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each shingle, first shingle of each text and one end more, number of words)."""
    words = find_words(data, offsets, MEMBER, FOLD)
    place, hashes = shingle_hashes(words, SHINGLE_WORDS)
    first = np.searchsorted(words.owner[place], np.arange(len(offsets)))
    return hashes, first, np.diff(words.first)[: len(offsets) - 1]


def _fold(value: np.ndarray, near: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows sorted by (value, near, doc): (rows that stay, rows folded away, and what each of these equals).

    Rows of equal ``near`` have the same neighbourhood, so whatever is similar to one is
    similar to all.  One of them stays; each other is linked to a row of another document.
    Where all are of one document nothing can be linked, and all stay.
    """
    row = np.arange(len(value))
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (near[1:] != near[:-1])
    starts, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    first = starts[group]
    foreign = doc != doc[first]
    second = np.minimum.reduceat(np.where(foreign, row, len(row)), starts)[group] if len(row) else row
    folded = ~fresh & (second < len(row))
    return row[~folded], row[folded], np.where(foreign, first, second)[folded]


def _places(batch_text: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """For each block of texts: (row, value, at, left, right, hashes, centre) of all compact windows."""
    for begin, _, data, offsets in blocks(batch_text):
        hashes, first, _ = _shingles(data, offsets)
        parts = []
        for k in range(1, FUNCTIONS + 1):
            mixed = mix(hashes ^ np.uint64(k * 0xD1342543DE82EF95 & (1 << 64) - 1))
            left, centre, right = compact_windows(mixed, first[:-1], first[1:], RUN)
            value = (mixed[centre] & ~np.uint64(_FUNCTION_BITS)) | np.uint64(k << _KEY_SHIFT)
            parts.append((value, centre, centre - left, right - centre))
        value, centre, left, right = (np.concatenate(p) for p in zip(*parts, strict=True))
        text = np.searchsorted(first, centre, side="right") - 1
        reach = RUN - 1
        yield begin + text, value.view(np.int64), centre - first[text], np.minimum(left, reach), np.minimum(right, reach), hashes, centre


def _range_hashes(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash of hashes[low:high] by row, from running sums of powers."""
    power, back = (np.cumprod(np.append(np.uint64(1), np.full(len(hashes), x, np.uint64)), dtype=np.uint64) for x in (_BASE, _INVERSE))
    total = np.append(np.uint64(0), np.cumsum(hashes * power[:-1], dtype=np.uint64))
    return (total[high] - total[low]) * back[low]


def _codes(hashes: np.ndarray, centre: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A code of each neighbourhood: its window and the shingles in it."""
    sides = (left << _SIDE_BITS | right).astype(np.uint64)
    code = mix(_range_hashes(hashes, centre - left, centre + right + 1) ^ mix(sides))
    return (code & ~np.uint64((1 << 2 * _SIDE_BITS) - 1)) | sides


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of smallest shingles, and a code of the neighbourhood of each: its window and the shingles in it."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for row, value, at, left, right, hashes, centre in _places(batch.column(1)):
            code = _codes(hashes, centre, left, right)
            # Places of one shingle in a text go next to each other.
            order = np.lexsort((value, row))
            columns = value, code.view(np.int64), at, ids[row]
            yield pa.RecordBatch.from_arrays([pa.array(x[order]) for x in columns], ["key", "code", "at", "doc"])


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Places, sorted by key, of shingles that stand in several: (key, code, doc, at) and what ``_fold`` says of them."""
    for groups in _grouped(batches, SHARED_ROWS):
        key = groups.column("key").to_numpy()
        again = np.append(False, key[1:] == key[:-1])[: len(key)]
        several = np.flatnonzero(again | np.append(again[1:], False)[: len(key)])
        if not len(several):
            continue
        key, code, doc, at = (groups.column(c).to_numpy()[several] for c in ("key", "code", "doc", "at"))
        order = np.lexsort((at, doc, code, key))
        key, code, doc, at = (x[order] for x in (key, code, doc, at))
        yield key, code, doc, at, *_fold(key, code, doc)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(document, shingle, its neighbourhoods if they are many) of shingles with neighbourhoods of several documents."""
    for key, code, doc, _, stay, _, _ in _classes(batches):
        key, code, doc = key[stay], code[stay], doc[stay]
        fresh = np.append(True, key[1:] != key[:-1])
        first, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        sent = fresh | np.append(True, (code[1:] != code[:-1]) | (doc[1:] != doc[:-1]))
        places = np.add.reduceat(sent.astype(np.int64), first)
        many = np.where(places > GROUP_ROWS, places, 1)
        kept = several[group]
        columns = doc[kept], key[kept], many[group[kept]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["known", "value", "n"])


def _merged_links(links: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one shift that overlap as one row, some ``LINK_ROWS`` at a time."""
    held: list[pa.RecordBatch] = []

    def merged() -> pa.RecordBatch:
        columns = pa.Table.from_batches(held)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(x) for x in merged_runs(*(c.to_numpy() for c in columns))], _LINK_NAMES)

    for batch in links:
        held.append(batch.select(_LINK_NAMES))
        if sum(map(len, held)) >= LINK_ROWS:
            yield merged()
    if held:
        yield merged()


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of places with equal neighbourhoods, which need no comparison."""

    def links() -> Iterator[pa.RecordBatch]:
        for _, code, doc, at, _, gone, equal in _classes(batches):
            if len(gone):
                sides = code[gone] & (1 << 2 * _SIDE_BITS) - 1
                yield _link_batch(doc, at, gone, equal, RUN - 1 - (sides >> _SIDE_BITS), sides & (1 << _SIDE_BITS) - 1)

    yield from _merged_links(links())


_LINK = "doc bigint, other bigint, shift bigint, low bigint, high bigint"
_MEMBER = "key bigint, sides int, at bigint, " + _LINK + ", near binary, more array<bigint>"


def _near_hash(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    odd = mix(np.arange(1, near.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    total = mix((left * 64 + right).astype(np.uint64))
    for k in range(near.shape[1]):
        total = total + mix(near[:, k].astype(np.uint64) ^ odd[k])
    return total


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts made small for their way to the names of their shared shingles."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=6)
    for batch in batches:
        small = [packer.compress(x.as_buffer()) for x in batch.column(1).cast(pa.large_string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary())], ["doc", "text"])


def _unpacked_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for k in range(0, len(batch), UNPACKED_ROWS):
            part = batch.slice(k, UNPACKED_ROWS)
            text = pa.array([unpacker.decompress(x.as_buffer()) for x in part.column(1)], pa.large_binary()).cast(pa.large_string())
            yield from _members([pa.RecordBatch.from_arrays([part.column(0), text, part.column(2)], part.schema.names)])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of shared shingles, each with the shingles around it that lie in its window.

    Equal neighbourhoods of a block are linked here, and those of one document go as one
    row.  A shingle of more than ``GROUP_ROWS`` of them is cut into chunks, and each two
    chunks meet in a tile, as its halves 1 and 2; a chunk by itself is half 0.
    """
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        shared = batch.column(2)
        ends = shared.offsets.to_numpy()
        values = shared.flatten()
        known, sizes = values.field("value").to_numpy(), values.field("n").to_numpy()
        ends = ends - ends[0]
        for row, value, at, left, right, hashes, centre in _places(batch.column(1)):
            n = np.zeros(len(row), np.int64)
            order = np.argsort(row, kind="stable")
            rows, begins = np.unique(row[order], return_index=True)
            for r, mine in zip(rows.tolist(), np.split(order, begins[1:]), strict=True) if len(rows) else ():
                low, high = ends[r], ends[r + 1]
                names = known[low:high]
                by = np.argsort(names)
                k = np.minimum(np.searchsorted(names[by], value[mine]), high - low - 1)
                n[mine] = np.where(names[by][k] == value[mine], sizes[low:high][by][k], 0)
            chosen = np.flatnonzero(n)
            if len(chosen):
                yield from _member_batches(*(x[chosen] for x in (ids[row], value, at, left, right, n)), hashes, centre[chosen])


def _member_batches(doc, value, at, left, right, n, hashes, centre) -> Iterator[pa.RecordBatch]:
    code = _codes(hashes, centre, left, right)
    order = np.lexsort((at, doc, code, value))
    stay, gone, equal = _fold(value[order], code[order], doc[order])
    stay, gone, equal = order[stay], order[gone], order[equal]
    if len(gone):
        runs = RUN - 1 - left[gone], right[gone]
        yield _link_batch(doc, at, gone, equal, *runs)
    # Places of a document with one neighbourhood are one row, at the first.
    same = np.ones(max(0, len(stay) - 1), bool)
    for x in (value, code, doc):
        same &= x[stay[1:]] == x[stay[:-1]]
    begins = np.flatnonzero(np.append(True, ~same))
    places, ends = at[stay], np.append(begins[1:], len(stay))
    stay = stay[begins]
    # Neighbours in a text hold much the same.
    sent = np.lexsort((at[stay], doc[stay]))
    side = np.arange(1 - RUN, RUN)
    for k in range(0, len(sent), STREAM_ROWS):
        part = sent[k : k + STREAM_ROWS]
        rows = stay[part]
        spots = np.clip(centre[rows][:, None] + side, 0, len(hashes) - 1)
        inside = (side >= -left[rows, None]) & (side <= right[rows, None])
        near = np.where(inside, np.maximum((hashes >> np.uint64(32)).astype(np.uint32)[spots], 1), 0).astype(np.uint32)
        yield _member_batch(*(x[rows] for x in (doc, value, at, left, right, n, code)), near, places, begins[part], ends[part])


def _member_batch(doc, value, at, left, right, n, code, near, places, begins, ends) -> pa.RecordBatch:
    chunks = -(-n // GROUP_ROWS)
    # Equal neighbourhoods are of one chunk.
    mine = (mix(code) % chunks.astype(np.uint64)).astype(np.int64)
    of = np.repeat(np.arange(len(n)), chunks)
    theirs = np.arange(len(of)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    tile = np.minimum(mine[of], theirs) * (1 << 20) + np.maximum(mine[of], theirs)
    key = np.where(chunks[of] > 1, mix(value[of].view(np.uint64) ^ mix(tile.astype(np.uint64) + np.uint64(1))).view(np.int64), value[of])
    half = np.sign(theirs - mine[of]) % 3
    sides = (half << _SIDE_BITS | left[of]) << _SIDE_BITS | right[of]
    flat = np.ascontiguousarray(near[of])
    offsets = pa.py_buffer((np.arange(len(of) + 1) * (4 * flat.shape[1])).astype(np.int32).tobytes())
    binary = pa.Array.from_buffers(pa.binary(), len(of), [None, offsets, pa.py_buffer(flat.tobytes())])
    begins, count = begins[of], (ends - begins)[of] - 1
    upto = np.cumsum(count)
    others = places[np.repeat(begins + 1 - (upto - count), count) + np.arange(int(count.sum()))]
    more = pa.ListArray.from_arrays(pa.array(np.append(0, upto).astype(np.int32)), pa.array(others))
    none = pa.nulls(len(of), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(sides.astype(np.int32)), pa.array(at[of]), pa.array(doc[of]),
         none, none, none, none, binary, more], _MEMBER_NAMES
    )


_LINK_NAMES = ["doc", "other", "shift", "low", "high"]
_MEMBER_NAMES = ["key", "sides", "at", *_LINK_NAMES, "near", "more"]


def _link_batch(doc: np.ndarray, at: np.ndarray, one: np.ndarray, two: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """Similar runs of two places, with the larger document first, as rows that go anywhere.

    ``low`` and ``high`` are the first and last run, counted from the first that holds the
    centre; rows get words.  Runs of one shift that overlap or touch become one row.
    """
    one, two = np.where(doc[one] > doc[two], one, two), np.where(doc[one] > doc[two], two, one)
    begin = at[one] - (RUN - 1)
    columns = merged_runs(doc[one], doc[two], at[one] - at[two], begin + low, begin + high + PASSAGE_WORDS)
    key = mix((columns[0] * 1_000_003 + columns[1]).astype(np.uint64)).view(np.int64)
    kinds = pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())
    sides, place, near, more = (pa.nulls(len(key), kind) for kind in kinds)
    return pa.RecordBatch.from_arrays([pa.array(key), sides, place, *map(pa.array, columns), near, more], _MEMBER_NAMES)


def merged_runs(doc: np.ndarray, other: np.ndarray, shift: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Rows [low, high) of each (doc, other, shift), in order, without overlaps."""
    order = np.lexsort((low, shift, other, doc))
    doc, other, shift, low, high = (c[order] for c in (doc, other, shift, low, high))
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (other[1:] != other[:-1]) | (shift[1:] != shift[:-1])
    base = np.cumsum(fresh) * (int(high.max(initial=0)) + 1)
    reach = np.maximum.accumulate(high + base) - base
    fresh[1:] |= low[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    return [doc[first], other[first], shift[first], low[first], reach[np.append(first[1:], len(doc))[: len(first)] - 1]]


def _run_sums(flags: np.ndarray) -> np.ndarray:
    """By row, the sums of all runs that hold the centre."""
    total = np.zeros((len(flags), flags.shape[1] + 1), np.int16)
    np.cumsum(flags, axis=1, dtype=np.int16, out=total[:, 1:])
    return total[:, RUN:] - total[:, :-RUN]


def _similar_sets(one: np.ndarray, two: np.ndarray, repeats: np.ndarray, other_repeats: np.ndarray) -> np.ndarray:
    """By row, whether the sets of numbers, of which so many are repeats, have a similarity of 0.8 or more."""
    shared = (one[:, :, None] == two[:, None, :]).any(axis=2)
    again = np.flatnonzero(repeats)
    if len(again):
        x = one[again]
        shared[again] &= ~((x[:, :, None] == x[:, None, :]) & np.tri(x.shape[1], k=-1, dtype=bool)).any(axis=2)
    both = shared.sum(axis=1)
    return both >= SIMILARITY * (2 * one.shape[1] - repeats - other_repeats - both) - 1e-9


def _repeats(near: np.ndarray, again: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """By row and run, shingles that stand in the run for a second time or more."""
    return RUN - _set_sums(np.ones(near.shape, np.int16), _again(near) if again is None else again)


def _fewest_shared(repeats: np.ndarray) -> np.ndarray:
    """Shingles that runs with together at most so many repeats must share."""
    return np.ceil((2 * RUN - repeats) * SIMILARITY / (1 + SIMILARITY) - 1e-9)


def _shared_close(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By row and run of ``x``: shingles that ``y`` has at most SHIFT off, and those whose place in ``y`` is in the run too."""
    width, run = x.shape[1], np.arange(x.shape[1] - RUN + 1)
    close = np.zeros(x.shape, bool)
    within = np.zeros((len(x), len(run)), np.int16)
    for d in range(-SHIFT, SHIFT + 1):
        low, high = max(0, -d), width - max(0, d)
        same = np.zeros(x.shape, bool)
        same[:, low:high] = (x[:, low:high] == y[:, low + d : high + d]) & (x[:, low:high] != 0)
        close |= same
        if same.any():
            total = np.zeros((len(x), width + 1), np.int16)
            np.cumsum(same, axis=1, dtype=np.int16, out=total[:, 1:])
            within += total[:, run + RUN - max(0, d)] - total[:, run + max(0, -d)]
    return _run_sums(close), within


def similar_runs(near: np.ndarray, a: np.ndarray, b: np.ndarray, asked: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """For pairs of rows of ``near``, as bits, which of the ``asked`` runs that hold the centre are similar."""
    least = least_shared(RUN)
    one, two = near[a], near[b]
    start = np.arange(RUN)
    valid = np.unpackbits(asked.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :RUN].astype(bool)
    repeated = repeats[a] + repeats[b]
    again = repeated > 0
    same = _run_sums((one == two) & (one != 0))
    found = valid & (same >= np.where(again, RUN, least))
    rest = np.flatnonzero((valid & ~found).any(axis=1))
    if len(rest):
        x, y, again = one[rest], two[rest], again[rest]
        # What stands there twice may have its partner further off.
        fewest = _fewest_shared(repeated[rest]) - repeated[rest]
        close, within = _shared_close(x, y)
        open_runs = valid[rest] & ~found[rest] & (close >= fewest)
        # Without repeats in a run the sets share at least what lies within it.
        sure = open_runs & ~again & (within >= least)
        found[rest] |= sure
        pair, run = np.nonzero(open_runs & ~sure)
        for k in range(0, len(pair), 1 << 11):
            p, r = pair[k : k + (1 << 11)], run[k : k + (1 << 11)]
            spots = r[:, None] + start
            found[rest[p], r] = _similar_sets(x[p[:, None], spots], y[p[:, None], spots], repeats[a[rest[p]], r], repeats[b[rest[p]], r])
    packed = np.zeros((len(a), 8), np.uint8)
    packed[:, : -(-RUN // 8)] = np.packbits(found, axis=1, bitorder="little")
    return packed.view("<u8")[:, 0]


def _sketches(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By row, a bit of 512 for each shingle, and how many shingles have no bit of their own.

    Rows share at most the common bits and the smaller of the two numbers.
    """
    flags = np.zeros((len(near), 512), bool)
    row, column = np.nonzero(near)
    flags[row, near[row, column] & np.uint32(511)] = True
    ordered = np.sort(near, axis=1)
    distinct = (ordered[:, 0] != 0).astype(np.int64) + ((ordered[:, 1:] != ordered[:, :-1]) & (ordered[:, 1:] != 0)).sum(axis=1)
    lost = distinct - flags.sum(axis=1)
    return np.packbits(flags, axis=1, bitorder="little").view(np.uint64), lost


def _common_bits(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """By row, the bits that both sketches have: eight counts of at most 64, added up in one number."""
    counts = np.bitwise_count(one & two).view(np.uint64)[:, 0]
    pairs = (counts & np.uint64(0x00FF00FF00FF00FF)) + (counts >> np.uint64(8) & np.uint64(0x00FF00FF00FF00FF))
    return (pairs * np.uint64(0x0001000100010001) >> np.uint64(48)).astype(np.int64)


def _again(near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, next place) of equal shingles that a run may hold both."""
    place = np.arange(near.shape[1], dtype=np.uint64)
    ordered = np.sort((near.astype(np.uint64) << np.uint64(8)) | place, axis=1)
    shingle = ordered >> np.uint64(8)
    row, at = np.nonzero((shingle[:, 1:] == shingle[:, :-1]) & (shingle[:, 1:] != 0))
    one, two = ((ordered[row, k] & np.uint64(255)).astype(np.int64) for k in (at, at + 1))
    inside = two - one < RUN
    return row[inside], one[inside], two[inside]


def _set_sums(values: np.ndarray, again: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """By row, the sums over the sets of all runs that hold the centre: a repeated shingle counts once."""
    row, one, two = again
    total = np.zeros((len(values), values.shape[1] + 1), values.dtype)
    np.cumsum(values, axis=1, dtype=values.dtype, out=total[:, 1:])
    # The runs that hold both places start in [two - RUN + 1, one].
    edge = np.zeros_like(total)
    value = values[row, one]
    np.add.at(edge, (row, np.maximum(two - RUN + 1, 0)), value)
    np.subtract.at(edge, (row, one + 1), value)
    return total[:, RUN:] - total[:, :-RUN] - np.cumsum(edge[:, : values.shape[1] - RUN + 1], axis=1, dtype=values.dtype)


def _met(near: np.ndarray, group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which shingles stand in rows of other documents of the group too; no others can be shared."""
    flat = near.reshape(-1)
    spot = np.flatnonzero(flat)
    row = spot // near.shape[1]
    name = (group[row].astype(np.uint64) << np.uint64(32)) | flat[spot]
    order = np.argsort(name)
    name, doc = name[order], doc[row[order]]
    fresh = np.append(True, name[1:] != name[:-1])[: len(name)]
    starts = np.flatnonzero(fresh)
    met = np.zeros(len(flat), bool)
    if len(starts):
        several = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
        met[spot[order]] = several[np.cumsum(fresh) - 1]
    return met.reshape(near.shape)


def _packed_runs(flags: np.ndarray) -> np.ndarray:
    packed = np.zeros((len(flags), 8), np.uint8)
    packed[:, : -(-RUN // 8)] = np.packbits(flags, axis=1, bitorder="little")
    return packed.view("<u8")[:, 0]


def _pairs_within(group: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every two rows (a, earlier b) of a group, about ``most`` pairs at a time; groups come in order."""
    first = np.searchsorted(group, group)
    earlier = np.arange(len(group)) - first
    upto = np.cumsum(earlier)
    low = 0
    while low < len(group):
        before = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, before + most, side="right")))
        n = earlier[low:high]
        a = np.repeat(np.arange(low, high), n)
        yield a, first[a] + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        low = high


def _similar_rows(near, doc, half, own, repeats, group) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Every two similar rows (a, b) of a group, and the bits of their similar runs."""
    sketch, lost = _sketches(near)
    most = repeats.max(axis=1, initial=0)
    for a, b in _pairs_within(group, PAIRS):
        asked = own[a] & own[b]
        common = _common_bits(sketch[a], sketch[b]) + np.minimum(lost[a], lost[b])
        wanted = ((half[a] == 0) | (half[a] != half[b])) & (doc[a] != doc[b]) & (asked != 0) & (common >= _fewest_shared(most[a] + most[b]))
        a, b = a[wanted], b[wanted]
        if len(a):
            bits = similar_runs(near, a, b, asked[wanted], repeats)
            yield a[bits != 0], b[bits != 0], bits[bits != 0]


def _run_sketches(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_sketches``, of 256 bits."""
    flags = np.zeros((len(tokens), 256), bool)
    row, column = np.nonzero(tokens)
    flags[row, tokens[row, column] & np.uint32(255)] = True
    ordered = np.sort(tokens, axis=1)
    distinct = (ordered[:, 0] != 0).astype(np.int64) + ((ordered[:, 1:] != ordered[:, :-1]) & (ordered[:, 1:] != 0)).sum(axis=1)
    return np.packbits(flags, axis=1, bitorder="little").view(np.uint64), distinct - flags.sum(axis=1)


def _documents(doc: np.ndarray, some: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each class the smallest and largest document among ``some`` of its rows; without any the largest is -1, counted from 0."""
    order = np.unique(doc, return_inverse=True)[1]
    low = np.minimum.reduceat(np.where(some, order, len(doc)), starts)
    return low, np.maximum.reduceat(np.where(some, order, -1), starts)


def _similar_classes(near, doc, half, flags, met, again, repeats, group) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links (a, b, run) of the runs of large groups: of each class of copies its members, and every two similar classes.

    Runs of a group at one place are copies if their sets are equal, or if they hold one equal
    block with nothing around it that any other document has, by which they are similar.  So
    all members of a class are similar to each other, and to whatever one of them is.
    Each is linked to one of another document; of every two similar classes one member each.
    """
    row, run = np.nonzero(flags)
    if not len(row):
        return
    counts = _set_sums(met.astype(np.int16), again)
    sums = _set_sums(np.where(met, mix(near.astype(np.uint64)), np.uint64(0)), again)
    begins = met.copy()
    begins[:, 1:] &= ~met[:, :-1]
    held = np.zeros((len(met), met.shape[1] + 1), np.int16)
    np.cumsum(begins, axis=1, dtype=np.int16, out=held[:, 1:])
    known, size = counts[row, run], RUN - repeats[row, run]
    alone = size - known
    one_block = held[row, run + RUN] - held[row, run + 1] + met[row, run] == 1
    copies = (alone == 0) | (one_block & (known >= SIMILARITY * (size + alone) - 1e-9))
    code = mix(sums[row, run] ^ mix(alone.astype(np.uint64) + np.uint64(1)))
    code = np.where(copies, code, mix(code ^ mix(row.astype(np.uint64) + np.uint64(1))))
    place = group[row] * RUN + run
    order = np.lexsort((row, code, place))
    row, run, known, size, code, place = (x[order] for x in (row, run, known, size, code, place))
    owner = doc[row]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (code[1:] != code[:-1])
    starts, label = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    part = half[row]
    bounds = [_documents(owner, part == h, starts) for h in (1, 2)]
    _, gone, equal = _fold(place, code, owner)
    kept = part[gone] == 0
    if not kept.all():
        # What the tile of a half by itself links is left to it: its members of several documents.
        both = ((bounds[0][1] >= 0) & (bounds[1][1] >= 0))[label[gone]]
        one_document = np.where(part[gone] == 1, *((low == high)[label[gone]] for low, high in bounds))
        across = np.flatnonzero(both & (equal == starts[label[gone]]) & (part[gone] != part[equal]))
        kept |= both & one_document
        kept[across[np.unique(label[gone[across]], return_index=True)[1]]] = True
    yield row[gone[kept]], row[equal[kept]], run[gone[kept]]

    # A member of another document than the first, or none.
    foreign = np.where(owner != owner[starts][label], np.arange(len(row)), len(row))
    second = np.minimum.reduceat(foreign, starts)
    single = second == len(row)
    second = np.where(single, starts, second)
    at, known, size, where = place[starts], known[starts], size[starts], run[starts]
    mine, home = repeats[row[starts], where], owner[starts]
    spots = where[:, None] + np.arange(RUN)
    several = np.bincount(at)[at] > 1
    sketch, lost = np.zeros((len(starts), 4), np.uint64), np.zeros(len(starts), np.int64)
    for k in range(0, len(starts), STREAM_ROWS):
        few = k + np.flatnonzero(several[k : k + STREAM_ROWS])
        tokens = np.where(met[row[starts[few], None], spots[few]], near[row[starts[few], None], spots[few]], 0).astype(np.uint32)
        sketch[few], lost[few] = _run_sketches(tokens)
    partner = np.full(len(starts), -1)
    for a, b in _pairs_within(at, CLASS_PAIRS):
        least = (size[a] + size[b]) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9
        wanted = (np.minimum(known[a], known[b]) >= least) & ~(single[a] & single[b] & (home[a] == home[b]))
        for low, high in bounds:
            # Pairs of one half are linked where it is by itself, unless they are of one document.
            same = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
            wanted &= (high[a] < 0) | (high[b] < 0) | same
        a, b, least = a[wanted], b[wanted], least[wanted]
        common = np.bitwise_count(sketch[a] & sketch[b]).sum(axis=1, dtype=np.int64) + np.minimum(lost[a], lost[b])
        a, b = a[common >= least], b[common >= least]
        for k in range(0, len(a), 1 << 11):
            x, y = a[k : k + (1 << 11)], b[k : k + (1 << 11)]
            one, two = (near[row[starts[z], None], spots[z]] for z in (x, y))
            found = _similar_sets(one, two, mine[x], mine[y])
            x, y = x[found], y[found]
            same = home[x] == home[y]
            left = np.where(same & ~single[x], second[x], starts[x])
            right = np.where(same & single[x], second[y], starts[y])
            yield row[left], row[right], where[x]
            for c, other in ((x, right), (y, left)):
                partner[c[single[c]]] = row[other[single[c]]]
    # All places of a class of one document are linked, each to one place of another class.
    more = np.flatnonzero(~fresh & single[label])
    more = more[partner[label[more]] >= 0]
    yield row[more], partner[label[more]], run[more]


def _spanning(
    key: np.ndarray, doc: np.ndarray, near: np.ndarray, left: np.ndarray, right: np.ndarray, half: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, other row) of rows sorted by (key, doc), and the bits of their similar runs.

    Every two rows of a key that can be similar are compared.  Of larger groups the runs are
    first put into classes of copies; every two similar classes are linked, and every member
    of a class to another.  Of rows in halves 1 and 2 only those of different halves are.
    """
    n = len(key)
    half = np.zeros(n, np.int64) if half is None else half
    fresh = np.append(True, key[1:] != key[:-1])[:n]
    starts, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    again = _again(near)
    met = _met(near, group, doc)
    repeats = _repeats(near, again)
    inside = np.arange(RUN)
    flags = (inside >= RUN - 1 - left[:, None]) & (inside <= right[:, None])
    size = RUN - repeats
    smallest = np.minimum.reduceat(np.where(flags, size, RUN), starts, axis=0)[group] if n else size
    # What a run shares with the smallest one that it can meet, and with one of any size.
    least = np.maximum((size + smallest) * (SIMILARITY / (1 + SIMILARITY)), SIMILARITY * size) - 1e-9
    flags &= _set_sums(met.astype(np.int16), again) >= least
    own = _packed_runs(flags)
    rows = np.flatnonzero(own)
    # Groups as they are without the rows that nothing can be similar to.
    few = np.bincount(group[rows], minlength=len(starts))[group] <= FEW
    pairs, bits = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.uint64)]

    def add(a, b, which) -> None:
        pairs.append(np.column_stack([np.maximum(a, b), np.minimum(a, b)]))
        bits.append(which)

    some = rows[few[rows]]
    for a, b, which in _similar_rows(near[some], doc[some], half[some], own[some], repeats[some], group[some]):
        add(some[a], some[b], which)
    flags[few] = False
    for a, b, run in _similar_classes(near, doc, half, flags, met, again, repeats, group):
        add(a, b, np.uint64(1) << run.astype(np.uint64))
    links, bits = np.concatenate(pairs), np.concatenate(bits)
    if not len(links):
        return links, bits
    order = np.lexsort((links[:, 1], links[:, 0]))
    links, bits = links[order], bits[order]
    first = np.flatnonzero(np.append(True, (links[1:] != links[:-1]).any(axis=1)))
    return links[first], np.bitwise_or.reduceat(bits, first)


def _bit_runs(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, first, last) of every run of ones."""
    one = np.uint64(1)
    edges = [
        np.nonzero(np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        for x in (bits & ~(bits << one), bits & ~(bits >> one))
    ]
    return edges[0][0], edges[0][1], edges[1][1]


def _further_places(places: pa.ChunkedArray, one: np.ndarray, two: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, other row, place, bits) that link the further places of each row: as many links as cover all runs of the row's."""
    places = places.combine_chunks()
    count = places.value_lengths().fill_null(0).to_numpy()
    begin = np.cumsum(count) - count
    values = places.flatten().to_numpy()
    row, partner, bits = np.append(one, two), np.append(two, one), np.append(bits, bits)
    some = np.flatnonzero(count[row])
    some = some[np.argsort(row[some], kind="stable")]
    row, partner, bits = row[some], partner[some], bits[some]
    # A link is taken if it adds a run to those before it.
    covered, held, taken = 0, -1, np.zeros(len(row), bool)
    for k, (r, b) in enumerate(zip(row.tolist(), bits.tolist(), strict=True)):
        covered, held = covered if r == held else 0, r
        taken[k] = bool(b & ~covered)
        covered |= b
    row, partner, bits = row[taken], partner[taken], bits[taken]
    n = count[row]
    spot = np.repeat(begin[row] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return np.repeat(row, n), np.repeat(partner, n), values[spot], np.repeat(bits, n)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows sorted by (key, doc, at), and those made before."""
    yield from _merged_links(_found_links(batches))


def _found_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made: list[pa.RecordBatch] = []

    def members() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made.append(batch.filter(batch.column("other").is_valid()).select(_LINK_NAMES))
            yield batch.filter(batch.column("other").is_null())

    for groups in _grouped(members(), STREAM_ROWS):
        yield from made
        made.clear()
        if not len(groups):
            continue
        key, doc, at, sides = (groups.column(c).to_numpy() for c in ("key", "doc", "at", "sides"))
        half, left, right = (sides >> _SIDE_BITS * k & (1 << _SIDE_BITS) - 1 for k in (2, 1, 0))
        near = np.frombuffer(b"".join(groups.column("near").to_pylist()), np.uint32).reshape(len(key), -1)
        code = _near_hash(near, left, right)
        order = np.lexsort((at, doc, code, key))
        stay, gone, equal = (order[x] for x in _fold(key[order], code[order], doc[order]))
        stay = stay[np.lexsort((at[stay], doc[stay], key[stay]))]
        found, bits = _spanning(*(x[stay] for x in (key, doc, near, left, right, half)))
        gone, equal = gone[half[gone] == 0], equal[half[gone] == 0]
        inside = np.arange(RUN)
        whole = _packed_runs((inside >= RUN - 1 - left[gone, None]) & (inside <= right[gone, None]))
        one, two = np.append(gone, stay[found[:, 0]]), np.append(equal, stay[found[:, 1]])
        bits = np.append(whole, bits)
        if len(one):
            row, partner, more, which = _further_places(groups.column("more"), one, two, bits)
            link, low, high = _bit_runs(np.append(bits, which))
            one, two = np.append(one, len(at) + np.arange(len(row)))[link], np.append(two, partner)[link]
            yield _link_batch(np.append(doc, doc[row]), np.append(at, more), one, two, low, high)
    yield from made


def repeated_passages(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pairs of passages: doc_id, start_word, end_word, and the same of the ``other`` one.

    Words are split at ASCII white space, lower-cased A-Z, and counted from 0; ends are
    exclusive.  Every two places of a shared smallest shingle are compared by the runs of 50
    words that hold it.  Copies of a run are one class: k documents give k - 1 links or a
    few more, not all pairs.  Copies are equal sets of shingles, or one equal block with
    nothing beside it that another document of the group has, by which they are similar.
    Of every two similar classes one member each is linked, so no link between different
    texts is left out.  A passage that stands at several places of a document is reported
    at each.  Texts of
    fewer than 50 words (null and empty ones too) have no passages, and rows with a null
    key can't be named and are left out.  Rows of one key are one document: passages
    shared between them are not reported.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).where(
        F.col("doc").isNotNull() & F.col("text").isNotNull()
    )
    windows = rows.mapInArrow(_windows, "key bigint, code bigint, at bigint, doc bigint").repartition("key").sortWithinPartitions("key")
    shared = windows.mapInArrow(_shared, "known bigint, value bigint, n bigint")
    known = shared.groupBy("known").agg(F.collect_list(F.struct("value", "n")).alias("shared"))
    packed = rows.mapInArrow(_packed, "doc bigint, text binary")
    named = packed.join(known, F.col("doc") == F.col("known")).select("doc", "text", "shared")
    members = named.mapInArrow(_unpacked_members, _MEMBER).repartition("key").sortWithinPartitions("key", "doc", "at")
    links = members.mapInArrow(_links, _LINK).unionAll(windows.mapInArrow(_copies, _LINK))
    # Both starts and a length take less room than a shift and an end.
    small = links.select("doc", "other", (F.col("low") - F.col("shift")).alias("other_low"), "low", (F.col("high") - F.col("low")).alias("words"))
    links = small.repartition("doc", "other", F.col("low") - F.col("other_low")).select(
        "doc", "other", (F.col("low") - F.col("other_low")).alias("shift"), "low", (F.col("low") + F.col("words")).alias("high")
    )
    # Overlapping runs of one shift are one passage; a group is at most a text's windows.
    shift = Window.partitionBy("doc", "other", "shift").orderBy("low")
    before = F.max("high").over(shift.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("low") > before, F.lit(True)).cast("int")
    found = links.select("*", apart.alias("apart")).select(
        *_LINK_NAMES, F.sum("apart").over(shift.rowsBetween(Window.unboundedPreceding, 0)).alias("passage")
    ).groupBy("doc", "other", "shift", "passage").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return found.select(
        F.col("doc").alias("doc_id"), F.col("low").alias("start_word"), F.col("high").alias("end_word"),
        F.col("other").alias("other_doc_id"), (F.col("low") - F.col("shift")).alias("other_start"),
        (F.col("high") - F.col("shift")).alias("other_end"),
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
