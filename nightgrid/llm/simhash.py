"""Near duplicates by SimHash, searched with a hierarchical index in Gray order.

Fingerprints are brought together by keys that two fingerprints within the distance
must share in part.  The fingerprints of a key are sorted by their rank in the Gray
code, in which equal leading bits stand together, so each level of the index is a run
of the level below with its own eight bits factored out.  The search descends pairs of
nodes, adds up the differing bits, and drops a pair of whole groups as soon as the sum
is over the distance, or when all below both is already linked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightgrid.llm.common import replaced, table, written
from nightgrid.llm.words import mix

DISTANCE = 3
SHINGLE_WORDS = 5
SEED = 42
#: Distance ``d`` and ``d + 2`` parts of the fingerprint: two parts at least agree.
PARTS, PART_BITS = 5, (13, 13, 13, 13, 12)
#: Fingerprints of a key that one task compares; larger groups are cut into tiles.
GROUP_ROWS = 1 << 14
#: Fingerprints, and pairs of nodes, that a task holds at a time.
STREAM_ROWS, FRONTIER = 1 << 16, 1 << 17

#: Similar texts: five-word shingles, Jaccard similarity of 0.8 or more.
SIMILARITY = 0.8
#: Two sets with that similarity have a cosine of 0.89 (8 / 9), so a bit of their fingerprints differs
#: with probability acos(8 / 9) / pi = 0.1515: 77.6 of 512 bits, with deviation 8.1; sets of four and five
#: shingles differ in 96 bits.  Up to the bound, which such pairs hardly ever reach, the sets themselves decide.
WIDE_WORDS = 8
WIDE_DISTANCE = 135
#: A band is three anchors.  One of ten bands is shared with probability
#: 1 - (1 - 0.8 ** 3) ** 10 = 0.9992 at similarity 0.8, and hardly ever by texts that only
#: have a frequent passage in common: at similarity 0.15 with probability 0.03.
BANDS, BAND_ANCHORS = 10, 3
#: Of the first 64 bits, 9.7 differ on average at that similarity, with deviation 2.9; 12 of short texts.
NARROW_DISTANCE = 26
#: Shingles of a chunk when sets are compared; a tile holds two chunks.
CHUNK_SHINGLES = 1 << 22
#: Pairs that are compared before what they link is looked at.
PAIRS_AT_ONCE = 512

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_POP = np.array([bin(i).count("1") for i in range(256)], np.int64)


def shingle_values(text: str, n: int) -> np.ndarray:
    """XXH64 of each n-word shingle, repeats included; fewer words are one shingle."""
    import xxhash

    words = text.encode().translate(_LOWER).split()
    joined = b" ".join(words)
    if len(words) <= n:
        values = [xxhash.xxh64_intdigest(joined, SEED)] if words else []
        return np.array(values, np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    hashed = xxhash.xxh64_intdigest
    return np.array(
        [hashed(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[n - 1 :].tolist(), strict=False)], np.uint64
    )


def fingerprint_of(values: np.ndarray) -> int:
    """A bit is set if it is set in over half of the values; no values: zero."""
    count = np.zeros(64, np.int64)
    for k in range(0, len(values), 1 << 14):
        part = np.ascontiguousarray(values[k : k + (1 << 14)], "<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(values), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The 64-bit fingerprint as a signed long; of null or no words: zero."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint_of(shingle_values(t or "", shingle_words)) for t in batch.to_pylist()]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    return of(text)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each 64-bit word in the Gray code."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(k))
    return x


def roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest index reachable from each of ``n`` nodes over the links a-b."""
    label = np.arange(n) if label is None else label.copy()
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            return label
        label = new


class GrayIndex:
    """The hierarchical index over rows sorted by (group, Gray rank of ``codes``)."""

    def __init__(self, group: np.ndarray, codes: np.ndarray):
        self.n = len(codes)
        self.firsts: list[np.ndarray] = []  # by level, each node's first row
        self.bits: list[np.ndarray] = []  # by level, each node's own eight bits
        self.children: list[np.ndarray] = []  # by level, each node's first child; one more at the end
        fresh = np.ones(self.n, bool)
        fresh[1:] = group[1:] != group[:-1]
        self.firsts.append(np.flatnonzero(fresh))
        for level in range(8):
            own = (codes >> np.uint64(56 - 8 * level)).astype(np.int64) & 255
            fresh = fresh.copy()
            fresh[1:] |= own[1:] != own[:-1]
            first = np.flatnonzero(fresh)
            self.children.append(np.searchsorted(first, np.append(self.firsts[-1], self.n)))
            self.firsts.append(first)
            self.bits.append(own[first])

    def link(self, distance: int, same: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> np.ndarray:
        """The root row of each row, over links within ``distance`` that ``same`` accepts."""
        self.distance, self.same = distance, same
        self.label = np.arange(self.n)
        self._label_nodes()
        top = np.arange(len(self.firsts[0]))
        top = top[np.diff(np.append(self.firsts[0], self.n)) > 1]
        for k in range(0, len(top), FRONTIER):
            self._descend(0, top[k : k + FRONTIER], top[k : k + FRONTIER], np.zeros(len(top[k : k + FRONTIER]), np.int64))
        return self.label

    def _label_nodes(self) -> None:
        self.low = [np.minimum.reduceat(self.label, f) for f in self.firsts]
        self.high = [np.maximum.reduceat(self.label, f) for f in self.firsts]

    def _open(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of nodes hold more than one component."""
        low, high = self.low[level], self.high[level]
        return (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])

    def _descend(self, level: int, a: np.ndarray, b: np.ndarray, differ: np.ndarray) -> None:
        keep = self._open(level, a, b)
        a, b, differ = a[keep], b[keep], differ[keep]
        if not len(a):
            return
        if level == 8:
            return self._leaves(a, b)
        child = self.children[level]
        wide, high = child[a + 1] - child[a], child[b + 1] - child[b]
        size = wide * high
        if size.sum() > FRONTIER and len(a) > 1:
            half = int(np.searchsorted(np.cumsum(size), size.sum() // 2)) + 1
            half = min(max(half, 1), len(a) - 1)
            self._descend(level, a[:half], b[:half], differ[:half])
            return self._descend(level, a[half:], b[half:], differ[half:])
        of = np.repeat(np.arange(len(a)), size)
        place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        one, two = child[a][of] + place // high[of], child[b][of] + place % high[of]
        more = differ[of] + _POP[self.bits[level][one] ^ self.bits[level][two]]
        near = (more <= self.distance) & (one <= two)
        return self._descend(level + 1, one[near], two[near], more[near])

    def _leaves(self, a: np.ndarray, b: np.ndarray) -> None:
        """Compares all rows of leaf pairs; a leaf holds the rows of one code."""
        first = np.append(self.firsts[8], self.n)
        wide, high = first[a + 1] - first[a], first[b + 1] - first[b]
        if self.same is None:
            # Rows of one code are as near as can be: each follows the leaf's first row.
            rows = np.concatenate([np.arange(first[x], first[x + 1]) for x in np.unique(a[a == b])] or [np.zeros(0, np.int64)])
            leaf = np.searchsorted(first, rows, side="right") - 1
            return self._join(np.append(first[a], first[leaf]), np.append(first[b], rows))
        rows = np.repeat(first[a], wide) + np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
        low, size = np.repeat(first[b], wide), np.repeat(high, wide)
        # One row against the rows of the other leaf, so many at a time.
        at = 0
        while at < len(rows):
            end = max(at + 1, at + int(np.searchsorted(np.cumsum(size[at : at + FRONTIER]), FRONTIER)))
            part = size[at:end]
            place = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
            one, two = np.repeat(rows[at:end], part), np.repeat(low[at:end], part) + place
            later = (one < two) | (np.repeat(low[at:end], part) > one)
            self._join(one[later], two[later])
            at = end

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        before = self.label
        step = len(a) if self.same is None else PAIRS_AT_ONCE
        for at in range(0, len(a), max(step, 1)):
            one, two = a[at : at + step], b[at : at + step]
            apart = self.label[one] != self.label[two]
            one, two = one[apart], two[apart]
            if self.same is not None and len(one):
                fits = self.same(one, two)
                one, two = one[fits], two[fits]
            if len(one):
                self.label = roots(self.n, one, two, self.label)
        if self.label is not before:
            self._label_nodes()


def _grouped(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Whole groups of equal ``key`` (rows come sorted by it), several at a time."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(map(len, held)) < rows:
            continue
        whole = pa.concat_tables(held).combine_chunks()
        key = whole.column("key").to_numpy()
        change = np.flatnonzero(key[1:] != key[:-1]) + 1
        cut = int(change[-1]) if len(change) else 0
        if cut:
            yield whole.slice(0, cut)
        held = [whole.slice(cut)]
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _sort_code(code: Column) -> Column:
    """An order-preserving signed form of the Gray rank."""
    for k in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, k))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets given as sorted arrays; two empty ones are equal."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def search_groups(rows: DataFrame, distance: int, same_bits: int | None = None, least: float | None = None) -> DataFrame:
    """Links (node, root) among rows of equal key: node id, and the smallest of its local group.

    ``rows``: key long, node long, code long, and ``rest`` array<long> when ``same_bits``
    is given; then codes and rests together may differ in at most ``same_bits`` bits.  With ``least``
    rows have ``shingles`` too, a sorted array<long>, and sets must be as similar as that.
    A key with more than ``GROUP_ROWS`` rows, or ``CHUNK_SHINGLES`` shingles, is cut into chunks, and each two chunks
    meet in a tile, a key of its own.
    """
    rows = written(rows, "keys")
    load = F.lit(0) if least is None else F.sum(F.size("shingles"))
    sizes = rows.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / GROUP_ROWS), F.ceil(load / CHUNK_SHINGLES)).alias("n"))
    large = written(sizes.where(F.col("n") > 1), "large")
    stream_rows = STREAM_ROWS if least is None else STREAM_ROWS >> 6
    if not large.isEmpty():
        chunks = F.col("n").cast("int")
        # Chunk numbers come from the node, so that a row is in the same chunk in any attempt.
        mine = F.pmod(F.xxhash64("node"), chunks).cast("int")
        other = F.explode(F.sequence(F.lit(0), chunks - 1))
        tiled = (
            rows.join(large, "key").withColumn("mine", mine).withColumn("other", other)
            .withColumn("key", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")))
            .drop("n", "mine", "other")
        )
        rows = rows.join(large, "key", "left_anti").unionByName(tiled.select(rows.columns))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _grouped(batches, stream_rows):
            key = groups.column("key").to_numpy()
            again = np.append(False, key[1:] == key[:-1])
            several = np.flatnonzero(again | np.append(again[1:], False))
            if not len(several):
                continue
            groups = groups.take(pa.array(several))
            key = groups.column("key").to_numpy()
            code = groups.column("code").to_numpy().view(np.uint64)
            node = groups.column("node").to_numpy()
            same = None
            if same_bits is not None:
                rest = groups.column("rest").combine_chunks()
                width = len(rest.values) // len(rest)
                wide = np.column_stack([code, rest.flatten().to_numpy().view(np.uint64).reshape(-1, width)])

                def near(a, b, wide=wide):
                    return np.bitwise_count(wide[a] ^ wide[b]).sum(axis=1, dtype=np.int64) <= same_bits

                same = near
            if least is not None:
                lists = groups.column("shingles").combine_chunks()
                values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
                size = np.diff(offsets)

                def same(a, b, near=near, values=values, offsets=offsets, size=size):
                    # Sets of too different sizes can't be similar.
                    fits = near(a, b) & (np.minimum(size[a], size[b]) >= least * np.maximum(size[a], size[b]))
                    for k in np.flatnonzero(fits):
                        x, y = a[k], b[k]
                        one, two = values[offsets[x] : offsets[x + 1]], values[offsets[y] : offsets[y + 1]]
                        fits[k] = similarity(one, two) >= least
                    return fits

            root = GrayIndex(key, code).link(distance, same)
            linked = np.flatnonzero(root != np.arange(len(root)))
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[linked]), pa.array(node[root[linked]])], ["node", "root"]
                )

    sorted_rows = rows.withColumn("__llm_rank", _sort_code(F.col("code"))).repartition("key").sortWithinPartitions("key", "__llm_rank")
    return sorted_rows.drop("__llm_rank").mapInArrow(search, "node bigint, root bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over the links; nodes without links are left out.

    Each round takes the smallest label among the neighbours and then that label's own
    label, so the number of rounds grows with the logarithm of a chain's length.  Every
    round is written to the shared folder.
    """
    both = links.select("node", "root").union(links.select("root", "node")).toDF("node", "near")
    both = written(both.where("node <> near").distinct(), "links")
    labels = written(both.groupBy("node").agg(F.least("node", F.min("near")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("near"), F.col("label").alias("theirs")), "near")
            .groupBy("node").agg(F.min("theirs").alias("theirs"))
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "theirs").alias("new"))
        own = labels.select(F.col("node").alias("new"), F.col("label").alias("further"))
        after = written(
            lower.join(own, "new").select("node", F.least("new", "further").alias("label"), F.col("label").alias("was")),
            "labels",
        )
        settled = after.where("label <> was").isEmpty()
        labels = after.drop("was")
        if settled:
            return labels


def _pair_keys(code: Column) -> Column:
    """For each two of the five parts: their numbers and bits as one long."""
    parts, low = [], 0
    for bits in PART_BITS:
        parts.append(F.shiftrightunsigned(code, low).bitwiseAND(F.lit((1 << bits) - 1).cast("long")))
        low += bits
    return F.array(*[
        F.shiftleft(F.lit(k).cast("long"), 26) + F.shiftleft(parts[i], 13) + parts[j]
        for k, (i, j) in enumerate(combinations(range(PARTS), 2))
    ])


def link_fingerprints(rows: DataFrame, id_column: str) -> DataFrame:
    """``rows`` (id, code long) with ``component_id``: the smallest id reachable.

    Fingerprints link at ``DISTANCE`` or fewer differing bits.  Equal fingerprints are
    one node, however many rows have them.
    """
    rows = written(rows, "fingerprints")
    nodes = rows.groupBy("code").agg(F.min(id_column).alias("first_id"))
    keys = nodes.select(F.explode(_pair_keys(F.col("code"))).alias("key"), F.col("code").alias("node"), "code")
    return _with_components(rows, nodes, search_groups(keys, DISTANCE), "code", id_column)


def _with_components(rows: DataFrame, nodes: DataFrame, links: DataFrame, node: str, id_column: str) -> DataFrame:
    labels = components(links)
    named = nodes.join(labels, nodes[node] == labels["node"], "left").select(
        nodes[node], "first_id", F.coalesce("label", nodes[node]).alias("label")
    )
    # Written, so that the join shuffles both sides and Spark can split a large component.
    smallest = written(named.groupBy("label").agg(F.min("first_id").alias("component_id")), "smallest")
    named = written(named.join(smallest, "label").select(node, "component_id"), "components")
    return rows.join(named, node)


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row per document: the key, ``fingerprint`` (16 hex digits) and ``component_id``.

    Documents whose fingerprints differ in at most three bits are linked;
    ``component_id`` is the smallest key reachable.  Null, empty and blank texts have
    fingerprint zero and are linked like any other.  Repeated rows stay; a null key
    stays and is never a component's id unless all keys there are null.
    """
    rows = docs.select(F.col(key).alias("id"), fingerprint(F.col(text).cast("string"), shingle_words).alias("code"))
    linked = link_fingerprints(rows, "id")
    return linked.select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id"
    )


def _mixings(values: np.ndarray, n: int, first: int) -> Iterator[np.ndarray]:
    """``n`` reorderings of 64-bit values."""
    for k in range(first, first + n):
        odd = np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1 | 1)
        mixed = (values ^ (values >> np.uint64(31))) * odd
        yield (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _wide(text: Column) -> Column:
    """A struct of the wide fingerprint of the set of shingles, and the keys of its bands.

    An anchor is the smallest value of the shingles under a mixing, a key the hash of a
    band's anchors.
    """

    @F.arrow_udf("struct<code:bigint,rest:array<bigint>,bands:array<bigint>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            codes, rests, bands = [], [], []
            for value in batch.to_pylist():
                values = np.unique(shingle_values(value or "", SHINGLE_WORDS))
                codes.append(fingerprint_of(values))
                rests.append([fingerprint_of(mix(m)) for m in _mixings(values, WIDE_WORDS - 1, 1)])
                anchors = [m.min() if len(m) else 0 for m in _mixings(values, BANDS * BAND_ANCHORS, WIDE_WORDS)]
                bands.append(np.array(anchors, np.uint64).reshape(BANDS, BAND_ANCHORS))
            key = np.array(bands, np.uint64).reshape(-1, BANDS, BAND_ANCHORS)
            total = np.zeros(key.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
            for k in range(BAND_ANCHORS):
                total = mix(total ^ key[:, :, k])
            arrays = [pa.array(np.array(codes, np.uint64).view(np.int64))]
            for numbers, width in ((np.array(rests, np.uint64), WIDE_WORDS - 1), (total, BANDS)):
                flat = pa.array(np.ascontiguousarray(numbers).reshape(-1).view(np.int64))
                arrays.append(pa.FixedSizeListArray.from_arrays(flat, width).cast(pa.list_(pa.int64())))
            yield pa.StructArray.from_arrays(arrays, ["code", "rest", "bands"])

    return of(text)


def _shingle_set(text: Column) -> Column:
    """The distinct shingles of a text as sorted numbers."""

    @F.arrow_udf("array<bigint>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sets = [np.unique(shingle_values(t or "", SHINGLE_WORDS).view(np.int64)) for t in batch.to_pylist()]
            yield pa.array(sets, pa.list_(pa.int64()))

    return of(text)


def similar_documents(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key and ``component_id`` at similarity 0.8 of five-word shingles.

    Three bits of 64 only reach nearly equal texts, and keys from parts of a fingerprint
    can't find 15 of 100 differing bits.  So fingerprints have 512 bits, bands of anchors
    (shingles that are smallest under a mixing) bring candidates together, and the Gray-order
    index searches each band's group by the first 64 bits and then all.  That gives groups of candidates.
    Within these the index is searched again, and now the sets of shingles decide: every link has a similarity
    of 0.8 or more, and every pair of a group that the bits allow is compared or already connected.

    Texts with the same 512 bits count as equal.  Null, blank and empty texts are similar to one another.
    A null key stays and is never a component's id unless all keys there are null; repeated rows stay.
    """
    docs = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    wide = docs.select("id", F.xxhash64("text").alias("text_hash"), _wide(F.col("text")).alias("w"))
    wide = wide.select("id", "text_hash", "w.*")
    rows = written(wide.withColumn("node", F.xxhash64("code", "rest")), "wide")
    nodes = rows.groupBy("node").agg(
        F.min("id").alias("first_id"), F.min("text_hash").alias("text_hash"), *[F.first(c).alias(c) for c in ("code", "rest", "bands")]
    )
    nodes = written(nodes, "nodes")
    keys = nodes.select(F.explode("bands").alias("key"), "node", "code", "rest")
    candidates = components(search_groups(keys, NARROW_DISTANCE, WIDE_DISTANCE))
    some = written(
        nodes.join(candidates, "node").select("node", "code", "rest", "text_hash", F.col("label").alias("key")), "candidates"
    )
    # One text for each node that has a candidate.
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").join(some.select("text_hash").distinct(), "text_hash", "left_semi")
    sets = texts.dropDuplicates(["text_hash"]).select("text_hash", _shingle_set(F.col("text")).alias("shingles"))
    links = search_groups(some.join(sets, "text_hash").drop("text_hash"), NARROW_DISTANCE, WIDE_DISTANCE, SIMILARITY)
    return _with_components(rows.select("id", "node"), nodes.select("node", "first_id"), links, "node", "id").select(
        F.col("id").alias(key), "component_id"
    )


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, shingle_words=3)
