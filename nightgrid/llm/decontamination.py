"""Benchmark decontamination by a prefix-filtered containment join.

Every benchmark item is cut into windows of ten words (a shorter item is one window).
A document contains a window only if it contains all of the window's shingles, so one of
them is a sufficient prefix: the rarest by the number of documents that hold it.  A
document's shingles are looked up among these prefixes alone; a match fixes where the
window would have to start, the text's length bounds that place, and the words there
are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightgrid.llm.common import replaced, table, written
from nightgrid.llm.words import Words, blocks, byte_tables, find_words, shingle_hashes

#: Words are runs of ASCII letters, digits and anything beyond ASCII.
MEMBER, FOLD = byte_tables([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: Words of the items that are broadcast together (about 100 bytes each); more items
#: are taken in as many rounds as needed.
BLOCK_WORDS = 500_000
_FILTER_BITS = 22

RESULT = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>"


class Windows(NamedTuple):
    """The windows of a block of items, as arrays; windows of ``n`` words have width n."""

    words: list[list[bytes]]
    items: list[list[str]]
    hashes: np.ndarray  #: windows x WINDOW_WORDS, zero beyond the width
    width: np.ndarray
    shingles: dict[int, np.ndarray]  #: sorted hashes by shingle width
    members: list[tuple[int, int, int, int]]  #: (window, shingle width, shingle, offset)


class Prefixes(NamedTuple):
    """By shingle width: sorted hashes, and for each its (window, offset) entries."""

    hashes: np.ndarray
    first: np.ndarray
    window: np.ndarray
    offset: np.ndarray
    filter: np.ndarray


def cut_windows(items: list[tuple[str, str]], window: int = WINDOW_WORDS) -> Windows:
    found: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        words = text.encode().translate(FOLD).split(b" ")
        words = [w for w in words if w]
        for i in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(tuple(words[i : i + window]), set()).add(item)
    windows = [list(w) for w in found]
    texts = pa.array([b" ".join(w).decode("utf-8", "replace") for w in windows], pa.string())
    hashes = np.zeros((len(windows), window), np.uint64)
    width = np.array([len(w) for w in windows], np.int64)
    runs: dict[int, list] = {}
    for first, _, data, offsets in blocks(texts):
        words = find_words(data, offsets, MEMBER, FOLD)
        hashes[first + words.owner, np.arange(len(words.owner)) - words.first[words.owner]] = words.hash
        for n in {min(SHINGLE_WORDS, int(w)) for w in width}:
            place, shingle = shingle_hashes(words, n)
            owner = first + words.owner[place]
            mine = np.minimum(width[owner], SHINGLE_WORDS) == n
            runs.setdefault(n, []).append((owner[mine], shingle[mine], (place - words.first[words.owner[place]])[mine]))
    shingles, members = {}, []
    for n, parts in runs.items():
        owner, shingle, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
        shingles[n] = np.unique(shingle)
        index = np.searchsorted(shingles[n], shingle)
        members += zip(owner.tolist(), [n] * len(owner), index.tolist(), offset.tolist(), strict=True)
    return Windows(windows, [sorted(x) for x in found.values()], hashes, width, shingles, members)


def _lookup(hashes: np.ndarray, known: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``hashes``, index in ``known``) of the members of ``known``."""
    at = np.flatnonzero(bits[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    index = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
    same = known[index] == hashes[at]
    return at[same], index[same]


def _filter(known: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << _FILTER_BITS, bool)
    bits[(known >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return bits


def _document_counts(docs: DataFrame, text: Column, shingles: Broadcast) -> dict[tuple[int, int], int]:
    """In how many documents each benchmark shingle occurs: one pass, summed per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shingles.value
        bits = {n: _filter(x) for n, x in known.items()}
        sums = {n: np.zeros(len(x), np.int64) for n, x in known.items()}
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                words = find_words(data, offsets, MEMBER, FOLD)
                for n in known:
                    place, hashes = shingle_hashes(words, n)
                    at, index = _lookup(hashes, known[n], bits[n])
                    pairs = np.unique(words.owner[place[at]] * len(known[n]) + index)
                    sums[n] += np.bincount(pairs % len(known[n]), minlength=len(known[n]))
        for n, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), n)), pa.array(at), pa.array(total[at])], ["width", "shingle", "n"]
            )

    counts = docs.select(text.alias("text")).mapInArrow(count, "width bigint, shingle bigint, n bigint")
    rows = counts.groupBy("width", "shingle").agg(F.sum("n").alias("n")).collect()
    return {(row.width, row.shingle): row.n for row in rows}


def _choose(windows: Windows, counts: dict[tuple[int, int], int]) -> dict[int, Prefixes]:
    """The rarest shingle of each window; a window with a shingle in no document is out."""
    best: dict[int, tuple] = {}
    for window, n, shingle, offset in windows.members:
        rank = (counts.get((n, shingle), 0), offset, n, shingle)
        if window not in best or rank < best[window]:
            best[window] = rank
    chosen: dict[int, list] = {}
    for window, (seen, offset, n, shingle) in best.items():
        if seen:
            chosen.setdefault(n, []).append((shingle, window, offset))
    out = {}
    for n, entries in chosen.items():
        entries.sort()
        shingle, window, offset = (np.array(x) for x in zip(*entries, strict=True))
        used, first = np.unique(shingle, return_index=True)
        hashes = windows.shingles[n][used]
        out[n] = Prefixes(hashes, np.append(first, len(entries)), window, offset, _filter(hashes))
    return out


def _occurrences(words: Words, windows: Windows, prefixes: dict[int, Prefixes]) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every verified occurrence in a block of texts."""
    starts, which = [], []
    for n, prefix in prefixes.items():
        place, hashes = shingle_hashes(words, n)
        at, index = _lookup(hashes, prefix.hashes, prefix.filter)
        count = prefix.first[index + 1] - prefix.first[index]
        entry = np.repeat(prefix.first[index], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(place[at], count)
        window, start = prefix.window[entry], at - prefix.offset[entry]
        owner = words.owner[at]
        fits = (start >= words.first[owner]) & (start + windows.width[window] <= words.first[owner + 1])
        start, window = start[fits], window[fits]
        for k in range(windows.hashes.shape[1]):
            if len(start):
                in_text = words.hash[np.minimum(start + k, len(words.hash) - 1)]
                same = (k >= windows.width[window]) | (in_text == windows.hashes[window, k])
                start, window = start[same], window[same]
        exact = [
            words.data[words.start[s] : words.end[s + windows.width[w] - 1]].tobytes().split() == windows.words[w]
            for s, w in zip(start, window, strict=True)
        ]
        starts.append(start[exact] if len(start) else start)
        which.append(window[exact] if len(start) else window)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(which)


def _scan_block(data: np.ndarray, offsets: np.ndarray, windows: Windows, prefixes: dict) -> list[dict]:
    words = find_words(data, offsets, MEMBER, FOLD)
    n_texts = len(offsets) - 1
    start, window = _occurrences(words, windows, prefixes)
    rows = [{"n_words": int(n), "spans": [], "items": set()} for n in np.diff(words.first)[:n_texts]]
    edge = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + windows.width[window], -1)
    for s, w in zip(start.tolist(), window.tolist(), strict=True):
        rows[words.owner[s]]["items"].update(windows.items[w])
    hit = np.cumsum(edge)[:-1] > 0
    breaks = np.zeros(len(hit) + 1, bool)
    breaks[words.first[:n_texts]] = True
    before, after = np.append(False, hit[:-1]), np.append(hit[1:], False)
    begins = np.flatnonzero(hit & (~before | breaks[:-1]))
    ends = np.flatnonzero(hit & (~after | breaks[1:])) + 1
    for s, e in zip(begins.tolist(), ends.tolist(), strict=True):
        owner = int(words.owner[s])
        rows[owner]["spans"].append({"start": s - int(words.first[owner]), "end": e - int(words.first[owner])})
    for row in rows:
        row["items"] = sorted(row["items"])
    return rows


def _scanner(windows: Broadcast):
    @F.arrow_udf(RESULT)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found, prefixes = windows.value
        kind = pa.struct([
            ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("items", pa.list_(pa.string())),
        ])
        for batch in batches:
            rows: list[dict] = []
            for _, _, data, offsets in blocks(batch):
                rows += _scan_block(data, offsets, found, prefixes)
            yield pa.array(rows, kind)

    return scan


def _item_blocks(benchmark: DataFrame, item: str, text: str, window: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of at most ``BLOCK_WORDS`` words (or one item), one block at a time."""
    rows = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).cast("string").alias("text")
    ).where(F.col("text").isNotNull())
    block, size = [], 0
    for row in rows.toLocalIterator():
        n = row.text.count(" ") + 1
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row.item, row.text))
        size += n
    yield block


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW_WORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word ranges inside occurrences), ``n_hit`` and ``items``.

    ``items``: ids of the benchmark items with an occurring window, as sorted strings.
    Null or empty texts have no words and no hits; items without words have no windows;
    a null item id is named by the empty string; items with one id count once.
    Columns of the result's names are replaced.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    scans = []
    for items in _item_blocks(benchmark, item, item_text, window):
        windows = cut_windows(items, window)
        shingles = spark.sparkContext.broadcast(windows.shingles)
        prefixes = _choose(windows, _document_counts(docs, whole, shingles))
        light = windows._replace(shingles={}, members=[])
        scans.append(_scanner(spark.sparkContext.broadcast((light, prefixes))))
    if len(scans) == 1:
        found = replaced(docs, {"__llm_found": scans[0](whole)})
    else:
        found = _several_rounds(docs, whole, scans)
    spans = F.col("__llm_found.spans")
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return replaced(
        found,
        {"n_words": F.col("__llm_found.n_words"), "hit_spans": spans, "n_hit": n_hit, "items": F.col("__llm_found.items")},
    ).drop("__llm_found")


def _several_rounds(docs: DataFrame, whole: Column, scans: list) -> DataFrame:
    """One scan per block of items; what they find in equal texts is put together."""
    texts = docs.select(F.sha2(whole, 256).alias("__llm_text"), whole.alias("whole"))
    parts = [
        written(texts.select("__llm_text", scan(F.col("whole")).alias("found")).dropDuplicates(["__llm_text"]), "round")
        for scan in scans
    ]
    rounds = parts[0]
    for part in parts[1:]:
        rounds = rounds.unionByName(part)
    merged = rounds.groupBy("__llm_text").agg(
        F.max("found.n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("found.spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("found.items")))).alias("items"),
    )
    # Sorted spans: a span that meets the last one is joined to it.
    joined = F.aggregate(
        "spans", F.slice("spans", 1, 0),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.struct(
                    F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                    F.greatest(F.try_element_at(done, F.lit(-1))["end"], s["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    merged = merged.select("__llm_text", F.struct("n_words", joined.alias("spans"), "items").alias("__llm_found"))
    keyed = replaced(docs, {"__llm_text": F.sha2(whole, 256)}).drop("__llm_found")
    return keyed.join(merged, "__llm_text").drop("__llm_text")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark")
    found = find_contamination(docs, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS_SQL = (
    "list_filter(string_split_regex(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)
OP5_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS_SQL.format("text")}, []) AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, coalesce({_WORDS_SQL.format("text")}, []) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), {WINDOW_WORDS}) AS n,
         array_to_string(w[i:i + {WINDOW_WORDS} - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW_WORDS} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, widths WHERE len(w) >= n)),
found AS (SELECT doc_id, i, p.n, item FROM places p JOIN windows v ON p.win = v.win AND p.n = v.n),
hits AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
