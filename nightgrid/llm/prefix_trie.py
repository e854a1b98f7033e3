"""A trie of conversation prefixes, by collapsing whole sequences.

1. Turns are numbered within their conversation and each conversation is rebuilt.
2. A sequence of turns is known by its length and 128 bits of folded hashes of (place, turn).
   Identical conversations become one weighted sequence with the list of its members, which is
   held in segments, so that no task holds all members of a common sequence.
3. Sequences that are proper prefixes of others are dropped by an anti-join; leaves are left.
4. The prefixes of the distinct sequences, weighted, are added up per node.

Sums over a subtree need no walk.  Every node has one owner, the leaf with the smallest
conversation below it.  The nodes that a leaf owns are the lower end of its path, so a
node's sum is the whole of all leaves below it, less what its owner owns above it.

No conversation has to fit a task: numbering, folding and suffix sums run over ranges
(``running_folds``).

Cases: turns with a null conv_id belong to no conversation and are left out.  Turns are ordered by (turn, null
first; role; text), so ties have one order; equal rows are turns of their own.  Null role or text is empty.
``c % 20`` has the sign of c.  No conversation, no node; else the root is there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightgrid.llm.common import table, written
from nightgrid.operators.heavy import join_by_weight
from nightgrid.operators.running import running_folds

#: Conversation ids in one segment of a list of members.
SEGMENT_IDS = 1 << 14

#: What tells a sequence, or a node of the trie, from others.
NODE = ["depth", "low", "high"]
_WORDS = r"[^\x20\x09-\x0D]+"


class Trie(NamedTuple):
    nodes: DataFrame  #: one row per node
    sequences: DataFrame  #: distinct sequences: rep, depth (turns), weight, ends_sha256, is_leaf
    members: DataFrame  #: segments of the members of each sequence: depth, low, high, first, n, ids (decimal, comma-joined)


def _turn_hashes(place: str) -> dict[str, tuple[Column, str]]:
    """Two independent 64-bit hashes of a turn at its place; XOR over a prefix keeps the order."""
    at = F.col(place)
    return {
        "low": (F.xxhash64(at, "role", "text"), "xor"),
        "high": (F.xxhash64(F.lit("other"), "text", "role", at), "xor"),
    }


def number_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): turns in order from 1, blanks for nulls."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    placed = running_folds(turns, ["conv_id"], ["turn", "role", "text"], {"place": (F.lit(1), "sum")}, "numbered-turns")
    return placed.select("conv_id", "place", "role", "text")


def rebuilt_conversations(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Every conversation with the first h turns of its family's first one before its own later turns.

    h is the unsigned crc32 of the decimal conv_id modulo ``most``.  Takes and gives (conv_id, place,
    role, text); conversations that end up without a turn have one row with place 0.
    """
    taken = F.crc32(F.col("conv_id").cast("string")) % most
    base = F.col("conv_id") - F.col("conv_id") % family
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size"))
    # Per conversation the base turns that come first: fewer than `most`, of at most 2 * family conversations each.
    asked = sizes.select("conv_id", "size", taken.alias("h"), base.alias("__llm_base"))
    opening = turns.where(F.col("place") < most).select(
        F.col("conv_id").alias("__llm_base"), F.col("place").alias("__llm_place"), "role", "text"
    )
    matched = (F.col("__llm_base") == F.col("__llm_of")) & (F.col("__llm_place") <= F.col("h"))
    first = asked.join(opening.withColumnRenamed("__llm_base", "__llm_of"), matched)
    heads = first.select("conv_id", F.col("__llm_place").alias("place"), "role", "text")
    base_sizes = sizes.select(F.col("conv_id").alias("__llm_base"), F.col("size").alias("__llm_size"))
    shifts = asked.join(base_sizes, "__llm_base", "left").select(
        "conv_id", "h", F.least("h", F.coalesce("__llm_size", F.lit(0))).alias("__llm_head"), "size"
    )
    own = join_by_weight(turns, written(shifts, "shifts"), ["conv_id"], "size")
    tails = own.where(F.col("place") > F.col("h")).select(
        "conv_id", (F.col("place") - F.col("h") + F.col("__llm_head")).alias("place"), "role", "text"
    )
    whole = written(heads.unionByName(tails), "rebuilt-turns")
    silent = sizes.join(whole.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("place"), F.lit("").alias("role"), F.lit("").alias("text")
    )
    return whole.unionByName(silent)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted members of a sequence as one row: smallest id, how many, ids on end."""
    held: list[tuple] = []
    ids: list[str] = []
    key = first = None

    def close() -> None:
        if ids:
            held.append((*key, first, len(ids), ",".join(ids)))
            ids.clear()

    for batch in batches:
        for *new, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if new != key or len(ids) >= SEGMENT_IDS:
                close()
                key, first = new, conv
            ids.append(str(conv))
        if len(held) >= 4096:
            yield _table(held, [*NODE, "first", "n", "ids"])
            held.clear()
    close()
    if held:
        yield _table(held, [*NODE, "first", "n", "ids"])


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    text = {"ids", "ends_sha256"}
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.string() if n in text else pa.int64()) for c, n in zip(columns, names, strict=True)], names=names
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence from its segments in order: smallest member, weight, SHA-256 of all ids."""
    key, digest, rep, weight, done = None, None, None, 0, []
    names = [*NODE, "rep", "weight", "ends_sha256"]
    for batch in batches:
        for *new, first, n, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "first", "n", "ids")), strict=True):
            if new != key:
                if key is not None:
                    done.append((*key, rep, weight, digest.hexdigest()))
                key, digest, rep, weight = new, hashlib.sha256(ids.encode()), first, n
            else:
                digest.update(b"," + ids.encode())
                weight += n
        if len(done) >= 4096:
            yield _table(done, names)
            done.clear()
    if key is not None:
        done.append((*key, rep, weight, digest.hexdigest()))
    if done:
        yield _table(done, names)


def collapse(rebuilt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(distinct sequences, segments of their members) of rebuilt conversations."""
    hashes = _turn_hashes("place")
    there = F.col("place") > 0
    whole = rebuilt.groupBy("conv_id").agg(
        F.count_if(there).alias("depth"),
        *[F.coalesce(F.bit_xor(F.when(there, h)), F.lit(0).cast("long")).alias(n) for n, (h, _) in hashes.items()],
    )
    ranged = whole.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    members = written(
        ranged.mapInArrow(_segments, "depth bigint, low bigint, high bigint, first bigint, n bigint, ids string"), "sequence-members"
    )
    # A sequence's segments meet in one task, which streams them: a row for each SEGMENT_IDS members.
    ordered = members.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    sequences = ordered.mapInArrow(_digests, "depth bigint, low bigint, high bigint, rep bigint, weight bigint, ends_sha256 string")
    return written(sequences, "sequences"), members


def prefix_trie(conversations: DataFrame, family: int = 20, most: int = 4) -> Trie:
    """The trie of all rebuilt conversations."""
    rebuilt = written(rebuilt_conversations(number_turns(conversations), family, most), "rebuilt")
    sequences, members = collapse(rebuilt)

    # Prefixes of one conversation of each distinct sequence, and of each the empty one.
    mine = sequences.select(F.col("rep").alias("conv_id"), "weight", F.col("depth").alias("size"))
    turns = rebuilt.where(F.col("place") > 0)
    words = F.when(F.col("text") == "", 0).otherwise(F.regexp_count("text", F.lit(_WORDS)))
    own = turns.withColumn("words", words.cast("long")).join(mine.select("conv_id"), "conv_id", "left_semi")
    folded = running_folds(own.select("conv_id", "place", "role", "text", "words"), ["conv_id"], ["place"], _turn_hashes("place"), "prefixes")
    # Without this turn the fold is the parent's.
    turn_of = {n: h for n, (h, _) in _turn_hashes("place").items()}
    steps = folded.select(
        F.col("conv_id").alias("rep"), F.col("place").alias("depth"), "words", "low", "high",
        F.col("low").bitwiseXOR(turn_of["low"]).alias("up_low"), F.col("high").bitwiseXOR(turn_of["high"]).alias("up_high"),
    )
    roots = sequences.select("rep", *[F.lit(0).cast("long").alias(c) for c in ("depth", "words", "low", "high", "up_low", "up_high")])
    paths = written(steps.unionByName(roots), "paths")

    # What a turn follows is a proper prefix; sequences that are none are leaves.
    proper = paths.where(F.col("depth") > 0).select(
        (F.col("depth") - 1).alias("depth"), F.col("up_low").alias("low"), F.col("up_high").alias("high")
    ).distinct()
    leaves = sequences.join(proper, NODE, "left_anti").select("rep", F.lit(True).alias("is_leaf"))
    sequences = written(
        sequences.join(leaves, "rep", "left").withColumn("is_leaf", F.coalesce("is_leaf", F.lit(False))), "marked-sequences"
    )
    # `depth` turns and the root make a sequence's share of the paths.
    marks = sequences.select("rep", "weight", "is_leaf", (F.col("depth") + 1).alias("__llm_rows"))
    paths = written(join_by_weight(paths, marks, ["rep"], "__llm_rows"), "weighted-paths")
    leaf = F.when(F.col("is_leaf"), F.col("rep"))
    nodes = written(
        paths.groupBy(*NODE).agg(
            F.min("rep").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("words").alias("words"),
            F.count(leaf).alias("n_leaves"), F.min(leaf).alias("owner"),
            F.max("up_low").alias("up_low"), F.max("up_high").alias("up_high"),
        ).withColumn("own", (F.col("n_convs") - 1) * F.col("words")),
        "trie-nodes",
    )
    saved = _subtree_sums(nodes, paths.where("is_leaf"))
    return Trie(_with_parents(nodes, saved, sequences), sequences, members)


def _subtree_sums(nodes: DataFrame, leaf_paths: DataFrame) -> DataFrame:
    """(node, saved_tokens): the sum of ``own`` over each node's subtree."""
    suffix = running_folds(
        nodes.select(*NODE, "owner", "own"), ["owner"], [F.desc("depth")], {"below": (F.col("own"), "sum")}, "suffix-sums"
    )
    wholes = nodes.groupBy("owner").agg(F.sum("own").alias("whole"))
    lengths = leaf_paths.groupBy("rep").agg(F.count("*").alias("__llm_rows"))
    per_leaf = written(lengths.join(wholes.withColumnRenamed("owner", "rep"), "rep"), "leaf-sums")
    spread = join_by_weight(leaf_paths.select("rep", *NODE), per_leaf, ["rep"], "__llm_rows")
    totals = spread.groupBy(*NODE).agg(F.sum("whole").alias("all_leaves"))
    by_owner = per_leaf.select(F.col("rep").alias("owner"), "whole", "__llm_rows")
    own = join_by_weight(written(suffix, "owned"), by_owner, ["owner"], "__llm_rows")
    return own.join(totals, NODE).select(
        *NODE, (F.col("all_leaves") - F.col("whole") + F.col("below")).alias("saved_tokens")
    )


def _with_parents(nodes: DataFrame, saved: DataFrame, sequences: DataFrame) -> DataFrame:
    up = ["depth", "up_low", "up_high"]
    children = (
        nodes.where(F.col("depth") > 0)
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("up_low").alias("low"), F.col("up_high").alias("high"))
        .agg(F.count("*").alias("n_children"))
    )
    ends = sequences.select(*NODE, "ends_sha256")
    full = written(
        nodes.join(children, NODE, "left").join(ends, NODE, "left").join(saved, NODE).select(
            *nodes.columns, F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        ),
        "full-nodes",
    )
    parents = full.where(F.col("n_children") > 0).select(
        (F.col("depth") + 1).alias("depth"), F.col("low").alias("up_low"), F.col("high").alias("up_high"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("__llm_rows"),
    )
    linked = join_by_weight(full, parents, up, "__llm_rows", how="left")
    return linked.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations``: every node of the trie of rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")).nodes
