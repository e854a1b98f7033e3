import random

import numpy as np
import pytest

from nightgrid.llm import substring_dedup as dedup


def brute_windows(hashes, low, high, width):
    """All (run start, run end) -> place of the smallest hash, leftmost of equals."""
    return {
        (i, j): i + int(np.argmin(hashes[i : j + 1])) for i in range(low, high) for j in range(i + width - 1, high)
    }


def test_compact_windows_cover_every_run_once():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    hashes[20:30] = hashes[10:20]
    found = {}
    for left, c, right in zip(*dedup.compact_windows(hashes, np.array([0, 40]), np.array([40, 60]), 7), strict=True):
        for i in range(left, c + 1):
            for j in range(max(c, i + 6), right + 1):
                assert (i, j) not in found
                found[i, j] = c
    assert found == brute_windows(hashes, 0, 40, 7) | brute_windows(hashes, 40, 60, 7)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    text = lambda n: [word() for _ in range(n)]
    passage, other = text(70), text(60)
    edited = passage[:30] + ["edit"] + passage[31:]
    inserted = passage[:40] + ["more"] + passage[40:]
    docs = {
        1: text(30) + passage + text(20), 2: text(100) + passage, 3: edited + text(200), 4: text(7) + inserted + text(9),
        5: text(300), 6: passage[:35] + text(100), 7: text(10) + other + text(10), 8: other, 9: text(400) + other + text(5) + passage,
        10: text(20), 11: docs_copy(other),
    }
    rows = [(i, " ".join(w)) for i, w in docs.items()] + [(12, None), (None, " ".join(passage)), (13, "")]
    return spark.createDataFrame(rows, "doc_id long, text string"), docs


def docs_copy(words):
    return [w.upper() for w in words]


def classes(pairs):
    label = {}
    find = lambda x: x if label.setdefault(x, x) == x else find(label[x])
    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {x: find(x) for x in label}


def test_planted_passages(planted):
    df, docs = planted
    found = dedup.repeated_passages(df).collect()
    assert classes((r.doc_id, r.other_doc_id) for r in found) == {k: 1 for k in (1, 2, 3, 4, 7, 8, 9, 11)}
    for r in found:
        one = [w.lower() for w in docs[r.doc_id][r.start_word : r.end_word]]
        two = [w.lower() for w in docs[r.other_doc_id][r.other_start : r.other_end]]
        # A passage is a union of runs of 50 words; the first is similar by itself.
        a, b = ({tuple(w[i : i + 5]) for i in range(46)} for w in (one, two))
        assert len(one) >= 50 and len(two) >= 50 and len(a & b) >= 0.8 * len(a | b)
    # Runs that reach a few words beyond the passage are similar too.
    assert any(
        (r.doc_id, r.other_doc_id) == (2, 1) and 95 <= r.start_word <= 100 and 170 <= r.end_word <= 175
        and r.start_word - r.other_start == 70 for r in found
    )


def test_exact_runs_of_all_documents(spark, sf_dir, texts):
    runs: dict[tuple, set] = {}
    for i, text in texts(sf_dir):
        words = (text or "").lower().split()
        for k in range(len(words) - 49):
            runs.setdefault(tuple(words[k : k + 50]), set()).add(i)
    label = classes((r.doc_id, r.other_doc_id) for r in dedup.op10_substring_dedup(spark, sf_dir).collect())
    for docs in runs.values():
        assert len(docs) == 1 or len({label.get(i, -i) for i in docs}) == 1


def test_versions_in_other_surroundings(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    text = lambda n: [word() for _ in range(n)]
    passage = text(60)
    docs = {}
    for i in range(40):
        edited = list(passage)
        for k in rng.sample(range(60), 2):
            edited[k] = word()
        docs[i] = text(30) + edited + text(30)
    docs[40] = text(20) + passage + text(20)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    found = dedup.repeated_passages(df).collect()
    sets = {
        i: [{tuple(w[k : k + 5]) for k in range(s, s + 46)} for s in range(len(w) - 49)] for i, w in docs.items()
    }
    covered = {
        (i, s) for r in found for i, low, high in ((r.doc_id, r.start_word, r.end_word), (r.other_doc_id, r.other_start, r.other_end))
        for s in range(low, high - 49)
    }
    expected, pairs = set(), set()
    for i in docs:
        for j in range(i):
            # Runs at one shift: the passages have only replaced words.
            for s, x in enumerate(sets[i]):
                for t, y in enumerate(sets[j]):
                    if len(x & y) >= 0.8 * len(x | y) - 1e-9:
                        pairs.add((i, j))
                        if docs[i][s + 10 : s + 12] == docs[j][t + 10 : t + 12] or docs[i][s + 30 : s + 32] == docs[j][t + 30 : t + 32]:
                            expected |= {(i, s), (j, t)}
    # The smallest shingles of a run at exactly 0.8 differ with probability 0.2 ** 5 only.
    assert len(expected - covered) <= 0.01 * len(expected)
    assert classes((r.doc_id, r.other_doc_id) for r in found) == classes(pairs)


def similar_sets(one, two):
    one, two = set(one.tolist()), set(two.tolist())
    return len(one & two) >= 0.8 * len(one | two) - 1e-9


def test_similar_runs_are_those_of_sets():
    rng = np.random.default_rng(5)
    base = rng.integers(1, 1 << 32, 91, dtype=np.uint32)
    rows = []
    for k in range(40):
        row = list(base)
        for _ in range(k % 5):
            at = int(rng.integers(0, 91))
            new = int(rng.integers(1, 1 << 32))
            # Replaced, inserted, removed and repeated shingles; the centre stays where it is.
            kind = int(rng.integers(0, 4))
            if kind == 0:
                row[at] = new
            elif kind == 1:
                row.insert(at, new)
            elif kind == 2:
                del row[at]
            else:
                row[at] = row[int(rng.integers(0, len(row)))]
        rows.append((row + rng.integers(1, 1 << 32, 91).tolist())[:91])
    near = np.array(rows, np.uint32)
    a, b = (x.reshape(-1) for x in np.meshgrid(np.arange(40), np.arange(40)))
    bits = dedup.similar_runs(near, a, b, np.full(len(a), (1 << 46) - 1, np.uint64), dedup._repeats(near))
    sketch, lost = dedup._sketches(near)
    some = 0
    for i, j, found in zip(a.tolist(), b.tolist(), bits.tolist(), strict=True):
        for s in range(46):
            one, two = near[i, s : s + 46], near[j, s : s + 46]
            # Shingles up to SHIFT off are looked at; the edits here move none further.
            assert bool(found >> s & 1) == similar_sets(one, two)
            some += similar_sets(one, two)
        both = len(set(near[i].tolist()) & set(near[j].tolist()))
        if i != j:
            assert both <= np.bitwise_count(sketch[i] & sketch[j]).sum() + min(lost[i], lost[j])
    assert some > 1000


def test_runs_of_one_shift_are_put_together():
    doc, other, shift = np.array([2, 2, 2, 3, 2]), np.array([1, 1, 1, 1, 1]), np.array([5, 5, 5, 5, 6])
    low, high = np.array([40, 0, 200, 60, 30]), np.array([110, 60, 250, 120, 90])
    rows = list(zip(*(c.tolist() for c in dedup.merged_runs(doc, other, shift, low, high)), strict=True))
    assert rows == [(2, 1, 5, 0, 110), (2, 1, 5, 200, 250), (2, 1, 6, 30, 90), (3, 1, 5, 60, 120)]


def test_spanning_links_connect_what_brute_force_finds():
    rng = np.random.default_rng(3)
    base = rng.integers(1, 1 << 32, 91, dtype=np.uint32)
    near = np.where(rng.random((60, 91)) < 0.02, rng.integers(1, 1 << 32, (60, 91), dtype=np.uint32), base)
    near[:, 45] = base[45]
    side = np.full(60, 45)
    links, _ = dedup._spanning(np.zeros(60, np.int64), np.arange(60), near, side, side)
    similar = [
        (i, j) for i in range(60) for j in range(i)
        if any(similar_sets(near[i, s : s + 46], near[j, s : s + 46]) for s in range(46))
    ]
    assert classes(links) == classes(similar)


def test_every_place_within_a_document(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    text = lambda n: [word() for _ in range(n)]
    passage = text(60)
    docs = {
        1: text(20) + passage + text(80) + passage + text(20) + passage, 2: passage + text(9) + passage,
        3: text(5) + passage + passage, 4: text(40) + passage[:52] + text(8) + passage[4:],
    }
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    covered = {
        (i, s) for r in dedup.repeated_passages(df).collect()
        for i, low, high in ((r.doc_id, r.start_word, r.end_word), (r.other_doc_id, r.other_start, r.other_end))
        for s in range(low, high - 49)
    }
    runs = {tuple(passage[k : k + 50]) for k in range(11)}
    expected = {(i, s) for i, w in docs.items() for s in range(len(w) - 49) if tuple(w[s : s + 50]) in runs}
    assert expected <= covered


def test_tiles_link_what_one_group_links(monkeypatch):
    import pyarrow as pa

    rng = random.Random(13)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = [word() for _ in range(60)]
    texts = [" ".join([word() for _ in range(30)] + passage + [word() for _ in range(30)]) for _ in range(40)]
    docs = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(texts)], ["doc", "text"])

    def linked():
        windows = pa.Table.from_batches(dedup._windows([docs])).sort_by("key").combine_chunks().to_batches()
        shared: dict[int, list] = {i: [] for i in range(40)}
        for r in pa.Table.from_batches(dedup._shared(iter(windows))).to_pylist():
            shared[r["known"]].append({"value": r["value"], "n": r["n"]})
        kind = pa.list_(pa.struct([("value", pa.int64()), ("n", pa.int64())]))
        known = pa.RecordBatch.from_arrays([*docs.columns, pa.array(list(shared.values()), kind)], ["doc", "text", "shared"])
        members = pa.Table.from_batches(dedup._members([known])).sort_by([(c, "ascending") for c in ("key", "doc", "at")])
        links = [x for b in dedup._links(iter(members.combine_chunks().to_batches())) for x in b.to_pylist()]
        return members, classes((x["doc"], x["other"]) for x in links)

    whole, one = linked()
    monkeypatch.setattr(dedup, "GROUP_ROWS", 8)
    tiled, two = linked()
    assert one == two == {k: 0 for k in range(40)}
    assert len(tiled) > len(whole)


def test_equal_neighbourhoods_are_linked_without_their_shingles():
    import pyarrow as pa

    rng = random.Random(14)
    copy, other = ([" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(200))] for _ in range(2))
    texts = copy * 12 + other * 3 + ["a few words", ""]
    docs = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc", "text"])
    windows = pa.Table.from_batches(dedup._windows([docs])).sort_by("key").combine_chunks().to_batches()
    # No neighbourhood is sent for comparison, since all places of a shingle have the same one.
    assert sum(map(len, dedup._shared(iter(windows)))) == 0
    links = [x for b in dedup._copies(iter(windows)) for x in b.to_pylist()]
    assert classes((x["doc"], x["other"]) for x in links) == {k: 0 if k < 12 else 12 for k in range(15)}
    assert {(x["shift"], x["low"], x["high"]) for x in links} == {(0, 0, 200)} and len(links) == 13


def test_places_of_a_shingle_are_sent_once_up_to_a_large_number(spark):
    rng = random.Random(15)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = [word() for _ in range(52)]
    import pyarrow as pa

    texts = [" ".join([word() for _ in range(3)] + passage + [word() for _ in range(3)]) for _ in range(3000)]
    docs = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array(texts)], ["doc", "text"])
    windows = pa.Table.from_batches(dedup._windows([docs])).sort_by("key").combine_chunks().to_batches()
    shared = pa.Table.from_batches(dedup._shared(iter(windows))).to_pylist()
    # Beyond 2,048 places, every place went to several tiles before.
    assert shared and {r["n"] for r in shared} == {1}


def test_every_two_versions_are_linked():
    rng = np.random.default_rng(6)
    base = rng.integers(1, 1 << 32, 91, dtype=np.uint32)
    near = np.tile(base, (12, 1))
    for i in range(12):
        near[i, 20 + 2 * i : 22 + 2 * i] = rng.integers(1, 1 << 32, 2, dtype=np.uint32)
    for few in (12, 3):
        links, bits = dedup._spanning(np.zeros(few, np.int64), np.arange(few), near[:few], np.full(few, 45), np.full(few, 45))
        assert {tuple(x) for x in links.tolist()} == {(i, j) for i in range(few) for j in range(i)}
        for (i, j), found in zip(links.tolist(), bits.tolist(), strict=True):
            for s in range(46):
                assert not found >> s & 1 or similar_sets(near[i, s : s + 46], near[j, s : s + 46])


def test_links_of_every_run_against_brute_force():
    rng = np.random.default_rng(7)
    rows, docs = [], []
    base = rng.integers(1, 60, 91, dtype=np.uint32)
    for i in range(40):
        row = base.copy()
        row[rng.integers(0, 91, i % 4)] = rng.integers(1, 60)
        low, high = rng.integers(0, 30), rng.integers(61, 91)
        row[:low], row[high:] = rng.integers(100, 1 << 31, low), rng.integers(100, 1 << 31, 91 - high)
        row[45] = base[45]
        rows.append(row)
        docs.append(i // 2)
    near, docs = np.array(rows, np.uint32), np.array(docs)
    side = np.full(40, 45)
    links, bits = dedup._spanning(np.zeros(40, np.int64), docs, near, side, side)
    some = 0
    for s in range(46):
        found = [x for x, b in zip(links.tolist(), bits.tolist(), strict=True) if b >> s & 1]
        pairs = [
            (i, j) for i in range(40) for j in range(i) if docs[i] != docs[j] and similar_sets(near[i, s : s + 46], near[j, s : s + 46])
        ]
        some += len(pairs)
        assert {tuple(x) for x in found} <= set(pairs)
        # Each similar run is covered, and connected at that very run.
        assert {x for p in found for x in p} == {x for p in pairs for x in p}
        label = classes(found)
        assert all(label[i] == label[j] for i, j in pairs)
    assert some > 1000


def test_copies_in_other_surroundings_are_one_class():
    rng = np.random.default_rng(8)
    near = rng.integers(1, 1 << 32, (50, 91), dtype=np.uint32)
    near[:, 20:75] = near[0, 20:75]
    near[30:, 45 + 3] = near[30, 48]
    side = np.full(50, 45)
    links, bits = dedup._spanning(np.zeros(50, np.int64), np.arange(50), near, side, side)
    # One link for each member of the two classes, and one between them.
    assert len(links) == 49 and classes(links) == {k: 0 for k in range(50)}
    assert all(np.bitwise_count(b) >= 10 for b in bits)


def test_tiles_cover_and_connect_the_runs_of_one_group(monkeypatch):
    import pyarrow as pa

    rng = random.Random(16)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = [word() for _ in range(64)]
    texts = []
    for i in range(60):
        words = list(passage)
        if i % 3 == 0:
            words[rng.randrange(64)] = word()
        # Some documents hold the passage more than once.
        texts.append([word() for _ in range(9)] + words + [word() for _ in range(9)] + (words + [word()] if i % 10 == 0 else []))
    docs = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array([" ".join(x) for x in texts])], ["doc", "text"])

    def linked():
        windows = pa.Table.from_batches(dedup._windows([docs])).sort_by("key").combine_chunks().to_batches()
        shared: dict[int, list] = {i: [] for i in range(60)}
        for r in pa.Table.from_batches(dedup._shared(iter(windows))).to_pylist():
            shared[r["known"]].append({"value": r["value"], "n": r["n"]})
        kind = pa.list_(pa.struct([("value", pa.int64()), ("n", pa.int64())]))
        known = pa.RecordBatch.from_arrays([*docs.columns, pa.array(list(shared.values()), kind)], ["doc", "text", "shared"])
        members = pa.Table.from_batches(dedup._members([known])).sort_by([(c, "ascending") for c in ("key", "doc", "at")])
        links = [x for b in dedup._links(iter(members.combine_chunks().to_batches())) for x in b.to_pylist()]
        runs = {
            (doc, s) for x in links for doc, low, high in
            ((x["doc"], x["low"], x["high"]), (x["other"], x["low"] - x["shift"], x["high"] - x["shift"])) for s in range(low, high - 49)
        }
        for x in links:
            one, two = (texts[x[c]][low : low + 50] for c, low in (("doc", x["low"]), ("other", x["low"] - x["shift"])))
            a, b = ({tuple(w[i : i + 5]) for i in range(46)} for w in (one, two))
            assert x["doc"] != x["other"] and len(a & b) >= 0.8 * len(a | b)
        return len(links), runs, classes((x["doc"], x["other"]) for x in links)

    whole, runs, label = linked()
    monkeypatch.setattr(dedup, "GROUP_ROWS", 8)
    tiled, other_runs, other_label = linked()
    assert runs == other_runs and label == other_label == {k: 0 for k in range(60)}
    # What a chunk links by itself is not linked again in each of its tiles.
    spanning = dedup._spanning
    monkeypatch.setattr(dedup, "_spanning", lambda *columns: spanning(*columns[:5]))
    assert whole < tiled < 0.8 * linked()[0]


def test_halves_are_linked_to_each_other_only():
    rng = np.random.default_rng(9)
    base = rng.integers(1, 1 << 32, 91, dtype=np.uint32)
    near = np.tile(base, (16, 1))
    for i in range(16):
        near[i, 20 + 2 * (i // 2) : 22 + 2 * (i // 2)] = i // 2 + 1
    side, key, half = np.full(16, 45), np.zeros(16, np.int64), np.arange(16) % 2 + 1
    docs = np.arange(16) // 4 * 2 + np.arange(16) % 2
    docs, near, half = (x[np.argsort(docs, kind="stable")] for x in (docs, near, half))
    parts = [np.flatnonzero(half == h) for h in (1, 2)]
    links = [dedup._spanning(key, docs, near, side, side, half)]
    for rows in parts:
        found, bits = dedup._spanning(key[rows], docs[rows], near[rows], side[rows], side[rows])
        links.append((rows[found], bits))
    alone = dedup._spanning(key, docs, near, side, side)
    for s in range(46):
        one, two = (
            [tuple(x) for found, bits in which for x, b in zip(found.tolist(), bits.tolist(), strict=True) if b >> s & 1] for which in (links, [alone])
        )
        assert classes(one) == classes(two)
