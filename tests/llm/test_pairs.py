"""Near duplicates, fuzzy passages and repeated strings against brute force."""

import collections
import hashlib
import itertools
import re

import numpy as np
import pytest

from llm_fixtures import ODD, documents, prose
from tidemark.llm import near_dups, passages, repeats
from tidemark.llm.graph import components


def shingle_counts(text):
    w = text.split()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def classes_of(texts, similarity=0.8):
    sets = {i: shingle_counts(t or "") for i, t in texts.items()}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            holders[shingle].append(i)
    common = collections.Counter(p for ids in holders.values() for p in itertools.combinations(sorted(ids), 2))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        whole = sum((sets[a] | sets[b]).values())
        if n >= similarity * (len(sets[a]) + len(sets[b]) - n) or sum((sets[a] & sets[b]).values()) >= similarity * whole:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: root(i) for i in sets}


def edited(text, every, mark):
    words = text.split(" ")
    return " ".join(f"{mark}{i}" if i % every == every - 1 else w for i, w in enumerate(words))


def test_classes_equal_brute_force(spark, table, texts):
    found = {r["doc_id"]: r["class_id"] for r in near_dups.near_duplicates(table).collect()}
    assert found == classes_of(texts)


def test_chains_of_links_are_found_across_classes(spark, monkeypatch):
    """Copies of copies: the least member is like few of the others, and blocks are split."""
    monkeypatch.setattr(near_dups, "BLOCK", 4)
    rows, text = [], prose(5, 240)
    for i in range(24):
        rows.append((i, text))
        words = text.split(" ")
        for j in range(5):
            words[(i * 41 + j * 7) % len(words)] = f"n{i}x{j}"
        text = " ".join(words)
    rows += [(100 + i, prose(100 + i, 200)) for i in range(10)]
    found = {r["doc_id"]: r["class_id"] for r in near_dups.near_duplicates(documents(spark, rows)).collect()}
    assert found == classes_of(dict(rows))


def test_signatures_estimate_weighted_similarity():
    a = np.repeat(np.arange(1, 101, dtype=np.uint64), 2)  # every shingle twice
    b = np.repeat(np.arange(1, 101, dtype=np.uint64), 1 + (np.arange(100) < 60))
    hits = []
    for units in (a, b):
        first = np.r_[True, units[1:] != units[:-1]]
        occurrence = (~first).astype(np.int64)
        hits.append(near_dups.signatures(np.zeros(len(units), np.int64), near_dups.regions(near_dups.mix(units), occurrence), 1, 2_000)[0])
    assert abs((hits[0] == hits[1]).mean() - 160 / 200) < 0.03


def test_pairs_alike_as_sets_only_are_linked(spark):
    """Texts with a part repeated often and their copies with it once: multiset similarities about 0.5."""
    rows = []
    for i in range(40):
        text = prose(700 + i, 160)
        part = " ".join(text.split()[40:80])
        rows += [(2 * i, text), (2 * i + 1, text + 4 * (" " + part))]
    counts = [shingle_counts(t) for _, t in rows]
    for a, b in zip(counts[::2], counts[1::2]):
        assert len(a.keys() & b.keys()) >= 0.8 * len(a.keys() | b.keys())
        assert sum((a & b).values()) < 0.6 * sum((a | b).values())
    found = {r["doc_id"]: r["class_id"] for r in near_dups.near_duplicates(documents(spark, rows)).collect()}
    assert found == {i: i // 2 * 2 for i in range(80)} == classes_of(dict(rows))


def test_near_duplicates_of_odd_rows(odd, none):
    rows = near_dups.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    by = collections.defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add(r["class_id"])
    assert by[5] == {4} and by[4] == {4} and by[1] == {1} and by[2] == {2} and by[3] == {3} and by[7] == {7} and by[None] == {None}
    assert near_dups.near_duplicates(none).count() == 0
    kept = near_dups.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11]


def test_components_of_paths_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (200, 200)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_passages_of_fifty_words_are_found(table, texts):
    found = {r["doc_id"] for r in passages.fuzzy_passages(table).collect()}
    first, wanted = {}, set()
    for i in sorted(texts):
        w = texts[i].split()
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k : k + 50]), i) != i:
                wanted.add(i)
    assert wanted and wanted <= found


def test_fuzzy_passage_has_its_span(spark):
    shared = prose(9, 120)
    rows = [(1, prose(10, 80) + " " + shared + " " + prose(11, 90)), (2, prose(12, 200) + " " + edited(shared, 30, "z") + " " + prose(13, 40)), (3, prose(14, 300))]
    found = passages.fuzzy_passages(documents(spark, rows)).collect()
    assert [(r["doc_id"], r["source_id"]) for r in found] == [(2, 1)]
    (r,) = found
    assert abs(r["start"] - 200) <= 2 and abs(r["end"] - 320) <= 2 and abs(r["source_start"] - 80) <= 2 and r["identity"] > 0.9
    assert passages.fuzzy_passages(documents(spark, [(1, prose(20, 45)), (2, prose(20, 45))])).count() == 0


def test_chain_is_the_best_by_brute_force():
    draw = np.random.default_rng(1)
    for _ in range(20):
        n = 9
        x = sorted(draw.integers(0, 60, n).tolist())
        y = draw.integers(0, 60, n).tolist()
        best = 0.0
        for size in range(1, n + 1):
            for pick in itertools.combinations(range(n), size):
                if all(x[a] < x[b] and y[a] < y[b] for a, b in zip(pick, pick[1:])):
                    gaps = (x[pick[-1]] - x[pick[0]] + y[pick[-1]] - y[pick[0]]) / 2
                    best = max(best, passages.KMER * size - passages.GAP_COST * gaps)
        chains = passages.chain(x, y)
        first = chains[0]
        gaps = (x[first[-1]] - x[first[0]] + y[first[-1]] - y[first[0]]) / 2
        assert passages.KMER * len(first) - passages.GAP_COST * gaps == pytest.approx(best)
        assert sorted(i for c in chains for i in c) == list(range(n))


def test_passages_of_odd_rows(odd, none):
    assert {r["doc_id"] for r in passages.fuzzy_passages(odd).collect()} <= {7, 9, 11}
    assert passages.fuzzy_passages(none).count() == 0


def brute_cuts(rows, length=400):
    seen = collections.Counter(t[k : k + length] for _, t in rows for k in range(len(t) - length + 1))
    out = []
    for i, raw in rows:
        covered = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                covered[k : k + length] = True
        kept = bytes(b for b, gone in zip(raw, covered) if not gone)
        runs = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        out.append((i, len(raw), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cuts(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.cut_repeats(df).collect()), key=str)


def test_cuts_equal_brute_force(table, texts):
    assert cuts(table) == brute_cuts([(i, t.encode()) for i, t in texts.items()])


def test_cuts_of_shared_parts(spark):
    """Strings of just under and over the length, at text ends, overlapping, inside one text."""
    a, b = prose(30, 400), prose(31, 400)
    rows = [
        (1, a), (2, b[:399] + "|" + a[100:499]), (3, b[:400] + "|" + a[100:500]), (4, a[50:900] + a[60:700]), (5, "ab" * 600),
        (6, "é" * 199 + "x" + b[:401]), (7, b), (8, a[:450] + b[1_000:1_600] + a[450:1_000]), (9, "c" * 400), (10, "c" * 400),
    ]
    assert cuts(documents(spark, rows)) == brute_cuts([(i, t.encode()) for i, t in rows])


def test_cuts_of_odd_rows(odd, none):
    assert cuts(odd) == brute_cuts([(i, (t or "").encode()) for i, t in ODD])
    assert repeats.cut_repeats(none).count() == 0
    kept = repeats.cut_repeats(odd, with_text=True).where("doc_id = 6").first()
    assert bytes(kept["kept"]).decode() == ODD[5][1]


def shared(df):
    return sorted(((r["doc_id"], r["n_shared_words"]) for r in repeats.cut_repeats(df).collect()), key=str)


def brute_shared(rows, length=50):
    split = [re.findall(r"[^ \t-\r]+", t or "") for _, t in rows]
    seen = collections.Counter(w for ws in split for w in {tuple(ws[k : k + length]) for k in range(len(ws) - length + 1)})
    out = []
    for (i, _), ws in zip(rows, split):
        covered = np.zeros(len(ws), bool)
        for k in range(len(ws) - length + 1):
            if seen[tuple(ws[k : k + length])] > 1:
                covered[k : k + length] = True
        out.append((i, int(covered.sum())))
    return sorted(out, key=str)


def test_shared_words_equal_brute_force(table, texts, odd, none):
    assert shared(table) == brute_shared(list(texts.items()))
    assert shared(odd) == brute_shared(ODD)
    assert shared(none) == []


def test_passages_below_the_length_are_told(spark):
    """Passages of 49 to 120 short words of one text in others, alone, in copies, and inside one text only."""
    draw = np.random.default_rng(6)
    new = lambda n: ["".join(draw.choice(list("abcdefghij"), 4)) for _ in range(n)]
    a, rows = new(900), []
    for i, n in enumerate((49, 50, 51, 52, 55, 60, 75, 90, 120)):
        k = int(draw.integers(0, 900 - n))
        rows += [(i, " ".join(new(80) + a[k : k + n] + new(80))), (100 + i, " ".join(a[k + 1 : k + n]) + "\n")]
    own, copied = new(70), " ".join(new(200))
    rows += [(200, " ".join(a)), (201, " ".join(own + new(30) + own)), (202, copied), (203, copied), (204, " \n ".join(copied.split()[20:75] + new(90)))]
    rows += [(205, "x y " * 60), (206, "x y " * 40 + " ".join(new(60))), (None, " ".join(new(90))), (207, " ".join(a[:51])), (207, " ".join(a[:51]))]
    got = shared(documents(spark, rows))
    assert got == brute_shared(rows)
    told = dict(got)
    assert [told[i] for i in (0, 1, 2, 5, 201, 204)] == [0, 50, 51, 60, 0, 55]
    removed = {r["doc_id"]: r["n_removed"] for r in repeats.cut_repeats(documents(spark, rows)).collect()}
    assert removed[5] == 0
