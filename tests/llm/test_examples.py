"""Ranked lexical search, packing and fill-in-the-middle against plain versions."""

import collections
import hashlib
import math
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_fixtures import ODD, documents, prose
from tidemark.llm import fill_in_middle as fim, lexical_search as search, packing


# ---------------------------------------------------------------------------------------- search


def plain_terms(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def plain_ranking(rows, items, k=20):
    """``item -> [(doc_id, score)]`` by scoring every document."""
    docs = [(i, collections.Counter(plain_terms(t))) for i, t in rows if plain_terms(t)]
    n_docs, length = len(docs), sum(c.total() for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    found = {}
    for item, text in items:
        scored = []
        for doc, counts in docs:
            m = 75 + (25 * counts.total() * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * counts[t]) // (1_000 * counts[t] + 12 * m))
                for t in plain_terms(text) if t in counts
            )
            if score > 0:
                scored.append((doc, score))
        scored.sort(key=lambda e: (-e[1], e[0] is None, e[0] or 0))
        found[item] = scored[:k]
    return found


def ranking(frame):
    found = collections.defaultdict(list)
    for row in sorted(frame.collect(), key=lambda r: (r["item_id"], r["rank"])):
        assert row["rank"] == len(found[row["item_id"]]) + 1
        found[row["item_id"]].append((row["doc_id"], row["score"]))
    return found


@pytest.fixture(scope="module")
def skewed_texts():
    """Texts of very different lengths, copies with equal scores, and words that nearly all share."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        n = draw.choice([3, 10, 40, 300])
        rows.append((i, " ".join(draw.choices(words, [1 / (r + 1) for r in range(120)], k=n))))
    return rows + [(1_000 + i, rows[7][1]) for i in range(90)]


@pytest.mark.parametrize("postings, depth, block", [(1 << 21, 64, 1 << 22), (300, 2, 200)])
def test_ranking_equals_scoring_everything(spark, skewed_texts, monkeypatch, postings, depth, block):
    monkeypatch.setattr(search, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(search, "DEPTH", depth)
    items = [(i, skewed_texts[i * 11][1] + " w0 W0 unheard-of") for i in range(12)]
    frame = search.rank_documents(documents(spark, skewed_texts).repartition(3), spark.createDataFrame(items, "item_id int, text string"), block_chars=block)
    assert ranking(frame) == plain_ranking(skewed_texts, items)


def test_best_positions_stop_early_and_lose_nothing():
    draw = np.random.default_rng(3)
    n, terms = 5_000, 6
    held = []
    for start in range(0, n, 1_000):
        rows = [(i, 50, list(range(terms)), draw.integers(1, 6, terms).tolist()) for i in range(start, start + 1_000)]
        ids, lengths, found, tfs = zip(*rows)
        import pyarrow as pa

        held.append(pa.RecordBatch.from_arrays([pa.array(ids), pa.array(lengths), pa.array(found, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], names=list("abcd")))
    weights = np.array([9_000, 20, 20, 20, 10, 10])
    shard = search.Shard(held, weights, n, 50 * n)
    best, times = search.Best(5), np.ones(terms, np.int64)
    scored = shard.search(np.arange(terms), times, best)
    every = shard.scores(np.arange(n), times)
    expected = sorted(((-s, i) for i, s in enumerate(every.tolist())))[:5]
    assert [(-s, i) for s, i in zip(best.scores.tolist(), best.ids.tolist())] == expected and scored < n


def test_ties_at_the_bar_are_kept():
    best = search.Best(2)
    for ids in ([9, 8], [7], [3]):
        best.add(np.full(len(ids), 5), np.zeros(len(ids), bool), np.array(ids))
    assert best.ids.tolist() == [3, 7] and best.bar == 5


def test_search_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [(1, "The x"), (1, "The x"), (2, None), (3, ""), (4, "日本語 ТЕКСТ é ÉÉ"), (None, "id"), (5, "nowhere")], "item_id bigint, text string"
    ).withColumn("score", F.lit(1.0))
    rows = [(i, t) for i, t in ODD]
    found = collections.defaultdict(list)
    for row in search.rank_documents(odd, items).collect():
        found[row["item_id"]].append((row["rank"], row["doc_id"], row["score"]))
    expected = plain_ranking(rows, [(1, "The x"), (4, "日本語 ТЕКСТ é ÉÉ"), (None, "id")])
    assert {k: [e[1:] for e in sorted(v)] for k, v in found.items()} == {k: v for k, v in expected.items() if v}
    assert search.rank_documents(none, items).count() == 0
    assert search.rank_documents(odd, items.limit(0)).count() == 0


def test_long_texts_are_read_whole(monkeypatch):
    text = prose(3, 4_000).encode()
    whole = search.term_counts(text)
    monkeypatch.setattr(search, "RUN_BYTES", 100)
    assert search.term_counts(text) == whole == collections.Counter(t.encode() for t in plain_terms(text.decode()))


# --------------------------------------------------------------------------------------- packing


@pytest.fixture(scope="module")
def word_tokenizer():
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    tokenizer.encode_special_tokens = True
    return tokenizer


def check_pieces(rows, expected, size=packing.SEQUENCE_TOKENS):
    """Pieces give back the documents' ids; sequences are gapless, within size and never padded."""
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        ids = list(struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"]))
        assert len(ids) == r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == size or end < size and end & (end - 1) == 0
    for doc, ids in expected.items():
        parts = sorted(pieces[doc])
        assert [x for _, part, _ in parts for x in part] == ids and all(t == len(ids) for *_, t in parts)
        assert all(start == sum(len(p) for _, p, _ in parts[:i]) for i, (start, _, _) in enumerate(parts))
    assert set(pieces) == set(expected)
    return sequences


def test_pieces_of_the_table(table, texts, word_tokenizer):
    rows = packing.pack(table, bucket_tokens=30_000).collect()
    expected = {i: word_tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    check_pieces(rows, expected)


def test_parts_equal_the_tokenizer(word_tokenizer, monkeypatch):
    text = "Å H̱ x́y Ünï's DON'T I'LL a'S 12½ ﬀ z\x85w\x1cv \x00 \x7f' 's İstanbul ΣΑΣ <|endoftext|> </w> 日本語 é̀ " + prose(4, 500)
    ids = packing.WordIds(public_tokenizers.path(packing.VOCABULARY))
    expected = np.array(word_tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert ids.encode(text.encode()) == expected
    monkeypatch.setattr(packing, "RUN_BYTES", 10)
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    ids = packing.WordIds(public_tokenizers.path(packing.VOCABULARY))
    assert ids.encode(text.encode()) == expected and len(ids) < 100


@settings(max_examples=60, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aA'sStTl 1.̱́\x1c")), max_size=40))
def test_any_text_equals_the_tokenizer(text):
    path = public_tokenizers.path(packing.VOCABULARY)
    ids = packing._word_ids(path)
    expected = np.array(ids.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert ids.encode(text.encode()) == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=40))
def test_assignment_fills_every_sequence(lengths):
    placed = packing.assign(lengths, 16)
    room = packing.capacities(sum(lengths), 16)
    assert sum(room) == sum(lengths)
    used = collections.Counter()
    for doc, start, length, to, offset in placed:
        assert used[to] == offset
        used[to] += length
    assert [used[i] for i in range(len(room))] == room.tolist()
    for doc, n in enumerate(lengths):
        parts = sorted((s, l) for d, s, l, *_ in placed if d == doc)
        assert sum(l for _, l in parts) == n and all(s == sum(l for _, l in parts[:i]) for i, (s, _) in enumerate(parts))


def test_costs_are_balanced():
    """Sequences cost more alike than when filled in the order of arrival."""
    draw = random.Random(2)
    lengths = [draw.choice([40, 90, 200, 900, 1_500]) for _ in range(2_000)]
    size = packing.SEQUENCE_TOKENS

    def spread(pieces):
        cost = collections.Counter()
        for _, _, n, to, _ in pieces:
            cost[to] += packing.LINEAR * n + packing.QUADRATIC * n * n
        return np.std([cost[i] for i in range(sum(lengths) // size)])

    arrival, at = [], 0
    for doc, n in enumerate(lengths):
        start = 0
        while start < n:
            part = min(n - start, size - at % size)
            arrival.append((doc, start, part, at // size, at % size))
            start, at = start + part, at + part
    assert spread(packing.assign(lengths)) < spread(arrival)


def test_packing_of_odd_rows(odd, none, word_tokenizer):
    rows = packing.pack(odd.coalesce(1), bucket_tokens=1).collect()
    assert packing.pack(none).count() == 0
    totals = collections.Counter()
    for r in rows:
        totals[r["doc_id"]] += r["length"]
    expected = collections.Counter()
    for i, t in ODD:
        expected[i] += len(word_tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    assert totals == expected
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)


# ------------------------------------------------------------------------------- fill in the middle

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_example(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = "".join(units[:one]), "".join(units[one:two]), "".join(units[two:])
    if h4 % 100 < 80:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


MARKED = [(i, t) for i in range(200, 260) for t in ("a <P> b", "<S", "<M><", "P>S> <P", "é" * 700 + " 😀\t\n", " \n ", "x" * 256 + " y", ("z " * 128 + "\n") * 3)]


def test_examples_equal_plain_ones(spark, odd):
    rows = MARKED + [(i, prose(i, 10 + 37 * i)) for i in range(60)]
    made = fim.fill_in_middle(documents(spark, rows)).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    found = sorted((r["doc_id"], r["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in made.collect())
    expected = sorted((i, t, *plain_example(i, t), t) for i, t in rows)
    assert repr(found) == repr(expected) and {f[3] for f in found} == {"plain", "psm", "spm"}


def test_examples_of_odd_rows(odd, none):
    rows = fim.fill_in_middle(odd.withColumn("draw", F.lit(1)).withColumn("N", F.lit(2))).collect()
    key = lambda e: repr(e)
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows), key=key) == sorted(
        ((i, *plain_example(i, t)) for i, t in ODD), key=key
    )
    assert {r["draw"] for r in rows} == {1} and "kept" in rows[0].asDict()
    assert fim.fill_in_middle(none).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab \né😀", max_size=60), max_size=6), st.integers(1, 9), st.randoms())
def test_cuts_equal_a_plain_search(texts, block, draw):
    raws = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raws), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)
    before, fim.BLOCK_BYTES = fim.BLOCK_BYTES, block
    try:
        trees = fim.BlockTrees(data, offsets)
        units = [UNITS.findall(t) for t in texts]
        assert trees.totals().tolist() == [len(u) for u in units]
        after = np.array([draw.randint(0, len(u)) for u in units], np.int64)
        cuts, chars = trees.cut(after)
    finally:
        fim.BLOCK_BYTES = before
    heads = ["".join(u[:k]) for u, k in zip(units, after)]
    assert cuts.tolist() == [len(h.encode()) for h in heads] and chars.tolist() == [len(h) for h in heads]
