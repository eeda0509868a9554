"""Language, quality rules, token counts, decontamination, classifier, byte-level BPE and personal data."""

import collections
import hashlib
import re
import struct

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from llm_fixtures import ODD, documents, prose
from tidemark.llm import byte_bpe, decontaminate, language_id, pii, quality_classifier, quality_rules, token_counts
from tidemark.llm.text import lowest_hashes


# ------------------------------------------------------------------------------------ language


def test_languages_of_held_out_texts(table):
    rows = language_id.op2_language_id(table.sparkSession, "/root/testdata/sf0.01").join(
        table.sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98 and all(0 <= r["score"] <= 1 for r in rows)


def test_phrases_equal_a_plain_parse():
    sample = {"a": [prose(1, 200)], "b": [prose(2, 200).replace("e", "ö")]}
    model = language_id.Model(sample, 700)
    learned = {k: "".join(map(chr, language_id.normal_codes(v[0] + " ")[:700])) for k, v in sample.items()}
    text = "ÿ " + prose(3, 300) + " öö ÿ " + prose(4, 60)
    codes = language_id.normal_codes(text)
    plain = "".join(map(chr, codes))
    alphabet = set("".join(learned.values()))
    expected = []
    for lang in model.languages:
        n = 0
        for start in range(0, len(plain), language_id.SEGMENT):
            part, at = plain[start : start + language_id.SEGMENT], 0
            while at < len(part):
                end = at + 1
                while end < len(part) and part[at : end + 1] in learned[lang]:
                    end += 1
                n, at = n + 1, end
        expected.append(n)
    assert alphabet and model.phrases(model.code[codes], np.array([0, len(codes)])).tolist() == [expected]


def scripted(seed, n, shift):
    """Prose in letters of a script of its own."""
    return "".join(chr(ord(c) + shift) if c.isalpha() else c for c in prose(seed, n))


def test_rare_scripts_long_texts_and_copies_are_learned(spark):
    shifts = {"aa": 0, "bb": 0x3B1 - 97, "cc": 0x430 - 97, "dd": 0x561 - 97, "ee": 0x10D0 - 97, "ff": 0x4E00}
    rows = [(n, scripted(n + 1_000 * k, 60, shift), lang, "s", 0) for k, (lang, shift) in enumerate(shifts.items())
            for n in range(40 if lang in ("aa", "bb", "cc", "dd") else 3)]
    # Few long texts, and one text copied many times beside a few others.
    rows += [(n, scripted(n + 7_000, 3_000, 0x5D0 - 97), "gg", "s", 0) for n in range(3)]
    rows += [(n, scripted(8_000 + max(0, n - 296), 60, 0x904 - 97), "hh", "s", 0) for n in range(300)]
    shifts |= {"gg": 0x5D0 - 97, "hh": 0x904 - 97}
    docs = documents(spark, rows)
    model = language_id.fit(docs, 2_000)
    assert model.languages == sorted(shifts)
    fresh = documents(spark, [(n, scripted(n + 9_000, 40, shift), lang, "s", 0) for lang, shift in shifts.items() for n in range(20)])
    assert language_id.identify(fresh, model).where("lang <> lang_pred").count() == 0
    assert len(model.cells) < 3 * np.count_nonzero(model.cells) + 4 * model.size


def test_hash_samples_hold_the_lowest_distinct_texts(spark):
    rows = [(n, f"text {n % 900}", "xy"[n % 3 == 0], "s", 0) for n in range(1_800)]
    docs = documents(spark, rows)
    for by, size, enough in (("lang", F.lit(1), 50), ("lang", F.length("text"), 10_000_000)):
        hashed = docs.selectExpr("text", "lang", "shiftrightunsigned(xxhash64(text), 2) AS draw").distinct().collect()
        for group in "xy":
            got = {r["draw"] for r in lowest_hashes(docs, by, size, enough).where(F.col("lang") == group).collect()}
            all_of = sorted(r["draw"] for r in hashed if r["lang"] == group)
            assert got == set(all_of[: len(got)]) and (50 <= len(got) < 90 if enough == 50 else len(got) == len(all_of))


def test_languages_of_odd_rows(odd, none):
    rows = language_id.identify(odd, language_id.fit(odd)).collect()
    assert len(rows) == len(ODD) and {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (4, 7, 9)} == {"en"}
    assert [r["score"] for r in rows if r["doc_id"] == 2] == [0.0]
    nothing = language_id.fit(none)
    assert language_id.identify(none, nothing).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(odd, nothing).collect()} == {"und"}


# --------------------------------------------------------------------------------------- rules


def rule_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + d for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_base_counts_of_odd_rows(odd, none):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = [tuple(r[c] for c in columns) for r in quality_rules.base_measures(odd).select(*columns).collect()]
    assert sorted(found) == sorted(rule_counts(t) for _, t in ODD)
    assert quality_rules.quality_rules(none).count() == 0
    assert not any(r["kept"] for r in quality_rules.quality_rules(odd).collect() if r["doc_id"] in (1, 2, 3, 9))


def test_long_texts_take_the_wide_way(odd, monkeypatch):
    monkeypatch.setattr(quality_rules, "PLACE_BITS", 6)
    found = [r["n_repeat_words"] for r in quality_rules.base_measures(odd).select("n_repeat_words").collect()]
    assert sorted(found) == sorted(rule_counts(t)[4] for _, t in ODD)


def test_order_of_rules_never_changes_the_verdict(table):
    names = list(quality_rules.RULES)
    one, two = (quality_rules.quality_rules(table, order=o).select("doc_id", "kept") for o in (names, names[::-1]))
    assert one.exceptAll(two).count() == 0


# --------------------------------------------------------------------------------- tokens, BPE


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_counts_across_blocks(odd, none, table, texts, reference):
    for block in (7, 1 << 16):
        found = {r["doc_id"]: r["n_tokens"] for r in token_counts.document_tokens(table.limit(40), block_tokens=block).collect()}
        assert found == {i: len(reference.encode_ordinary(texts[i])) for i in found} and len(found) == 40
    found = [(r["doc_id"], r["n_tokens"]) for r in token_counts.document_tokens(odd, block_tokens=5).collect()]
    assert sorted(found, key=str) == sorted(((i, len(reference.encode_ordinary(t or ""))) for i, t in ODD), key=str)
    assert token_counts.document_tokens(none).count() == 0


def test_scan_of_a_stream_that_stops_early(spark):
    rows = [(0, 0, [1, 2, 9]), (0, 1, [9, 3, 3]), (0, 2, [3]), (0, 3, [3, 9, 9]), (0, 4, [4, 4]), (1, 0, [9])]
    blocks = spark.createDataFrame([(s, p, bytearray(np.array(t, "<u2").tobytes())) for s, p, t in rows], "stream int, place bigint, tokens binary")
    found = sorted(tuple(r) for r in token_counts.count_tokens(blocks, 9).collect())
    assert found == [(0, 0, 2), (0, 1, 0), (0, 2, 4), (0, 3, 0), (1, 0, 0)]


def test_ids_equal_the_library(table, texts, reference):
    found = byte_bpe.decode(byte_bpe.encode(table)).collect()
    for r in found:
        text = texts[r["doc_id"]]
        assert struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"]) == tuple(reference.encode_ordinary(text)) and bytes(r["bytes"]).decode() == text


def test_ids_of_odd_rows(odd, none, reference):
    rows = byte_bpe.round_trip(odd).collect()
    wanted = collections.Counter((i, struct.pack(f"<{len(e)}I", *e), (t or "").encode()) for i, t in ODD for e in [reference.encode_ordinary(t or "")])
    assert collections.Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in rows) == wanted
    assert byte_bpe.round_trip(none).count() == 0


def test_long_words_take_several_rounds(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "ROUND", 20)
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.VOCABULARY))
    texts = ["abracadabra" * 60, "\0\0 x\0", "ααβγ" * 80, " \n\n  \t", "don't we'll 1234567", "<|endoftext|>"]
    packed = own.encode(texts)
    assert [list(struct.unpack(f"<{len(p) // 4}I", p)) for p in packed] == [reference.encode_ordinary(t) for t in texts]
    assert own.decode(packed) == [t.encode() for t in texts] and own.decode([]) == [] and own.decode([b""]) == [b""]
    with pytest.raises((IndexError, ValueError)):
        own.decode([struct.pack("<I", 60_000)])


def test_words_longer_than_a_query_takes(reference):
    draw = np.random.default_rng(8)
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.VOCABULARY))
    letters = np.frombuffer(b"etaoinshrdlucmfwypvbgk", np.uint8)
    texts = ["x " + letters[draw.integers(0, len(letters), n)].tobytes().decode() + " y" for n in (11_000, 12_000, (1 << 20) + 500)]
    texts += ["a" * 12_001, "-" * ((1 << 20) + 7), "αβγб" * 4_000]
    packed = own.encode(texts)
    for text, p in zip(texts, packed):
        assert np.array_equal(np.frombuffer(p, "<u4"), reference.encode_ordinary(text))
    assert own.decode(packed) == [t.encode() for t in texts]


def test_both_ways_of_contracting_agree(texts):
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.VOCABULARY))
    words = {w for t in list(texts.values())[:20] for w in own.pattern.findall(t)}
    own._learn(words)
    assert {w: own._contract_long(w.encode()) for w in words} == {w: own.known[w] for w in words}


# -------------------------------------------------------------------------------- decontaminate


def test_planted_items_are_found(spark, table, texts, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(table, items).collect()}
    planted = {(i, r["item_id"]) for i, t in texts.items() for r in items.collect() if r["text"] in t}
    assert planted and planted <= found and len(found - planted) <= 1


@pytest.mark.parametrize("length", [150, 400, 1_000, 3_000])
def test_long_items_are_found_whole(spark, length):
    item = prose(60, length).replace(".", ",").replace("\n", " ") + ". " + prose(61, 8)
    items = spark.createDataFrame([(1, item), (2, prose(62, 40))], "item_id bigint, text string")
    half = " ".join(item.split()[: length // 3])  # less than half the question and no answer
    rows = [(1, prose(63, 700) + " " + item + " " + prose(64, 300)), (2, item), (3, prose(65, 900) + " " + half + " " + prose(66, 100))]
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_leaks(documents(spark, rows), items).collect()}
    assert set(found) == {(1, 1), (2, 1)} and all(r["question_overlap"] > 0.99 and r["answer_overlap"] == 1.0 for r in found.values())


def test_search_returns_all_items_above_the_threshold():
    draw = np.random.default_rng(3)
    items = [(i, prose(i, int(draw.integers(5, 90)))) for i in range(60)]
    hashes = [decontaminate.word_hashes(t) for _, t in items]
    df = collections.Counter(int(h) for hs in hashes for h in np.unique(hs).view(np.int64))
    index = decontaminate.Index(items, df, len(items), float(np.mean([len(h) for h in hashes])))
    for case in range(80):
        terms = sorted(draw.choice(len(index.terms), 40, replace=False).tolist())
        scores = collections.Counter()
        for t in terms:
            for item, w in zip(*index.lists[t]):
                scores[item] += w
        for threshold in (0.02, 0.1, 0.3):
            assert {i for i, _ in index.search(terms, threshold)} == {i for i, s in scores.items() if s >= threshold - 1e-9}


def test_ranges_rule_out_no_window():
    items = [(i, prose(i, 40)) for i in range(30)]
    df = collections.Counter(int(h) for _, t in items for h in np.unique(decontaminate.word_hashes(t)).view(np.int64))
    index = decontaminate.Index(items, df, 30, 40.0)
    text = (prose(500, 300) + " " + items[7][1] + " " + prose(501, 100)).encode()
    (found,) = decontaminate.leaks_of(index, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert set(found) == {7} and found[7][1:] == (1.0, 1.0)


def test_leaks_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, ODD[13][1][:400]), (None, "the the"), (3, ODD[13][1][:400])], "item_id bigint, text string")
    rows = decontaminate.annotate(odd, items).collect()
    assert len(rows) == len(ODD) and [len(r["leaks"]) for r in rows if r["doc_id"] == 11] == [2]
    assert [len(r["leaks"]) for r in rows if r["doc_id"] == 1] == [0]
    assert decontaminate.find_leaks(none, items).count() == 0 and decontaminate.find_leaks(odd, items.limit(0)).count() == 0


def test_items_in_several_indexes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_WORDS", 60)
    items = spark.createDataFrame([(i, prose(i, 30)) for i in range(8)], "item_id bigint, text string")
    docs = documents(spark, [(i, prose(90 + i, 50) + " " + prose(i, 30)) for i in range(8)])
    rows = decontaminate.annotate(docs, items).collect()
    assert len(decontaminate.build_indexes(items)) > 1 and all([x["item_id"] for x in r["leaks"]] == [r["doc_id"]] for r in rows)


# -------------------------------------------------------------------------- classifier


def test_scores_follow_the_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit(docs, labels)
    rows = quality_classifier.classify(docs.where("doc_id % 7 = 3"), model).join(labels, "doc_id").collect()
    assert np.mean([(r["score"] >= 0.5) == (r["quality"] == 1) for r in rows]) > 0.97
    assert np.mean([(r["toxic_score"] >= 0.5) == (r["toxic"] == 1) for r in rows]) > 0.97


def test_classes_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 1), (7, 1, 0), (9, None, 7), (None, 1, 1), (77, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = quality_classifier.classify(odd, quality_classifier.fit(odd, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 and 0 <= r["toxic_score"] <= 1 for r in rows)
    empty = quality_classifier.fit(none, labels.limit(0))
    assert quality_classifier.classify(none, empty).count() == 0 and quality_classifier.classify(odd, empty).count() == len(ODD)


# ----------------------------------------------------------------------------- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns(texts):
    odd = ["a@b@c.d@e.f", "..@x.y 1.2.3.4.5.6.7.8 300.1.1.1.2 001.02.3.4", "+1 (2) 3-4.5678 9 +12", "@.@a.b x@y x@y.z.", "4111 1111-1111 1111 1", "é@b.co 😀 1.1.1.1@q.w"]
    draw = np.random.default_rng(0)
    odd += ["".join(draw.choice(list("ab1.@+- (9\n"), 60)) for _ in range(300)]
    for text in [*odd, *texts.values()]:
        assert pii.base_spans(text) == plain_spans(text)


def test_gradients_equal_differences():
    draw = np.random.default_rng(0)
    net = pii.new_network()
    codes, tags = draw.integers(97, 105, (10, 5)), draw.integers(0, 5, (10, 5))
    _, gradients = pii.loss_and_gradients(net, codes, tags)
    for p, g in zip(net.parameters(), gradients):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at], 1e-2
        p[at] = old + step
        more = pii.loss_and_gradients(net, codes, tags)[0]
        p[at] = old - step
        less = pii.loss_and_gradients(net, codes, tags)[0]
        p[at] = old
        assert (more - less) / (2 * step) == pytest.approx(float(g[at]), rel=0.02, abs=2e-3)


def test_viterbi_finds_the_best_sequence():
    import itertools

    draw = np.random.default_rng(2)
    net = pii.new_network()
    net.moves[:] = draw.normal(size=net.moves.shape)
    scores = draw.normal(size=(5, 5, 3)).astype(np.float32)
    tags = pii.decode(net, scores)
    for n in range(3):
        value = {s: sum(scores[t, k, n] for t, k in enumerate(s)) + sum(net.moves[a, b] for a, b in zip(s, s[1:])) for s in itertools.product(range(5), repeat=5)}
        assert tuple(tags[:, n].tolist()) == max(value, key=value.get)


@pytest.fixture(scope="module")
def network(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_network_adds_other_ways_of_writing(network):
    draw = np.random.default_rng(4)
    hits = 0
    for n in range(200):
        digits = "".join(map(str, draw.integers(0, 10, 15)))
        digits += next(d for d in "0123456789" if pii.luhn(digits + d))
        card = "./_"[n % 3].join(digits[i : i + 4] for i in range(0, 16, 4))
        phone = f"({digits[:3]}) {digits[3:6]}-{digits[6:10]}"
        kind, written = (2, card) if n % 2 else (3, phone)
        text = f"the quick {written} jumps over"
        hits += pii.added_spans(text, pii.tag_texts(network, [text])[0], pii.base_spans(text)) == [(kind, 10, 10 + len(written))]
    assert hits >= 150


def test_network_finds_base_spans_and_leaves_clean_texts(network, spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    hits = spans = 0
    for text, tags in zip(texts, pii.tag_texts(network, texts)):
        base = pii.base_spans(text)
        spans += len(base)
        hits += sum((tags[a:b] == k + 1).mean() > 0.8 for k, a, b in base)
        assert base or not pii.added_spans(text, tags, base)
    assert spans > 50 and hits / spans > 0.95


def test_windows_agree_with_one_long_window(network, monkeypatch):
    text = prose(1, 90) + " x.y@z.example.com " + prose(2, 90) + " +1 (017) 555-7713 " + prose(3, 60)
    cut = pii.tag_texts(network, [text])[0]
    monkeypatch.setattr(pii, "WINDOW", 4_096)
    assert (cut == pii.tag_texts(network, [text])[0]).mean() > 0.995


def test_network_learns_where_spans_are_rare(spark):
    """One text in 200 holds a span; of 2,000 drawn from all with a digit, some ten would."""
    rows = []
    for n in range(40_000):
        one, two, three = prose(n, 3).replace(".", "").split()[:3]
        span = f"{one}{n % 7}@{two}.example" if n % 400 else f"{one}.{two}@{three}.example"
        rows.append((n, f"{one} {two} write to {span} {three} or to 10.{n % 251}.{n % 83}.7 {two}" if n % 200 == 0 else f"{one} {two} in {n} of 12 {three}"))
    net = pii.fit(documents(spark, rows))
    assert net is not None
    text = "amber birch write to cedar.delta@fjord.example ember or to 10.9.8.7 grove"
    tags = pii.tag_texts(net, [text])[0]
    for kind, a, b in pii.base_spans(text):
        assert (tags[a:b] == kind + 1).mean() > 0.8


def test_signs_match_wherever_the_patterns_do(spark):
    texts = ["x a.b@c-d.ef", "a@b-.c", "1.2.3.4", "256.1.1.300", "4111 1111-1111 1111", "+1 (017) 555-7713", "+12345678", "a@b", "1.2.3", "", "+1 2 3"]
    signs = {r["text"]: r["s"] for r in documents(spark, list(enumerate(texts))).select("text", F.col("text").rlike(pii.SIGNS).alias("s")).collect()}
    assert all(signs[t] for t in texts if pii.base_spans(t)) and not any(signs[t] for t in ("a@b", "1.2.3", "", "+1 2 3"))


def test_redacting_keeps_columns_of_any_name(spark, network):
    docs = documents(spark, [(1, "to a.b@c.example")]).selectExpr("*", "7 AS pii_spans", "8 AS PII_SPANS_")
    row = pii.redact(docs, network).first()
    assert (row["text"], row["pii_spans"], row["PII_SPANS_"]) == ("to [email]", 7, 8)


def test_spans_of_odd_rows(odd, none, network):
    for net in (network, None):
        rows = pii.find_spans(odd, net).collect()
        assert len(rows) == len(ODD) and all(r["spans"] == [] for r in rows if r["doc_id"] in (1, 2, 3))
    assert pii.find_spans(none, None).count() == 0 and pii.fit(none) is None


def test_redacted_text(spark, network):
    docs = documents(spark, [(1, "mail a.b@c.example and +1 (017) 555-7713, 10.0.0.1"), (2, None), (3, "😀 q@w.er")])
    found = {r["doc_id"]: r["text"] for r in pii.redact(docs, network).collect()}
    assert found == {1: "mail [email] and [phone], [ip]", 2: None, 3: "😀 [email]"}


def test_digest_columns(spark, tmp_path):
    text = "é x@y.example 1.2.3.4 +1 555 123 4567"
    documents(spark, [(1, text), (2, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in pii.op9_pii(spark, str(tmp_path)).collect()}
    base = "email:2:13,ip:14:21,phone:22:37"
    assert rows[1]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and rows[1]["spans"] == base
    assert (rows[2]["n_email"], rows[2]["spans"]) == (0, "")


# ---------------------------------------------------------------------------------- pipeline


def test_pipeline(spark, folder, texts, reference):
    import corpus_pipeline
    from test_pairs import classes_of

    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    classes = classes_of(texts)
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    wanted = {i for i, t in texts.items() if classes[i] == i and any(c.isalpha() for c in t) and not any(x in t for x in items)}
    assert set(rows) <= wanted and len(wanted - set(rows)) <= 1
    for r in rows.values():
        assert plain_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
        assert struct.unpack(f"<{r['n_tokens']}I", r["ids"]) == tuple(reference.encode_ordinary(r["text"]))
        if not plain_spans(texts[r["doc_id"]]):
            assert r["text"] == texts[r["doc_id"]]


def test_stages_take_odd_and_empty_tables(spark, odd, none, folder):
    import corpus_pipeline

    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            assert set(corpus_pipeline.COLUMNS) <= set(out.columns) and out.count() <= docs.count()


def test_rules_oracle_on_small_tables(spark, tmp_path):
    from compare import connect, difference

    documents(spark, [r for r in ODD if r[0] != 7]).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert connect and difference(quality_rules.quality_rules(docs).drop("failed_rule"), con, quality_rules.OP3_SQL) is None
