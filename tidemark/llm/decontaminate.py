"""Benchmark decontamination: a BM25 index of test items, searched by block-max WAND.

Every passage of every document is a query against an inverted index of the test items. The
impacts of an item are BM25 weights over the item's score for itself, so that one threshold
means the same share of any item. Passages whose terms cannot reach the threshold together are
ruled out at once for a whole slice of texts; the others walk the index with block-max WAND,
which returns all items at or above it. A hit counts when the document also overlaps the item's
question and its answer.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.text import extended, mix, slices, text_buffer, words

PASSAGE, STRIDE = 128, 64
THRESHOLD = 0.6
QUESTION_OVERLAP = ANSWER_OVERLAP = 0.5
K1, B = 1.2, 0.75
BLOCK = 2
# Words of test items in one index; more items are searched index by index, in further passes.
INDEX_WORDS = 2_000_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence of an item is its answer; of a single sentence, the last quarter."""
    parts = re.split(r"(?<=[.!?])\s+|\n+", text.strip())
    if len(parts) > 1:
        return text.strip()[: -len(parts[-1])], parts[-1]
    tokens = text.split()
    cut = len(tokens) - max(1, len(tokens) // 4)
    return " ".join(tokens[:cut]), " ".join(tokens[cut:])


def word_hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return words(raw, np.array([0, len(raw)]), plain=True)[3]


def trigrams(hashes: np.ndarray) -> np.ndarray:
    """Hashes of three words in a row; of fewer words, the words."""
    if len(hashes) < 3:
        return np.unique(hashes)
    return np.unique(mix(hashes[:-2] + hashes[1:-1] * _A + hashes[2:] * _B))


class Index:
    """Postings of items by term: items in ascending order, impacts, and maxima per block."""

    def __init__(self, items: list[tuple[object, str]], frequency: dict[int, int], n_items: int, mean_words: float):
        self.ids = [item for item, _ in items]
        self.question, self.answer, self.length = [], [], []
        postings: dict[int, list[tuple[int, float]]] = {}
        for place, (_, text) in enumerate(items):
            question, answer = question_and_answer(text)
            self.question.append(trigrams(word_hashes(question)))
            self.answer.append(np.unique(word_hashes(answer)))
            terms, counts = np.unique(word_hashes(text), return_counts=True)
            df = np.array([frequency[int(term)] for term in terms.view(np.int64)])
            idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
            length = counts.sum()
            self.length.append(int(length))
            weight = idf * counts * (K1 + 1) / (counts + K1 * (1 - B + B * length / mean_words))
            weight /= weight.sum() * min(1.0, STRIDE / length)  # a long item is seen in parts only
            for term, w in zip(terms.tolist(), weight.tolist()):
                postings.setdefault(term, []).append((place, w))
        self.terms = np.array(sorted(postings), np.uint64)
        self.lists = [tuple(zip(*postings[term])) for term in self.terms.tolist()]
        self.most = np.array([max(w) for _, w in self.lists] or [0.0])
        # The same maxima by ranges of BLOCK items, for ruling out whole slices of passages.
        ranges = [np.unique(np.array(d) // BLOCK, return_index=True) for d, _ in self.lists]
        self.range_of = np.concatenate([r for r, _ in ranges] or [np.zeros(0, int)])
        self.range_most = np.concatenate([np.maximum.reduceat(np.array(w), at) for (_, at), (_, w) in zip(ranges, self.lists)] or [np.zeros(0)])
        self.range_first = np.cumsum([0] + [len(r) for r, _ in ranges])
        self.block_most = [[max(w[i : i + BLOCK]) for i in range(0, len(w), BLOCK)] for _, w in self.lists]
        self.block_last = [[d[min(i + BLOCK, len(d)) - 1] for i in range(0, len(d), BLOCK)] for d, _ in self.lists]

    def hopeful(self, window: np.ndarray, term: np.ndarray, n: int, threshold: float) -> np.ndarray:
        """Of n windows, given as pairs with their terms, those with a range of items in reach."""
        reach = np.bincount(window, self.most[term], n) >= threshold - 1e-9
        keep = reach[window]
        window, term = window[keep], term[keep]
        n_ranges = -(-len(self.ids) // BLOCK)
        out = np.zeros(n, bool)
        edges = np.flatnonzero(np.r_[True, window[1:] != window[:-1]]) if len(window) else np.zeros(0, int)
        cost = np.cumsum(self.range_first[term + 1] - self.range_first[term])
        start = 0
        while start < len(window):  # some windows at a time, so that their sums stay small
            limit = (cost[start - 1] if start else 0) + 1_000_000
            last = int(np.searchsorted(cost, limit, "right"))
            end = int(edges[max(np.searchsorted(edges, last, "right") - 1, 0)]) if last < len(window) else len(window)
            if end <= start:
                after = np.searchsorted(edges, start, "right")
                end = int(edges[after]) if after < len(edges) else len(window)
            w, t = window[start:end], term[start:end]
            own, local = np.unique(w, return_inverse=True)
            size = self.range_first[t + 1] - self.range_first[t]
            at = np.repeat(self.range_first[t] - np.cumsum(size) + size, size) + np.arange(size.sum())
            slot = np.repeat(local, size) * n_ranges + self.range_of[at]
            keys, where = np.unique(slot, return_inverse=True)
            good = np.bincount(where, self.range_most[at]) >= threshold - 1e-9
            out[own[np.unique(keys[good] // n_ranges)]] = True
            start = end
        return np.flatnonzero(out)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose impacts under the terms add up to the threshold, by block-max WAND."""
        end = len(self.ids)
        cursors = [[self.lists[t][0][0], 0, t] for t in terms]  # item, position, term
        found = []
        while True:
            cursors.sort()
            reach, pivot = 0.0, -1
            for i, (item, _, t) in enumerate(cursors):
                if item == end:
                    break
                reach += self.most[t]
                if reach >= threshold - 1e-9:
                    pivot = i
                    break
            if pivot < 0:
                return found
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            bound, skip = 0.0, end
            for item, _, t in cursors[: pivot + 1]:
                block = bisect_left(self.block_last[t], target)
                if block < len(self.block_last[t]):
                    bound += self.block_most[t][block]
                    skip = min(skip, self.block_last[t][block] + 1)
            if bound < threshold - 1e-9:  # no item up to the first block's end can reach it
                if pivot + 1 < len(cursors):
                    skip = min(skip, cursors[pivot + 1][0])
                target = max(skip, target + 1)
            elif cursors[0][0] == target:
                score = sum(self.lists[t][1][at] for item, at, t in cursors[: pivot + 1] if item == target)
                if score >= threshold - 1e-9:
                    found.append((target, score))
                target += 1
            for cursor in cursors[: pivot + 1]:
                if cursor[0] < target:
                    docs = self.lists[cursor[2]][0]
                    cursor[1] = bisect_left(docs, target, cursor[1])
                    cursor[0] = docs[cursor[1]] if cursor[1] < len(docs) else end


def leaks_of(index: Index, data: np.ndarray, offsets: np.ndarray, threshold: float = THRESHOLD) -> list[dict[int, tuple]]:
    """Per text, the verified items with their best score and the overlaps of that passage."""
    n_texts = len(offsets) - 1
    found: list[dict[int, tuple]] = [{} for _ in range(n_texts)]
    of, _, _, hashes = words(data, offsets, plain=True)
    if not len(of) or not len(index.terms):
        return found
    sizes = np.bincount(of, minlength=n_texts)
    first = np.cumsum(sizes) - sizes
    n_windows = np.where(sizes > 0, np.maximum(1, -(-(sizes - PASSAGE) // STRIDE) + 1), 0)
    window_first = np.cumsum(n_windows) - n_windows
    term = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    at = np.flatnonzero(index.terms[term] == hashes)
    term, text = term[at], of[at]
    step = (at - first[text]) // STRIDE
    inside, before = step < n_windows[text], step > 0
    window = np.concatenate([(window_first[text] + step)[inside], (window_first[text] + step - 1)[before]])
    pair = np.unique(window * len(index.terms) + np.concatenate([term[inside], term[before]]))
    window, term = pair // len(index.terms), pair % len(index.terms)
    hopeful = index.hopeful(window, term, int(n_windows.sum()), threshold)
    bounds = np.searchsorted(window, hopeful), np.searchsorted(window, hopeful, "right")
    owner = np.searchsorted(window_first + n_windows, hopeful, "right")
    for w, a, b, text in zip(hopeful.tolist(), bounds[0].tolist(), bounds[1].tolist(), owner.tolist()):
        for item, score in index.search(term[a:b].tolist(), threshold):
            # As much text on both sides as a copy may have there of which the window is only a part.
            margin = max(STRIDE, index.length[item])
            begin = (w - window_first[text]) * STRIDE
            near = hashes[first[text] + max(0, begin - margin) : first[text] + min(begin + PASSAGE + margin, sizes[text])]
            asked = _share(index.question[item], trigrams(near) if len(index.question[item]) else near)
            asked = max(asked, _share(index.question[item], near))  # questions of one or two words
            answered = _share(index.answer[item], near)
            if asked >= QUESTION_OVERLAP and answered >= ANSWER_OVERLAP and score > found[text].get(item, (0.0,))[0]:
                found[text][item] = (score, asked, answered)
    return found


def _share(wanted: np.ndarray, there: np.ndarray) -> float:
    return float(np.isin(wanted, there).mean()) if len(wanted) else 1.0


def build_indexes(items: DataFrame, index_words: int | None = None) -> list[Index]:
    """Indexes over all items with a text of one word or more, each of about ``index_words`` (INDEX_WORDS).

    Frequencies, the mean length and the number of items are those of all items.
    """
    known = items.select("item_id", "text").where(F.length(F.trim("text")) > 0)

    def terms(batches):
        for part in slices(batches):
            of, _, _, hashes = words(*text_buffer(part.column(1)), plain=True)
            pairs = np.unique(np.stack([of.astype(np.uint64), hashes]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[1].view(np.int64))], names=["term"])

    size = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    n, total = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    frequencies = known.mapInArrow(terms, "term bigint").groupBy("term").count()
    shards = max(1, -(-total // (index_words or INDEX_WORDS)))
    indexes = []
    for shard in range(shards):
        part = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        rows = [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]
        counts = frequencies if shards == 1 else frequencies.join(part.mapInArrow(terms, "term bigint").distinct(), "term")
        frequency = {r["term"]: r["count"] for r in counts.collect()}
        # Items of like length have like impacts, which makes the maxima of their blocks tight.
        rows = sorted((row for row in rows if len(word_hashes(row[1]))), key=lambda r: len(r[1]))
        indexes.append(Index(rows, frequency, n, max(total / max(n, 1), 1.0)))
    return indexes


def annotate(docs: DataFrame, items: DataFrame, column: str = "leaks", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with an array of the leaked items: ``item_id``, ``score`` and both overlaps.

    Null, empty and item-less texts have an empty array; so has every text when no item has a
    word. Repeated documents are each searched; repeated items are each reported. All columns
    of ``docs`` are kept; one named like ``column`` is replaced.
    """
    context = docs.sparkSession.sparkContext
    leak = T.StructType([
        T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("score", T.DoubleType()),
        T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType()),
    ])
    kind = to_arrow_type(T.ArrayType(leak))
    parts = []
    for index in build_indexes(items):
        shared = context.broadcast(index)  # bounded by INDEX_WORDS

        def make(texts, shared=shared):
            own = shared.value
            found = leaks_of(own, *text_buffer(texts), threshold)
            return [pa.array(
                [[{"item_id": own.ids[i], "score": s, "question_overlap": q, "answer_overlap": a} for i, (s, q, a) in sorted(hits.items())] for hits in found],
                kind,
            )]

        name = column if not parts else f"{column}_{len(parts)}"
        docs = extended(docs, make, [T.StructField(name, T.ArrayType(leak))])
        parts.append(name)
    return docs.withColumn(column, F.concat(*parts)).drop(*parts[1:])


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` of every verified leak."""
    return annotate(docs.select("doc_id", "text"), items).select("doc_id", F.inline("leaks"))


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
