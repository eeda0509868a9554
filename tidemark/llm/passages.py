"""Fuzzy repeated passages: shared k-mer seeds, collinear chains, aligned chains.

Seeds are word k-mers chosen as minimizers, so that any ``KMER + WINNOW - 1`` equal words share
one. Each seed's occurrences are linked to its first occurrence, in the least document that has
it, so that a seed of n occurrences makes n - 1 anchors. The anchors of a document and a source
are chained by a Fenwick tree over source positions with a cost for gaps, and the words between
the anchors of a chain and at its ends are aligned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import mix, slices, text_buffer, words
from tidemark.session import written

KMER, WINNOW = 8, 12
MIN_WORDS = 50
# A passage may be put together from pieces with different sources, each at least so long.
PIECE_WORDS = 20
IDENTITY = 0.8
GAP_COST = 0.1
# Words that pieces of one passage may lie apart.
JOIN_GAP = 5

_FACTORS = mix(np.arange(11, 11 + KMER, dtype=np.uint64)) | np.uint64(1)


def seeds_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, word position and hash of every chosen k-mer."""
    of, _, _, hashes = words(data, offsets)
    sizes = np.bincount(of, minlength=len(offsets) - 1)
    first = np.cumsum(sizes) - sizes
    n = len(of) - KMER + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for step in range(KMER):
        total += hashes[step : step + n] * _FACTORS[step]
    valid = of[:n] == of[KMER - 1 :]
    at, text = np.flatnonzero(valid), of[:n][valid]
    kmers = mix(total[valid])
    count = np.bincount(text, minlength=len(offsets) - 1)
    begin = np.cumsum(count) - count
    if len(kmers) >= WINNOW:
        view = np.lib.stride_tricks.sliding_window_view(kmers, WINNOW)
        inside = np.flatnonzero(text[: len(view)] == text[WINNOW - 1 :])
        chosen = [inside + view[inside].argmin(1)]
    else:
        chosen = []
    for short in np.flatnonzero((count > 0) & (count < WINNOW)).tolist():
        chosen.append(np.array([begin[short] + kmers[begin[short] : begin[short] + count[short]].argmin()]))
    chosen = np.unique(np.concatenate(chosen)) if chosen else np.zeros(0, np.int64)
    return text[chosen], at[chosen] - first[text[chosen]], kmers[chosen]


def seeds(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part in slices(batches):
            text, place, kmers = seeds_of(*text_buffer(part.column(1)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(text)), pa.array(place.astype(np.int32)), pa.array(kmers.view(np.int64))],
                names=["doc_id", "place", "seed"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, place int, seed bigint")


def chain(x: list[int], y: list[int]) -> list[list[int]]:
    """Disjoint chains of anchors that rise in both coordinates, best first; x ascends.

    A chain scores ``KMER`` per anchor less ``GAP_COST`` per word of mean gap; the best
    predecessor of an anchor is the prefix maximum of a Fenwick tree over ranks of y.
    """
    rank = {v: i + 1 for i, v in enumerate(sorted(set(y)))}
    size = len(rank)
    tree: list[tuple[float, int]] = [(0.0, -1)] * (size + 1)
    score, before = [0.0] * len(x), [-1] * len(x)
    start = 0
    while start < len(x):
        end = start
        while end < len(x) and x[end] == x[start]:  # anchors at one place cannot follow each other
            end += 1
        for i in range(start, end):
            lift = GAP_COST * (x[i] + y[i]) / 2
            best, at = 0.0, -1
            r = rank[y[i]] - 1
            while r > 0:
                value, j = tree[r]
                if j >= 0 and value - lift > best:
                    best, at = value - lift, j
                r &= r - 1
            score[i], before[i] = KMER + best, at
        for i in range(start, end):
            value = score[i] + GAP_COST * (x[i] + y[i]) / 2
            r = rank[y[i]]
            while r <= size:
                if tree[r][1] < 0 or tree[r][0] < value:
                    tree[r] = (value, i)
                r += r & -r
        start = end
    used = [False] * len(x)
    chains = []
    for i in sorted(range(len(x)), key=lambda i: -score[i]):
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            links.append(i)
            i = before[i]
        if links:
            chains.append(links[::-1])
    return chains


def chains(anchors: DataFrame) -> DataFrame:
    """``doc_id, source_id, chains`` (arrays of anchors) of the anchors ``doc_id, place, source_id, source``.

    A document's anchors are no more than its seeds, so that a task holds no more than a text's.
    """
    kind = anchors.schema["doc_id"].dataType.simpleString()
    point = pa.struct([("x", pa.int32()), ("y", pa.int32())])

    def flush(doc, source, x, y):
        own, there = np.concatenate(x).tolist(), np.concatenate(y).tolist()
        found = [[{"x": own[i], "y": there[i]} for i in links] for links in chain(own, there)]
        return doc, source, found

    def run(batches):
        current, x, y, out = None, [], [], []

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], doc_type), pa.array([r[1] for r in out], doc_type), pa.array([r[2] for r in out], pa.list_(pa.list_(point)))],
                names=["doc_id", "source_id", "chains"],
            )

        doc_type = None
        for b in batches:
            doc_type = b.column(0).type
            docs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
            xs, ys = b.column(2).to_numpy(), b.column(3).to_numpy()
            edges = [i for i in range(len(docs)) if i == 0 or docs[i] != docs[i - 1] or sources[i] != sources[i - 1]] + [len(docs)]
            for a, e in zip(edges[:-1], edges[1:]):
                key = (docs[a], sources[a])
                if key != current and current is not None:
                    out.append(flush(*current, x, y))
                    x, y = [], []
                current = key
                x.append(xs[a:e])
                y.append(ys[a:e])
            if len(out) >= 1_000:
                yield batch()
                out = []
        if current is not None:
            out.append(flush(*current, x, y))
        if out:
            yield batch()

    dealt = anchors.select("doc_id", "source_id", "place", "source").repartition("doc_id").sortWithinPartitions(
        "doc_id", "source_id", "place", "source"
    )
    return dealt.mapInArrow(run, f"doc_id {kind}, source_id {kind}, chains array<array<struct<x: int, y: int>>>")


def _between(a: np.ndarray, b: np.ndarray) -> int:
    """Equal words in a best alignment of two short word lists."""
    if len(a) == len(b) and (a == b).all():
        return len(a)
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, np.int32)
    for word in a:
        step = row.copy()
        step[1:] = np.maximum(row[1:], row[:-1] + (b == word))
        row = np.maximum.accumulate(step)
    return int(row[-1])


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far two word lists agree from their starts, over single words that differ if three follow."""
    n, matched, limit = 0, 0, min(len(a), len(b))
    while n < limit:
        differ = np.flatnonzero(a[n:limit] != b[n:limit])
        run = int(differ[0]) if len(differ) else limit - n
        n, matched = n + run, matched + run
        if n + 4 > limit or (a[n + 1 : n + 4] != b[n + 1 : n + 4]).any():
            break
        n += 1
    return n, matched


def align(own: np.ndarray, there: np.ndarray, points: list[tuple[int, int]]) -> tuple[int, int, int, int, float]:
    """Spans in both word lists and the share of equal words of a chain's alignment."""
    x, y = points[0]
    matched, at_x, at_y = KMER, x + KMER, y + KMER
    for px, py in points[1:]:
        gap_x, gap_y = px - at_x, py - at_y
        if gap_x < 0 or gap_y < 0:  # overlapping anchors: what both still add
            step = min(px + KMER - at_x, py + KMER - at_y)
            matched += max(step, 0)
        else:
            matched += _between(own[at_x:px], there[at_y:py]) + KMER
        at_x, at_y = max(at_x, px + KMER), max(at_y, py + KMER)
    left, more = _extend(own[:x][::-1], there[:y][::-1])
    right, most = _extend(own[at_x:], there[at_y:])
    x, y, at_x, at_y = x - left, y - left, at_x + right, at_y + right
    return x, at_x, y, at_y, min(1.0, (matched + more + most) / max(at_x - x, at_y - y))


def aligned(chained: DataFrame, texts: DataFrame) -> DataFrame:
    """Pieces: spans of words of a document and its source that align, of PIECE_WORDS or more."""
    kind = chained.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, source_id {kind}, start int, end int, source_start int, source_end int, identity double"

    def run(batches):
        for batch in batches:
            for offset in range(0, batch.num_rows, 64):
                part = batch.slice(offset, 64)
                rows = []
                hashed = {}
                docs, sources = part.column(0), part.column(1)
                for i, (text, other, found) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(4).to_pylist())):
                    both = []
                    for t in (text, other):
                        if t not in hashed:
                            raw = np.frombuffer(t.encode(), np.uint8)
                            hashed[t] = words(raw, np.array([0, len(raw)]))[3]
                        both.append(hashed[t])
                    for links in found:
                        points = [(p["x"], p["y"]) for p in links]
                        x, x_end, y, y_end, identity = align(*both, points)
                        if x_end - x >= PIECE_WORDS and identity >= IDENTITY:
                            rows.append((i, x, x_end, y, y_end, identity))
                columns = list(zip(*rows)) if rows else [()] * 6
                take = pa.array(columns[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [docs.take(take), sources.take(take), *(pa.array(c, pa.int32()) for c in columns[1:5]), pa.array(columns[5], pa.float64())],
                    names=["doc_id", "source_id", "start", "end", "source_start", "source_end", "identity"],
                )

    with_own = chained.join(texts, "doc_id").withColumnRenamed("text", "own")
    both = with_own.join(texts.select(F.col("doc_id").alias("source_id"), F.col("text").alias("there")), "source_id")
    return both.select("doc_id", "source_id", "own", "there", "chains").mapInArrow(run, schema).distinct()


def fuzzy_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages of ``min_words`` or more words that a document shares with one before it, by pieces.

    One row per piece: ``doc_id`` and its words ``start`` to ``end`` (exclusive), ``source_id``
    (a lesser or equal-seeded document) with its span, ``identity`` and ``passage_words``, the
    length of the run of pieces that the piece belongs to. Copies are passages over whole texts.

    Texts without eight words and rows without ``doc_id`` share nothing; rows that repeat an id
    are one document. Extra columns are ignored; an empty table gives no rows.
    """
    known = docs.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sown = seeds(known)
    first = written(
        sown.groupBy("seed").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.max("doc_id").alias("last"))
        .where("last <> first.doc_id").select("seed", F.col("first.doc_id").alias("source_id"), F.col("first.place").alias("source")),
        "first-seeds",
    )
    anchors = written(sown.join(first, "seed").where("doc_id <> source_id").select("doc_id", "source_id", "place", "source"), "anchors")
    chained = written(chains(anchors), "chains")
    ids = chained.select("doc_id").union(chained.select("source_id")).distinct()
    texts = written(known.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    pieces = aligned(chained, texts)
    # Runs of pieces that overlap or nearly touch, within a document.
    listed = pieces.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(
        "start", "end", "source_id", "source_start", "source_end", "identity"))).alias("pieces"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = []
            for i, found in enumerate(batch.column(1).to_pylist()):
                group, stop = [], None
                for piece in [*found, None]:
                    if piece is None or (group and piece["start"] > stop + JOIN_GAP):
                        length = stop - group[0]["start"] if group else 0
                        if length >= min_words:
                            rows += [(i, p, length) for p in group]
                        group, stop = [], None
                    if piece is not None:
                        group.append(piece)
                        stop = piece["end"] if stop is None else max(stop, piece["end"])
            take = pa.array([r[0] for r in rows], pa.int64())
            source_type = batch.column(0).type
            columns = [batch.column(0).take(take)]
            for name, t in (("start", pa.int32()), ("end", pa.int32()), ("source_id", source_type), ("source_start", pa.int32()), ("source_end", pa.int32()), ("identity", pa.float64())):
                columns.append(pa.array([r[1][name] for r in rows], t))
            columns.append(pa.array([r[2] for r in rows], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "start", "end", "source_id", "source_start", "source_end", "identity", "passage_words"]
            )

    return listed.mapInArrow(
        run, f"doc_id {kind}, start int, end int, source_id {kind}, source_start int, source_end int, identity double, passage_words int"
    )


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return fuzzy_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
