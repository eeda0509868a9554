"""Removal of repeated byte strings, by prefix-free parsing of the corpus.

Rolling-hash triggers cut texts into phrases, alike wherever the same bytes stand. A window of
``LENGTH`` bytes is found by its first trigger: what lies before it is a suffix of a phrase,
what lies after it a prefix of the parse. Windows are compared in blocks of neighbouring starts
at one trigger. The bytes that all windows of a block share (``core``) say whether any of them
can be repeated; the bytes that they cover together (``whole``) say whether all of them are.
Blocks in between are cut smaller, down to single windows, so that work after the first scan
goes with the ends of repeats and not with their length.

The corpus order itself is never laid out: whether a suffix has a neighbour with ``LENGTH``
equal bytes is decided by 128-bit hashes of the bytes, grouped by the cluster, instead of by
sorting all suffixes of the corpus.

Passages that stand in several rows are found alike, by words: of the short grams in a window of
``PASSAGE`` words the one of least hash is its trigger, windows with one trigger are a block, and
blocks whose whole is not repeated are cut into single windows. ``LENGTH`` bytes may be more than
such a passage has, so this is told beside what is removed.
"""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import mix, powers, runs, slices, text_buffer, words
from tidemark.session import written

LENGTH = 400
WINDOW = 16  # bytes under the rolling hash
# One trigger in so many places; windows without one go by finer triggers, then one by one.
COARSE, FINE = 128, 16
BLOCKS = (128, 16, 1)
# Words of a passage, and of the grams of which one stands for it.
PASSAGE, GRAM = 50, 16

_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_draw = random.Random(7)
_VALUES = [np.array([_draw.getrandbits(64) for _ in range(256)], np.uint64) for _ in _BASES]
_INVERSES = [pow(base, -1, 1 << 64) for base in _BASES]


class Hashes:
    """Hashes of any byte range of a buffer, from prefix sums."""

    def __init__(self, data: np.ndarray, families: int):
        self.n = len(data)
        self.sums = []
        for family in range(families):
            total = np.zeros(self.n + 1, np.uint64)
            np.cumsum(self.values(data, family) * powers(_BASES[family], self.n), out=total[1:])
            self.sums.append(total)

    def values(self, data: np.ndarray, family: int) -> np.ndarray:
        return _VALUES[family][data]

    def of(self, start: np.ndarray, end: np.ndarray, tag: np.ndarray, family: int = 0) -> np.ndarray:
        total = self.sums[family]
        return mix((total[end] - total[start]) * powers(_INVERSES[family], self.n + 1)[start] + mix(tag.astype(np.uint64)))

    def rolling(self) -> np.ndarray:
        if self.n < WINDOW:
            return np.zeros(0, np.uint64)
        total = self.sums[0]
        return mix((total[WINDOW:] - total[:-WINDOW]) * powers(_INVERSES[0], self.n + 1)[: self.n - WINDOW + 1])


class WordHashes(Hashes):
    """Hashes of any range of words, from the words' own hashes."""

    def values(self, data: np.ndarray, family: int) -> np.ndarray:
        return mix(data + np.uint64(_BASES[family]))


def _blocks_at(trigger, previous, low, high, size):
    """Blocks of window starts in [low, high] whose first trigger is given; the right edge of each
    lies a multiple of ``size`` before its trigger. Arrays of edge, first and last start, trigger number."""
    low = np.maximum(np.maximum(low, previous + 1), trigger - (LENGTH - WINDOW))
    high = np.minimum(high, trigger)
    keep = np.flatnonzero(low <= high)
    trigger, low, high = trigger[keep], low[keep], high[keep]
    first = (trigger - high) // size
    count = (trigger - low) // size - first + 1
    of = np.repeat(np.arange(len(keep)), count)
    k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + first[of]
    edge = trigger[of] - k * size
    return edge, np.maximum(low[of], edge - size + 1), np.minimum(high[of], edge), keep[of]


def _gaps(trigger, owner, low, high):
    """Starts of the ranges [low, high] (by number) that have no trigger in reach: ranges again."""
    reach = LENGTH - WINDOW
    n = len(low)
    # Per range, the triggers in it cut it into pieces: (previous + 1 .. trigger - reach - 1).
    begin = np.concatenate([low, trigger + 1])
    number = np.concatenate([np.arange(n), owner])
    order = np.lexsort((begin, number))
    begin, number = begin[order], number[order]
    end = np.empty(len(begin), np.int64)
    is_last = np.r_[number[1:] != number[:-1], True] if len(number) else np.zeros(0, bool)
    end[:-1] = begin[1:] - 1 - reach - 1
    end[is_last] = high[number[is_last]]
    end = np.minimum(end, high[number])
    keep = begin <= end
    return begin[keep], end[keep], number[keep]


def first_blocks(hashes: Hashes, offsets: np.ndarray):
    """Blocks of all windows: edge, first and last start, size, class of the trigger, text number."""
    length = np.diff(offsets)
    texts = np.flatnonzero(length >= LENGTH)
    low, high = offsets[texts], offsets[texts + 1] - LENGTH
    rolled = hashes.rolling()
    out = []

    def triggers(every: int, low, high):
        """Triggers in reach of the ranges, with their range and the trigger before in it."""
        at = np.flatnonzero((rolled & np.uint64(every - 1)) == 0)
        owner = np.searchsorted(low, at, "right") - 1
        inside = (owner >= 0) & (at <= (high + LENGTH - WINDOW)[np.maximum(owner, 0)]) if len(low) else np.zeros(len(at), bool)
        at, owner = at[inside], owner[inside]
        before = np.empty(len(at), np.int64)
        if len(at):
            before[1:] = at[:-1]
            new = np.r_[True, owner[1:] != owner[:-1]]
            before[new] = low[owner[new]] - 1
        return at, owner, before

    text = texts
    for kind, every in enumerate((COARSE, FINE)):
        at, owner, before = triggers(every, low, high)
        edge, first, last, number = _blocks_at(at, before, low[owner], high[owner], BLOCKS[0])
        out.append((edge, first, last, np.full(len(edge), BLOCKS[0]), np.full(len(edge), kind), text[owner[number]]))
        low, high, number = _gaps(at, owner, low, high)
        text = text[number]
    size = high - low + 1
    of = np.repeat(np.arange(len(low)), size)
    edge = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + low[of]
    out.append((edge, edge, edge, np.ones(len(edge), np.int64), np.full(len(edge), 2), text[of]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _keys(hashes: Hashes, edge, size, kind, begin, end, whole: bool):
    """Core and, if asked for, the two hashes of the whole of each block of texts [begin, end).

    ``inside`` tells whether the whole lies in its text; if not, it is no whole.
    """
    core = hashes.of(edge, edge - size + 1 + LENGTH, kind)
    if not whole:
        return core, None, None, None
    left, right = edge - size + 1, edge + LENGTH
    inside = (left >= begin) & (right <= end)
    left, right = np.maximum(left, begin), np.minimum(right, end)
    one, two = (hashes.of(left, right, kind, family) for family in (0, 1))
    return core, one, two, inside


_ROW = "rid bigint, edge int, first int, last int, size int, kind int"


def _batch(rid, edge, first, last, size, kind, *keys):
    columns = [pa.array(rid), *(pa.array(x.astype(np.int32)) for x in (edge, first, last, size, kind))]
    names = ["rid", "edge", "first", "last", "size", "kind"]
    for name, key in zip(("core", "one", "two"), keys):
        columns.append(pa.array(key.view(np.int64)))
        names.append(name)
    return pa.RecordBatch.from_arrays(columns, names=names)


def _scan(texts: DataFrame, whole: bool) -> DataFrame:
    """Blocks of all windows with their keys; without ``whole`` only the cores."""

    def run(batches):
        for part in slices(batches):
            data, offsets = text_buffer(part.column(1))
            hashes = Hashes(data, 2 if whole else 1)
            edge, first, last, size, kind, text = first_blocks(hashes, offsets)
            begin, end = offsets[text], offsets[text + 1]
            if not whole:
                core = _keys(hashes, edge, size, kind, begin, end, False)[0]
                yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64))], names=["core"])
                continue
            core, one, two, inside = _keys(hashes, edge, size, kind, begin, end, True)
            rid = part.column(0).to_numpy()[text]
            two = np.where(inside, two, mix(rid.view(np.uint64) + edge.astype(np.uint64)))
            yield _batch(rid, edge - begin, first - begin, last - begin, size, kind, core, one, two)

    return texts.mapInArrow(run, f"{_ROW}, core bigint, one bigint, two bigint" if whole else "core bigint")


def _refine(blocks: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The blocks cut into blocks of ``size`` starts, with their keys."""
    listed = blocks.groupBy("rid").agg(F.collect_set(F.struct("edge", "first", "last", "size", "kind", "spare")).alias("blocks"))

    def run(batches):
        for part in slices(batches):
            data, offsets = text_buffer(part.column(1))
            hashes = Hashes(data, 2)
            lists = part.column(2)
            rows = lists.flatten()
            count = np.diff(lists.offsets.to_numpy())
            text = np.repeat(np.arange(part.num_rows), count)
            edge, first, last, old, kind, spare = (rows.field(i).to_numpy().astype(np.int64) for i in range(6))
            begin, end = offsets[text], offsets[text + 1]
            cuts = old // size
            of = np.repeat(np.arange(len(edge)), cuts)
            step = np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            edge = edge[of] - step * size
            first, last = np.maximum(first[of], edge - size + 1), np.minimum(last[of], edge)
            keep = first <= last
            of, edge, first, last = of[keep], edge[keep], first[keep], last[keep]
            begin, end, kind, text = begin[of], end[of], kind[of], text[of]
            sizes = np.full(len(edge), size)
            core, one, two, inside = _keys(hashes, edge + begin, sizes, kind, begin, end, True)
            rid = part.column(0).to_numpy()[text]
            two = np.where(inside, two, mix(rid.view(np.uint64) + edge.astype(np.uint64)))
            batch = _batch(rid, edge, first, last, sizes, kind, core, one, two)
            yield batch.append_column("spare", pa.array(spare[of].astype(np.int32)))

    joined = texts.join(listed, "rid").select("rid", "text", "blocks")
    return joined.mapInArrow(run, f"{_ROW}, core bigint, one bigint, two bigint, spare int")


def _judged(rows: DataFrame, wholes: DataFrame) -> DataFrame:
    """The rows with ``whole``, true if theirs is repeated, in place of its hashes; such rows lose their core."""
    both = rows.join(wholes.select("one", "two", F.lit(True).alias("whole")), ["one", "two"], "left").drop("one", "two")
    return written(both.withColumn("core", F.when(F.col("whole").isNull(), F.col("core"))), "judged")


def repeated_spans(texts: DataFrame, also: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rid, start, end`` of repeated strings, and the texts (``rid, text``) that can have any
    or whose ``rid`` is in ``also``."""
    cores = written(_scan(texts, False).groupBy("core").count().where("count > 1").select("core"), "cores")
    rows = _scan(texts, True).join(cores, "core", "left_semi").withColumn("spare", F.lit(0))
    held, spans = None, []
    for level, size in enumerate(BLOCKS):
        if level:
            rows = written(_refine(rows, held, size), "blocks")
            again = written(rows.groupBy("core").count().where("count > 1").select("core"), "cores")
            rows = rows.join(again, "core", "left_semi")
        rows = written(rows, "hits")
        if held is None:
            ids = rows.select("rid").union(also).distinct()
            held = written(texts.join(ids, "rid", "left_semi"), "texts")
        block = F.struct("rid", "edge", "first", "last", "size", "kind")
        wholes = written(
            rows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"), F.first("core").alias("core"), F.min(block).alias("block"))
            .where("n > 1"), "wholes",
        )
        judged = _judged(rows, wholes)
        spans.append(judged.where("whole").selectExpr("rid", "first AS start", f"last + {LENGTH} AS end"))
        if size == 1:
            break
        undecided = judged.where("whole IS NULL AND spare = 0 AND size > 1")
        # One block of each decided whole stands for all: an undecided one may equal a part of it.
        # So may the parts, not decided themselves, of one that stood so before.
        near = written(undecided.select("core").distinct(), "undecided-cores")
        spare = wholes.where("block.size > 1").join(near, "core", "left_semi").select("block.*", F.lit(1).alias("spare"))
        columns = ["rid", "edge", "first", "last", "size", "kind", "spare"]
        parts = judged.where("whole IS NULL AND spare = 1").join(near, "core", "left_semi")
        rows = undecided.select(*columns).union(spare.select(*columns)).union(parts.select(*columns))
    found = spans[0]
    for more in spans[1:]:
        found = found.union(more)
    return found, held


def passage_blocks(text: np.ndarray, hashes: WordHashes):
    """Blocks of all windows of ``PASSAGE`` words: text number, first and last window, hash of the trigger."""
    n = len(text)
    if n < PASSAGE:
        return *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64)
    at = np.arange(n - GRAM + 1)
    grams = hashes.of(at, at + GRAM, np.array([GRAM]))
    # Half of the hash and the place, so that the first of equal grams stands for a window.
    least = (grams & np.uint64(0xFFFFFFFF << 32)) | at.astype(np.uint64)
    width, reach = 1, PASSAGE - GRAM + 1
    while width < reach:
        step = min(width, reach - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    start = np.flatnonzero(text[: n - PASSAGE + 1] == text[PASSAGE - 1 :])
    trigger = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.ones(len(start) + 1, bool)
    edge[1:-1] = trigger[1:] != trigger[:-1]
    first, last = start[edge[:-1]], start[edge[1:]]
    return text[first], first, last, grams[trigger[edge[:-1]]]


def _fresh(*keys: np.ndarray) -> np.ndarray:
    """Whether an entry is the first of its equals, by all keys."""
    order = np.lexsort(keys)
    out = np.ones(len(order), bool)
    out[order[1:]] = np.logical_or.reduce([key[order[1:]] != key[order[:-1]] for key in keys])
    return out


def _scan_passages(texts: DataFrame, whole: bool) -> DataFrame:
    """Blocks of all windows of words with their keys, ``n`` being 0 for further ones of a row with an
    equal whole; without ``whole`` only the cores, once a row."""

    def run(batches):
        for part in slices(batches):
            text, _, _, values = words(*text_buffer(part.column(1)))
            hashes = WordHashes(values, 2 if whole else 1)
            text_of, first, last, core = passage_blocks(text, hashes)
            if not whole:
                yield pa.RecordBatch.from_arrays([pa.array(core[_fresh(core, text_of)].view(np.int64))], names=["core"])
                continue
            end = last + PASSAGE
            one, two = (hashes.of(first, end, end - first, family) for family in (0, 1))
            begin = runs(text, part.num_rows)[text_of]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part.column(0).to_numpy()[text_of]), pa.array((first - begin).astype(np.int32)), pa.array((last - begin).astype(np.int32)),
                    pa.array(_fresh(two, one, text_of).astype(np.int32)), *(pa.array(x.view(np.int64)) for x in (core, one, two)),
                ],
                names=["rid", "first", "last", "n", "core", "one", "two"],
            )

    return texts.mapInArrow(run, "rid bigint, first int, last int, n int, core bigint, one bigint, two bigint" if whole else "core bigint")


def _windows(blocks: DataFrame, texts: DataFrame) -> DataFrame:
    """The blocks cut into single windows with their keys. ``n`` is the number of rows that a window
    stands for: 2 in a spare block, which is repeated, and 0 for further equal ones of a row."""
    listed = blocks.groupBy("rid").agg(F.collect_set(F.struct("first", "last", "spare")).alias("blocks"))

    def run(batches):
        for part in slices(batches):
            text, _, _, values = words(*text_buffer(part.column(1)))
            hashes = WordHashes(values, 2)
            lists = part.column(2)
            rows = lists.flatten()
            of = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            first, last, spare = (rows.field(i).to_numpy().astype(np.int64) for i in range(3))
            size = last - first + 1
            start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
            of, spare = np.repeat(of, size), np.repeat(spare, size)
            at = start + runs(text, part.num_rows)[of]
            one, two = (hashes.of(at, at + PASSAGE, np.array([PASSAGE]), family) for family in (0, 1))
            n = _fresh(two, one, spare, of) * (1 + spare)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.column(0).to_numpy()[of]), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(spare.astype(np.int32)),
                 *(pa.array(x.view(np.int64)) for x in (one, two))],
                names=["rid", "start", "n", "spare", "one", "two"],
            )

    joined = texts.join(listed, "rid").select("rid", "text", "blocks")
    return joined.mapInArrow(run, "rid bigint, start int, n int, spare int, one bigint, two bigint")


def judged_passages(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rid, start, end`` (in words) of blocks of passages that stand in several rows, and the blocks
    (``rid, first, last, spare``) whose windows have to be compared one by one."""
    cores = written(_scan_passages(texts, False).groupBy("core").count().where("count > 1").select("core"), "cores")
    rows = written(_scan_passages(texts, True).join(cores, "core", "left_semi"), "hits")
    block = F.struct("rid", "first", "last")
    wholes = written(
        rows.groupBy("one", "two").agg(F.sum("n").alias("n"), F.first("core").alias("core"), F.min(block).alias("block")).where("n > 1"), "wholes"
    )
    judged = _judged(rows.drop("n"), wholes)
    undecided = judged.where("whole IS NULL")
    # As above: one block of each decided whole stands for all.
    near = written(undecided.select("core").distinct(), "undecided-cores")
    spare = wholes.join(near, "core", "left_semi").select("block.*", F.lit(1).alias("spare"))
    blocks = undecided.select("rid", "first", "last", F.lit(0).alias("spare")).union(spare)
    return judged.where("whole").selectExpr("rid", "first AS start", f"last + {PASSAGE} AS end"), blocks


def shared_words(spans: DataFrame, blocks: DataFrame, texts: DataFrame) -> DataFrame:
    """``rid, n_shared_words``: words in passages that stand in several rows; ``texts`` has those of the blocks."""
    windows = written(_windows(blocks, texts), "windows")
    found = windows.groupBy("one", "two").agg(F.sum("n").alias("n")).where("n > 1").select("one", "two")
    single = windows.where("spare = 0").join(found, ["one", "two"], "left_semi").selectExpr("rid", "start", f"start + {PASSAGE} AS end")
    # Of spans in order, each adds what lies behind all before it.
    return spans.union(single).groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")).selectExpr(
        "rid",
        """aggregate(spans, named_struct('n', 0L, 'stop', 0), (a, x) -> named_struct(
            'n', a.n + greatest(x.end - greatest(x.start, a.stop), 0), 'stop', greatest(x.end, a.stop)), a -> a.n) AS n_shared_words""",
    )


def cut_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Sizes, spans and the hash of what is left of every text, by row.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared_words`` and, if asked for,
    ``kept`` (the bytes). ``n_shared_words`` counts the words in passages of ``PASSAGE`` words or more that
    stand in another row too, with any white space between the words; they are told, not removed, where
    they have no ``LENGTH`` repeated bytes. Null and empty texts have no bytes. Rows that repeat
    each other repeat each other's strings: from ``LENGTH`` bytes on all of them are removed whole.
    Rows without ``doc_id`` are treated like any others, extra columns ignored; an empty table gives
    no rows. Rows are told apart by a 64-bit hash of id and text.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("rid", F.xxhash64("doc_id", "text"))
    texts = keyed.select("rid", "text")
    passages, blocks = judged_passages(texts)
    found, held = repeated_spans(texts, blocks.select("rid"))
    shared = written(shared_words(passages, blocks, held), "shared")
    spans = found.groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            # Runs of all rows at once; rows are told apart by the upper bits of a place.
            lists = batch.column(2)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            start, end = (lists.flatten().field(i).to_numpy().astype(np.int64) + (row << 32) for i in (0, 1))
            stop = np.maximum.accumulate(end)
            edge = np.ones(len(row) + 1, bool)
            edge[1:-1] = start[1:] > stop[:-1]
            low = (1 << 32) - 1
            starts, stops = (start[edge[:-1]] & low).tolist(), (stop[edge[1:]] & low).tolist()
            counts = np.bincount(row[edge[:-1]], minlength=batch.num_rows)
            removed, digests, rest, at = [], [], [], 0
            for text, n in zip(batch.column(1).to_pylist(), counts.tolist()):
                raw = text.encode()
                bounds = zip([0, *stops[at : at + n]], [*starts[at : at + n], len(raw)])
                kept = b"".join([raw[a:b] for a, b in bounds])
                at += n
                removed.append(len(raw) - len(kept))
                digests.append(hashlib.sha256(kept).hexdigest())
                rest.append(kept if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests), pa.array(rest, pa.binary())],
                names=["rid", "removed", "spans", "digest", "rest"],
            )

    cut = held.dropDuplicates(["rid"]).join(spans, "rid").select("rid", "text", "spans").mapInArrow(
        run, "rid bigint, removed bigint, spans bigint, digest string, rest binary"
    )
    cut = written(cut, "cut")
    columns = ["doc_id", "rid", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("full")]
    if with_text:
        columns.append(F.col("text").cast("binary").alias("raw"))
    joined = keyed.select(*columns).join(cut, "rid", "left").join(shared, "rid", "left")
    out = [
        "doc_id", "n_bytes", F.coalesce("removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("digest", "full").alias("kept_sha256"),
        F.coalesce("n_shared_words", F.lit(0)).cast("bigint").alias("n_shared_words"),
    ]
    if with_text:
        out.append(F.when(F.col("digest").isNull(), F.col("raw")).otherwise(F.col("rest")).alias("kept"))
    return joined.select(*out)


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return cut_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
