"""Near duplicates by DartMinHash signatures, banded candidates and exact verification.

A text is a weighted set: its five-word shingles, each with the number of its occurrences. The
w-th occurrence of a shingle owns a unit region of the dart board; darts fall into a region as
a Poisson process over their ranks, drawn from hashes of the region alone, and each dart aims
at one of the signature's coordinates. A coordinate keeps its earliest dart. Two texts agree in
a coordinate with the probability of their weighted Jaccard similarity, and a text of W
shingles needs only about k log k darts besides W first draws. A text that repeats shingles has
a second signature, of its first occurrences only, for texts that are alike as sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.graph import components
from tidemark.llm.text import mix, slices, text_buffer, words
from tidemark.session import written

SHINGLE = 5
SIMILARITY = 0.8
# At a similarity of 0.8 a pair is missed by all 25 bands with probability 5e-5.
BANDS, BAND_ROWS = 25, 5
# Members of a bucket that are compared with as many others at a time.
BLOCK = 256

_STEP = np.uint64(0x9E3779B97F4A7C15)
_AIM = np.uint64(0xD1B54A32D192ED03)
_FACTORS = mix(np.arange(1, 10, dtype=np.uint64)) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and occurrence (0, 1, ...) of each shingle, by text and hash.

    A text of one to four words has one shingle, all of it.
    """
    of, _, _, hashes = words(data, offsets)
    n_texts = len(offsets) - 1
    sizes = np.bincount(of, minlength=n_texts)
    ends = np.cumsum(sizes)
    last = np.repeat(ends, sizes)
    at = np.arange(len(of))
    total = np.zeros(len(of), np.uint64)
    for step in range(SHINGLE):
        inside = at + step < last
        total[inside] += hashes[at[inside] + step] * _FACTORS[step]
    begins = (at + SHINGLE <= last) | ((at == last - np.repeat(sizes, sizes)) & (np.repeat(sizes, sizes) < SHINGLE))
    of, hashes = of[begins], mix(total[begins])
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    fresh = np.ones(len(of), bool)
    fresh[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(fresh)
    return of, hashes, np.arange(len(of)) - np.repeat(first, np.diff(np.r_[first, len(of)]))


def regions(hashes: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """Unit regions of the board: one per shingle and occurrence."""
    return mix(hashes + occurrence.astype(np.uint64) * _AIM)


def signatures(of: np.ndarray, units: np.ndarray, n_texts: int, k: int) -> np.ndarray:
    """The earliest dart per text and coordinate (n_texts x k); texts without regions get zeros."""
    out = np.zeros((n_texts, k), np.uint64)
    weight = np.bincount(of, minlength=n_texts)
    reach = (k * np.log(k) + 3 * k) / np.maximum(weight, 1)  # rank up to which darts are drawn
    todo = weight > 0
    while todo.any():
        mine = todo[of]
        text, unit = of[mine], units[mine]
        rank = np.zeros(len(text))
        limit = reach[text]
        earliest = np.full(n_texts * k, np.inf)
        thrown = []
        nth = 0
        while len(text):
            nth += 1
            dart = mix(unit + np.uint64(nth * int(_STEP) % (1 << 64)))
            rank = rank - np.log((dart >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54)
            hit = rank < limit
            text, unit, rank, limit, dart = text[hit], unit[hit], rank[hit], limit[hit], dart[hit]
            slot = text * k + (mix(dart ^ _AIM) % np.uint64(k)).astype(np.int64)
            np.minimum.at(earliest, slot, rank)
            thrown.append((slot, rank, dart))
        flat = out.reshape(-1)
        for slot, rank, dart in thrown:
            won = rank == earliest[slot]
            flat[slot[won]] = dart[won]
        todo &= np.isinf(earliest.reshape(n_texts, k)).any(1)
        reach *= 2
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band."""
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS)
    keys = np.arange(BANDS, dtype=np.uint64) * _STEP
    return mix((parts * _FACTORS[:BAND_ROWS]).sum(2, dtype=np.uint64) + keys).view(np.int64)


def bands_of(of: np.ndarray, hashes: np.ndarray, occurrence: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of all texts in a row, and where each text's begin and the last's end.

    Keys are of the multiset of shingles and of their set; a key that is both is there once.
    """
    k = BANDS * BAND_ROWS
    keys = band_keys(signatures(of, regions(hashes, occurrence), n_texts, k))
    repeating = np.unique(of[occurrence > 0])
    place = np.full(n_texts, -1)
    place[repeating] = np.arange(len(repeating))
    own = (occurrence == 0) & (place[of] >= 0)
    of_sets = band_keys(signatures(place[of[own]], regions(hashes[own], occurrence[own]), len(repeating), k))
    fresh = of_sets != keys[repeating]
    text = np.concatenate([np.repeat(np.arange(n_texts), BANDS), np.repeat(repeating, fresh.sum(1))])
    order = np.argsort(text, kind="stable")
    return np.concatenate([keys.ravel(), of_sets[fresh]])[order], np.searchsorted(text[order], np.arange(n_texts + 1))


def sign(docs: DataFrame) -> DataFrame:
    """``doc_id, copy, bands``: a key of the exact text and the band keys (null without words)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part in slices(batches):
            data, offsets = text_buffer(part.column(1))
            of, hashes, occurrence = shingles(data, offsets)
            n = part.num_rows
            keys, bounds = bands_of(of, hashes, occurrence, n)
            empty = np.bincount(of, minlength=n) == 0
            bands = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(keys))
            bands = pa.array([None if none else row for none, row in zip(empty.tolist(), bands)], pa.list_(pa.int64())) if empty.any() else bands
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), bands], names=["doc_id", "copy", "bands"])

    keyed = docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("copy"))
    return keyed.mapInArrow(run, f"doc_id {kind}, copy binary, bands array<bigint>")


def verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose texts are similar: in their shingle multisets or their shingle sets."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches):
        last, held = None, None
        for batch in batches:
            a_ids, b_ids = batch.column(0), batch.column(1)
            keep = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column(2), batch.column(3))):
                a, b = a.as_py(), b.as_py()
                if a != last:  # rows of one leader come together
                    last, held = a, _units(a)
                keep[i] = _alike(held, _units(b), similarity)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([a_ids.filter(mask), b_ids.filter(mask)], names=["a", "b"])

    with_b = pairs.hint("merge").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.hint("merge").join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}")


def _units(text: str) -> tuple[np.ndarray, int]:
    raw = np.frombuffer(text.encode(), np.uint8)
    _, hashes, occurrence = shingles(raw, np.array([0, len(raw)]))
    return regions(hashes, occurrence), int((occurrence == 0).sum()), hashes[occurrence == 0]


def _alike(a, b, similarity: float) -> bool:
    common = len(np.intersect1d(a[0], b[0], assume_unique=True))
    if common >= similarity * (len(a[0]) + len(b[0]) - common):
        return True
    common = len(np.intersect1d(a[2], b[2], assume_unique=True))
    return common >= similarity * (a[1] + b[1] - common)


def _unit_lists(texts: DataFrame) -> DataFrame:
    """``doc_id, units``: the regions, those of first occurrences in front, and how many these are."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part in slices(batches):
            of, hashes, occurrence = shingles(*text_buffer(part.column(1)))
            units = regions(hashes, occurrence).astype("<u8")
            order = np.lexsort((occurrence > 0, of))
            of, units, occurrence = of[order], units[order], occurrence[order]
            bounds = np.searchsorted(of, np.arange(part.num_rows + 1))
            lists = [units[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            n_first = np.bincount(of[occurrence == 0], minlength=part.num_rows).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lists, pa.binary()), pa.array(n_first)], names=["doc_id", "units", "n_first"])

    return texts.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, units binary, n_first int")


class _Block:
    """Members of a bucket: their classes and units side by side."""

    def __init__(self, rows: list[dict]):
        self.ids = [r["doc_id"] for r in rows]
        self.component = np.array([r["component"] for r in rows])
        self.lists = [np.frombuffer(r["units"], "<u8") for r in rows]
        self.n_first = np.array([r["n_first"] for r in rows])
        self.size = np.array([len(units) for units in self.lists])
        owner = np.repeat(np.arange(len(rows)), self.size)
        units = np.concatenate(self.lists)
        starts = np.cumsum(self.size) - self.size
        is_first = np.arange(len(units)) < (starts + self.n_first)[owner]
        order = np.argsort(units, kind="stable")
        self.units, self.owner, self.is_first = units[order], owner[order], is_first[order]

    def like(self, units: np.ndarray, n_first: int, similarity: float) -> np.ndarray:
        """Members similar to a text with these units, as multisets or as sets."""
        low, high = np.searchsorted(self.units, units), np.searchsorted(self.units, units, "right")
        size = high - low
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        common = np.bincount(self.owner[at], minlength=len(self.ids))
        at = at[self.is_first[at]]
        of_first = np.bincount(self.owner[at], minlength=len(self.ids))
        return (common >= similarity * (self.size + len(units) - common)) | (of_first >= similarity * (self.n_first + n_first - of_first))


def _across(rest: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` between the classes of a bucket: one for every two classes with similar members, or more.

    Buckets are dealt into blocks of BLOCK members by a hash of the id; a task compares two
    blocks, and of those only members outside the blocks' commonest class with the rest. Members
    are compared by their whole regions, so that what is found needs no further look.
    """
    kind = rest.schema["doc_id"].dataType.simpleString()
    ids = rest.select("doc_id").distinct()
    units = _unit_lists(texts.join(ids.hint("merge"), "doc_id", "left_semi"))
    blocks = written(
        rest.withColumn("k", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("k")))
        .join(units.hint("merge"), "doc_id").groupBy("band", "k", "block")
        .agg(F.collect_list(F.struct("doc_id", "component", "units", "n_first")).alias("rows")), "blocks",
    )
    alone = blocks.select("rows", F.lit(None).cast(blocks.schema["rows"].dataType).alias("others"))
    several = blocks.where("k > 1").select("band", "block", "rows")
    two = several.join(several.select("band", F.col("block").alias("other"), F.col("rows").alias("others")), "band").where("block < other").select("rows", "others")

    def run(batches):
        for batch in batches:
            pairs = set()
            for i in range(batch.num_rows):
                a = _Block(batch.column(0)[i].as_py())
                b = _Block(other) if (other := batch.column(1)[i].as_py()) else a
                classes, counts = np.unique(np.concatenate([a.component, b.component]), return_counts=True)
                main = classes[counts.argmax()]
                for one, two in ((a, b), (b, a)) if b is not a else ((a, a),):
                    for at in np.flatnonzero(one.component != main).tolist():
                        alike = two.like(one.lists[at], one.n_first[at], similarity) & (two.component != one.component[at])
                        own = one.component[at]
                        pairs.update((min(own, other), max(own, other)) for other in set(two.component[alike].tolist()))
            kind_of = batch.column(0).type.value_type.field("doc_id").type
            first, second = zip(*sorted(pairs)) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(first, kind_of), pa.array(second, kind_of)], names=["a", "b"])

    return alone.union(two).mapInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, kept`` of every row; a class is linked by similarity, its id the least.

    Exact copies are one node. A bucket of equal band keys links each member to its least one;
    members that verification leaves in different classes are then compared across classes, so
    that no link is lost while a bucket of one class costs as many comparisons as it has members.
    ``kept`` marks the row whose id is the class's.

    A text without words, null or empty, is a class of its own; a row without ``doc_id`` has no
    class and is kept. Rows that repeat an id belong to one class. Extra columns are ignored.
    """
    signed = written(sign(docs), "signatures")
    nodes = written(
        signed.where("bands IS NOT NULL AND doc_id IS NOT NULL").groupBy("copy")
        .agg(F.min(F.struct("doc_id", "bands")).alias("first"), F.count(F.lit(1)).alias("n")), "nodes",
    )
    banded = nodes.select(F.col("first.doc_id").alias("doc_id"), F.explode("first.bands").alias("band"))
    leaders = written(banded.groupBy("band").agg(F.min("doc_id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1"), "leaders")
    members = written(banded.join(leaders, "band"), "members")
    pairs = written(members.where("leader <> doc_id").select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    # Joins that carry texts are dealt by key at every size, never by a copy of the other side.
    texts = written(docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi"), "texts")
    links = written(verify(pairs, texts, similarity), "verified")
    of = written(components(links), "components")
    # Buckets that still hold several classes: compare across them, in blocks of their members.
    placed = members.where("n > 2").join(of, F.col("id") == F.col("doc_id"), "left").select(
        "band", "doc_id", "n", F.coalesce("component", "doc_id").alias("component")
    )
    mixed = written(placed.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("band"), "mixed")
    rest = written(placed.join(mixed, "band"), "rest")
    # Links between classes join their classes: the members' own links are not walked again.
    joined = components(written(_across(rest, texts, similarity), "links-across"))
    copies = written(nodes.where("n > 1").select("copy", F.col("first.doc_id").alias("first")), "copies")
    named = signed.select("doc_id", F.when(F.col("bands").isNotNull(), F.col("copy")).alias("copy")).join(copies, "copy", "left").select(
        "doc_id", F.coalesce("first", "doc_id").alias("node")
    )
    classed = named.join(of, F.col("node") == F.col("id"), "left").select("doc_id", F.coalesce("component", "node").alias("class"))
    joined = joined.select(F.col("id").alias("class"), "component")
    final = classed.join(joined, "class", "left").select("doc_id", F.coalesce("component", "class").alias("class_id"))
    return final.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The row of each class whose id is the class's, with all its columns; of repeated ids one row.

    Rows without ``doc_id`` stay.
    """
    kept = near_duplicates(docs, similarity).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id IS NULL"))


def op1_dart_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
