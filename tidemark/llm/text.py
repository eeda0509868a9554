"""Texts as byte buffers: bounded slices of Arrow batches, words and their hashes in NumPy."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

SLICE_BYTES = 4 << 20

# White space of the word pattern [^\x20\x09-\x0D]+.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

# Plain words are runs of ASCII letters and digits and of other characters, in lower case.
_PLAIN = np.array([chr(i).isalnum() or i > 127 for i in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_draw = random.Random(20_240_607)
_BYTE_VALUES = np.array([_draw.getrandbits(64) for _ in range(256)], np.uint64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches, column: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with at most about ``limit`` bytes of text, one row at least.

    Nulls of the text column read as empty texts.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(column).fill_null("").cast(pa.large_string())
        columns = list(batch.columns)
        columns[column] = text
        batch = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
        _, offsets = text_buffer(text)
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def extended(docs: DataFrame, make: Callable[[pa.Array], list[pa.Array]], fields: list[T.StructField], limit: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with the columns that ``make`` has for a slice of texts (nulls read as empty there).

    All columns stay as they are, except that a new one replaces one of its name, in any case.
    """
    fresh = {field.name.lower() for field in fields}
    docs = docs.select(*[F.col(f"`{name}`") for name in docs.columns if name.lower() not in fresh])
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            start = 0
            for part in slices([batch], place, limit):
                old = batch.slice(start, part.num_rows)
                start += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*old.columns, *make(part.column(place))], names=[*batch.schema.names, *(field.name for field in fields)]
                )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def text_buffer(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a large_string array, and where each begins and the last ends."""
    _, ends, data = text.buffers()
    offsets = np.frombuffer(ends, np.int64)[text.offset : text.offset + len(text) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(text) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        table = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        table[0] = 1
        have = _powers[base] = np.multiply.accumulate(table)
        if n > 4 * SLICE_BYTES:
            del _powers[base]  # one very long text must not stay in memory
    return have[:n]


def words(data: np.ndarray, offsets: np.ndarray, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every word: text number, first byte, byte after the last, 64-bit hash of its bytes.

    A word is what stands between white space; with ``plain`` it is rid of ASCII signs and capitals.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    solid = _PLAIN[data] if plain else ~_SPACE[data]
    if plain:
        data = _LOWER[data]
    edge = np.ones(n + 1, bool)
    edge[1:n] = ~solid[:-1]
    edge[offsets[offsets < n]] = True
    starts = np.flatnonzero(solid & edge[:-1])
    after = np.ones(n, bool)
    after[:-1] = ~solid[1:] | edge[1:n]
    ends = np.flatnonzero(solid & after) + 1
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    values = _BYTE_VALUES[data]
    values *= powers(_BASE, n)
    values[~solid] = 0
    sums = np.add.reduceat(values, starts)
    hashes = mix(sums * powers(pow(_BASE, -1, 1 << 64), n)[starts])
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends, hashes


def runs(of: np.ndarray, n: int) -> np.ndarray:
    """Where the entries of each number 0..n-1 begin in the sorted ``of``; n + 1 bounds."""
    return np.searchsorted(of, np.arange(n + 1))


def lowest_hashes(rows: DataFrame, by: str, size: Column, enough: int) -> DataFrame:
    """Of every group ``by``, distinct texts in order of a hash until their sizes reach ``enough``.

    ``rows`` has the columns ``text`` and ``by``; added is ``draw``, the hash. A group that has less
    gives all its texts. Hashes are counted by bands whose width grows with the hash, some 500 a
    group at every table size; the last band taken adds about a tenth. Copies count once.
    """
    hashed = rows.withColumn("draw", F.expr("shiftrightunsigned(xxhash64(text), 2)"))
    band = F.floor(8 * F.log2(F.col("draw") + F.lit(1.0))).cast("int")
    sized = hashed.select(by, "draw", size.alias("size")).groupBy(by, "draw").agg(F.max("size").alias("size"))
    bands = sized.groupBy(by, band.alias("band")).agg(F.sum("size").alias("size"))
    before = F.sum("size").over(Window.partitionBy(by).orderBy("band").rowsBetween(Window.unboundedPreceding, -1))
    needed = bands.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < enough)
    last = {row[by]: row["band"] for row in needed.groupBy(by).agg(F.max("band").alias("band")).collect()}
    if not last:
        return hashed.limit(0)
    pairs = [F.lit(x) for pair in last.items() for x in pair]
    return hashed.where(band <= F.create_map(*pairs)[F.col(by)]).dropDuplicates([by, "draw"])
