"""Fill-in-the-middle examples: two cuts per text, found in Fenwick trees over fixed blocks.

A text is laid out in blocks of 256 bytes. Two Fenwick trees per text hold, for every block, how
many units end in it and how many code points begin in it. A cut after so many units is found by
binary lifting: the descent ends at the block that holds the cut, knowing the units and code
points before it, and only that block is searched for the boundary. All texts of a slice descend
together.

A unit is a word with the white space before it; white space after the last word is a unit too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.text import _SPACE, slices, text_buffer

BLOCK_BYTES = 256
# Cuts whose blocks are searched at once.
CUTS_AT_ONCE = 4_096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIELDS = [
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()),
]


class BlockTrees:
    """Fenwick trees of all texts of a buffer; the tree of text t is rows first[t] .. first[t] + blocks[t] - 1."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.offsets = offsets
        sizes = np.diff(offsets)
        solid = ~_SPACE[data]
        # A unit ends where a word ends and where its text ends.
        self.unit_end = np.zeros(len(data), bool)
        self.unit_end[:-1] = solid[:-1] & ~solid[1:]
        self.unit_end[offsets[1:][sizes > 0] - 1] = True
        self.begins = (data & 0xC0) != 0x80
        self.blocks = -(-sizes // BLOCK_BYTES)
        self.first = np.cumsum(self.blocks) - self.blocks
        place = np.arange(self.blocks.sum()) - np.repeat(self.first, self.blocks)
        starts = np.repeat(offsets[:-1], self.blocks) + place * BLOCK_BYTES
        self.units = self._tree(np.add.reduceat(self.unit_end, starts, dtype=np.int64) if len(starts) else starts, place + 1)
        self.points = self._tree(np.add.reduceat(self.begins, starts, dtype=np.int64) if len(starts) else starts, place + 1)

    def _tree(self, counts: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Counts of single blocks to counts of the ranges of a Fenwick tree, one step length at a time."""
        inside = np.repeat(self.blocks, self.blocks)
        step = 1
        while step < self.blocks.max(initial=0):
            child = np.flatnonzero(((place & -place) == step) & (place + step <= inside))
            counts[child + step] += counts[child]
            step *= 2
        return counts

    def totals(self) -> np.ndarray:
        """Units of every text: the sum over its tree's last descent."""
        total = np.zeros(len(self.blocks), np.int64)
        at = self.blocks.copy()
        while (left := np.flatnonzero(at)).size:
            total[left] += self.units[self.first[left] + at[left] - 1]
            at[left] &= at[left] - 1
        return total

    def cut(self, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte and code point, counted from the text's begin, after ``after[t]`` units of text t."""
        texts = np.flatnonzero(after > 0)
        left, first, blocks = after[texts].copy(), self.first[texts], self.blocks[texts]
        at, points = np.zeros_like(left), np.zeros_like(left)
        step = 1 << int(blocks.max(initial=1)).bit_length() - 1
        while step:
            row = first + np.minimum(at + step, blocks) - 1
            passed = (at + step <= blocks) & (self.units[row] < left)
            left -= np.where(passed, self.units[row], 0)
            points += np.where(passed, self.points[row], 0)
            at += np.where(passed, step, 0)
            step >>= 1
        byte = np.zeros_like(left)
        for some in range(0, len(texts), CUTS_AT_ONCE):
            part = slice(some, some + CUTS_AT_ONCE)
            start, end = self.offsets[texts[part]] + at[part] * BLOCK_BYTES, self.offsets[texts[part] + 1]
            index = start[:, None] + np.arange(BLOCK_BYTES)
            valid = index < end[:, None]
            index = np.minimum(index, end[:, None] - 1)
            found = ((self.unit_end[index] & valid).cumsum(axis=1) == left[part, None]).argmax(axis=1)
            byte[part] = at[part] * BLOCK_BYTES + found + 1
            points[part] += (self.begins[index] & valid & (np.arange(BLOCK_BYTES) <= found[:, None])).sum(axis=1)
        cuts, chars = np.zeros(len(after), np.int64), np.zeros(len(after), np.int64)
        cuts[texts], chars[texts] = byte, points
        return cuts, chars


def _examples(text: pa.Array, form: list[str], h1: np.ndarray, h2: np.ndarray) -> list[pa.Array]:
    data, offsets = text_buffer(text)
    trees = BlockTrees(data, offsets)
    n = trees.totals()
    one, two = h1 % (n + 1), h2 % (n + 1)
    cut = np.array([f != "plain" for f in form], bool)
    prefix, prefix_chars = trees.cut(np.where(cut, np.minimum(one, two), 0))
    middle, middle_chars = trees.cut(np.where(cut, np.maximum(one, two), 0))
    raw = data.tobytes()
    outputs = []
    for kind, start, a, b, end in zip(form, offsets[:-1].tolist(), prefix.tolist(), middle.tolist(), offsets[1:].tolist()):
        head, inner, tail = raw[start : start + a], raw[start + a : start + b], raw[start + b : end]
        if kind == "plain":
            outputs.append(raw[start:end])
        elif kind == "psm":
            outputs.append(b"<P>" + head + b"<S>" + tail + b"<M>" + inner)
        else:
            outputs.append(b"<S>" + tail + b"<P>" + head + b"<M>" + inner)
    plain = ~cut
    return [
        pa.array(n), pa.array(form, pa.string()), pa.array(prefix_chars, pa.int64(), mask=plain),
        pa.array(middle_chars - prefix_chars, pa.int64(), mask=plain), pa.array(outputs, pa.binary()).cast(pa.string()),
    ]


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, suffix_first: int = 80) -> DataFrame:
    """``docs`` with ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text.

    ``rate`` of 100 texts are cut, ``suffix_first`` of 100 of these into the form ``spm``. Draws
    come from the SHA-256 of seed and ``doc_id``, so that they repeat on retry and at every size;
    rows without ``doc_id`` draw as if it were an empty string. Null texts read as empty; empty
    texts and texts with a marker stay plain. Repeated rows give repeated results; columns of the
    result's names are replaced, others kept; an empty table gives no rows.
    """
    fresh = {field.name for field in FIELDS}
    docs = docs.select(*[F.col(f"`{name}`") for name in docs.columns if name.lower() not in fresh])
    draw = "draw"
    while draw in {name.lower() for name in docs.columns}:
        draw += "_"
    text = F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)

    def number(group: int) -> Column:
        return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("bigint")

    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | marked | (number(2) % 100 >= rate), "plain").when(number(3) % 100 < suffix_first, "spm").otherwise("psm")
    drawn = docs.withColumn(draw, F.struct(number(0).alias("h1"), number(1).alias("h2"), form.alias("form")))
    place = drawn.columns.index("text")

    def run(batches):
        for batch in batches:
            start = 0
            for part in slices([batch], place):
                old = batch.slice(start, part.num_rows)
                start += part.num_rows
                h1, h2, kind = part.column(part.num_columns - 1).flatten()
                made = _examples(part.column(place), kind.to_pylist(), h1.to_numpy(), h2.to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [*old.columns[:-1], *made], names=[*batch.schema.names[:-1], *(field.name for field in FIELDS)]
                )

    return drawn.mapInArrow(run, T.StructType([*docs.schema.fields, *FIELDS]))


def restored(output: Column, form: Column) -> Column:
    """The exact text of an output: no part holds a marker, so the first ones are the real ones."""

    def parts(separator: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(PREFIX) + 1))
        one = F.substring_index(body, separator, 1)
        rest = F.substr(body, F.length(one) + len(separator) + 1)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substr(rest, F.length(two) + len(MIDDLE) + 1)

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), d AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS two,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:least(one, two)], '') AS a,
    array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS b, array_to_string(units[greatest(one, two) + 1:], '') AS c
  FROM d
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(b)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
