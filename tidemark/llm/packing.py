"""Cost-balanced packing of token documents into sequences of one length.

A bucket of documents opens exactly as many sequences as its tokens fill. Documents, longest
first, go to the sequence with the lowest estimated cost (linear plus quadratic attention cost of
what it holds) among those with enough room. A document longer than a sequence is first cut into
whole sequences and a rest; one that fits nowhere any more fills the cheapest rooms left.

Sequences are padded to their length unless they have a power of two tokens, so the tokens beyond
the last whole sequence of a bucket open sequences of powers of two: nothing is padded.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tidemark.llm.text import slices

VOCABULARY = "word_bpe_49k.json"
SEQUENCE_TOKENS = 2_048
END_ID = 1
# Documents are packed together until they have so many tokens, one document at least.
BUCKET_TOKENS = 1 << 22
# Cost of n tokens that attend to each other: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 2_048
# Words whose ids a worker remembers; then it forgets them all and goes on.
REMEMBERED = 1_000_000
# Bytes of a text whose words are listed at once.
RUN_BYTES = 1 << 20
_SPACES = b" \t\n\r\x0b\x0c"
# Parts of a word whose ids don't depend on what stands beside them: the matches of the tokenizer's
# own pattern, as they are for printable ASCII.
_PARTS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+", re.IGNORECASE)
_PRINTABLE = re.compile(rb"[\x21-\x7e]*").fullmatch


class WordIds(dict):
    """Ids of words as little-endian 32-bit integers, found when first asked for.

    A word stands between ASCII white space: the tokenizer's pattern never reaches over white
    space and its normalization never joins over it. Words of printable ASCII need no more of it
    than lower case before the merges; others go through all of it.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.merge = self.tokenizer.model.tokenize

    def encode(self, raw: bytes) -> bytes:
        """Ids of a whole text."""
        return b"".join([b"".join(map(self.__getitem__, run.split())) for run in _runs(raw)])

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        if not _PRINTABLE(word):
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        elif word.isalpha() or len(parts := _PARTS.findall(word)) == 1:
            ids = [token.id for token in self.merge(word.decode().lower())]
        else:
            self[word] = joined = b"".join([self[part] for part in parts])
            return joined
        self[word] = found = struct.pack(f"<{len(ids)}I", *ids)
        return found


def _runs(raw: bytes) -> Iterator[bytes]:
    """A text in runs of bounded size that end at white space."""
    at = 0
    while at < len(raw):
        end = at + RUN_BYTES
        while end < len(raw) and raw[end] not in _SPACES:
            end += 1
        yield raw[at:end]
        at = end


@functools.cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def capacities(tokens: int, size: int = SEQUENCE_TOKENS) -> np.ndarray:
    """Lengths of the sequences that ``tokens`` fill: whole ones, then powers of two, descending."""
    rest = tokens % size
    powers = [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    return np.array([size] * (tokens // size) + powers, np.int64)


def assign(lengths: list[int], size: int = SEQUENCE_TOKENS, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of every piece of documents of these lengths."""
    room = capacities(sum(lengths), size)
    cost = np.zeros(len(room))
    filled = np.zeros(len(room), np.int64)
    pieces = [(min(size, n - start), doc, start) for doc, n in enumerate(lengths) for start in range(0, n, size)]
    pieces.sort(key=lambda piece: (-piece[0], piece[1], piece[2]))
    placed = []
    for length, doc, start in pieces:
        while length:
            fits = room >= length
            if not fits.any():
                fits = room > 0
            to = int(np.where(fits, cost, np.inf).argmin())
            part = min(length, int(room[to]))
            placed.append((doc, start, part, to, int(filled[to])))
            room[to] -= part
            filled[to] += part
            cost[to] += linear * part + quadratic * part * part
            length -= part
            start += part
    return placed


def pack(docs: DataFrame, size: int = SEQUENCE_TOKENS, vocabulary: str | None = None, end_id: int = END_ID, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """Pieces ``doc_id, start, length, ids, doc_tokens, sequence_id, offset`` of all whole texts.

    ``ids`` are little-endian unsigned 32-bit integers; every document ends with ``end_id``. Null
    and empty texts are that id alone. Repeated rows and rows without ``doc_id`` are packed each;
    extra columns are ignored; an empty table gives no rows. Every partition is packed by itself
    in buckets, without a shuffle; a sequence's number holds that of its partition.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"

    def run(batches):
        encoder = _word_ids(path)
        sequence = TaskContext.get().partitionId() << 40
        ending = np.array([end_id], "<u4").tobytes()
        names: list[pa.Array] = []
        ids: list[bytes] = []
        held = 0

        def packed():
            lengths = [len(x) // 4 for x in ids]
            doc, start, length, to, offset = (np.array(x, np.int64) for x in zip(*assign(lengths, size)))
            order = np.lexsort((start, doc))
            doc, start, length, to, offset = doc[order], start[order], length[order], to[order], offset[order]
            cut = [ids[d][4 * s : 4 * (s + n)] for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
            columns = [
                pa.concat_arrays(names).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(cut, pa.binary()),
                pa.array(np.array(lengths)[doc]), pa.array(sequence + to), pa.array(offset),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=pa.schema([pa.field(n, c.type) for n, c in zip(header, columns)])), int(to.max()) + 1

        header = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for part in slices(batches):
            # Texts are taken one by one, so that a bucket holds little more than its tokens.
            for row, text in enumerate(part.column(1)):
                ids.append(encoder.encode(text.as_buffer().to_pybytes()) + ending)
                names.append(part.column(0).slice(row, 1))
                held += len(ids[-1]) // 4
                if held >= bucket_tokens:
                    rows, used = packed()
                    sequence += used
                    names, ids, held = [], [], 0
                    yield rows
        if ids:
            yield packed()[0]

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op12_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
