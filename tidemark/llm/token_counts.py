"""Token counts by scanning flat token streams for end-of-document ids.

A stream is a sequence of ids, cut into blocks without regard to documents and without any
index. Every block is searched on its own, all of its ids at once; what reaches over block
edges is stitched by prefix sums over the block summaries of a stream.
"""

from __future__ import annotations

import functools

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.byte_bpe import VOCABULARY, read_ranks
from tidemark.llm.text import slices
from tidemark.session import fresh_path

BLOCK_TOKENS = 1 << 16


@functools.cache
def _tokenizer(path: str) -> tuple[tiktoken.Encoding, int]:
    """The tokenizer, and the first free id, which ends documents."""
    ranks = read_ranks(path)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1


def id_type(eod: int) -> str:
    """Width of the ids in a stream: as narrow as the largest id allows."""
    return "<u2" if eod < 1 << 16 else "<u4"


def write_streams(docs: DataFrame, vocabulary: str | None = None, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, int]:
    """Token streams of all whole texts, written to the shared folder; and the id that ends documents.

    Rows with ``tokens`` are blocks (``stream``, ``place`` of the block); rows without are the
    names of a stream's documents in order (``stream``, ``place`` of the document, ``doc_id``).
    Each task's rows become one stream, so that a task that runs again writes the same one.
    """
    spark = docs.sparkSession
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    _, eod = _tokenizer(path)
    kind = docs.schema["doc_id"].dataType
    schema = f"stream int, place bigint, doc_id {kind.simpleString()}, tokens binary"

    def run(batches):
        encoding, end = _tokenizer(path)
        width = id_type(end)
        stream = TaskContext.get().partitionId()
        pending: list[np.ndarray] = []
        held = blocks = named = 0

        def rows(places, ids, tokens):
            n = len(places)
            return pa.RecordBatch.from_arrays(
                [pa.array([stream] * n, pa.int32()), pa.array(places, pa.int64()), ids, pa.array(tokens, pa.binary())],
                names=["stream", "place", "doc_id", "tokens"],
            )

        for part in slices(batches):
            for text in part.column(1).to_pylist():
                ids = np.array(encoding.encode_ordinary(text) + [end], width)
                pending.append(ids)
                held += len(ids)
            yield rows(range(named, named + part.num_rows), part.column(0), [None] * part.num_rows)
            named += part.num_rows
            empty = pa.nulls(0, part.column(0).type)
            flat = np.concatenate(pending)
            full = held // block_tokens
            for block in range(full):
                cut = flat[block * block_tokens : (block + 1) * block_tokens].tobytes()
                yield rows([blocks], pa.nulls(1, empty.type), [cut])
                blocks += 1
            pending = [flat[full * block_tokens :]]
            held = len(pending[0])
        if held:
            yield rows([blocks], pa.nulls(1, empty.type), [pending[0].tobytes()])

    target = fresh_path(spark, "token-streams")
    docs.select("doc_id", "text").mapInArrow(run, schema).write.option("compression", "zstd").parquet(target)
    return spark.read.schema(schema).parquet(target), eod


def scan_blocks(blocks: DataFrame, eod: int) -> DataFrame:
    """Per block: ids before its first end (``head``), after its last (``tail``), lengths between.

    A block without an end has its whole length as ``tail`` and a null ``head``.
    """
    width = id_type(eod)

    def run(batches):
        for batch in batches:
            heads, tails, inner = [], [], []
            for raw in batch.column(2).to_pylist():
                ids = np.frombuffer(raw, width)
                ends = np.flatnonzero(ids == eod)
                heads.append(int(ends[0]) if len(ends) else None)
                tails.append(len(ids) - 1 - int(ends[-1]) if len(ends) else len(ids))
                inner.append((np.diff(ends) - 1).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(heads, pa.int64()), pa.array(tails, pa.int64()), pa.array(inner, pa.list_(pa.int64()))],
                names=["stream", "place", "head", "tail", "inner"],
            )

    return blocks.select("stream", "place", "tokens").mapInArrow(run, "stream int, place bigint, head bigint, tail bigint, inner array<bigint>")


def count_tokens(blocks: DataFrame, eod: int) -> DataFrame:
    """``stream, place, n_tokens`` of every document of the streams, by number within its stream.

    ``blocks`` has ``stream``, ``place`` (of the block) and ``tokens``. What a document has
    before the block in which it ends is a difference of running sums: of ids outside complete
    documents, at its end block and at the last end before. A stream that stops without an end
    has an unfinished last document, which is not counted.
    """
    scanned = scan_blocks(blocks, eod)
    order = Window.partitionBy("stream").orderBy("place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # Ids of a document that is open at the block's start: all tails since the last block with an end.
    summed = scanned.select(
        "*", F.coalesce(F.sum("tail").over(before), F.lit(0)).alias("tails"),
        F.coalesce(F.sum(F.when(F.col("head").isNotNull(), F.size("inner") + 1).otherwise(0)).over(before), F.lit(0)).alias("first"),
    )
    opened = summed.select(
        "*", F.coalesce(F.last(F.when(F.col("head").isNotNull(), F.col("tails")), ignorenulls=True).over(before), F.lit(0)).alias("closed"),
    )
    lengths = opened.where("head IS NOT NULL").select(
        "stream", "first", F.concat(F.array(F.col("head") + F.col("tails") - F.col("closed")), "inner").alias("lengths")
    )
    return lengths.select("stream", "first", F.posexplode("lengths").alias("i", "n_tokens")).select(
        "stream", (F.col("first") + F.col("i")).alias("place"), "n_tokens"
    )


def document_tokens(docs: DataFrame, vocabulary: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, n_tokens`` of every row, counted in the token streams made of the rows.

    Null and empty texts have no tokens. Repeated rows and rows without ``doc_id`` are counted
    each; extra columns are ignored; an empty table gives no rows.
    """
    streams, eod = write_streams(docs, vocabulary, block_tokens)
    counts = count_tokens(streams.where("tokens IS NOT NULL"), eod)
    names = streams.where("tokens IS NULL").select("stream", "place", "doc_id")
    return names.join(counts, ["stream", "place"]).select("doc_id", "n_tokens")


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    return document_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
