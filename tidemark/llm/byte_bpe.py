"""Byte-level BPE by DuckDB recursive queries, one in-process engine per Spark task's worker.

Encoding: every match of the pattern is a word. Distinct words of a slice become token-position
rows, one per byte; a recursive query joins neighbouring tokens with the merge table and
contracts each word's leftmost minimum-rank pair until no pair merges. Words too long for one
query make the same contractions from a heap of pairs. Decoding: the ids are unnested with
their position, joined with the vocabulary and put together by an ordered aggregation.
"""

from __future__ import annotations

import base64
import functools
import heapq
from array import array

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from tidemark.llm.text import extended, slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Words whose ids a worker remembers; then it forgets them all and goes on.
REMEMBERED = 400_000
# Token-position rows, over all iterations, that one recursive query may make.
QUERY_ROWS = 1_500_000
ROUND = 128
SLICE_BYTES = 2 << 20

# A row is a token of a word: its place, the place and token of its right neighbour, and as
# ``best`` the rank of the two as one token above both places (null when they don't merge). The
# pair at p is contracted into its right place n, so that places keep their order; a word
# without a mergeable pair drops out with the rows it has.
_ENCODE = """
WITH RECURSIVE tokens AS (
  SELECT b.word, b.place, b.place + 1 AS after, b.token, b.next,
    (m.rank::BIGINT << 40) | (b.place::BIGINT << 20) | (b.place + 1)::BIGINT AS best, 0 AS step
  FROM start b LEFT JOIN merges m ON m.pair = b.token::BIGINT * 16777216 + b.next
  UNION ALL
  SELECT c.word, c.place, c.after, c.token, c.next, (m.rank::BIGINT << 40) | (c.place::BIGINT << 20) | c.after::BIGINT, c.step
  FROM (
    SELECT t.word, t.place, CASE WHEN t.after = f.p THEN f.n ELSE t.after END AS after,
      CASE WHEN t.place = f.n THEN f.rank ELSE t.token END AS token,
      CASE WHEN t.after = f.p THEN f.rank ELSE t.next END AS next, t.step + 1 AS step
    FROM tokens t JOIN (
      SELECT word, (b >> 40)::INTEGER AS rank, ((b >> 20) & 1048575)::INTEGER AS p, (b & 1048575)::INTEGER AS n
      FROM (SELECT word, min(best) AS b FROM tokens WHERE step < $round GROUP BY word) WHERE b IS NOT NULL) f USING (word)
    WHERE t.place <> f.p) c
  LEFT JOIN merges m ON m.pair = c.token::BIGINT * 16777216 + c.next)
SELECT word, place, token, best IS NULL AS final FROM tokens JOIN (SELECT word, max(step) AS step FROM tokens GROUP BY word) USING (word, step)
ORDER BY word, place
"""
# Places of a word have 20 bits there; longer words, and those whose round alone has more than
# QUERY_ROWS rows, don't go there.
LONGEST_WORD = (1 << 20) - 2

_DECODE = """
SELECT string_agg(v.bytes, '' ORDER BY u.place)
FROM (SELECT unnest(ids) AS id, generate_subscripts(ids, 1) AS place FROM given) u JOIN vocabulary v USING (id)
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder over one vocabulary; lives in a worker process."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.blank = np.zeros(max(self.ranks.values()) + 1, bool)
        self.blank[[rank for token, rank in self.ranks.items() if token[:1] == b" "]] = True
        self.size = np.zeros(len(self.blank), np.int64)
        self.size[list(self.ranks.values())] = [len(token) for token in self.ranks]
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, bytes] = {}
        self.decoded: dict[bytes, bytes] = {}
        self.engine = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "preserve_insertion_order": False})
        merges = [
            (self.ranks[token[:cut]], self.ranks[token[cut:]], rank)
            for token, rank in self.ranks.items() for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        ]
        a, b, rank = (np.array(x, np.int64) for x in zip(*merges))
        # Bytes travel as characters of the same number; 256 stands for the byte 0.
        vocabulary = pa.table({
            "id": pa.array(list(self.ranks.values()), pa.int32()),
            "bytes": pa.array([token.decode("latin-1").replace("\0", "Ā") for token in self.ranks]),
        })
        self._table("merges", pa.table({"pair": a * 16777216 + b, "rank": rank.astype(np.int32)}))
        self._table("vocabulary", vocabulary)

    def _table(self, name: str, rows: pa.Table) -> None:
        self.engine.register("rows", rows)
        self.engine.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
        self.engine.unregister("rows")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as little-endian 32-bit integers."""
        words = [self.pattern.findall(text) for text in texts]
        self._learn(set().union(*words))
        ids = self.known.__getitem__
        return [b"".join(map(ids, found)) for found in words]

    def _learn(self, words: set[str]) -> None:
        """Find the ids of the words that are not known yet."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        pending: list[tuple[str, bytes]] = []
        cost = 0
        for word in words.difference(self.known):
            raw = word.encode()
            if raw in self.ranks:  # a word that is a token needs no merges
                self.known[word] = self.ranks[raw].to_bytes(4, "little")
                continue
            if len(raw) > min(QUERY_ROWS // ROUND, LONGEST_WORD):
                self.known[word] = self._contract_long(raw)
                continue
            pending.append((word, raw))
            cost += len(raw) * min(len(raw), ROUND)
            if cost > QUERY_ROWS:
                self._contract(pending)
                pending, cost = [], 0
        if pending:
            self._contract(pending)

    def _contract_long(self, raw: bytes) -> bytes:
        """Packed ids of a word of any length, the same contractions in the same order by a heap of pairs.

        A pair is its rank above its place; one that a contraction nearby has changed is passed over.
        """
        n = len(raw)
        before, after = array("q", range(-1, n)), array("q", range(1, n + 2))  # of the token at a place; 0 after: contracted
        rank_of = self.ranks.get
        pairs = [r << 40 | p for p in range(n - 1) if (r := rank_of(raw[p : p + 2])) is not None]
        heapq.heapify(pairs)
        while pairs:
            best = heapq.heappop(pairs)
            rank, p = best >> 40, best & ((1 << 40) - 1)
            gone = after[p]
            if not gone or gone >= n or rank_of(raw[p : after[gone]]) != rank:
                continue
            after[p] = following = after[gone]
            before[following] = p
            after[gone] = 0
            if following < n and (r := rank_of(raw[p : after[following]])) is not None:
                heapq.heappush(pairs, r << 40 | p)
            if p and (r := rank_of(raw[before[p] : following])) is not None:
                heapq.heappush(pairs, r << 40 | before[p])
        ids, p = array("q"), 0
        while p < n:
            ids.append(self.ranks[raw[p : after[p]]])
            p = after[p]
        return np.array(ids, "<u4").tobytes()

    def _contract(self, pending: list[tuple[str, bytes]]) -> None:
        lengths = np.array([len(raw) for _, raw in pending])
        word = np.repeat(np.arange(len(pending), dtype=np.int32), lengths)
        token = self.byte_ids[np.frombuffer(b"".join(raw for _, raw in pending), np.uint8)]
        while len(word):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            place = np.arange(len(word)) - np.repeat(first, np.diff(np.r_[first, len(word)]))
            last = np.r_[word[1:] != word[:-1], True]
            following = pa.array(np.r_[token[1:], 0].astype(np.int32), mask=last)
            self.engine.register("start", pa.table({
                "word": word, "place": place.astype(np.int32), "token": token.astype(np.int32), "next": following,
            }))
            done = self.engine.sql(_ENCODE, params={"round": ROUND}).to_arrow_table()
            self.engine.unregister("start")
            word = done.column("word").to_numpy()
            token = done.column("token").to_numpy()
            open_words = np.zeros(len(pending), bool)
            open_words[word[~done.column("final").to_numpy()]] = True
            going_on = open_words[word]
            ended, ids = word[~going_on], token[~going_on].astype("<u4")
            bounds = np.flatnonzero(np.r_[True, ended[1:] != ended[:-1]]) if len(ended) else np.zeros(0, int)
            packed = ids.tobytes()
            for a, b in zip(bounds.tolist(), np.r_[bounds[1:], len(ended)].tolist()):
                self.known[pending[ended[a]][0]] = packed[4 * a : 4 * b]
            word, token = word[going_on], token[going_on].astype(np.int64)

    def decode(self, rows: list[bytes]) -> list[bytes]:
        """Bytes of packed ids; unknown ids raise.

        Ids are cut before tokens that begin with a blank; equal parts are decoded once.
        """
        every = np.frombuffer(b"".join(rows), "<u4")
        sizes = np.array([0] + [len(ids) // 4 for ids in rows])
        edges = np.cumsum(sizes)
        cut = self.blank[every]
        cut[edges[:-1][edges[:-1] < len(every)]] = True
        cuts = np.flatnonzero(cut)
        packed = every.tobytes()
        bounds = np.r_[cuts, len(every)] * 4
        parts = [packed[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        if len(self.decoded) > REMEMBERED:
            self.decoded.clear()
        new = list(set(parts).difference(self.decoded))
        for start in range(0, len(new), 50_000):
            self._join_tokens(new[start : start + 50_000])
        texts = list(map(self.decoded.__getitem__, parts))
        first = np.searchsorted(cuts, edges).tolist()
        return [b"".join(texts[a:b]) for a, b in zip(first[:-1], first[1:])]

    def _join_tokens(self, parts: list[bytes]) -> None:
        ids = np.frombuffer(b"".join(parts), "<u4").astype(np.int32)
        self.engine.register("given", pa.table({"ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids))}))
        text = self.engine.execute(_DECODE).fetchall()[0][0].replace("Ā", "\0").encode("latin-1")
        self.engine.unregister("given")
        ends = np.cumsum(self.size[ids])
        if len(text) < ends[-1]:
            raise ValueError("ids outside the vocabulary")
        start = 0
        for part, end in zip(parts, ends[np.cumsum([len(part) // 4 for part in parts]) - 1].tolist()):
            self.decoded[part] = text[start:end]
            start = end


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text, packed as little-endian 32-bit integers.

    A null text is an empty one and has no ids. Every input row gives one row, repeated rows
    too; columns besides ``doc_id`` and ``text`` are ignored. An empty table gives no rows.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches):
        own = codec(path)
        for part in slices(batches, limit=SLICE_BYTES):
            texts = part.column(1).to_pylist()
            packed = pa.array(own.encode(texts), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), packed], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids, bytes`` of packed ids; null ids give empty bytes."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches):
        own = codec(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = part.column(1).fill_null(b"").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(own.decode(ids), pa.binary())], names=["doc_id", "ids", "bytes"]
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, bytes binary")


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` of each text, packed, and ``decoded``, the bytes of those ids; nulls are empty."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def make(texts):
        own = codec(path)
        ids = own.encode(texts.to_pylist())
        return [pa.array(ids, pa.binary()), pa.array(own.decode(ids), pa.binary())]

    return extended(docs, make, [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())], SLICE_BYTES)


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return decode(encode(docs)).selectExpr(
        "doc_id", "bigint(length(ids) / 4) AS n_tokens", "sha2(ids, 256) AS ids_sha256", "sha2(bytes, 256) AS decoded_sha256"
    )
