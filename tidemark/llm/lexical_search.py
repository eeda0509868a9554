"""Ranked lexical search by the Best Position Algorithm over impact lists.

The documents of a task are cut into shards of a bounded number of postings. In a shard every term
of the queries has an impact list: its documents by descending impact. A query reads its lists from
their best positions on (all entries before a best position are seen) and scores each document it
meets by direct accesses to all its lists, which marks the document's entries as seen everywhere. So
best positions run ahead of the reading depth, and the impacts at them bound what an unseen document
can reach. A query stops when that bound lies strictly below its k-th score; an equal bound could
still hide a tie. Its k best documents stay with the task from shard to shard; Spark merges those
of the tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.text import slices
from tidemark.session import written

TOP = 20
# Items are searched in blocks of about so many characters, which bounds terms, lists and broadcasts.
BLOCK_CHARS = 4 << 20
# Postings of a shard, one document at least.
SHARD_POSTINGS = 1 << 21
# Entries read from every list at first; doubled in each round.
DEPTH = 64
# Postings looked up at once by direct accesses.
ACCESSES = 1 << 20
# Bytes of a text whose terms are listed at once.
RUN_BYTES = 1 << 20
# Parts into which a query's results are dealt before they are merged.
PARTS = 32

# Terms are runs of ASCII letters, in lower case, digits and all other characters beyond ASCII.
_CLEAN = bytes(i + 32 if 65 <= i <= 90 else i if i > 127 or chr(i).isalnum() else 32 for i in range(256))


def term_runs(raw: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in lists of bounded size."""
    clean = raw.translate(_CLEAN)
    at = 0
    while at < len(clean):
        end = clean.find(b" ", at + RUN_BYTES)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def term_counts(raw: bytes) -> Counter[bytes]:
    counts: Counter[bytes] = Counter()
    for run in term_runs(raw):
        counts.update(run)
    return counts


def index_documents(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term; ``terms`` are those of the vocabulary.

    ``n`` counts all terms with repeats.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        number = shared.value
        for part in slices(batches):
            lengths, bounds, terms, tfs = [], [0], [], []
            for text in part.column(1):
                counts = term_counts(text.as_buffer().to_pybytes())
                lengths.append(counts.total())
                for term in counts.keys() & number.keys():
                    terms.append(number[term])
                    tfs.append(counts[term])
                bounds.append(len(terms))
            columns = [
                part.column(0), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tfs, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")
    return rows.where("n > 0")


def weight(documents: int, frequency: int) -> int:
    return math.floor(1_000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


class Best:
    """The k best documents of a query so far: highest scores, then lowest ids, none last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.nameless, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def bar(self) -> int:
        """Score below which nothing enters."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, nameless: np.ndarray, ids: np.ndarray) -> None:
        enters = scores >= self.bar
        if not enters.any():
            return
        scores = np.concatenate([self.scores, scores[enters]])
        nameless, ids = np.concatenate([self.nameless, nameless[enters]]), np.concatenate([self.ids, ids[enters]])
        order = np.lexsort((ids, nameless, -scores))[: self.k]
        self.scores, self.nameless, self.ids = scores[order], nameless[order], ids[order]


class Shard:
    """Impact lists over some documents, and each document's own postings for direct accesses."""

    def __init__(self, batches: list[pa.RecordBatch], weights: np.ndarray, documents: int, length: int):
        ids = pa.concat_arrays([b.column(0) for b in batches])
        self.nameless = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        n = np.concatenate([b.column(1).to_numpy() for b in batches])
        sizes = np.concatenate([b.column(2).value_lengths().to_numpy() for b in batches]).astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.terms = np.concatenate([b.column(2).flatten().to_numpy() for b in batches])
        tf = np.concatenate([b.column(3).flatten().to_numpy() for b in batches]).astype(np.int64)
        owner = np.repeat(np.arange(len(n), dtype=np.int32), sizes)
        m = 100 - 25 + (25 * n * documents) // length
        self.impacts = weights[self.terms] * ((1_000_000_000 * tf) // (1_000 * tf + 12 * m[owner]))
        order = np.lexsort((-self.impacts, self.terms))
        self.list_bounds = np.searchsorted(self.terms[order], np.arange(len(weights) + 1))
        self.list_docs, self.list_impacts = owner[order], self.impacts[order]

    def scores(self, docs: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Scores of documents by direct access to their entries in all lists of a query."""
        sizes = self.bounds[docs + 1] - self.bounds[docs]
        ends = np.cumsum(sizes)
        found = []
        start = 0
        while start < len(docs):
            done = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, done + ACCESSES, "right")), start + 1)
            first = ends[start:stop] - sizes[start:stop] - done
            at = np.repeat(self.bounds[docs[start:stop]] - first, sizes[start:stop]) + np.arange(ends[stop - 1] - done)
            found.append(np.add.reduceat(times[self.terms[at]] * self.impacts[at], first))
            start = stop
        return np.concatenate(found)

    def search(self, terms: np.ndarray, times: np.ndarray, best: Best) -> int:
        """Bring the shard's documents into ``best``; returns how many were scored.

        ``times`` has, by term number, how often the query names a term.
        """
        at, ends = self.list_bounds[terms], self.list_bounds[terms + 1]
        open_lists = at < ends
        terms, at, ends = terms[open_lists], at[open_lists].copy(), ends[open_lists]
        repeats = times[terms]
        seen = np.zeros(len(self.ids), bool)
        depth, scored = DEPTH, 0
        while len(at):
            if int((repeats * self.list_impacts[at]).sum()) < best.bar:
                break
            read = np.concatenate([self.list_docs[a : min(a + depth, e)] for a, e in zip(at.tolist(), ends.tolist())])
            fresh = np.unique(read[~seen[read]])
            seen[fresh] = True
            scored += len(fresh)
            best.add(self.scores(fresh, times), self.nameless[fresh], self.ids[fresh])
            for i, (a, e) in enumerate(zip(at.tolist(), ends.tolist())):
                while a < e:
                    ahead = seen[self.list_docs[a : min(a + depth, e)]]
                    if not ahead.all():
                        a += int(ahead.argmin())
                        break
                    a += len(ahead)
                at[i] = a
            left = at < ends
            at, ends, repeats = at[left], ends[left], repeats[left]
            depth *= 2
        return scored


def _search_index(index: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """``item, doc_id, score`` of each task's k best documents; ``item`` is the query's place."""
    shared = index.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches):
        wanted, weight_of = shared.value
        best = [Best(k) for _ in wanted]
        times = np.zeros(len(weight_of), np.int64)
        held: list[pa.RecordBatch] = []

        def search():
            shard = Shard(held, weight_of, documents, length)
            for (terms, repeats), top in zip(wanted, best):
                times[terms] = repeats
                shard.search(terms, times, top)
                times[terms] = 0

        postings = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                held.append(part)
                postings += len(part.column(2).flatten())
                if postings >= SHARD_POSTINGS:
                    search()
                    held, postings = [], 0
        if held:
            search()
        items = np.repeat(np.arange(len(best), dtype=np.int32), [len(b.ids) for b in best])
        if len(items):
            ids = pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.nameless for b in best]))
            yield pa.RecordBatch.from_arrays([pa.array(items), ids, pa.array(np.concatenate([b.scores for b in best]))], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, "item int, doc_id bigint, score bigint")


def _search_block(docs: DataFrame, items: list, k: int, item_type: str) -> DataFrame:
    spark = docs.sparkSession
    counted = [term_counts((row["text"] or "").encode()) for row in items]
    vocabulary = {term: number for number, term in enumerate(sorted(set().union(*counted)))}
    queries = [
        (np.array([vocabulary[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in counted
    ]
    index = written(index_documents(docs, vocabulary), "postings")
    documents, length = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.full(len(vocabulary), 0, np.int64)
    # At most one row per term of the block.
    for term, frequency in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = weight(documents, frequency)
    found = _search_index(index, queries, weights, documents, max(length, 1), k)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    # An item has k rows per task: they are dealt into parts by id before the last ones meet.
    dealt = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for by in (["item", "part"], ["item"]):
        dealt = dealt.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(items)], f"item int, item_id {item_type}")
    return written(dealt.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the k best documents of every item, by BM25 in integers.

    Null and empty texts have no terms and are no documents; items without terms, or whose terms
    no document has, have no rows. Repeated documents are ranked each, equal scores by ascending
    ``doc_id``, those without one last. Equal rows of items count once; different texts under one
    ``item_id`` give a ranking each. ``doc_id`` is an integer; extra columns are ignored; empty
    tables give no rows.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    wanted = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    chars = wanted.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-chars // block_chars)
    result = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        if part:
            result = result.union(_search_block(docs, part, k, kind))
    return result


def op11_best_position_search(spark, sf_dir: str) -> DataFrame:
    return rank_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id
), totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS all_terms FROM lengths
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // all_terms))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
