"""Exact top-k search by BM25 with block-max WAND.

:func:`build_index` stores an inverted index in shards of at most ``SHARD_DOCS`` documents: sorted
term hashes, and for each term its documents with their frequencies. Scores use the statistics of
the whole corpus (number and average length of documents, document frequencies), so the shards' best
lists merge exactly.

Every list has its maximum, and maxima per block of documents. A query whose summed list maxima stay below its
threshold, the k-th best score so far, carried from shard to shard, leaves the shard at once. Otherwise summed
block maxima bound every block, and a loop moves from pivot to pivot: the next block whose bound reaches the
threshold. Only there the lists of frequent terms are read; the threshold rises with each step, and when no bound
reaches it any more all other blocks are skipped. Pivots come by falling bound, not by place, so that thresholds
rise early, and in steps that double, so that many queries share a step.

Blocks have two sizes: ``BLOCK`` documents in the lists of frequent terms, one document in all others, where a
posting is its own maximum. Queries are whole texts of hundreds of terms; with blocks of 64 documents in every
list the sums of their maxima are so far above any score that 97 of 100 blocks were pivots.

The stated queries go through the index in blocks of bounded size, so neither the queries nor the index are
ever held whole by one process; a task keeps the k best of each query over all its shards and returns them once.

Defined results: words as in :mod:`salesflow.llm.decontamination`; texts without words match nothing
and count in the averages with length 0; a query term counts as often as it occurs in the query; scores are
rounded to ``DIGITS`` decimals, ties go to the smaller doc_id (null first); documents without a
common word are not returned; repeated rows are documents of their own, repeated equal queries are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.textscan import padded, pieces, runs, span_hashes
from salesflow.session import stage

K1, B = 1.2, 0.75
DIGITS = 6
SHARD_DOCS = 8192
SHARD_WORDS = 6_000_000
BLOCK = 64
FREQUENT = 16  # a term in more than 1 / FREQUENT of a shard's documents counts as frequent
QUERY_TERMS = 500_000  # terms of one block of queries
BATCH = 256  # queries that are scored at once
PIVOTS = 1  # blocks of a query's first step; each step has twice as many
SLACK = 10.0 ** -DIGITS  # bounds and scores are sums in different orders

_WORD = np.zeros(256, bool)  # bytes of words: digits, letters and all but ASCII
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hash of each word, row of each word within the piece), piece by piece."""
    for first, part in pieces(texts):
        data, borders = padded(part)
        lower = _LOWER[data]
        starts, ends = runs(_WORD[lower])
        row = np.searchsorted(borders, starts, side="right") - 1
        yield first, len(part), span_hashes(lower, starts, ends), row


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    ids: list[pa.Array] = []
    docs = words = 0

    def flush() -> pa.RecordBatch:
        term = np.concatenate([h[0] for h in held])
        doc = np.concatenate([h[1] for h in held])
        lengths = np.bincount(doc, minlength=docs)
        order = np.argsort(term, kind="stable")
        term, doc = term[order], doc[order]
        new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])]
                             if len(term) else np.zeros(0, bool))
        counts = np.diff(np.append(new, len(term)))
        term, doc = term[new], doc[new]
        begins = np.flatnonzero(np.r_[True, term[1:] != term[:-1]] if len(term) else np.zeros(0, bool))
        doc_ids = pa.concat_arrays(ids)
        columns = {
            "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
            "lengths": lengths.astype(np.uint32), "terms": term[begins], "begins": begins.astype(np.uint32),
            "docs": doc.astype(np.uint16), "counts": counts.astype(np.uint32)}
        arrays = [v if isinstance(v, pa.Array) else pa.array([v.tobytes()], pa.binary())
                  for v in columns.values()]
        size = [pa.array([docs], pa.int64()), pa.array([int(lengths.sum())], pa.int64())]
        held.clear()
        ids.clear()
        return pa.RecordBatch.from_arrays([*size, *arrays], names=["n_docs", "n_words", *columns])

    for batch in batches:
        for first, count, term, row in _words(batch.column(1)):
            for a in range(0, count, SHARD_DOCS):
                some = slice(*np.searchsorted(row, [a, a + SHARD_DOCS]))
                n = min(SHARD_DOCS, count - a)
                if docs and (docs + n > SHARD_DOCS or words + some.stop - some.start > SHARD_WORDS):
                    yield flush()
                    docs = words = 0
                held.append((term[some], row[some] - a + docs))
                ids.append(batch.column(0).slice(first + a, n))
                docs += n
                words += some.stop - some.start
    if docs:
        yield flush()


def build_index(docs: DataFrame) -> DataFrame:
    """The stored shards; every row of ``docs`` is in one of them."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(docs.select("doc_id", "text").mapInArrow(
        _shards, f"n_docs bigint, n_words bigint, doc_ids array<{kind}>, lengths binary, "
                 "terms binary, begins binary, docs binary, counts binary"), "search-index")


def _query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, count, term, row in _words(batch.column(1)):
            terms, counts, sizes = [], [], []
            bounds = np.searchsorted(row, np.arange(count + 1))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                t, n = np.unique(term[a:b], return_counts=True)
                terms.append(t.tobytes())
                counts.append(n.astype(np.uint32).tobytes())
                sizes.append(len(t))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, count), pa.array(terms, pa.binary()),
                 pa.array(counts, pa.binary()), pa.array(sizes, pa.int64())],
                names=["query_id", "terms", "counts", "size"])


class Shard:
    """One shard, opened for search with the corpus's average length."""

    def __init__(self, row: dict, average: float) -> None:
        self.n = row["n_docs"]
        self.terms = np.frombuffer(row["terms"], np.uint64)
        begins = np.frombuffer(row["begins"], np.uint32).astype(np.int64)
        self.docs = np.frombuffer(row["docs"], np.uint16)
        tf = np.frombuffer(row["counts"], np.uint32).astype(np.float64)
        length = np.frombuffer(row["lengths"], np.uint32).astype(np.float64)
        self.begins, self.ends = begins, np.append(begins[1:], len(self.docs))
        norm = K1 * (1 - B + B * length / average) if average else np.full(self.n, K1)
        self.gain = tf * (K1 + 1) / (tf + norm[self.docs])
        self.list_most = np.maximum.reduceat(self.gain, begins) if len(begins) else np.zeros(0)
        self.blocks = -(-self.n // BLOCK)
        self.scored = self.read = 0  # pivots that were scored, postings of rarer terms that were summed
        often = np.flatnonzero(self.ends - begins > max(self.n // FREQUENT, 8))
        self.row_of = np.full(len(self.terms), -1)
        self.row_of[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.blocks * BLOCK))
        for r, t in enumerate(often.tolist()):
            part = slice(self.begins[t], self.ends[t])
            self.dense[r, self.docs[part]] = self.gain[part]
        self.dense_most = self.dense.reshape(len(often), self.blocks, BLOCK).max(axis=2)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The place of each term in the shard, or -1."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        place = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[place] == terms, place, -1)

    def rare_sums(self, place: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The summed gains of the rarer terms, for every document: a row per block."""
        begin, count = self.begins[place], self.ends[place] - self.begins[place]
        before = np.cumsum(count) - count
        take = np.repeat(begin - before, count) + np.arange(count.sum())
        self.read += len(take)
        return np.bincount(self.docs[take], weights=self.gain[take] * np.repeat(weight, count),
                           minlength=self.blocks * BLOCK).reshape(self.blocks, BLOCK)


def search_shard(shard: Shard, queries: list[tuple[np.ndarray, np.ndarray]], best: list[np.ndarray], k: int
                 ) -> list[tuple[np.ndarray, np.ndarray]]:
    """(documents, scores) that can be among the k best of each query.

    ``best`` holds the k best scores that each query has met so far, and is kept up to date.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for first in range(0, len(queries), BATCH):
        top = np.array(best[first:first + BATCH])
        found += _search(shard, queries[first:first + BATCH], top)
        best[first:first + BATCH] = list(top)
    return found


def _search(shard: Shard, queries: list[tuple[np.ndarray, np.ndarray]], top: np.ndarray
            ) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same for one batch; ``top`` has the k best scores of each query, the lowest first."""
    rare = np.zeros((len(queries), shard.blocks, BLOCK))
    weights = np.zeros((len(queries), len(shard.dense)))
    for i, (terms, weight) in enumerate(queries):
        place = shard.find(terms)
        there = np.flatnonzero(place >= 0)
        place, weight = place[there], weight[there]
        if shard.list_most[place] @ weight < top[i, 0] - SLACK:
            continue
        row = shard.row_of[place]
        weights[i, row[row >= 0]] = weight[row >= 0]
        rare[i] = shard.rare_sums(place[row < 0], weight[row < 0])
    bound = rare.max(axis=2) + weights @ shard.dense_most
    order = np.argsort(-bound, axis=1)
    bound = np.take_along_axis(bound, order, axis=1)
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at, step = 0, PIVOTS
    while at < shard.blocks:
        ahead = bound[:, at:at + step]
        who, nth = np.nonzero((ahead >= top[:, :1] - SLACK) & (ahead > 0))
        if not len(who):
            break
        pivot = order[who, at + nth]
        shard.scored += len(who)
        score = rare[who, pivot]
        by_block = np.argsort(pivot, kind="stable")
        for pairs in np.split(by_block, np.flatnonzero(np.diff(pivot[by_block])) + 1):
            b = int(pivot[pairs[0]])
            score[pairs] += weights[who[pairs]] @ shard.dense[:, b * BLOCK:(b + 1) * BLOCK]
        pair, offset = np.nonzero((score >= top[who, :1] - SLACK) & (score > 0))
        reached = score[pair, offset]
        kept.append((who[pair], pivot[pair] * BLOCK + offset, reached))
        for i, some in _slices(who[pair]):
            top[i] = np.sort(np.concatenate([top[i], reached[some]]))[-top.shape[1]:]
        at, step = at + step, 2 * step
    who, doc, score = (np.concatenate(x) for x in zip(*kept, strict=True)) if kept else np.zeros((3, 0), np.int64)
    good = np.flatnonzero(score >= top[who, 0] - SLACK)
    good = good[np.argsort(who[good], kind="stable")]
    ends = np.searchsorted(who[good], np.arange(1, len(queries)))
    return list(zip(np.split(doc[good], ends), np.split(score[good], ends), strict=True))


def _slices(sorted_values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value of a sorted array and where it stands."""
    cuts = np.flatnonzero(np.diff(sorted_values)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sorted_values)], strict=True):
        if b > a:
            yield int(sorted_values[a]), slice(a, b)


def top_k(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, doc_id, score of the ``k`` best documents of every query (query_id, text)."""
    spark = index.sparkSession
    kind = queries.schema["query_id"].dataType.simpleString()
    asked = stage(queries.select("query_id", "text").distinct().mapInArrow(
        _query_rows, f"query_id {kind}, terms binary, counts binary, size bigint")
        .filter("size > 0"), "queries")
    totals = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
    n_docs, n_words = totals[0] or 0, totals[1] or 0
    blocks = int((asked.agg(F.sum("size")).first()[0] or 0) // QUERY_TERMS) + 1
    spot = F.pmod(F.xxhash64("query_id", "terms"), F.lit(blocks))
    counts = document_frequencies(index)
    lists = [_block_lists(index, counts, asked.filter(spot == b), n_docs, n_words, k) for b in range(blocks)]
    merged = lists[0]
    for more in lists[1:]:
        merged = merged.union(more)
    order = Window.partitionBy("query_id", "query").orderBy(
        F.desc("score"), F.col("doc_id").asc_nulls_first())
    return (merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "doc_id", "score"))


def document_frequencies(index: DataFrame) -> DataFrame:
    """Stored: (term, df) of all terms of the corpus, from one pass over the shards."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, b, size in zip(*batch.columns, strict=True):
                terms = np.frombuffer(t.as_buffer(), np.uint64)
                begins = np.frombuffer(b.as_buffer(), np.uint32).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms.view(np.int64)), pa.array(np.diff(np.append(begins, size.as_py() // 2)))],
                    names=["term", "n"])

    spread = index.select("terms", "begins", F.octet_length("docs").cast("bigint").alias("size"))
    return stage(spread.mapInArrow(counted, "term bigint, n bigint").groupBy("term").agg(
        F.sum("n").alias("df")), "search-frequencies")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for terms in batch.column(0):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms.as_buffer(), np.int64))], names=["term"])


class Best:
    """The k best documents of each query, over all shards of a task."""

    def __init__(self, queries: int, k: int, kind: pa.DataType) -> None:
        self.k = k
        self.held = [pa.table({"doc_id": pa.array([], kind), "score": pa.array([], pa.float64())})] * queries

    def add(self, query: int, docs: pa.Array, scores: np.ndarray) -> None:
        if len(docs):
            both = pa.concat_tables([self.held[query], pa.table({"doc_id": docs, "score": pa.array(scores)})])
            if len(both) > self.k:
                order = pc.sort_indices(both, sort_keys=[("score", "descending"), ("doc_id", "ascending")],
                                        null_placement="at_start")
                both = both.take(order[:self.k])
            self.held[query] = both

    def rows(self, names: pa.Array) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        query = np.repeat(np.arange(len(self.held)), [len(t) for t in self.held])
        both = pa.concat_tables(self.held).combine_chunks()
        for a in range(0, len(query), 50_000):
            some, part = pa.array(query[a:a + 50_000]), both.slice(a, 50_000)
            yield pa.RecordBatch.from_arrays(
                [names.take(some), some, *(c.combine_chunks() for c in part.columns)],
                names=["query_id", "query", "doc_id", "score"])


def _block_lists(index: DataFrame, frequencies: DataFrame, asked: DataFrame, n_docs: int, n_words: int,
                 k: int) -> DataFrame:
    """The tasks' lists for one block of queries, stored."""
    context = index.sparkSession.sparkContext
    table = asked.select("query_id", "terms", "counts").toArrow()  # about QUERY_TERMS terms
    terms = [np.frombuffer(t.as_buffer(), np.uint64) for t in table.column("terms")]
    counts = [np.frombuffer(c.as_buffer(), np.uint32) for c in table.column("counts")]
    wanted = asked.select("terms").mapInArrow(_exploded, "term bigint").distinct()
    found = wanted.join(frequencies, "term").toArrow()  # as many rows at most
    known = np.asarray(found.column("term")).astype(np.int64).view(np.uint64)
    order = np.argsort(known)
    known, df = known[order], np.asarray(found.column("df")).astype(np.float64)[order]
    idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))

    def weighted(own: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The query's terms that the corpus has, and their weights."""
        place = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
        there = known[place] == own if len(known) else np.zeros(len(own), bool)
        return own[there], idf[place[there]] * n[there]

    vectors = context.broadcast([weighted(t, c) for t, c in zip(terms, counts, strict=True)])
    names = context.broadcast(table.column("query_id").combine_chunks())
    average = n_words / n_docs if n_docs else 0.0

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.full(k, -np.inf) for _ in vectors.value]
        held = None
        for batch in batches:
            for row in range(batch.num_rows):
                cells = {n: batch.column(n)[row] for n in batch.schema.names}
                shard = Shard({n: c.as_buffer() if pa.types.is_binary(c.type) else
                               c.as_py() if n == "n_docs" else None for n, c in cells.items()}, average)
                ids = cells["doc_ids"].values
                held = held or Best(len(vectors.value), k, ids.type)
                for query, (docs, score) in enumerate(search_shard(shard, vectors.value, best, k)):
                    held.add(query, ids.take(pa.array(docs)), np.round(score, DIGITS))
        if held:
            yield from held.rows(names.value)

    kinds = [index.schema["doc_ids"].dataType.elementType.simpleString(),
             asked.schema["query_id"].dataType.simpleString()]
    return stage(index.select("n_docs", "doc_ids", "lengths", "terms", "begins", "docs", "counts")
                 .mapInArrow(lists, f"query_id {kinds[1]}, query bigint, doc_id {kinds[0]}, score double"),
                 "search-lists")


def every_hundredth(doc_id: Column) -> Column:
    """The stated query set: rows whose id is divisible by 100."""
    return doc_id % 100 == 0
