"""Ranked lexical search over term-partitioned postings, evaluated in a pipeline of term owners.

1. The documents become blocks of at most ``block_docs`` rows (:class:`Layout`). For each term of the items a block stores one
   posting list (document numbers and occurrences), beside a header with its ids and lengths.
2. The terms are partitioned among owners by the share of documents that hold them (``owners``): the first
   owner has the rarest, heaviest terms, the last the commonest.
3. Items travel in bundles of ``bundle_items``. For every block, a bundle carries a sparse accumulator per item
   (document number, score so far) from owner to owner. A stage is a cogroup of the bundles with the
   postings of its owner, keyed by (block, bundle): no group holds more than a block, however often a
   term occurs. Contributions are 64-bit integers.
4. After each stage an accumulator goes only if even the most that the later owners can add leaves it
   below the 50th score that the block has already reached, so the selection is exact.
5. The last stage leaves the best of each block; a ranked window keeps the best of all, cut in each task first.

Defined results: words are lower-cased in A-Z and consist of digits, letters and everything beyond ASCII; null and
empty texts have none, count nowhere and match nothing; each row of the documents and each row of the items is
one of its own, also where ids repeat; equal scores go by doc_id, null first; items without a matching document
have no rows; empty tables give an empty result; other columns are ignored. Terms are told apart by their
bytes; within one piece of 2 MB of text two different terms with an equal 64-bit hash would be taken for one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.textscan import padded, pieces, runs, span_hashes
from salesflow.session import stage



@dataclass(frozen=True)
class Layout:
    """How the work is cut up; no result depends on it."""

    block_docs: int = 8192  # rows of a block; at most 65,536
    block_postings: int = 4_000_000
    bundle_items: int = 64
    owners: tuple[float, ...] = (1 / 1000, 1 / 100, 1 / 20)  # least share of documents for the second owner, ..
    map_bits: int = 20  # the map of item terms has 2 ** map_bits places, whatever their number


SCALE, LENGTH_SHARE, TF_UNIT, LENGTH_UNIT = 1_000_000_000, 50, 1000, 20  # of the score (fixed values)

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _words(texts: pa.Array) -> Iterator[tuple]:
    """(first row, rows, lower-cased bytes, starts, ends, hashes, row of each word), piece by piece."""
    for first, part in pieces(texts):
        data, borders = padded(part)
        lower = _LOWER[data]
        starts, ends = runs(_WORD[data])
        row = np.searchsorted(borders, starts, side="right") - 1
        yield first, len(part), lower, starts, ends, span_hashes(lower, starts, ends), row


def _place(hashes: np.ndarray, map_bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - map_bits)).astype(np.int64)


def _item_terms(batches: Iterator[pa.RecordBatch], map_bits: int) -> Iterator[pa.RecordBatch]:
    """(item, place in the map, term), once each."""
    for batch in batches:
        for first, _, lower, starts, ends, hashes, row in _words(batch.column(1)):
            order = np.lexsort((hashes, row))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(row[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])
            at = order[new]
            terms = [lower[a:b].tobytes() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(first + row[at])), pa.array(_place(hashes[at], map_bits)),
                 pa.array(terms, pa.binary())], names=["item", "place", "term"])


# --- the stored index ------------------------------------------------------------------


class _Block:
    """Rows and postings that are still to be written."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]] = []
        self.docs = self.postings = 0

    def rows(self, block: int, kind: pa.DataType) -> pa.RecordBatch:
        """The header (no term), then one row per term."""
        lists: dict[bytes, list[tuple[np.ndarray, np.ndarray]]] = {}
        for begins, docs, counts, terms in self.held:
            for term, a, b in zip(terms, begins[:-1].tolist(), begins[1:].tolist(), strict=True):
                lists.setdefault(term, []).append((docs[a:b], counts[a:b]))
        postings = [(np.concatenate([x[0] for x in v]), np.concatenate([x[1] for x in v]))
                    for v in lists.values()]
        lengths = np.concatenate(self.lengths)
        ids = pa.concat_arrays(self.ids)
        n = len(postings) + 1
        names = pa.array([None, *lists], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block, np.int64)), names,
             pa.array([int((lengths > 0).sum()), *(len(d) for d, _ in postings)], pa.int64()),
             pa.array([int(lengths.sum()), *(int(c.max()) for _, c in postings)], pa.int64()),
             pa.array([ids.to_pylist()] + [None] * (n - 1), pa.list_(kind)),
             pa.array([lengths.astype(np.int64).tobytes(), *(d.astype(np.uint16).tobytes() for d, _ in postings)],
                      pa.binary()),
             pa.array([None, *(c.astype(np.uint32).tobytes() for _, c in postings)], pa.binary())],
            names=["block", "term", "n", "most", "doc_ids", "docs", "counts"])


def _blocks(batches: Iterator[pa.RecordBatch], wanted: np.ndarray, layout: Layout) -> Iterator[pa.RecordBatch]:
    part, seq, open_block = TaskContext.get().partitionId(), 0, _Block()
    for batch in batches:
        kind = batch.schema.field(0).type
        for first, count, lower, starts, ends, hashes, row in _words(batch.column(1)):
            lengths = np.bincount(row, minlength=count)
            asked = np.flatnonzero(wanted[_place(hashes, layout.map_bits)])
            asked = asked[np.argsort(hashes[asked], kind="stable")]  # by term, then by row
            for a in range(0, count, layout.block_docs):
                some = asked[(row[asked] >= a) & (row[asked] < a + layout.block_docs)]
                n = min(layout.block_docs, count - a)
                if open_block.docs and (open_block.docs + n > layout.block_docs
                                        or open_block.postings + len(some) > layout.block_postings):
                    yield open_block.rows(part << 32 | seq, kind)
                    seq, open_block = seq + 1, _Block()
                h, r = hashes[some], row[some]
                new_term = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
                new = np.flatnonzero(new_term | np.r_[True, r[1:] != r[:-1]] if len(h) else new_term)
                counts = np.diff(np.append(new, len(h)))
                head = np.flatnonzero(new_term[new])
                at = some[new[head]]
                terms = [lower[x:y].tobytes() for x, y in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                open_block.held.append((np.append(head, len(new)), r[new] - a + open_block.docs, counts, terms))
                open_block.ids.append(batch.column(0).slice(first + a, n))
                open_block.lengths.append(lengths[a:a + n])
                open_block.docs += n
                open_block.postings += len(new)
    if open_block.docs:
        yield open_block.rows(part << 32 | seq, kind)


def build_index(docs: DataFrame, terms: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """The stored blocks of ``docs`` (doc_id, text), with the lists of the terms in ``terms`` (place, term).

    A term that merely shares a place with one of them may have a list as well; nothing asks for it.
    """
    spark = docs.sparkSession
    places = terms.select("place").distinct().toArrow()  # at most 2 ** map_bits numbers
    wanted = np.zeros(1 << layout.map_bits, bool)
    wanted[np.asarray(places.column("place"))] = True
    packed = spark.sparkContext.broadcast(np.packbits(wanted))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(docs.select("doc_id", "text").mapInArrow(
        lambda b: _blocks(b, np.unpackbits(packed.value).astype(bool), layout),
        f"block bigint, term binary, n bigint, most bigint, doc_ids array<{kind}>, docs binary, counts binary"),
        "ranked-index")


# --- the pipeline of owners ----------------------------------------------------------------


def weight(df: Column, n_docs: int) -> Column:
    return F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * df + 1).cast("double")))


def owner(df: Column, n_docs: int, owners: tuple[float, ...]) -> Column:
    found = F.lit(0)
    for number, share in enumerate(owners, 1):
        found = F.when(df >= F.lit(share * n_docs), number).otherwise(found)
    return found


def _advance(bundle: dict, postings: pa.Table, factor: tuple[int, int], own: int, k: int) -> tuple:
    """(item, document number, score) of what a bundle carries on after the stage of ``own``."""
    lengths = np.frombuffer(bundle["lengths"], np.int64)
    norm = 50 + (LENGTH_SHARE * lengths * factor[0]) // max(factor[1], 1)
    bounds = np.array(bundle["bounds"], np.int64).reshape(len(bundle["items"]), -1)  # (item, owner): most it adds
    later = np.cumsum(bounds[:, ::-1], axis=1)[:, ::-1]
    after = later[:, own + 1] if own + 1 < later.shape[1] else np.zeros(len(later), np.int64)
    scores = np.zeros((len(later), len(lengths)), np.int64)
    at = np.frombuffer(bundle["acc_item"], np.uint16), np.frombuffer(bundle["acc_doc"], np.uint16)
    scores[at] = np.frombuffer(bundle["acc_score"], np.int64)
    # an item whose block best cannot be passed by a document that starts here takes no new ones
    carried = scores > 0
    closed = later[:, own] < _kth(scores, k)
    for w, items, docs, counts in zip(*(postings.column(c).to_pylist() for c in (
            "weight", "items", "docs", "counts")), strict=True):
        doc = np.frombuffer(docs, np.uint16)
        tf = np.frombuffer(counts, np.uint32).astype(np.int64)
        gain = w * ((SCALE * tf) // (TF_UNIT * tf + LENGTH_UNIT * norm[doc]))
        for i in items:
            scores[i, doc] += gain
    scores[closed] *= carried[closed]
    keep = (scores > 0) & (scores + after[:, None] >= _kth(scores, k)[:, None])
    item, doc = np.nonzero(keep)
    return item, doc, scores[item, doc]


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each row; 0 where there are fewer."""
    if scores.shape[1] <= k:
        return np.zeros(len(scores), np.int64)
    return np.partition(scores, -k, axis=1)[:, -k]


CARRIED = ("block bigint, bundle bigint, items array<bigint>, bounds array<bigint>, doc_ids array<{kind}>, "
           "lengths binary, acc_item binary, acc_doc binary, acc_score binary")


def search(docs: DataFrame, items: DataFrame, k: int = 50, layout: Layout = Layout()) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of each row of ``items`` (item_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = stage(items.select("item_id", "text", F.monotonically_increasing_id().alias("item")), "ranked-items")
    asked = stage(named.select("item", "text").mapInArrow(
        lambda b: _item_terms(b, layout.map_bits), "item bigint, place bigint, term binary"), "ranked-terms")
    index = build_index(docs, asked, layout)
    heads = index.filter("term IS NULL")
    total = heads.agg(F.sum("n"), F.sum("most")).first()
    factor = total[0] or 0, total[1] or 0

    # bundles of items: a number within the part that wrote the item, so nothing is sorted as a whole
    member = asked.select("item").distinct().select(
        "item", F.shiftright("item", 33).alias("part"), (F.col("item").bitwiseAND((1 << 33) - 1)).alias("seq"))
    member = member.select(
        "item", (F.col("part") * (1 << 27) + F.floor(F.col("seq") / layout.bundle_items)).alias("bundle"),
        (F.col("seq") % layout.bundle_items).cast("int").alias("slot"))
    known = (index.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df"), F.max("most").alias("most"))
             .withColumn("weight", weight(F.col("df"), factor[0])).filter("weight > 0")
             .withColumn("owner", owner(F.col("df"), factor[0], layout.owners)))
    # a length's share is at least 50, so this is the most that one document can gain from the term
    gain = F.expr(f"weight * (({SCALE} * most) div ({TF_UNIT} * most + {LENGTH_UNIT * 50}))")
    terms = stage(asked.select("item", "term").join(member, "item").join(known, "term")
                  .select("bundle", "slot", "term", "weight", "owner", gain.alias("gain")), "ranked-dictionary")
    slots = F.array(*[F.coalesce(F.sum(F.when(F.col("owner") == o, F.col("gain"))), F.lit(0))
                      for o in range(len(layout.owners) + 1)])
    bundles = (terms.groupBy("bundle", "slot").agg(slots.alias("most"))
               .join(member, ["bundle", "slot"])
               .groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("slot", "item", "most"))).alias("s"))
               .select("bundle", F.expr("transform(s, x -> x.item)").alias("items"),
                       F.expr("transform(s, x -> x.slot)").alias("slots"),
                       F.expr("flatten(transform(s, x -> x.most))").alias("bounds")))
    lists = (terms.groupBy("bundle", "term", "weight", "owner").agg(F.collect_list("slot").alias("slots"))
             .join(bundles.select("bundle", F.col("slots").alias("held")), "bundle")
             .withColumn("items", F.expr("transform(slots, s -> cast(array_position(held, s) - 1 as int))"))
             .select("bundle", "term", "weight", "owner", "items"))
    postings = stage(index.filter("term IS NOT NULL").select("block", "term", "docs", "counts").join(lists, "term")
                     .select("owner", "block", "bundle", "weight", "items", "docs", "counts"), "ranked-postings")
    nothing = F.lit(b"").cast("binary")
    carried = (postings.select("block", "bundle").distinct()
               .join(bundles.drop("slots"), "bundle")
               .join(heads.select("block", "doc_ids", F.col("docs").alias("lengths")), "block")
               .select("block", "bundle", "items", "bounds", "doc_ids", "lengths", nothing.alias("acc_item"),
                       nothing.alias("acc_doc"), nothing.alias("acc_score")))
    last = len(layout.owners)
    for own in range(last):
        carried = _stage(carried, postings, own, factor, k, CARRIED.format(kind=kind), False)
    best = _stage(carried, postings, last, factor, k, f"item bigint, doc_id {kind}, score bigint", True)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _stage(carried: DataFrame, postings: DataFrame, own: int, factor: tuple[int, int], k: int, schema: str,
           select: bool) -> DataFrame:
    """The bundles meet the postings of one owner."""
    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        bundle = {n: left.column(n)[0].as_py() for n in left.column_names if n != "doc_ids"}
        ids = left.column("doc_ids").combine_chunks()
        item, doc, score = _advance(bundle, right, factor, own, k)
        if select:
            return pa.table([pa.array(np.array(bundle["items"], np.int64)[item]), ids.values.take(
                pa.array(doc + ids.offsets[0].as_py())), pa.array(score)], names=["item", "doc_id", "score"])
        numbers = pa.list_(pa.int64())
        made = {"items": pa.array([bundle["items"]], numbers), "bounds": pa.array([bundle["bounds"]], numbers)}
        for name, values, width in (("acc_item", item, np.uint16), ("acc_doc", doc, np.uint16),
                                    ("acc_score", score, np.int64)):
            made[name] = pa.array([values.astype(width).tobytes()], pa.binary())
        return pa.table([made.get(n, left.column(n)) for n in left.column_names], names=left.column_names)

    mine = postings.filter(F.col("owner") == own).select(  # columns of their own: ``carried`` has others of these rows
        *[F.col(c).alias(c) for c in postings.columns if c != "owner"])
    return carried.groupBy("block", "bundle").cogroup(mine.groupBy("block", "bundle")).applyInArrow(meet, schema)
