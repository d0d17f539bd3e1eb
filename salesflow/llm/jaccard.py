"""N-gram Jaccard join with vertical partitioning.

The global order of all shingles (by hash, the very frequent ones last) is cut into fragments.

1. One pass gives every document the 128-bit key of its shingle set: documents with the same set
   are one node from here on. The same pass finds the shingles that are frequent in a block of
   documents, and a count over all prefixes those in more than ``LIST_MOST`` of them. Texts with one of
   these share a common passage, and a count over all their shingles finds the rest of it. The
   ``HOT_KEPT`` most frequent ones go last in the global order.
2. Two sets that reach the similarity share a shingle among the first ``n - need + 1`` of the order
   (prefix). These prefixes, split into fragments, give lists of nodes per shingle; lists of a
   single node are dropped where they are gathered. Frequent shingles are never gathered.
3. A pair is a candidate only if the places of the shared shingle leave room for enough overlap,
   and if their whole prefixes share enough.
4. A candidate is settled by its overlap, counted separately in every fragment of the order and
   summed per pair. So every link is exact.

For connected components not every link is needed: the first candidates of a list join its smallest
node with the others (a star), and only pairs that are still in different components follow. With
``all_links=True`` every candidate is settled. No link can be lost either way: what is left out
lies within one component already.

Defined results: null and empty texts, and texts without words, have an empty set and no link;
fewer words than a shingle's are one shingle; repeated rows are rows of their own with the same set;
only doc_id and text are read. Shingles are 64-bit hashes. Nodes are, too, and are checked against a second
64-bit hash: of sets that share a node, those with another check get one made of both (:class:`Clashes`).
Long texts are scanned in windows, and the groups in which overlaps are counted are sized by their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.components import components
from salesflow.llm.textscan import PIECE_BYTES, lower_table, mix, padded, pieces, runs, span_hashes
from salesflow.session import stage

HOT_BLOCK = 1_000_000  # shingles in which frequent ones are counted at once
HOT_LEAST = 16  # documents of a block that make a shingle frequent
LIST_MOST = 32  # prefixes that may share a shingle before it counts as frequent
HOT_KEPT = 1 << 18  # frequent shingles that go last in the global order
GROUP_ENTRIES = 250_000  # prefix entries of one fragment
FRAGMENTS = 4  # of the order, in which the overlaps of a pair are counted
GROUP_SHINGLES = 1_000_000  # of the sets of a group's pairs, in all fragments
MOST_CLASHES = 100_000  # 64-bit keys shared by different sets; n sets have n * n / 2 ** 65
WINDOW_WORDS = 1 << 17  # words of a long text whose shingles are made at once
BITS = 1 << 24  # of the map that thins out sets before the shuffle; any size is right

_LOWER = lower_table()


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, part in pieces(texts):
        if len(part) == 1 and (pc.binary_length(part)[0].as_py() or 0) > PIECE_BYTES:
            yield _shingles(_long_words(part), size)
            continue
        data, borders = padded(part)
        symbols = _LOWER[data]
        starts, ends = runs(symbols != 0x20)
        words = span_hashes(symbols, starts, ends)
        bounds = np.searchsorted(starts, borders)
        rolled = _rolled(words, size)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield np.unique(rolled[a:b - size + 1]) if b - a >= size else _shingles(words[a:b], size)


def _rolled(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each word on."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    rolled = words[:len(words) - size + 1].copy()
    for k in range(1, size):
        rolled = mix(rolled)
        rolled += words[k:len(words) - size + 1 + k]
    return mix(rolled)


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The set of one text; fewer words than ``size`` are one shingle."""
    if len(words) >= size:
        parts = [np.unique(_rolled(words[a:a + WINDOW_WORDS + size - 1], size))
                 for a in range(0, len(words) - size + 1, WINDOW_WORDS)]
        return np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
    if not len(words):
        return np.zeros(0, np.uint64)
    whole = np.full(1, len(words), np.uint64)
    for word in words:
        whole = mix(whole) + word
    return mix(whole)


def _long_words(text: pa.Array) -> np.ndarray:
    """The word hashes of one long text, window by window; windows end behind a blank."""
    (raw,) = text.cast(pa.large_string())
    data = np.frombuffer(raw.as_buffer(), np.uint8)
    found, a = [], 0
    while a < len(data):
        b = len(data)
        for end in range(a + PIECE_BYTES, len(data), PIECE_BYTES):  # a word may be longer than a window
            blanks = np.flatnonzero(_LOWER[data[end - PIECE_BYTES:end]] == 0x20)
            if len(blanks):
                b = end - PIECE_BYTES + int(blanks[-1]) + 1
                break
        symbols = np.full(b - a + 2, 0x20, np.uint8)
        symbols[1:-1] = _LOWER[data[a:b]]
        found.append(span_hashes(symbols, *runs(symbols != 0x20)))
        a = b
    return np.concatenate(found)


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent signed 64-bit keys of a set."""
    n = np.uint64(len(shingles))
    one = mix(np.array([mix(shingles).sum(dtype=np.uint64) + n], np.uint64))
    two = mix(np.array([mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) - n],
                       np.uint64))
    return int(one.view(np.int64)[0]), int(two.view(np.int64)[0])


class Clashes:
    """The nodes that different sets share, each with the check of the set that keeps it."""

    def __init__(self, kept: dict[int, int]) -> None:
        self.kept = kept

    @classmethod
    def of(cls, sets: DataFrame) -> Clashes:
        """Of stored rows (node, check, n). They are few: about n * n / 2 ** 65 for n different sets."""
        rows = (sets.filter("n > 0").groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi"))
                .filter("lo <> hi").select("node", "lo").limit(MOST_CLASHES + 1).collect())
        if len(rows) > MOST_CLASHES:
            raise RuntimeError("more sets share a 64-bit key than any corpus explains")
        return cls({r.node: r.lo for r in rows})

    def node(self, key: tuple[int, int]) -> int:
        """The node of a set with this key."""
        node, check = key
        return node if self.kept.get(node, check) == check else node ^ check

    def nodes(self, sets: DataFrame) -> DataFrame:
        """Stored rows (doc_id, node, check, n) with the nodes that :meth:`node` gives."""
        if not self.kept:
            return sets
        kept = sets.sparkSession.createDataFrame(list(self.kept.items()), "node long, kept long")
        joined = sets.join(kept, "node", "left")
        return joined.withColumn("node", F.when(F.col("kept") != F.col("check"), F.col("node").bitwiseXOR(F.col("check")))
                                 .otherwise(F.col("node"))).drop("kept")


def need_of(n: np.ndarray, percent: int) -> np.ndarray:
    """The overlap that a set of n shingles needs with any set similar to it."""
    return -(-n * percent // 100)


def document_sets(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Stored: (doc_id, node, check, n) of every row, and (shingle, n) of frequent shingles."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[np.ndarray] = []
        held = 0

        def hot() -> pa.RecordBatch:
            seen, count = np.unique(np.concatenate(block or [np.zeros(0, np.uint64)]),
                                    return_counts=True)
            block.clear()
            often = np.flatnonzero(count >= HOT_LEAST)
            return made(pa.nulls(len(often), batch_type), seen[often].view(np.int64),
                        np.zeros(len(often), np.int64), count[often], True)

        def made(ids, node, check, n, is_hot) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(node, pa.int64()), pa.array(check, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(np.full(len(ids), is_hot))],
                names=["doc_id", "node", "check", "n", "hot"])

        batch_type = pa.int64()
        for batch in batches:
            batch_type = batch.schema.field(0).type
            keys, counts = [], []
            for shingles in shingle_sets(batch.column(1), size):
                keys.append(set_key(shingles) if len(shingles) else (0, 0))
                counts.append(len(shingles))
                block.append(shingles)
                held += len(shingles)
                if held >= HOT_BLOCK:
                    yield hot()
                    held = 0
            node, check = zip(*keys, strict=True) if keys else ((), ())
            yield made(batch.column(0), np.array(node, np.int64), np.array(check, np.int64),
                       np.array(counts, np.int64), False)
        if block:
            yield hot()

    found = docs.select("doc_id", "text").mapInArrow(
        task, f"doc_id {kind}, node bigint, check bigint, n bigint, hot boolean")
    rows = stage(found, "shingle-sets")
    hot = (rows.filter("hot").groupBy(F.col("node").alias("shingle")).agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "shingle").limit(HOT_KEPT))
    return rows.filter("NOT hot").drop("hot"), hot


def _prefix(shingles: np.ndarray, hot: np.ndarray, hot_rank: np.ndarray, percent: int
            ) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of a set in the global order, and which of it is frequent."""
    n = len(shingles)
    length = n - int(need_of(np.array(n), percent)) + 1
    if not len(hot):
        return shingles[:length], np.zeros(length, bool)
    place = np.searchsorted(hot, shingles)
    is_hot = hot[np.minimum(place, len(hot) - 1)] == shingles
    cold = shingles[~is_hot][:length]
    often = place[is_hot]
    often = often[np.argsort(hot_rank[often], kind="stable")][:length - len(cold)]
    return np.concatenate([cold, hot[often]]), np.arange(length) >= len(cold)


def _found(shingles: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which shingles are among the sorted ``known`` ones."""
    if not len(known):
        return np.zeros(len(shingles), bool)
    return known[np.minimum(np.searchsorted(known, shingles), len(known) - 1)] == shingles


def _prefix_rows(docs: DataFrame, hot: DataFrame, groups: int, size: int, percent: int, nodes: bool,
                 clashes: Clashes, whole: DataFrame | None = None) -> DataFrame:
    """(fragment, entries): the packed prefix entries of every set, the frequent ones apart.

    An entry is (shingle, node, n, place), or without ``nodes`` the shingle alone. With ``whole``, sets with one of
    its shingles in the prefix have all of theirs as entries, and the others none.
    """
    table = hot.toArrow()  # at most HOT_KEPT rows
    shingles = np.asarray(table.column("shingle")).astype(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    rank = np.empty(len(order), np.int64)  # the least frequent first
    rank[np.lexsort((shingles, np.asarray(table.column("n"))))] = np.arange(len(order))
    common = None
    if whole is not None:
        common = np.sort(np.asarray(whole.toArrow().column("shingle")).astype(np.int64).view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast((shingles[order], rank[order], common))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_, rank_, common_ = shared.value
        seen: set[int] = set()  # copies within a task count once

        def sent(found: list[tuple]) -> pa.RecordBatch:
            counts = [len(f[0]) for f in found]
            shingle = np.concatenate([f[0] for f in found])
            often = np.concatenate([f[1] for f in found])
            node = np.repeat(np.array([f[2] for f in found], np.int64), counts)
            n = np.repeat(np.array([f[3] for f in found], np.int32), counts)
            place = np.concatenate([np.arange(c, dtype=np.int32) for c in counts])
            # other shingles by their hash, frequent ones by the node
            spot = mix(np.where(often, node.view(np.uint64), shingle)) % np.uint64(groups)
            group = spot.astype(np.int64) + groups * often
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0, True])
            fields = (shingle, node, n, place) if nodes else (shingle,)
            payloads = [b"".join(x[order[a:b]].tobytes() for x in fields)
                        for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(group[order][cuts[:-1]]), pa.array(payloads, pa.binary())],
                names=["fragment", "entries"])

        found, held = [], 0
        for batch in batches:
            for shingles in shingle_sets(batch.column(0), size):
                if not len(shingles):
                    continue
                node = clashes.node(set_key(shingles))
                if node in seen:
                    continue
                seen.add(node)
                prefix, often = _prefix(shingles, hot_, rank_, percent)
                if common_ is not None:
                    if not _found(prefix, common_).any():
                        continue
                    prefix, often = shingles, _found(shingles, hot_)
                found.append((prefix, often, node, len(shingles)))
                held += len(found[-1][0])
                if held >= 300_000:
                    yield sent(found)
                    found, held = [], 0
        if found:
            yield sent(found)

    return docs.select("text").mapInArrow(task, "fragment bigint, entries binary")


def frequent_in_prefixes(docs: DataFrame, hot: DataFrame, groups: int, size: int, percent: int,
                         clashes: Clashes) -> DataFrame:
    """Stored: (shingle, n) of ``hot``, and of the shingles in more than LIST_MOST prefixes.

    A shingle that goes last makes room in the prefixes of its texts for others of the same common passage. So
    these texts are counted once more, with all of their shingles.
    """
    def count(rows: pa.Table) -> pa.Table:
        entries = np.concatenate([np.frombuffer(p.as_buffer(), np.uint64) for p in rows.column("entries")])
        found, counts = np.unique(entries, return_counts=True)
        often = counts > LIST_MOST
        return pa.table({"shingle": found[often].view(np.int64), "n": counts[often].astype(np.int64)})

    def most(rows: DataFrame) -> DataFrame:
        return rows.orderBy(F.desc("n"), "shingle").limit(HOT_KEPT)

    def counted(whole: DataFrame | None = None) -> DataFrame:
        rows = _prefix_rows(docs, hot, groups, size, percent, False, clashes, whole).filter(F.col("fragment") < groups)
        return rows.groupBy("fragment").applyInArrow(count, "shingle bigint, n bigint")

    more = stage(most(counted()), "frequent-in-prefixes")
    known = hot.union(more)
    if not more.isEmpty():
        known = known.union(counted(more)).groupBy("shingle").agg(F.max("n").alias("n"))
    return stage(most(known), "frequent-shingles")


def prefix_lists(docs: DataFrame, hot: DataFrame, groups: int, size: int, percent: int,
                 clashes: Clashes) -> DataFrame:
    """Stored: (shingle, node, n, place) of every prefix shingle that two nodes may share."""
    def gather(rows: pa.Table) -> pa.Table:
        parts = [_unpacked(p.as_py()) for p in rows.column("entries")]
        shingle, node, n, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((node, shingle))
        shingle, node, n, place = (x[order] for x in (shingle, node, n, place))
        first = np.r_[True, (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])]
        shingle, node, n, place = (x[first] for x in (shingle, node, n, place))
        if rows.column("fragment")[0].as_py() < groups:  # gathered by shingle: drop lone nodes
            same = shingle[1:] == shingle[:-1]
            keep = np.r_[False, same] | np.r_[same, False]
            shingle, node, n, place = (x[keep] for x in (shingle, node, n, place))
        return pa.table({"shingle": shingle.view(np.int64), "node": node, "n": n, "place": place})

    rows = _prefix_rows(docs, hot, groups, size, percent, True, clashes)
    return stage(rows.groupBy("fragment").applyInArrow(
        gather, "shingle bigint, node bigint, n int, place int"), "prefix-lists")


def _unpacked(entries: bytes) -> tuple[np.ndarray, ...]:
    count = len(entries) // 24
    return (np.frombuffer(entries, np.uint64, count), np.frombuffer(entries, np.int64, count, 8 * count),
            np.frombuffer(entries, np.int32, count, 16 * count),
            np.frombuffer(entries, np.int32, count, 20 * count))


def _room(percent: int) -> Column:
    """Two entries x, y of a list may begin the overlap of a similar pair."""
    need = F.ceil((F.col("x.n") + F.col("y.n")) * percent / (100 + percent))
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    return (F.col("x.node") != F.col("y.node")) & (left >= need)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("x.node", "y.node").alias("a"),
                         F.greatest("x.node", "y.node").alias("b")).distinct()


def star_candidates(lists: DataFrame, percent: int) -> DataFrame:
    """Two nodes of each list with its other nodes: the one with the most room, and any one."""
    entry = F.struct("node", "n", "place")
    centres = lists.groupBy("shingle").agg(
        F.min_by(entry, F.struct("place", "node")).alias("s"),
        F.min_by(entry, F.xxhash64("node", "shingle")).alias("t"))
    centres = centres.select("shingle", F.explode(F.array_distinct(F.array("s", "t"))).alias("c"))
    centres = centres.select("shingle", "c.*")
    return _pairs(lists.alias("x").join(centres.alias("y"), "shingle").filter(_room(percent)))


def cross_candidates(lists: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs of a list that are in different components.

    Nodes outside the most frequent component of their list are joined with the whole list.
    """
    tagged = lists.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    tagged = stage(tagged.drop("component"), "tagged-lists")
    sizes = tagged.groupBy("shingle", "part").agg(F.count("*").alias("k"))
    main = sizes.groupBy("shingle").agg(
        F.max(F.struct("k", "part"))["part"].alias("main"), F.count("*").alias("parts"))
    mixed = main.filter("parts > 1")
    strays = tagged.join(mixed, "shingle").filter("part <> main")
    return _pairs(strays.alias("x").join(tagged.alias("y"), "shingle").filter(
        (F.col("x.part") != F.col("y.part")) & _room(percent)))


def _bit_map(nodes: DataFrame) -> np.ndarray:
    """BITS bits with those of the nodes set; its size does not depend on their number."""
    spot = F.pmod("node", F.lit(BITS)) + 1  # bitmap functions count from 1
    rows = nodes.groupBy(F.bitmap_bucket_number(spot).alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("m")).collect()
    bits = np.zeros(BITS, bool)
    for row in rows:  # 32768 bits in each bucket
        mapped = np.unpackbits(np.frombuffer(row["m"], np.uint8), bitorder="little")
        bits[(row["k"] - 1) * len(mapped):][:len(mapped)] = mapped
    return bits


def node_prefixes(lists: DataFrame) -> DataFrame:
    """Stored: (node, n, shingles) of every node's entries."""
    return stage(lists.groupBy("node").agg(
        F.first("n").alias("n"), F.collect_list("shingle").alias("shingles")), "node-prefixes")


def plausible(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Stored: the ``pairs`` whose prefixes share as much as a similar pair's must.

    The prefix is the first fragment of the order: what two sets share beyond it is less than the
    overlap that the larger one needs with any set.
    """
    a, b = (prefixes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"),
                            F.col("shingles").alias(f"s_{x}")) for x in "ab")
    beyond = F.ceil(F.greatest("n_a", "n_b") * percent / 100) - 1
    need = F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))
    both = pairs.join(a, "a").join(b, "b")
    kept = both.filter(F.size(F.array_intersect("s_a", "s_b")) + beyond >= need)
    return stage(kept.select("a", "b", (F.col("n_a") + F.col("n_b")).cast("long").alias("weight")), "candidates")


def settle(docs: DataFrame, pairs: DataFrame, size: int, percent: int, clashes: Clashes) -> DataFrame:
    """Stored: (a, b, overlap, n_a, n_b) of the ``pairs`` (stored) that reach the similarity."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(_bit_map(nodes)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = bits.value
        seen: set[int] = set()
        for batch in batches:
            out: list[tuple] = []
            for shingles in shingle_sets(batch.column(0), size):
                if not len(shingles):
                    continue
                node = clashes.node(set_key(shingles))
                spot = node % BITS
                if node in seen or not wanted[spot >> 3] >> (7 - (spot & 7)) & 1:
                    continue
                seen.add(node)
                cuts = np.searchsorted(shingles >> np.uint64(62), np.arange(FRAGMENTS + 1))
                out += [(node, f, len(shingles), shingles[cuts[f]:cuts[f + 1]].tobytes())
                        for f in range(FRAGMENTS)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                        pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                    names=["node", "fragment", "n", "shingles"])

    # each pair is settled where its first node's set is; a node whose pairs are many or large is split
    load = pairs.groupBy("a").agg(F.sum("weight").alias("load"))
    total = load.agg(F.sum("load")).first()[0] or 0
    groups = total // GROUP_SHINGLES + 1
    split = pairs.join(load, "a").withColumn("salt", F.when(
        F.col("load") > GROUP_SHINGLES, F.pmod(F.xxhash64("b"), F.ceil(F.col("load") / GROUP_SHINGLES)))
        .otherwise(0))
    split = split.select("a", "b", F.pmod(F.xxhash64("a", "salt"), F.lit(groups)).alias("bucket"))
    split = stage(split, "split-pairs")
    roles = (split.select(F.col("a").alias("node"), "bucket")
             .union(split.select(F.col("b").alias("node"), "bucket")).distinct())
    sets = docs.select("text").mapInArrow(
        task, "node bigint, fragment int, n int, shingles binary")
    sent = sets.join(roles, "node").select(
        "bucket", "fragment", "node", "n", "shingles",
        F.lit(None).cast("bigint").alias("b"))
    asked = split.select("bucket", F.explode(F.array(*map(F.lit, range(FRAGMENTS)))).alias("fragment"),
                         F.col("a").alias("node"), F.lit(0).alias("n"),
                         F.lit(None).cast("binary").alias("shingles"), "b")
    counted = sent.union(asked).groupBy("bucket", "fragment").applyInArrow(
        _partial_overlaps, "a bigint, b bigint, n_a int, n_b int, part bigint")
    summed = counted.groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("overlap"))
    linked = F.col("overlap") * 100 >= percent * (F.col("n_a") + F.col("n_b") - F.col("overlap"))
    return stage(summed.filter(linked).select("a", "b", "overlap", "n_a", "n_b"), "links")


def _partial_overlaps(rows: pa.Table) -> pa.Table:
    """The shared shingles of each asked pair, in one fragment of the order."""
    asked = np.asarray(rows.column("shingles").is_null())
    node = np.asarray(rows.column("node"))
    a, b = node[asked], np.asarray(rows.column("b").drop_null())
    sets: dict[int, np.ndarray] = {}
    sizes: dict[int, int] = {}
    for key, n, shingles in zip(node[~asked].tolist(),
                                np.asarray(rows.column("n"))[~asked].tolist(),
                                rows.column("shingles").filter(pa.array(~asked)), strict=True):
        sets[key], sizes[key] = np.frombuffer(shingles.as_buffer(), np.uint64), n
    part = [len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    return pa.table({
        "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
        "n_a": pa.array([sizes[x] for x in a.tolist()], pa.int32()),
        "n_b": pa.array([sizes[x] for x in b.tolist()], pa.int32()),
        "part": pa.array(part, pa.int64())})


def similar_sets(docs: DataFrame, size: int = 5, percent: int = 80, all_links: bool = False
                 ) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, node, n) of every row, and links (a, b, overlap, n_a, n_b) of nodes.

    The links connect every component; with ``all_links`` they are all links.
    """
    sets, hot = document_sets(docs, size)
    clashes = Clashes.of(sets)
    sets = clashes.nodes(sets)
    members = sets.select("doc_id", F.when(F.col("n") > 0, F.col("node")).alias("node"), "n")
    entries = sets.agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()[0] or 0
    groups = int(entries // GROUP_ENTRIES) + 1
    hot = frequent_in_prefixes(docs, hot, groups, size, percent, clashes)
    lists = prefix_lists(docs, hot, groups, size, percent, clashes)
    prefixes = node_prefixes(lists)
    if all_links:
        every = _pairs(lists.alias("x").join(lists.alias("y"), "shingle").filter(
            (F.col("x.node") < F.col("y.node")) & _room(percent)))
        return members, settle(docs, plausible(every, prefixes, percent), size, percent, clashes)
    star = stage(star_candidates(lists, percent), "star-candidates")
    links = settle(docs, plausible(star, prefixes, percent), size, percent, clashes)
    cross = cross_candidates(lists, components(links), percent)
    cross = plausible(cross.join(star, ["a", "b"], "left_anti"), prefixes, percent)
    return members, links.union(settle(docs, cross, size, percent, clashes))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id linked to it) of every row."""
    members, links = similar_sets(docs, size, percent)
    nodes = members.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    parts = nodes.join(components(links), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    parts = stage(parts, "node-components")
    roots = parts.groupBy("component").agg(F.min("least").alias("component_id"))
    named = parts.join(roots, "component").select("node", "component_id")
    joined = members.join(named, "node", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"),
                         F.when(F.col("node").isNull(), F.col("doc_id"))
                         .otherwise(F.col("component_id")).alias("component_id"))
