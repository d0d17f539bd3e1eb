"""Benchmark decontamination with a distributed positional inverted index.

:func:`build_index` stores one posting (term, row, pos) for every occurrence of a test term in the
training texts. A phrase is found by intersecting the lists of its terms, each shifted by the
term's offset: first the two rarest terms (by their counts over the whole corpus), then the others,
only in the documents that are left. Postings are spread by (row, pos), so a word that fills a
third of the corpus, or a passage that many documents share, is never gathered in one task.

Words: A-Z lower-cased, then the maximal runs without ASCII separators. Defined results: null
and empty texts have no words; a row of the training table is a document of its own even if its
doc_id is null or repeated; test items without words have no window; equal windows of one item
count once; columns other than doc_id / item_id and text are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.session import stage

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value: what stands between words
DOC_END = ""  # the term whose posting stands behind the last word: its position is the length


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else; pure ASCII texts take the fast path."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def test_windows(items: DataFrame, size: int = 10) -> DataFrame:
    """(item_id, window, terms): every run of ``size`` words; a shorter item is one window."""
    split = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = split.select("item_id", F.explode(F.transform(
        starts, lambda s: F.slice("w", s, F.least(F.lit(size), F.size("w"))))).alias("terms"))
    return cut.distinct().withColumn("window", F.xxhash64("terms", "item_id"))


def terms_of(windows: DataFrame) -> DataFrame:
    """(window, offset, term) of all windows."""
    return windows.select("window", F.posexplode("terms").alias("offset", "term"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored postings (term, row, doc_id, pos) of ``terms``, and a DOC_END posting per row.

    ``row`` numbers the rows of ``docs`` and is stored with the postings, so it stays the same
    for everything that reads the index.
    """
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"),
                       words(F.col("text")).alias("w"))
    tokens = rows.select("row", "doc_id", F.posexplode(
        F.concat("w", F.array(F.lit(DOC_END)))).alias("pos", "term"))
    end = terms.sparkSession.range(1).select(F.lit(DOC_END).alias("term"))
    wanted = stage(terms.select("term").distinct().union(end), "test-terms")
    kept = tokens.join(wanted, "term", "left_semi")
    return stage(kept.select("term", "row", F.when(F.col("term") == DOC_END, F.col("doc_id"))
                             .alias("doc_id"), "pos"), "postings")


def lengths(index: DataFrame) -> DataFrame:
    """(row, doc_id, n_words) of every training row."""
    ends = index.filter(F.col("term") == DOC_END)
    return ends.select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))


def by_rarity(index: DataFrame, terms: DataFrame) -> DataFrame:
    """``terms`` with their rank in the window, from the rarest; windows with an absent term go."""
    counts = index.filter(F.col("term") != DOC_END).groupBy("term").agg(F.count("*").alias("n"))
    counted = terms.join(stage(counts, "term-counts"), "term", "left")
    each = Window.partitionBy("window")
    return (counted.withColumn("absent", F.max(F.col("n").isNull()).over(each))
            .filter(~F.col("absent"))
            .withColumn("rank", F.row_number().over(each.orderBy("n", "term", "offset")))
            .select("window", "offset", "term", "rank", F.count("*").over(each).alias("size")))


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, start, window, size): every exact occurrence of every window, stored."""
    ranked = stage(by_rarity(index, terms_of(windows)), "ranked-terms")
    shifted = index.join(ranked.filter("rank <= 2"), "term").select(
        "row", (F.col("pos") - F.col("offset")).alias("start"), "window", "size")
    begun = shifted.groupBy("row", "start", "window", "size").agg(F.count("*").alias("found"))
    begun = begun.filter(F.col("found") == F.least(F.lit(2), F.col("size"))).drop("found")
    begun = stage(begun, "alignments")

    left = stage(begun.select("row").distinct(), "aligned-rows")
    lists = index.join(left, "row", "left_semi").select("row", "pos", "term")
    rest = begun.filter("size > 2").join(ranked.filter("rank > 2").drop("size"), "window")
    needed = rest.select("row", (F.col("start") + F.col("offset")).alias("pos"), "term",
                         "start", "window", "size")
    met = (needed.join(lists, ["row", "pos", "term"])
           .groupBy("row", "start", "window", "size").agg(F.count("*").alias("found"))
           .filter("found = size - 2").drop("found"))
    return stage(begun.filter("size <= 2").unionByName(met), "matches")


def proximity_matches(index: DataFrame, queries: DataFrame, width: int) -> DataFrame:
    """(row, start, query): the places where all terms of a query stand within ``width`` words.

    ``queries`` has (query, terms); ``start`` is the position of a match's first term, once per
    shortest match from that start. Lists are intersected around the rarest term, in cells of
    ``width`` positions, so that only neighbouring postings meet.
    """
    terms = queries.select(F.col("query").alias("window"), F.posexplode(
        F.array_distinct("terms")).alias("offset", "term"))
    ranked = stage(by_rarity(index, terms), "ranked-terms")
    rare = index.join(ranked.filter("rank = 1"), "term").select(
        "row", F.col("pos").alias("anchor"), "window", "size")
    cells = rare.withColumn("cell", F.explode(F.sequence(
        F.floor((F.col("anchor") - width) / width), F.floor((F.col("anchor") + width) / width))))
    near = index.join(ranked.drop("size", "rank", "offset"), "term").select(
        "row", "pos", "term", "window", F.floor(F.col("pos") / width).alias("cell"))
    met = cells.join(near, ["row", "window", "cell"]).filter(
        F.abs(F.col("pos") - F.col("anchor")) < width)
    spots = met.groupBy("row", "window", "anchor", "size").agg(
        F.collect_list(F.struct("pos", "term")).alias("near"))
    inside = F.filter("near", lambda x: (x["pos"] >= F.col("start"))
                      & (x["pos"] < F.col("start") + width))
    full = F.size(F.array_distinct(F.transform(inside, lambda x: x["term"]))) == F.col("size")
    starts = spots.select("row", "window", "anchor", "size", "near", F.explode(
        F.array_distinct(F.transform("near", lambda x: x["pos"]))).alias("start"))
    return (starts.filter((F.col("start") <= F.col("anchor")) & full)
            .select("row", F.col("start"), F.col("window").alias("query")).distinct())


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """One row per training row: doc_id, n_words, n_hit, n_items, item_ids, contaminated.

    ``n_hit`` counts the words inside any occurrence of any window; ``item_ids`` are the items
    with occurring windows, as strings in order.
    """
    windows = stage(test_windows(items, size), "test-windows")
    index = build_index(docs, terms_of(windows))
    found = phrase_matches(index, windows)
    spans = found.groupBy("row", "start").agg(F.max("size").alias("size"))
    covered = spans.select("row", F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("size").cast("int") - 1)).alias("pos")).distinct()
    hits = covered.groupBy("row").agg(F.count("*").alias("n_hit"))
    seen = found.join(windows.select("window", "item_id"), "window").select(
        "row", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
    per_row = seen.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    return (lengths(index).join(hits, "row", "left").join(per_row, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
