"""Exact windows and proximity against a plain scan."""

import re

from pyspark.sql import functions as F

from salesflow.llm import decontamination as D

DOCS = [
    (1, "a b c d e f g h i j k l m"), (2, "x A B C D E F G H I J k y"), (3, None), (4, ""), (5, "..!"),
    (6, "one two"), (6, "one two"), (None, "zero one two three one two"), (7, "the the the the"),
    (8, "a b c d e f g h i X j"), (9, "k l m " * 4000 + "a b c d e f g h i j"), (10, "É é É"),
]
ITEMS = [(100, "a b c d e f g h i j k"), (20, "one two"), (3, "the the"), (4, None), (5, " ?"), (6, "É"),
         (None, "x y z"), (20, "one two")]


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", lower)


def brute(text):
    w, hit, items = words(text), set(), set()
    for item, t in ITEMS:
        q = words(t)
        k = min(10, len(q))
        for s in range(len(q) - k + 1) if k else ():
            for at in range(len(w) - k + 1):
                if w[at:at + k] == q[s:s + k]:
                    hit |= set(range(at, at + k))
                    items.add("" if item is None else str(item))
    return len(w), len(hit), len(items), sorted(items), bool(hit)


def tables(spark):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in DOCS], "doc_id long, text string, term string, pos int")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def test_against_scan(spark):
    found = D.contamination(*tables(spark)).collect()
    got = sorted(((r[0], tuple(r[1:4]) + (list(r[4]), r[5])) for r in found), key=str)
    assert got == sorted(((i, brute(t)) for i, t in DOCS), key=str)


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert D.contamination(docs.limit(0), items).count() == 0
    assert D.contamination(docs, items.limit(0)).filter("contaminated").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x x b x a b c"), (2, "c " * 30 + "a b"), (3, None)], "doc_id long, text string")
    asked = [("q1", ["a", "b"]), ("q2", ["c", "a", "b"]), ("q3", ["a", "absent"])]
    queries = spark.createDataFrame(asked, "query string, terms array<string>")
    index = D.build_index(docs, queries.select(F.explode("terms").alias("term")))
    got = {(r["doc_id"], r["start"], r["query"]) for r in D.proximity_matches(index, queries, 4)
           .join(D.lengths(index), "row").collect()}
    expected = set()
    for doc, text in docs.collect():
        w = words(text)
        for q, terms in asked:
            for s in range(len(w)):
                if w[s] in terms and set(terms) <= set(w[s:s + 4]):
                    expected.add((doc, s, q))
    assert got == expected
