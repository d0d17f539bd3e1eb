"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import pytest

from salesflow.llm import ranked
from salesflow.llm.ranked import Layout


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", lower)


def brute(docs, items, k):
    tfs = [Counter(words(t)) for _, t in docs]
    n, total = sum(bool(t) for t in tfs), sum(sum(t.values()) for t in tfs)
    df = Counter(w for t in tfs for w in t)
    weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for w, c in df.items()}
    out = Counter()
    for item, text in items:
        asked, scores = set(words(text)), []
        for (d, _), tf in zip(docs, tfs):
            m = 50 + (50 * sum(tf.values()) * n) // max(total, 1)
            s = sum(weight[w] * ((10 ** 9 * tf[w]) // (1000 * tf[w] + 20 * m)) for w in asked if w in tf)
            if s > 0:
                scores.append((-s, d is not None, d or 0, d))
        for i, (s, _, _, d) in enumerate(sorted(scores)[:k]):
            out[item, i + 1, d, -s] += 1
    return out


def run(spark, docs, items, k, layout=Layout(), parts=4):
    df = spark.createDataFrame([(d, t, "b", 1, 2) for d, t in docs], "doc_id long, text string, block string, item int, rank int")
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    found = ranked.search(df.repartition(parts), asked, k, layout).select("item_id", "rank", "doc_id", "score")
    return Counter(map(tuple, found.collect()))


def corpus(n, seed=1):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}é" for i in range(300)]
    return [(i, " ".join(rng.choices(common, k=rng.randint(0, 40)) + rng.choices(rare, k=6))) for i in range(n)]


ODD = [(1000, None), (1001, ""), (1002, " -- "), (None, "r1é r2é c1"), (None, "r1é r2é c1"), (7, "R7É C3_c3"),
       (5000, "c1 " * 30_000 + "r5é")]


@pytest.mark.parametrize("layout", [
    Layout(), Layout(16, 200, 3, (0.01, 0.05, 0.3)), Layout(7, 10 ** 6, 1, (0.2,)), Layout(5, 9, 64, ())])
def test_against_plain_scores(spark, layout):
    docs = corpus(400) + ODD
    items = [(i, t) for i, t in corpus(9, 2)] + [(50, "c1 c2 c1 C1"), (51, None), (52, "absent"), (50, "r1é"), (None, "c3")]
    assert run(spark, docs, items, 5, layout) == brute(docs, items, 5)


def test_a_small_map_only_adds_lists_that_nothing_asks_for(spark):
    docs, items = corpus(100), [(1, "c1 r1é r2é r3é")]
    assert run(spark, docs, items, 9, Layout(map_bits=1)) == brute(docs, items, 9)


def test_ties_and_copies(spark):
    docs = [(i % 90, "same words here") for i in range(120)] + [(200 + i, "other") for i in range(300)]
    items = [(0, "same"), (1, "words other")]
    assert run(spark, docs, items, 50, Layout(block_docs=8)) == brute(docs, items, 50)


def test_empty_tables(spark):
    assert not run(spark, [], [(1, "a")], 5) and not run(spark, [(1, "a")], [], 5)
    assert not run(spark, [(1, None)], [(1, "a")], 5)


def test_accumulators_that_cannot_win_are_left_behind():
    import numpy as np
    import pyarrow as pa

    lengths = np.full(200, 10, np.int64)
    bundle = {"items": [7], "bounds": [900_000, 10], "lengths": lengths.tobytes(),
              "acc_item": b"", "acc_doc": b"", "acc_score": b""}
    tf = np.where(np.arange(200) < 20, 9, 1).astype(np.uint32)
    postings = pa.table({"weight": [1], "items": [[0]], "docs": [np.arange(200, dtype=np.uint16).tobytes()],
                         "counts": [tf.tobytes()]})
    _, docs, _ = ranked._advance(bundle, postings, (200, 2000), 0, 10)
    assert docs.tolist() == list(range(20))
