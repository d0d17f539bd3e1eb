"""Packing: nothing lost, nothing over, bins no larger than they must be."""

from collections import defaultdict

import numpy as np
import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesflow.llm import packing
from salesflow.llm.queries import QUERIES, tokenizer_path

ROWS = [(i, " ".join("w" * (i * 37 % 400))) for i in range(300)] + [(1, "again"), (None, "x y"), (900, None), (901, ""), (902, "w " * 20_000)]


def run(spark, rows, **params):
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, n_tokens int").repartition(3)
    return packing.pack_documents(df, **params).collect()


def test_whole_and_tight(spark):
    got = run(spark, ROWS)
    total = sum(len((t or "").split()) + 1 for _, t in ROWS)
    assert sum(r.n_tokens for r in got) == total
    bins = defaultdict(list)
    for r in got:
        bins[r.bin_id].append(r)
    for members in bins.values():
        members.sort(key=lambda r: r.bin_start)
        at = 0
        for r in members:
            assert r.bin_start == at
            at += r.n_tokens
        assert members[0].capacity == min(n for n in packing.LENGTHS if n >= at)
    pieces = sorted((r.piece, r.doc_start, r.n_tokens) for r in got if r.doc_id == 902)
    assert pieces == [(0, 0, 8192), (1, 8192, 8192), (2, 16384, 20_001 - 16_384)]
    assert total / sum(b[0].capacity for b in bins.values()) > 0.9


def plain_best_fit(items, costs, largest):
    """The same rule by a scan over all open bins."""
    allowed, rooms, used, changed = sorted(costs), [], [], []
    for step, n in enumerate(sorted(items, reverse=True)):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if fits:
            i = min(fits, key=lambda i: (rooms[i], -changed[i]))  # of equal ones the one changed last
        else:
            low = min(c for c in allowed if c >= n)
            choice = [c for c in allowed if low <= c <= largest] or [low]
            rooms.append(min(choice, key=lambda c: (costs[c] / c, -c)))
            used.append(0)
            changed.append(step)
            i = len(rooms) - 1
        rooms[i] -= n
        used[i] += n
        changed[i] = step
    return sorted(used)


def test_rule_against_scan():
    rng = np.random.default_rng(2)
    costs = packing.bin_costs((64, 128, 256))
    for _ in range(20):
        items = rng.integers(1, 257, 200)
        for largest in costs:
            _, used = packing.best_fit(items, np.argsort(-items, kind="stable"), costs, largest)
            assert sorted(used.tolist()) == plain_best_fit(items.tolist(), costs, largest)
        where, size = packing.pack(items, costs)
        used = np.bincount(where, weights=items)
        assert (used <= size).all() and set(size.tolist()) <= set(costs)


def test_cheap_small_bins_are_preferred():
    where, size = packing.pack(np.full(8, 60), {64: 64.0, 256: 1024.0})
    assert set(size.tolist()) == {64}


def test_lengths_windows_and_empty(spark):
    assert run(spark, []) == []
    got = run(spark, ROWS, n_tokens=F.lit(None).cast("bigint"), lengths=(4, 2), window=10)
    assert len(got) == len(ROWS) and {r.n_tokens for r in got} == {1} and {r.capacity for r in got} <= {2, 4}


def test_query_and_stage_count_token_ids(spark, folder):
    texts = ["unbelievable extraordinarily", "日本語" * 9000, "x" * 50_000, "", None, "don't 12,5 ab "]
    rows = [(i % 5 or None, t) for i, t in enumerate(texts)]
    path = folder()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{path}/documents.parquet")
    library = Tokenizer.from_file(tokenizer_path())
    ids = [len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts]
    expected = sorted(min(8192, n - a) for n in ids for a in range(0, n, 8192))
    for got in (QUERIES["op10_best_fit_packing"](spark, path), corpus_pipeline.pack_sequences(spark, docs, path)):
        got = got.collect()
        assert sorted(r.n_tokens for r in got) == expected and max(ids) > 8192
        filled = defaultdict(int)
        for r in got:
            filled[r.bin_id, r.capacity] += r.n_tokens
        assert all(n <= room for (_, room), n in filled.items())
