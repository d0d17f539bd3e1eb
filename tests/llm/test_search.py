"""Exact top-k against a plain BM25, with pruning and ties."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from salesflow.llm import search


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", lower)


def brute(docs, queries, k):
    tfs = [Counter(words(t)) for _, t in docs]
    mean = sum(sum(t.values()) for t in tfs) / max(len(docs), 1)
    df = Counter(w for t in tfs for w in t)
    out = set()
    for q, text in set(queries):
        scores = []
        for (d, _), tf in zip(docs, tfs):
            s = sum(n * math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2
                    / (tf[w] + 1.2 * (0.25 + 0.75 * sum(tf.values()) / mean)) for w, n in Counter(words(text)).items() if w in tf)
            if s:
                scores.append((-round(s, 6), -math.inf if d is None else d, d))
        out |= {(q, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2])[:k])}
    return out


def corpus(n=400, seed=1):
    rng = np.random.default_rng(seed)
    common, rare = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(600)]
    return [(i, " ".join(rng.choice(common, rng.integers(0, 60)).tolist() + rng.choice(rare, 8).tolist())) for i in range(n)]


def run(spark, docs, queries, k=7):
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, rank int")
    asked = spark.createDataFrame(queries, "query_id long, text string")
    found = search.top_k(search.build_index(df.repartition(3)), asked, k)
    return [(r[0], r[1], r[2], round(r[3], 6)) for r in found.select("query_id", "rank", "doc_id", "score").collect()]


def test_against_plain_scores(spark):
    docs = corpus() + [(1000, None), (1001, ""), (None, "r1 r2 c1"), (1002, "R7 É"), (5000, "c1 " * 20_000)]
    queries = [(i, t) for i, t in docs[:40:8]] + [(1, "r1 r2"), (2, None), (3, "absent"), (4, "c1 c1 r7 é É"), (4, "c1 c1 r7 é É")]
    got = run(spark, docs, queries)
    assert len(got) == len(set(got)) and set(got) == brute(docs, queries, 7)


def test_ties_go_to_smaller_ids(spark):
    got = run(spark, [(i, "same words here") for i in range(30)] + [(99, "other")], [(0, "same")], 5)
    assert [(r[1], r[2]) for r in sorted(got)] == [(i + 1, i) for i in range(5)]


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == []


def shard_of(docs):
    batch = pa.record_batch([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], names=["doc_id", "text"])
    (made,) = search._shards(iter([batch]))
    cells = {n: made.column(n)[0] for n in made.schema.names}
    return search.Shard({n: c.as_buffer() if pa.types.is_binary(c.type) else c.as_py() for n, c in cells.items()}, 2.0)


def test_blocks_are_skipped():
    docs = [(i, "common filler " + ("common " * 30 if i // 64 == 1 else "")) for i in range(640)]
    shard = shard_of(docs)
    terms = np.sort(np.concatenate([t for _, _, t, _ in search._words(pa.array(["common"]))]))
    (found,) = search.search_shard(shard, [(terms, np.ones(1))], [np.full(5, -np.inf)], 5)
    assert set(found[0].tolist()) == set(range(64, 128)) and shard.scored == 1 and shard.blocks == 10
    found = search.search_shard(shard, [(terms, np.ones(1))], [np.full(5, 99.0)], 5)  # better ones are known
    assert len(found[0][0]) == 0 and shard.scored == 1


def weighed(text):
    terms, counts = np.unique(np.concatenate([t for _, _, t, _ in search._words(pa.array([text]))]), return_counts=True)
    return terms, counts.astype(float)


def test_list_maxima_leave_the_shard():
    rare = [f"r{i}" for i in range(30)]
    docs = [(i, " ".join(rare) if 64 <= i < 70 else "" if i % 4 else rare[i // 64 * 3 + i % 3]) for i in range(640)]
    shard = shard_of(docs)
    assert len(shard.dense) == 0 and len(shard.terms) == 30  # no list is frequent
    (found,) = search.search_shard(shard, [weighed(" ".join(rare))], [np.full(3, -np.inf)], 3)
    assert set(found[0].tolist()) == set(range(64, 70)) and (shard.scored, shard.read) == (1, len(shard.docs))
    (found,) = search.search_shard(shard, [weighed("r1")], [np.full(3, 99.0)], 3)  # the maximum of the list is too low
    assert len(found[0]) == 0 and (shard.scored, shard.read) == (1, len(shard.docs))


def test_pivots_lose_nothing():
    docs, rng = corpus(2000, 5), np.random.default_rng(3)
    queries = [weighed(t or "c1") for _, t in docs[:600:2]] + [weighed("c1"), weighed("absent")]
    whole = [shard_of(docs[a:a + 700]) for a in range(0, 2000, 700)]
    order = rng.permutation(len(whole)).tolist()
    best = [np.full(9, -np.inf) for _ in queries]
    got = [[] for _ in queries]
    for s in order:
        for i, (doc, score) in enumerate(search.search_shard(whole[s], queries, best, 9)):
            got[i] += zip((-score.round(6)).tolist(), (doc + 700 * s).tolist())
    for i, (terms, weight) in enumerate(queries):
        plain = []
        for s, shard in enumerate(whole):
            total = np.zeros(shard.n)
            for t, w in zip(shard.find(terms), weight):
                if t >= 0:
                    run = slice(shard.begins[t], shard.ends[t])
                    total[shard.docs[run]] += w * shard.gain[run]
            plain += [(-x, d + 700 * s) for d, x in enumerate(total.round(6).tolist()) if x > 0]
        assert sorted(got[i])[:9] == sorted(plain)[:9]
    assert sum(s.scored for s in whole) < len(queries) * sum(s.blocks for s in whole)


def test_frequencies_are_counted_once(spark):
    docs = [(i, f"c{i % 3} same") for i in range(50)] + [(99, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    counts = search.document_frequencies(search.build_index(df))
    assert sorted(r.df for r in counts.collect()) == [16, 17, 17, 50]


def test_the_best_of_a_task():
    best = search.Best(2, 3, pa.int64())
    best.add(0, pa.array([5, None, 7, 1]), np.array([1.0, 1.0, 2.0, 0.5]))
    best.add(0, pa.array([2, 3]), np.array([1.0, 3.0]))
    (rows,) = best.rows(pa.array(["a", "b"]))
    assert list(zip(*(c.to_pylist() for c in rows.columns))) == [("a", 0, 3, 3.0), ("a", 0, 7, 2.0), ("a", 0, None, 1.0)]
