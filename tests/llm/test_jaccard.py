"""Links and components against all pairs."""

import os
import subprocess
import sys

import numpy as np
import pyarrow as pa

from salesflow.llm import jaccard, textscan
from salesflow.llm.components import components
from salesflow.llm.textscan import PIECE_BYTES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    part = list(range(len(docs)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, j in links:
        part[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(docs):
        ids.setdefault(root(i), []).append(d)
    distinct = {frozenset((frozenset(sets[i]), frozenset(sets[j]))) for i, j in links if sets[i] != sets[j]}
    return [(d, len(s), min((x for x in ids[root(i)] if x is not None), default=None) if s else d)
            for i, ((d, _), s) in enumerate(zip(docs, sets))], distinct


def corpus(seed=3):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    shared = " ".join(rng.choice(vocabulary, 60))
    docs, n = [], 0
    for _ in range(25):
        text = rng.choice(vocabulary, rng.integers(6, 150)).tolist()
        for _ in range(rng.integers(1, 12)):
            copy = list(text)
            for _ in range(rng.integers(0, 3)):
                copy[rng.integers(len(copy))] = rng.choice(vocabulary)
            docs.append((n, " ".join(copy)))
            text = copy if rng.random() < 0.5 else text
            n += 1
    docs += [(n + i, shared + " " + " ".join(rng.choice(vocabulary, rng.integers(1, 25)))) for i in range(60)]
    return docs + [(1000, None), (1001, ""), (1002, " \n"), (1003, "a b"), (1004, "A\tB"), (1005, "b a"), (None, "a b"), (1006, None),
                   (7, "a b"), (7, "completely different words in here"), (1007, "long " * 30_000)]


def frame(spark, docs):
    return spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, node int, n int").repartition(3)


def test_components(spark):
    docs = corpus()
    got = jaccard.near_duplicates(frame(spark, docs)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(docs)[0], key=str)


def test_all_links(spark):
    docs = corpus(5)
    members, links = jaccard.similar_sets(frame(spark, docs), all_links=True)
    assert links.count() == links.select("a", "b").distinct().count() == len(brute(docs)[1])


def test_large_near_copy_group(spark):
    rng = np.random.default_rng(0)
    text = [f"w{i}" for i in range(80)]
    docs = []
    for i in range(300):
        copy = list(text)
        copy[rng.integers(80)] = f"x{i}"
        docs.append((i, " ".join(copy)))
    got = jaccard.near_duplicates(frame(spark, docs)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs)[0])


def test_a_common_passage_makes_no_long_lists(spark):
    passage = " ".join(f"common{k}" for k in range(60))
    texts = [" ".join(f"own{i}x{k}" for k in range(60)) + " " + passage for i in range(160)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16)
    sets, hot = jaccard.document_sets(docs, 5)
    assert hot.isEmpty()  # too few in each task
    clashes = jaccard.Clashes.of(sets)
    hot = jaccard.frequent_in_prefixes(docs, hot, 3, 5, 80, clashes)
    lists = jaccard.prefix_lists(docs, hot, 3, 5, 80, clashes).join(hot, "shingle", "left_anti")
    assert all(r["count"] <= 2 * jaccard.LIST_MOST for r in lists.groupBy("shingle").count().collect())
    assert not jaccard.near_duplicates(docs).filter("component_id <> doc_id").count()


def test_empty_table(spark):
    assert jaccard.near_duplicates(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_long_chain(spark):
    links = spark.range(300).selectExpr("(id * 7919) % 1000003 AS a", "((id + 1) * 7919) % 1000003 AS b")
    found = components(links).select("component").distinct().collect()
    assert [r[0] for r in found] == [0]


def test_sets_that_share_a_key_stay_apart(spark):
    docs = corpus(8)[:80]
    keys = [jaccard.set_key(s) for s in jaccard.shingle_sets(pa.array([t for _, t in docs]), 5)]
    other = (keys[0][0], keys[0][1] + 1)
    kept = jaccard.Clashes({keys[0][0]: keys[0][1]})
    assert kept.node(keys[0]) == keys[0][0] and kept.node(other) == other[0] ^ other[1] and kept.node(keys[-1]) == keys[-1][0]
    rows = spark.createDataFrame([(1, *keys[0], 3), (2, *other, 3), (3, *keys[-1], 3), (4, 0, 0, 0), (5, 0, 1, 0)],
                                 "doc_id long, node long, check long, n long")
    found = jaccard.Clashes.of(rows)
    assert found.kept == {keys[0][0]: min(keys[0][1], other[1])}
    assert {(r.doc_id, r.node) for r in found.nodes(rows).collect()} == {
        (1, found.node(keys[0])), (2, found.node(other)), (3, keys[-1][0]), (4, 0), (5, 0)}


def test_a_long_text_has_the_set_of_its_parts():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 90_000, 400_000)] + ["x" * 3_000_000] + ["end", "of", "it"] * 4
    long = "\t".join(words)
    (got,) = jaccard.shingle_sets(pa.array([long]), 5)
    assert len(long) > 2 * PIECE_BYTES and len(got) == len({tuple(words[i:i + 5]) for i in range(len(words) - 4)})
    short = " ".join(words[:50])
    (some,) = jaccard.shingle_sets(pa.array([short]), 5)
    assert set(some.tolist()) <= set(got.tolist())
    (lone,) = jaccard.shingle_sets(pa.array([" " + "y" * 2_500_000 + " "]), 5)
    assert len(lone) == 1


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    cuts = np.unique(rng.integers(0, 5000, 120))
    starts, ends = cuts[:-1], cuts[1:]
    plain = [sum((int(c) + 1) * pow(textscan._BASE, i, 1 << 64) for i, c in enumerate(data[a:b])) % (1 << 64)
             for a, b in zip(starts, ends)]
    want = textscan.mix(np.array(plain, np.uint64) + textscan.mix((ends - starts).astype(np.uint64)))
    for size in (1, 10, 64, 1 << 17):
        monkeypatch.setattr(textscan, "HASH_BYTES", size)
        monkeypatch.setattr(textscan, "_powers", {})
        assert np.array_equal(textscan.span_hashes(data, starts, ends), want)


def test_memory_of_a_very_long_text():
    """A text of 31 MB takes a worker less than 400 MB, beyond what the text itself and the imports take."""
    code = """
import resource, numpy as np, pyarrow as pa
from salesflow.llm import jaccard
text = pa.array([" ".join(f"w{i}" for i in np.random.default_rng(1).integers(0, 10 ** 6, 4_000_000))])
size = text.nbytes
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
(found,) = jaccard.shingle_sets(text, 5)
print(size, len(found), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=ROOT)
    size, found, grown = map(int, out.stdout.split())
    assert size > 27_000_000 and found > 3_900_000 and grown < 400
