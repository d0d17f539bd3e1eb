"""Each stage against brute force on its own input."""

import os

import corpus_pipeline as P
import test_decontamination as contamination
import test_jaccard as similar
import test_lines as repeated
from salesflow.llm import packing, toxicity
from salesflow.llm.queries import QUERIES
from salesflow.session import stage

import __spark_entry__ as entry_point


def test_stages(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rejected = {r.doc_id for r in QUERIES["op8_toxicity"](spark, sf_dir).collect() if r.predicted}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    monkeypatch.setattr(contamination, "ITEMS", items)
    seen = []
    for name, function in P.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(function(spark, docs, sf_dir), name)
        after = {r.doc_id: getattr(r, "text", None) for r in out.collect()}
        if name == "toxicity":
            assert set(after) == set(before) - rejected
        elif name == "line_dedup":
            assert after == {e[0]: e[3] for e in repeated.brute(list(before.items()))}
        elif name == "ngram_jaccard":
            assert set(after) == {e[0] for e in similar.brute(list(before.items()))[0] if e[0] == e[2]}
        elif name == "decontamination":
            assert set(after) == {d for d, t in before.items() if not contamination.brute(t)[4]}
        else:
            assert set(after) == set(before)
            assert out.columns[0] == "doc_id" and set(out.columns) >= {"bin_id", "capacity"}
        if name != "packing":
            assert out.columns == list(P.COLUMNS)
            docs = out
        seen.append(len(after))
    assert entry_point.queries()["pipeline"](spark, sf_dir).select("doc_id").distinct().count() == seen[-1]


def test_five_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard", "decontamination", "packing"]
    assert toxicity.THRESHOLD == 0.7 and packing.LENGTHS


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_one_row_of_each_group_stays_with_null_and_repeated_ids(spark, sf_dir):
    first, second, third = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    near = first + " more"
    rows = [(7, first), (None, near), (3, near), (3, near), (3, "alone one"), (None, "alone two"),
            (None, second), (None, second), (None, second + " x"), (9, third), (9, third), (9, third),
            (None, None), (None, ""), (4, None), (4, None)]
    got = rows_of(P.drop_near_duplicates(spark, documents(spark, rows), sf_dir))
    assert [g for g in got if g[1] not in (second, second + " x")] == sorted(
        [(3, near), (3, "alone one"), (None, "alone two"), (9, third), (None, None), (None, ""),
         (4, None), (4, None)], key=str)
    assert [g[0] for g in got if g[1] in (second, second + " x")] == [None]


def test_benchmark_rows_go_with_null_and_repeated_ids(spark, folder):
    path, passage = folder(), "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    rows = [(None, f"x {passage} y"), (None, "clean"), (5, passage), (5, "clean too"), (5, "clean too"),
            (6, passage), (None, None), (None, passage)]
    got = rows_of(P.drop_benchmark_documents(spark, documents(spark, rows), path))
    assert got == sorted([(None, "clean"), (5, "clean too"), (5, "clean too"), (None, None)], key=str)


def test_repeated_lines_go_with_null_and_repeated_ids(spark, sf_dir):
    line = "a line that stands in many documents"
    rows = [(None, f"{line}\n{i}") for i in range(30)] + [(4, line), (4, line), (None, None), (None, "")]
    got = P.drop_repeated_lines(spark, documents(spark, rows), sf_dir)
    kept = rows_of(got)
    assert got.columns == list(P.COLUMNS) and len(kept) == len(rows)
    assert [k for k in kept if line in (k[1] or "")] == [(4, line)] and kept.count((4, "")) == 1
    assert {r.text: r.n_chars for r in got.collect() if r.text is not None} == {
        t: len(t) for _, t in kept if t is not None}


def test_toxic_rows_go_with_null_and_repeated_ids(spark):
    sf_dir = os.environ.get("TEST_TOXIC_DIR", "/root/testdata/sf0.01")  # the smallest tables have too few labels
    toxic = [r.doc_id for r in QUERIES["op8_toxicity"](spark, sf_dir).collect() if r.predicted]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    bad, clean = docs[toxic[0]], next(t for d, t in docs.items() if d not in toxic and t)
    rows = [(None, bad), (None, clean), (5, bad), (5, clean), (5, clean)]
    assert rows_of(P.drop_toxic(spark, documents(spark, rows), sf_dir)) == sorted(
        [(None, clean), (5, clean), (5, clean)], key=str)


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = documents(spark, [(1, "x")]).limit(0)
    for name, function in P.STAGES:
        out = function(spark, docs, sf_dir)
        assert out.count() == 0, name
        assert name == "packing" or out.columns == list(P.COLUMNS)
