"""Line dedup against a plain count."""

from collections import defaultdict

from salesflow.llm import lines

LONG = "This line stands in many documents"
BLANKS = " \t\n\v\f\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(docs):
    where = defaultdict(set)
    for d, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                where[key(x)].add(-1 if d is None else d)
    out = []
    for d, t in docs:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if len(where[key(x)]) < 3 or max(where[key(x)]) == (-1 if d is None else d)]
        out.append((d, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def cases():
    docs = [(i, f"{LONG}\nown line number {i} of this text") for i in range(40)]
    docs += [(100, f"\t {LONG.upper()} \r\n{LONG}\n{LONG}"), (50, None), (51, ""), (52, "\n\n"), (53, f"{LONG}\n"), (54, f"\n{LONG}")]
    docs += [(60, "only twice in the whole corpus"), (61, "only twice in the whole corpus"), (62, "short"), (63, "short"), (64, "short")]
    docs += [(70, "same document, three rows here"), (70, "same document, three rows here"), (70, "same document, three rows here\nx")]
    docs += [(80 + i, "ÄÖÜ äöü line with twenty points") for i in range(3)] + [(None, LONG), (None, f"a\n{LONG}")]
    docs += [(90 + i, "é" * 19) for i in range(3)] + [(95 + i, "é" * 20 + "\n" + "w" * 150_000) for i in range(3)]
    docs += [(200 + i, f"tab\there and twenty {i % 2} points") for i in range(6)]
    return docs


def kept(spark, docs, parts):
    df = spark.createDataFrame([(d, t, 1, "y") for d, t in docs], "doc_id long, text string, line int, keep string")
    return lines.drop_lines(df.repartition(parts)), lines.line_digests(df, lines.keep_bitmaps(df))


def test_against_count(spark):
    docs = cases()
    dropped, digests = kept(spark, docs, 3)
    expected = brute(docs)
    assert sorted(((r.doc_id, r.text or "") for r in dropped.collect()), key=str) == sorted(((e[0], e[3]) for e in expected), key=str)
    assert dropped.columns == ["doc_id", "text", "line", "keep"]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped) for r in digests.collect()), key=str) == sorted((e[:3] for e in expected), key=str)


def test_a_line_in_most_documents(spark):
    docs = [(i, f"{LONG} \n" * (1 + i % 3) + str(i)) for i in range(6000)]
    assert sorted((r.doc_id, r.text) for r in kept(spark, docs, 7)[0].collect()) == sorted((e[0], e[3]) for e in brute(docs))


def test_empty_table(spark):
    a, b = kept(spark, [], 1)
    assert a.count() == b.count() == 0


def test_rows_as_documents(spark):
    rows = [(None, LONG)] * 30 + [(7, f"{LONG}\nx")] * 3 + [(5, f"{LONG}\n{LONG}"), (None, None)]
    df = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, place long").repartition(4)
    got = lines.drop_lines(df, row="place").collect()
    kept = [r for r in got if LONG in (r.text or "")]
    assert len(got) == len(rows) and [(r.doc_id, r.place) for r in kept] == [(7, 30)]
    assert [r.text for r in got if r.doc_id == 5] == [""]
    few = spark.createDataFrame([(1, LONG, 0), (1, LONG, 1)], "doc_id long, text string, place long")
    assert [r.text for r in lines.drop_lines(few, row="place").collect()] == [LONG, LONG]


def test_columns_of_any_name(spark):
    docs = [(i, f"{LONG}\n{i}") for i in range(5)]
    names = ["doc", "which", "keep", "__doc", "__hash", "__keep", "h1", "part", "line"]
    df = spark.createDataFrame([(d, t, *names) for d, t in docs],
                               "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    got = lines.drop_lines(df).collect()
    assert {tuple(r[2:]) for r in got} == {tuple(names)}
    assert sorted((r.doc_id, r.text) for r in got) == sorted((e[0], e[3]) for e in brute(docs))


def test_a_key_in_many_partitions(spark):
    """A line in every document, in partitions of few rows: what is settled goes to each of them."""
    docs = [(i, f"{LONG}\n{LONG}\n{i}") for i in range(900)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = [(r.doc_id, r.text) for r in kept(spark, docs, 5)[0].collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got) == sorted((e[0], e[3]) for e in brute(docs))
