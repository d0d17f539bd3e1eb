"""CSV records with line breaks in quotes, split among tasks at any place."""

import csv
import io

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesflow.sources import records
from salesflow.sources.files import ingest_csv, refused_lines

KIND = "a string, b string, c string"


@pytest.fixture()
def split_at(spark):
    """Read files in splits of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def choose(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)

    yield choose
    for n, v in old.items():
        spark.conf.set(n, v)


def write(folder, *texts):
    import pathlib
    path = pathlib.Path(folder)
    path.mkdir()
    for i, text in enumerate(texts):
        (path / f"{i}.csv").write_bytes(text.encode())
    return str(path)


def as_csv(rows, ends="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=ends).writerows(rows)
    return out.getvalue()


def rows_like(n, seed=3):
    rng = np.random.default_rng(seed)
    cells = ["x", "two\nlines", 'q"uote', 'end"\n', "a,b", '"\n\n"', "\n,\n", "é\n漢", "plain text", '",\n"']
    return [[f"r{i}", *rng.choice(cells, 2).tolist()] for i in range(n)]


@pytest.mark.parametrize("size", [150, 1 << 20])
def test_breaks_in_every_column_and_any_split(spark, folder, split_at, size):
    rows = [["a\n1", "b", "c\n"], *rows_like(120)]
    path = write(folder("csv"), as_csv(rows), as_csv([["a", "b", "c"], *rows_like(50, 4)]))
    schema = spark.createDataFrame([], KIND).schema
    split_at(size)
    tasks = spark.read.text(path).rdd.getNumPartitions()
    assert tasks > 15 or size > 1000
    out = folder("out")
    got = sorted(tuple(r) for r in ingest_csv(spark, path, out, schema, records=True).collect())
    assert got == sorted(map(tuple, rows[1:] + rows_like(50, 4)))
    assert refused_lines(spark, out, schema).count() == 0
    split_at(1 << 20)
    whole = ingest_csv(spark, path, folder("whole"), schema, multi_line=True)
    assert got == sorted(map(tuple, whole.collect()))


def test_quotes_that_open_nothing(spark, folder, split_at):
    lines = ["a,b,c", '1,5" pipe,x', '2,"a"b,y', '3,"",z', "", '4,"say ""hi""",w', "5,,"]
    path = write(folder("csv"), "\r\n".join(lines) + "\r\n")
    schema = spark.createDataFrame([], KIND).schema
    plain = sorted(map(tuple, ingest_csv(spark, path, folder("plain"), schema).collect()), key=str)
    for size in (25, 1 << 20):
        split_at(size)
        got = ingest_csv(spark, path, folder("out"), schema, records=True).collect()
        assert sorted(map(tuple, got), key=str) == plain and len(plain) == 5


def test_a_quote_never_closed_and_a_long_record_stay_on_record(spark, folder, split_at):
    path = write(folder("csv"), 'a,b,c\n1,x,y\n2,"open,z\n3,x,y\n4,x,y\n')
    schema, out = spark.createDataFrame([], KIND).schema, folder("out")
    split_at(20)
    assert [tuple(r) for r in ingest_csv(spark, path, out, schema, records=True).collect()] == [("1", "x", "y")]
    bad = refused_lines(spark, out, schema).collect()
    assert sorted(r.line for r in bad) == ['2,"open,z', "3,x,y", "4,x,y"] and all(r.dropped for r in bad)
    path = write(folder("csv"), 'a,b,c\n1,"' + "long\n" * 30 + '",y\n2,"a\nb",y\n')
    found = records.csv_records(spark, path, longest=50).collect()
    assert [r.record for r in found if not r.torn] == ['2,"a\nb",y']
    assert len([r for r in found if r.torn]) == 31


def test_wrong_fields_and_types_of_records(spark, folder):
    path = write(folder("csv"), 'a,b\n1,"x\ny"\nn,"p\nq"\n3,"u\nv",w\n')
    schema, out = spark.createDataFrame([], "a long, b string").schema, folder("out")
    rows = ingest_csv(spark, path, out, schema, records=True).collect()
    assert sorted(map(tuple, rows), key=str) == [(1, "x\ny"), (None, "p\nq")]
    assert [r.line for r in refused_lines(spark, out, schema).collect() if r.dropped] == ['3,"u\nv",w']


def test_empty_files_and_headers_alone(spark, folder):
    schema = spark.createDataFrame([], KIND).schema
    for text in ("", "a,b,c", 'a,"b\nb",c\n'):
        path = write(folder("csv"), text)
        assert ingest_csv(spark, path, folder("out"), schema, records=True).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text('a",', max_size=6), min_size=1, max_size=8), st.lists(st.integers(0, 8), max_size=4))
def test_states_of_lines_against_a_machine(lines, cuts):
    def machine(state, line):  # S field start, U text, Q quoted, E quote in quotes
        state = "Q" if state else "S"
        for c in line:
            if state == "Q":
                state = "E" if c == '"' else "Q"
            elif state == "E" and c == '"':
                state = "Q"
            elif c == ",":
                state = "S"
            elif state == "S" and c == '"':
                state = "Q"
            else:
                state = "U"
        return int(state == "Q")

    edges = [0, *sorted(min(c, len(lines)) for c in cuts), len(lines)]
    batches = [pa.record_batch([pa.array([1] * (b - a), pa.int64()), pa.array([0] * (b - a), pa.int64()),
                                pa.array([x.encode() for x in lines[a:b]], pa.binary())], names=["file", "split", "value"])
               for a, b in zip(edges, edges[1:])]
    passed = [p for _, first, _, p in records._passed(iter(batches), ",") if first is not None]
    for s in (0, 1):
        state, want = s, []
        for line in lines:
            want.append((state, machine(state, line)))
            state = want[-1][1]
        got = [(int(x), int(y)) for p in passed for x, y in zip(p[s][0], p[s][1])]
        assert got == want
