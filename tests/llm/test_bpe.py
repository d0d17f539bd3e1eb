"""Byte-level BPE against the public library, round trips and odd texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.errors import PythonException

from salesflow.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["'", "'s", "'re", "'ll", "'t", "'ve", " ", "  ", "\n", "\t", "a", "st", "ve", "é", "中文", "١٢", "1", "!", "　", "\xa0",
         "\x85", "😀", "\x1c", "ll", "'S", "é", "Ᲊ", "\U00010d40", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=bpe.vocabulary(PATH).ranks, special_tokens={})


def fuzz(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(n)]


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_the_pattern_is_the_one_the_scan_stands_for():
    assert bpe.PATTERN_TEXT == public_tokenizers.PATTERN


@pytest.mark.parametrize("window", [1, 7, 64, 1 << 20])
def test_against_the_library(library, monkeypatch, window):
    monkeypatch.setattr(bpe, "WINDOW", window)
    texts = fuzz(300 if window < 64 else 5000, window) + ["x" * 900, "ab" * 700, "Qz9Xj" * 300, "中" * 400, " " * 500 + "a", "\n " * 99]
    ids, counts = bpe.Encoder(bpe.vocabulary(PATH)).encode(pa.array([*texts, None]))
    assert split(ids, counts) == [library.encode_ordinary(t) for t in texts] + [[]]


def test_classes_are_the_library_s():
    """Every code point: what a run of letters, numbers or white space takes in."""
    points = "".join(map(chr, [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]))
    single = {bytes([i]): i for i in range(256)}
    kinds = bpe.classes()
    for pattern, wanted in ((r"\p{L}", [bpe.LETTER]), (r"\p{N}", [bpe.NUMBER]), (r"\s", [bpe.SPACE, bpe.WHITE])):
        found = bytes(tiktoken.Encoding("one", pat_str=pattern, mergeable_ranks=single, special_tokens={})
                      .encode_ordinary(points)).decode()
        assert found == "".join(c for c in points if kinds[ord(c)] in wanted)


def test_scan_of_any_automaton():
    rng = random.Random(2)
    steps = [tuple(rng.randrange(3) for _ in range(3)) for _ in range(4)]
    scan = bpe.Scan(steps)
    symbols = np.array([rng.randrange(4) for _ in range(70_000)], np.uint8)
    state, wanted = 1, []
    for s in symbols.tolist():
        wanted.append(state)
        state = steps[s][state]
    got, last = scan.before(scan.symbol[symbols], 1)
    assert got.tolist() == wanted and last == state


def test_words_that_share_a_hash(library, monkeypatch):
    monkeypatch.setattr(bpe, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    texts = ["some words of the same size", "come wards"]
    ids, counts = bpe.Encoder(bpe.vocabulary(PATH)).encode(pa.array(texts))
    assert split(ids, counts) == [library.encode_ordinary(t) for t in texts]


def test_a_worker_forgets_in_time(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 10)
    encoder = bpe.Encoder(bpe.vocabulary(PATH))
    for text in fuzz(40, 9):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == library.encode_ordinary(text)


def test_tables_go_there_and_back(spark, library):
    texts = [*fuzz(200, 3), None, "", "same", "same", "long " * 100_000]
    rows = [(None if i % 50 == 0 else i, t, 5, "m") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, marks string").repartition(3)
    encoded = bpe.encode(df, PATH, stride=4)
    back = bpe.decode(encoded, PATH, stride=4).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded), r.ids) for r in back) == sorted(
        (i or 0, (t or "").encode(), library.encode_ordinary(t or "")) for i, t, *_ in rows)
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_part_of_a_text_from_its_marks(spark):
    text = " ".join(fuzz(3000, 4))
    (row,) = bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).collect()
    raw, words = text.encode(), bpe.vocabulary(PATH)
    for a, b in ((0, 10), (4000, 4100), (0, len(raw)), (len(raw) - 5, len(raw)), (7, 7)):
        assert bpe.byte_range(np.array(row.ids), np.array(row.marks), words, a, b) == raw[a:b]


def test_damaged_ids_are_an_error(spark):
    good = bpe.encode(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), PATH)
    for wrong in ("array(60000)", "array(-1)"):
        with pytest.raises(PythonException, match="not in the vocabulary"):
            bpe.decode(good.selectExpr("doc_id", f"{wrong} AS ids", "marks"), PATH).collect()
    with pytest.raises(PythonException, match="do not fit their marks"):
        bpe.decode(good.selectExpr("doc_id", "ids", "array(5L) AS marks"), PATH).collect()


def test_query_against_the_library(spark, sf_dir, library):
    docs = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    wanted = set()
    for d in docs:
        ids = library.encode_ordinary(d["text"] or "")
        wanted.add((d["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((d["text"] or "").encode()).hexdigest()))
    got = list(map(tuple, queries.QUERIES["op13_byte_bpe"](spark, sf_dir).collect()))
    assert len(got) == len(docs) and set(got) == wanted
