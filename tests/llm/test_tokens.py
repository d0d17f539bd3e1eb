"""Exact round trips of the token files and of the block codec."""

import os
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesflow.llm import rans, tokens
from salesflow.llm.queries import tokenizer_path

TEXTS = ["", "  a", "a  b", "a\n\nb", "\n \n x", "don't  I'll", "a\tb  \t c", "x ", "日本 語", "<|endoftext|> y",
         "12 ab34!! ?? \n", "é É  ñ1", "'s", " 's", "\r\n\r\nab", "  x", "\x00\x1f", "ab" * 30_000, " " * 5000, "a b " * 20_000]


@given(st.lists(st.integers(0, 40), min_size=1, max_size=700), st.integers(1, 9), st.integers(1, 5))
@settings(max_examples=60, deadline=None)
def test_codec(ids, lanes, every):
    ids = np.array(ids, np.uint16)
    table = rans.Table.of(rans.scaled(np.bincount(ids, minlength=41), 12))
    block = rans.encode(ids, table, lanes, every)
    assert np.array_equal(rans.decode(block, table), ids)
    parts = [rans.decode_part(block, table, k) for k in range(rans.checkpoints(block))]
    assert np.array_equal(np.concatenate(parts), ids)


def test_damage_is_noticed():
    ids = np.arange(5000) % 50
    table = rans.Table.of(rans.scaled(np.bincount(ids), 12))
    block = bytearray(rans.encode(ids, table))
    block[-9] ^= 1
    with pytest.raises(ValueError):
        rans.decode(bytes(block), table)
    with pytest.raises(ValueError):
        rans.decode(b"XXXX" + bytes(block[4:]), table)


@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x300), max_size=40), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_encoder_equals_library(texts):
    known = tokens.encoder(tokenizer_path())
    ids, counts = known.encode(pa.array(texts))
    expected = [e.ids for e in known.library.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in expected] and ids.tolist() == sum(expected, [])


def brute(rows):
    library, out, start = Tokenizer.from_file(tokenizer_path()), [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(df, spark, folder):
    path = folder("tokens")
    tokens.write_tokens(df, tokenizer_path(), path)
    return sorted(map(tuple, tokens.read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()),
                  key=lambda r: r[1])


def test_files(spark, folder):
    rows = [(i * 3 % 20, t) for i, t in enumerate(TEXTS)] + [(None, "n"), (5, None), (5, "twice"), (5, "twice")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, part int, ids string")
    assert written(df.repartition(5), spark, folder) == brute(rows)


def test_whole_table(spark, sf_dir, folder):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert written(docs, spark, folder) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark, folder):
    assert written(spark.createDataFrame([], "doc_id long, text string"), spark, folder) == []


def test_order_of_a_repeated_id_in_any_number_of_parts(spark, folder):
    texts = [f"text number {i} " * (1 + i % 5) for i in range(300)]
    docs = spark.createDataFrame([(7, t) for t in texts] + [(None, "x"), (8, "y")], "doc_id long, text string")
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    before, found = {k: spark.conf.get(k) for k in keys}, []
    try:
        for parts, adaptive in (("1", "true"), ("7", "false"), ("4", "false")):
            spark.conf.set(keys[0], parts)
            spark.conf.set(keys[1], adaptive)
            path = folder("tokens")
            tokens.write_tokens(docs.repartition(3), tokenizer_path(), path)
            found.append([(r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in
                          tokens.read_tokens(spark, path).orderBy("start").collect()])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found[0] == found[1] == found[2] and len(found[0]) == 302


def test_without_the_tokenizers_package():
    """All other queries can be used: the package is imported where ids are made."""
    code = """
import sys
sys.modules["tokenizers"] = None
import __spark_entry__
print(len(__spark_entry__.queries()), "op4_token_ids" in __spark_entry__.queries())
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=root)
    assert int(out.stdout.split()[0]) > 120
