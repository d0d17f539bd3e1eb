"""Spans against the plain patterns in Python."""

import re
import time

from salesflow.llm import pii
from salesflow.llm.queries import QUERIES

PATTERNS = {  # fixed values: the base patterns
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")),
            "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "")
            if passes(k, m.group())]


def spans(df):
    found = pii.find_personal_data(df)
    return found.select("doc_id", pii.span_text(found["spans"]).alias("s")).collect()


def base(s):
    return [x for x in s.split(",") if x.split(":")[0] in PATTERNS]


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = QUERIES["op3_personal_data"](spark, sf_dir).collect()
    assert len(got) == len(text) and any(r.spans for r in got)
    for r in got:
        assert base(r.spans) == brute(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(x.startswith(k + ":") for x in base(r.spans)) for k in PATTERNS]


def test_edges(spark):
    texts = [None, "", "é😀 a@b.cd😀x@y.z", "a@b.c_d@e.f", "foo@bar@baz.com", "1.2.3.4.5.6.7.8", "256.1.1.1 000001.2.3.255",
             "4111 1111 1111 1111 4111-1111-1111-1112", "12--34 " * 10, "+1 (202) 555-0147.", "+49+4912345678901", "+1" + " " * 500,
             "a" * 9000, "1" * 9000, "a.b@" * 900, "1.1" * 3000, "x@" + "a." * 3000 + "b", "+1-" * 3000]
    rows = [(i, t, "s", 1) for i, t in enumerate(texts)] + [(None, "a@b.cd", "s", 1), (2, texts[2], "s", 1)]
    got = spans(spark.createDataFrame(rows, "doc_id long, text string, spans string, email int"))
    assert sorted((r.doc_id, ",".join(base(r.s))) for r in got if r.doc_id is not None) == sorted(
        (i, ",".join(brute(t))) for i, t, *_ in rows if i is not None)
    assert len(got) == len(rows)


def test_added_kinds_and_context(spark):
    rows = [(1, "iban DE89370400440532013000 ok"), (2, "DE89370400440532013001"), (3, "GB29 NWBK 6016 1331 9268 19"),
            (4, "my ssn 123-45-6789"), (5, "part 123-45-6789"), (6, "card 4111111111111111"), (7, "4111111111111111")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.s for r in spans(df)}
    assert "iban:5:27" in got[1] and "iban" not in got[2] and got[3].endswith("iban:0:27")
    assert "ssn:7:18" in got[4] and "ssn" not in got[5]
    score = {r.doc_id: r.spans[0]["score"] for r in pii.find_personal_data(df.filter("doc_id > 5")).collect()}
    assert score[6] > score[7]


def test_empty_table(spark):
    assert spans(spark.createDataFrame([], "doc_id long, text string")) == []


def test_endless_words_take_linear_time(spark):
    texts = ["a" * 2_000_000, "1" * 1_000_000, "x@" + "a." * 300_000 + "b", "a.b@" * 200_000, "+1" + " " * 900_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    begun = time.monotonic()
    assert len(spans(df)) == len(texts) and time.monotonic() - begun < 60
