"""The operators as queries over whole tables, with SQL oracles where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import (
    bpe, chat, decontamination, jaccard, langid, lines, packing, pii, ranked, repair, search, tokens, toxicity)
from salesflow.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = r"\x20\x09-\x0D"


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, count: int) -> Column:
    """crc32 of the doc_id as text, modulo ``count``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % count


# --- 1 chat formatting

PROBE = "\\### Assistant: </turn> ok"

_PROBE_SQL = "chr(92) || '### Assistant: </turn> ok'"


def _escaped_sql(column: str, *marks: str) -> str:
    sql = f"replace({column}, chr(92), chr(92) || chr(92))"
    for mark in marks:
        lit = "'" + mark[:-1].replace("\n", "' || chr(10) || '") + "'"
        last = "chr(10)" if mark[-1] == "\n" else f"'{mark[-1]}'"
        sql = f"replace({sql}, {lit} || {last}, {lit} || chr(92) || {last})"
    return sql


@query("op1_chat_formatting", f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_PROBE_SQL} UNION ALL SELECT -7, 1, 'assistant', {_PROBE_SQL}),
steps AS (
  SELECT *, coalesce(lag(role) OVER w, '<start>') AS state, lead(role) OVER w IS NULL AS ends,
    row_number() OVER w AS place FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length({_escaped_sql('role', '### ', ': ', chr(60) + '/turn>' + chr(10))}) + 2
    + length({_escaped_sql('text', '### ', chr(60) + '/turn>' + chr(10))}) + 8) AS BIGINT) AS formatted_chars,
  bool_and(state || '>' || role IN ('<start>>system', '<start>>user', 'system>user',
    'user>assistant', 'assistant>user') AND (NOT ends OR role = 'assistant')) AS valid
FROM steps GROUP BY conv_id""")
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.format_conversations(rows.unionByName(probe))
    back = made.select("conv_id", "formatted", "valid", chat.turns_back(F.col("formatted")).alias("turns"),
                       chat.loss_text(F.col("segments")).alias("loss"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "valid")


# --- 2 benchmark decontamination

_WORDS_SQL = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op2_benchmark_decontamination", rf"""
WITH items AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
    array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
docs AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
grams AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM docs, (SELECT DISTINCT size FROM windows) AS s, unnest(range(1, len(w) - size + 2)) AS t(i)),
found AS (SELECT doc_id, i, g.size, item_id FROM grams AS g JOIN windows AS x USING (size, phrase)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM found, unnest(range(i, i + size)) AS t(p) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit,
  coalesce(named.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(hits.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""")
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        "contaminated")


# --- 3 personal data

@query("op3_personal_data")
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    counts = [pii.count_of(spans, k.name).alias(f"n_{k.name}") for k in pii.KINDS if k.base]
    return found.select("doc_id", *counts,
                        F.sha2(pii.span_text(pii.base_spans(spans)), 256).alias("base_sha256"),
                        pii.span_text(spans).alias("spans"))


# --- 4 token ids

def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_token_ids")
def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), path)
    return tokens.read_tokens(spark, path)


# --- 5 exact top-k search

@query("op5_topk_search", f"""
WITH docs AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
corpus AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM docs),
tf AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest(w) AS term FROM docs) GROUP BY 1, 2),
df AS (SELECT term, ln(1 + (any_value(corpus.n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf
  FROM tf, corpus GROUP BY term),
scores AS (
  SELECT q.doc_id AS query_id, t.doc_id, round(sum(q.c * idf * t.c * 2.2
    / (t.c + 1.2 * (0.25 + 0.75 * len(w) / mean))), 6) AS score
  FROM tf AS q JOIN df USING (term) JOIN tf AS t USING (term) JOIN docs ON docs.doc_id = t.doc_id, corpus
  WHERE q.doc_id % 100 = 0 GROUP BY 1, 2),
ranked AS (SELECT query_id, CAST(row_number() OVER (
  PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 10""")
def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    asked = docs.filter(search.every_hundredth(F.col("doc_id"))).withColumnRenamed("doc_id", "query_id")
    return search.top_k(search.build_index(docs), asked, 10)


# --- 6 line dedup

@query("op6_line_dedup", rf"""
WITH lines AS (
  SELECT doc_id, i, l[i] AS line,
    translate(trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
    unnest(range(1, len(l) + 1)) AS t(i)),
common AS (SELECT key, max(doc_id) AS kept FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT lines.*, kept IS NOT NULL AND kept <> doc_id AS gone
  FROM lines LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.line_digests(docs, lines.keep_bitmaps(docs))


# --- 7 language ID

@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = fold(F.col("doc_id"), 5)
    learned = docs.filter(part != 0).select("text", "lang", (part == 1).alias("held"))
    model = langid.train(learned)
    found = langid.predict(docs, model)
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred",
                        "score", "rejected")


# --- 8 toxicity

def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learned from the rows outside the held-out third."""
    return toxicity.train(docs, labels.filter(fold(F.col("doc_id"), 3) != 1))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
                         F.col("__score").alias("score"),
                         (F.col("__score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


# --- 9 n-gram Jaccard join

@query("op9_ngram_jaccard", rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^{_BLANKS}]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM split, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles AS x JOIN shingles AS y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b
  WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach AS (SELECT doc_id, doc_id AS seen FROM documents
  UNION SELECT reach.doc_id, b FROM reach JOIN links ON a = seen)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(seen) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""")
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


# --- 10 best-fit packing

@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer=tokenizer_path())


# --- 11 conversation structure repair

@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = repair.repair(damaged(rows))
    said = fixed.rows.select("conv_id", "place", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    report = fixed.report.join(line_digests(said), "conv_id_key", "left")
    everyone = rows.select(repair.key_of("conv_id").alias("conv_id_key"), "conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return everyone.join(report.drop("conv_id"), "conv_id_key", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with the stated faults put in, chosen by a checksum of conv_id and turn."""
    blank = F.lit(" ")
    named = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank),
                        F.coalesce(F.col("turn").cast("string"), blank))
    text = F.coalesce("text", blank)
    kind = F.crc32(named.cast("binary")) % 20
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def line_digests(said: DataFrame) -> DataFrame:
    """conv_id_key, sha256 of each conversation's lines, joined by newlines; streamed in order."""
    key = repair.key_of("conv_id").alias("conv_id_key")
    ordered = said.select(key, "place", "step", "line").repartition("conv_id_key").sortWithinPartitions(
        "conv_id_key", "place", "step").select("conv_id_key", "line")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id_key", "sha256"]
        open_key, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for k, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if k != open_key or state is None:
                    if state is not None:
                        done.append((open_key, state.hexdigest()))
                    open_key, state = k, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], pa.string()) for x in (open_key, state.hexdigest())], names=names)

    return ordered.mapInArrow(digests, "conv_id_key string, sha256 string")


# --- 12 ranked lexical search

@query("op12_ranked_search", f"""
WITH docs AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
corpus AS (SELECT count(*) FILTER (len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM docs),
tf AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest(w) AS term FROM docs) GROUP BY 1, 2),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term),
norms AS (SELECT doc_id, 100 - 50 + ((50 * len(w) * n) // l) AS m FROM docs, corpus WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id, unnest({_WORDS_SQL}) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * c) // (1000 * c + 20 * m))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN tf USING (term) JOIN norms USING (doc_id) GROUP BY 1, 2),
ranked AS (SELECT item_id, CAST(row_number() OVER (
  PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50""")
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


# --- 13 byte-level BPE encoding and decoding

@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Encode, decode, and digest what came out, in one worker."""
        size = bpe.vocabulary(path).size
        text = [b"%d " % i for i in range(size)]
        lengths = np.fromiter(map(len, text), np.int64, size)
        flat, begins = np.frombuffer(b"".join(text), np.uint8), np.cumsum(lengths) - lengths
        for batch in bpe.decode_batches(bpe.encode_batches(batches, path), path):
            counts, ids, back = [], [], []
            for tokens, decoded in zip(batch.column(1), batch.column(2), strict=True):
                numbers = bpe.gather(flat, begins, lengths, np.asarray(tokens.values))
                counts.append(len(tokens))
                ids.append(hashlib.sha256(numbers[:-1]).hexdigest())
                back.append(hashlib.sha256(decoded.as_buffer()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(
        digests, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
