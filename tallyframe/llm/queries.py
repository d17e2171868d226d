"""Registered queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import byte_bpe
from tallyframe.llm.attention_lm import lm_scores
from tallyframe.llm.chat_format import CONTROL, END, SEP, START, format_conversations, masked_texts, read_back, unescape
from tallyframe.llm.exact_dedup import verdicts as exact_verdicts
from tallyframe.llm.fill_in_middle import fill_in_middle, restored
from tallyframe.llm.html_extract import extract
from tallyframe.llm.kneser_ney import quality_scores
from tallyframe.llm.licenses import license_scan
from tallyframe.llm.mixing import mixed
from tallyframe.llm.packing import packed_pieces
from tallyframe.llm.quality_rules import BASE, quality_verdicts
from tallyframe.llm.rows import table
from tallyframe.llm.simhash import near_duplicates
from tallyframe.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, books_sha256, vector_codes


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents, dropped rows included."""
    return exact_verdicts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    out = mixed(table(spark, sf_dir, "documents"))
    return out.select("id", "size", "source_size", "target", "taken").withColumnRenamed("id", "doc_id")


def _chat_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the formatted conversations hold, read back from them."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            formatted, ends, learnt = (batch.column(c)[i].as_py() for c in ("formatted", "ends", "loss_mask"))
            turns = read_back(formatted)
            loss = "".join(map(unescape, masked_texts(formatted, np.array(ends, np.int64), np.array(learnt, bool))))
            digests = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in turns), loss)]
            rows.append((len(turns), digests[0], len(loss), digests[1], len(formatted)))
        columns = [pa.array(x) for x in zip(*rows, strict=True)] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names)


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, and of one that holds control strings."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], conversations.schema)
    formatted = format_conversations(conversations.unionByName(probe)).select("conv_id", "formatted", "ends", "loss_mask")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(_chat_digests, schema)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families confirmed in every document."""
    return license_scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return out.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule figures and verdict of every document."""
    out = quality_verdicts(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), *BASE, "base_failed", "kept", "p_good")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a packed sequence."""
    return packed_pieces(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text, and whether it is kept."""
    out = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), "lang", "size", "bits", "perplexity", "threshold", "kept")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and attention-model score of every document."""
    return lm_scores(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and errors of every vector, and a digest of the codebooks."""
    codes, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return codes.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and the text decoded from them again."""
    found = byte_bpe.round_trip(table(spark, sf_dir, "documents"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                        sha(F.array_join("ids", " ")).alias("ids_sha256"), sha(F.col("text")).alias("decoded_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and cuts of every document, and the text rebuilt from the output."""
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return out.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                      sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


#: The control strings of the template, as one pattern for the SQL: each gets one character more.
_CONTROL = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True)).replace("'", "''")
_MARKERS = len(START) + len(SEP) + len(END)

def _codebook_rounds() -> str:
    """The rounds of the vector codes in SQL: assignment, then averages; the last assignment has no averages after it."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""
won{i} AS MATERIALIZED (
    SELECT r, p, min(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x, y)])::BIGINT * {ENTRIES} + e) AS best
    FROM parts JOIN book{i} USING (p) GROUP BY r, p)""")
        if i < ROUNDS:
            steps.append(f"""
sum{i} AS (
    SELECT p, e, j, sum(a)::BIGINT AS s, count(*) AS c
    FROM (SELECT p, best % {ENTRIES} AS e, unnest(x) AS a, generate_subscripts(x, 1) AS j FROM parts JOIN won{i} USING (r, p))
    GROUP BY p, e, j),
book{i + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(m, y) AS y FROM book{i}
    LEFT JOIN (SELECT p, e, list((s - (s % c + c) % c) // c ORDER BY j) AS m FROM sum{i} GROUP BY p, e) USING (p, e))""")
    return ",".join(steps)


_SQL = {
    "op11_vector_codes": f"""
WITH whole AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, [floor({SCALE} * x)::BIGINT FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (
    SELECT r, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS x FROM whole, range({PARTS}) AS t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS y FROM parts WHERE r <= {ENTRIES}),{_codebook_rounds()},
coded AS (
    SELECT r, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY p) AS code, sum(best // {ENTRIES})::BIGINT AS error
    FROM won{ROUNDS} GROUP BY r),
digest AS (
    SELECT sha256(string_agg(c, ',' ORDER BY p, e)) AS codebooks_sha256
    FROM (SELECT p, e, array_to_string(y, ',') AS c FROM book{ROUNDS}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM whole JOIN coded USING (r), digest
""",
    "op13_fill_in_middle": r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h
    FROM documents
),
draws AS (
    SELECT *, len(u) AS n, [('0x' || substr(h, 8 * k - 7, 8))::BIGINT for k in [1, 2, 3, 4]] AS d FROM units
),
cuts AS (
    SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d[3] % 100 >= 90 THEN 'plain'
                WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM draws
),
parts AS (
    SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""",
    "op3_chat_formatting": rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
joined AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
           coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
           sum({_MARKERS} + length(role) + length(text) + len(regexp_extract_all(role, '{_CONTROL}'))
               + len(regexp_extract_all(text, '{_CONTROL}')))::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM joined
""",
    "op1_exact_dedup": r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY n DESC, doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM d
""",
}

_QUERIES = [
    op1_exact_dedup, op2_mix_sources, op3_chat_formatting, op4_license_scan, op5_simhash_near_dedup, op6_html_extraction,
    op7_quality_rules, op8_best_fit_packing, op9_quality_classifier, op10_lm_scoring, op11_vector_codes, op12_byte_bpe, op13_fill_in_middle,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, sql in _SQL.items()}
