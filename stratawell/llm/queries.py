"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratawell.llm import (
    bayes_language,
    best_fit_packing,
    compression_bands,
    crf_extract,
    deobfuscation,
    filter_audit,
    hard_negatives,
    huffman_tokens,
    positional_index,
    repeated_substrings,
    separator_scan,
    shard_schedule,
    tensored_minhash,
)
from stratawell.llm.oracles import OP11_SQL, OP12_SQL, OP13_SQL
from stratawell.session import scratch_path

END_OF_TEXT = 49407  # of word_bpe_49k.json
DOCUMENT_END = 2  # closes each document of the Huffman files
Builder = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and compression verdict of every document."""
    return compression_bands.compression_bands(_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bin and offset of every document, by number of words."""
    return best_fit_packing.pack_documents(_table(spark, sf_dir, "documents"))


def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows cover."""
    return positional_index.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that start elsewhere too."""
    return repeated_substrings.removal_report(_table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents),
items AS (
    SELECT coalesce(cast(item_id AS varchar), 'null') AS item,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
    SELECT rid, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)),
found AS (SELECT rid, i, n, item FROM grams JOIN windows USING (n, gram)),
hit AS (
    SELECT rid, count(DISTINCT p) AS n_hit
    FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM found)) GROUP BY rid),
named AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item COLLATE "C") AS list
    FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid),
counts AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM docs) GROUP BY w),
ranked AS (
    SELECT item, t, row_number() OVER (PARTITION BY item ORDER BY n, off) AS r
    FROM (SELECT item, t, min(off) AS off, max(coalesce(n, 0)) AS n
          FROM (SELECT item, unnest(w) AS t, unnest(range(len(w))) AS off FROM items) s
          LEFT JOIN counts ON s.t = counts.w GROUP BY item, t)),
rare AS (SELECT item, t, r, max(r) OVER (PARTITION BY item) AS k FROM ranked WHERE r <= 3),
spots AS (SELECT rid, t, p FROM (SELECT rid, unnest(w) AS t, unnest(range(len(w))) AS p FROM docs) WHERE t IN (SELECT t FROM rare)),
near AS (
    SELECT a.rid, x.item FROM rare x JOIN spots a ON a.t = x.t AND x.r = 1 WHERE x.k = 1
    UNION
    SELECT a.rid, x.item FROM rare x JOIN spots a ON a.t = x.t AND x.r = 1
    JOIN rare y ON y.item = x.item AND y.r = 2 JOIN spots b ON b.t = y.t AND b.rid = a.rid AND abs(b.p - a.p) < 50
    WHERE x.k = 2
    UNION
    SELECT a.rid, x.item FROM rare x JOIN spots a ON a.t = x.t AND x.r = 1
    JOIN rare y ON y.item = x.item AND y.r = 2 JOIN spots b ON b.t = y.t AND b.rid = a.rid AND abs(b.p - a.p) < 50
    JOIN rare z ON z.item = x.item AND z.r = 3 JOIN spots c ON c.t = z.t AND c.rid = a.rid
      AND greatest(a.p, b.p, c.p) - least(a.p, b.p, c.p) < 50
    WHERE x.k = 3),
n_near AS (SELECT rid, count(*) AS n_near FROM near GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0) AS n_near
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid) LEFT JOIN n_near USING (rid)
"""


def op5_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat files that are written first."""
    docs, folder = _table(spark, sf_dir, "documents"), scratch_path(spark, "flat-tokens")
    return separator_scan.token_counts(docs, _vocabulary("word_bpe_49k.json"), END_OF_TEXT, folder)


def op6_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    letters = deobfuscation.fit_letters(docs)
    learnt = docs.where(~bayes_language.held_out(F.col("doc_id")))
    model = deobfuscation.fit_toxicity(learnt, labels.where(~bayes_language.held_out(F.col("doc_id"))), letters)
    found = deobfuscation.toxicity(docs, model)
    return found.select("doc_id", bayes_language.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_restored")


def op7_crf_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    return crf_extract.extract(pages, crf_extract.fit(pages))


def op8_bayes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = bayes_language.fit(docs.where(~bayes_language.held_out(F.col("doc_id"))))
    found = bayes_language.predict(docs, model)
    return found.select("doc_id", bayes_language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of the ids of every document, read back from Huffman files."""
    docs, folder = _table(spark, sf_dir, "documents"), scratch_path(spark, "huffman")
    written = huffman_tokens.write_tokens(docs, _vocabulary("word_bpe_49k.json"), DOCUMENT_END, folder)
    return huffman_tokens.read_tokens(spark, written)


def op10_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    found = tensored_minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and each of its positives."""
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op12_longest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; equal texts stay together, sizes are near equal."""
    return shard_schedule.shard_documents(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order, per source."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Builder] = {
    "op1_compression_bands": op1_compression_bands,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_positional_index": op3_positional_index,
    "op4_column_bwt": op4_column_bwt,
    "op5_separator_scan": op5_separator_scan,
    "op6_deobfuscation": op6_deobfuscation,
    "op7_crf_extract": op7_crf_extract,
    "op8_bayes_language": op8_bayes_language,
    "op9_huffman_tokens": op9_huffman_tokens,
    "op10_tensored_minhash": op10_tensored_minhash,
    "op11_bond_negatives": op11_bond_negatives,
    "op12_longest_first": op12_longest_first,
    "op13_filter_audit": op13_filter_audit,
}
#: DuckDB SQL, where SQL can say what the query returns.
ORACLES: dict[str, str] = {
    "op3_positional_index": OP3_SQL,
    "op11_bond_negatives": OP11_SQL,
    "op12_longest_first": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
