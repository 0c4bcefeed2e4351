"""The registered queries and the pipeline on the smallest tables."""

import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from stratawell.llm import queries
from tools.check_oracles import compare, connect

COLUMNS = {
    "op1": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op2": {"doc_id", "bin_id", "bin_offset"},
    "op3": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op4": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op5": {"doc_id", "n_tokens"},
    "op6": {"doc_id", "held_out", "score", "predicted"},
    "op7": {"page_id", "url", "text", "n_chars"},
    "op8": {"doc_id", "held_out", "lang_pred", "score"},
    "op9": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op10": {"doc_id", "n_shingles", "component_id", "kept"},
    "op12": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
}


def test_all_are_registered():
    assert {q.split("_")[0] for q in queries.QUERIES} == set(COLUMNS) | {"op11", "op13"}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(q for q in queries.QUERIES if q.split("_")[0] in COLUMNS))
def test_one_row_per_input_row(spark, tiny, name):
    found = queries.QUERIES[name](spark, tiny)
    assert COLUMNS[name.split("_")[0]] <= set(found.columns)
    table = "pages" if name.startswith("op7") else "documents"
    rows = spark.read.parquet(f"{tiny}/{table}.parquet")
    key = rows.columns[0]
    got = found.groupBy(key).agg(F.count("*").alias("n")).collect()
    assert len(got) == rows.count()
    assert all(r.n == 1 for r in got) or name.startswith("op2")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, tiny, name):
    verdict = compare(queries.QUERIES[name](spark, tiny), connect(tiny).sql(queries.ORACLES[name]))
    assert verdict.startswith("ok"), verdict


def test_held_out_languages_are_right(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "lang")
    rows = queries.QUERIES["op8_bayes_language"](spark, tiny).join(docs, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95


def test_stages_keep_the_columns_and_only_lose_rows(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, tiny))
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and after <= before
        before = after
    assert after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tiny)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == after


def test_pipeline_equals_its_parts(spark, tiny):
    """The rows that stay, by brute force over the given tables."""
    import re

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    docs = [(d, t) for d, t in docs if t and any(c.isalpha() for c in t)]

    def shingles(text):
        words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
        n = min(len(words), 5)
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()

    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    kept = [(d, t.encode()) for d, t in docs if find(d) == d]
    from collections import Counter

    often = Counter(b[i : i + 200] for _, b in kept for i in range(len(b) - 199))
    cut = {}
    for d, b in kept:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if often[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\x01" * 200
        text = bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        if text:
            cut[d] = text
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def words(text):
        return word.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))

    windows = set()
    for (text,) in spark.read.parquet(f"{tiny}/benchmark.parquet").select("text").collect():
        w = words(text)
        n = min(len(w), 10)
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    sizes = {len(x) for x in windows}
    clean = {
        d for d, t in cut.items()
        if not any(tuple(w[i : i + n]) in windows for w in [words(t)] for n in sizes for i in range(len(w) - n + 1))
    }
    assert {r.doc_id for r in corpus_pipeline.run(spark, tiny).select("doc_id").collect()} == clean
