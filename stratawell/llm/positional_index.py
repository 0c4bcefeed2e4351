"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The index is a table of postings: for each word of a document that some benchmark item has, its
position. A phrase is looked up from its rarest word: the postings of that word give candidate
places, and each further list, in order of rarity, is shifted by the word's offset in the phrase
and intersected with them. What is left is compared word by word with the texts of the few
documents concerned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stratawell.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SPAN = 50  # words that the rare words of an item may lie apart to be near
NEAR_TERMS = 3


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null for null."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


@dataclass(frozen=True)
class Index:
    """``terms``: term, tid. ``postings``: doc_id, mark, pos, tid; tid is null in one row per
    document, whose pos is the number of words. (doc_id, mark) names a document."""

    terms: DataFrame
    postings: DataFrame


def build_index(docs: DataFrame, benchmark: DataFrame) -> Index:
    """Index the words of ``docs`` (doc_id, text) that ``benchmark`` (text) has."""
    terms = materialize(
        benchmark.select(F.explode(words(F.col("text"))).alias("term")).distinct()
        .withColumn("tid", F.monotonically_increasing_id())
    )
    end = F.array(F.lit(None).cast("string"))
    spelled = docs.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("mark"),
        F.posexplode(F.concat(F.coalesce(words(F.col("text")), F.array().cast("array<string>")), end)).alias("pos", "term"),
    )
    # The table of terms is as large as the benchmark; Spark broadcasts it only if it is small.
    found = spelled.join(terms, "term", "left").where("tid IS NOT NULL OR term IS NULL")
    return Index(terms, materialize(found.select("doc_id", "mark", "pos", "tid")))


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (wid, terms), and which item (as text) has which: (wid, item).

    An item of fewer words than ``size``, but not none, is one window. A null id counts as the
    item "null".
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words(F.col("text")).alias("w"))
    items = materialize(items.where(F.size("w") > 0))
    last = F.greatest(F.size("w") - size, F.lit(0))
    starts = items.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    cut = materialize(starts.select("item", F.slice("w", F.col("at") + 1, size).alias("terms")).distinct())
    windows = materialize(cut.select("terms").distinct().withColumn("wid", F.monotonically_increasing_id()))
    return windows, cut.join(windows, "terms").select("wid", "item")


def _by_rarity(index: Index, phrases: DataFrame) -> DataFrame:
    """(wid, terms, lists): offsets and ids of the words of each phrase, rarest first.

    Phrases with a word that no document has cannot occur and are left out.
    """
    counts = index.postings.where("tid IS NOT NULL").groupBy("tid").agg(F.count("*").alias("n"))
    spelled = phrases.select("wid", F.posexplode("terms").alias("off", "term")).join(index.terms, "term").join(counts, "tid", "left")
    ordered = spelled.groupBy("wid").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "tid"))).alias("lists")
    )
    return phrases.join(ordered.where("lists[0].n > 0"), "wid")


def phrase_matches(index: Index, docs: DataFrame, phrases: DataFrame, lists: int = 2) -> DataFrame:
    """(id, mark, wid, start, len): every place where a phrase (wid, terms) occurs in a document.

    ``lists`` posting lists are intersected, from the rarest; then the words are compared.
    ``id`` is the doc_id, 0 for null.
    """
    ranked = materialize(_by_rarity(index, phrases))
    placed = index.postings.where("tid IS NOT NULL").select(F.coalesce("doc_id", F.lit(0)).alias("id"), "mark", "pos", "tid")
    anchors = ranked.select("wid", F.size("terms").alias("len"), F.expr("lists[0].tid").alias("tid"), F.expr("lists[0].off").alias("off"))
    places = placed.join(anchors, "tid").select("id", "mark", "wid", "len", (F.col("pos") - F.col("off")).alias("start"))
    places = places.where("start >= 0")
    for k in range(1, lists):
        nth = ranked.where(F.size("lists") > k).select(
            "wid", F.expr(f"lists[{k}].tid").alias("tid"), F.expr(f"lists[{k}].off").alias("off")
        )
        short = ranked.where(F.size("lists") <= k).select("wid")
        wanted = places.join(nth, "wid").select("id", "mark", "wid", "len", "start", (F.col("start") + F.col("off")).alias("pos"), "tid")
        listed = placed.join(nth.select("tid").distinct(), "tid", "left_semi")
        met = wanted.join(listed, ["id", "mark", "pos", "tid"], "left_semi").select("id", "mark", "wid", "len", "start")
        places = met.unionByName(places.join(short, "wid", "left_semi"))
    places = materialize(places.distinct())
    keyed = docs.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("doc_id", "text").alias("mark"), "text")
    # The documents concerned grow with the input, so they are never broadcast, however few.
    concerned = keyed.join(places.select("id", "mark").distinct().hint("merge"), ["id", "mark"], "left_semi")
    texts = materialize(concerned.select("id", "mark", words(F.col("text")).alias("w")).dropDuplicates(["id", "mark"]))
    same = F.slice("w", F.col("start") + 1, F.col("len")) == F.col("terms")
    checked = places.join(texts, ["id", "mark"]).join(ranked.select("wid", "terms"), "wid")
    return checked.where(same).select("id", "mark", "wid", "start", "len")


def near_matches(index: Index, benchmark: DataFrame, span: int = SPAN, n_terms: int = NEAR_TERMS) -> DataFrame:
    """(id, mark, item): documents where the rarest words of an item lie within ``span`` words.

    The ``n_terms`` rarest different words of the item are used, all of them if it has fewer.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.array_distinct(words(F.col("text"))).alias("terms"))
    phrases = materialize(items.where(F.size("terms") > 0).withColumn("wid", F.monotonically_increasing_id()))
    ranked = materialize(_by_rarity(index, phrases).select("wid", "item", F.slice("lists", 1, n_terms).alias("lists")))
    placed = index.postings.where("tid IS NOT NULL").select(F.coalesce("doc_id", F.lit(0)).alias("id"), "mark", "pos", "tid")
    first = ranked.select("wid", F.expr("lists[0].tid").alias("tid"))
    # Every occurrence of the rarest word is a place; a place keeps the stretch it has used so far.
    near = placed.join(first, "tid").select("id", "mark", "wid", F.col("pos").alias("low"), F.col("pos").alias("high"))
    for k in range(1, n_terms):
        nth = ranked.where(F.size("lists") > k).select("wid", F.expr(f"lists[{k}].tid").alias("tid"))
        short = ranked.where(F.size("lists") <= k).select("wid")
        listed = placed.join(nth.select("tid").distinct(), "tid", "left_semi").withColumn("cell", F.floor(F.col("pos") / span))
        cells = F.explode(F.sequence(F.floor((F.col("high") - span) / span), F.floor((F.col("low") + span) / span)))
        wanted = near.join(nth, "wid").select("*", cells.alias("cell"))
        met = (
            wanted.join(listed, ["id", "mark", "tid", "cell"])
            .select("id", "mark", "wid", F.least("low", "pos").alias("low"), F.greatest("high", "pos").alias("high"))
            .where(F.col("high") - F.col("low") < span)
            .distinct()
        )
        near = met.unionByName(near.join(short, "wid", "left_semi"))
    return near.select("id", "mark", "wid").distinct().join(ranked.select("wid", "item"), "wid").select("id", "mark", "item").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near for every row of ``docs``.

    A word is hit if it lies in an occurrence of a window; ``n_near`` counts items whose rarest
    words lie close together. A null or empty text has no words. Rows that repeat (doc_id, text)
    get the same result each; rows that share only the id are documents of their own. With an
    empty benchmark nothing is hit.
    """
    index = build_index(docs, benchmark)
    windows, owners = benchmark_windows(benchmark, size)
    matches = materialize(phrase_matches(index, docs, windows))
    spans = matches.select("id", "mark", "start", (F.col("start") + F.col("len")).alias("stop"))
    spans = spans.groupBy("id", "mark", "start").agg(F.max("stop").alias("stop"))
    before = W.partitionBy("id", "mark").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    new = F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0)))
    hits = spans.select("id", "mark", F.greatest(new, F.lit(0)).alias("new")).groupBy("id", "mark").agg(F.sum("new").alias("n_hit"))
    items = (
        matches.select("id", "mark", "wid").distinct().join(owners, "wid")
        .groupBy("id", "mark").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    near = near_matches(index, benchmark).groupBy("id", "mark").agg(F.count("*").alias("n_near"))
    ends = index.postings.where("tid IS NULL").select(
        "doc_id", F.coalesce("doc_id", F.lit(0)).alias("id"), "mark", F.col("pos").cast("long").alias("n_words")
    )
    joined = ends.join(hits.join(items, ["id", "mark"]), ["id", "mark"], "left").join(near, ["id", "mark"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no window of the benchmark."""
    index = build_index(docs, benchmark)
    windows, _ = benchmark_windows(benchmark, size)
    hit = phrase_matches(index, docs, windows).select("id", "mark").distinct()
    same = (F.coalesce(docs["doc_id"], F.lit(0)) == hit["id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == hit["mark"])
    return docs.join(hit.hint("merge"), same, "left_anti")
