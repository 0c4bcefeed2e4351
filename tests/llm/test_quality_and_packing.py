"""Compression bands (1) and best-fit packing (2)."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from stratawell.llm import best_fit_packing as packing
from stratawell.llm import compression_bands as bands
from stratawell.llm.words import slices

BLANK = "\x20\x09-\x0D"


def base_counts(text):
    text = text or ""
    words = re.findall(f"[^{BLANK}]+", text)
    lines = [x for x in text.split("\n") if re.search(f"[^{BLANK}]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def test_base_counts_equal_brute_force():
    draw = random.Random(3)
    alphabet = ["a", "b", "é", "\n", " ", " ", "#", "\t", "日", "\x1c"]
    texts = [None, "", " ", "\n\n", "a", "a b", "\n a\n a\na"]
    texts += ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 300))) for _ in range(200)]
    got = bands.word_counts(pa.array(texts))
    assert list(zip(*(v.tolist() for v in got.values()))) == [base_counts(t) for t in texts]


def test_bands_reject_repetition_and_noise(frame, prose):
    draw = random.Random(1)
    noise = " ".join("".join(chr(draw.randrange(0x4E00, 0x9000)) for _ in range(40)) for _ in range(80))
    rows = [(1, prose(1, 400)), (2, "same five words over again " * 200), (3, None), (4, ""), (5, noise)]
    got = {r.doc_id: r for r in bands.compression_bands(frame(rows)).collect()}
    assert got[1].kept and not got[1].base_failed
    assert not got[2].kept and got[2].ratio > 5
    assert got[3].base_failed and not got[3].kept and got[3].n_words == 0 and got[4].n_words == 0
    assert not got[5].base_failed and not got[5].kept and got[5].ratio < 1.5


def test_bands_whole_long_text_repeats_empty_and_clashes(frame, clashing, prose):
    long = prose(2, 60_000, 10**6)
    got = bands.compression_bands(clashing([(1, long), (1, long), (None, "x")])).collect()
    assert [r.n_words for r in got if r.doc_id == 1] == [60_000, 60_000]
    assert len(got) == 3
    assert bands.compression_bands(frame([])).count() == 0


def test_slices_hold_every_row_once():
    batch = pa.record_batch({"text": pa.array(["a" * 10, None, "b" * 50, "", "c"])})
    got = [x for part in slices([batch], budget=12) for x in part.column(0).to_pylist()]
    assert got == batch.column(0).to_pylist()


def plain_best_fit(lengths, sources, clusters, capacity):
    bins, placed = [], []
    for length, s, c in zip(lengths, sources, clusters):
        fits = [
            (capacity - b["used"], i) for i, b in enumerate(bins)
            if capacity - b["used"] >= length and not (s >= 0 and s in b["s"]) and not (c >= 0 and c in b["c"])
        ]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"used": 0, "s": set(), "c": set()})
        placed.append((i, bins[i]["used"]))
        bins[i]["used"] += length
        bins[i]["s"].add(s)
        bins[i]["c"].add(c)
    return placed


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_takes_the_tightest_compatible_bin(seed):
    draw = random.Random(seed)
    items = [(draw.randint(1, 60), draw.choice([-1, 0, 0, 1, 2]), draw.choice([-1, 1, 2, 3, 4, 5])) for _ in range(300)]
    args = list(zip(*items))
    assert packing.best_fit(*args, 60) == plain_best_fit(*args, 60)


def test_packing_keeps_the_rules(spark, prose):
    draw = random.Random(9)
    rows = []
    for i in range(400):
        text = prose(i % 300, draw.randint(1, 300)) if i % 7 else "copied text of some words"
        rows.append((i, text, "hot" if i % 3 == 0 else f"s{i % 11}"))
    rows += [(900, prose(1, 1000), None), (901, None, "hot"), (902, "", None), (5, prose(5, 20), "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = packing.pack(docs, packing.n_words(docs.text), docs.source, packing.copy_cluster(docs.text), 256, 64).collect()
    words = Counter()
    for d, t, _ in rows:
        words[d] += len((t or "").split())
    packed = Counter()
    bins = {}
    for r in got:
        packed[r.doc_id] += r.length
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    assert packed == words
    assert {r.doc_id for r in got if r.bin_id is None} == {901, 902}
    source = {d: s for d, _, s in rows}
    for found in bins.values():
        found.sort(key=lambda r: r.bin_offset)
        end = 0
        for r in found:
            assert r.bin_offset == end
            end += r.length
        assert end == 256 - found[0].bin_free and end <= 256
        named = [source[r.doc_id] for r in found if source[r.doc_id] is not None]
        assert len(named) == len(set(named))


def test_packing_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert packing.pack_documents(docs).count() == 0
