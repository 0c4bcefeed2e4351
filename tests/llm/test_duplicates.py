"""Tensored MinHash (10), repeated strings (4) and the positional index (3) against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stratawell.llm import column_bwt, links, positional_index, repeated_substrings, tensored_minhash as minhash

BLANK = "\x20\x09-\x0D"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words = re.findall(f"[^{BLANK}]+", lower(text))
    return {tuple(words)} if len(words) == 1 else set(zip(words, words[1:]))


def union_find(n, pairs):
    top = list(range(n))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in pairs:
        top[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


def edited(draw, text, share):
    words = text.split()
    for i in range(len(words)):
        if draw.random() < share:
            words[i] = f"e{draw.randrange(10**6)}"
    return " ".join(words)


def near_rows(prose):
    draw, rows = random.Random(4), []
    for k in range(25):
        base = prose(k, draw.randint(30, 200))
        rows += [base, base.upper()] + [edited(draw, base, draw.choice([0.01, 0.03, 0.05, 0.1])) for _ in range(6)]
    rows += [None, "", "   ", "one", "ONE", "two words", "two  words", "\x1c", None, ""]
    return list(enumerate(rows))


def test_components_of_long_chains_and_stars(frame):
    draw = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    pairs += [(draw.randrange(200, 260), draw.randrange(200, 260)) for _ in range(30)]
    got = {r.node: r.root for r in links.components(frame(pairs, "a long, b long")).collect()}
    want = union_find(300, pairs)
    assert got == {x: want[x] for p in pairs for x in p if want[x] != x}


def test_components_stop_at_stars(frame, monkeypatch):
    """Links of a star are written once; so are links between the roots of stars that were found before."""
    made, written = links.materialize, []

    def watched(df):
        written.append(made(df))
        return written[-1]

    monkeypatch.setattr(links, "materialize", watched)
    star = [(5, x) for x in range(100, 160)] + [(x, 9) for x in range(200, 260)]
    for pairs in (star, [(b, a) for a, b in star] + [(5, 9)]):
        written.clear()
        got = {r.node: r.root for r in links.components(frame(pairs, "a long, b long")).collect()}
        want = union_find(300, pairs)
        assert got == {x: want[x] for p in pairs for x in p if want[x] != x}
        assert len(written) == 1


def test_shingle_sets_are_exact(prose):
    texts = [t for _, t in near_rows(prose)]
    sets, bounds = minhash.shingle_sets(pa.array(texts), 2)
    assert np.diff(bounds).tolist() == [len(shingles(t)) for t in texts]
    a, b = sets[bounds[0] : bounds[1]], sets[bounds[1] : bounds[2]]
    assert sorted(a.tolist()) == sorted(b.tolist())


def test_near_duplicates_equal_brute_force(clashing, prose):
    rows = near_rows(prose)
    sets = [shingles(t) for _, t in rows]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    want = union_find(len(rows), pairs)
    got = {r.doc_id: r for r in minhash.near_duplicates(clashing(rows)).collect()}
    assert {d: r.component_id for d, r in got.items()} == dict(enumerate(want))
    assert all(r.n_shingles == len(sets[d]) and r.kept == (want[d] == d) for d, r in got.items())
    kept = minhash.keep_one(clashing(rows))
    assert kept.columns == clashing(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, _ in rows if want[d] == d]


def test_one_of_repeated_rows_stays(frame, prose):
    text, other = prose(1, 80), prose(2, 80)
    rows = [(5, text), (5, text), (5, other), (9, text), (None, other)]
    found = minhash.keep_one(frame(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in found) == sorted([(5, text), (5, other)])


def test_no_rows(frame):
    empty = frame([])
    assert minhash.near_duplicates(empty).count() == 0 and minhash.keep_one(empty).count() == 0
    assert repeated_substrings.removal_report(empty).count() == 0
    assert repeated_substrings.remove_repeats(empty).count() == 0
    items = frame([], "item_id long, text string")
    assert positional_index.contamination(empty, items).count() == 0
    got = positional_index.contamination(frame([(1, "some words")]), items).collect()
    assert [(r.n_words, r.contaminated) for r in got] == [(2, False)]


@pytest.mark.parametrize("seed", range(8))
def test_transform_equals_sorting_the_suffixes(seed):
    draw = random.Random(seed)
    for _ in range(15):
        strings = [bytes(draw.choice(b"abc"[: 2 + seed % 2]) for _ in range(draw.randint(0, 30))) for _ in range(draw.randint(1, 8))]
        cap = draw.choice([3, 5, 200])
        symbols, prefixes, alphabet = column_bwt.transform(strings, cap)
        suffixes = sorted(
            ((s[t:], j, t) for j, s in enumerate(strings) for t in range(len(s) + 1)),
            key=lambda x: ([c + len(strings) for c in x[0]] + [x[1]]),
        )
        assert [None if x == 0 else alphabet[x - 1] for x in symbols] == [strings[j][t - 1] if t else None for _, j, t in suffixes]
        common = [0] + [
            min(cap, next((k for k, (x, y) in enumerate(zip(a[0], b[0])) if x != y), min(len(a[0]), len(b[0]))))
            for a, b in zip(suffixes, suffixes[1:])
        ]
        assert prefixes.tolist() == common
        size = draw.choice([2, 4, 6])
        often = Counter(s[i : i + size] for s in strings for i in range(len(s) - size + 1))
        want = [[i for i in range(len(s) - size + 1) if often[s[i : i + size]] > 1] for s in strings]
        assert [x.tolist() for x in column_bwt.repeated_starts(strings, size)] == want


def removed_by_brute_force(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    often = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if often[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((-1 if d is None else d, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeat_rows(prose):
    draw = random.Random(7)
    shared = [prose(100 + k, 60) for k in range(4)]
    rows = []
    for k in range(60):
        parts = [prose(k, draw.randint(5, 60)), draw.choice(shared), prose(k + 500, draw.randint(5, 60))]
        rows.append(" ".join(parts[: draw.randint(1, 3)]))
    rows += ["a" * 1000, None, "", "ab" * 130, "x" * 200, "é" * 300, "q" * 199, "lorem ipsum " * 40, shared[0], shared[0]]
    return [*enumerate(rows), (3, rows[3]), (None, "null id " * 60), (0, "other text of the same id")]


@pytest.mark.parametrize("limit", [repeated_substrings.GROUP_LIMIT, 1])
def test_removal_equals_brute_force(clashing, prose, monkeypatch, limit):
    monkeypatch.setattr(repeated_substrings, "GROUP_LIMIT", limit)
    rows = repeat_rows(prose)
    got = repeated_substrings.removal_report(clashing(rows)).collect()
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)
    assert found == removed_by_brute_force(rows, 200)


def test_fragments_hold_every_start_once(prose):
    text = (prose(1, 300) + "z" * 900 + prose(2, 3)).encode()
    data = np.frombuffer(text, np.uint8)
    found = repeated_substrings.fragments(data, np.array([0, 700, 700, len(data)]))
    seen = [(r, f + i) for r, f, n in zip(found["row"], found["first"], found["starts"]) for i in range(n)]
    assert sorted(seen) == [(0, i) for i in range(501)] + [(2, i) for i in range(len(data) - 700 - 199)]


def test_texts_are_cut_and_rows_stay(clashing, prose):
    passage = prose(50, 60)
    rows = [(1, f"start {passage} end"), (2, f"{passage} tail"), (3, passage), (4, None), (5, ""), (6, prose(60, 40))]
    docs = clashing(rows)
    got = repeated_substrings.remove_repeats(docs)
    assert got.columns == docs.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[1] == "start end" and texts[2] == "tail" and texts[4] is None and texts[5] == "" and texts[6] == rows[5][1]
    assert 3 not in texts


ASCII_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return ASCII_WORD.findall(lower(text))


def hits_by_brute_force(rows, items):
    places = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if w else 0):
            places[tuple(w[i : i + n])].add("null" if item is None else str(item))
    sizes = {len(p) for p in places}
    out = []
    for d, text in rows:
        w, hit, found = words_of(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in places:
                    hit |= set(range(i, i + n))
                    found |= places[tuple(w[i : i + n])]
        mark = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((-1 if d is None else d, len(w), len(hit), len(found), mark, bool(hit)))
    return sorted(out)


def index_rows(prose):
    items = [(k, prose(1000 + k, 30, 300)) for k in range(8)]
    items += [(20, "the the the the the the the the the the the the"), (21, "rare pair"), (22, "lone"), (23, None), (24, "!!"), (None, prose(9, 12)), (3, prose(77, 15))]
    rows = [(k, prose(k, 80, 300)) for k in range(30)]
    rows += [
        (40, f"x {items[0][1].upper()} y"), (41, " ".join(items[1][1].split()[5:20])), (42, " ".join(items[2][1].split()[:9])),
        (43, "the " * 50), (44, "a rare,PAIR here"), (45, "LONE"), (46, None), (47, ""), (48, prose(9, 12)), (None, items[3][1]),
        (40, "same id, other text"), (40, "same id, other text"), (49, "Ünï " + prose(77, 15)),
    ]
    return rows, items


def test_contamination_equals_brute_force(clashing, frame, prose):
    rows, items = index_rows(prose)
    got = positional_index.contamination(clashing(rows), frame(items, "item_id long, text string")).collect()
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)
    assert found == hits_by_brute_force(rows, items)
    kept = positional_index.clean(clashing(rows), frame(items, "item_id long, text string"))
    assert kept.columns == clashing(rows).columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(
        f[0] for f in hits_by_brute_force(rows, items) if not f[5]
    )


@pytest.mark.parametrize("lists", [1, 3])
def test_phrases_do_not_depend_on_the_number_of_lists(frame, prose, lists):
    rows, items = index_rows(prose)
    docs, benchmark = frame(rows), frame(items, "item_id long, text string")
    index = positional_index.build_index(docs, benchmark)
    windows, _ = positional_index.benchmark_windows(benchmark)
    key = ["id", "mark", "start", "wid"]
    two = {tuple(r) for r in positional_index.phrase_matches(index, docs, windows).select(*key).collect()}
    assert {tuple(r) for r in positional_index.phrase_matches(index, docs, windows, lists).select(*key).collect()} == two


def test_near_matches_need_all_rare_words_close_by(frame):
    items = frame([(1, "zebra apple quince is is is")], "item_id long, text string")
    docs = frame([(1, "quince of zebra and apple"), (2, "zebra apple" + " pad" * 60 + " quince"), (3, "zebra is apple"), (4, "is " * 9)])
    index = positional_index.build_index(docs, items)
    assert {r.id for r in positional_index.near_matches(index, items).collect()} == {1}
