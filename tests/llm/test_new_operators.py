"""Hard negatives, sharding and the filter audit against plain versions."""

import heapq
import math
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from stratawell.llm import filter_audit, hard_negatives, queries, shard_schedule
from tools.check_oracles import compare, connect

# ---- sharding -----------------------------------------------------------------------------------------------


def plain_schedule(sizes, n_shards):
    heap, moves = [(0, k) for k in range(n_shards)], []
    for size, count in sizes:
        given = [0] * n_shards
        for _ in range(count):
            load, shard = heapq.heappop(heap)
            heapq.heappush(heap, (load + size, shard))
            given[shard] += 1
        moves.append([(k, n) for k, n in enumerate(given) if n])
    return moves, [load for load, _ in sorted(heap, key=lambda x: x[1])]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 400), st.integers(1, 300), min_size=1, max_size=8), st.integers(1, 9))
def test_schedule_is_the_plain_heap(sizes, n_shards):
    runs = sorted(sizes.items(), reverse=True)
    assert shard_schedule.schedule(runs, n_shards) == plain_schedule(runs, n_shards)


def test_a_run_of_a_billion_groups_is_one_step():
    plan, loads = shard_schedule.schedule([(10**12, 1), (7, 10**9)], 16)
    assert sum(n for _, n in plan[1]) == 10**9 and loads[0] == 10**12 and max(loads[1:]) - min(loads[1:]) <= 7


def check_shards(rows, texts, n_shards=16):
    assert len(rows) == len(texts)
    shard_of, slots, loads = {}, {}, [0] * n_shards
    by_id = {}
    for d, t in texts:
        by_id.setdefault(d, []).append(t or "")
    for r in rows:
        sizes = [len(t.encode()) + 1 for t in by_id[r.doc_id]]
        assert r.size in sizes and r.law == "bytes" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
        loads[r.shard] += r.size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    for r in rows:
        if len(by_id[r.doc_id]) == 1:
            (text,) = by_id[r.doc_id]
            assert r.text_crc32 == zlib.crc32(text.encode())
            assert shard_of.setdefault(text, r.shard) == r.shard
    return loads


def test_shards_of_odd_rows(spark, clashing):
    texts = [(1, "a b"), (2, "a b"), (3, None), (4, ""), (5, "ü" * 900), (6, "x" * 5000), (6, "x" * 5000), (7, "y"), (None, "z"), (8, "a b")]
    rows = shard_schedule.shard_documents(clashing(texts)).collect()
    check_shards(rows, texts)
    assert len({r.shard for r in rows if r.doc_id == 6}) == 1


def test_shards_are_near_equal_beside_a_hot_group(spark, frame):
    draw = random.Random(5)
    texts = [(i, "same text " * 40) for i in range(0, 3000, 3)]
    texts += [(i, f"{i} " * draw.randrange(1, 200)) for i in range(3000) if i % 3]
    loads = check_shards(shard_schedule.shard_documents(frame(texts).repartition(5)).collect(), texts)
    others = sorted(loads)[:-1] if max(loads) > sum(loads) / 8 else loads
    assert max(others) - min(others) < 100


def test_no_rows_no_shards(spark, frame):
    assert shard_schedule.shard_documents(frame([])).count() == 0


def test_written_shards_hold_all_columns(spark, clashing, tmp_path):
    texts = [(i, f"text {i % 7}") for i in range(40)]
    shard_schedule.write_shards(clashing(texts), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(40)) and "spans" in back.columns
    assert back.select("text", "shard").distinct().count() == 7


# ---- filter audit -----------------------------------------------------------------------------------------------


def plain_audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}  # null ids meet nothing
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    fails = []
    for d, t, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = set()
        bad |= {"A"} if len(words) < 50 else set()
        bad |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        bad |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        bad |= {"D"} if re.search("[#$%&*|]", t) else set()
        bad |= {"E"} if d is not None and d > least[t] else set()
        fails.append((s or "", d, bad))
    out = set()
    for part in {s for s, _, _ in fails}:
        mine = [(d, bad) for s, d, bad in fails if s == part]
        rows, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                gone = [d for d, bad in mine if f in bad and not bad & before]
                shapley[f] += len(gone)
                rows.append((
                    "".join(order), k + 1, sum(not bad & (before | {f}) for _, bad in mine), len(gone),
                    sum(f in bad and bool(bad & before) for _, bad in mine), sum(bad == {f} for _, bad in mine),
                    sum(d in good for d in gone), sum(d in toxic for d in gone),
                ))
        out |= {(part, *r, shapley[r[0][r[1] - 1]]) for r in rows}
    return out


COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def test_audit_of_odd_rows(spark):
    prose = " ".join(f"word{i}" for i in range(60))
    docs = [
        (1, prose, "a"), (2, prose, "b"), (3, prose, "a"), (3, prose, "a"), (4, None, None), (5, "", "a"), (6, "SHOUT NOW", None),
        (7, "x " * 200, "b"), (8, prose + " #", "b"), (None, prose, "a"), (None, "", ""), (9, "é\x0b\x0cÀ " * 70, "a"), (10, "w v " * 90, "b"),
    ]
    labels = [(1, 1, 0), (1, 1, 0), (2, 1, 1), (3, None, 1), (7, 0, 1), (99, 1, 1), (None, 1, 1)]
    wide = spark.createDataFrame([(d, t, s, 1, "q") for d, t, s in docs], "doc_id long, text string, source string, mask int, least string").repartition(3)
    found = filter_audit.audit(wide, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {tuple(r[c] for c in COLUMNS) for r in found.collect()} == plain_audit(docs, labels)
    assert found.count() == 600 * 3


def test_audit_of_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.audit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_sketch_clears_only_unique_rows(spark):
    rows = [(i, bytes([i % 256, i // 256 % 256, 1])) for i in range(6000)] + [(i, b"hot") for i in range(3000)] + [(9000 + i, bytes([i, 0, 1])) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, digest binary").repartition(7)
    for bits in (28, 14):  # one round, and several of a sketch that is too small
        kept = [bytes(r.digest) for r in filter_audit.clear_unique(df, max_bits=bits).collect() if r.digest is not None]
        assert kept.count(b"hot") == 3000
        assert all(kept.count(bytes([i, 0, 1])) == 2 for i in range(40))
        assert bits == 14 or len(kept) < 3080 + 60


def test_heavy_texts_are_joined_by_broadcast(spark):
    docs = [(i, "hot text", f"s{i % 3}") for i in range(2000)] + [(5000 + i, f"pair {i // 2}", "s0") for i in range(600)]
    rows = filter_audit.masks(spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4))
    repeats = {r.doc_id for r in rows.collect() if r["mask"] & filter_audit.REPEAT}
    assert repeats == set(range(1, 2000)) | {5001 + i for i in range(0, 600, 2)}


# ---- hard negatives ---------------------------------------------------------------------------------------------


def plain_negatives(rows):
    known = []
    for k, (i, label, v) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        known.append((k, i, label, [math.floor(256 * x) for x in v]))
    out = []
    for k, i, label, v in known:
        if i is None or i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j if j is not None else -math.inf, n, lab, j) for n, j, lab, w in known if n != k and len(w) == len(v)]
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[3] == label][:5]:
            inside = [s for s in scored if s[3] != label and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:5]
            out += [(i, p[4], r, s[4], -p[0], -s[0]) for r, s in enumerate(inside, 1)]
    return sorted(out, key=str)


EMBEDDINGS = "vec_id long, label int, embedding array<float>, score int, anchor string"


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, lab, v, 1, "x") for i, lab, v in rows], EMBEDDINGS).repartition(3)
    return sorted((tuple(r) for r in hard_negatives.hard_negatives(df).collect()), key=str)


def test_negatives_equal_brute_force(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(10, 12))
    rows = []
    for i in range(900):
        v = (centres[i % 10] * 0.2 + draw.normal(size=12) * 0.15).astype(np.float32).tolist()
        rows.append((i, int(i % 10), v))
    rows += [(1000 + i, 3, rows[3][2]) for i in range(300)]  # a common vector
    got = mined(spark, rows)
    assert got == plain_negatives(rows) and len(got) > 100


def test_negatives_of_odd_rows(spark):
    rows = [
        (0, 9, [0.5, 0.5]), (100, 1, [0.5, 0.25]), (100, 1, [0.5, 0.25]), (1, 0, [0.5, 0.5]), (2, 1, [0.4, 0.3]), (3, 2, [0.45, 0.2]),
        (4, None, [9.0, 9.0]), (5, 1, None), (6, 1, [None, 1.0]), (8, 1, [float("nan"), 1.0]), (9, 2, [float("inf"), 1.0]),
        (10, 2, [0.4, 0.4, 0.4]), (200, 2, []), (300, 3, [-1.0, -1.0]), (None, 2, [0.45, 0.2]), (None, 1, [0.45, 0.2]), (11, 2, [0.45, 0.2]),
        (400, 5, [0.0, 0.0]), (401, 5, [0.0, 0.0]), (402, 6, [0.0, 0.1]), (12, 3, [1e30, 1.0]),
    ]
    assert mined(spark, rows) == plain_negatives([r for r in rows if r[0] != 12])
    assert mined(spark, []) == [] and mined(spark, [(5, 1, [0.5])]) == []


def test_batches_of_anchors_change_nothing(spark):
    draw = np.random.default_rng(8)
    rows = [(i, int(draw.integers(3)), (draw.normal(size=6) * 0.3).tolist()) for i in range(700)]
    df = hard_negatives.comparable_rows(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), hard_negatives.F.col("label"))
    whole, split = (sorted(map(tuple, hard_negatives.mine(df, anchor_bytes=b).collect())) for b in (1 << 20, 200))
    assert whole == split and whole


def test_the_scan_leaves_rows_early():
    draw = np.random.default_rng(1)
    columns = (draw.normal(size=(64, 4000)) * 40).astype(np.int64)
    block = hard_negatives.Block(np.arange(4000), np.arange(4000), np.zeros(4000, np.int64), columns, columns.min(axis=1), columns.max(axis=1))
    sizes = []

    def keep(low, high):
        sizes.append(len(low))
        return high >= hard_negatives._fifth(low, 5)

    vector = (draw.normal(size=64) * 60).astype(np.int64)
    at, scores = hard_negatives.narrowed(vector, block, np.ones(4000, bool), keep)
    exact = vector @ columns
    assert sizes[-1] < 2000 and set(np.argsort(-exact)[:5]) <= set(at.tolist()) and (exact[at] == scores).all()


@pytest.mark.parametrize("name", ["op11_bond_negatives", "op12_longest_first", "op13_filter_audit"])
def test_oracles_on_more_rows(spark, name):
    sf = "/root/testdata/sf0.01"
    verdict = compare(queries.QUERIES[name](spark, sf), connect(sf).sql(queries.ORACLES[name]))
    assert verdict.startswith("ok"), verdict
