"""Piece tokenizer, Huffman token files (9) and separator scan (5)."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stratawell.llm import huffman_tokens as huffman
from stratawell.llm import separator_scan as scan
from stratawell.llm.tokens import PieceTokenizer, with_end
from stratawell.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = list("abcXYZ019.,'!-_<|># \n\t") + [
    "é", "É", "ß", "×", "÷", "ª", "µ", "İ", "ı", "日", "—", "“", "é", "J̌", "̸", "=", "½", " ", "\x1c",
    "\x85", "\x00", "한", "😀", "Σ", "'s", "'LL", "<|endoftext|>", "<|startoftext|>",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def fuzz(n, seed=5):
    draw = random.Random(seed)
    return [None, ""] + ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 60))) for _ in range(n)]


def test_pieces_give_the_ids_of_whole_texts(library):
    texts = fuzz(1500)
    ids, bounds = PieceTokenizer(VOCABULARY, cache_pieces=500).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_literal_specials_never_give_the_end_id():
    ids, _ = PieceTokenizer(VOCABULARY, literal_specials=True).encode(pa.array(["a <|endoftext|> b"]))
    assert 49407 not in ids.tolist()


def test_end_ids_close_every_text():
    ids, bounds = with_end(np.array([1, 2, 3], np.uint32), np.array([0, 0, 2, 3]), 9)
    assert ids.tolist() == [9, 1, 2, 9, 3, 9] and bounds.tolist() == [0, 1, 4, 6]


def test_code_lengths_are_optimal_and_limited():
    import heapq

    counts = np.random.default_rng(1).zipf(1.5, 300)
    lengths = huffman.code_lengths(counts, 20)
    heap, n, cost = [int(c) for c in counts], len(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    assert int((counts * lengths).sum()) == cost and n == (lengths > 0).sum()
    tight = huffman.code_lengths(counts, 9)
    assert tight.max() <= 9 and np.sum(2.0 ** -tight.astype(float)) <= 1


@pytest.mark.parametrize("n,m", [(0, 5), (1, 5), (511, 50), (512, 50), (513, 50), (9000, 40_000), (3000, 1)])
def test_blocks_round_trip(n, m):
    ids = (np.random.default_rng(n + m).zipf(1.3, n) % m).astype(np.uint32)
    code = huffman.Code.canonical(huffman.code_lengths(np.bincount(ids, minlength=1)))
    _, marks, words = huffman.encode_block(ids, code)
    assert (huffman.decode_block(words, marks, n, code) == ids).all()


def test_files_return_the_documents_in_order(spark, frame, library):
    texts = fuzz(150, 8)
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, "again three"), (3, "again three")]
    docs = frame(rows).repartition(3)
    written = huffman.write_tokens(docs, VOCABULARY, 2, scratch_path(spark, "t-huffman"), 4)
    got = sorted(huffman.read_tokens(spark, written).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: -1 if d is None else d)
    start = 0
    left = {}
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        left.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == start
        left[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens


def test_no_documents_no_files(spark, frame):
    written = huffman.write_tokens(frame([]), VOCABULARY, 2, scratch_path(spark, "t-huffman"), 2)
    assert written.tokens == () and huffman.read_tokens(spark, written).count() == 0
    assert scan.token_counts(frame([]), VOCABULARY, 49407, scratch_path(spark, "t-flat")).count() == 0


@pytest.mark.parametrize("block", [7, 100, scan.BLOCK_IDS])
def test_scan_counts_across_blocks(spark, clashing, library, block):
    library.encode_special_tokens = True
    rows = list(enumerate(fuzz(120, 4))) + [(3, "twice"), (3, "twice"), (None, "none")]
    want = sorted(((-1 if d is None else d), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    library.encode_special_tokens = False
    got = scan.token_counts(clashing(rows), VOCABULARY, 49407, scratch_path(spark, "t-flat"), block).collect()
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.n_tokens) for r in got) == want


def test_scan_returns_a_document_that_is_cut_off(spark):
    folder = scratch_path(spark, "t-cut")
    from stratawell.llm.files import TaskFile

    file = TaskFile(f"{folder}/part-0000000.ids")
    file.write(np.array([5, 6, 49407, 49407, 8, 9, 10], "<u2").tobytes())
    file.commit()
    got = {r.ordinal: r.n_tokens for r in scan.scan(spark, folder, 49407, 3).collect()}
    assert got == {0: 2, 1: 0, 2: 3}
