"""Token ids as canonical length-limited Huffman codes in files of independent blocks.

Code lengths come from the counts of all ids of the corpus. Documents are written in ascending id
order, one file per range of ids:

    file    magic, u32 number of code lengths, the lengths (u8 each), blocks, footer
    block   u64 x 4: documents, tokens, bits, checkpoint interval
            document ids (i64), null marks (u8), tokens per document (u64),
            checkpoints (u64: bit offset of every n-th token), code words (big-endian u32)
    footer  offset of each block (u64), number of blocks (u64), magic

A block holds whole documents. Its checkpoints let all stretches between them be decoded side by
side, one table lookup per token.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratawell.llm.files import TaskFile, opened
from stratawell.llm.tokens import PieceTokenizer, with_end
from stratawell.llm.words import slices
from stratawell.session import estimated_bytes, scratch_path
from stratawell.storage import delete

MAGIC = b"HUFTOK01"
MAX_BITS = 20
INTERVAL = 512
PART_BYTES = 64 << 20


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code length of each symbol under a limit (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols do not fit codes of {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    packages, is_item = np.zeros(0), []
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        merged = merged[rank]
        is_item.append(rank < len(weights))
        packages = merged[0 : len(merged) // 2 * 2 : 2] + merged[1 : len(merged) // 2 * 2 : 2]
    taken = 2 * len(weights) - 2
    for items in reversed(is_item):
        n = int(items[:taken].sum())
        lengths[order[:n]] += 1
        taken = 2 * (taken - n)
    return lengths


@dataclass(frozen=True)
class Code:
    """Canonical codes: shorter first, then by id."""

    lengths: np.ndarray
    words: np.ndarray
    table_id: np.ndarray
    table_bits: np.ndarray
    bits: int

    @classmethod
    def canonical(cls, lengths: np.ndarray) -> Code:
        used = np.flatnonzero(lengths)
        order = used[np.argsort(lengths[used], kind="stable")]
        bits = int(lengths.max(initial=1))
        words = np.zeros(len(lengths), np.uint64)
        span = np.left_shift(np.uint64(1), (bits - lengths[order].astype(np.int64)).astype(np.uint64))
        first = np.concatenate([[0], np.cumsum(span)[:-1]]).astype(np.uint64) if len(order) else span
        words[order] = first >> (bits - lengths[order].astype(np.int64)).astype(np.uint64)
        table_id, table_bits = np.zeros(1 << bits, np.uint32), np.ones(1 << bits, np.uint8)
        covered = int(span.sum())
        table_id[:covered] = np.repeat(order, span.astype(np.int64))
        table_bits[:covered] = np.repeat(lengths[order], span.astype(np.int64))
        return cls(lengths, words, table_id, table_bits, bits)


def encode_block(ids: np.ndarray, code: Code, interval: int = INTERVAL) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of bits, checkpoints and code words (32 bits each) of a sequence of ids."""
    bits = code.lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    total = int(ends[-1]) if len(ids) else 0
    begins = ends - bits
    out = np.zeros(total // 32 + 2, np.uint64)
    if len(ids):
        word, shift = begins >> 5, (64 - (begins & 31) - bits).astype(np.uint64)
        placed = code.words[ids] << shift
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        # Codes never overlap, so sums of the codes that begin in a word are their union.
        both = np.add.reduceat(placed, first)
        out[word[first]] += both >> np.uint64(32)
        out[word[first] + 1] += both & np.uint64(0xFFFFFFFF)
    return total, begins[::interval].astype(np.uint64), out.astype(">u4")


def decode_block(words: np.ndarray, checkpoints: np.ndarray, n_tokens: int, code: Code, interval: int = INTERVAL) -> np.ndarray:
    """The ids of a block: all stretches between checkpoints advance one token per step."""
    lanes = len(checkpoints)
    if not lanes:
        return np.zeros(0, np.uint32)
    words = np.concatenate([words.astype(np.uint64), np.zeros(2, np.uint64)])
    pairs = (words[:-1] << np.uint64(32)) | words[1:]
    last = len(pairs) - 1
    at = checkpoints.astype(np.int64)
    out = np.empty((min(interval, n_tokens), lanes), np.uint32)
    for step in range(len(out)):
        # Only the last lane can run past the end; what it reads there is cut off below.
        seen = pairs[np.minimum(at >> 5, last)] >> (64 - code.bits - (at & 31)).astype(np.uint64)
        seen = seen.astype(np.int64) & ((1 << code.bits) - 1)
        out[step] = code.table_id[seen]
        at += code.table_bits[seen]
    return out.T.reshape(-1)[:n_tokens] if n_tokens > interval else out[:n_tokens, 0]


def pack_block(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, code: Code) -> bytes:
    n_bits, marks, words = encode_block(ids, code)
    out = io.BytesIO()
    out.write(np.array([len(doc_ids), len(ids), n_bits, INTERVAL], "<u8").tobytes())
    out.write(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    out.write(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    out.write(counts.astype("<u8").tobytes())
    out.write(marks.astype("<u8").tobytes())
    out.write(words.tobytes())
    return out.getvalue()


def unpack_block(raw: bytes, code: Code) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    n_docs, n_tokens, n_bits, interval = (int(x) for x in np.frombuffer(raw, "<u8", 4))
    at = 32
    doc_ids = np.frombuffer(raw, "<i8", n_docs, at).tolist()
    at += 8 * n_docs
    nulls = np.frombuffer(raw, np.uint8, n_docs, at)
    at += n_docs
    counts = np.frombuffer(raw, "<u8", n_docs, at).astype(np.int64)
    at += 8 * n_docs
    n_marks = -(-n_tokens // interval)
    marks = np.frombuffer(raw, "<u8", n_marks, at)
    at += 8 * n_marks
    words = np.frombuffer(raw, ">u4", n_bits // 32 + 2, at)
    ids = decode_block(words, marks, n_tokens, code, interval)
    return [None if gone else d for d, gone in zip(doc_ids, nulls)], counts, ids


def read_file(uri: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, tokens per document, ids) of each block; any block can be read by itself."""
    system, path = opened(uri)
    with system.open_input_file(path) as f:
        size = f.size()
        if f.read_at(8, size - 8) != MAGIC or f.read_at(8, 0) != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        n_blocks = int(np.frombuffer(f.read_at(8, size - 16), "<u8")[0])
        offsets = np.frombuffer(f.read_at(8 * n_blocks, size - 16 - 8 * n_blocks), "<u8").astype(np.int64)
        n_lengths = int(np.frombuffer(f.read_at(4, 8), "<u4")[0])
        code = Code.canonical(np.frombuffer(f.read_at(n_lengths, 12), np.uint8))
        ends = [*offsets[1:].tolist(), size - 16 - 8 * n_blocks]
        for begin, end in zip(offsets.tolist(), ends):
            yield unpack_block(f.read_at(end - begin, begin), code)


def _raw_records(uri: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    system, path = opened(uri)
    with system.open_input_file(path) as f, pa.ipc.open_stream(f) as reader:
        for batch in reader:
            row = batch.column(0)
            yield row[0].as_py(), np.array(batch.column(1)[0].as_py(), np.int64), np.frombuffer(batch.column(2)[0].as_buffer(), np.uint32)


@dataclass(frozen=True)
class Written:
    """Token files of a corpus, in id order, and the number of tokens in each."""

    folder: str
    tokens: tuple[int, ...]

    def file(self, part: int) -> str:
        return f"{self.folder}/part-{part:07d}.huf"


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int, folder: str, n_parts: int | None = None) -> Written:
    """Encode (doc_id, text) and write the files of the format above to ``folder``.

    Documents go in ascending doc_id order, nulls first; rows that share an id are ordered by a
    hash of their text. A null text has the end id only. Files hold about 64 MB of input each.
    Ids are kept once between the two passes (counts, then codes) and deleted afterwards.
    """
    spark = docs.sparkSession
    if n_parts is None:
        n_parts = max(spark.sparkContext.defaultParallelism, (estimated_bytes(docs) or 0) // PART_BYTES + 1)
    raw = scratch_path(spark, "raw-ids")
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(int(n_parts), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    schema = pa.schema([("docs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("ids", pa.large_binary())])

    def to_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tokenizer, file, totals = None, None, np.zeros(0, np.int64)
        for piece in slices(batches):
            if file is None:
                tokenizer = PieceTokenizer(vocabulary)
                file = TaskFile(f"{raw}/{part:07d}")
                writer = pa.ipc.new_stream(file.stream, schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            ids, bounds = with_end(*tokenizer.encode(piece.column(1)), end_id)
            seen = np.bincount(ids)
            if len(seen) > len(totals):
                totals = np.concatenate([totals, np.zeros(len(seen) - len(totals), np.int64)])
            totals[: len(seen)] += seen
            record = [[piece.column(0).to_pylist()], [np.diff(bounds)], [ids.astype("<u4").tobytes()]]
            writer.write_batch(pa.record_batch([pa.array(c, t) for c, t in zip(record, schema.types)], schema=schema))
        if file is None:
            return
        writer.close()
        file.commit()
        at = np.flatnonzero(totals)
        # One more row says that this part has a file: -1 - part.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1 - part)), pa.array(np.append(totals[at], 1))], names=["id", "n"]
        )

    # Bounded by the vocabulary and by the input over 64 MB, not by the number of documents.
    rows = ordered.mapInArrow(to_ids, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    parts = sorted(-1 - r["id"] for r in rows if r["id"] < 0)
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        if r["id"] >= 0:
            counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    shared = spark.sparkContext.broadcast(lengths)

    def to_codes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code.canonical(shared.value)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                file = TaskFile(f"{folder}/part-{number:07d}.huf")
                at = file.write(MAGIC + np.array([len(code.lengths)], "<u4").tobytes() + code.lengths.tobytes())
                offsets, total = [], 0
                for doc_ids, n, ids in _raw_records(f"{raw}/{parts[number]:07d}"):
                    offsets.append(at)
                    at += file.write(pack_block(doc_ids, n, ids, code))
                    total += len(ids)
                file.write(np.array([*offsets, len(offsets)], "<u8").tobytes() + MAGIC)
                file.commit()
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([total])], names=["part", "n"])

    n = len(parts)
    files = spark.range(0, n, 1, max(n, 1))
    done = files.mapInArrow(to_codes, "part long, n long").collect()
    totals = [r["n"] for r in sorted(done, key=lambda r: r["part"])]
    delete(spark, raw)
    return Written(folder, tuple(totals))


def read_tokens(spark: SparkSession, written: Written) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    ``start`` counts the ids of all documents before; the checksum is over the document's ids as
    little-endian u32.
    """
    before = np.concatenate([[0], np.cumsum(written.tokens)]).astype(np.int64)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                start = int(before[part])
                for doc_ids, counts, ids in read_file(written.file(part)):
                    raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(counts)
                    begins = ends - counts
                    sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids, pa.int64()), pa.array(begins + start), pa.array(counts), pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    start += len(ids)

    n = len(written.tokens)
    parts = spark.range(0, n, 1, max(n, 1)).select(F.col("id").alias("part"))
    return parts.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
