"""Operator 1: token ids in binary segments whose document boundaries are Elias-Fano encoded.

File format, one segment (little-endian): b"CRLWEF01" | u64 documents n | u64 ids m | u8 bytes an id |
u8 low bits l | 6 bytes 0 | crc32 of all that follows as u32 | 4 bytes 0 | lower bits: ceil(n*l/8) bytes |
upper bits: ceil((n + (m >> l) + 1)/8) bytes | select samples: u32 bit positions of every 256th upper one |
ids. Boundary i (the end of document i) is select1(i) - i shifted by l, or'ed with its lower bits: about
2 + log2(m/n) bits a document instead of 64. Segments are rows of a table that Spark writes, so a lost
executor's segment is written anew by whichever attempt commits.

Nulls: a null text counts as empty and still gets its end id; a null doc_id sorts first. Rows that repeat a
doc_id are kept, in order of their texts' hashes. An empty table gives an empty result. Columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curlew.llm._common import Stored, shuffle_partitions, store, table, text_key
from curlew.llm.tokens import encoder, vocabulary

MAGIC = b"CRLWEF01"
HEAD = struct.Struct("<8sQQBB6xI4x")
STEP = 256
#: Ids after which a segment is closed; a longer document still stays in one segment.
SEGMENT_IDS = 1 << 20


class EliasFano:
    """A non-decreasing sequence of n values up to u, in n*l lower and about 2n upper bits, with select."""

    def __init__(self, n: int, u: int, low: int, lower: np.ndarray, upper: np.ndarray, samples: np.ndarray):
        self.n, self.u, self.low, self.lower, self.upper, self.samples = n, u, low, lower, upper, samples

    @staticmethod
    def low_bits(n: int, u: int) -> int:
        return max(0, (u // n).bit_length() - 1) if n else 0

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, u = len(values), int(values[-1]) if len(values) else 0
        low = cls.low_bits(n, u)
        bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
        lower = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        marks = np.zeros(n + (u >> low) + 1, np.uint8)
        marks[ones] = 1
        return cls(n, u, low, lower, np.packbits(marks, bitorder="little"), ones[::STEP].astype("<u4"))

    def _lower(self, i: int) -> int:
        bit = i * self.low
        return int.from_bytes(self.lower[bit >> 3 : (bit + self.low + 7) >> 3].tobytes(), "little") >> (bit & 7) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """Value i in O(STEP) steps from the nearest sample."""
        at = int(self.samples[i // STEP])
        left = i % STEP
        byte = at >> 3
        word = int(self.upper[byte]) >> (at & 7) << (at & 7)
        while (have := word.bit_count()) <= left:
            left -= have
            byte += 1
            word = int(self.upper[byte])
        for _ in range(left):
            word &= word - 1
        one = (byte << 3) + (word & -word).bit_length() - 1
        return (one - i) << self.low | self._lower(i)


def id_width(ids: int) -> int:
    """Bytes for one of so many ids."""
    return 2 if ids <= 1 << 16 else 4


def pack(ids: list[np.ndarray], id_bytes: int = 2) -> bytes:
    """One segment from its documents' ids; an id that doesn't fit stops it."""
    if max((int(x.max()) for x in ids if len(x)), default=0) >> 8 * id_bytes:
        raise ValueError(f"an id needs more than {id_bytes} bytes")
    ends = np.cumsum([len(x) for x in ids], dtype=np.uint64)
    ef = EliasFano.encode(ends)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    body = b"".join((ef.lower.tobytes(), ef.upper.tobytes(), ef.samples.tobytes(), flat.astype(f"<u{id_bytes}").tobytes()))
    return HEAD.pack(MAGIC, ef.n, ef.u, id_bytes, ef.low, zlib.crc32(body)) + body


class Segment:
    """Reads a segment: boundaries by select, ids by offset."""

    def __init__(self, data: bytes):
        magic, n, m, width, low, crc = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a segment")
        body = memoryview(data)[HEAD.size :]
        if zlib.crc32(body) != crc:
            raise ValueError("the segment is damaged")
        a = (n * low + 7) // 8
        b = a + (n + (m >> low) + 1 + 7) // 8
        c = b + 4 * ((n + STEP - 1) // STEP)
        self.ids = np.frombuffer(body[c:], f"<u{width}")
        self.ends = EliasFano(n, m, low, np.frombuffer(body[:a], np.uint8), np.frombuffer(body[a:b], np.uint8), np.frombuffer(body[b:c], "<u4"))

    def __len__(self) -> int:
        return self.ends.n

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        a, b = self.bounds(i)
        return self.ids[a:b]


def write_segments(docs: DataFrame, tokenizer: str, end_id: int, segment_ids: int = SEGMENT_IDS, partitions: int | None = None) -> Stored:
    """Rows (part, seq, part_start, n_ids, nulls, doc_ids, segment), in ascending doc_id order by (part, seq).

    Documents are dealt by range of (doc_id, text's hash), so no range has to fit one key. Memory of a task: one
    segment and one Arrow batch. Ids take as many bytes as the vocabulary needs.
    """
    spark = docs.sparkSession
    n = partitions or shuffle_partitions(spark)
    body = F.coalesce("text", F.lit(""))
    # ranges are sampled from hashes: a sample of texts would be too large for the driver
    dealt = docs.select("doc_id", text_key(body).alias("key"), body.alias("text")).repartitionByRange(n, "doc_id", "key").sortWithinPartitions("doc_id", "key").select("doc_id", "text")

    def run(batches):
        import pandas as pd
        from pyspark import TaskContext

        part, seq, before, at = TaskContext.get().partitionId(), 0, 0, 0
        enc, end = encoder(tokenizer), np.array([end_id], "<u4")
        id_bytes = id_width(max(enc.tok.get_vocab_size(), end_id + 1))
        names, held = [], []

        def close():
            row = {"part": part, "seq": seq, "part_start": before, "n_ids": at - before, "nulls": names.count(None), "doc_ids": [[x for x in names if x is not None]], "segment": pack(held, id_bytes)}
            names.clear()
            held.clear()
            return pd.DataFrame(row)

        for pdf in batches:
            for lo in range(0, len(pdf), 500):
                chunk = pdf.iloc[lo : lo + 500]
                for doc, raw in zip(chunk["doc_id"], enc.encode(chunk["text"].tolist()), strict=True):
                    ids = np.concatenate((np.frombuffer(raw, "<u4"), end))
                    if held and at - before + len(ids) > segment_ids:
                        yield close()
                        seq, before = seq + 1, at
                    names.append(None if pd.isna(doc) else int(doc))
                    held.append(ids)
                    at += len(ids)
        if held:
            yield close()

    return store(dealt.mapInPandas(run, "part int, seq int, part_start long, n_ids long, nulls int, doc_ids array<long>, segment binary"), "segments")


def read_documents(segments: DataFrame) -> DataFrame:
    """One row a document from written segments: doc_id, start, n_tokens, ids_crc32.

    Parts' first offsets are a running sum over one row a part (their number is that of tasks), sent to
    all executors; within a part the segments already hold their offset.
    """
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = parts.select("part", (F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("base"))
    placed = segments.join(F.broadcast(base), "part").select((F.col("base") + F.col("part_start")).alias("first"), "nulls", "doc_ids", "segment")

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for first, nulls, names, data in zip(pdf["first"], pdf["nulls"], pdf["doc_ids"], pdf["segment"], strict=True):
                seg = Segment(data)
                ends = np.array([seg.ends.select(i) for i in range(len(seg))], np.int64)
                starts = np.append(0, ends[:-1]).astype(np.int64)
                crcs = [zlib.crc32(seg.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pd.DataFrame({"doc_id": pd.array([None] * nulls + [int(x) for x in names], "Int64"), "start": starts + first, "n_tokens": ends - starts, "ids_crc32": np.array(crcs, np.int64)})

    return placed.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = write_segments(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)
    return read_documents(segments.df)
