"""Operator 5: removal of byte strings that repeat across documents, by a distributed suffix sort.

A byte goes if a string of `WIDTH` bytes that covers it also starts in a document with a smaller doc_id.

Method. A suffix starts at every token: a word, or in stretches of over `REACH` bytes without a word's start the
place whose next eight bytes hash lowest. Each window of WIDTH bytes belongs to the first token that starts in its
first REACH bytes (after the first), which depends on the window's own bytes only; so equal windows belong to
suffixes that agree in their first `KEY` bytes, and stand as many bytes before them.
1. Texts are written once as blocks, with their suffixes' places.
2. A sample of the suffixes gives splitters: ranges of the first KEY bytes (five or six tokens) of equal volume.
3. The ranges are sorted in `PASSES` passes, as the records of all suffixes are many times the text: a record holds
   the bytes of all windows of its suffix. Each task first settles what it can among its own documents, so a
   passage that very many documents share is a record a task; the others go to their ranges' buckets.
4. A bucket is sorted by multikey quicksort, eight bytes being one character: each character is sorted by itself,
   and only suffixes that tie with one of another document go on to the next. Of suffixes that agree in KEY bytes
   the windows are compared, byte for byte; all but the smallest document's are marked.
5. A string of KEY bytes so frequent that it is several splitters spans the buckets between them. Its suffixes are
   dealt over these, settled there, and what is left in each is compared across the buckets' boundaries, window by
   window, dealt by the whole windows.
6. Marks are brought to their blocks and cut there. No byte goes on a hash alone: hashes only choose tokens' places
   in long stretches and deal windows in step 5.

Nulls: a null text is empty; a null doc_id counts as larger than all others. Rows that share a doc_id don't
remove from each other. Texts under WIDTH bytes stay whole. Removed bytes may cut a UTF-8 character: in texts
that are returned, its other bytes go too. Empty tables give empty results; other columns, whatever their names,
are passed on by `drop_repeats` and left unread by `find_repeats`.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from curlew.llm._common import Temporary, fresh, lean, release, store, table

WIDTH = 50
REACH = 16  # a window's suffix starts 1 to REACH bytes after it
RIGHT = WIDTH - 1
RECORD = REACH + RIGHT  # bytes before and after a suffix's start that its windows cover
KEY = 32
#: Bytes of text of a block, of blocks settled together before records are sent, and of records in a bucket.
BLOCK, GROUP, BUCKET = 4 << 20, 16 << 20, 24 << 20
PASSES = 8
#: Sampled suffixes for each bucket, and blocks that are sampled at least, and one in so many of the others.
SAMPLES, BLOCKS, ONE_IN = 16, 32, 16
#: Places looked at together when suffixes are chosen.
SEGMENT = 1 << 20
SLOTS = 1 << 16
LAST = (1 << 63) - 1


# --- suffixes of a text ------------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _space() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[32, *range(9, 14)]] = True
    return out


def suffixes(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix in order: the number of windows it has, and how far it starts after the first of them.

    inside: whether the window that starts at each place lies in one document; data goes on REACH + 8 bytes at least.
    """
    n = len(inside)
    white = _space()[data[: n + REACH + 1]]
    bits = np.uint64(int(n + REACH + 1).bit_length())
    v = _mix(np.ndarray((n + REACH,), "<u8", np.ascontiguousarray(data), 1, (1,)).astype(np.uint64)) | np.uint64(1 << 63)
    v >>= bits
    v <<= bits
    v[white[:-1] & ~white[1:]] = 0  # a word's start goes before all else
    v |= np.arange(1, len(v) + 1, dtype=np.uint64)
    size = 1
    while size < REACH:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    at = np.flatnonzero(inside)
    start = (v[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    head = np.ones(len(at), bool)
    head[1:] = (start[1:] != start[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(head)
    return np.diff(np.append(first, len(at))).astype(np.uint8), (start[first] - at[first]).astype(np.uint8)


def chosen(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`suffixes` of documents that lie one after another, end by end."""
    begin = np.append(0, ends[:-1])
    padded = np.concatenate((flat, np.zeros(REACH + 16, np.uint8)))
    counts, offsets = [], []
    for lo in range(0, len(flat), SEGMENT):
        inside = np.zeros(min(SEGMENT, len(flat) - lo), bool)
        for k in range(np.searchsorted(ends, lo, "right"), np.searchsorted(begin, lo + len(inside), "left")):
            inside[max(0, begin[k] - lo) : max(0, ends[k] - WIDTH + 1 - lo)] = True
        if inside.any():
            c, o = suffixes(padded[lo : lo + len(inside) + REACH + 16], inside)
            counts.append(c)
            offsets.append(o)
    empty = np.zeros(0, np.uint8)
    return np.concatenate(counts or [empty]), np.concatenate(offsets or [empty])


class Block:
    """Documents of a block as read back, and its suffixes' starts, in order."""

    def __init__(self, number: int, docs: bytes, counts: bytes, offsets: bytes):
        self.number, self.batch = number, read_batch(docs)
        self.text = self.batch.column("text")
        buffers, n = self.text.buffers(), len(self.text)
        edges = np.frombuffer(buffers[1], "<i4")[self.text.offset : self.text.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        self.flat = np.frombuffer(buffers[2] or b"", np.uint8)[edges[0] : edges[-1]]
        self.edges = edges - edges[0]
        ids = self.batch.column("doc_id")
        self.ids = np.array([LAST if x is None else x for x in ids.to_pylist()], np.int64) if ids.null_count else ids.to_numpy()
        self.counts, self.most = np.frombuffer(counts, np.uint8), np.frombuffer(offsets, np.uint8)

    def starts(self) -> tuple[np.ndarray, np.ndarray]:
        """(place of each suffix, its document)."""
        windows = np.maximum(np.diff(self.edges) - WIDTH + 1, 0)
        before = np.cumsum(windows) - windows
        first = np.cumsum(self.counts, dtype=np.int64) - self.counts
        doc = np.repeat(np.arange(len(windows)), np.diff(np.append(np.searchsorted(first, before), len(first))))
        return first + (self.edges[:-1] - before)[doc] + self.most, doc

    def padded(self) -> np.ndarray:
        return np.concatenate((np.zeros(REACH, np.uint8), self.flat, np.zeros(RIGHT + 8, np.uint8)))


def write_batch(batch) -> bytes:
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_batch(data: bytes):
    import pyarrow as pa

    return pa.ipc.open_stream(data).read_next_batch()


def blocks(docs: DataFrame) -> DataFrame:
    """Rows of `docs` (doc_id long, text string, and others) in blocks, with the places of their suffixes."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            nonlocal seq, size
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            size = 0
            number, seq = part << 32 | seq, seq + 1
            data = write_batch(whole)
            block = Block(number, data, b"", b"")
            counts, offsets = chosen(block.flat, block.edges[1:])
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([data], pa.binary()), pa.array([counts.tobytes()], pa.binary()), pa.array([offsets.tobytes()], pa.binary()), pa.array([len(counts)], pa.int64())], names=["block", "docs", "counts", "offsets", "suffixes"])

        for batch in batches:
            lens = np.diff(np.frombuffer(batch.column("text").buffers()[1], "<i4")[batch.column("text").offset :][: batch.num_rows + 1].astype(np.int64)) if batch.num_rows else []
            at = 0
            for k, n in enumerate(lens):
                size += int(n) + 16
                if size >= BLOCK:
                    held.append(batch.slice(at, k + 1 - at))
                    at = k + 1
                    yield close()
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            yield close()

    return docs.mapInArrow(run, "block long, docs binary, counts binary, offsets binary, suffixes long")


# --- records, and what can be settled among some of them ----------------------------------------------------


def characters(data: np.ndarray) -> list[np.ndarray]:
    """Columns of eight bytes as numbers in the bytes' order."""
    n, width = data.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = data
    return [c.astype(np.uint64) for c in padded.view(">u8").T]


def tied(columns, owner: np.ndarray, rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of rows within their groups by a character after the other.

    Returns rows that agree in all characters with one of another owner, and numbers of the groups they form;
    a group of one owner is sorted no further.
    """
    for column in columns:
        if not len(rows):
            break
        x = column[rows]
        if group[-1] == group[0]:
            order = np.argsort(x)
        else:
            order = np.lexsort((x, group))
        rows, x, group = rows[order], x[order], group[order]
        head = np.ones(len(rows), bool)
        head[1:] = (x[1:] != x[:-1]) | (group[1:] != group[:-1])
        rows, group = several(rows, np.cumsum(head) - 1, owner)
    return rows, group


def several(rows: np.ndarray, group: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of groups (numbered in order) that have more than one owner."""
    if not len(rows):
        return rows, group
    least, most = extremes(group, owner[rows])
    keep = least < most
    return rows[keep], group[keep]


def extremes(group: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest owner of each row's group."""
    head = np.ones(len(group), bool)
    head[1:] = group[1:] != group[:-1]
    first = np.flatnonzero(head)
    label = np.cumsum(head) - 1
    return np.minimum.reduceat(owner, first)[label], np.maximum.reduceat(owner, first)[label]


class Records:
    """Suffixes with the bytes of their windows; arrays of one length."""

    FIELDS = ("data", "least", "most", "owner", "block", "place")

    def __init__(self, data, least, most, owner, block, place):
        self.data, self.least, self.most, self.owner, self.block, self.place = data, least, most, owner, block, place

    def __len__(self) -> int:
        return len(self.least)

    @classmethod
    def of(cls, block: Block, start: np.ndarray, doc: np.ndarray, which: np.ndarray, padded: np.ndarray) -> Records:
        """Records of some suffixes of a block; bytes outside of a record's windows are zero."""
        place = start[which]
        data = np.lib.stride_tricks.sliding_window_view(padded, RECORD)[place]
        most = block.most[which]
        least = most - block.counts[which] + np.uint8(1)
        column = np.arange(RECORD, dtype=np.uint8)
        data *= column >= np.uint8(REACH) - most[:, None]
        short = np.flatnonzero(least > 1)
        if len(short):
            data[short] *= column < np.uint8(RECORD + 1) - least[short, None]
        return cls(data, least, most, block.ids[doc[which]], np.full(len(place), block.number, np.int64), place.astype(np.uint32))

    @classmethod
    def joined(cls, parts: list[Records]) -> Records:
        return cls(*(np.concatenate([getattr(p, f) for p in parts]) for f in cls.FIELDS))

    def take(self, rows: np.ndarray) -> Records:
        return Records(*(getattr(self, f)[rows] for f in self.FIELDS))

    def keys(self) -> np.ndarray:
        return np.ascontiguousarray(self.data[:, REACH : REACH + KEY]).view(f"S{KEY}").ravel()

    def pack(self) -> bytes:
        import zstandard

        n = len(self)
        planes = [x.view(np.uint8).reshape(n, -1).T.tobytes() for x in (self.owner.astype("<i8"), self.block.astype("<i8"), self.place.astype("<u4"))]
        return zstandard.ZstdCompressor(level=1).compress(b"".join((self.data.tobytes(), self.least.tobytes(), self.most.tobytes(), *planes)))

    @classmethod
    def unpack(cls, payload: bytes) -> Records:
        import zstandard

        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
        n, at, out = len(raw) // (RECORD + 22), 0, []
        for width, kind in ((RECORD, None), (1, None), (1, None), (8, "<i8"), (8, "<i8"), (4, "<u4")):
            x = raw[at : at + width * n]
            at += width * n
            out.append(x if width == 1 else x.reshape(n, width) if kind is None else np.ascontiguousarray(x.reshape(width, n).T).view(kind).ravel())
        return cls(*out)

    def windows(self, rows: np.ndarray, offset: int) -> np.ndarray:
        """Which of `rows` have a window `offset` bytes before their suffix."""
        return (self.least[rows] <= offset) & (self.most[rows] >= offset)

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, offset) of windows that a smaller owner's record here has too; offset 0: all windows of the row."""
        rows, group = np.arange(len(self)), np.zeros(len(self), np.int64)
        key = characters(self.data[:, REACH : REACH + KEY])
        rows, group = tied(key, self.owner, rows, group)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if len(rows):
            sub = self.data[rows]
            local, owner = np.arange(len(rows)), self.owner[rows]
            rest = np.concatenate((sub[:, REACH + KEY :], sub[:, :REACH], self.least[rows, None], self.most[rows, None]), axis=1)
            same, whole = tied(characters(rest), owner, local, group)
            gone = np.zeros(len(rows), bool)
            if len(same):
                gone[same] = owner[same] > extremes(whole, owner[same])[0]
            found.append((rows[gone], np.zeros(int(gone.sum()), np.int64)))
            left, at = several(local[~gone], group[~gone], owner)
            for offset in range(1, REACH + 1) if len(left) else ():
                has = self.windows(rows[left], offset)
                some, where = several(left[has], at[has], owner)
                if not len(some):
                    continue
                beyond = np.concatenate((sub[some, REACH - offset : REACH], sub[some, REACH + KEY : REACH + WIDTH - offset]), axis=1)
                hit, equal = tied(characters(beyond), owner[some], np.arange(len(some)), where)
                if len(hit):
                    hit = hit[owner[some[hit]] > extremes(equal, owner[some[hit]])[0]]
                    found.append((rows[some[hit]], np.full(len(hit), offset, np.int64)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def left(self, row: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """Rows that have a window besides those found."""
        gone = np.bincount(row, np.where(offset == 0, 99, 1), len(self))
        return np.flatnonzero(gone <= self.most.astype(np.int64) - self.least)

    def spans(self, row: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(block, from, to) of windows found."""
        place, whole = self.place[row].astype(np.int64), offset == 0
        return self.block[row], place - np.where(whole, self.most[row], offset), place - np.where(whole, self.least[row], offset) + WIDTH


def merged(block: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching spans of a block, in order."""
    if not len(block):
        return block, start, end
    order = np.lexsort((start, block))
    block, start, end = block[order], start[order], end[order]
    base = np.unique(block, return_inverse=True)[1].astype(np.int64) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(base + end)
    head = np.ones(len(block), bool)
    head[1:] = (base + start)[1:] > reach[:-1]
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(block)) - 1
    return block[first], start[first], reach[last] - base[first]


def pack_spans(start: np.ndarray, end: np.ndarray) -> bytes:
    """Gaps and lengths byte plane by byte plane: small ones leave zeros that compress."""
    edges = np.stack((start, end), axis=1).ravel()
    return np.diff(edges, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    edges = np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel(), dtype=np.int64)
    return edges[::2], edges[1::2]


def span_rows(block: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Spans as rows of a block and its packed spans."""
    if not len(block):
        return []
    block, start, end = merged(block, start, end)
    first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    return [(int(block[a]), pack_spans(start[a:b], end[a:b])) for a, b in zip(first, [*first[1:], len(block)], strict=True)]


# --- splitters ----------------------------------------------------------------------------------------------


class Splitters:
    """Sorted strings of KEY bytes; bucket k holds what is over the k-th and not over the next.

    A string that is several splitters is hot: its suffixes are dealt over the buckets between them.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = sorted(strings)
        flat = np.frombuffer(b"".join(self.strings), np.uint8).reshape(-1, KEY)
        self.columns, self.whole = characters(flat), np.ascontiguousarray(flat).view(f"S{KEY}").ravel()
        self.hot = {a for a, b in zip(self.strings[1:], self.strings, strict=False) if a == b}

    def __len__(self) -> int:
        return len(self.strings) + 1

    def first(self, lo: int) -> int:
        """First eight bytes, as a number, from which bucket `lo` can have suffixes."""
        return int(self.columns[0][lo - 1]) if lo else 0

    def last(self, hi: int) -> int:
        """First eight bytes up to which buckets below `hi` can have suffixes."""
        return int(self.columns[0][hi - 1]) if hi <= len(self.strings) else (1 << 64) - 1

    def buckets(self, data: np.ndarray, salt: int) -> np.ndarray:
        """The bucket of each row of KEY bytes; one of several, by salt, for hot strings."""
        first = characters(data[:, :8])[0]
        lo, hi = np.searchsorted(self.columns[0], first, "left"), np.searchsorted(self.columns[0], first, "right")
        unsure = np.flatnonzero(lo < hi)  # the first eight bytes don't tell
        if len(unsure):
            whole = np.ascontiguousarray(data[unsure]).view(f"S{KEY}").ravel()
            lo[unsure], hi[unsure] = np.searchsorted(self.whole, whole, "left"), np.searchsorted(self.whole, whole, "right")
        return lo + np.where(hi - lo > 1, salt % np.maximum(hi - lo, 1), 0)


def sampled(blocks: DataFrame, suffixes: int, buckets: int) -> Splitters:
    """Splitters from suffixes of a sample of blocks, after these are settled by themselves; SAMPLES a bucket come to the driver."""
    count = blocks.count()
    one_in = max(1, min(ONE_IN, count // BLOCKS))
    step = max(1, suffixes // one_in // (SAMPLES * buckets))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["block"], row["docs"], row["counts"], row["offsets"])
                start, doc = block.starts()
                records = Records.of(block, start, doc, np.arange(len(start)), block.padded())
                keep = records.left(*records.settle())
                keep = keep[_mix(keep.astype(np.uint64) + np.uint64(1)) % np.uint64(step) == 0]
                yield pa.RecordBatch.from_arrays([pa.array([x.ljust(KEY, b"\0") for x in records.take(keep).keys().tolist()], pa.binary())], names=["key"])

    picked = blocks.filter(F.pmod(F.xxhash64("block"), F.lit(one_in)) == 0) if one_in > 1 else blocks
    keys = sorted(picked.select("block", "docs", "counts", "offsets").mapInArrow(run, "key binary").toArrow().column("key").to_pylist())
    buckets = min(buckets, len(keys) + 1)  # where most suffixes are settled at once, fewer have to be sorted
    return Splitters([keys[k * len(keys) // buckets] for k in range(1, buckets)])


# --- the sort -----------------------------------------------------------------------------------------------


def sent(blocks: DataFrame, split, lo: int, hi: int) -> DataFrame:
    """Records of buckets lo to hi (bucket, null, payload); spans that are settled already (a bucket, block, payload)."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        splitters = split.value
        first, last = np.uint64(splitters.first(lo)), np.uint64(splitters.last(hi))
        salt = TaskContext.get().partitionId()
        held, size = [], 0

        def flush():
            nonlocal held, size, salt
            records = Records.joined(held)
            held, size = [], 0
            row, offset = records.settle()
            out = [(lo + block % (hi - lo), block, spans) for block, spans in span_rows(*records.spans(row, offset))]
            records = records.take(records.left(row, offset))
            salt += 1
            bucket = splitters.buckets(records.data[:, REACH : REACH + KEY], salt)
            order = np.lexsort((characters(records.data[:, REACH : REACH + 8])[0], bucket))
            edges = np.searchsorted(bucket[order], np.arange(lo, hi + 1))
            out += [(b, None, records.take(order[x:y]).pack()) for b, x, y in zip(range(lo, hi), edges, edges[1:], strict=False) if x < y]
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.binary())], names=["bucket", "block", "payload"])

        for batch in batches:
            for k in range(batch.num_rows):
                block = Block(*(batch.column(c)[k].as_py() for c in range(4)))
                start, doc = block.starts()
                padded = block.padded()
                key = np.ndarray((len(padded) - 7,), ">u8", padded, 0, (1,))[start + REACH].astype(np.uint64)
                which = np.flatnonzero((key >= first) & (key <= last))
                if len(which):
                    held.append(Records.of(block, start, doc, which, padded))
                size += len(block.flat)
                if size >= GROUP and held:
                    yield flush()
        if held:
            yield flush()

    return blocks.select("block", "docs", "counts", "offsets").mapInArrow(run, "bucket int, block long, payload binary")


MARKS = "block long, slot int, payload binary"


def window_rows(records: Records, rows: np.ndarray, gone: set) -> list[tuple[None, int, bytes]]:
    """Windows of hot suffixes that are left in a bucket, packed by slot: the window's bytes, owner, block, place."""
    import xxhash

    out: dict[int, list[bytes]] = {}
    for offset in range(1, REACH + 1):
        for r in rows[records.windows(rows, offset)].tolist():
            if (r, offset) not in gone:
                window = records.data[r, REACH - offset : REACH - offset + WIDTH].tobytes()
                tail = np.array([records.owner[r], records.block[r], int(records.place[r]) - offset], "<i8").tobytes()
                out.setdefault(xxhash.xxh3_64_intdigest(window) % SLOTS, []).append(window + tail)
    return [(None, slot, b"".join(x)) for slot, x in out.items()]


def settled(rows: DataFrame, split) -> DataFrame:
    """Marks (block, packed spans) of a pass, and windows (slot, packed) that are to be compared across boundaries."""

    def run(group):
        import pyarrow as pa

        splitters = split.value
        out = [(b, None, s) for b, s in zip(group.column("block").to_pylist(), group.column("payload").to_pylist(), strict=True) if b is not None]
        parts = [Records.unpack(p) for b, p in zip(group.column("block").to_pylist(), group.column("payload").to_pylist(), strict=True) if b is None]
        if parts:
            records = Records.joined(parts)
            row, offset = records.settle()
            out += [(block, None, spans) for block, spans in span_rows(*records.spans(row, offset))]
            if splitters.hot:
                left = records.left(row, offset)
                hot = left[np.isin(records.take(left).keys(), np.array(sorted(splitters.hot), f"S{KEY}"))]
                out += window_rows(records, hot, set(zip(row.tolist(), offset.tolist(), strict=True)))
        return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "slot": pa.array([x[1] for x in out], pa.int32()), "payload": pa.array([x[2] for x in out], pa.binary())})

    return rows.groupBy("bucket").applyInArrow(run, MARKS)


def across(windows: DataFrame, parts: int) -> DataFrame:
    """Marks of windows that stood in several buckets, compared whole."""

    def run(group):
        import pyarrow as pa

        raw = np.frombuffer(b"".join(group.column("payload").to_pylist()), np.uint8).reshape(-1, WIDTH + 24)
        owner, block, start = np.ascontiguousarray(raw[:, WIDTH:]).view("<i8").T
        hit, equal = tied(characters(raw[:, :WIDTH]), owner, np.arange(len(raw)), np.zeros(len(raw), np.int64))
        if len(hit):
            hit = hit[owner[hit] > extremes(equal, owner[hit])[0]]
        out = span_rows(block[hit], start[hit], start[hit] + WIDTH)
        return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "slot": pa.array([None] * len(out), pa.int32()), "payload": pa.array([x[1] for x in out], pa.binary())})

    return windows.groupBy(F.pmod("slot", F.lit(parts)).alias("part")).applyInArrow(run, MARKS)


def marks(blocks: DataFrame, bucket_bytes: int = BUCKET, passes: int = PASSES) -> DataFrame:
    """Spans to remove, one row a block that has any: (block, packed spans)."""
    spark = blocks.sparkSession
    suffixes = blocks.agg(F.coalesce(F.sum("suffixes"), F.lit(0))).first()[0]
    splitters = sampled(blocks, suffixes, max(1, -(-suffixes * RECORD // bucket_bytes)))
    split = spark.sparkContext.broadcast(splitters)
    edges = sorted({len(splitters) * k // passes for k in range(passes + 1)})
    found = []
    for lo, hi in zip(edges, edges[1:], strict=False):
        found.append(store(settled(sent(blocks, split, lo, hi), split), "marks").df)
        release(spark)
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    if splitters.hot:
        windows = every.filter("slot IS NOT NULL")
        size = windows.agg(F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).cast("long")).first()[0]
        every = every.unionByName(store(across(windows, max(1, min(SLOTS, -(-size // bucket_bytes)))), "marks").df)

    def union(group):
        import pyarrow as pa

        start, end = (np.concatenate(x) for x in zip(*map(unpack_spans, group.column("payload").to_pylist()), strict=True))
        _, start, end = merged(np.zeros(len(start), np.int64), start, end)
        return pa.table({"block": group.column("block").slice(0, 1), "spans": pa.array([pack_spans(start, end)], pa.binary())})

    return every.filter("slot IS NULL").select("block", "payload").groupBy("block").applyInArrow(union, "block long, spans binary")


def marked(docs: DataFrame, **sizes: int) -> DataFrame:
    """Blocks of rows of `docs` (docs) with their spans (null: none); scratch tables but these two are deleted."""
    with Temporary() as temp:
        stored = temp.keep(store(blocks(docs), "blocks"))
        spans = temp.keep(store(marks(stored.df, **sizes), "spans"))
    release(docs.sparkSession)
    return stored.df.select("block", "docs").join(spans.df, "block", "left").select("docs", "spans")


def cuts(docs: bytes, spans: bytes | None):
    """Each document of a block: (bytes, spans to remove within it); and the block's rows."""
    block = Block(0, docs, b"", b"")
    start, end = unpack_spans(spans) if spans else (np.zeros(0, np.int64),) * 2
    edges, flat = block.edges, block.flat
    near = np.searchsorted(end, edges[:-1], "right"), np.searchsorted(start, edges[1:], "left")
    out = []
    for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        own = slice(near[0][k], near[1][k])
        out.append((flat[a:b].tobytes(), list(zip(np.maximum(start[own], a) - a, np.minimum(end[own], b) - a, strict=True))))
    return out, block.batch


def kept(body: bytes, spans) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(body[at:a])
        at = b
    parts.append(body[at:])
    return b"".join(parts)


def find_repeats(docs: DataFrame, **sizes: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document; sizes: of `marks`."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for data, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, rows = cuts(data, spans)
                got = [(len(body), int(sum(b - a for a, b in s)), len(s), hashlib.sha256(kept(body, s)).hexdigest()) for body, s in found]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array([r[k] for r in got], pa.int64() if k < 3 else pa.string()) for k in range(4))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), **sizes).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """Pipeline form: all documents, without the removed bytes; n_chars of those cut is counted anew."""
    flag, kinds = fresh("cut", docs.columns), docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(c for c in docs.columns if c not in ("doc_id", "text")))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for data, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, rows = cuts(data, spans)
                texts = [kept(body, s).decode("utf-8", "ignore") if s else None for body, s in found]
                at = rows.schema.get_field_index("text")
                whole = [t if t is not None else x for t, x in zip(texts, rows.column(at).to_pylist(), strict=True)]
                columns = [pa.array(whole, rows.schema.field(at).type) if k == at else c for k, c in enumerate(rows.columns)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([t is not None for t in texts])], schema=rows.schema.append(pa.field(flag, pa.bool_())))

    out = marked(kinds).mapInArrow(lean(run), StructType([*kinds.schema.fields, StructField(flag, BooleanType())]))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(flag), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*(F.col(c).cast(docs.schema[c].dataType).alias(c) if c == "doc_id" else F.col(c) for c in docs.columns))


def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(table(spark, sf_dir, "documents"))
