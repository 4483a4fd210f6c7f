"""Encoding of whole texts by a public tokenizer file, with a bounded cache of encoded pre-tokens."""

from __future__ import annotations

import re

import numpy as np

_L = "A-Za-zÀ-ÖØ-öø-ÿ"
#: In texts of these characters only, the patterns below cut exactly where the tokenizers' own do.
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e¡¿«»{_L}]*")
_PATTERNS = {
    "ByteLevel": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+"),
    "Sequence": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[0-9]|[^\s{_L}0-9]+"),
}
#: Byte-level models' characters for bytes.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARS = {b: chr(b) for b in _PRINTED} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
#: Where one of these occurs, a space may not start a pre-token of its own.
_RUNS = ("  ", "\n ", "\t ", "\r ")
#: Words and pre-tokens remembered in each Python worker; beyond it the memory starts anew.
WORDS, PIECES = 1_500_000, 700_000
#: Characters encoded together.
BATCH = 1 << 20
_rng = np.random.default_rng(77)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_WHITE = np.isin(np.arange(256), [9, 10, 13, 32])


class Encoder:
    """encode(texts) gives each text's ids as little-endian uint32 bytes, equal to the library's ids.

    Both tokenizer files encode the pieces of their pre-tokenizer one by one, so a piece's ids don't depend
    on its neighbours, and pieces never reach over a space that follows a word. Plain texts are cut at
    spaces; all words of a batch are looked up together by 64-bit hash, and their bytes are compared with those of
    the word found. A word not met before is cut into pieces, and a piece not met before is encoded by the
    library's model. Any other text, and one with a word whose hash another has too, goes to the library whole.
    """

    def __init__(self, path: str):
        import json
        import os

        # an executor has its cores busy with tasks already; more threads only wait for each other
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = (spec.get("pre_tokenizer") or {}).get("type")
        self.lower = kind == "Sequence"
        self.cut = self._pattern(kind, spec)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.pieces: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.keys, self.where = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.first, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")
        self.begin, self.size, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    @staticmethod
    def _pattern(kind, spec):
        """The fast cut is used only where it was proven equal: the two layouts named above."""
        if kind == "ByteLevel" and not spec.get("normalizer") and not spec["pre_tokenizer"].get("add_prefix_space"):
            return _PATTERNS[kind]
        if kind == "Sequence" and [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            return _PATTERNS[kind]
        return None

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token, by the library's BPE model alone: its bytes as the model's characters."""
        return np.array([t.id for t in self.tok.model.tokenize(piece.encode().decode("latin-1").translate(_CHARS))], "<u4").tobytes()

    def _plain(self, text: str) -> bool:
        return self.cut is not None and _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special) and (self.lower or not any(s in text for s in _RUNS))

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        pieces, find, piece = self.pieces, self.cut.findall, self._piece
        if len(pieces) > PIECES:
            pieces.clear()
        out = []
        for w in words:
            got = []
            for p in find(w):
                if p not in pieces:
                    pieces[p] = piece(p)
                got.append(pieces[p])
            out.append(b"".join(got))
        count = np.array([len(x) // 4 for x in out], np.int64)
        self.first = np.append(self.first, len(self.ids) + np.cumsum(count) - count)
        self.where = np.append(self.where, np.arange(len(self.count), len(self.count) + len(words), dtype=np.int32))
        self.count = np.append(self.count, count)
        raw = [w.encode() for w in words]
        size = np.array([len(w) for w in raw], np.int64)
        self.begin = np.append(self.begin, len(self.bytes) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.bytes = np.append(self.bytes, np.frombuffer(b"".join(raw), np.uint8))
        self.ids = np.append(self.ids, np.frombuffer(b"".join(out), "<u4"))
        self.keys = np.append(self.keys, keys)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.where = self.keys[order], self.where[order]

    def _plain_batch(self, texts: list[str]) -> list[bytes | None]:
        """Ids of plain texts; none for one with a word that shares its hash with another."""
        if len(self.keys) > WORDS:
            self._forget()
        data = [t.lower().encode() if self.lower else t.encode() for t in texts]
        raw = b"\0".join(data) + b"\0"
        flat = np.frombuffer(raw, np.uint8)
        ends = np.cumsum([len(d) + 1 for d in data]) - 1
        # a unit is a word (dropped white space) or a word with the space before it
        gap = flat == 0
        after = np.append(True, gap[:-1])
        if self.lower:
            gap |= _WHITE[flat]
            start = ~gap & np.append(True, gap[:-1])
            inside = ~gap
        else:
            start = ~gap & (after | (flat == 32))
            inside = ~gap
        begin = np.flatnonzero(start)
        if not len(begin):
            return [b""] * len(texts)
        at = np.flatnonzero(inside)
        unit = np.cumsum(start)[at] - 1
        place = at - begin[unit]
        power = np.full(int(place.max()) + 1, _STEP, np.uint64)
        power[0] = 1
        head = np.searchsorted(at, begin)
        h = np.add.reduceat(_BYTE[flat[at]] * np.cumprod(power)[place], head)
        size = np.diff(np.append(head, len(at)))
        h = (h ^ (h >> np.uint64(31))) * _STEP + size.astype(np.uint64)
        distinct, one, back = np.unique(h, return_index=True, return_inverse=True)
        found = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        new = self.keys[found] != distinct if len(self.keys) else np.ones(len(distinct), bool)
        if new.any():
            here = one[new]
            self._learn(distinct[new], [raw[b : b + n].decode() for b, n in zip(begin[here].tolist(), size[here].tolist(), strict=True)])
            found = np.searchsorted(self.keys, distinct)
        slot = self.where[found][back]
        count = self.count[slot]
        upto = np.cumsum(count)
        total = int(upto[-1])
        ids = self.ids[np.repeat(self.first[slot] - (upto - count), count) + np.arange(total)].tobytes()
        last = np.searchsorted(begin, ends)  # units up to each text's end
        stops = (np.append(0, upto)[last] * 4).tolist()
        out = [ids[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]
        same = self.size[slot] == size
        known = self.begin[slot]
        # a unit of another size is wrong whatever its bytes; they are read where they can be
        other = self.bytes[np.minimum(known[unit] + place, len(self.bytes) - 1)] != flat[at]
        if other.any() or not same.all():
            wrong = np.union1d(unit[other], np.flatnonzero(~same))
            for k in np.unique(np.searchsorted(last, wrong, "right")).tolist():
                out[k] = None
        return out

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        held: list[int] = []
        size = 0
        for k, t in enumerate(texts):
            if self._plain(t):
                held.append(k)
                size += len(t)
            else:
                out[k] = self._whole(t)
            if held and (size >= BATCH or k == len(texts) - 1):
                for j, x in zip(held, self._plain_batch([texts[j] for j in held]), strict=True):
                    out[j] = self._whole(texts[j]) if x is None else x
                held, size = [], 0
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process and file, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget_words() -> bool:
    """Lets go of the words and pieces that this process's encoders remember; whether there were any."""
    held = [e for e in _encoders.values() if e.pieces or len(e.keys)]
    for e in held:
        e.pieces = {}
        e._forget()
    return bool(held)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
