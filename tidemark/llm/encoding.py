"""Whole-text encoding with the tokenizers library, each distinct piece once.

Both vocabularies split a text before merging, and white space always ends a split. So a text encodes as the concatenation of
pieces, and the library need meet each distinct piece only once per cache line. Most texts take the array path: many are laid
end to end as bytes and cut at spaces, at single line feeds, and before a comma or full stop that follows a letter or digit and ends
a word, which is where the split patterns certainly cut. Pieces are known by a 64-bit hash; a direct-mapped cache of
bounded size holds their ids, and new ones are encoded together. Texts with other white space, or letters beyond
Latin take the string path: cut at spaces, with memos; and a text whose pieces could depend on their neighbours goes to
the library whole.
"""

from __future__ import annotations

import os
import string
import struct
import unicodedata
from collections.abc import Iterator

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

#: Strings that one Python worker remembers per generation, pieces and words apart; there are two generations of each.
MEMO_PIECES, MEMO_WORDS = 50_000, 100_000
#: Bytes of texts laid end to end; lines of the cache; ids that a line holds.
GROUP_BYTES = 1 << 19
LINE_BITS, LINE_IDS = 20, 8

_CUT = "\x01"
#: What the cuts must not meet: their own mark, runs of the punctuation they cut before, and empty lines.
_UNSURE = (_CUT, ",,", "..", ".,", ",.", "\n\n")

_loaded: dict[tuple[str, bool], "PieceEncoder"] = {}


def encoder(path: str, space_joins: bool) -> "PieceEncoder":
    """One encoder per worker process and vocabulary."""
    key = (path, space_joins)
    if key not in _loaded:
        _loaded[key] = PieceEncoder(path, space_joins)
    return _loaded[key]


_LETTER, _DIGIT, _SPACE, _FEED, _STOP, _MARK, _END, _BAD = range(8)
_KIND = np.full(256, _BAD, np.uint8)
_KIND[33:127] = _MARK
_KIND[[*range(65, 91), *range(97, 123), *range(128, 192), 0xC3]] = _LETTER
_KIND[48:58], _KIND[32], _KIND[10], _KIND[[44, 46]], _KIND[1] = _DIGIT, _SPACE, _FEED, _STOP, _END
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_BASE = 0x2545F4914F6CDD1D
_BYTE = np.random.default_rng(21).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]).cumprod(dtype=np.uint64)


class _Lines:
    """A direct-mapped cache from hashes to rows of ids."""

    def __init__(self, kind):
        self.keys = np.zeros(1 << LINE_BITS, np.uint64)
        self.count = np.zeros(1 << LINE_BITS, np.uint8)
        self.ids = np.zeros((1 << LINE_BITS, LINE_IDS), kind)
        self.up = self.down = np.zeros(0, np.uint64)

    def hashes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(raw):
            size = max(GROUP_BYTES * 5 // 4, len(raw) + 1)
            self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        with np.errstate(over="ignore"):
            total = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(_BYTE[raw] * self.up[: len(raw)], out=total[1:])
            z = (total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return z ^ (z >> np.uint64(31)) | np.uint64(1)  # never the key of an empty line


class _Memo(dict):
    """Bounded: a full generation becomes the old one, from which strings that are met again come back."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old, self.failed = make, most, {}, False

    def __missing__(self, key: str):
        made = self.old.get(key)
        if made is None and (made := self.make(key)) is None:
            self.failed = True
            return b""
        self[key] = made
        return made

    def turn(self) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()


class PieceEncoder:
    """``space_joins``: a space belongs to the word after it (byte-level); otherwise white space and case are dropped."""

    def __init__(self, path: str, space_joins: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.space_joins, self.lead = space_joins, " " if space_joins else ""
        self.words = _Memo(self._cut_piece, MEMO_WORDS)
        self.pieces = _Memo(self._piece, MEMO_PIECES)
        self.lines = _Lines(np.uint16 if self.vocabulary <= 1 << 16 else np.uint32)
        self.waiting: list[str] = []
        self.holes: list[bytearray] = []
        self.joins: list[tuple[bytearray, list]] = []
        named = self.tokenizer.get_vocab()
        self.marked = np.zeros(max(named.values()) + 1, bool)
        self.marked[[i for token, i in named.items() if (token.startswith("Ġ") if space_joins else token.endswith("</w>"))]] = True

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _cut_piece(self, piece: str) -> bytes | bytearray | None:
        """None for a piece that may not be one; a plain word gets a hole that ``_learn`` fills."""
        bare = piece[1:] if self.space_joins and piece[:1] == " " else piece
        if bare.isalpha() and (len(bare) < len(piece) or not self.space_joins):
            self.waiting.append(piece)
            self.holes.append(hole := bytearray())
            return hole
        sure = piece in ("", ",", ".", "\n") or bare and not bare[0].isspace() and bare[-1].isalnum()
        return self.whole(piece) if sure else None

    def _cuts(self, text: str) -> list[str] | None:
        """The pieces by replacement; None where only the slower cut can tell."""
        if any(map(text.__contains__, _UNSURE)):
            return None
        if not self.space_joins:
            if not text.isascii() and ("Σ" in text or "İ" in text or not unicodedata.is_normalized("NFC", text)):
                return None  # case or composition may depend on neighbours
            text = text.lower()
        cut = text.replace(" ", _CUT + self.lead) + _CUT
        cut = cut.replace("," + _CUT, f"{_CUT},{_CUT}").replace("." + _CUT, f"{_CUT}.{_CUT}").replace(".\n", f"{_CUT}.{_CUT}\n{_CUT}")
        return cut.split(_CUT)

    def _piece(self, piece: str) -> bytes | bytearray | None:
        """A space-separated piece; letters and then ASCII punctuation are two splits, all else is the library's."""
        if not piece or piece[0].isspace():
            return None if self.space_joins else self.whole(piece)
        core = piece.rstrip(string.punctuation)
        if not self.space_joins and core.isascii():
            core, piece = core.lower(), piece.lower() if piece.isascii() else piece
        if not core.isalpha() or (not self.space_joins and core.lower() != core):
            return self.whole(self.lead + piece)
        if len(core) == len(piece):
            return self.words[self.lead + core]
        hole = bytearray()
        self.joins.append((hole, [self.words[self.lead + core], self.whole(piece[len(core) :])]))
        return hole

    def _learn(self) -> None:
        """Encode the words that wait, many at a time, and tell their ids apart by the marks of a word's first or last token."""
        words, holes, self.waiting, self.holes = self.waiting, self.holes, [], []
        for a in range(0, len(words), 2000):
            part = words[a : a + 2000]
            joined = "".join(part) if self.space_joins else " ".join(part)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            marks = np.flatnonzero(self.marked[ids])
            ends = np.append(marks[1:], len(ids)) if self.space_joins else marks + 1
            if len(ends) == len(part):
                raw, at = ids.tobytes(), 0
                for word, hole, end in zip(part, holes[a : a + 2000], (4 * ends).tolist(), strict=True):
                    hole += raw[at:end]
                    self.words[word] = raw[at:end]
                    at = end
            else:
                for word, hole in zip(part, holes[a : a + 2000], strict=True):
                    hole += self.whole(word)
        joins, self.joins = self.joins, []
        for hole, parts in joins:
            hole += b"".join(parts)
        self.words.turn()
        self.pieces.turn()

    def _values(self, text: str) -> list | None:
        """The memos' values for the pieces of a text; None if it must be encoded whole."""
        pieces = self._cuts(text)
        if pieces is not None:
            self.words.failed = False
            values = list(map(self.words.__getitem__, pieces))
            if not self.words.failed:
                return values
        head, _, rest = text.partition(" ")
        if not self.space_joins:
            return list(map(self.pieces.__getitem__, text.split(" ")))
        if not head or not rest:
            return None
        self.pieces.failed = False
        values = [self.whole(head), *map(self.pieces.__getitem__, rest.split(" "))]
        return None if self.pieces.failed else values

    def _by_strings(self, texts: list[str]) -> list[bytes]:
        found = [self._values(t) for t in texts]
        self._learn()
        return [self.whole(t) if v is None else b"".join(v) for t, v in zip(texts, found, strict=True)]

    def _new_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces; plain words many at a time."""
        out: list = [None] * len(pieces)
        skip = len(self.lead)
        plain = [i for i, p in enumerate(pieces) if p[skip:].isalpha() and p.startswith(self.lead)]
        for a in range(0, len(plain), 2000):
            part = plain[a : a + 2000]
            joined = ("" if skip else " ").join([pieces[i] for i in part])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            marks = np.flatnonzero(self.marked[ids])
            ends = np.append(marks[1:], len(ids)) if skip else marks + 1
            if len(ends) == len(part):
                raw, at = ids.tobytes(), 0
                for i, end in zip(part, (4 * ends).tolist(), strict=True):
                    out[i], at = raw[at:end], end
        return [self.whole(p) if ids is None else ids for p, ids in zip(pieces, out, strict=True)]

    def _by_arrays(self, raws: list[bytes]) -> list[bytes | None]:
        """Per text its ids; None where the string path must decide."""
        joined = b"\x01".join(raws) + b"\x01"
        raw = np.frombuffer(joined, np.uint8)
        size = np.array([len(r) + 1 for r in raws])
        first = np.cumsum(size) - size
        kind = _KIND[raw]
        pair = np.flatnonzero(raw[:-1] == 0xC3)
        bad = np.zeros(len(raw), bool)
        bad[pair] = (raw[pair + 1] == 0x97) | (raw[pair + 1] == 0xB7)  # signs among the letters
        if self.space_joins:
            bad |= (kind == _BAD) & (raw != 0xC4) & (raw != 0xC5)
        else:
            bad |= kind == _BAD
            raw = _SMALL[raw]
            lower = pair[(raw[pair + 1] >= 0x80) & (raw[pair + 1] <= 0x9E)] + 1
            raw[lower] += 0x20
        end = kind == _END
        before, after = np.concatenate([[_END], kind[:-1]]).astype(np.uint8), np.concatenate([kind[1:], [_END]]).astype(np.uint8)
        blank, gap = (kind == _SPACE) | (kind == _FEED), (after == _SPACE) | (after == _FEED)
        bad |= blank & gap  # more than one in a row
        bad |= (kind == _SPACE) & (after == _END)
        bad[end] = True
        bad[first + size - 1] = False  # the ends laid between texts, but not a mark inside one
        stop = (kind == _STOP) & (before <= _DIGIT) & (gap | (after == _END))
        cut = blank | stop | end
        cut[first] = True
        cut[1:] |= stop[:-1] | (kind[:-1] == _FEED)
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(raw))
        drop = end[starts]
        if not self.space_joins:
            starts = starts + blank[starts]
            drop |= starts == ends
        unsure = np.add.reduceat(bad, first) > 0
        drop |= np.repeat(unsure, size)[np.minimum(starts, len(raw) - 1)]
        starts, ends = starts[~drop], ends[~drop]
        h = self.lines.hashes(raw, starts, ends)
        line = (h >> np.uint64(64 - LINE_BITS)).astype(np.int64)
        rows, count = self.lines.ids[line], self.lines.count[line]
        missed = np.flatnonzero(self.lines.keys[line] != h)
        full, extra = count.astype(np.int64), None
        if len(missed):
            key, where, which = np.unique(h[missed], return_index=True, return_inverse=True)
            whole, at = raw.tobytes(), missed[where]
            pieces = [whole[a:z].decode() for a, z in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            made = self._new_pieces(pieces)
            n = np.array([len(m) // 4 for m in made])
            table = np.zeros((len(made), LINE_IDS), self.lines.ids.dtype)
            fits = n <= LINE_IDS
            n8 = np.where(fits, n, 0)
            flat = np.frombuffer(b"".join([m for m, f in zip(made, fits.tolist(), strict=True) if f]), "<u4")
            table[np.arange(LINE_IDS) < n8[:, None]] = flat
            slot = (key[fits] >> np.uint64(64 - LINE_BITS)).astype(np.int64)
            self.lines.keys[slot], self.lines.count[slot], self.lines.ids[slot] = key[fits], n[fits], table[fits]
            rows[missed], count[missed], full[missed] = table[which], n8[which], n[which]
            extra = np.flatnonzero(~fits[which])  # pieces of many ids are put between the others afterwards
        ids = rows[np.arange(LINE_IDS) < count[:, None]]
        if extra is not None and len(extra):
            before_it = np.cumsum(count, dtype=np.int64)[missed[extra]]
            many = [np.frombuffer(made[k], "<u4") for k in which[extra].tolist()]
            ids = np.insert(ids, np.repeat(before_it, [len(m) for m in many]), np.concatenate(many))
        ids = ids.astype("<u4").tobytes()
        owner = np.searchsorted(starts, np.append(first, len(raw)))
        total = np.concatenate([[0], np.cumsum(full)])
        return [None if u else ids[4 * total[a] : 4 * total[z]] for u, a, z in zip(unsure.tolist(), owner[:-1].tolist(), owner[1:].tolist(), strict=True)]

    def packed_all(self, texts: list[str]) -> Iterator[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        at = 0
        while at < len(texts):
            raws, size = [], 0
            while at + len(raws) < len(texts) and (not raws or size < GROUP_BYTES):
                raws.append(texts[at + len(raws)].encode())
                size += len(raws[-1])
            part, at = texts[at : at + len(raws)], at + len(raws)
            found = self._by_arrays(raws)
            rest = [i for i, f in enumerate(found) if f is None]
            for i, ids in zip(rest, self._by_strings([part[i] for i in rest]), strict=True):
                found[i] = ids
            yield from found
