"""Word shingles as 64-bit hashes, many documents at a time, and parity sketches over them, in numpy."""

from __future__ import annotations

import numpy as np

WORDS = 5
_TABLE = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[32] = 0
_PLACE = np.random.default_rng(12).integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
CHUNK = 1 << 19


def mix(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    size, step = 1, base
    with np.errstate(over="ignore"):
        while size < n:
            out[size : 2 * size] = out[: min(size, n - size)] * np.uint64(step)
            size, step = 2 * size, step * step % (1 << 64)
    return out


_up, _down = _powers(_BASE, 1 << 16), _powers(pow(_BASE, -1, 1 << 64), 1 << 16)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _up, _down
    if len(_up) < n:
        size = 1 << (n - 1).bit_length()
        _up, _down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _up, _down


def words_of(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of all texts, whose white space is blanks, and per text the number of its first word, and the end."""
    joined = b" ".join(raws) + b" "
    bytes_ = np.frombuffer(joined, np.uint8)
    gap = bytes_ == 32
    before = np.concatenate([[True], gap[:-1]])
    starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
    up, down = _tables(len(bytes_) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[bytes_] * up[: len(bytes_)], dtype=np.uint64)])
        words = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return words, np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])]))


def _chunk(raws: list[bytes]) -> list[np.ndarray]:
    words, edges = words_of(raws)
    with np.errstate(over="ignore"):
        n = len(words) - WORDS + 1
        grams = mix(sum(words[i : i + n] * _PLACE[i] for i in range(WORDS))) if n > 0 else words[:0]
        out = []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if hi - lo >= WORDS:
                out.append(np.unique(grams[lo : hi - WORDS + 1]))
            elif hi > lo:  # the whole sequence is the only shingle
                own = (words[lo:hi] * _PLACE[: hi - lo]).sum(dtype=np.uint64)
                out.append(mix(np.array([own + np.uint64(int(hi - lo) << 56)], np.uint64)))
            else:
                out.append(words[:0])
    return out


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Per text its distinct shingles, sorted; empty without words."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0
    for t in texts:
        held.append((t or "").encode().translate(_TABLE))
        size += len(held[-1])
        if size >= CHUNK:
            out += _chunk(held)
            held, size = [], 0
    return out + _chunk(held) if held else out


def class_key(shingles: np.ndarray) -> int:
    """A 64-bit key of the set, as a signed number."""
    with np.errstate(over="ignore"):
        total = mix(shingles + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


LEAST_BITS = 512


def parity_words(shingles: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` parity bits (a power of two) as signed 64-bit words; the Hamming distance of two is at most the symmetric difference.

    The XOR of both halves is the sketch of half as many bits.
    """
    at = np.bincount((shingles >> np.uint64(7)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(at.astype(np.uint8)).view(np.int64)


def parity_bits(shingles: np.ndarray, bits: int) -> list[int]:
    return parity_words(shingles, bits).tolist()


def wide_bits(size: int) -> int:
    """Two to four bits a shingle, so that the distance of unlike sets shows; sets of linked sizes differ by one halving at most."""
    return max(LEAST_BITS, 2 << size.bit_length())


def bands(size: int) -> list[tuple[int, int]]:
    """(band, most differing blocks): a set's own band, and the next one if a partner of up to 4/3 of its size is there."""
    own, largest = size.bit_length(), 4 * size // 3
    found = [(own, (size + min(largest, (1 << own) - 1)) // 7)]
    if largest >= 1 << own:
        found.append((own + 1, (size + largest) // 7))
    return found


def block_tokens(shingles: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the sketch's non-empty blocks, and the numbers of those blocks.

    A band has half as many blocks as its largest set has shingles. Each shingle flips one bit of its block; a block is far wider than it has
    bits set, so it is kept as the XOR of a random word for each set bit.
    """
    shift = band - 1
    block = shingles >> np.uint64(64 - shift) if shift else np.zeros(len(shingles), np.uint64)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    word = np.bitwise_xor.reduceat(mix(shingles ^ np.uint64(0xD1B54A32D192ED03)), first)
    number = block[first]
    return _named(word, number, band), number


def _named(word: np.ndarray, number: np.ndarray, band: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(word + mix(number + np.uint64(band << 40)))


def prefix_tokens(shingles: np.ndarray, band: int, differ: int, weight: np.ndarray) -> np.ndarray:
    """The first ``differ + 1`` tokens in an order all sets share: light cells first.

    If at most ``differ`` blocks of two sets are unequal, their prefixes have a token in common. Empty blocks come last in the
    order, and so are only there for a set that has too few others.
    """
    tokens, number = block_tokens(shingles, band)
    if len(tokens) > differ:
        order = np.lexsort((tokens, weight[cells(tokens, weight)]))
        return tokens[order[: differ + 1]]
    empty = np.setdiff1d(np.arange(1 << (band - 1), dtype=np.uint64), number)
    named = np.sort(_named(np.full(len(empty), 0xABCDEF, np.uint64), empty, band))
    return np.concatenate([tokens, named[: differ + 1 - len(tokens)]])


def cells(tokens: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(65 - len(weight).bit_length())).astype(np.int64)
