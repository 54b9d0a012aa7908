"""Words and shingles of many texts at a time, as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_STEP = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, U), np.cumprod(np.full(n - 1, base, U))])


_POW = _powers(int(_BASE), _STEP)
_INV = _powers(pow(int(_BASE), -1, 1 << 64), _STEP)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters near ones (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def segment_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte segment, whatever its place in ``buf``: a polynomial of all its bytes and its length, mixed."""
    out = np.zeros(len(starts), U)
    if not len(starts):
        return out
    with np.errstate(over="ignore"):
        # in pieces of the buffer, so that the powers are few; a segment's sum is put together from the pieces it touches
        for lo in range(0, len(buf), _STEP):
            hi = min(lo + _STEP, len(buf))
            a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi, "left")
            if a >= b:
                continue
            total = np.concatenate([np.zeros(1, U), np.cumsum((buf[lo:hi].astype(U) + U(1)) * _POW[: hi - lo])])
            s, e = np.maximum(starts[a:b], lo) - lo, np.minimum(ends[a:b], hi) - lo
            part = (total[e] - total[s]) * _INV[np.minimum(s, _STEP - 1)]
            before = lo - starts[a:b]
            if a < b and before[0] > 0:  # the first segment began in an earlier piece
                part[0] *= U(pow(int(_BASE), int(before[0]), 1 << 64))
            out[a:b] += part
        return mix(out + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


#: Bytes that part words: space and \x09 to \x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def join_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with one line feed after each, and where each begins (one more for the end)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    return buf, at


def word_spans(buf: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    gap = space[buf]
    edge = np.diff(np.concatenate([np.ones(1, np.int8), gap.astype(np.int8)]))
    starts = np.flatnonzero(edge == -1)
    ends = np.flatnonzero(edge == 1)
    return starts, ends


def word_hashes(texts: list[bytes], space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the number of words before it (one more for the end)."""
    buf, at = join_bytes(texts)
    starts, ends = word_spans(buf, space)
    return segment_hashes(buf, starts, ends), np.searchsorted(starts, at)


def shingles(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Of each text its distinct shingles of ``size`` words, as sorted hashes; of fewer words one for the whole sequence, of none nothing.

    A-Z are lower-cased and words are runs of other bytes than space and \\x09 to \\x0D.
    """
    h, at = word_hashes([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])
    out = []
    with np.errstate(over="ignore"):
        for lo, hi in zip(at, at[1:], strict=False):
            w = h[lo:hi]
            n = max(1, len(w) - size + 1) if len(w) else 0
            k = min(size, len(w))
            x = np.zeros(n, U)
            for i in range(k):
                x = x * U(0xFF51AFD7ED558CCD) + w[i : i + n]
            out.append(np.unique(mix(x + U(k))))
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repetition."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
