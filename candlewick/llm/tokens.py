"""Token ids of many texts, by the ``tokenizers`` library.

The tokenizers used here treat what stands between white space apart from all else. So a
text is cut at spaces and line feeds, each distinct chunk is encoded by the library
once, and the ids are put together: the same ids as for the whole text, for less work.
``Encoder`` refuses a tokenizer for which that doesn't hold. A word with punctuation after
it is put together from its two parts in the same way.
"""

from __future__ import annotations

import os
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that a process keeps before it drops those that came once, about 170 MB.
KEPT = 700_000
#: Characters put together at a time; a longer text is a part of its own.
PART = 8_000_000
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each process and file, with its chunks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class _Numbers(dict):
    """Chunk to number; an unknown chunk gets the next number and is noted in ``new``."""

    def __init__(self, *a):
        super().__init__(*a)
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = i = len(self)
        self.new.append(chunk)
        return i


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab().values()) < 1 << 16 else "<u4")
        probe = "An ordinary  text,\n\nwith é and 12 o'clock .\n ok... x%% "
        parts = probe.replace("\n", " ").replace(",", " ,").replace("...", " ...").replace("%%", " %%").split(" ")
        if self.tokenizer.encode(probe, add_special_tokens=False).ids != [i for c in parts for i in self.tokenizer.encode(c, add_special_tokens=False).ids]:
            raise ValueError("this tokenizer has ids that depend on white space; only those that drop it are supported")
        # where case doesn't matter to the ids, ASCII texts are lower-cased first, so that fewer chunks differ
        cased = string.ascii_uppercase + " An ORDINARY Text With THE Names Of Paris"
        self.caseless = self.tokenizer.encode(cased, add_special_tokens=False).ids == self.tokenizer.encode(cased.lower(), add_special_tokens=False).ids
        self.at = _Numbers({" ": 0})
        self.ids = np.zeros(1 << 18, np.uint32)
        self.begin, self.length, self.seen = (np.zeros(KEPT, np.int32) for _ in range(3))
        self.used = 0

    def forget(self) -> None:
        """Starts anew with the chunks that came more than once, or with none if those are most."""
        old = [(c, i) for c, i in self.at.items() if self.seen[i] > 1 and i]
        if len(old) > KEPT // 2:
            old = []
        at = np.array([0] + [i for _, i in old], np.int64)
        n = self.length[at]
        end = np.cumsum(n)
        ids = self.ids[np.repeat(self.begin[at] - end + n, n) + np.arange(end[-1])]
        self.at = _Numbers({" ": 0} | {c: k + 1 for k, (c, _) in enumerate(old)})
        self.used = len(ids)
        self.ids[: self.used] = ids
        self.begin[: len(n)], self.length[: len(n)] = end - n, n
        self.seen[:] = 0

    def _room(self, chunks: int, ids: int) -> None:
        while self.used + ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while chunks > len(self.length):
            self.begin, self.length, self.seen = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.length, self.seen))

    def learn(self) -> None:
        """Ids for the chunks noted as new. A chunk ends with its space."""
        at = self.at
        base = len(at) - len(at.new)  # new chunks have consecutive numbers
        new = pa.array(at.new, pa.string())
        word = pc.ascii_rtrim(new, characters=string.punctuation + " ")
        tail = pc.subtract(pc.subtract(pc.binary_length(new), pc.binary_length(word)), 1)  # without the space
        joined = pc.and_(pc.greater(tail, 0), pc.utf8_is_alpha(word)).to_numpy(zero_copy_only=False).copy()
        joint = []
        for i, w in zip(np.flatnonzero(joined).tolist(), word.filter(pa.array(joined)).to_pylist(), strict=True):
            if w.isascii() or w.lower().isalpha():  # some letters lower-case to a letter and a mark
                joint.append((base + i, at[w + " "], at[at.new[i][len(w) :]]))  # may note more
            else:
                joined[i] = False
        numbers = base + np.concatenate([np.flatnonzero(~joined), np.arange(len(joined), len(at.new))])
        whole = [at.new[i - base] for i in numbers.tolist()]
        at.new = []
        self._room(len(at), 0)
        for lo in range(0, len(whole), 256):  # a token belongs to the chunk in which it begins
            part, no = whole[lo : lo + 256], numbers[lo : lo + 256]
            e = self.tokenizer.encode("".join(part), add_special_tokens=False)
            size = np.fromiter(map(len, part), np.int64, len(part))
            first = np.cumsum(size) - size
            own = np.searchsorted(first, np.array(e.offsets, np.int64).reshape(-1, 2)[:, 0], "right") - 1
            count = np.bincount(own, minlength=len(part))
            self._room(0, len(own))
            self.begin[no], self.length[no] = self.used + np.cumsum(count) - count, count
            self.ids[self.used : self.used + len(own)] = e.ids
            self.used += len(own)
        if joint:
            c, a, b = np.array(joint, np.int64).T
            self._room(len(at), 0)
            both = np.stack([a, b], 1).ravel()
            m = self.length[both]
            end = np.cumsum(m)
            total = int(end[-1])
            self._room(len(at), total)
            self.ids[self.used : self.used + total] = self.ids[np.repeat(self.begin[both] - end + m, m) + np.arange(total)]
            self.length[c] = m[::2] + m[1::2]
            self.begin[c] = self.used + end[1::2] - self.length[c]
            self.used += total

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (one more for the end). A null is empty."""
        # in ASCII the library's lower-casing is Python's; a special token keeps its case
        texts = [t.lower() if self.caseless and t.isascii() and "<|" not in t else t for t in (t or "" for t in texts)]
        ids, sizes, lo = [], [], 0
        while lo < len(texts):
            hi, chars = lo, 0
            while hi < len(texts) and (hi == lo or chars + len(texts[hi]) <= PART):
                chars += len(texts[hi])
                hi += 1
            part = texts[lo:hi]
            buf = (" ".join(part).replace("\n", " ") + " ").encode("utf-8", "surrogatepass")
            ends = np.concatenate([[0], np.flatnonzero(np.frombuffer(buf, np.uint8) == 32) + 1])
            chunks = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(buf)]).dictionary_encode()
            if len(self.at) > KEPT * 9 // 10:
                self.forget()
            once = chunks.dictionary.to_pylist()
            at = np.fromiter(map(self.at.__getitem__, once), np.int64, len(once))
            idx = chunks.indices.to_numpy()
            if self.at.new:
                self.learn()
            self._room(len(self.at), 0)
            self.seen[at] += np.bincount(idx, minlength=len(at)).astype(np.int32)
            at = at[idx]
            n = self.length[at]
            end = np.cumsum(n, dtype=np.int32)
            where = np.repeat(self.begin[at] - end + n, n)
            where += np.arange(end[-1], dtype=np.int32)
            ids.append(self.ids[where])
            # one chunk more than the spaces and line feeds of a text
            last = np.cumsum([t.count(" ") + t.count("\n") + 1 for t in part])
            sizes.append(np.diff(end[last - 1].astype(np.int64), prepend=0))
            lo = hi
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))] if sizes else [[0]]).astype(np.int64)
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32)), offsets

    def documents(self, texts: list[str | None], end_id: int) -> list[np.ndarray]:
        """Each text's ids with ``end_id`` after them."""
        flat, at = self.encode(texts)
        last = np.array([end_id], np.uint32)
        return [np.concatenate([flat[a:b], last]) for a, b in zip(at, at[1:], strict=False)]
