"""Token ids of whole texts, fast: texts are cut where no token can cross, and each distinct piece is encoded once.

A cut goes before a space, tab or line end that follows a character which is no white space; no pattern of the byte-level
pre-tokenizer goes on over such a place. A text with any other white space goes to the tokenizer as a whole. The pieces of
many texts are found, told apart by a 64-bit hash and compared with their like byte by byte in numpy; only distinct ones
meet Python.
"""

import re
from array import array
from functools import lru_cache

import numpy as np

OTHER = re.compile(r"[^\S \n\t\r]")
VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces and ids that a task keeps at most; beyond that the memory starts anew.
KEEP_PIECES, KEEP_IDS = 400_000, 4_000_000
#: Characters that are worked on at once (one text alone may be longer).
CHARS = 1_500_000

_SPACE = np.isin(np.arange(256), [9, 10, 13, 32])
#: Printable bytes stand for themselves, the others for characters from 256 on: the alphabet of byte-level vocabularies.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_FACTOR = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse, modulo 2 ** 64."""
    both = (_FACTOR, pow(_FACTOR, -1, 2**64))
    return tuple(np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, f, np.uint64)]) for f in both)


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... for each i, size[i] numbers long."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True     # their strings in a text are ordinary text
        self.model, self.pattern = self.tokenizer.model, regex.compile(PATTERN)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.words: dict[str, list[int]] = {}
        self.starts, self.sizes, self.flat = array("q"), array("q"), array("I")

    def _word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            ids = self.words[word] = [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(_ALPHABET))]
        return ids

    def _learn(self, piece: bytes) -> int:
        self.place[piece] = at = len(self.starts)
        self.starts.append(len(self.flat))
        for word in self.pattern.findall(piece.decode()):
            self.flat.extend(self._word(word))
        self.sizes.append(len(self.flat) - self.starts[-1])
        return at

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit numbers; null is empty."""
        out: list[np.ndarray] = []
        at, chars = 0, 0
        for i, t in enumerate(texts):
            chars += len(t or "")
            if chars > CHARS or i == len(texts) - 1:
                out += self._encode(texts[at:i + 1])
                at, chars = i + 1, 0
        return out

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.place) > KEEP_PIECES or len(self.flat) > KEEP_IDS:
            self._forget()
        odd = {i: np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4") for i, t in enumerate(texts) if t and OTHER.search(t)}
        raw = [b"" if t is None or i in odd else t.encode() for i, t in enumerate(texts)]
        data, firsts = b"".join(raw), np.cumsum([0, *map(len, raw)])
        if not data:
            return [odd.get(i, np.zeros(0, "<u4")) for i in range(len(texts))]
        chars = np.frombuffer(data, np.uint8)
        space = _SPACE[chars]
        cut = space & ~np.r_[False, space[:-1]]
        cut[firsts[:-1][np.diff(firsts) > 0]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(np.r_[starts, len(chars)])
        up, down = _powers(1 << (len(chars) - 1).bit_length() if len(chars) > 1 else 1)
        sums = np.r_[np.uint64(0), np.cumsum(_VALUES[chars] * up[:len(chars)])]
        _, first, like = np.unique((sums[starts + sizes] - sums[starts]) * down[starts], return_index=True, return_inverse=True)
        same = sizes[first][like] == sizes
        if not (same.all() and (chars[_runs(starts[first][like], sizes)] == chars).all()):      # hashes met: take every piece by itself
            first, like = np.arange(len(starts)), np.arange(len(starts))
        distinct = [data[s:s + n] for s, n in zip(starts[first].tolist(), sizes[first].tolist(), strict=True)]
        known = self.place.get
        at = np.array([self._learn(p) if (k := known(p)) is None else k for p in distinct], np.int64)[like]
        own, n, ids = (np.array(x) for x in (self.starts, self.sizes, self.flat))
        counts = n[at]
        flat = ids[_runs(own[at], counts)].astype("<u4")
        ends = np.r_[0, np.cumsum(counts)][np.searchsorted(starts, firsts)]
        return [odd.get(i, flat[ends[i]:ends[i + 1]]) for i in range(len(texts))]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)
