"""Marginal word probabilities over all segmentations into subword pieces.

Plain numpy, run inside tasks. A word is spelt with a leading word mark; an edge of
its lattice is a vocabulary piece, or the UTF-8 bytes of one character. The forward
recursion runs in log space over all words of one length at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

MARK = "▁"
_K = np.uint64(0x9E3779B97F4A7C15)
_CELLS = 1 << 17


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as sorted prefix hashes; ``piece`` is -1 where a prefix is no piece.
    Ids: pieces, then 256 bytes, then the end of a text."""

    prefixes: np.ndarray
    piece: np.ndarray
    size: int
    longest: int

    @property
    def first_byte(self) -> int:
        return self.size

    @property
    def end(self) -> int:
        return self.size + 256


def _codes(words: list[str]) -> np.ndarray:
    n = len(words[0])
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, n).astype(np.uint64)


def _step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    h = (h ^ (c + np.uint64(1))) * _K
    return h ^ (h >> np.uint64(29))


def vocabulary(pieces: list[str]) -> Vocabulary:
    seen: dict[int, int] = {}
    for i, p in enumerate(pieces):
        h = np.zeros(1, np.uint64)
        codes = _codes([p])
        for j in range(len(p)):
            h = _step(h, codes[:, j])
            whole = i if j == len(p) - 1 else -1
            key = int(h[0])
            seen[key] = max(seen.get(key, -1), whole)
    keys = np.array(sorted(seen), np.uint64)
    return Vocabulary(keys, np.array([seen[int(k)] for k in keys], np.int32), len(pieces),
                      max(map(len, pieces), default=0))


class Lattice:
    def __init__(self, vocab: Vocabulary, log_p: np.ndarray):
        self.vocab, self.log_p = vocab, log_p
        self._bytes: dict[int, float] = {}

    def _spelt(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of each character as its bytes."""
        kinds, at = np.unique(codes, return_inverse=True)
        for c in kinds.tolist():
            if c not in self._bytes:
                raw = chr(c).encode("utf-8", "surrogatepass")
                self._bytes[c] = sum(self.log_p[self.vocab.first_byte + b] for b in raw)
        return np.array([self._bytes[c] for c in kinds.tolist()])[at].reshape(codes.shape)

    def _edges(self, codes: np.ndarray) -> list[np.ndarray]:
        """Piece ids by length - 1: (words, start), -1 where there is none."""
        n, v = codes.shape[1], self.vocab
        word, start = (x.ravel() for x in np.indices(codes.shape))
        h = np.zeros(codes.size, np.uint64)
        out = []
        for size in range(1, min(n, v.longest) + 1):
            fits = start + size <= n
            word, start, h = word[fits], start[fits], h[fits]
            h = _step(h, codes[word, start + size - 1])
            at = np.searchsorted(v.prefixes, h)
            at[at == len(v.prefixes)] = 0
            alive = v.prefixes[at] == h
            word, start, h, at = word[alive], start[alive], h[alive], at[alive]
            ids = np.full(codes.shape, -1, np.int32)
            ids[word, start] = v.piece[at]
            out.append(ids)
            if not len(word):
                break
        return out

    def _groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(indexes, codes) of words of one length, in bounded groups."""
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        order = np.argsort(size, kind="stable")
        lo = 0
        while lo < len(order):
            n = int(size[order[lo]])
            hi = int(np.searchsorted(size[order], n, side="right"))
            hi = min(hi, lo + max(1, _CELLS // n))
            yield order[lo:hi], _codes([MARK + words[i] for i in order[lo:hi]])
            lo = hi

    def _forward(self, codes: np.ndarray):
        edges, spelt = self._edges(codes), self._spelt(codes)
        weight = [np.where(e >= 0, self.log_p[e], -np.inf) for e in edges]
        n = codes.shape[1]
        alpha = np.full((len(codes), n + 1), -np.inf)
        alpha[:, 0] = 0
        for j in range(1, n + 1):
            terms = [alpha[:, j - 1] + spelt[:, j - 1]]
            terms += [alpha[:, j - s - 1] + w[:, j - s - 1] for s, w in enumerate(weight) if s < j]
            alpha[:, j] = _logsum(np.stack(terms))
        return edges, weight, spelt, alpha

    def log_prob(self, words: list[str]) -> np.ndarray:
        """Natural log of each word's probability, all segmentations summed."""
        out = np.empty(len(words))
        for at, codes in self._groups(words):
            out[at] = self._forward(codes)[3][:, -1]
        return out

    def expected(self, words: list[str], count: np.ndarray) -> np.ndarray:
        """Expected uses of every id in ``count[i]`` draws of each word."""
        v = self.vocab
        out = np.zeros(v.end + 1)
        for at, codes in self._groups(words):
            edges, weight, spelt, alpha = self._forward(codes)
            n = codes.shape[1]
            beta = np.full((len(codes), n + 1), -np.inf)
            beta[:, n] = 0
            for i in range(n - 1, -1, -1):
                terms = [beta[:, i + 1] + spelt[:, i]]
                terms += [beta[:, i + s + 1] + w[:, i] for s, w in enumerate(weight) if i + s < n]
                beta[:, i] = _logsum(np.stack(terms))
            c = count[at][:, None]
            total = alpha[:, n:]
            for s, (ids, w) in enumerate(zip(edges, weight)):
                k = n - s
                use = np.exp(alpha[:, :k] + w[:, :k] + beta[:, s + 1:] - total) * c
                there = ids[:, :k] >= 0
                out += np.bincount(ids[:, :k][there], use[there], len(out))
            by_char = np.exp(alpha[:, :n] + spelt + beta[:, 1:] - total) * c
            kinds, which = np.unique(codes, return_inverse=True)
            for k, x in zip(kinds.tolist(), np.bincount(which.ravel(), by_char.ravel())):
                for b in chr(k).encode("utf-8", "surrogatepass"):
                    out[v.first_byte + b] += x
        return out


def _logsum(terms: np.ndarray) -> np.ndarray:
    top = terms.max(0)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(terms - top).sum(0)) + top
