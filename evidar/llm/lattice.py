"""Unigram models over an existing subword vocabulary, and the marginal probability of a word under one.

A word is the mark U+2581 and its characters. Every way to write it in pieces is a path through a
lattice; a character may also be written as the pieces of its UTF-8 bytes. The forward recursion
in log space adds up all paths; with the backward one it gives expected counts of pieces.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

MARK = "▁"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SIEVE_BITS = 20
#: Longer words are taken one by one, with the same result.
LONG = 40
#: Heat of the existing scores (which are ranks, less one, below zero) before any text is seen.
FIRST_HEAT = 4000.0
#: Least heat that is fitted, so that no piece is impossible.
LEAST_HEAT = 1000.0
BLOCK = 20_000


class Vocabulary:
    """Pieces of a sentencepiece model that can stand in words, then one for each byte, then the end.
    scores are the model's own, best first."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        scored = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) or MARK in piece[1:]:
                continue
            scored.append((-model.get_score(i), piece))
        scored.sort()
        self.pieces = [p for _, p in scored]
        scores = -np.array([s for s, _ in scored])
        # a piece outside the ranks has a score far below all; it counts as the last
        self.scores = np.maximum(scores, scores[scores > -1e8].min(initial=0.0) - 1)
        self.place = {p: k for k, p in enumerate(self.pieces)}
        self.bytes_at = len(self.pieces)
        self.end = self.bytes_at + 256
        self.size = self.end + 1
        self.longest = max(map(len, self.pieces))
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.order = hashes[order], order
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self.hashes >> np.uint64(64 - _SIEVE_BITS)] = True

    @staticmethod
    def _hash(piece: str) -> int:
        h = 1
        for c in piece:
            h = (h * int(_STEP) + ord(c)) % (1 << 64)
        return h

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose hash is a piece's, and those pieces."""
        rows = np.flatnonzero(self.sieve[hashes >> np.uint64(64 - _SIEVE_BITS)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[rows]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[rows]
        return rows[hit], self.order[at[hit]]

    def spelling(self, code: int) -> list[int]:
        """The byte pieces of a character."""
        return [self.bytes_at + b for b in chr(code).encode("utf-8", "surrogatepass")]

    def tempered(self, heat: float) -> np.ndarray:
        """Probabilities by the existing scores: proportional to exp(score / heat); a thousandth each for all bytes
        together and for the end, which have no scores."""
        p = np.zeros(self.size)
        weight = np.exp((self.scores - self.scores[0]) / heat)
        p[: self.bytes_at] = 0.998 * weight / weight.sum()
        p[self.bytes_at : self.end] = 0.001 / 256
        p[self.end] = 0.001
        return p

    def fitted_heat(self, expected: np.ndarray) -> float:
        """The heat under which pieces so often expected are most probable, by golden section over its log."""
        n = expected[: self.bytes_at]
        cost = lambda x: -float(n @ np.log(np.maximum(self.tempered(math.exp(x))[: self.bytes_at], 1e-300)))
        low, high, ratio = math.log(LEAST_HEAT), math.log(1e6), (math.sqrt(5) - 1) / 2
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        at_a, at_b = cost(a), cost(b)
        while high - low > 1e-4:
            if at_a <= at_b:
                high, b, at_b = b, a, at_a
                a = high - ratio * (high - low)
                at_a = cost(a)
            else:
                low, a, at_a = a, b, at_b
                b = low + ratio * (high - low)
                at_b = cost(b)
        return math.exp((low + high) / 2)

    def first_guess(self) -> np.ndarray:
        """Log probabilities before any text is seen."""
        return np.log(self.tempered(FIRST_HEAT))


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


class Lattice:
    def __init__(self, vocab: Vocabulary, log_p: np.ndarray):
        self.vocab, self.log_p = vocab, log_p

    def _spelled(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of each character as bytes."""
        letters, inverse = np.unique(codes, return_inverse=True)
        cost = np.array([self.log_p[self.vocab.spelling(c)].sum() for c in letters.tolist()])
        return cost[inverse.ravel()].reshape(codes.shape)

    def _edges(self, codes: np.ndarray):
        """(start, stop, rows, pieces) of all pieces in words of one length; codes: word x character."""
        n, length = codes.shape
        wide = codes.astype(np.uint64)
        for start in range(length):
            h = np.ones(n, np.uint64)
            for stop in range(start + 1, min(length, start + self.vocab.longest) + 1):
                h = h * _STEP + wide[:, stop - 1]
                rows, pieces = self.vocab.find(h)
                if len(rows):
                    yield start, stop, rows, pieces

    def _forward(self, codes: np.ndarray, edges: list, spelled: np.ndarray) -> np.ndarray:
        n, length = codes.shape
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0.0
        by_start: dict[int, list] = {}
        for edge in edges:
            by_start.setdefault(edge[0], []).append(edge)
        for start in range(length):
            np.logaddexp(alpha[start + 1], alpha[start] + spelled[:, start], out=alpha[start + 1])
            for _, stop, rows, pieces in by_start.get(start, ()):
                alpha[stop, rows] = np.logaddexp(alpha[stop, rows], alpha[start, rows] + self.log_p[pieces])
        return alpha

    @staticmethod
    def _by_length(words: list[str]):
        """(places, character codes with the mark before) of words of one length, in blocks; long words alone."""
        groups: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            groups.setdefault(len(word), []).append(i)
        for length, places in groups.items():
            step = BLOCK if length <= LONG else 1
            for at in range(0, len(places), step):
                block = places[at : at + step]
                text = "".join(MARK + words[i] for i in block)
                yield block, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(block), length + 1)

    def word_scores(self, words: list[str]) -> list[float]:
        """Natural log of each word's marginal probability."""
        out = np.zeros(len(words))
        for block, codes in self._by_length(words):
            if codes.shape[1] > LONG + 1:
                out[block] = self._long(words[block[0]])[-1]
            else:
                out[block] = self._forward(codes, list(self._edges(codes)), self._spelled(codes))[-1]
        return out.tolist()

    def _pieces_at(self, text: str, start: int) -> list[tuple[int, int]]:
        """(end, piece) of each piece of the vocabulary that begins at a place of a text."""
        place = self.vocab.place
        stops = range(start + 1, min(len(text), start + self.vocab.longest) + 1)
        return [(stop, piece) for stop in stops if (piece := place.get(text[start:stop])) is not None]

    def _long(self, word: str) -> list[float]:
        """The forward recursion for one word: natural log of the probability of its first 0, 1, ... characters, the mark being one."""
        text = MARK + word
        spelled = {c: float(self._spelled(np.array([ord(c)]))[0]) for c in set(text)}
        alpha = [0.0] + [-math.inf] * len(text)
        for start, c in enumerate(text):
            alpha[start + 1] = _log_add(alpha[start + 1], alpha[start] + spelled[c])
            for stop, piece in self._pieces_at(text, start):
                alpha[stop] = _log_add(alpha[stop], alpha[start] + float(self.log_p[piece]))
        return alpha

    def _count_long(self, word: str, times: float, total: np.ndarray) -> None:
        """Adds the expected pieces of one word, as often as it occurs."""
        text, alpha = MARK + word, self._long(word)
        spelled = {c: float(self._spelled(np.array([ord(c)]))[0]) for c in set(text)}
        letters: dict[str, float] = {}
        beta = [-math.inf] * len(text) + [0.0]
        for start in range(len(text) - 1, -1, -1):
            base = alpha[start] - alpha[-1]
            by_byte = spelled[text[start]] + beta[start + 1]
            letters[text[start]] = letters.get(text[start], 0.0) + math.exp(min(0.0, base + by_byte)) * times
            beta[start] = by_byte
            for stop, piece in self._pieces_at(text, start):
                own = float(self.log_p[piece]) + beta[stop]
                total[piece] += math.exp(min(0.0, base + own)) * times
                beta[start] = _log_add(beta[start], own)
        for c, n in letters.items():
            np.add.at(total, self.vocab.spelling(ord(c)), n)

    def expected_counts(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """Expected pieces over all segmentations of the words, each as often as it occurs."""
        total = np.zeros(self.vocab.size)
        weights = np.asarray(times, float)
        for block, codes in self._by_length(words):
            if codes.shape[1] > LONG + 1:
                self._count_long(words[block[0]], weights[block[0]], total)
                continue
            n, length = codes.shape
            edges, spelled = list(self._edges(codes)), self._spelled(codes)
            alpha = self._forward(codes, edges, spelled)
            beta = np.full((length + 1, n), -np.inf)
            beta[length] = 0.0
            by_start: dict[int, list] = {}
            for edge in edges:
                by_start.setdefault(edge[0], []).append(edge)
            w = weights[block]
            for start in range(length - 1, -1, -1):
                own = beta[start + 1] + spelled[:, start]
                for _, stop, rows, pieces in by_start.get(start, ()):
                    own[rows] = np.logaddexp(own[rows], beta[stop, rows] + self.log_p[pieces])
                beta[start] = own
            whole = alpha[length]
            for start, stop, rows, pieces in edges:
                share = np.exp(alpha[start, rows] + self.log_p[pieces] + beta[stop, rows] - whole[rows]) * w[rows]
                np.add.at(total, pieces, share) if len(rows) < 64 else np.add(total, np.bincount(pieces, share, self.vocab.size), out=total)
            by_byte = np.exp(alpha[:-1].T + spelled + beta[1:].T - whole[:, None]) * w[:, None]
            letters, inverse = np.unique(codes, return_inverse=True)
            share = np.bincount(inverse.ravel(), by_byte.ravel(), len(letters))
            for c, s in zip(letters.tolist(), share):
                np.add.at(total, self.vocab.spelling(c), s)
        return total
