"""SentencePiece encoding and decoding that keeps offsets.

A text is normalised by the longest keys of the model's compiled character map that match, one after
another, and every character of the result is recorded with the byte of the source at which its key
began. Pairs of symbols are merged, best score first and leftmost first among equals, and each piece is
projected through the record to the bytes of the source that it stands for. No piece of a model reaches
over the start of a word if none has a mark inside, so each new word is merged once.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from struct import unpack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import as_rows, table, worker_cache

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Kinds of pieces in a model file, and its model type of merges.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BPE = 2
#: Characters of a text that are normalised and merged at once.
SLICE = 1 << 20
#: Bytes that a worker's words may take; words merged at once; longer words are merged one by one, with the same result.
HELD, WORDS, LONG = 32 << 20, 20_000, 64
_NONE = np.iinfo(np.int64).max


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message in protocol buffer encoding."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, message[at : at + size]
            at += size


class CharacterMap:
    """A compiled map: the keys in a double array, each with the place of its replacement."""

    def __init__(self, blob: bytes = b""):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.replacements = blob[4 + size :]
        self.begins: dict[str, bool] = {}

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, text: str, at: int) -> tuple[int, str] | None:
        """Characters of the longest key that stands at this place, and what replaces it."""
        if not self.units:
            return None
        node = self._children(self.units[0])
        found = None
        for k in range(at, len(text)):
            for byte in text[k].encode("utf-8", "surrogatepass"):
                node ^= byte
                if node >= len(self.units) or self.units[node] & 0x800000FF != byte:
                    return found
                leaf = self.units[node] >> 8 & 1
                node ^= self._children(self.units[node])
            if leaf:
                value = self.units[node] & 0x7FFFFFFF
                found = k + 1 - at, self.replacements[value : self.replacements.index(0, value)].decode()
        return found

    def touches(self, text: str) -> bool:
        """Whether a character of the text could begin a key."""
        if not self.units:
            return False
        return any(self._begins(c) for c in set(text))

    def _begins(self, c: str) -> bool:
        if c not in self.begins:
            node, ok = self._children(self.units[0]), True
            for byte in c.encode("utf-8", "surrogatepass"):
                node ^= byte
                ok = node < len(self.units) and self.units[node] & 0x800000FF == byte
                if not ok:
                    break
                node ^= self._children(self.units[node])
            self.begins[c] = ok
        return self.begins[c]


class Normaliser:
    """What a model does to a text before it is cut in pieces."""

    def __init__(self, spec: bytes = b""):
        given = dict(_fields(spec))
        self.map = CharacterMap(given.get(2, b""))
        self.dummy, self.trims, self.escapes = (bool(given.get(k, 1)) for k in (3, 4, 5))

    def __call__(self, text: str, head: bool = True) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters, and its end, the byte of text at which the key
        that made it begins. head: whether a text begins here, not a later slice of one."""
        if not text:
            return "", np.zeros(1, np.int64)
        if self.trims or self.map.touches(text):
            return self._by_keys(text, head)
        lead = int(head and self.dummy)
        begins = np.zeros(lead + len(text) + 1, np.int64)
        if text.isascii():
            begins[lead:] = np.arange(len(text) + 1)
        else:
            code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            np.cumsum(1 + (code >= 0x80) + (code >= 0x800).astype(np.int64) + (code >= 0x10000), out=begins[lead + 1 :])
        space = MARK if self.escapes else " "
        return space * lead + text.replace(" ", space), begins

    def _by_keys(self, text: str, head: bool) -> tuple[str, np.ndarray]:
        out: list[str] = []
        begins = array("q")
        space = MARK if self.escapes else " "
        at = consumed = 0

        def key() -> tuple[int, str]:
            return self.map.longest(text, at) or (1, text[at])

        def width(n: int) -> int:
            return len(text[at : at + n].encode("utf-8", "surrogatepass"))

        while self.trims and at < len(text):
            n, made = key()
            if made != " ":
                break
            consumed += width(n)
            at += n
        if at == len(text):
            return "", np.zeros(1, np.int64)
        if head and self.dummy:
            out.append(space)
            begins.append(consumed)
        after_space = self.trims
        while at < len(text):
            n, made = key()
            if after_space:
                made = made.lstrip(" ")
            if made:
                out.append(made.replace(" ", space))
                begins.extend([consumed] * len(made))
                after_space = made.endswith(" ")
            consumed += width(n)
            at += n
            after_space &= self.trims
        done = "".join(out)
        kept = len(done.rstrip(space)) if self.trims else len(done)
        begins.append(consumed)
        return done[:kept], np.frombuffer(begins, np.int64)[: kept + 1].copy()


class Pieces:
    """Pieces, scores and normaliser of a model of merges whose unknown characters are written in bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            fields = list(_fields(f.read()))
        trainer, spec = (b"".join(v for k, v in fields if k == n) for n in (2, 3))
        trainer = dict(_fields(trainer))
        if trainer.get(3) != _BPE or not trainer.get(35) or trainer.get(24):
            raise ValueError("a model of merges with bytes for unknown characters and marks before words is needed")
        self.normalise = Normaliser(spec)
        self.ids: dict[str, int] = {}
        self.byte_ids, self.kinds, self.surfaces, scores = [0] * 256, [], [], {}
        unknown = trainer.get(44, " ⁇ ".encode())
        for i, (piece, score, kind) in enumerate(self._read(v) for k, v in fields if k == 1):
            self.kinds.append(kind)
            if kind == _NORMAL:
                self.ids[piece], scores[piece] = i, score
                self.surfaces.append(piece.replace(MARK, " ").encode())
            elif kind == _BYTE:
                self.byte_ids[int(piece[3:5], 16)] = i
                self.surfaces.append(bytes([int(piece[3:5], 16)]))
            elif kind in (_UNKNOWN, _CONTROL):
                self.surfaces.append(unknown if kind == _UNKNOWN else b"")
            else:
                raise ValueError(f"piece {piece!r} is of a kind that is not known")
        self.end = trainer.get(42, 2)
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {p: order[s] for p, s in scores.items()}
        self.longest = max(map(len, self.ranks), default=1)
        self.decimals = [b"%d" % i for i in range(len(self.kinds))]
        self.control = np.array(self.kinds) == _CONTROL
        # words can be told apart if no piece has a mark after another character; a line's end stands alone if it is in no piece
        self._pairs()
        self.apart = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        alone = "\n" if not any("\n" in p for p in self.ids) else ""
        self.words = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + "|\n" * bool(alone))

    def _pairs(self) -> None:
        """Symbols are numbered: pieces by their ids, then characters of pieces that are none, then all others. Each way to write a
        piece as two symbols is a pair."""
        number = dict(self.ids)
        for c in sorted(set("".join(self.ids))):
            number.setdefault(c, len(self.kinds) + len(number))
        self.symbol = np.full(0x110000, len(self.kinds) + len(number), np.int32)
        for piece, k in number.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = k
        self.symbols = len(self.kinds) + len(number) + 1
        found = [(number[p[:k]] * self.symbols + number[p[k:]], r, self.ids[p]) for p, r in self.ranks.items() for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        table = np.array(sorted(found), np.int64).reshape(-1, 3)
        self.pair, self.pair_rank, self.pair_makes = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].astype(np.int32)

    @staticmethod
    def _read(message: bytes) -> tuple[str, float, int]:
        piece = dict(_fields(message))
        return piece[1].decode(), unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, _NORMAL)

    def spelled(self, ids: np.ndarray) -> bytes:
        return b"".join([b"".join(map(self.surfaces.__getitem__, ids[at : at + 65536].tolist())) for at in range(0, len(ids), 65536)])

    def split(self, normal: str) -> list[str]:
        """Parts that no piece reaches out of."""
        return self.words.findall(normal) if self.apart else [normal] * bool(normal)

    def merge(self, word: str) -> tuple[list[int], list[int]]:
        """The ids of a normalised word's pieces and the character at which each ends; of a character that is written in
        bytes the last byte has it, the others end where it begins. A pair waits under its rank and place; it counts if it
        still stands there when its turn comes."""
        n, ranks, longest = len(word), self.ranks, self.longest
        ends, before = array("l", range(1, n + 1)), array("l", range(-1, n - 1))  # the end of the symbol that begins here, 0 if none; the one before it
        queue: list[int] = []

        def rank(left: int) -> int:
            right = ends[left]
            if right >= n or ends[right] - left > longest:
                return -1
            return ranks.get(word[left : ends[right]], -1)

        for left in range(n - 1):
            if (r := rank(left)) >= 0:
                queue.append(r << 32 | left)
        heapq.heapify(queue)
        while queue:
            top = heapq.heappop(queue)
            left = top & 0xFFFFFFFF
            if not ends[left] or rank(left) != top >> 32:
                continue
            right = ends[left]
            ends[left], ends[right] = ends[right], 0
            if ends[left] < n:
                before[ends[left]] = left
            for at in (before[left], left) if left else (left,):
                if (r := rank(at)) >= 0:
                    heapq.heappush(queue, r << 32 | at)
        ids, places, at = [], [], 0
        while at < n:
            to = ends[at]
            known = self.ids.get(word[at:to])
            if known is not None:
                ids.append(known)
                places.append(to)
            else:
                spelled = [self.byte_ids[b] for b in word[at:to].encode("utf-8", "surrogatepass")]
                ids += spelled
                places += [at] * (len(spelled) - 1) + [to]
            at = to
        return ids, places


    def _best(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in the table, as rank times the table's size plus place; _NONE where there is none."""
        if not len(self.pair):
            return np.full(len(left), _NONE)
        key = left.astype(np.int64) * self.symbols + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at] * len(self.pair) + at, _NONE)

    def merge_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As merge, of many words at once: all ids, all ends, and how many each word has. In each round every word
        merges its first pair of the best rank; words without a pair are done."""
        chars = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        symbol, owner = self.symbol[code], np.repeat(np.arange(len(words)), chars)
        first = np.cumsum(chars) - chars
        ends = np.arange(1, len(code) + 1) - first[owner]
        size = max(len(self.pair), 1)
        best = np.full(len(code), _NONE)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        best[inside] = self._best(symbol[inside], symbol[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            rank = np.where(best == _NONE, _NONE, best // size)
            least = np.minimum.reduceat(rank, starts)
            live = np.repeat(least != _NONE, sizes)
            if not live.all():
                done.append((owner[~live], symbol[~live], ends[~live]))
                owner, symbol, ends, best, rank = (x[live] for x in (owner, symbol, ends, best, rank))
                if not len(symbol):
                    break
                least, sizes = least[least != _NONE], sizes[least != _NONE]
                starts = np.cumsum(sizes) - sizes
            hits = np.flatnonzero(rank == np.repeat(least, sizes))
            hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]  # the leftmost of each word
            symbol[hits], ends[hits] = self.pair_makes[best[hits] % size], ends[hits + 1]
            keep = np.full(len(symbol), True)
            keep[hits + 1] = False
            at = hits - np.arange(len(hits))  # where they are once what they have taken is gone
            owner, symbol, ends, best = owner[keep], symbol[keep], ends[keep], best[keep]
            best[at] = _NONE
            right = at[at + 1 < len(owner)]
            right = right[owner[right + 1] == owner[right]]
            best[right] = self._best(symbol[right], symbol[right + 1])
            left = at[at > 0] - 1
            left = left[owner[left] == owner[left + 1]]
            best[left] = self._best(symbol[left], symbol[left + 1])
        owner, symbol, ends = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 3
        order = np.argsort(owner, kind="stable")
        owner, symbol, ends = owner[order], symbol[order], ends[order]
        unknown = np.flatnonzero(symbol >= len(self.kinds))
        if len(unknown):
            owner, symbol, ends = self._in_bytes(owner, symbol, ends, unknown, code[first[owner[unknown]] + ends[unknown] - 1])
        return symbol.astype(np.int32), ends.astype(np.int32), np.bincount(owner, minlength=len(words))

    def _in_bytes(self, owner: np.ndarray, symbol: np.ndarray, ends: np.ndarray, unknown: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, ...]:
        """With the characters that are no pieces written in bytes."""
        codes, which = np.unique(code, return_inverse=True)
        spelled = [[self.byte_ids[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in codes.tolist()]
        lengths = np.array([len(x) for x in spelled])
        n = np.ones(len(symbol), np.int64)
        n[unknown] = lengths[which]
        place = np.repeat(np.arange(len(symbol)), n)
        nth = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
        table = np.zeros((len(codes), 4), np.int64)
        for k, x in enumerate(spelled):
            table[k, : len(x)] = x
        kind = np.zeros(len(symbol), np.int64)
        kind[unknown] = which
        is_byte = np.repeat(np.isin(np.arange(len(symbol)), unknown), n)
        ids = np.where(is_byte, table[kind[place], np.minimum(nth, 3)], symbol[place])
        return owner[place], ids, ends[place] - (is_byte & (nth < n[place] - 1))


class Encoder:
    """Words and what they are merged to, in flat arrays; it begins anew when they take more than HELD bytes."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._anew()

    def _anew(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids, self.ends, self.starts, self.chars, self.held = array("i"), array("i"), array("q", [0]), array("q"), 0

    def _learn(self, words: set[str]) -> None:
        if self.held > HELD:
            self._anew()
        new = [w for w in words if w not in self.slots]
        short = [w for w in new if len(w) <= LONG]
        for at in range(0, len(short), WORDS):
            some = short[at : at + WORDS]
            self._put(some, *self.pieces.merge_all(some))
        for word in new:
            if len(word) > LONG:
                ids, ends = self.pieces.merge(word)
                self._put([word], np.array(ids, np.int32), np.array(ends, np.int32), np.array([len(ids)]))

    def _put(self, words: list[str], ids: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> None:
        self.slots.update(zip(words, range(len(self.chars), len(self.chars) + len(words))))
        self.starts.frombytes((len(self.ids) + np.cumsum(sizes)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.tobytes())
        self.ends.frombytes(ends.tobytes())
        self.chars.extend(map(len, words))
        self.held += 120 * len(words) + 2 * sum(map(len, words)) + 8 * len(ids)

    def _group(self, parts: list[tuple[str, bool]]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """For each part (of a text; whether it is the text's head): ids, the byte of the part at which each piece ends, and
        that at which the first begins."""
        normal = [self.pieces.normalise(*part) for part in parts]
        words = [self.pieces.split(text) for text, _ in normal]
        self._learn(set().union(*words))
        all_ids, all_ends = np.frombuffer(self.ids, np.int32), np.frombuffer(self.ends, np.int32)
        starts, chars = np.frombuffer(self.starts, np.int64), np.frombuffer(self.chars, np.int64)
        for (_, begins), some in zip(normal, words):
            if not some:
                yield np.zeros(0, np.int32), np.zeros(0, np.int64), int(begins[0])
                continue
            slot = np.fromiter(map(self.slots.__getitem__, some), np.int64, len(some))
            first, width = starts[slot], chars[slot]
            sizes = starts[slot + 1] - first
            at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
            yield all_ids[at], begins[all_ends[at] + np.repeat(np.cumsum(width) - width, sizes)], int(begins[0])

    def encode(self, texts: list[str], end: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """As _group, of whole texts, with the end's id if asked for. Where the map and trimming leave characters as they are a
        long text goes slice by slice, each from the start of a word on; short texts go together."""
        whole = self.pieces.normalise.trims or self.pieces.normalise.map.units or not self.pieces.apart
        group: list[tuple[str, bool]] = []
        held: list[tuple[np.ndarray, np.ndarray, int, int]] = []  # of the text that is not over yet
        size = 0

        def flush() -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
            for (part, head), found in zip(group, self._group(group)):
                if head and held:
                    yield self._joined(held, end)
                    held.clear()
                held.append((*found, len(part) if part.isascii() else len(part.encode("utf-8", "surrogatepass"))))
            group.clear()

        for text in texts:
            for k, part in enumerate([text] if whole else self._cut(text)):
                group.append((part, k == 0))
                size += len(part)
                if size >= SLICE:
                    yield from flush()
                    size = 0
        if group:
            yield from flush()
        if held:
            yield self._joined(held, end)

    def _joined(self, parts: list[tuple[np.ndarray, np.ndarray, int, int]], end: bool) -> tuple[np.ndarray, np.ndarray, int]:
        ids, ends, base = [], [], 0
        for some, places, _, size in parts:
            ids.append(some)
            ends.append(places + base)
            base += size
        if end:
            ids.append(np.array([self.pieces.end], np.int32))
            ends.append(np.array([base], np.int64))
        return np.concatenate(ids), np.concatenate(ends), parts[0][2]

    @staticmethod
    def _cut(text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > SLICE:
            cut = _WORD_START.search(text, at + SLICE)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text


_WORD_START = re.compile(f"(?<=[^ {MARK}])[ {MARK}]")


def _one_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("evidar-one-byte", _one_byte)


def decoded(pieces: Pieces, ids: np.ndarray) -> str:
    """The text of these ids: marks are spaces, but for the one that normalising put first; control ids are nothing; bytes that
    are no UTF-8 are U+FFFD each."""
    breaks = np.r_[-1, np.flatnonzero(pieces.control[ids]), len(ids)].tolist()  # bytes do not join across a control id
    text = "".join(pieces.spelled(ids[a + 1 : b]).decode("utf-8", "evidar-one-byte") for a, b in zip(breaks, breaks[1:]) if a + 1 < b)
    if pieces.normalise.dummy or pieces.normalise.trims:
        for i in map(int, ids):
            surface = pieces.surfaces[i]
            if pieces.kinds[i] == _NORMAL and surface.startswith(b" "):
                text = text[1:]
                if pieces.normalise.trims and len(surface) == 1:
                    continue  # nothing has come out yet
                break
            if surface:
                break
    return text


@lru_cache(maxsize=1)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def _model_path(path: str | None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path(MODEL)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: bool = True) -> DataFrame:
    """id, ids, starts and ends of each row of docs: the ids of its pieces, and the bytes of the source (UTF-8) that each
    stands for. The mark before a text stands for none of them; of a character written in bytes the last byte has it.

    Null text counts as empty and has the end's id only, at byte 0. Rows repeat as they are in docs, ids may be null.
    A very long text is merged in slices from word to word, with the same result. An empty table gives no rows.
    Other columns, whatever their names, play no part.
    """
    model = _model_path(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"pieces {model}", lambda: Encoder(pieces_of(model)))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, starts, ends, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [0]
                for found, places, first in encoder.encode([text.as_py() or "" for text in part.column(1)], end):
                    ids.append(found)
                    ends.append(places.astype(np.int32))
                    starts.append(np.concatenate([np.array([first], np.int32), ends[-1][:-1]])[: len(found)])
                    sizes.append(len(found))
                offsets = pa.array(np.cumsum(sizes), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (ids, starts, ends)]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], ["id", "ids", "starts", "ends"])

    kind = docs.schema[id_col].dataType.simpleString()
    given = as_rows(docs, id_col, text_col).toDF("id", "text")
    return given.mapInArrow(run, f"id {kind}, ids array<int>, starts array<int>, ends array<int>")


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of an array of ids; null for null."""
    model = _model_path(path)

    def run(batch: pa.Array) -> pa.Array:
        pieces = pieces_of(model)
        return pa.array([decoded(pieces, x.values.to_numpy(zero_copy_only=False)) if x.is_valid else None for x in batch], pa.string())

    return F.arrow_udf(run, "string")(ids)


def ids_digest(ids: Column, path: str | None = None) -> Column:
    """SHA-256 of the decimal ids joined by one space each, in lowercase hex."""
    model = _model_path(path)

    def run(batch: pa.Array) -> pa.Array:
        decimals, out = pieces_of(model).decimals, []
        for row in batch:
            values, digest = row.values.to_numpy(zero_copy_only=False), hashlib.sha256()
            for at in range(0, len(values), 65536):
                digest.update(b" " * bool(at) + b" ".join(map(decimals.__getitem__, values[at : at + 65536].tolist())))
            out.append(digest.hexdigest())
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(ids)


def pieces_of_texts(encoded: DataFrame) -> DataFrame:
    """encode()'s rows as one row a piece: id, place, piece_id, start, end."""
    spans = F.posexplode(F.arrays_zip("ids", "starts", "ends")).alias("place", "span")
    return encoded.select("id", spans).select("id", "place", F.col("span.ids").alias("piece_id"), F.col("span.starts").alias("start"), F.col("span.ends").alias("end"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents"))
    return encoded.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2(decode(F.col("ids")).cast("binary"), 256).alias("decoded_sha256"))
