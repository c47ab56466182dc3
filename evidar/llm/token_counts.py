"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch lie in one ragged array of symbol ids. In each round every sequence
looks up the ranks of its adjacent pairs and applies its lowest-rank pair, wherever it occurs
and all sequences at once; sequences without a mergeable pair drop out. What survives is counted.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import table, worker_cache
from evidar.llm.words import WordCache, grouped

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
#: Bytes above which a sequence is merged by itself, with the same result: rounds over a batch would last as long as its longest.
LONG = 512
_NO_RANK = np.iinfo(np.int32).max


class MergeTable:
    """Byte symbols and ranked merges of a BPE vocabulary with word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.size = max(vocab.values()) + 1
        letters = byte_letters()
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + self.end] for b in range(256)], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        self.normaliser = Tokenizer.from_file(path).normalizer
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern)
        self.split_ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)

    def pre_tokens(self, part: str) -> list[str]:
        """Of a part of a word in which no special string stands."""
        if part.isascii():
            low = part.lower()
            return [low] if low.isalpha() else self.split_ascii.findall(low)
        # the library lowers each character by itself, so a final sigma stays as it is there
        low = part.lower() if is_normalized("NFC", part) and "\u03a3" not in part else self.normaliser.normalize_str(part)
        return [low] if low.isalpha() else self.split.findall(low)

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and place in the table of each pair; _NO_RANK where there is no merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NO_RANK), at

    def merge(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols that survive of each sequence (none is empty)."""
        long = [i for i, s in enumerate(sequences) if len(s) > LONG]
        if long:
            out = np.zeros(len(sequences), np.int64)
            out[long] = [self.merge_long(sequences[i]) for i in long]
            short = np.array([i for i, s in enumerate(sequences) if len(s) <= LONG], np.int64)
            if len(short):
                out[short] = self.merge([sequences[i] for i in short])
            return out
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        result = lengths.copy()
        flat = np.frombuffer(b"".join(sequences), np.uint8)
        symbols = self.first[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[flat[ends]]
        ids = np.repeat(np.arange(len(sequences)), lengths)
        while len(symbols):
            inside = ids[1:] == ids[:-1]
            rank, at = self.rank(symbols[:-1], symbols[1:])
            rank[~inside] = _NO_RANK
            rank, at = np.append(rank, _NO_RANK).astype(np.int32), np.append(at, 0)
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            sizes = np.diff(np.r_[starts, len(ids)])
            lowest = np.minimum.reduceat(rank, starts)
            result[ids[starts]] = sizes
            live = np.repeat(lowest != _NO_RANK, sizes)
            hit = live & (rank == np.repeat(lowest, sizes))
            hit = _apart(hit)
            symbols[hit] = self.made[at[hit]]
            gone = np.r_[False, hit[:-1]]
            keep = live & ~gone
            symbols, ids = symbols[keep], ids[keep]
        return result

    def merge_long(self, sequence: bytes) -> int:
        """As merge, of one sequence. Places wait under the rank of their pair; a round takes the places of the lowest
        rank and looks up anew only the pairs beside what it merged, so that settled stretches cost nothing more."""
        flat = np.frombuffer(sequence, np.uint8)
        n = len(flat)
        symbols = np.append(self.first[flat], -1)
        symbols[n - 1] = self.last[flat[-1]]
        following, before = np.arange(1, n + 2), np.arange(-1, n)
        rank, made = np.full(n + 1, _NO_RANK, np.int32), np.zeros(n + 1, np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def look_up(at: np.ndarray) -> None:
            found, row = self.rank(symbols[at], symbols[following[at]])
            rank[at], made[at] = found, self.made[row]
            order = np.argsort(found, kind="stable")
            found, at = found[order], at[order]
            stop = int(np.searchsorted(found, _NO_RANK))
            for part in np.split(np.arange(stop), np.flatnonzero(np.diff(found[:stop])) + 1) if stop else ():
                key = int(found[part[0]])
                if key not in waiting:
                    waiting[key] = []
                    heapq.heappush(queue, key)
                waiting[key].append(at[part])

        left = n
        look_up(np.arange(n - 1))
        while queue:
            lowest = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(lowest)))
            at = at[rank[at] == lowest]  # the others have gone or changed
            if len(at) > 1:
                # of pairs that overlap (the pair of a symbol with itself) every second one, from the left
                run = np.r_[True, following[at[:-1]] != at[1:]]
                start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
            if not len(at):
                continue
            gone = following[at]
            symbols[at] = made[at]
            rank[gone] = _NO_RANK
            following[at] = following[gone]
            before[following[at]] = at
            left -= len(at)
            beside = np.unique(np.concatenate((at, before[at])))
            beside = beside[beside >= 0]
            last = following[beside] >= n
            rank[beside[last]] = _NO_RANK
            look_up(beside[~last])
        return left

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each white-space word, special strings being one token each."""
        place: dict[bytes, int] = {}
        owner: list[int] = []
        which: list[int] = []
        special = np.zeros(len(words), np.int64)
        for i, word in enumerate(words):
            parts = [word]
            if self.special is not None and "<" in word:
                special[i] = len(self.special.findall(word))
                parts = self.special.split(word)
            for part in parts:
                for token in self.pre_tokens(part):
                    owner.append(i)
                    which.append(place.setdefault(token.encode("utf-8", "replace"), len(place)))
        if place:
            np.add.at(special, owner, self.merge(list(place))[which])
        return special.tolist()


def _apart(hit: np.ndarray) -> np.ndarray:
    """Of hits next to each other (the pair overlaps itself) every second one, from the left."""
    at = np.flatnonzero(hit)
    if len(at) < 2 or not (np.diff(at) == 1).any():
        return hit
    new_run = np.r_[True, np.diff(at) != 1]
    run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
    out = np.zeros_like(hit)
    out[at[(np.arange(len(at)) - run_start) % 2 == 0]] = True
    return out


def byte_letters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


@lru_cache(2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def count_texts(texts: list[str | None], path: str) -> np.ndarray:
    cache = worker_cache(f"counts {path}", lambda: WordCache(merge_table(path).counts))
    out = np.zeros(len(texts), np.int64)
    for group, words in grouped(texts):
        cache.learn(words)
        for i, own in group:
            out[i] += sum(map(cache.__getitem__, own))
    return out


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit for each row of docs, in one pass without a shuffle.

    Null text counts as empty (0 bytes, 0 tokens), a null id stays null, repeated rows repeat, an empty
    table gives no rows; other columns play no part. Texts are taken whole, however long they or their
    words are; path names the vocabulary file, which every executor must have.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, sizes = batch.columns
            yield pa.RecordBatch.from_arrays([ids, sizes, pa.array(count_texts(texts.to_pylist(), path))], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return counts.withColumnRenamed("id", "doc_id")
