"""White-space words of texts in bounded chunks, and bounded caches keyed by word.

The vocabulary word_bpe_49k drops white space before it splits text, so the tokens of a text
are the tokens of its words in order; what is expensive is done once for each new word.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from sys import getsizeof

#: Characters that str.split() takes for white space and Unicode's White_Space does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
CHUNK_CHARS = 1 << 20


def slices(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """The text in parts of about size characters, cut at white space only."""
    at = 0
    while len(text) - at > size:
        cut = _WHITE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def split_words(text: str) -> list[str]:
    """The runs of characters that are not White_Space."""
    if _SEPARATORS.search(text) is None:
        return text.split()
    return [w for w in _WHITE.split(text) if w]


class WordCache(dict):
    """Values by word; resolve() finds those of new words all at once. When words and values take more than
    limit bytes it begins anew."""

    def __init__(self, resolve: Callable[[list[str]], list], limit: int = 16 << 20):
        super().__init__()
        self.resolve, self.limit, self.held = resolve, limit, 0

    def learn(self, words: set[str]) -> None:
        """After this the cache has all of words (of words learned before perhaps not)."""
        new = [w for w in words if w not in self]
        if not new:
            return
        if self.held > self.limit:
            self.clear()
            self.held, new = 0, list(words)
        values = self.resolve(new)
        self.update(zip(new, values))
        # an entry of the table, and the objects of word and value
        self.held += 60 * len(new) + _held(new) + _held(values)


def _held(objects: list) -> int:
    """About the bytes that they take. Of strings and bytes all at once: asking each costs as much as looking it up."""
    if isinstance(objects[0], str):
        return getsizeof("") * len(objects) + len("".join(objects).encode("utf-8", "surrogatepass"))
    if isinstance(objects[0], bytes):
        return getsizeof(b"") * len(objects) + sum(map(len, objects))
    return sum(map(getsizeof, objects))


def grouped(texts: list[str | None], size: int = CHUNK_CHARS) -> Iterator[tuple[list[tuple[int, list[str]]], set[str]]]:
    """Groups of (index of the text, words of it or of a slice of it), of about size characters
    together, each with the set of its words. Null counts as empty."""
    group: list[tuple[int, list[str]]] = []
    chars = 0
    for i, text in enumerate(texts):
        for part in slices(text or "", size):
            group.append((i, split_words(part)))
            chars += len(part)
            if chars >= size:
                yield group, set().union(*(w for _, w in group))
                group, chars = [], 0
    if group:
        yield group, set().union(*(w for _, w in group))
