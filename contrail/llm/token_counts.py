"""Token counts by byte-pair merging with a heap and a linked list.

A text is split into words the way the vocabulary's library does (Unicode NFC,
lower case, white space dropped; then English contractions, runs of letters,
single digits, runs of anything else).  The symbols of a word are its UTF-8
bytes, the last one marked as the end of the word.  The adjacent pair of lowest
rank is popped from a heap and merged in a linked list until no ranked pair is
left; each merge takes one symbol away, so the count is the number of initial
symbols less the number of merges, and no identifier is ever made.  Special
strings inside a text count one token each, as in the library's default.

The work is per row and needs no shuffle.  Counts of short words are kept in a
bounded table per Python worker; very long words are merged in
O(n log n) and not kept.

Defined cases: a null text counts as empty and has no tokens; very long texts are
counted whole, without a limit; of equally ranked pairs (ties) the first in the word
is merged; 14 rare or unassigned code points (U+A7CB and U+A7DC among them) may be split
as the installed Unicode tables say, which are not the library's own; repeated rows are
counted one by one; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_batches

#: Unicode white space (the four separators of ASCII aren't).
_WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and not 0x1C <= ord(c) <= 0x1F)
#: Fixed value: the library's word pattern.
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WHITE}\p{{L}}\p{{N}}]+"
#: The same for texts of Latin-1 characters in lower case, without Unicode tables.
_LATIN_LETTERS, _LATIN_NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN_LETTERS}]+|[{_LATIN_NUMBERS}]|[^\t-\r \x85\xa0{_LATIN_LETTERS}{_LATIN_NUMBERS}]+"
KEEP_WORDS = 400_000
KEEP_CHARS = 40
MAX_TOKENS = 2048


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where it prints, and
    else the next free one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


class Splitter:
    """Special strings and words of a text, as the vocabulary file defines them."""

    def __init__(self, vocabulary: dict):
        self.specials = {t["content"]: t["id"] for t in vocabulary["added_tokens"]}
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self._words = regex.compile(WORD).findall
        self._latin_words = re.compile(LATIN_WORD).findall

    def words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            # The library lowers one character at a time: no final sigma.
            return self._words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        return self._latin_words(text.lower())  # always in normal form

    def parts(self, text: str) -> Iterator[tuple[str, list[str]]]:
        """(special string that follows, words before it); "" at the end."""
        start = 0
        if self._special is not None and "<|" in text:
            for m in self._special.finditer(text):
                yield m[0], self.words(text[start:m.start()])
                start = m.end()
        yield "", self.words(text[start:])


class Merger:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)
        model = vocabulary["model"]
        self.split = Splitter(vocabulary)
        self.ranks = {(a, b): i for i, (a, b) in enumerate(model["merges"])}
        self.end = model["end_of_word_suffix"]
        self.symbols = byte_symbols()
        self.known: dict[str, int] = {}

    def merge_count(self, word: str) -> int:
        """Tokens of one word."""
        parts: list[str | None] = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        n = len(parts)
        parts[-1] += self.end
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.ranks.get
        heap = [(r, i) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or rank((parts[i], parts[j])) != r:
                continue  # one of the two has been merged meanwhile
            parts[i] += parts[j]
            parts[j] = None
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return n - merges

    def _new(self, word: str) -> int:
        count = self.merge_count(word)
        if len(word) <= KEEP_CHARS:
            if len(self.known) >= KEEP_WORDS:
                self.known.clear()
            self.known[word] = count
        return count

    def count(self, text: str) -> int:
        total, known, new = 0, self.known.get, self._new
        for special, words in self.split.parts(text):
            total += bool(special)
            for w in words:
                total += known(w) or new(w)
        return total


@functools.lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def count_tokens(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row.  ``vocabulary`` is
    the path of the vocabulary file, readable on every executor."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = merger(vocabulary).count
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            n = pa.array([count(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, max_tokens)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", F.col("text").cast("string")), counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
