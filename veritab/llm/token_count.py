"""Token counts by a finite-state transducer (operator 4).

The merges are compiled into a deterministic automaton whose transitions carry the number of tokens they add (see
bpe.PrefixAutomaton), so a word is counted in one walk.  White space is never part of a token and resets the automaton,
so a stretch of text maps any state to a known one as soon as it holds white space: its state map is the text before
the first white space (which depends on the state it is entered with), the count in between, and the text after the
last.  Such maps compose associatively; texts are cut into chunks and the maps are combined in a parallel prefix scan.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.bpe import PrefixAutomaton, load_listed
from veritab.llm.frames import held, in_batches, strings_of

#: Fixed values of the tokenizer file: what it takes for white space, and how it cuts text into words.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Characters that str.split() takes for white space and the tokenizer does not.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_STRETCH = re.compile(f"[^{SPACE}]+")
_SPACE_AT = re.compile(f"[{SPACE}]")
_LAST_SPACE = re.compile(f"[{SPACE}][^{SPACE}]*$")


class StateMap(NamedTuple):
    """What a chunk does to the automaton: head is walked from the state that it is entered with; then count tokens
    follow; tail is what has been read since the last white space.  A chunk without white space is all head."""

    head: str
    count: int
    tail: str | None


class WordCounts(dict):
    """Token counts of stretches between white space, worked out by the transducer when first met."""

    def __init__(self, path: str, max_words: int = 400_000, max_states: int = 250_000):
        table, special = load_listed(path)
        self.transducer = PrefixAutomaton(table, True, max_states)
        self.words = regex.compile(WORDS)
        self.special = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.max_words = max_words

    def _plain(self, stretch: str) -> int:
        if not stretch.isascii():
            stretch = unicodedata.normalize("NFC", stretch).replace("Σ", "σ")
        total = 0
        for word in self.words.findall(stretch.lower()):
            coded = word.encode()
            total += self.transducer.count(coded[:-1].decode("latin-1") + chr(256 + coded[-1]))
        return total

    def __missing__(self, stretch: str) -> int:
        if self.special and "<|" in stretch:
            pieces = self.special.split(stretch)
            total = sum(map(self._plain, pieces[::2])) + len(pieces[1::2])
        else:
            total = self._plain(stretch)
        if len(self) >= self.max_words:
            self.clear()
        self[stretch] = total
        return total

    def between(self, text: str) -> int:
        """Tokens of a text that starts and ends at white space or at an end of the whole."""
        words = _STRETCH.findall(text) if _ODD_SPACE.search(text) else text.split()
        return sum(map(self.__getitem__, words))

    def state_map(self, chunk: str) -> StateMap:
        first = _SPACE_AT.search(chunk)
        if first is None:
            return StateMap(chunk, 0, None)
        last = _LAST_SPACE.search(chunk).start()
        return StateMap(chunk[: first.start()], self.between(chunk[first.start() : last]), chunk[last + 1 :])

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        if a.tail is None:
            return StateMap(a.head + b.head, b.count, b.tail)
        if b.tail is None:
            return StateMap(a.head, a.count, a.tail + b.head)
        return StateMap(a.head, a.count + self.between(a.tail + b.head) + b.count, b.tail)

    def scan(self, maps: list[StateMap]) -> list[StateMap]:
        """All prefixes' maps, by pairing neighbours, scanning the pairs and filling in (a parallel prefix scan)."""
        if len(maps) < 2:
            return maps
        pairs = self.scan([self.compose(maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)])
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(pairs[i // 2] if i % 2 else self.compose(pairs[i // 2 - 1], maps[i]))
        return out

    def count(self, text: str, chunk: int = 1 << 15) -> int:
        """Tokens of a whole text, which is cut into chunks anywhere, even inside words."""
        whole = self.scan([self.state_map(text[i : i + chunk]) for i in range(0, max(1, len(text)), chunk)])[-1]
        return self.between(whole.head) + whole.count + (self.between(whole.tail) if whole.tail is not None else 0)


def counter(path: str) -> WordCounts:
    """One per Python worker: what it has compiled serves all its tasks."""
    return held(f"token counts {path}", lambda: WordCounts(path))


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """docs with n_bytes, n_tokens (no begin, end or added tokens) and over_limit (n_tokens > limit).

    Null and empty texts have 0 tokens; other columns stay, but for columns of these three names, which are replaced;
    repeated rows are counted each.  Strings of special tokens inside a text count as one token each, as is the
    tokenizer library's default.
    """
    kept = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    schema = docs.select(*kept).schema.add("n_tokens", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer_path)
        for batch in batches:
            n = [counts.count(t) for t in strings_of(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], [*batch.schema.names, "n_tokens"])

    return in_batches(docs.select(*kept), work, schema).withColumns(
        {"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), "over_limit": F.col("n_tokens") > limit}
    )


def token_counts(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """Only key, as doc_id, and the figures: texts are read by the workers but not sent back.

    Null and empty texts have 0 tokens; null and repeated ids give a row each; an empty table gives none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer_path)
        for batch in batches:
            texts = strings_of(batch.column(1))
            n = [counts.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return in_batches(source, work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
