"""Byte-pair merges as a lazily built deterministic automaton.

For every prefix of a word there is exactly one token that can end a valid encoding of that prefix (two neighbouring
tokens are valid together when the merges of their own bytes never meet a cheaper merge across the border).  So a
word's encoding is found left to right: keep each prefix's last token, append a byte, look for the one token that ends
at the new position and follows the last token of the prefix before it.

What the next byte can need is the stretch of bytes that may still begin a longer token, with the last token of each
of its prefixes.  Those stretches are the states of an automaton; it is compiled as texts need it, and every transition
carries the last token of the new prefix and the change in the number of tokens.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterable

FOREVER = 1 << 60
NO_TOKEN = -1


class MergeTable:
    """Tokens as strings of symbols, with the rank of each merge.

    Symbols are bytes (chr 0-255) and, for vocabularies that mark word ends, final bytes (chr 256-511).
    """

    def __init__(self, tokens: dict[str, int]):
        self.tokens = tokens
        self.text = {i: s for s, i in tokens.items()}
        self.length = {i: len(s) for s, i in tokens.items()}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._valid: dict[tuple[int, int], bool] = {}
        self._spines: tuple[dict, dict] = ({}, {})
        self.openings = {s[:k] for s in tokens for k in range(1, len(s))}
        self.longest = max(map(len, tokens))

    def merge(self, a: int, b: int) -> tuple[int, int] | None:
        """Rank and result of merging two tokens, if they merge."""
        raise NotImplementedError

    def encode_by_merging(self, word: str) -> list[int]:
        """The definition of byte-pair encoding: merge the cheapest, leftmost pair until none is left."""
        out = [self.tokens[s] for s in word]
        while len(out) > 1:
            best = None
            for i in range(len(out) - 1):
                m = self.merge(out[i], out[i + 1])
                if m and (best is None or m[0] < best[0]):
                    best = (m[0], i, m[1])
            if best is None:
                break
            rank, i, made = best
            new, k = [], 0
            while k < len(out):
                m = self.merge(out[k], out[k + 1]) if k + 1 < len(out) else None
                if m and m[0] == rank:
                    new.append(m[1])
                    k += 2
                else:
                    new.append(out[k])
                    k += 1
            out = new
        return out

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; none for a single symbol."""
        raise NotImplementedError

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that stand at one edge while a token is built, each with the rank of the merge that takes it up."""
        if known := self._spines[side].get(token):
            return known
        chain, used, whole = [], FOREVER, token
        while True:
            chain.append((token, used))
            parts = self.parts(token)
            if parts is None:
                self._spines[side][whole] = chain = chain[::-1]
                return chain
            used = self.merge(*parts)[0]
            token = parts[side]

    def valid(self, a: int, b: int) -> bool:
        """Whether a then b can stand next to each other in an encoding."""
        if a == NO_TOKEN:
            return True
        if (known := self._valid.get((a, b))) is not None:
            return known
        left, right = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            (x, x_used), (y, y_used) = left[i], right[j]
            across = self.merge(x, y)
            # of equal ranks the left pair goes first
            if across and across[0] < x_used and across[0] <= y_used:
                ok = False
                break
            if x_used == FOREVER and y_used == FOREVER:
                ok = True
                break
            if x_used <= y_used:
                i += 1
            else:
                j += 1
        if len(self._valid) > 400_000:
            self._valid.clear()
        self._valid[a, b] = ok
        return ok


class RankTable(MergeTable):
    """A vocabulary of bytes with ranks: two tokens merge when their joined bytes have a rank."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__({token.decode("latin-1"): rank for token, rank in ranks.items()})
        self.bytes = dict(zip(ranks.values(), ranks.keys(), strict=True))

    def merge(self, a, b):
        made = self.tokens.get(self.text[a] + self.text[b])
        return None if made is None else (made, made)

    def parts(self, token):
        if token in self._parts:
            return self._parts[token]
        word = self.text[token]
        out = [self.tokens[s] for s in word]
        while len(out) > 2:
            rank, i = min((m[0], i) for i in range(len(out) - 1) if (m := self.merge(out[i], out[i + 1])) and m[0] != token)
            out[i : i + 2] = [rank]
        self._parts[token] = found = tuple(out) if len(out) == 2 else None
        return found


class ListedTable(MergeTable):
    """A vocabulary with a list of merges, whose words end in a marked symbol."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], end: str, byte_of: dict[str, int]):
        def symbols(token: str) -> str:
            last = token.endswith(end)
            chars = [byte_of[c] for c in (token[: -len(end)] if last else token)]
            return "".join(map(chr, chars[:-1] if last else chars)) + (chr(256 + chars[-1]) if last else "")

        reachable = {c: i for c, i in vocab.items() if len(c) == 1 or c.endswith(end) and len(c) == 1 + len(end)}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        made_by: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            reachable[a + b] = made = vocab[a + b]
            self.merges[vocab[a], vocab[b]] = (rank, made)
            made_by.setdefault(made, (vocab[a], vocab[b]))
        super().__init__({symbols(c): i for c, i in reachable.items()})
        self._parts = {i: made_by.get(i) for i in reachable.values()}

    def merge(self, a, b):
        return self.merges.get((a, b))

    def parts(self, token):
        return self._parts[token]


class PrefixAutomaton:
    """States and transitions over symbols, built as needed; forgotten as a whole beyond max_states."""

    def __init__(self, table: MergeTable, counting: bool, max_states: int = 120_000):
        self.table, self.counting, self.max_states = table, counting, max_states
        self.reset()

    def reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.next: list[dict[str, tuple[int, int, int]]] = []
        self.start = self._state(("", (NO_TOKEN,), (0,)))

    def _state(self, key: tuple) -> int:
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
        return found

    def build(self, state: int, symbol: str) -> tuple[int, int, int]:
        """Compile one transition: the next state, the new prefix's last token, and its change in token count."""
        pending, lasts, counts = self.states[state]
        table, pending = self.table, pending + symbol
        n = len(pending)
        for k in range(n):
            token = table.tokens.get(pending[k:])
            if token is not None and table.valid(lasts[k], token):
                break
        else:
            raise ValueError("no token ends here: the vocabulary does not cover every symbol")
        change = counts[k] + 1
        cut = next((i for i in range(n) if pending[i:] in table.openings), n)
        new_counts = tuple(c - change for c in counts[cut:]) + (0,) if self.counting else (0,) * (n - cut + 1)
        step = (self._state((pending[cut:], lasts[cut:] + (token,), new_counts)), token, change)
        self.next[state][symbol] = step
        return step

    def count(self, word: str) -> int:
        """Tokens of a word of symbols, by adding up what the transitions carry."""
        if len(self.states) > self.max_states:
            self.reset()
        state, total, steps = self.start, 0, self.next
        for symbol in word:
            step = steps[state].get(symbol) or self.build(state, symbol)
            state = step[0]
            total += step[2]
        return total

    def lasts(self, word: str, state: int | None = None) -> tuple[list[int], int]:
        """Each prefix's last token, and the state after the word; may go on from a state of this automaton."""
        if state is None:
            if len(self.states) > self.max_states:
                self.reset()
            state = self.start
        out, steps = [], self.next
        for symbol in word:
            step = steps[state].get(symbol) or self.build(state, symbol)
            state = step[0]
            out.append(step[1])
        return out, state

    def walk_back(self, lasts: list[int]) -> list[int]:
        """The encoding that a list of last tokens stands for."""
        out, n, length = [], len(lasts), self.table.length
        while n:
            token = lasts[n - 1]
            out.append(token)
            n -= length[token]
        out.reverse()
        return out

    def encode(self, word: str) -> list[int]:
        return self.walk_back(self.lasts(word)[0])


class EditableEncoding:
    """A word's bytes with each prefix's last token: exact appends, and edits that redo only what they change."""

    def __init__(self, table: MergeTable, word: bytes = b""):
        self.automaton = PrefixAutomaton(table, counting=False, max_states=FOREVER)
        self.word, self.last, self.state = "", [], [self.automaton.start]
        self.append(word)

    def append(self, more: bytes) -> None:
        for symbol in more.decode("latin-1"):
            step = self.automaton.next[self.state[-1]].get(symbol) or self.automaton.build(self.state[-1], symbol)
            self.state.append(step[0])
            self.last.append(step[1])
            self.word += symbol

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put new bytes in place of [start, end); returns how many prefixes were worked out again.

        Work stops where the state after the edit is the one that stood there before: the rest follows unchanged.
        """
        tail, old = self.word[end:], (self.last[end:], self.state[end:])
        del self.last[start:], self.state[start + 1 :]
        self.word = self.word[:start]
        self.append(new)
        redone = len(new)
        for k, symbol in enumerate(tail):
            if self.state[-1] == old[1][k]:
                self.last += old[0][k:]
                self.state += old[1][k + 1 :]
                self.word += tail[k:]
                return redone
            self.append(symbol.encode("latin-1"))
            redone += 1
        return redone

    def ids(self) -> list[int]:
        return self.automaton.walk_back(self.last)


def byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use: printable Latin-1 as itself, others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_ranks(path: str) -> RankTable:
    with open(path, "rb") as lines:
        return RankTable({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


def load_listed(path: str) -> tuple[ListedTable, dict[str, int]]:
    """The merges of a tokenizer file with word ends, and its special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return ListedTable({c: i for c, i in model["vocab"].items() if c not in special}, merges, model["end_of_word_suffix"], byte_letters()), special
