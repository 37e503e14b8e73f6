"""Many words looked for in a text at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


@lru_cache(maxsize=8)
def _automaton(words: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for i, w in enumerate(words):
        if w and w not in found:
            found.add_word(w, i)
    found.make_automaton()
    return found


def first_word(text: Column, words: Sequence[str]) -> Column:
    """The place, from 0, of the first word of the list that a text holds; null if it holds none or is null.

    The words are one automaton, so a text is read once however many there are.  Which word comes first is told by the
    list, not by the text; empty words are in no text.
    """
    listed = tuple(words)

    def find(texts: pd.Series) -> pd.Series:
        search = _automaton(listed)
        if not len(search):
            return pd.Series([None] * len(texts), dtype="Int32")
        return pd.Series([None if t is None else min((i for _, i in search.iter(t)), default=None) for t in texts], dtype="Int32")

    return F.pandas_udf(find, IntegerType())(text)
