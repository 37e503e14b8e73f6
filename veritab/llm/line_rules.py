"""Quality rules by line-first cleaning (operator 5).

Every line is judged on its own by rules of symbols, navigation, punctuation and boilerplate; lines that fail are
removed; a document that loses more than a share of its words is rejected, as is one that fails the base rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.frames import in_batches, texts_of

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
#: What parts a line of links.
SEPARATORS = re.compile("[|]|»|•".encode())
SHOUTS = re.compile(rb"!!(?:[ \t\r\f\v]|$)")
CLOSING = tuple(c.encode() for c in ".!?:;…\"”’»)]")
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
    "enable javascript", "lorem ipsum", "click here", "subscribe to our", "sign up for", "skip to content", "powered by",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "hier klicken", "zum inhalt springen",
    "tous droits réservés", "mentions légales", "politique de confidentialité", "cliquez ici", "aller au contenu",
    "todos los derechos reservados", "política de privacidad", "aviso legal", "haga clic aquí", "saltar al contenido",
)
#: Lines are lowered in ASCII only, so other letters match in both cases.
_BOILERPLATE = re.compile("|".join("".join(c if c.isascii() else f"(?:{c}|{c.upper()})" for c in phrase) for phrase in BOILERPLATE).encode())
_NOT_CHARS = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])
_SPACES = bytes([0x20, *range(0x09, 0x0E)])


@dataclass(frozen=True)
class Limits:
    """symbols, shouts: most per ten words of a line.  links: separators that make a line navigation.  short: words
    that a line without closing punctuation must have.  lost: most of a document's words, in percent, that may go."""

    symbols: int = 3
    shouts: int = 3
    links: int = 3
    short: int = 4
    lost: int = 50
    words: int = 10
    repeated: int = 20


def line_fails(line: bytes, words: int, limits: Limits) -> bool:
    """Whether a line that holds words breaks a rule."""
    if (len(line) - len(line.translate(None, SYMBOLS))) * 10 > words * limits.symbols:
        return True
    if b"!!" in line and len(SHOUTS.findall(line)) * 10 > words * limits.shouts:
        return True
    links = len(SEPARATORS.findall(line))
    if links >= limits.links and links * 5 >= words:
        return True
    bare = line.strip(_SPACES)
    if words < limits.short and not bare.endswith(CLOSING):
        return True
    return _BOILERPLATE.search(line.lower()) is not None


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that the text holds twice or more, exactly.

    Windows are compared through ranks of pairs, of pairs of pairs, and so on, never through hashes.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) == n:
        return 0
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    kinds = int(pairs.max()) + 1
    if kinds == n - 1:
        return 0
    fours = np.unique(pairs[:-2] * kinds + pairs[2:], return_inverse=True)[1]
    _, fives, count = np.unique(fours[:-1] * len(known) + ids[4:], return_inverse=True, return_counts=True)
    twice = count[fives] > 1
    edges = np.zeros(n + 1, np.int64)
    edges[: n - 4] += twice
    edges[WINDOW : n + 1] -= twice
    return int((np.cumsum(edges)[:n] > 0).sum())


def judge(text: bytes, limits: Limits = Limits()) -> tuple[dict, bytes]:
    """Figures and verdict of a text, and what is left of it without the lines that fail."""
    words = text.split()
    n = len(words)
    lines, seen, kept_lines = 0, set(), []
    lost = 0
    for line in text.split(b"\n"):
        in_line = len(line.split())
        if in_line:
            lines += 1
            seen.add(line)
            if line_fails(line, in_line, limits):
                lost += in_line
                continue
        kept_lines.append(line)
    repeated = repeated_words(words)
    failed = n < limits.words or 100 * repeated > limits.repeated * n
    figures = {
        "n_words": n,
        "word_chars": len(text.translate(None, _NOT_CHARS)),
        "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
        "n_dup_lines": lines - len(seen),
        "n_repeat_words": repeated,
        "n_lost_words": lost,
        "base_failed": failed,
        "kept": not failed and 100 * lost <= limits.lost * n,
    }
    return figures, b"\n".join(kept_lines)


FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lost_words long, base_failed boolean, kept boolean"


def judge_documents(docs: DataFrame, limits: Limits = Limits(), keep_text: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Figures and verdict of every row; with keep_text also cleaned, the text without failing lines.

    A null text is an empty one: no words, so it fails the base rules.  Repeated rows are judged each.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(t, limits) for t in texts_of(batch.column(1))]
            columns = [batch.column(0)]
            for part in FIGURES.split(", "):
                name, type_ = part.split()
                columns.append(pa.array([f[name] for f, _ in found], pa.bool_() if type_ == "boolean" else pa.int64()))
            names = ["doc_id", *[part.split()[0] for part in FIGURES.split(", ")]]
            if keep_text:
                columns.append(pa.array([c.decode("utf-8", "replace") for _, c in found], pa.string()))
                names.append("cleaned")
            yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return in_batches(source, work, f"doc_id {kind}, {FIGURES}" + ", cleaned string" * keep_text)


def clean(docs: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """The rows that are kept, with all their columns and the text without failing lines."""
    schema = docs.schema
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(t, limits) for t in texts_of(batch.column(place))]
            columns = list(batch.columns)
            columns[place] = pa.array([c.decode("utf-8", "replace") for _, c in found], pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array([f["kept"] for f, _ in found], pa.bool_()))

    return in_batches(docs, work, schema)


ORACLE = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), word AS (
  SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS pos
  FROM (SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM doc)
), wide AS (
  SELECT row, pos, CASE WHEN lead(word, 4) OVER w IS NOT NULL
    THEN concat_ws(' ', word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w, lead(word, 4) OVER w) END AS five
  FROM word WINDOW w AS (PARTITION BY row ORDER BY pos)
), twice AS (
  SELECT row, pos, CASE WHEN five IS NOT NULL AND count(*) OVER (PARTITION BY row, five) > 1 THEN 1 ELSE 0 END AS again FROM wide
), marked AS (
  SELECT row, max(again) OVER (PARTITION BY row ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS again FROM twice
), repeats AS (
  SELECT row, sum(again)::BIGINT AS n FROM marked GROUP BY row
), line AS (
  SELECT row, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM doc)
), judged AS (
  SELECT row, line, words,
    len(regexp_extract_all(line, '[#*$%&|<>]')) * 10 > words * 3
    OR len(regexp_extract_all(line, '!!(?:[ \t\r\f\v]|$)')) * 10 > words * 3
    OR (len(regexp_extract_all(line, '[|»•]')) >= 3 AND len(regexp_extract_all(line, '[|»•]')) * 5 >= words)
    OR (words < 4 AND NOT regexp_matches(line, '[.!?:;…"”’»)\]][\x20\x09-\x0D]*$'))
    OR regexp_matches(lower(line), '{"|".join(BOILERPLATE)}') AS fails
  FROM line WHERE words > 0
), lines AS (
  SELECT row, count(*) - count(DISTINCT line) AS dups, coalesce(sum(words) FILTER (fails), 0)::BIGINT AS lost FROM judged GROUP BY row
), figures AS (
  SELECT doc_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_lost_words
  FROM doc LEFT JOIN lines USING (row) LEFT JOIN repeats r USING (row)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * n_lost_words <= 50 * n_words AS kept
FROM figures
"""
