"""Grouping of spelling variants by a rare-first q-gram prefix filter (operator 13).

Words are counted over the corpus.  Two words are near if one inserted, deleted or replaced code point parts them; such
an edit breaks at most two positional bigrams, so of any three bigrams of a word one survives, shifted by a place at
most.  All bigrams stand in one global order, the rarest first; each word is entered under its three rarest, and words
meet only in equal bigrams at places and lengths that one edit allows.  A pair that meets passes a mask of its letters
and is verified exactly.  Forms are the most frequent near words, and roots follow forms by pointer jumping.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.frames import in_batches, texts_of, written

#: Bytes of UTF-8 that are no letter of a run become spaces and A-Z lower; letters from U+00C0 to U+00FF start with C3.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_OTHER = re.compile(rb"[\xc2\xc4-\xf4][\x80-\xbf]+")
#: One occurrence in so many, by its document's and word's crc32, loses a letter.
DAMAGED = 97
SHORTEST, LEAST = 5, 3
#: Bigrams under which a word is entered: two for one edit, and one more.
PREFIX = 3
#: Words that a task counts before it passes them on.
HELD_WORDS = 1_000_000
#: Words under one bigram, place and length that are compared with a probe in one task.
BLOCK = 4096
#: Buckets above BLOCK that are broadcast; if there are more, they are joined.
FEW_BUCKETS = 20_000
#: Comparisons for each task, about.
COMPARISONS = 20_000_000


def damaged(word: bytes, h: int) -> bytes:
    """The word without the code point that the hash names."""
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def runs(text: bytes) -> list[bytes]:
    """Maximal runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z lowered."""
    plain = text.translate(_LETTERS)
    return (plain if plain.isascii() else _OTHER.sub(b" ", plain)).split()


def counted_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n of all words of SHORTEST code points that occur LEAST times or more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def take() -> Iterator[pa.RecordBatch]:
            words, n = list(total), list(total.values())
            total.clear()
            for at in range(0, len(words), 65_536):
                yield pa.RecordBatch.from_arrays([pa.array(words[at : at + 65_536], pa.binary()).cast(pa.string()), pa.array(n[at : at + 65_536], pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, t in zip(texts_of(batch.column(0)), texts_of(batch.column(1)), strict=True):
                seed = zlib.crc32(doc_id + b":")
                for word, n in Counter(runs(t)).items():
                    if len(word) < SHORTEST:
                        continue
                    h = zlib.crc32(word, seed)
                    total[damaged(word, h) if h % DAMAGED == 0 else word] += n
                if len(total) > HELD_WORDS:
                    yield from take()
        yield from take()

    source = docs.select(F.col(key).cast("string").alias("doc_id"), F.col(text).alias("text"))
    summed = in_batches(source, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return summed.filter((F.col("n") >= LEAST) & (F.length("word") >= SHORTEST))


def bigram_ranks(words: DataFrame) -> dict[str, int]:
    """The place of each bigram in the global order, the rarest first.  There are 90 letters, so at most 8100 bigrams."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        for batch in batches:
            for w in batch.column(0).to_pylist():
                n.update(map("".join, zip(w, w[1:], strict=False)))
        yield pa.RecordBatch.from_pydict({"gram": pa.array(n.keys(), pa.string()), "n": pa.array(n.values(), pa.int64())})

    summed = in_batches(words.select("word"), work, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: i for i, r in enumerate(sorted(summed.collect(), key=lambda r: (r["n"], r["gram"])))}


def letter_mask(word: str) -> int:
    """64 bits: which of 32 classes of letters occur, and which twice or more.  One letter more or less changes one bit
    at most."""
    mask = 0
    for c in word:
        bit = 1 << (ord(c) & 31)
        mask |= bit << 32 if mask & bit else bit
    return mask - (1 << 64) if mask >> 63 else mask


def prefix(word: str, ranks: dict[str, int]) -> list[tuple[int, int]]:
    """(bigram, place) of the PREFIX rarest bigrams of a word, and of all places of the last of these: ties between
    places of one bigram are not broken, so that the order is the same in every word."""
    grams = [ranks[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(grams)[: PREFIX][-1]
    return [(g, i) for i, g in enumerate(grams) if g <= last]


def entered(words: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """gram, place and size that words are entered under, with word, n and mask."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                mask = letter_mask(word)
                for gram, place in prefix(word, ranks):
                    for column, value in zip(rows, (gram, place, len(word), word, n, mask), strict=True):
                        column.append(value)
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], ["gram", "place", "size", "word", "n", "mask"])

    return in_batches(words.select("word", "n"), work, "gram int, place int, size int, word string, n long, mask long")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n of every two near words, once.

    The shorter word probes its own length and the next: a replaced letter leaves bigrams where they are, an inserted one
    leaves them or moves them up by one.  Buckets above BLOCK are cut into blocks by the hash of the word, and a probe
    asks all of them, so that no bucket is one task's.
    """
    entries = written(entered(words, bigram_ranks(words)), "entries")
    key = ["gram", "place", "size"]
    sizes = entries.groupBy(*key).agg(F.count("*").alias("held"))
    step = F.explode(
        F.array(
            F.struct(F.lit(0).alias("up"), F.lit(0).alias("longer")), F.struct(F.lit(0).alias("up"), F.lit(1).alias("longer")), F.struct(F.lit(1).alias("up"), F.lit(1).alias("longer"))
        )
    ).alias("step")

    def aimed(df: DataFrame, *columns: str) -> DataFrame:
        return df.select("*", step).select("gram", (F.col("place") + F.col("step.up")).alias("place"), (F.col("size") + F.col("step.longer")).alias("size"), (F.col("step.longer") == 1).alias("longer"), *columns)

    asked = aimed(sizes, F.col("held").alias("asked")).groupBy(*key).agg(F.sum("asked").alias("asked"))
    met = written(sizes.join(asked, key), "buckets")
    total = met.agg(F.coalesce(F.sum(F.col("held") * F.col("asked")), F.lit(0)).alias("n")).first()["n"]
    big = met.filter(F.col("held") > BLOCK).select(*key, F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks"))
    big = F.broadcast(big) if big.count() <= FEW_BUCKETS else big
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, total // COMPARISONS + 1)

    held = entries.join(big, key, "left")
    held = held.select(*key, F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("mask").alias("b_mask"), F.pmod(F.xxhash64("word"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"))
    probes = aimed(entries, F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("mask").alias("a_mask")).join(big, key, "left")
    probes = probes.select("*", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block")).drop("blocks")
    by = [*key, "block"]
    left, right = probes.repartition(tasks, *by), held.repartition(tasks, *by)
    # cheapest first: order of equal lengths, then the letters' mask, then the distance itself
    near = (
        (F.col("longer") | (F.col("a") < F.col("b")))
        & (F.bit_count(F.col("a_mask").bitwiseXOR(F.col("b_mask"))) <= F.when(F.col("longer"), 1).otherwise(2))
        & (F.levenshtein("a", "b", 1) == 1)
    )
    return left.join(right, by).filter(near).select("a", "a_n", "b", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word and root of (word, form): from each word along forms to the last, by pointer jumping.  A form is at least
    twice as frequent as its word, so chains are short and end."""
    jumps = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = written(jumps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        jumps = jumped.select("word", "root")
        if not jumped.filter("moved").limit(1).count():
            return jumps


def group_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the corpus.

    Null texts hold no words; a null id reads as empty; repeated rows count each; an empty table gives no rows.  Words
    of equal n are told apart by code points.  No word, bucket or pair is dropped.
    """
    words = written(counted_words(docs, key, text), "words")
    pairs = written(near_pairs(words), "near_words")
    sides = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("side"))
    most = sides.select("side.*").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("first"))
    formed = F.col("first.less") <= -2 * F.col("n")
    found = written(words.join(most, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("first.near")).alias("form"), F.when(formed, -F.col("first.less")).alias("form_n")), "variants")
    ends = roots(found.filter(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The query op13 in DuckDB's SQL.  crc32 goes byte by byte over the table of its polynomial; near words are found by what
#: is left when one letter is taken out.
ORACLE = rf"""
WITH RECURSIVE steps AS (
  SELECT i::BIGINT AS byte, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY byte) AS parts FROM steps WHERE k = 8
), run AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word FROM documents
), met AS (
  SELECT doc, word, count(*) AS n FROM run WHERE length(word) >= {SHORTEST} GROUP BY ALL
), bytes AS (
  SELECT *, list_transform(range(1, length(hex(encode(doc || ':' || word))) // 2 + 1), lambda i: ('0x' || substr(hex(encode(doc || ':' || word)), (2 * i - 1)::BIGINT, 2))::BIGINT) AS b FROM met
), hashed AS (
  SELECT word, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda h, x: xor(h // 256, parts[xor(h % 256, x) + 1])), 4294967295) AS h FROM bytes, crc
), changed AS (
  SELECT CASE WHEN h % {DAMAGED} = 0 THEN substr(word, 1, (h % length(word))::BIGINT) || substr(word, (h % length(word) + 2)::BIGINT) ELSE word END AS word, n FROM hashed
), word AS (
  SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {LEAST}
), cut AS (
  SELECT word, n, i, length(word) AS size, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)
), near AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN word b ON a.rest = b.word
), most AS (
  SELECT word, count(*)::BIGINT AS n_near, min({{'less': -near_n, 'near': near}}) AS first FROM near GROUP BY word
), variant AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -first.less >= 2 * n THEN first.near END AS form, CASE WHEN -first.less >= 2 * n THEN -first.less END AS form_n FROM word LEFT JOIN most USING (word)
), walk AS (
  SELECT word, coalesce(form, word) AS root FROM variant
  UNION SELECT w.word, v.form FROM walk w JOIN variant v ON v.word = w.root WHERE v.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM variant JOIN (
  SELECT w.word, w.root FROM walk w JOIN variant v ON v.word = w.root WHERE v.form IS NULL
) USING (word)
"""
