"""Audit of how sources diverge from each other and from their language (operator 12).

Terms are found over the concatenated UTF-8 buffers of a batch: one look-up table tells term bytes and lowers A-Z, and
boundaries are where it changes or a text ends.  Slices are grouped by their xxhash, and each is compared byte by byte
with its group's first, so a collision cannot merge terms.  Counts by language, source and term are summed in one
shuffle; a bucket of a language's terms is then a CSR matrix of sources by terms, whose divergences are sums by reduceat
over its rows.  All arithmetic is in integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.frames import in_batches, written

#: Of each byte what it is in a term: itself, A-Z lowered; 0 if it parts terms.
TERM_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
#: Documents of its language that a kept term is in, at least.
LEAST_DOCS = 10
#: Terms of a group that are reported.
TOP = 10
#: p is one more than a share in so many parts.
PARTS = 1_000_000_000
#: Counts that a task holds before it passes them on.
HELD_COUNTS = 1_500_000
#: Counts in a bucket, about.
BUCKET = 200_000


def slices(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, and starts, ends and text numbers of all terms of texts that lie end to end in data; text i is
    data[offsets[i] : offsets[i + 1]]."""
    lowered = TERM_BYTES[data]
    inside = lowered != 0
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = np.unique(offsets)
    first, last = edges[edges < len(data)], edges[edges > 0] - 1
    opens[first] = inside[first]
    closes[last] = inside[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return lowered, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def grouped(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray, digest: Callable[[bytes], int] = xxhash.xxh64_intdigest) -> tuple[list[bytes], np.ndarray]:
    """The distinct slices, and of each slice the number of its own: by digest, then verified byte by byte."""
    held = lowered.tobytes()
    hashes = np.fromiter((digest(held[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    size = ends - starts
    same = np.array_equal(size, size[first][kind])
    if same and len(starts):
        # every byte of a slice beside that of its group's first slice
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        same = np.array_equal(lowered[np.repeat(starts, size) + within], lowered[np.repeat(starts[first][kind], size) + within])
    if not same:
        known: dict[bytes, int] = {}
        kind = np.fromiter((known.setdefault(held[s:e], len(known)) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(starts))
        return list(known), kind
    return [held[starts[i] : ends[i]] for i in first.tolist()], kind


class Tally:
    """Counts of (group, term): occurrences, and documents that hold it."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.terms: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, groups: list[tuple[str, str]], terms: list[bytes], kind: np.ndarray, text: np.ndarray) -> None:
        """Terms of texts: terms[kind[i]] stands in text[i], whose group is groups[text[i]]."""
        group = np.fromiter((self.groups.setdefault(g, len(self.groups)) for g in groups), np.int64, len(groups))
        number = np.fromiter((self.terms.setdefault(t, len(self.terms)) for t in terms), np.int64, len(terms))
        pair, n = np.unique(text * len(terms) + kind, return_counts=True)
        key = (group[pair // len(terms)] << 40) + number[pair % len(terms)] if len(pair) else pair
        self._keep(np.stack([key, n, np.ones_like(n)]))
        if self.size > 2 * HELD_COUNTS:
            self._merge()

    def _keep(self, part: np.ndarray) -> None:
        key, place = np.unique(part[0], return_inverse=True)
        sums = np.zeros((2, len(key)), np.int64)
        for i in (0, 1):
            np.add.at(sums[i], place, part[i + 1])
        self.parts.append(np.concatenate([key[None], sums]))
        self.size += len(key)

    def _merge(self) -> None:
        whole = np.concatenate(self.parts, 1)
        self.parts, self.size = [], 0
        self._keep(whole)

    def full(self) -> bool:
        return self.size > HELD_COUNTS

    def take(self) -> Iterator[pa.RecordBatch]:
        """What was counted, in batches; the tally is empty then."""
        if self.parts:
            self._merge()
            key, n, docs = self.parts[0]
            groups, terms = list(self.groups), list(self.terms)
            for at in range(0, len(key), 65_536):
                k = key[at : at + 65_536]
                of = [groups[g] for g in (k >> 40).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([g[0] for g in of], pa.string()),
                        pa.array([g[1] for g in of], pa.string()),
                        pa.array([terms[t] for t in (k & (1 << 40) - 1).tolist()], pa.binary()).cast(pa.string()),
                        pa.array(n[at : at + 65_536]),
                        pa.array(docs[at : at + 65_536]),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )
        self.__init__()


def tallied(docs: DataFrame) -> DataFrame:
    """lang, source, term, n and docs of (lang, source, text), summed within each task only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            _, offsets, data = texts.buffers()
            offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
            lowered, starts, ends, text = slices(data, offsets - offsets[0])
            terms, kind = grouped(lowered, starts, ends)
            tally.add(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)), terms, kind, text)
            if tally.full():
                yield from tally.take()
        yield from tally.take()

    return in_batches(docs, work, "lang string, source string, term string, n long, docs long")


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(PARTS * n / total), exactly: a long division by thousands, so that no product passes 64 bits."""
    if len(n) and int(np.max(total)) >= 1 << 53:
        return np.array([1 + PARTS * int(a) // int(b) for a, b in zip(n, total, strict=True)], np.int64)
    whole, rest = np.zeros(len(n), np.int64), n
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + step
    return 1 + whole


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def pair_sums(row: np.ndarray, col: np.ndarray, n: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """Divergence of each two sources over `terms` terms.  (row, col, n) are the counts above 0, by source; totals are the
    sources' denominators.

    For a source a, reduceat over the CSR rows gives each b's sum over b's own terms; a's terms that b lacks are all of
    a's against b's share of none, less those that both have; terms that neither has are alike.
    """
    sources = len(totals)
    none = shares(np.full(sources, 2, np.int64), totals)
    p = shares(n + 2, totals[row])
    starts = np.searchsorted(row, np.arange(sources + 1))
    size = np.diff(starts)
    filled = np.flatnonzero(size)
    out = np.zeros((sources, sources), np.int64)

    def by_row(values: np.ndarray) -> np.ndarray:
        sums = np.zeros(sources, np.int64)
        if len(filled):
            sums[filled] = np.add.reduceat(values, starts[filled])
        return sums

    for a in range(sources):
        mine = slice(starts[a], starts[a + 1])
        line, has = np.full(terms, none[a]), np.zeros(terms, bool)
        line[col[mine]], has[col[mine]] = p[mine], True
        both = has[col]
        alone = np.zeros(sources, np.int64)
        step = max(1, 1_000_000 // sources)
        for at in range(starts[a], starts[a + 1], step):
            alone += apart(p[at : min(at + step, starts[a + 1]), None], none[None]).sum(0)
        alone -= by_row(np.where(both, apart(line[col], none[row]), 0))
        neither = terms - size[a] - size + by_row(both.astype(np.int64))
        out[a] = by_row(apart(p, line[col])) + alone + neither * apart(none[a], none)
    return out


def bucket_parts(lang: str, counts: pa.Table, groups: pa.Table) -> dict[str, list]:
    """One bucket of a language: sums of each two sources, and the terms that each source has most in excess."""
    sources = groups["source"].to_pylist()
    place = {s: i for i, s in enumerate(sources)}
    totals = groups["total"].to_numpy()
    rows: dict[str, list] = {"lang": [], "source": [], "part": [], "item": [], "value": []}

    def add(source: str, part: str, item: str, value: int) -> None:
        for name, x in zip(rows, (lang, source, part, item, value), strict=True):
            rows[name].append(x)

    terms: dict[str, int] = {}
    col = np.fromiter((terms.setdefault(t, len(terms)) for t in counts["term"].to_pylist()), np.int64, len(counts))
    row = np.fromiter((place[s] for s in counts["source"].to_pylist()), np.int64, len(counts))
    order = np.lexsort((col, row))
    row, col, n = row[order], col[order], counts["n"].to_numpy()[order]
    sums = pair_sums(row, col, n, totals, len(terms))
    for a in range(len(sources)):
        for b in range(a + 1, len(sources)):
            add(sources[a], "pair", sources[b], int(sums[a, b]))
    if len(n):
        names = list(terms)
        whole = np.zeros(len(terms), np.int64)
        np.add.at(whole, col, n)
        q = shares(whole + 2, np.full(len(terms), groups["lang_total"][0].as_py()))
        p = shares(n + 2, totals[row])
        value = np.where(p > q[col], apart(p, q[col]), -1)
        for a in range(len(sources)):
            mine = np.flatnonzero((row == a) & (value >= 0))
            if len(mine) > TOP:
                least = np.partition(value[mine], -TOP)[-TOP]
                mine = mine[value[mine] >= least]
            best = sorted((-int(value[i]), names[col[i]].encode(), i) for i in mine)[:TOP]
            for less, name, _ in best:
                add(sources[a], "term", name.decode(), -less)
    return rows


def audit_sources(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from every other of its language (part pair), and
    the terms that it has most in excess of its language (part term, TOP ranks).

    Null texts, languages and sources read as ''.  A group without terms is compared too; a language without kept terms
    gives 0 for all its pairs; a source that is alone in its language has no pair.  Repeated rows count each; an empty
    table gives no rows.
    """
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = docs.select(read(lang).alias("lang"), read(source).alias("source"), read(text).alias("text"))
    # one shuffle by term serves the sums, the documents of a term and the number of terms
    by_term = Window.partitionBy("lang", "term")
    counts = tallied(own).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = counts.select("lang", "source", "term", "n", F.sum("docs").over(by_term).alias("docs"), F.row_number().over(by_term.orderBy("source")).alias("turn"))
    kept = written(counts.filter(F.col("docs") >= LEAST_DOCS).select("lang", "source", "term", "n", "turn"), "kept_terms")

    of_lang = kept.groupBy("lang").agg(F.sum(F.when(F.col("turn") == 1, 1).otherwise(0)).alias("v"), F.sum("n").alias("lang_n"))
    of_group = own.select("lang", "source").distinct().join(kept.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
    groups = of_group.join(of_lang, "lang", "left").na.fill(0, ["n", "v", "lang_n"])
    # a language without kept terms has no shares; all its sums are 0 whatever the totals
    total = lambda n: F.greatest(F.col(n) + 2 * F.col("v"), F.lit(1)).cast("long")
    groups = groups.select("lang", "source", total("n").alias("total"), total("lang_n").alias("lang_total"))

    buckets = kept.count() // BUCKET + 1
    left = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"), "source", "term", "n")
    right = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))

    def work(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
        return pa.table(bucket_parts(key[0].as_py(), counts, groups), pa.schema([*[(c, pa.string()) for c in ("lang", "source", "part", "item")], ("value", pa.int64())]))

    parts = left.groupBy("lang", "bucket").cogroup(right.groupBy("lang", "bucket")).applyInArrow(work, "lang string, source string, part string, item string, value long")
    both = F.when(F.col("part") == "pair", F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    sides = F.explode(F.coalesce(both, F.array(F.struct("source", "item")))).alias("side")
    summed = parts.select("lang", "part", "value", sides).groupBy("lang", "side.source", "part", "side.item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return summed.select("lang", "source", "part", "item", "value", rank.alias("rank")).filter((F.col("part") == "pair") | (F.col("rank") <= TOP))


#: The query op12 in DuckDB's SQL, with all terms of all groups spelt out.
ORACLE = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), word AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM doc
), term AS (
  SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT row) >= {LEAST_DOCS}
), grp AS (
  SELECT DISTINCT lang, source FROM doc
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM word JOIN term USING (lang, term) GROUP BY ALL
), dense AS (
  SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n FROM grp g JOIN term t ON t.lang = g.lang LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term
), share AS (
  SELECT lang, source, term, n, (1 + {PARTS}::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)))::HUGEINT AS p FROM dense
), whole AS (
  SELECT lang, term, (1 + {PARTS}::HUGEINT * (sum(n) + 2) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)))::HUGEINT AS q FROM dense GROUP BY lang, term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM share x JOIN share y ON y.lang = x.lang AND y.term = x.term
    WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
), excess AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM share JOIN whole USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pair
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM excess
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
