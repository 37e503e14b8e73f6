"""Secret scans by corpus-wide ownership frequency (operator 11).

Candidates are found in each text on its own: the base kinds (named assignments, access keys, hexadecimal runs) and the
wider kinds that the method adds (bearer headers, logins in URLs, keys with an issuer's prefix, opaque runs).  Each
candidate's value is digested, and over the whole corpus every digest gets the number of its documents, of the distinct
repositories and of the distinct owners that hold it.  A value that many owners or repositories hold was copied from an
example; one that few hold and that looks random is live.  Base spans are always reported; wider ones only where live.

Values are never stored, only their SHA-256 digests.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.frames import in_batches, strings_of, written

#: Kinds in the order that ties of start follow.  Of each the group that holds the value.  Letters of the names that
#: assignments have match in either case, ASCII only.
KINDS: dict[str, tuple[re.Pattern[str], int]] = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE), 2),
    "access": (re.compile("AKIA[A-Z0-9]{16,}"), 0),
    "hex": (re.compile("[0-9a-f]{24,}"), 0),
    "bearer": (re.compile("[Bb]earer\x20+([A-Za-z0-9+/_.=-]{16,})"), 1),
    "login": (re.compile(r"://[^\x00-\x20/:@]+:([^\x00-\x20/:@]+)@"), 1),
    "issued": (re.compile(r"(?:gh[pousr]_|github_pat_|glpat-|sk-|xox[abprs]-|AIza|ya29\.)[A-Za-z0-9_-]{16,}"), 0),
    "opaque": (re.compile("[A-Za-z0-9+/_=-]{20,}"), 0),
}
NAMES = tuple(KINDS)
#: So many kinds, the first ones, are base kinds.
BASE = 3
#: Shortest value of an assignment; a shorter one is dropped with what it consumed.
SHORTEST = 6
#: Kinds that only their shape gives away; their values need more different characters to look live.
SHAPES = ("hex", "opaque")
PLACEHOLDERS = re.compile("example|sample|dummy|changeme|placeholder|your|xxxx|test|123456|abcdef")
DIGITS, LETTERS = re.compile("[0-9]"), re.compile("[A-Za-z]")
#: At most one value in HOT_SHARE can be hot, so there are at most so many hot values.
HOT_SHARE = 1000


@dataclass(frozen=True)
class Wide:
    """A value is copied if at least so many distinct owners, or so many distinct repositories, hold it."""

    owners: int = 3
    repositories: int = 6


def looks_live(kind: str, value: str) -> bool:
    """Letters and digits, many different characters, and nothing that marks a placeholder."""
    if len(set(value)) < (10 if kind in SHAPES else 6) or not DIGITS.search(value) or not LETTERS.search(value):
        return False
    return not PLACEHOLDERS.search(value.lower())


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of a text, in this order: all base spans, and of the wider ones those that overlap
    neither a base span nor a wider one before them."""
    base, wider = [], []
    for k, (pattern, group) in enumerate(KINDS.values()):
        for m in pattern.finditer(text):
            value = m[group]
            if k or len(value) >= SHORTEST:
                (base if k < BASE else wider).append((m.start(), k, m.end(), value))
    base.sort()
    if not wider:
        return base
    free, held, taken, at = [], [], -1, 0
    for start, _, end, _ in base:
        if held and start < held[-1][1]:
            held[-1][1] = max(end, held[-1][1])
        else:
            held.append([start, end])
    for span in sorted(wider):
        while at < len(held) and held[at][1] <= span[0]:
            at += 1
        if span[0] >= taken and (at == len(held) or held[at][0] >= span[2]):
            free.append(span)
            taken = span[2]
    return sorted(base + free)


def named(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{NAMES[k]}:{start}:{end}" for start, k, end, _ in spans)


SPAN = "array<struct<start:long,kind:int,end:long,digest:binary,live:boolean>>"


def find_candidates(docs: DataFrame, owner: Column, repository: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: row (a number of its own), doc_id, owner, repository, n_assign, n_access, n_hex, base_sha256, and found,
    its candidates with the digests of their values.  A null text is an empty one."""
    kind = docs.schema[key].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("digest", pa.binary()), ("live", pa.bool_())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, found = ([], [], []), [], []
            for t in strings_of(batch.column(4)):
                of_text = candidates(t)
                base = [s for s in of_text if s[1] < BASE]
                for k in range(BASE):
                    counts[k].append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(named(base).encode()).hexdigest())
                found.append(
                    [
                        {"start": start, "kind": k, "end": end, "digest": hashlib.sha256(value.encode()).digest(), "live": looks_live(NAMES[k], value)}
                        for start, k, end, value in of_text
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(found, spans)],
                ["row", "doc_id", "owner", "repository", "n_assign", "n_access", "n_hex", "base_sha256", "found"],
            )

    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), F.col(text).alias("text")
    )
    columns = f"row long, doc_id {kind}, owner string, repository string, n_assign long, n_access long, n_hex long, base_sha256 string, found {SPAN}"
    return in_batches(source, work, columns)


def ownership(held: DataFrame) -> DataFrame:
    """digest, n_found, n_repositories and n_owners of (digest, owner, repository), one row for each time a value is found.

    Null owners are one owner, null repositories one repository of their owner.  Only counts with partial sums, so that
    a value that a third of all documents hold is no large group.
    """
    places = held.groupBy("digest", "owner", "repository").agg(F.count("*").alias("n"))
    owners = places.groupBy("digest", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repositories"))
    return owners.groupBy("digest").agg(
        F.sum("n").alias("n_found"), F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners")
    )


def judged(held: DataFrame, wide: Wide) -> DataFrame:
    """The rows of held with copied, true for a value that many owners or repositories hold.

    Values that make up more than one in HOT_SHARE of all candidates, of which there are at most HOT_SHARE, are
    broadcast; all others are joined by digest, none of them hot.
    """
    found = written(ownership(held).withColumn("copied", (F.col("n_owners") >= wide.owners) | (F.col("n_repositories") >= wide.repositories)), "ownership")
    total = found.agg(F.coalesce(F.sum("n_found"), F.lit(0)).alias("n")).first()["n"]
    is_hot = F.col("n_found") * HOT_SHARE > total
    hot = found.filter(is_hot).select("digest", F.col("copied").alias("hot_copied"))
    cold = found.filter(~is_hot).select("digest", "copied")
    told = held.join(F.broadcast(hot), "digest", "left")
    columns = held.columns
    of_hot = told.filter(F.col("hot_copied").isNotNull()).select(*columns, F.col("hot_copied").alias("copied"))
    return of_hot.unionByName(told.filter(F.col("hot_copied").isNull()).select(*columns).join(cold, "digest").select(*columns, "copied"))


def scan_documents(docs: DataFrame, owner: Column, repository: Column, wide: Wide = Wide(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end of the base spans
    and of wider ones that are live), n_added, n_live and n_copied (of all spans reported).

    Null and empty texts have no spans; repeated rows are reported each; a null id is kept; an empty table gives no rows.
    Only documents with candidates are shuffled, and of them not the texts.
    """
    found = written(find_candidates(docs, owner, repository, key, text), "candidates")
    own = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    none = found.filter(F.size("found") == 0).select(
        *own, F.lit("").alias("spans"), *[F.lit(0).cast("long").alias(c) for c in ("n_added", "n_live", "n_copied")]
    )
    held = found.filter(F.size("found") > 0)
    spans = held.select("row", "owner", "repository", F.explode("found").alias("span")).select("row", "owner", "repository", "span", F.col("span.digest").alias("digest"))
    live = F.col("span.live") & ~F.col("copied")
    told = judged(spans, wide).filter((F.col("span.kind") < BASE) | live)
    count = lambda c: F.sum(c.cast("long"))
    of_row = told.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("span.start", "span.kind", "span.end"))).alias("spans"),
        count(F.col("span.kind") >= BASE).alias("n_added"),
        count(live).alias("n_live"),
        count(F.col("copied")).alias("n_copied"),
    )
    names = F.array(*map(F.lit, NAMES))
    shown = F.transform("spans", lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    joined = held.join(of_row, "row", "left").select(
        *own, F.coalesce(F.concat_ws(",", shown), F.lit("")).alias("spans"), *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_added", "n_live", "n_copied")]
    )
    return none.unionByName(joined)


def _sql() -> str:
    """Matches are marked by U+E000, which no pattern takes in, and their places are running lengths of the parts."""
    assign = """([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    found = []
    for k, (name, (pattern, group)) in enumerate(KINDS.items()):
        shape = assign if name == "assign" else pattern.pattern.replace(" ", r"\x20")
        found.append(
            f"""
  SELECT row, {k} AS kind, part, pos,
    CASE WHEN pos % 2 = 0 THEN regexp_extract(part, '{shape}', {group}) END AS value,
    sum(length(part)) OVER (PARTITION BY row ORDER BY pos) AS stop
  FROM (SELECT row, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos
    FROM (SELECT row, string_split(regexp_replace(text, '{shape}', chr(57344) || '\\0' || chr(57344), 'g'), chr(57344)) AS parts FROM doc))"""
        )
    names = ", ".join(f"'{n}'" for n in NAMES)
    shapes = ", ".join(str(NAMES.index(s)) for s in SHAPES)
    return f"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, 'null') AS owner, coalesce('=' || source, 'null') || ' ' || coalesce('=' || lang, 'null') AS repository,
    replace(coalesce(text, ''), chr(57344), chr(57345)) AS text FROM documents
), part AS ({" UNION ALL ".join(found)}
), span AS (
  SELECT row, kind, (stop - length(part))::BIGINT AS start, stop::BIGINT AS stop, value FROM part WHERE pos % 2 = 0 AND (kind > 0 OR length(value) >= {SHORTEST})
), wider AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY start, kind) AS turn FROM span s WHERE kind >= {BASE}
    AND NOT EXISTS (SELECT 1 FROM span b WHERE b.kind < {BASE} AND b.row = s.row AND b.start < s.stop AND s.start < b.stop)
), walk AS (
  SELECT row, turn, kind, start, stop, value, true AS free, stop AS taken FROM wider WHERE turn = 1
  UNION ALL
  SELECT w.row, w.turn, w.kind, w.start, w.stop, w.value, w.start >= k.taken, CASE WHEN w.start >= k.taken THEN w.stop ELSE k.taken END
  FROM walk k JOIN wider w ON w.row = k.row AND w.turn = k.turn + 1
), candidate AS (
  SELECT row, kind, start, stop, value FROM span WHERE kind < {BASE} UNION ALL SELECT row, kind, start, stop, value FROM walk WHERE free
), judged AS (
  SELECT c.*, o.copied, NOT o.copied AND len(list_distinct(string_split(value, ''))) >= CASE WHEN kind IN ({shapes}) THEN 10 ELSE 6 END
    AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND NOT regexp_matches(lower(value), '{PLACEHOLDERS.pattern}') AS live
  FROM candidate c JOIN (
    SELECT value, count(DISTINCT owner) >= {Wide.owners} OR count(DISTINCT repository) >= {Wide.repositories} AS copied FROM candidate JOIN doc USING (row) GROUP BY value
  ) o USING (value)
), told AS (
  SELECT *, ([{names}])[kind + 1] || ':' || start || ':' || stop AS shown FROM judged WHERE kind < {BASE} OR live
)
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(shown, ',' ORDER BY start, kind) FILTER (kind < {BASE}), '')) AS base_sha256,
  coalesce(string_agg(shown, ',' ORDER BY start, kind), '') AS spans,
  count(*) FILTER (kind >= {BASE}) AS n_added, count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied
FROM doc LEFT JOIN told USING (row) GROUP BY row, doc_id
"""


#: The query op11 in DuckDB's SQL: owners are sources, repositories are sources by language.
ORACLE = _sql()
