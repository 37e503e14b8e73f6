"""MinHash near-duplicate detection by BagMinHash (operator 6).

A document is the multiset of its windows of five words.  Weights (how often a window occurs) are discretised to whole
numbers, and the weight axis of each window is covered by intervals [0, 1), [1, 2), [2, 4), [4, 8), ...: every one
carries a Poisson process whose rate is its length, seeded by the window and the interval alone.  A point has a time,
a component of the signature and a place on the weight axis; it counts for a document if its place is below the
window's weight there.  Each component keeps the earliest time, so two documents agree in a component with the
probability of their weighted Jaccard similarity.  Intervals above a weight are never opened, and a process ends once
it is later than the latest component, so the work follows the number of distinct windows, not the weights.

Signatures are banded; documents that share a band are candidates; candidates are verified by their exact multiset
overlap.  In a bucket all are held against one leader first, which puts most copies into one group.  Buckets whose
members are then still in different groups are worked through in blocks of bounded size: every two members that are in
different groups, and that sizes and signatures don't rule out, are compared where they meet first, and only links that
join groups are emitted.  So a similar pair that shares a band is lost only if the signatures rule it out wrongly
(see MOST_DIGITS), and no bucket emits all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from veritab.llm.frames import held, in_batches, texts_of, written

WORDS = 5
BANDS, ROWS = 32, 5
SIZE = BANDS * ROWS
SIMILAR = 0.8
#: Members of a bucket that one task holds: two blocks at most.
MEMBERS = 512
#: Four bits of every component's hash are kept.  Texts of similarity 0.8 differ in 30 of 160 such digits on average,
#: with a standard deviation of 4.94.  They differ in more than MOST_DIGITS with a chance of 1.1e-9, against 3.0e-6 that
#: they share no band.  Pairs beyond it aren't verified.
MOST_DIGITS = 62
DIGIT_BITS = 0x1111111111111111
#: Windows whose processes run side by side.
BLOCK = 200_000
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """64-bit hashes of words, kept while a worker lives."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = value = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return value


def windows(text: bytes) -> np.ndarray:
    """Hashes of a text's windows of WORDS words in order; a shorter text is one window, an empty one has none."""
    words = text.split()
    if not words:
        return np.zeros(0, _U)
    h = np.fromiter(map(held("word hashes", WordHashes).__getitem__, words), _U, len(words))
    if len(h) < WORDS:
        h = np.concatenate([h, np.zeros(WORDS - len(h), _U)])
    out = np.zeros(len(h) - WORDS + 1, _U)
    for k in range(WORDS):
        out = mixed(out * _U(0x9E3779B97F4A7C15) + h[k : len(h) - WORDS + 1 + k])
    return out


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """A multiset as a set: each further occurrence of a window is a different 64-bit number.  Sorted."""
    if not len(hashes):
        return hashes
    h = np.sort(hashes)
    first = np.concatenate([[True], h[1:] != h[:-1]])
    start = np.flatnonzero(first)
    turn = np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))
    return np.sort(np.where(turn == 0, h, mixed(h + turn.astype(_U) * _U(0xD6E8FEB86659FD93))))


def signatures(texts: list[np.ndarray]) -> np.ndarray:
    """BagMinHash signatures of several texts' window hashes: earliest times by text and component.

    Rows of texts without windows stay infinite.
    """
    sig = np.full((len(texts), SIZE), np.inf)
    owner, element, weight = [], [], []
    for i, h in enumerate(texts):
        if len(h):
            distinct, count = np.unique(h, return_counts=True)
            owner.append(np.full(len(distinct), i))
            element.append(distinct)
            weight.append(count)
    if not owner:
        return sig
    owner, element, weight = np.concatenate(owner), np.concatenate(element), np.concatenate(weight)
    # interval 0 is [0, 1); interval k is [2 ** (k - 1), 2 ** k)
    open_until = np.ceil(np.log2(weight)).astype(np.int64)
    level = np.concatenate([np.zeros(len(weight), np.int64), *(np.full((open_until >= k).sum(), k) for k in range(1, int(open_until.max(initial=0)) + 1))])
    which = np.concatenate([np.arange(len(weight)), *(np.flatnonzero(open_until >= k) for k in range(1, int(open_until.max(initial=0)) + 1))])
    owner, weight = owner[which], weight[which].astype(np.float64)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    length = np.where(level == 0, 1.0, low)
    state = mixed(element[which] + (level.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
    time = np.zeros(len(state))
    flat = sig.ravel()
    for step in range(1, 1 << 20):
        draw = mixed(state + _U(step * 0xA0761D6478BD642F % 2**64))
        time = time - np.log(((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / length
        more = mixed(draw ^ _U(0xE7037ED1A0B428DB))
        component = ((more >> _U(32)) * _U(SIZE) >> _U(32)).astype(np.int64)
        place = low + length * ((more & _U(0xFFFFFFFF)).astype(np.float64) * 2.0**-32)
        counts = place < weight
        np.minimum.at(flat, owner[counts] * SIZE + component[counts], time[counts])
        going = time < sig.max(1)[owner]
        if not going.any():
            return sig
        owner, weight, low, length, state, time = owner[going], weight[going], low[going], length[going], state[going], time[going]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    parts = sig.view(_U).reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), (len(sig), BANDS)).copy()
    for r in range(ROWS):
        key = mixed(key * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def digit_words(sig: np.ndarray) -> np.ndarray:
    """A hexadecimal digit of every component, packed into SIZE / 16 numbers for each signature."""
    digits = (mixed(sig.view(_U) + np.arange(1, SIZE + 1, dtype=_U)) & _U(15)).astype(np.uint8)
    return np.ascontiguousarray(digits[:, 0::2] << 4 | digits[:, 1::2]).view(np.int64)


def blocks(hashes: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Neighbours of together no more than BLOCK windows, or a single longer text."""
    part, size = [], 0
    for h in hashes:
        if part and size + len(h) > BLOCK:
            yield part
            part, size = [], 0
        part.append(h)
        size += len(h)
    if part:
        yield part


def name_of(hashes: np.ndarray) -> int:
    """One number for a multiset of windows: texts that differ in white space only have the same."""
    return int(mixed(occurrences(hashes) ^ _U(len(hashes))).sum(dtype=_U).astype(np.int64))


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n, bands, digits) of (doc_id, text): the name of the text's multiset of windows, its size, the
    keys of its bands and the digits of its components."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [windows(t) for t in texts_of(batch.column("text"))]
            sig = np.concatenate([signatures(part) for part in blocks(hashes)]) if hashes else np.zeros((0, SIZE))
            keys, digits = band_keys(sig), digit_words(sig)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([name_of(h) for h in hashes], pa.int64()),
                    pa.array([len(h) for h in hashes], pa.int64()),
                    pa.ListArray.from_arrays(np.arange(0, len(hashes) * BANDS + 1, BANDS, dtype=np.int32), pa.array(keys.ravel())),
                    pa.array(list(digits), pa.list_(pa.int64())),
                ],
                ["doc_id", "node", "n", "bands", "digits"],
            )

    return in_batches(docs, work, "doc_id long, node long, n long, bands array<long>, digits array<long>")


def window_sets(docs: DataFrame) -> DataFrame:
    """(node, windows) of (text): the multiset of windows as a set of 64-bit numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [windows(t) for t in texts_of(batch.column("text"))]
            sets = [occurrences(h).view(np.int64) for h in hashes]
            yield pa.RecordBatch.from_arrays([pa.array([name_of(h) for h in hashes], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "windows"])

    return in_batches(docs, work, "node long, windows array<long>")


def may_be_similar(x: str, y: str) -> Column:
    """Whether two rows with n and digits can be similar: the smaller is at least SIMILAR of the larger, and their
    digits do not rule it out."""
    sizes = F.least(F.col(f"{x}.n"), F.col(f"{y}.n")) >= SIMILAR * F.greatest(F.col(f"{x}.n"), F.col(f"{y}.n"))
    apart = F.lit(0)
    for k in range(SIZE // 16):
        differs = F.col(f"{x}.digits")[k].bitwiseXOR(F.col(f"{y}.digits")[k])
        # a digit's lowest bit gathers its four
        differs = differs.bitwiseOR(F.shiftrightunsigned(differs, 1))
        differs = differs.bitwiseOR(F.shiftrightunsigned(differs, 2))
        apart = apart + F.bit_count(differs.bitwiseAND(DIGIT_BITS))
    return sizes & (apart <= MOST_DIGITS)


def verified(pairs: DataFrame, sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Of distinct (a, b), those whose multisets overlap enough: sum of minima over sum of maxima."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("windows").alias("wa")), "a").join(sets.select(F.col("node").alias("b"), F.col("windows").alias("wb")), "b")
    common = F.size(F.array_intersect("wa", "wb"))
    return both.filter(common >= similar * (F.size("wa") + F.size("wb") - common)).select("a", "b")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of edges (a, b): root is the smallest node that links reach.

    Each round points every node at the smallest root next to it and then at that root's root, and ends with a written
    table; nothing passes through the driver but whether something changed.
    """
    links = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).select(F.col("a").alias("node"), "root"), "labels")
    for _ in range(rounds):
        near = links.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        best = labels.join(near, "node", "left").select("node", "root", F.least("root", "near").alias("best"))
        # roots learn what their nodes found, and nodes jump to their root's root
        offers = best.select(F.col("root").alias("node"), F.col("best").alias("offer")).unionByName(best.select("node", F.col("best").alias("offer")))
        taken = offers.groupBy("node").agg(F.min("offer").alias("up"))
        jumped = taken.join(taken.select(F.col("node").alias("up"), F.col("up").alias("top")), "up", "left").select("node", F.coalesce("top", "up").alias("root"))
        new = written(jumped, "labels")
        changed = new.join(labels.withColumnRenamed("root", "old"), "node").filter("root <> old").limit(1).count()
        labels = new
        if not changed:
            return labels
    raise RuntimeError("links are longer chains than the rounds allow")


def bucketed(texts: DataFrame) -> DataFrame:
    """(bucket, band, node, n, digits) of the texts that share a bucket with others.

    A bucket is a band's key and a class of sizes.  Sizes at least SIMILAR of each other are in the same or in
    neighbouring classes, and every text is in its own class and in the next.
    """

    def shared(entries: DataFrame) -> DataFrame:
        return entries.join(entries.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1").select("bucket"), "bucket")

    banded = written(shared(texts.filter("n > 0").select("node", F.posexplode("bands").alias("band", "bucket"))), "bands")
    size_class = F.floor(F.log("n") / float(-np.log(SIMILAR)) + 1e-9)
    known = banded.join(texts.select("node", "n", "digits"), "node")
    classed = known.select("node", "n", "digits", "band", F.explode(F.array(F.xxhash64("bucket", size_class), F.xxhash64("bucket", size_class + 1))).alias("bucket"))
    return written(shared(classed), "buckets")


def grouped(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, and (node, first_id, text_id, class_id, class_size, kept) of every distinct text; of
    each class the text of the smallest (first_id, node) is kept."""
    source = docs.select(id_of(key).alias("doc_id"), F.col(text).alias("text"))
    sketched = written(sketch(source), "sketch")
    firsts = [F.first(c).alias(c) for c in ("n", "bands", "digits")]
    texts = written(sketched.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), *firsts), "texts")
    entries = bucketed(texts)
    # all buckets order their members alike, so a large group has few leaders
    leaders = entries.groupBy("bucket").agg(F.min(F.struct("node", "n", "digits")).alias("leader")).select("bucket", "leader.node", "leader.n", "leader.digits")
    pairs = entries.alias("x").join(leaders.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.node") != F.col("y.node")) & may_be_similar("x", "y"))
    pairs = pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    wanted = entries.select("node").distinct().join(texts.select("node", "first_id"), "node").select(F.col("first_id").alias("doc_id")).distinct()
    sets = window_sets(source.join(wanted, "doc_id").select("text")).groupBy("node").agg(F.first("windows").alias("windows"))
    sets = written(sets, "windows")
    groups = linked_groups(entries, written(verified(pairs, sets), "edges"), sets.join(texts.select("node", "bands"), "node"))
    rooted = texts.select("node", "first_id", "copies").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = with_own_id(rooted, "text_id")
    classes = rooted.groupBy("root").agg(F.min(F.struct("first_id", "node")).alias("first"), F.sum("copies").alias("class_size"))
    classes = with_own_id(classes.select("root", "first.first_id", "first.node", "class_size"), "class_id").select("root", F.col("node").alias("keeper"), "class_id", "class_size")
    named = rooted.join(classes, "root").select("node", "first_id", "text_id", "class_id", "class_size", (F.col("node") == F.col("keeper")).alias("kept"))
    return sketched.select("doc_id", "node"), written(named, "classes")


def with_own_id(rows: DataFrame, name: str) -> DataFrame:
    """rows of distinct node with first_id as name; of several with one first_id that of the smallest node has it, and
    the others have their node with the sign bit set."""
    clashes = rows.groupBy("first_id").agg(F.min("node").alias("holder"), F.count("*").alias("rows")).filter("rows > 1").select("first_id", "holder")
    named = F.when(F.col("node") == F.coalesce("holder", "node"), F.col("first_id")).otherwise(F.col("node").bitwiseOR(F.lit(-(2**63))))
    return rows.join(clashes, "first_id", "left").withColumn(name, named).drop("holder")


def id_of(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(-1))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, text_id (the smallest id with the same windows), class_id (the smallest id
    of its near-duplicate class) and class_size (rows in the class).

    Classes are the connected components of pairs of similarity SIMILAR or more.  Texts without words, null ones
    too, are each other's copies; a text of fewer than five words is one window.  Rows whose id is null take
    part under the id -1; repeated rows are copies and give repeated results.  Where different texts, or classes, have
    one smallest id (null or repeated ids), one of them has it and the others a negative number made of their windows,
    so that no two share a text_id or a class_id.
    """
    rows, named = grouped(docs, key, text)
    return rows.join(named, "node").select("doc_id", "text_id", "class_id", "class_size")


def linked_groups(entries: DataFrame, edges: DataFrame, members: DataFrame) -> DataFrame:
    """(node, root): components of the edges and of what blocks of open buckets add to them.

    A bucket is open if it has more than two members (two have met already) and they are not all in one group.  Its
    members are dealt by a hash into blocks of about MEMBERS, and every two blocks meet in one place, so what a task
    holds is bounded.
    members: (node, windows, bands).
    """
    groups = components(edges)
    rooted = entries.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    unlike = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
    unlike = unlike.filter((F.col("low") < F.col("high")) & (F.col("size") > 2)).select("bucket", (F.ceil(F.col("size") / MEMBERS)).cast("int").alias("blocks"))
    dealt = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    open_ = written(rooted.join(unlike, "bucket").withColumn("block", dealt), "open")
    if open_.isEmpty():
        return groups
    met = open_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    rows = met.join(members, "node").withColumn("place", F.xxhash64("bucket", "first", "second"))
    rows = rows.select("place", "bucket", "first", "second", "block", "band", "node", "root", "n", "digits", "bands", "windows")
    dealt = rows.repartition("place").sortWithinPartitions("place", "bucket", "first", "second")
    new = written(in_batches(dealt, block_links, "a long, b long"), "edges")
    return components(edges.unionByName(new))


def block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join groups, from rows sorted by where they meet."""
    held: list[pa.Table] = []
    key = None

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            links = links_of(pa.concat_tables(held).combine_chunks())
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["a", "b"])
            held.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([batch.column(c).to_numpy() for c in ("bucket", "first", "second")], axis=1)
        cuts = np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(names)], strict=True):
            if key != tuple(names[start]):
                yield from flush()
                key = tuple(names[start])
            held.append(pa.Table.from_batches([batch.slice(start, end - start)]))
    yield from flush()


def links_of(rows: pa.Table) -> list[tuple[int, int]]:
    """Links between members of different groups where two blocks of a bucket meet."""
    block, node, root, n = (rows[c].to_numpy() for c in ("block", "node", "root", "n"))
    first, second, band = rows["first"][0].as_py(), rows["second"][0].as_py(), rows["band"][0].as_py()
    lists = {c: rows[c].combine_chunks() for c in ("digits", "bands", "windows")}
    digits, bands = (lists[c].flatten().to_numpy().reshape(len(node), -1) for c in ("digits", "bands"))
    windows, ends = lists["windows"].flatten().to_numpy(), lists["windows"].offsets.to_numpy()
    ends = ends - ends[0]
    parent = {int(r): int(r) for r in root}

    def find(r: int) -> int:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    top = root.copy()
    out = []
    for i in range(len(node)):
        rest = slice(i + 1, None)
        meets = (np.minimum(block[i], block[rest]) == first) & (np.maximum(block[i], block[rest]) == second) & (top[rest] != top[i])
        meets &= np.minimum(n[i], n[rest]) >= SIMILAR * np.maximum(n[i], n[rest])
        near = np.flatnonzero(meets) + i + 1
        if not len(near):
            continue
        differs = (digits[near] ^ digits[i]).view(_U)
        differs |= differs >> _U(1)
        differs |= differs >> _U(2)
        near = near[np.bitwise_count(differs & _U(DIGIT_BITS)).sum(1) <= MOST_DIGITS]
        # of the bands that two share, only the first compares them
        near = near[(bands[near] == bands[i]).argmax(1) == band] if len(near) else near
        mine = windows[ends[i] : ends[i + 1]]
        for j in near.tolist():
            a, b = find(int(root[i])), find(int(root[j]))
            if a == b:
                continue
            common = len(np.intersect1d(mine, windows[ends[j] : ends[j + 1]], assume_unique=True))
            if common >= SIMILAR * (n[i] + n[j] - common):
                out.append((int(node[i]), int(node[j])))
                parent[max(a, b)] = min(a, b)
                top = np.array([find(int(r)) for r in root])
    return out


def first_of_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each near-duplicate class: that of the smallest id, once.

    Rows are told apart by id and windows, so different texts under null or repeated ids are each kept.
    """
    # names of our own, so that no column of the documents clashes with what is added
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in own.items()])
    keepers = grouped(renamed, own[key], own[text])[1].filter("kept").select(F.col("first_id").alias("_id"), F.col("node").alias("_node"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = pa.array([name_of(windows(t)) for t in texts_of(batch.column("_text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], names], [*batch.schema.names[:-1], "_node"])

    numbered = renamed.withColumn("_id", id_of(own[key]))
    schema = StructType([*numbered.schema.fields, StructField("_node", LongType())])
    named = in_batches(numbered.withColumn("_text", F.col(own[text])), work, schema)
    kept = named.join(keepers, ["_id", "_node"]).dropDuplicates(["_id", "_node"])
    return kept.select(*[F.col(name).alias(c) for c, name in own.items()])
