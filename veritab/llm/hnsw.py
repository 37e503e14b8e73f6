"""Approximate nearest neighbours by navigable small-world graphs (operator 8).

Vectors are dealt into shards of about SHARD_ROWS: by the nearest of some centres, and a centre's vectors by a hash where
they are more than one shard holds.  Each shard builds one hierarchical graph, kept as flat neighbour arrays.  A query
goes to the shards of its nearest centres, as many as a bounded sample needs to keep ROUTED of its true neighbours (to
all of them, where vectors have no clusters), and the shards' results are merged.  A shard's graph is loaded once for
every QUERY_BLOCK queries, which stream through it.

Equal vectors are one entry that knows the smallest ids of its rows, as many as a result can need; entries of one
direction are one node of the graph.  Whatever the graph finds is scored again in double precision on the vectors as
they stand, so ties are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from veritab.llm.frames import in_batches, written

SHARD_ROWS = 16384
#: Queries for which one copy of a shard is read.
QUERY_BLOCK = 65536
#: Links of a node above the ground layer; the ground layer has twice as many.
LINKS = 16
#: Candidates for a node's links, and nodes that a search keeps.
EF_BUILD, EF_SEARCH = 40, 128
TOP_LAYER = 5
#: Vectors on which centres and routes are fitted, and the share of true neighbours that routes keep there.
SAMPLE, ROUTED = 16384, 0.99
#: Components in a sample.
SAMPLE_NUMBERS = 8_000_000


def diverse(unit: np.ndarray, sims: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """For each row of candidates by falling similarity (-1 where none): those that no chosen one before them is closer
    to, then the nearest others, most at the most."""
    rows, width = near.shape
    if width <= most:
        return near
    vectors = unit[near]
    among = vectors @ vectors.transpose(0, 2, 1)
    hidden, chosen = near < 0, np.zeros(near.shape, bool)
    for k in range(width):
        takes = ~hidden[:, k] & (chosen.sum(1) < most)
        chosen[:, k] = takes
        hidden |= takes[:, None] & (among[:, k] > sims)
    # chosen ones first, then others, each by falling similarity
    order = np.argsort(np.where(near < 0, 2, np.where(chosen, 0, 1)), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, order, 1)


class Graph:
    """A hierarchical navigable small-world graph: links[layer] is an array of neighbours by node, -1 where none."""

    def __init__(self, unit: np.ndarray, links: list[np.ndarray], entry: int):
        self.unit, self.links, self.entry = unit, links, entry
        self.seen = np.zeros(len(unit), np.int64)
        self.turn = 0

    @classmethod
    def build(cls, unit: np.ndarray, seed: int = 11) -> Graph:
        """Nodes enter in order; each links to diverse ones of the nearest before it in its layers, which link back."""
        n = len(unit)
        draw = np.random.default_rng(seed).random(n)
        heights = np.minimum((-np.log(1 - draw) / np.log(LINKS)).astype(int), TOP_LAYER)
        links = []
        for layer in range(int(heights.max(initial=0)) + 1):
            members = np.flatnonzero(heights >= layer)
            most = LINKS * (2 if layer == 0 else 1)
            inside = cls.layer_links(unit[members], most)
            whole = np.full((n, most), -1, np.int32)
            whole[members] = np.where(inside < 0, -1, members[inside])
            links.append(whole)
        return cls(unit, links, int(np.argmax(heights)) if n else 0)

    @staticmethod
    def layer_links(unit: np.ndarray, most: int, block: int = 256) -> np.ndarray:
        n = len(unit)
        if n < 2:
            return np.full((n, most), -1, np.int32)
        ahead = np.full((n, LINKS), -1, np.int32)
        for start in range(1, n, block):
            rows = np.arange(start, min(n, start + block))
            sims = unit[rows] @ unit[: rows[-1]].T
            sims[np.arange(rows[-1]) >= rows[:, None]] = -np.inf
            width = min(EF_BUILD, sims.shape[1])
            near = np.argpartition(sims, -width, axis=1)[:, -width:]
            value = np.take_along_axis(sims, near, 1)
            order = np.argsort(-value, axis=1, kind="stable")
            near, value = np.take_along_axis(near, order, 1), np.take_along_axis(value, order, 1)
            near[value == -np.inf] = -1
            found = diverse(unit, value, near, LINKS)
            ahead[rows, : found.shape[1]] = found
        # links both ways, by node and falling similarity
        a, b = np.repeat(np.arange(n), LINKS), ahead.ravel()
        a, b = np.concatenate([a[b >= 0], b[b >= 0]]), np.concatenate([b[b >= 0], a[b >= 0]])
        value = np.einsum("ij,ij->i", unit[a], unit[b])
        order = np.lexsort([b, -value, a])
        a, b, value = a[order], b[order], value[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        width = most + most // 2
        use = place < width
        near, sims = np.full((n, width), -1, np.int32), np.full((n, width), -np.inf, np.float32)
        near[a[use], place[use]], sims[a[use], place[use]] = b[use], value[use]
        out = np.full((n, most), -1, np.int32)
        full = np.flatnonzero(near[:, most] >= 0)
        out[:] = near[:, :most]
        for start in range(0, len(full), block):
            rows = full[start : start + block]
            out[rows] = diverse(unit, sims[rows], near[rows], most)
        return out

    def layer(self, q: np.ndarray, start: list[tuple[float, int]], ef: int, layer: int) -> list[tuple[float, int]]:
        """The ef most similar nodes found from the starting ones, by falling similarity."""
        self.turn += 1
        seen, turn, unit, links = self.seen, self.turn, self.unit, self.links[layer]
        ahead = [(-s, i) for s, i in start]
        heapify(ahead)
        found = list(start)
        heapify(found)
        for _, i in start:
            seen[i] = turn
        while len(found) > ef:
            heappop(found)
        while ahead:
            s, i = heappop(ahead)
            if len(found) >= ef and -s < found[0][0]:
                break
            near = links[i]
            near = near[near >= 0]
            near = near[seen[near] != turn]
            if not len(near):
                continue
            seen[near] = turn
            sims = unit[near] @ q
            if len(found) >= ef:
                better = sims > found[0][0]
                near, sims = near[better], sims[better]
            for sim, j in zip(sims.tolist(), near.tolist(), strict=True):
                if len(found) < ef:
                    heappush(found, (sim, j))
                elif sim > found[0][0]:
                    heapreplace(found, (sim, j))
                else:
                    continue
                heappush(ahead, (-sim, j))
        return sorted(found, key=lambda x: (-x[0], x[1]))

    def search(self, q: np.ndarray, ef: int = EF_SEARCH) -> list[int]:
        """The nodes that a search for q keeps, nearest first."""
        if not len(self.unit):
            return []
        near = [(float(self.unit[self.entry] @ q), self.entry)]
        for layer in range(len(self.links) - 1, 0, -1):
            near = self.layer(q, near[:1], 1, layer)
        return [i for _, i in self.layer(q, near, ef, 0)]


def usable(vector: str) -> Column:
    """Whether a vector can be compared: not null, no null or non-finite component, and not zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit_rows(raw: np.ndarray) -> np.ndarray:
    # the largest component first, so that no square overflows or vanishes
    wide = raw / np.abs(raw).max(1, keepdims=True)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


class Routes:
    """Centres of one length of vectors, how many shards each centre has, and how many centres a query asks."""

    def __init__(self, sample: np.ndarray, cells: int, k: int):
        unit = unit_rows(sample)
        rng = np.random.default_rng(3)
        self.centres = unit[rng.choice(len(unit), min(cells, len(unit)), replace=False)]
        for _ in range(8):
            nearest = (unit @ self.centres.T).argmax(1)
            sums = np.zeros_like(self.centres)
            np.add.at(sums, nearest, unit)
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            self.centres = np.where(norm > 0, sums / np.maximum(norm, 1e-12), self.centres)
        self.asked, self.splits, self.first = len(self.centres), np.ones(len(self.centres), int), np.arange(len(self.centres))
        if len(self.centres) > 1:
            # the sample's own neighbours are farther than those among all rows, so they stray more
            cell = (unit @ self.centres.T).argmax(1)
            asks = rng.choice(len(unit), min(256, len(unit)), replace=False)
            sims = unit[asks] @ unit.T
            sims[np.arange(len(asks)), asks] = -2
            near = cell[np.argsort(-sims, axis=1)[:, :k]]
            turn = np.argsort(np.argsort(-(unit[asks] @ self.centres.T), axis=1), axis=1)
            turns = np.sort(np.take_along_axis(turn, near, 1).ravel())
            self.asked = int(turns[int(np.ceil(ROUTED * len(turns))) - 1]) + 1

    def split(self, sizes: np.ndarray) -> None:
        """Deal cells of more than SHARD_ROWS vectors to several shards."""
        self.splits = np.maximum(1, -(-sizes // SHARD_ROWS)).astype(int)
        self.first = np.concatenate([[0], np.cumsum(self.splits)[:-1]])

    def shards(self, vectors: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        cell = (unit_rows(vectors) @ self.centres.T).argmax(1)
        return self.first[cell] + hashes % self.splits[cell]

    def asks(self, vectors: np.ndarray) -> list[list[int]]:
        near = np.argsort(-(unit_rows(vectors) @ self.centres.T), axis=1, kind="stable")[:, : self.asked]
        return [[int(self.first[c] + s) for c in row for s in range(self.splits[c])] for row in near]


def entries(vectors: DataFrame, members: int) -> DataFrame:
    """(dim, vector, ids): distinct vectors of each partition with their smallest ids, before any shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list[int]] = {}

        def out() -> pa.RecordBatch:
            found = [(len(v) // 8, v, sorted(ids)[:members]) for v, ids in known.items()]
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.binary()), pa.array([x[2] for x in found], pa.list_(pa.int64()))],
                ["dim", "vector", "ids"],
            )

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("vector").to_pylist(), strict=True):
                # a zero has one sign
                ids = known.setdefault((np.asarray(v, np.float64) + 0.0).tobytes(), [])
                ids.append(i)
                if len(ids) >= 64:
                    ids.sort()
                    del ids[members:]
            if len(known) > 20_000:
                yield out()
                known.clear()
        if known:
            yield out()

    return in_batches(vectors, work, "dim int, vector binary, ids array<long>")


def fit_routes(found: DataFrame, k: int) -> dict[int, Routes]:
    """Routes for each length of vectors of which there is more than one shard; others need none."""
    out = {}
    for dim, rows in found.groupBy("dim").agg(F.count("*").alias("rows")).filter(F.col("rows") > SHARD_ROWS).collect():
        few = found.filter(F.col("dim") == dim)
        # fewer of longer vectors, so that the sample's size is bounded too
        most = min(SAMPLE, max(1024, SAMPLE_NUMBERS // dim))
        sample = few.orderBy(F.xxhash64("vector"), "vector").limit(most).select("vector").collect()
        out[dim] = Routes(np.stack([np.frombuffer(r["vector"]) for r in sample]), -(-rows // SHARD_ROWS), k)
    if not out:
        return out
    shared = found.sparkSession.sparkContext.broadcast(out)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = {dim: np.zeros(len(r.centres), np.int64) for dim, r in shared.value.items()}
        for batch in batches:
            for dim, which, vectors in by_length(batch):
                if dim in sizes:
                    sizes[dim] += np.bincount(shared.value[dim].shards(vectors, np.zeros(len(which), np.int64)), minlength=len(sizes[dim]))
        for dim, n in sizes.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * len(n), pa.int32()), pa.array(range(len(n)), pa.int32()), pa.array(n)], ["dim", "cell", "rows"])

    totals = in_batches(found, count, "dim int, cell int, rows long").groupBy("dim", "cell").agg(F.sum("rows").alias("rows")).orderBy("dim", "cell").collect()
    for dim, routes in out.items():
        routes.split(np.array([r["rows"] for r in totals if r["dim"] == dim]))
    return out


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, places in the batch, vectors) of a batch of (dim, vector)."""
    dims, raw = batch.column("dim").to_numpy(), batch.column("vector").to_pylist()
    for dim in np.unique(dims).tolist():
        which = np.flatnonzero(dims == dim)
        yield dim, which, np.frombuffer(b"".join(raw[i] for i in which)).reshape(len(which), dim)


def with_shards(rows: DataFrame, routes: dict[int, Routes], asks: bool) -> DataFrame:
    """rows of (dim, vector, hash, ...) with shards: the one that holds each, or those that it asks."""
    shared = rows.sparkSession.sparkContext.broadcast(routes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards: list[list[int]] = [[0]] * batch.num_rows
            hashes = batch.column("hash").to_numpy()
            for dim, which, vectors in by_length(batch):
                if dim in shared.value:
                    found = shared.value[dim].asks(vectors) if asks else [[s] for s in shared.value[dim].shards(vectors, hashes[which]).tolist()]
                    for i, s in zip(which.tolist(), found, strict=True):
                        shards[i] = s
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.list_(pa.int32()))], [*batch.schema.names, "shards"])

    return in_batches(rows, work, StructType([*rows.schema.fields, StructField("shards", ArrayType(IntegerType()))]))


def build_index(found: DataFrame, routes: dict[int, Routes], members: int) -> DataFrame:
    """One row for each shard: its distinct vectors, their rows' smallest ids, the node of each vector, and the graph."""

    def work(key: tuple, group: pa.Table) -> pa.Table:
        merged: dict[bytes, list[int]] = {}
        for v, ids in zip(group["vector"].to_pylist(), group["ids"].to_pylist(), strict=True):
            merged.setdefault(v, []).extend(ids)
        order = sorted(merged)
        # what is alike is scattered
        order = [order[i] for i in np.random.default_rng(7).permutation(len(order))]
        ids = [sorted(merged[v])[:members] for v in order]
        raw = np.frombuffer(b"".join(order)).reshape(len(order), -1)
        unit = unit_rows(raw)
        _, first, node = np.unique(unit, axis=0, return_index=True, return_inverse=True)
        # nodes by the first vector of their direction
        turn = np.argsort(first)
        graph = Graph.build(unit[first[turn]])
        return pa.table(
            {
                "dim": pa.array([key[0].as_py()], pa.int32()),
                "shard": pa.array([key[1].as_py()], pa.int32()),
                "vectors": pa.array([raw.tobytes()], pa.binary()),
                "node": pa.array([np.argsort(turn)[node.ravel()].tolist()], pa.list_(pa.int32())),
                "ids": pa.array([[i for x in ids for i in x]], pa.list_(pa.int64())),
                "ends": pa.array([np.cumsum([len(x) for x in ids]).tolist()], pa.list_(pa.int64())),
                "links": pa.array([[layer.tobytes() for layer in graph.links]], pa.list_(pa.binary())),
                "entry": pa.array([graph.entry], pa.int32()),
            }
        )

    dealt = with_shards(found.withColumn("hash", F.pmod(F.xxhash64("vector"), F.lit(1 << 31))), routes, False)
    dealt = dealt.select("dim", F.col("shards")[0].alias("shard"), "vector", "ids")
    shards = sum(int(r.splits.sum()) for r in routes.values()) + 1
    dealt = dealt.repartition(shards, "dim", "shard")
    return dealt.groupBy("dim", "shard").applyInArrow(work, INDEX)


INDEX = "dim int, shard int, vectors binary, node array<int>, ids array<long>, ends array<long>, links array<binary>, entry int"


def halved(rows: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two until the largest component is at least a half and below 1.  That is exact and leaves
    cosines as they are, but no square of what is far from 1 overflows or vanishes."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])


class Shard:
    """One shard of the index, ready to be searched."""

    def __init__(self, row: dict):
        self.raw = halved(np.frombuffer(row["vectors"]).reshape(-1, row["dim"]))
        self.norms = np.linalg.norm(self.raw, axis=1)
        node = np.array(row["node"])
        #: vectors by node
        self.order = np.argsort(node, kind="stable")
        self.starts = np.searchsorted(node[self.order], np.arange(int(node.max()) + 2))
        self.ids, self.ends = np.array(row["ids"]), np.array(row["ends"])
        unit = unit_rows(self.raw[self.order[self.starts[:-1]]])
        self.graph = Graph(unit, [np.frombuffer(x, np.int32).reshape(len(unit), -1) for x in row["links"]], row["entry"])

    def nearest(self, query: int, vector: np.ndarray, k: int) -> list[tuple[float, int]]:
        """(-score, id) of the k nearest rows found, other than the query's own."""
        vector = halved(vector[None])[0]
        found = self.graph.search(unit_rows(vector[None])[0], max(EF_SEARCH, 2 * k))
        which = np.concatenate([self.order[self.starts[i] : self.starts[i + 1]] for i in found])
        scores = self.raw[which] @ vector / (self.norms[which] * np.linalg.norm(vector))
        best: list[tuple[float, int]] = []
        for score, v in sorted(zip((-scores).tolist(), which.tolist(), strict=True)):
            if len(best) >= k and score > best[k - 1][0]:
                break
            best += [(score, i) for i in self.ids[(self.ends[v - 1] if v else 0) : self.ends[v]].tolist() if i != query]
        return sorted(best)[:k]


def search_index(index: DataFrame, queries: DataFrame, routes: dict[int, Routes], k: int, blocks: int) -> DataFrame:
    """(query_id, vec_id, score) of up to k rows from each shard that each of (id, dim, vector, hash) asks.

    Where they meet, a shard's row comes first and its queries stream after it.
    """
    blank = {f.name: f.dataType for f in index.schema.fields}
    asked = with_shards(queries, routes, True).select("dim", F.explode("shards").alias("shard"), F.pmod("hash", F.lit(blocks)).cast("int").alias("block"), F.col("id").alias("query"), F.col("vector").alias("asks"))
    asked = asked.select("dim", "shard", "block", "query", "asks", *[F.lit(None).cast(kind).alias(c) for c, kind in blank.items() if c not in ("dim", "shard")])
    parts = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "dim", "shard", "block", F.lit(None).cast("long").alias("query"), F.lit(None).cast("binary").alias("asks"), *[c for c in blank if c not in ("dim", "shard")]
    )
    shards = sum(int(r.splits.sum()) for r in routes.values()) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name = None, None
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            names = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "shard", "block")), strict=True))
            asks = zip(names, batch.column("query").to_pylist(), batch.column("asks").to_pylist(), strict=True)
            for i, (here, query, vector) in enumerate(asks):
                if vector is None:
                    shard, name = Shard(batch.slice(i, 1).to_pylist()[0]), here
                elif here == name:
                    for score, found in shard.nearest(query, np.frombuffer(vector), k):
                        out[0].append(query)
                        out[1].append(found)
                        out[2].append(-score)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    met = parts.unionByName(asked).repartition(shards * blocks, "dim", "shard", "block").sortWithinPartitions("dim", "shard", "block", F.col("query").asc_nulls_first())
    return in_batches(met, work, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for each query row, by cosine.

    Vectors that are null or zero, or hold null or non-finite components, take no part, and vectors of other lengths
    are not compared; rows with null ids take no part.  Ties go to the smaller id.  Of repeated query ids the smallest
    vector answers, and no row of that id is its neighbour.  An empty table gives no rows.
    """
    taken = vectors.filter(usable(vector) & F.col(key).isNotNull())
    rows = taken.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    queries = taken.filter(is_query).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    queries = queries.groupBy("id").agg(F.min("vector").alias("vector"))
    found = written(entries(rows, k + 1), "vectors")
    routes = fit_routes(found, k)
    index = written(build_index(found, routes, k + 1), "graphs")
    asked = written(one_by_one(queries), "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    answers = search_index(index, asked, routes, k, blocks).distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def one_by_one(queries: DataFrame) -> DataFrame:
    """(id, dim, vector, hash) of queries, their vectors as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(np.asarray(v, np.float64) + 0.0).tobytes() for v in batch.column("vector").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(x) // 8 for x in raw], pa.int32()), pa.array(raw, pa.binary()), batch.column("hash")], ["id", "dim", "vector", "hash"])

    return in_batches(queries.withColumn("hash", F.pmod(F.xxhash64("id"), F.lit(1 << 31))), work, "id long, dim int, vector binary, hash long")
