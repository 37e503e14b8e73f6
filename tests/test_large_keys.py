"""Joins whose keys many rows share: the same rows as plain versions, and no join that pairs copies of a text."""

import random

from pyspark.sql import functions as F

from veritab.operators import resolve, revision, workflow


def test_proposals_pair_no_copies(spark):
    n = 20_000
    missing = spark.range(n).select(F.col("id").alias("left_id"), F.lit("a").alias("name"))
    known = spark.range(n).select(F.col("id").alias("right_id"), F.lit("a").alias("name"))
    # 400 million pairs, if they were made
    assert [tuple(r) for r in resolve.proposals(missing, known, lambda c: c).groupBy("matches", "right_id", "proposal").count().collect()] == [(n, 0, "ambiguous", n)]


def test_proposals_of_several_keys(spark):
    random.seed(3)
    missing = [(random.choice([None, *range(8)]), random.choice(["a", "b", "c", "d", None])) for _ in range(30)] + [(50, "z"), (51, None)]
    known = [(random.choice([None, *range(12)]), random.choice(["a", "b", "c", None])) for _ in range(20)]
    got = resolve.proposals(spark.createDataFrame(missing, "left_id long, name string"), spark.createDataFrame(known, "right_id long, name string"), lambda c: c)
    expected = {}
    for left in {m for m, _ in missing}:
        hits = {r for m, n in missing if m == left for r, k in known if n is not None and k == n and r is not None}
        expected[left] = (len(hits), min(hits, default=None), ("no_candidate", "auto_alias")[len(hits)] if len(hits) < 2 else "ambiguous")
    assert {r["left_id"]: (r["matches"], r["right_id"], r["proposal"]) for r in got.collect()} == expected


def test_greedy_codes_of_copies(spark):
    random.seed(4)
    name = lambda: random.choice(["abcd", "abcde", "abcdef", "xabcd", "zz", "zzz", None])
    entities = [(i, name(), random.choice("pq")) for i in range(60)]
    targets = [(100 + i, name(), random.choice("pq"), random.randint(0, 10**6)) for i in range(25)]
    used = [(100 + i,) for i in range(0, 25, 6)]
    got = resolve.greedy_codes(spark.createDataFrame(entities, "entity_id long, name string, region string"), spark.createDataFrame(targets, "code long, name string, region string, position long"), spark.createDataFrame(used, "code long"))
    exact, rows, codes = {}, [], {u for (u,) in used}
    for e, n, region in sorted(entities, key=lambda x: x[0]):
        first = min((t for t in targets if n and t[1:3] == (n, region)), key=lambda t: t[3], default=None)
        if first and first[0] not in codes and first[0] not in exact:
            exact[first[0]] = e
    for e, n, region in entities:
        if e not in exact.values() and n:
            near = [(-min(len(n), len(t[1])) / max(len(n), len(t[1])), t[3], t[0]) for t in targets if t[1] and t[2] == region and (n in t[1] or t[1] in n) and t[0] not in codes and exact.get(t[0], e + 1) > e]
            best = min((x for x in near if x[0] <= -0.6), default=None)
            rows += [(e, best[2], "containment")] if best else []
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows + [(e, c, "exact") for c, e in exact.items()]) and rows and exact


def test_greedy_codes_pair_no_copies(spark):
    n = 8_000
    rows = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, "abcdef").otherwise("abcdefg").alias("name"), F.lit("r").alias("region"))
    entities = rows.filter("id % 2 = 0").withColumnRenamed("id", "entity_id")
    targets = rows.filter("id % 2 = 1").select(F.col("id").alias("code"), "name", "region", F.col("id").alias("position"))
    got = resolve.greedy_codes(entities, targets, spark.createDataFrame([], "code long"))
    # a join of copies would make 16 million pairs, one task's whole sort
    assert {(r["code"], r["tier"]) for r in got.select("code", "tier").distinct().collect()} == {(1, "containment")} and got.count() == n // 2
    assert resolve.containing(entities.select("region", F.col("name").alias("k")), targets.select("region", F.col("name").alias("rk")), "region").count() == 1


def test_unique_containment_of_several_names(spark):
    random.seed(5)
    left = [(i % 30, random.choice("pq"), "".join(random.choices("ab", k=random.randint(1, 4)))) for i in range(40)]
    right = [(i % 15, random.choice("pq"), "".join(random.choices("ab", k=random.randint(1, 6)))) for i in range(18)] + [(99, "p", "abababababab"), (98, "p", "babababab")]
    got = resolve.unique_containment(spark.createDataFrame(left, "left_id long, b string, name string"), spark.createDataFrame(right, "right_id long, b string, name string"), "b", lambda c: c, 2)
    hits = {}
    for i, b, k in left:
        hits.setdefault(i, set()).update(r for r, c, rk in right if b == c and min(len(k), len(rk)) >= 2 and (k in rk or rk in k))
    assert {r["left_id"]: r["right_id"] for r in got.collect()} == {i: min(h) for i, h in hits.items() if len(h) == 1}


def test_held_names_longer_than_runs(spark):
    random.seed(6)
    make = lambda least, most: "".join(random.choices("ab", k=random.randint(least, most)))
    outer = [("x", make(0, 40)) for _ in range(60)] + [("x", "é" * 9), ("x", "c"), ("y", None)]
    inner = [("x", rk[i : i + random.randint(1, 14)]) for _, rk in outer if rk for i in (0, 3)] + [("x", make(7, 11)) for _ in range(20)] + [("x", "c"), ("x", "é" * 8)]
    got = resolve.held_names(spark.createDataFrame(inner, "b string, k string"), spark.createDataFrame(outer, "b string, rk string"), "b")
    assert sorted(tuple(r) for r in got.collect()) == sorted({(b, k, rk) for b, k in inner for c, rk in outer if b == c and k and rk and k in rk and (len(k) > 1 or k == rk)})


def test_unit_aliases_broadcast_nothing(spark):
    missing = spark.createDataFrame([(1, 7, "情報処理学科")], "left_id long, entity_id long, name string")
    plan = resolve.unit_aliases(missing, missing.withColumnRenamed("left_id", "right_id"))._jdf.queryExecution().executedPlan().toString()
    # only the shapes of runs, of which there are SHAPES at most
    assert "SortMergeJoin" in plan and all("LeftSemi" in x for x in plan.splitlines() if "BroadcastHashJoin" in x)


def test_unit_groups_of_alike(spark):
    random.seed(7)
    told = lambda n: [(i % (n - 5), random.choice([None, 1, 2, 3]), [random.choice(["a", "b", "c", None]) for _ in range(random.randint(0, 3))]) for i in range(n)]
    lumped, units = told(40), told(30)
    shape = "long, entity_id long, tracks array<string>"
    groups = resolve.unit_groups(spark.createDataFrame(lumped, f"left_id {shape}"), spark.createDataFrame(units, f"right_id {shape}"))
    hits = {}
    for i, e, tracks in lumped:
        hits.setdefault(i, set()).update(str(r) for r, f, other in units if e is not None and e == f and {*tracks} & {*other} - {None})
    assert {r["left_id"]: r["unit_ids"] for r in groups.collect()} == {i: ",".join(sorted(h)) for i, h in hits.items() if h}
    # units are listed once for those that are alike
    n = 3_000
    alike = spark.range(n).select(F.col("id").alias("left_id"), F.lit(1).alias("entity_id"), F.array(F.lit("a")).alias("tracks"))
    got = resolve.unit_groups(alike, alike.withColumnRenamed("left_id", "right_id"))
    assert got.count() == n and got.select(F.length("unit_ids")).distinct().count() == 1


def test_owner_pages_choose_by_token(spark):
    random.seed(8)
    tails = ["/plan.pdf", "/disclosure", "/top", "", "/Top"]
    pages = [(random.choice("op"), f"https://o.example.com/{random.randint(1, 30)}{random.choice(tails)}") for _ in range(150)] + [("o", None)]
    entity = [(i % 50, random.choice("op"), random.choice([f"/{i}/", f"/{i}", f"example.com/{i}", "1", "2", "", None])) for i in range(60)]
    got = workflow.owner_pages(spark.createDataFrame(entity, "entity_id long, owner string, token string"), spark.createDataFrame(pages, "owner string, url string"))
    rank = {u: tuple(r) for u, *r in spark.createDataFrame([(u,) for _, u in pages if u], "url string").distinct().select("url", F.when(workflow.urls.quality(F.col("url")) == "direct_pdf", 0).when(workflow.urls.quality(F.col("url")) == "disclosure", 1).otherwise(2), F.length("url"), "url").collect()}
    expected = {}
    for i, owner, token in entity:
        for o, u in pages:
            if u and token and o == owner and token in u.lower():
                expected[i] = min(expected.get(i, rank[u]), rank[u])
    assert {r["entity_id"]: r["url"] for r in got.collect()} == {i: b[-1] for i, b in expected.items()}


def test_attached_over_ranges(spark):
    random.seed(9)
    rows = [(sheet, pos, f"n{sheet}-{pos}" if kind == 0 else None, f"v{sheet}-{pos}" if kind == 1 else None) for sheet in (1, 2, None) for pos in range(400) for kind in [random.randint(0, 3)]]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "sheet long, pos long, name string, url string")
    expected, now = [], None
    for sheet, pos, name, url in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        now = None if now and now[0] != sheet else now
        if name:
            now = [sheet, pos, name, None]
            expected.append(now)
        elif url and now and now[3] is None:
            now[3] = url
    for parts in (1, 7, 40):
        got = revision.attached(df, ["sheet"], "pos", "name", "url", parts)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in expected} and got.count() == len(expected)
    # no task sorts a whole sheet
    windows = [x for x in revision.attached(df, ["sheet"], "pos", "name", "url", 7)._jdf.queryExecution().analyzed().toString().splitlines() if "Window [count(name" in x]
    assert windows and all("_part" in x.split("],")[1] for x in windows)
