"""Queries that SQL cannot express, against plain Python versions on whole tables."""

from collections import defaultdict

from veritab.plans.queries import QUERIES


def test_greedy_unit_match(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").collect()
    sides = {0: defaultdict(list), 1: defaultdict(list)}
    for r in lines:
        unit = (r["l_linenumber"], f"unit{r['l_partkey'] % 4}", r["l_returnflag"], r["l_quantity"] % 3)
        sides[r["l_linenumber"] % 2][r["l_orderkey"]].append(unit)
    expected = []
    for doc, gold in sides[1].items():
        free = sorted(sides[0].get(doc, []))
        for pos, name, shift, years in sorted(gold):
            held = [u for u in free if name in u[1] or u[1] in name]
            best = next((u for u in held if u[2:] == (shift, years)), held[0] if held else None)
            if best:
                free = [u for u in free if u[0] != best[0]]
                expected.append((doc, pos, best[0]))
    got = sorted((r["doc_id"], r["gold_pos"], r["parsed_pos"]) for r in QUERIES["greedy_unit_match"](spark, sf).collect())
    assert got == sorted(expected) and got


def test_throttle_replay(spark, sf):
    from pyspark.sql import functions as F

    rows = spark.read.parquet(f"{sf}/events.parquet").select((F.col("user_id") % 20).cast("string").alias("host"), (F.unix_timestamp(F.col("ts").cast("timestamp")) / 600).alias("at"), "event_type", "event_id").collect()
    by_host = defaultdict(list)
    for r in rows:
        by_host[r["host"]].append((float(r["at"]), r["event_type"] != "error", r["event_id"] % 17 == 0))
    expected = []
    for host, requests in by_host.items():
        free_at, last, failures = float("-inf"), float("-inf"), 0
        after_cooldown = False
        for at, ok, blocked in sorted(requests):
            if at < free_at:
                expected.append((host, at, "cooldown", free_at - at))
                continue
            after_cooldown = free_at > float("-inf")
            expected.append((host, at, "ok", max(0.0, 30.0 - (at - last))))
            last = at
            if ok:
                failures, free_at = 0, float("-inf")
                continue
            failures = 1 if after_cooldown else failures + 1
            free_at = at + 3600.0 if blocked or failures >= 3 else float("-inf")
    got = sorted(tuple(r) for r in QUERIES["throttle_replay"](spark, sf).collect())
    assert got == sorted(expected) and {x[2] for x in got} == {"ok", "cooldown"}
