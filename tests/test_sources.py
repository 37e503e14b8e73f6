"""Readers and sinks on files that the tests write."""

import json
import zipfile

from pyspark.sql import functions as F

from veritab.operators import diff, export, records, resolve, revision
from veritab.sources import files
from veritab.streaming import queues


def test_spreadsheet_round_trip(spark, tmp_path):
    path = tmp_path / "book.xlsx"
    path.write_bytes(export.workbook({"One": (["name", "n"], [["a & b", 1], [None, 2.5]]), "Two": (["x"], [["東京"]])}))
    rows = {(r["sheet"], r["row"]): r["cells"] for r in files.spreadsheet(spark, str(path)).collect()}
    assert rows == {("One", 1): ["name", "n"], ("One", 2): ["a & b", "1"], ("One", 3): [None, "2.5"], ("Two", 1): ["x"], ("Two", 2): ["東京"]}


def test_csv_with_fallback(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("名前,値\n東京,1\n".encode("cp932"))
    (tmp_path / "b.csv").write_bytes("﻿名前,値\n大阪,2\n".encode())
    got = sorted(r["cells"]["名前"] for r in files.csv_with_fallback(spark, str(tmp_path / "*.csv")).collect())
    assert got == ["大阪", "東京"]


def test_code_list(spark, tmp_path):
    (tmp_path / "codes.csv").write_bytes("code,type,region,name,address,ended\n1,H1(x),01(青森),甲,a,\n2,H2,01(青森),乙,a,\n3,H1,01(青森),丙,a,2020\n".encode("cp932"))
    assert [r["name"] for r in files.code_list(spark, str(tmp_path / "codes.csv")).collect()] == ["甲"]


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/1.PDF", b"one")
        z.writestr("notes.txt", b"no")
    (tmp_path / "broken.zip").write_bytes(b"nothing")
    assert [(r["member"], bytes(r["content"])) for r in files.zip_members(spark, str(tmp_path / "*.zip")).collect()] == [("x/1.PDF", b"one")]


def test_ocr_words(spark):
    tsv = "level\tpage\tblock\tpar\tline\tword\tl\tt\tw\th\tconf\ttext\n5\t1\t1\t1\t1\t1\t0\t0\t0\t0\t90\tHello\n5\t1\t1\t1\t1\t2\t0\t0\t0\t0\t\tthere\n4\t1\t1\t1\t1\t0\t0\t0\t0\t0\t-1\t\n5\tx\t1\t1\t2\t1\t0\t0\t0\t0\t50\tbad"
    row = files.ocr_words(spark.createDataFrame([(1, tsv)], "doc long, tsv string")).collect()
    assert [(r["text"], r["confidences"]) for r in row] == [("Hello there", [90.0, -1.0])]


def test_html_tables(spark):
    html = "<table><tr><th>No</th><th>学校名</th></tr><tr><td>1</td><td><a href='/a.pdf'>甲</a></td></tr><tr><td>1</td><td><a href='/a.pdf'>甲</a></td></tr></table>"
    cells = files.html_tables(spark.createDataFrame([(1, "http://e.com/x/", html), (2, None, None)], "page_id long, url string, html string"))
    assert [(r["name"], r["href"]) for r in files.index_rows(cells).collect()] == [("甲", "http://e.com/a.pdf")]


def test_sitemap(spark):
    df = spark.createDataFrame([("<urlset><url><loc> http://a/1 </loc></url></urlset>",), ("User-agent: *\nSitemap: http://a/s.xml",)], "xml string")
    assert sorted(r["url"] for r in files.sitemap_locations(df).collect()) == ["http://a/1", "http://a/s.xml"]


def test_gold_files(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"entry_id": "e1", "school": {"school_id": 3, "school_name": "n"}, "target_fiscal_year": 2026, "outcome": "accepted", "expected_result": {"pdf_url": "u"}}, indent=1))
    (tmp_path / "p.jsonl").write_text('{"entry_id": "e1", "outcome": "accepted"}\nnot json\n')
    assert files.gold_entries(spark, str(tmp_path / "e.json")).first()["entity_id"] == 3
    assert files.predictions(spark, str(tmp_path / "p.jsonl")).count() == 1


def test_outbox_writes_once(spark, tmp_path):
    actions = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "action_id string, n long")
    path = str(tmp_path / "log")
    assert [export.flush_outbox(actions, path) for _ in range(2)] == [2, 0]
    assert spark.read.json(path).count() == 2


def test_incremental_run(spark, tmp_path):
    seen = []
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"id": 1}\n')
    run = lambda: queues.process_new(queues.file_stream(spark, str(tmp_path / "in"), "id long"), lambda df, n: seen.extend(r["id"] for r in df.collect()), str(tmp_path / "cp"))
    run()
    (tmp_path / "in" / "2.json").write_text('{"id": 2}\n')
    run()
    run()
    assert seen == [1, 2]


def test_throttle(spark):
    log = spark.createDataFrame([("h", 0.0, True, False), ("h", 10.0, False, True), ("h", 20.0, True, False), ("h", 4000.0, True, False)], "host string, at double, ok boolean, blocked boolean")
    got = [(r["decision"], r["wait_s"]) for r in queues.throttle(log).orderBy("at").collect()]
    assert got == [("ok", 0.0), ("ok", 20.0), ("cooldown", 3590.0), ("ok", 0.0)]


def test_grid_records(spark):
    grid = [["学科名", "生徒総定員", "生徒実員"], ["情報科", "８０", "76人"], ["", "1", "2"]]
    df = spark.createDataFrame([(1, 1, 0, grid)], "doc_id long, page int, table_index int, grid array<array<string>>")
    assert {(r["unit"], r["metric"], r["value"]) for r in records.grid_records(df).collect()} == {("情報科", "capacity", 80), ("情報科", "enrollment", 76)}


def test_period_blocks(spark):
    df = spark.createDataFrame([("u", "10", "9", None, None, "x", "7")], "unit string, c0 string, c1 string, c2 string, c3 string, c4 string, c5 string")
    got = records.period_blocks(df, ["unit"], {2019: 0, 2020: 2, 2021: 4}, ["capacity", "enrollment"]).collect()
    assert [(r["period"], r["capacity"], r["enrollment"]) for r in got] == [(2019, 10, 9), (2021, None, 7)]


def test_ambiguity_is_refused(spark):
    rows = lambda values: spark.createDataFrame(values, "entity long, metric string, value double")
    got = {r["entity"]: r["category"] for r in diff.five_way(rows([(1, "m", None), (2, "m", 1.0), (2, "m", 1.0), (3, "m", 1.0)]), rows([(1, "m", None), (2, "m", 1.0), (4, "m", 1.0)]), ["entity", "metric"]).collect()}
    assert got == {1: "exact_match", 2: "ambiguous_key", 3: "missing_actual", 4: "unexpected_actual"}


def test_course_track_is_not_its_parent(spark):
    key = ("甲", None, "ビジネスコース", 2026, "capacity")
    reviewed = spark.createDataFrame([(*key, 1, "accepted", "10")], "entity string, category string, unit string, period int, metric string, review_id long, review_status string, final_value string")
    other = spark.createDataFrame([("甲", None, "ビジネス科", 2026, "capacity", 5, "10")], "entity string, category string, unit string, period int, metric string, source_row long, value string")
    assert [r["status"] for r in diff.compare_external(reviewed, other).collect()] == ["ambiguous_key_not_comparable"]
    assert [r["status"] for r in diff.diff_master(reviewed, other).collect()] == ["ambiguous_key"]


def test_order_does_not_matter(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("p"), "o_orderstatus")
    one, other = (revision.latest(x, ["k"], ["p"]) for x in (o, o.orderBy(F.xxhash64("p"))))
    assert one.exceptAll(other).count() == 0


def test_greedy_codes_follow_the_loop(spark):
    import random

    random.seed(1)
    for _ in range(3):
        entities = [(i, "n" * random.randint(1, 5), random.choice("xy")) for i in range(12)]
        targets = [(i, "n" * random.randint(1, 5), random.choice("xy"), i) for i in range(10)]
        expected, used = {}, set()
        for i, name, region in entities:
            first = next((c for c, n, r, _ in targets if (n, r) == (name, region)), None)
            if first is not None and first not in used:
                expected[i] = (first, "exact")
                used.add(first)
                continue
            scored = [(min(len(n), len(name)) / max(len(n), len(name)), -c) for c, n, r, _ in targets if r == region and c not in used and (n in name or name in n)]
            if scored and max(scored)[0] >= 0.6:
                expected[i] = (-max(scored)[1], "containment")
        got = resolve.greedy_codes(spark.createDataFrame(entities, "entity_id long, name string, region string"), spark.createDataFrame(targets, "code long, name string, region string, position long"), spark.createDataFrame([], "code long"))
        assert {r["entity_id"]: (r["code"], r["tier"]) for r in got.collect()} == expected
