"""Many words at once, and texts held by others."""

import random

from pyspark.sql import functions as F

from veritab.functions.words import first_word
from veritab.operators.resolve import held_texts


def test_first_word_of_the_list(spark):
    random.seed(1)
    words = ["bc", "a", "", "abc", "ca", "a", "財務", "務諸"]
    texts = [None, "", "財務諸表", *["".join(random.choices("abcd", k=random.randint(0, 6))) for _ in range(60)], "d" * 100_000 + "ca"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["w"] for r in df.select("i", first_word(F.col("t"), words).alias("w")).collect()}
    assert got == {i: None if t is None else next((n for n, w in enumerate(words) if w and w in t), None) for i, t in enumerate(texts)}
    assert {r["w"] for r in df.select(first_word(F.col("t"), []).alias("w")).collect()} == {None}


def test_held_texts(spark):
    random.seed(2)
    inner = [(i, random.choice("xy"), "".join(random.choices("ab", k=random.randint(2, 4)))) for i in range(40)] + [(90, "x", None), (91, "x", "")]
    outer = [(i, random.choice("xyz"), "".join(random.choices("ab", k=random.randint(0, 6)))) for i in range(40)] + [(92, "x", None)]
    got = held_texts(spark.createDataFrame(inner, "inner_id long, b string, k string"), spark.createDataFrame(outer, "outer_id long, b string, rk string"), "b")
    assert sorted((r["inner_id"], r["outer_id"]) for r in got.collect()) == sorted((i, o) for i, b, k in inner for o, c, rk in outer if b == c and k and rk and k in rk)


def test_unit_aliases(spark):
    from veritab.operators.resolve import unit_aliases

    known = [(1, 7, "情報処理科"), (2, 7, "情報処理応用科"), (3, 7, "コンピュータ専攻"), (4, 7, "看護"), (5, 8, "情報処理学科"), (6, 7, None), (7, 7, "情報 処理科")]
    missing = [(10, 7, "情報処理学科"), (11, 7, "情報処理"), (12, 7, "コンピューター専攻"), (13, 7, "看護学科"), (14, 7, "看護科"), (15, 9, "情報処理科"), (16, 7, None), (17, 7, "")]
    got = unit_aliases(spark.createDataFrame(missing, "left_id long, entity_id long, name string"), spark.createDataFrame(known, "right_id long, entity_id long, name string"))
    assert sorted(tuple(r) for r in got.collect()) == [(10, 1, "suffix"), (10, 7, "suffix"), (11, 1, "part"), (11, 2, "part"), (11, 7, "part"), (12, 3, "kana"), (13, 4, "part"), (14, 4, "part")]
