"""The status table brought up to date equals one built anew."""

import pytest

from veritab.operators import report
from veritab.plans.views import PERIOD, view

INPUTS = ("entity", "site", "document", "fact")


def rows(df):
    return sorted((tuple(str(v) for v in r) for r in df.select(sorted(set(df.columns) - {"part"})).collect()))


@pytest.fixture(scope="module")
def inputs(spark, sf):
    return [view(spark, sf, t) for t in INPUTS]


def test_refresh_equals_rebuild(spark, inputs, tmp_path):
    entity, site, document, fact = inputs
    path = str(tmp_path / "status")
    old = [entity, site.filter("site_id % 3 <> 0"), document.filter("document_id % 4 <> 0"), fact.filter("unit_id % 5 <> 0")]
    report.build_status(path, *old, PERIOD, 8)
    assert rows(spark.read.parquet(path)) == rows(report.status_rows(*old, PERIOD))
    touched = site.filter("site_id % 3 = 0").select("entity_id").unionByName(document.filter("document_id % 4 = 0").select("entity_id")).unionByName(fact.filter("unit_id % 5 = 0").select("entity_id"))
    for _ in range(2):
        report.refresh_status(path, touched, *inputs, PERIOD, 8)
        assert rows(spark.read.parquet(path)) == rows(report.status_rows(*inputs, PERIOD))


def test_untouched_parts_and_entities_that_leave(spark, inputs, tmp_path):
    entity, site, document, fact = inputs
    path = str(tmp_path / "status")
    few = entity.filter("active").limit(5)
    few = spark.createDataFrame(few.collect(), few.schema)
    report.build_status(path, few, site, document, fact, PERIOD, 1000)
    assert report.refresh_status(path, few.select("entity_id").filter("false"), few, site, document, fact, PERIOD, 1000) == 0
    gone = few.limit(1)
    assert report.refresh_status(path, gone.select("entity_id"), few.join(gone, "entity_id", "left_anti"), site, document, fact, PERIOD, 1000) == 1
    assert spark.read.parquet(path).count() == 4
