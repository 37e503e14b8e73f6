"""Queues of documents: each on its own, states exactly once, and evidence whose state is forgotten."""

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException

from veritab.streaming import queues


def parser():
    # a function of a test module could not be found by workers
    def parse(text):
        if text == "bad":
            raise ValueError("no table")
        if text == "late":
            raise TimeoutError("slow")
        return None if text is None else text.upper()

    return parse


parse = parser()


def test_one_failure_leaves_the_others(spark):
    docs = spark.range(1000).selectExpr("id AS document_id", "IF(id = 617, 'bad', 'good') AS text", "'mine' AS status", "'mine' AS value").repartition(3)
    rows = queues.outcomes(docs, parse, "text").collect()
    assert sorted(r["status"] for r in rows) == ["ingested"] * 999 + ["parse_failed"]
    assert [(r["document_id"], r["error"], r["result"]) for r in rows if r["error"]] == [(617, "ValueError: no table", None)]
    assert queues.outcomes(docs.filter("false"), parse, "text").count() == 0


def test_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(None, None), (1, "a"), (1, "a"), (2, "late")], "document_id long, text string")
    got = sorted(((r["document_id"] or 0, r["status"], r["result"]) for r in queues.outcomes(docs, parse, "text").collect()), key=str)
    assert got == [(0, "ingested", None), (1, "ingested", "A"), (1, "ingested", "A"), (2, "transient_error", None)]


def test_replay_adds_no_row(spark, tmp_path):
    source, told, progress = (str(tmp_path / n) for n in ("in", "states", "progress"))
    stream = lambda: spark.readStream.schema("document_id long, text string").parquet(source)
    spark.createDataFrame([(1, "a"), (2, "bad"), (3, "late")], "document_id long, text string").write.parquet(source)

    def crashes(batch, number):
        queues.written_batch(queues.outcomes(batch, parse, "text").select("document_id", "status", "error"), told, number)
        raise RuntimeError("lost before the commit")

    with pytest.raises(StreamingQueryException):
        queues.process_new(stream(), crashes, progress)
    work = lambda batch: queues.outcomes(batch, parse, "text")
    queues.process_documents(stream(), work, told, progress)
    states = lambda: sorted((r["document_id"], r["status"], r["run"], r["batch"]) for r in queues.read_states(spark, told).collect())
    first = [(1, "ingested", 0, 0), (2, "parse_failed", 0, 0), (3, "transient_error", 0, 0)]
    assert states() == first
    spark.createDataFrame([(4, "b")], "document_id long, text string").write.mode("append").parquet(source)
    queues.process_documents(stream(), work, told, progress)
    assert states() == [*first, (4, "ingested", 0, 1)]
    assert [r["document_id"] for r in queues.failed(queues.read_states(spark, told)).orderBy("document_id").collect()] == [2, 3]
    documents = spark.read.schema("document_id long, text string").parquet(source)
    for _ in range(2):
        # the same run again replaces what it wrote
        queues.retry(documents, lambda rows: queues.outcomes(rows, str.lower, "text"), told, 1)
    assert states() == [*first[:2], (3, "ingested", 1, 0), first[2], (4, "ingested", 0, 1)]
    assert {r["document_id"]: r["status"] for r in queues.latest_states(queues.read_states(spark, told)).collect()}[3] == "ingested"


def test_faults_of_the_job_end_it(spark, tmp_path):
    spark.range(3).selectExpr("id AS document_id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("document_id long").parquet(str(tmp_path / "in"))
    with pytest.raises(StreamingQueryException):
        queues.process_documents(stream, lambda batch: batch.selectExpr("no_such_column"), str(tmp_path / "states"), str(tmp_path / "progress"))
    assert not (tmp_path / "states").exists()


class State:
    def __init__(self):
        self.value, self.hasTimedOut, self.timeout = None, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):  # noqa: N802
        self.timeout = ms


def test_state_counts_once_and_is_forgotten():
    state = State()
    step = lambda *rows: [tuple(r) for p in queues.advanced((7,), iter([pd.DataFrame(rows, columns=["position", "flags"])] * 2), state, 1000) for r in p[["rows", "f0", "f1"]].to_numpy()]
    assert step((0, 1), (9000, 2), (0, 1)) == [(2, 1, 1)]
    assert step((9000, 2), (1, 3)) == [(3, 2, 2)] and state.timeout == 1000
    state.hasTimedOut = True
    assert list(queues.advanced((7,), iter([]), state, 1000)) == [] and not state.exists
    state.hasTimedOut = False
    assert step((1, 3)) == [(1, 1, 1)]


def test_outbox_after_a_crash(spark, tmp_path):
    source, path, progress = (str(tmp_path / n) for n in ("in", "log", "progress"))
    flush = lambda: queues.outbox_stream(spark.readStream.schema("action_id string, note string").parquet(source), path, progress)
    held = lambda: sorted(r["action_id"] or "" for r in spark.read.schema("action_id string, note string").json(path).collect())
    spark.createDataFrame([("a", "1"), ("a", "2"), (None, "3")], "action_id string, note string").write.parquet(source)
    flush()
    assert held() == ["", "a"]
    # the log was written, the commit of its batch was not
    (last,) = sorted(p for p in (tmp_path / "progress" / "commits").iterdir() if p.name.isdigit())[-1:]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    spark.createDataFrame([("b", "1"), ("a", "4"), (None, "5")], "action_id string, note string").write.mode("append").parquet(source)
    flush()
    flush()
    assert held() == ["", "a", "b"]
