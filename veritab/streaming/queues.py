"""Incremental runs as Structured Streaming over files, with availableNow triggers.

A checkpoint takes the place of claim columns and locks: every file is processed once, also after a crash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from veritab.functions import states
from veritab.operators import evidence


def process_new(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """STM-01, STM-03, STM-04: hand every new batch of rows to work, then stop; running it again takes up what is new."""
    query = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


#: What may pass if it is tried again.
TRANSIENT = (OSError, TimeoutError)
STATES = "document_id {kind}, status string, error string, run int, batch long"


def outcomes(documents: DataFrame, parse: Callable[[Any], Any], on: str, transient: tuple[type[Exception], ...] = TRANSIENT) -> DataFrame:
    """STM-01: document_id, status, error and result of each document, each on its own: parse gets the value of the column
    named by on and returns a text, or nothing.

    A document whose parse fails is parse_failed, or transient_error if the failure is one of transient, with what went
    wrong; the others are ingested.  What ends the whole task, a lost executor or a fault of Spark, is no document's
    fault: it fails the batch, which the stream runs again.
    """
    kind = documents.schema["document_id"].dataType.simpleString()

    def one(value: Any) -> tuple[str, str | None, str | None]:
        try:
            result = parse(value)
        except transient as failure:
            return "transient_error", f"{type(failure).__name__}: {failure}"[:500], None
        except Exception as failure:  # noqa: BLE001  any fault of a parser is its document's
            return "parse_failed", f"{type(failure).__name__}: {failure}"[:500], None
        return "ingested", None, result

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = list(zip(*map(one, batch.column(1).to_pylist()), strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string()) for c in told]], ["document_id", "status", "error", "result"])

    return documents.select("document_id", F.col(on).alias("value")).mapInArrow(work, f"document_id {kind}, status string, error string, result string")


def written_batch(rows: DataFrame, path: str, batch: int, run: int = 0) -> None:
    """rows as the part of the table at path that belongs to a run and batch.  A batch that is run again replaces what it
    wrote before, so a crash between writing and committing leaves nothing twice."""
    rows.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch}")


def process_documents(stream: DataFrame, work: Callable[[DataFrame], DataFrame], states_path: str, checkpoint: str) -> StreamingQuery:
    """STM-01, STM-03, STM-04: documents of a stream worked on batch by batch, the state of each kept in a table.

    work takes a batch of (document_id, ...) and returns (document_id, status), and error where there is one, such as
    outcomes gives.  Documents that failed are rows of the table like all others: failed gives them, retry takes up
    those that may pass.
    """
    return process_new(stream, lambda batch, number: written_batch(_told(work(batch)), states_path, number), checkpoint)


def _told(rows: DataFrame) -> DataFrame:
    error = F.col("error") if "error" in rows.columns else F.lit(None).cast("string")
    return rows.select("document_id", "status", error.alias("error"))


def read_states(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """The table of states: document_id, status, error, run, batch."""
    return spark.read.schema(STATES.format(kind=kind)).parquet(path)


def latest_states(states_table: DataFrame) -> DataFrame:
    """The last state of each document."""
    return states_table.groupBy("document_id").agg(F.max_by(F.struct("status", "error"), F.struct("run", "batch")).alias("s")).select("document_id", "s.*")


def retried(documents: DataFrame, states_table: DataFrame) -> DataFrame:
    """Documents whose last state is a transient error."""
    return documents.join(latest_states(states_table).filter("status = 'transient_error'").select("document_id"), "document_id", "left_semi")


def failed(states_table: DataFrame) -> DataFrame:
    """The dead letters: documents whose last state is a failure, with what went wrong."""
    return latest_states(states_table).filter("status IN ('transient_error', 'parse_failed')")


def retry(documents: DataFrame, work: Callable[[DataFrame], DataFrame], states_path: str, run: int) -> None:
    """Work once more on the documents whose last state before this run is a transient error.  A run has its number, from 1;
    the same run again replaces its states."""
    kind = documents.schema["document_id"].dataType.simpleString()
    before = read_states(documents.sparkSession, states_path, kind).filter(F.col("run") < run)
    written_batch(_told(work(retried(documents, before))), states_path, 0, run)


def missing_items(items: DataFrame, queue: DataFrame, key: str) -> DataFrame:
    """STM-02: queue items that are still to be made."""
    return items.join(queue.select(key).distinct(), key, "left_anti").select(key, F.lit("pending").alias("status"))


def ingest_units(annotations: DataFrame, current: DataFrame, target: int) -> DataFrame:
    """UPD-01: units of parsed documents as fact rows with confidence and verdict; only verdicts that may be written.

    annotations: entity_id, document_id, unit_id, name, period, capacity, enrollment, graduates, dropouts; current:
    unit_id, period, enrollment of the same period's previous revision, which is what the sanity factor compares with.
    """
    from veritab.functions import numbers
    from veritab.operators.report import valid_unit

    rows = annotations.filter(valid_unit(F.col("name"), F.col("enrollment"), F.col("period")) & (F.col("period") <= target + 1))
    prior = current.select("unit_id", "period", F.col("enrollment").alias("prior"))
    rows = rows.join(prior, ["unit_id", "period"], "left")
    required = [F.col(c) for c in ("capacity", "enrollment", "graduates", "dropouts")]
    b = numbers.breakdown(numbers.extraction_factor(required), required, F.col("enrollment"), F.col("prior"), "pdf_parse")
    rows = rows.withColumn("breakdown", b).withColumn("verdict", numbers.verdict(F.col("breakdown.composite")))
    return rows.filter(F.col("verdict").isin("auto", "auto_flag"))


def bucket_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """STM-05: entities' evidence buckets over a log that grows: each micro-batch writes the entities that it changed to its
    part of a table; latest_buckets reads it.

    The state is one row of flags for each entity, for ever; evidence_stream forgets.
    """
    rows = evidence.with_flags(evidence.actionable(stream)).groupBy("entity_id").agg(*evidence.bucket_aggregates())
    out = rows.select("entity_id", evidence.bucket_column().alias("bucket"), "rows")
    query = out.writeStream.outputMode("update").foreachBatch(lambda batch, number: written_batch(batch, path, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def latest_buckets(spark: SparkSession, path: str) -> DataFrame:
    """Each entity's bucket by the last batch that changed it."""
    told = spark.read.schema("entity_id long, bucket string, rows long, run int, batch long").parquet(path)
    return told.groupBy("entity_id").agg(F.max_by(F.struct("bucket", "rows"), "batch").alias("b")).select("entity_id", "b.bucket", "b.rows")


STATE_FLAGS = (*evidence.FLAGS, "is_error", "is_tls")
TOTALS = "rows long, " + ", ".join(f"f{i} long" for i in range(len(STATE_FLAGS)))


def advanced(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState, ttl_ms: int) -> Iterator[pd.DataFrame]:
    """What is known of an entity, moved on by new rows: how many rows bear each flag, and the places of rows met, in order,
    eight bytes each.  An entity that was silent for ttl_ms is forgotten, with its rows."""
    if state.hasTimedOut:
        state.remove()
        return
    *totals, known = state.get if state.exists else [0] * (1 + len(STATE_FLAGS)) + [b""]
    met = np.frombuffer(known, np.int64)
    for part in parts:
        places, rows = np.unique(part["position"].to_numpy(np.int64), return_index=True)
        new = ~np.isin(places, met, assume_unique=True)
        flags = part["flags"].to_numpy(np.int64)[rows[new]]
        met = np.union1d(met, places[new])
        totals[0] += len(flags)
        for i in range(len(STATE_FLAGS)):
            totals[1 + i] += int((flags >> i & 1).sum())
    state.update((*totals, met.tobytes()))
    state.setTimeoutDuration(ttl_ms)
    yield pd.DataFrame({"entity_id": [key[0]], "rows": [totals[0]], **{f"f{i}": [n] for i, n in enumerate(totals[1:])}})


def evidence_stream(stream: DataFrame, path: str, checkpoint: str, ttl_ms: int) -> StreamingQuery:
    """STM-05: as bucket_stream, with a state that forgets entities of which nothing is heard for ttl_ms, and in which a row
    that comes again, by its position, counts once: positions number the log's rows from 0.

    Counters are kept, so a busy entity's rows aren't read again, and the places of its rows, so that the state grows with
    the rows and not with entities times the log's length.
    """
    flags = reduce(Column.__add__, [F.col(f).cast("int") * (1 << i) for i, f in enumerate(STATE_FLAGS)])
    rows = evidence.with_flags(evidence.actionable(stream)).select("entity_id", F.col("position").cast("long").alias("position"), flags.alias("flags"))
    move = lambda key, parts, state: advanced(key, parts, state, ttl_ms)
    kept = rows.groupBy("entity_id").applyInPandasWithState(move, f"entity_id long, {TOTALS}", f"{TOTALS}, places binary", "update", GroupStateTimeout.ProcessingTimeTimeout)
    told = {f: F.col(f"f{i}") > 0 for i, f in enumerate(STATE_FLAGS)}
    errors = F.col(f"f{STATE_FLAGS.index('is_error')}")
    bucket = states.evidence_bucket({**{f: told[f] for f in evidence.FLAGS}, "all_errors": errors == F.col("rows"), "any_errors": told["is_error"], "any_tls": told["is_tls"], "any_rows": F.col("rows") > 0})
    out = kept.select("entity_id", bucket.alias("bucket"), "rows")
    query = out.writeStream.outputMode("update").foreachBatch(lambda batch, number: written_batch(batch, path, number)).option("checkpointLocation", checkpoint).start()
    # a state that expires by the clock always has a further batch to run, so the run ends with the first that reads nothing
    while query.isActive and not any(p["numInputRows"] == 0 for p in query.recentProgress):
        query.awaitTermination(1)
    query.stop()
    if query.exception():
        raise query.exception()
    return query


def outbox_stream(actions: DataFrame, path: str, checkpoint: str, key: str = "action_id") -> StreamingQuery:
    """SNK-07: a stream of actions into a log of JSON lines, each action once by its key, the first that comes.

    Keys that were written are state of the stream, so a flush reads no log; the log's own list of batches tells which
    files count, so a batch that is run again after a crash between writing and committing adds nothing.  Null keys are
    one action.
    """
    query = actions.dropDuplicates([key]).writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def throttle(log: DataFrame, least_s: float = 30.0, failures: int = 3, cooldown_s: float = 3600.0) -> DataFrame:
    """STM-06: what a per-host throttle would have decided for each request of a log: (host, at, decision, wait_s).

    log: host, at (seconds), ok, blocked, and request, by which equal times are ordered, if there is such a column; else
    they are ordered by ok and blocked.  A request inside a cooldown is refused and changes nothing; a block, or so
    many failures in a row, starts one.  State passes along each host's requests in time.
    """

    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        last, bad, until, out = float("-inf"), 0, float("-inf"), []
        for r in rows.sort_values(["at", *(c for c in ("request", "ok", "blocked") if c in rows.columns)]).itertuples():
            if until > r.at:
                out.append((key[0], r.at, "cooldown", until - r.at))
                continue
            out.append((key[0], r.at, "ok", max(0.0, least_s - (r.at - last))))
            last = r.at
            if r.ok:
                bad, until = 0, float("-inf")
                continue
            bad = 1 if until > float("-inf") else bad + 1
            if r.blocked or bad >= failures:
                until = r.at + cooldown_s
            else:
                until = float("-inf")
        return pd.DataFrame(out, columns=["host", "at", "decision", "wait_s"])

    return log.groupBy("host").applyInPandas(work, "host string, at double, decision string, wait_s double")


def stale(progress: DataFrame, now: float, after_s: float) -> DataFrame:
    """STM-07: runs that hold their lock and have not reported for too long."""
    return progress.withColumn("stale", F.col("running") & F.coalesce(F.lit(now) - F.col("reported_at") > after_s, F.lit(True)))


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "json", per_trigger: int = 100) -> DataFrame:
    """Files of a folder as a stream, so many in one micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(path)
