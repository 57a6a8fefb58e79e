"""Streaming operators of the lookup service: client counters, rates and the request allowance."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from arbora.functions.constants import COUNTERS, HEADER_BYTES, MOST_COUNT, MOST_LOAD_MS

RATE, BURST, IDLE_S = 8.0, 40.0, 300


def counter_totals(reports: DataFrame) -> DataFrame:
    """Sums of the counters k=v,k=v in the column header; works on a stream and on a table alike."""
    pair = F.explode(F.split("header", ",")).alias("pair")
    rows = reports.select(pair).select(F.split("pair", "=")[0].alias("k"), F.expr("try_cast(split(pair, '=')[1] as long)").alias("v"))
    return rows.where("k <> '' and v is not null").groupBy("k").agg(F.sum("v").alias("total"))


def strict_reports(reports: DataFrame) -> DataFrame:
    """reports with `accepted`, and `counts`, a map of the header's known counters, null where it is refused.

    A header is k=v,k=v with whole numbers of up to nine digits. One that is empty, too long, has an empty key, a known
    key twice, a count over its limit, or more slow waits than waits is refused as a whole; unknown keys are skipped.
    """
    pairs = F.transform(F.split("header", ",", -1), lambda x: F.struct(F.regexp_extract(x, "^([^=]*)=", 1).alias("k"), F.regexp_extract(x, "^[^=]*=([0-9]{1,9})$", 1).alias("v")))
    known = F.filter(F.col("pairs"), lambda x: x["k"].isin(COUNTERS))
    most = lambda x: F.when(x["k"] == "pl", MOST_LOAD_MS).otherwise(MOST_COUNT)
    fine = (F.length("header") > 0) & (F.octet_length("header") <= HEADER_BYTES) & F.forall("pairs", lambda x: (x["k"] != "") & (x["v"] != ""))
    fine &= F.size(known) == F.size(F.array_distinct(F.transform(known, lambda x: x["k"])))
    fine &= F.forall(known, lambda x: x["v"].try_cast("long") <= most(x))
    of = lambda k: F.coalesce(F.get(F.filter(known, lambda x: x["k"] == k), F.lit(0))["v"].try_cast("long"), F.lit(0))
    rows = reports.withColumn("pairs", pairs).withColumn("accepted", F.coalesce(fine & (of("ws") <= of("wn")), F.lit(False)))
    counts = F.when(F.col("accepted"), F.map_from_entries(F.transform(known, lambda x: F.struct(x["k"], x["v"].cast("long")))))
    return rows.withColumn("counts", counts).drop("pairs")


def strict_totals(reports: DataFrame) -> DataFrame:
    """(k, total) over the counters of accepted headers; works on a stream and on a table alike."""
    return strict_reports(reports).where("accepted").select(F.explode("counts").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("total"))


def _fs(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _log(spark: SparkSession, folder: str, batch: int) -> None:
    fs, path = _fs(spark, f"{folder}/log/{batch}")
    fs.mkdirs(path)


def ingest(reports: DataFrame, folder: str, checkpoint: str):
    """Starts a stream that adds the counters of accepted reports to a folder, each batch once.

    A batch's sums go to a folder named after it, which a repeated batch writes anew, and count from the moment at which
    the batch is in the log; a batch in the log is passed over. So a failure between any two steps adds nothing twice and
    loses nothing, and a report that is refused adds nothing at all.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fs, path = _fs(spark, f"{folder}/log/{number}")
        if not fs.exists(path):
            strict_totals(batch).write.mode("overwrite").parquet(f"{folder}/counts/{number}")
            _log(spark, folder, number)

    return reports.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingested(spark: SparkSession, folder: str) -> DataFrame:
    """(k, total) over the batches in the log."""
    fs, path = _fs(spark, f"{folder}/log")
    batches = [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []
    if not batches:
        return spark.createDataFrame([], "k string, total long")
    return spark.read.schema("k string, total long").parquet(*(f"{folder}/counts/{b}" for b in batches)).groupBy("k").agg(F.sum("total").alias("total"))


def spend(tokens: float, seen: float, now: float) -> tuple[float, bool, float]:
    """(tokens left, allowed, seconds to wait) of a request at `now` against a bucket last seen at `seen`."""
    tokens = min(BURST, tokens + max(0.0, now - seen) * RATE)
    return (tokens - 1, True, 0.0) if tokens >= 1 else (tokens, False, (1 - tokens) / RATE)


def allowances(requests: DataFrame) -> DataFrame:
    """(client, at, allowed, retry_after) of a stream of requests (client, at in seconds); idle clients are forgotten."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        tokens, seen = state.get if state.exists else (BURST, None)
        out = []
        for at in sorted(x for batch in batches for x in batch["at"]):  # what came since the last trigger
            tokens, allowed, wait = spend(tokens, at if seen is None else seen, at)
            seen = at
            out.append((key[0], at, allowed, wait))
        yield pd.DataFrame(out, columns=["client", "at", "allowed", "retry_after"])
        state.update((tokens, seen))
        state.setTimeoutDuration(IDLE_S * 1000)

    return requests.groupBy("client").applyInPandasWithState(run, "client string, at double, allowed boolean, retry_after double", "tokens double, seen double", "append", GroupStateTimeout.ProcessingTimeTimeout)


DECISIONS = "client string, at double, allowed boolean, retry_after double"


class _InOrder(StatefulProcessor):
    """Holds a client's requests, by the millisecond that they are over, until the watermark says that none before is missing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ms long", "times array<double>")
        self.bucket = handle.getValueState("bucket", "tokens double, seen double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came: dict[int, list[float]] = {}
        for part in rows:
            for at in part["at"].tolist():
                came.setdefault(math.ceil(at * 1000), []).append(at)
        for ms, times in came.items():
            known = list(self.waiting.getValue((ms,))[0]) if self.waiting.containsKey((ms,)) else None
            self.waiting.updateValue((ms,), ((known or []) + times,))
            if known is None:
                self.handle.registerTimer(ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ms, out = expiredTimerInfo.getExpiryTimeInMs(), []
        tokens, seen = self.bucket.get() if self.bucket.exists() else (BURST, None)
        if self.waiting.containsKey((ms,)):
            over = sorted(k for (k,) in self.waiting.keys() if k <= timerValues.getCurrentWatermarkInMs())
            for k in over:
                for at in sorted(self.waiting.getValue((k,))[0]):
                    tokens, allowed, wait = spend(tokens, at if seen is None else seen, at)
                    seen = at
                    out.append((key[0], at, allowed, wait))
                self.waiting.removeKey((k,))
            self.bucket.update((tokens, seen))
            self.handle.registerTimer(over[-1] + IDLE_S * 1000)
        elif seen is not None and ms >= math.ceil(seen * 1000) + IDLE_S * 1000:
            self.bucket.clear()  # full again by now
        if out:
            # text as objects: an Arrow-backed column would come as chunks
            yield pd.DataFrame(out, columns=["client", "at", "allowed", "retry_after"]).astype({"client": object})

    def close(self) -> None:
        pass


def ordered_allowances(requests: DataFrame, late: str = "10 seconds") -> DataFrame:
    """(client, at, allowed, retry_after) of a stream of requests (client, at in seconds), decided in the order of `at`.

    A decision comes once the watermark, `late` behind the latest request of all clients, has passed; so requests may
    come in any order over triggers, and the decisions are those of replayed(). What comes later than that has no
    decision, as with any watermark. Clients without a request for IDLE_S of the stream's own time are forgotten by a
    timer. Null clients and times are left out. The session has to keep its streams' state in RocksDB.
    """
    rows = requests.selectExpr("cast(client as string) client", "cast(at as double) at").where("client is not null and at is not null")
    rows = rows.withColumn("time", F.timestamp_micros((F.col("at") * 1e6).cast("long"))).withWatermark("time", late)
    return rows.groupBy("client").transformWithStateInPandas(_InOrder(), DECISIONS, "Append", "EventTime")


def replayed(requests: DataFrame) -> DataFrame:
    """(client, at, allowed, retry_after) of a table of requests (client, at in seconds), as allowances() decides them.

    Requests stream through each task in order, so of a client only its tokens are held. A client that was idle for
    IDLE_S starts anew, with a full allowance as it has by then.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, tokens, seen = None, BURST, None
        for part in parts:
            out = []
            for c, at in zip(part["client"], part["at"], strict=True):
                if c != client:
                    client, tokens, seen = c, BURST, None
                tokens, allowed, wait = spend(tokens, at if seen is None else seen, at)
                seen = at
                out.append((c, at, allowed, wait))
            yield pd.DataFrame(out, columns=["client", "at", "allowed", "retry_after"])

    rows = requests.selectExpr("cast(client as string) client", "cast(at as double) at").where("client is not null and at is not null")
    return rows.repartition("client").sortWithinPartitions("client", "at").mapInPandas(run, "client string, at double, allowed boolean, retry_after double")
