"""Token counts kept by signed deltas.

A batch holds documents that came, went or were counted anew. Its rows become signed amounts, additive by source,
language and tokenizer version, and are committed under the batch's name: the first commit of a name is the only one,
so a batch that is sent again changes nothing. Amounts are written to a folder of their own, which counts from the
moment that a numbered log entry names it; totals are sums over the folders that the log leaves in place, and a
compaction's entry puts one folder in the place of those that it sums up.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.llm.text import word_array

KEYS = ("source", "lang", "tokenizer")
AMOUNTS = ("documents", "tokens")


def word_tokens(text: Column) -> Column:
    """Tokenizer version words-1: runs of anything but white space."""
    return F.size(word_array(text)).cast("long")


def piece_tokens(text: Column) -> Column:
    """Tokenizer version pieces-1: runs of ASCII letters and digits, and each other character but white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]")), F.lit(0)).cast("long")


def changes(inserted: DataFrame | None = None, deleted: DataFrame | None = None, revised: DataFrame | None = None) -> DataFrame:
    """Signed rows (source, lang, tokenizer, documents, tokens).

    inserted and deleted have source, lang, tokenizer and tokens; revised has old_tokens and tokens, and a revision
    leaves the number of documents as it is. Null tokens count as 0; null keys are keys of their own.
    """
    parts = []
    amount = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    for rows, sign in ((inserted, 1), (deleted, -1)):
        if rows is not None:
            parts.append(rows.select(*KEYS, F.lit(sign).cast("long").alias("documents"), (sign * amount("tokens")).alias("tokens")))
    if revised is not None:
        parts.append(revised.select(*KEYS, F.lit(0).cast("long").alias("documents"), (amount("tokens") - amount("old_tokens")).alias("tokens")))
    if not parts:
        raise ValueError("a batch needs inserted, deleted or revised rows")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class Rollup:
    """A folder of committed batches, in any file system that Spark writes to.

    A log entry appears as a whole under the next free number, or not at all, where the file system renames without
    replacing, as HDFS does. A writer that finds the number taken reads the log again, so several writers can commit; one
    that is lost before its entry leaves a folder that never counts.
    """

    AMOUNT = "source string, lang string, tokenizer string, documents long, tokens long"
    ENTRY = "number long, batch string, added string, removed array<string>"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self) -> tuple[int, set[str], list[str]]:
        """(next number, names of committed batches, folders that count); a row for each commit and compaction."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        log = hadoop.Path(f"{self.path}/log")
        if not log.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(log):
            return 0, set(), []
        entries = sorted(self.spark.read.schema(self.ENTRY).json(f"{self.path}/log").collect(), key=lambda r: r["number"])
        live: dict[str, None] = {}
        for r in entries:
            for f in r["removed"] or ():
                live.pop(f, None)
            live[r["added"]] = None
        return len(entries), {r["batch"] for r in entries if r["batch"] is not None}, list(live)

    def _publish(self, number: int, batch: str | None, added: str, removed: list[str]) -> bool:
        """Whether the entry took its number."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        hadoop = jvm.org.apache.hadoop.fs
        body = json.dumps({"number": number, "batch": batch, "added": added, "removed": removed}).encode()
        draft, entry = (hadoop.Path(f"{self.path}/log/{n}") for n in (f"_{uuid.uuid4().hex}", f"{number:012d}.json"))
        files = draft.getFileSystem(conf)
        out = files.create(draft)
        out.write(bytearray(body))
        out.close()
        draft, entry = files.makeQualified(draft), files.makeQualified(entry)
        options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            hadoop.FileContext.getFileContext(draft.toUri(), conf).rename(draft, entry, options)
        except Py4JJavaError as e:
            files.delete(draft, False)
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            return False
        return True

    def committed(self, batch: str) -> bool:
        return batch in self._log()[1]

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Adds a batch of changes(); False, and nothing done, where a batch of that name is committed already."""
        if not batch or not all(c.isalnum() or c in "-_." for c in batch):
            raise ValueError("a batch's name has letters, digits, - _ and . only")
        if self.committed(batch):
            return False
        folder = self._write(rows.groupBy(*KEYS).agg(*(F.sum(a).alias(a) for a in AMOUNTS)))
        while True:
            number, names, _ = self._log()
            if batch in names:
                return False
            if self._publish(number, batch, folder, []):
                return True

    def compact(self) -> None:
        """Puts one folder in the place of all that count now; what is committed meanwhile stays beside it."""
        while True:
            number, _, live = self._log()
            if len(live) < 2 or self._publish(number, None, self._write(self._sums(live)), live):
                return

    def _write(self, sums: DataFrame) -> str:
        folder = f"data-{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.path}/{folder}")
        return folder

    def _sums(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.AMOUNT)
        rows = self.spark.read.schema(self.AMOUNT).parquet(*(f"{self.path}/{f}" for f in folders))
        return rows.groupBy(*KEYS).agg(*(F.sum(a).alias(a) for a in AMOUNTS))

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, documents, tokens); groups that came to nothing are left out."""
        return self._sums(self._log()[2]).where("documents <> 0 or tokens <> 0")
