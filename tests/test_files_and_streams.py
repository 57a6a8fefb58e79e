"""Bucketed merges, running totals over ranges, and counters that a restart neither loses nor repeats."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from arbora.operators import tally
from arbora.plans import policies, solving
from arbora.sources import flags, tallies
from arbora.streaming import service
from tests.test_components import EDGES, made
from tests.test_journeys import SF, rows


def test_bucketed_months_merge_without_a_shuffle(spark, tmp_path):
    links = {(f"n{i}", f"n{i * 7 % 60}") for i in range(60)}
    months = [spark.createDataFrame(made(set(sorted(links)[k : k + 40]), k), EDGES) for k in (0, 10)]
    months[1] = months[1].union(spark.createDataFrame([("n99", "w", "x", None, 1, 4, 0, 0)], EDGES))
    names = [f"month_{uuid.uuid4().hex}" for _ in months]
    for k, (name, month) in enumerate(zip(names, months, strict=True)):
        tallies.write_bucketed(month, name, 5, f"{tmp_path}/{k}")
    found = tallies.merge_bucketed(spark, *names, 5)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    want = tally.merge(months, 5)
    assert "n99" not in {r.node for r in found.collect()}
    assert rows(found.columns, map(tuple, found.collect())) == rows(want.columns, map(tuple, want.collect()))
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_running_total_over_ranges(spark):
    data = [(i * 37 % 101, chr(97 + i % 5), i % 4) for i in range(400)]
    found = tallies.running_total(spark.createDataFrame(data, "a long, b string, v long").distinct(), ["a", "b", "v"], "v", "before")
    total = 0
    for r in sorted(map(tuple, found.select("a", "b", "v", "before").collect())):
        assert r[3] == total
        total += r[2]


def test_subtree_nodes_still_equal_duckdb(spark):
    import duckdb

    from arbora.plans import queries as q

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    for module, name in ((policies, "subtree_nodes"), (solving, "merge_months_bucketed")):
        cur = con.execute(q.SQL[name])
        got = getattr(module, name)(spark, SF)
        assert rows(got.columns, map(tuple, got.collect())) == rows([c[0] for c in cur.description], cur.fetchall())


@pytest.mark.parametrize("step", ["before", "after"])
def test_a_restart_counts_each_report_once(spark, tmp_path, monkeypatch, step):
    reports = [["wn=3,ws=1", "wn=2,ws=5", "ch=7"], ["ch=1,ch=2", "ch=4", None], ["pl=100", "zz=9"]]
    source = str(tmp_path / "in")
    for part in reports:
        spark.createDataFrame([(x,) for x in part], "header string").coalesce(1).write.mode("append").parquet(source)
    stream = lambda: service.ingest(spark.readStream.schema("header string").option("maxFilesPerTrigger", 1).parquet(source), str(tmp_path / "out"), str(tmp_path / "points"))
    whole, fails = service._log, [1]

    def log(spark, folder, batch):
        if step == "after":
            whole(spark, folder, batch)
        if batch in fails:
            fails.remove(batch)
            raise RuntimeError("lost")
        whole(spark, folder, batch)

    monkeypatch.setattr(service, "_log", log)
    assert service.ingested(spark, str(tmp_path / "out")).count() == 0
    with pytest.raises(Exception, match="lost"):
        stream().awaitTermination()
    stream().awaitTermination()
    stream().awaitTermination()
    got = {r.k: r.total for r in service.ingested(spark, str(tmp_path / "out")).collect()}
    assert got == {"wn": 3, "ws": 1, "ch": 11, "pl": 100}
    assert got == {r.k: r.total for r in service.strict_totals(spark.read.parquet(source)).where(F.col("total").isNotNull()).collect()}


def test_flagged_lists_number_lines_across_splits(spark, tmp_path):
    rng = random.Random(3)
    texts = {f"{k}.txt": [rng.choice(["", "# note", "w:r | a | why", "w:r | a", f"w:r | b | {'x' * rng.randint(0, 90)} | #"]) for _ in range(rng.randint(1, 60))] for k in range(4)}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n" * (name != "2.txt"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        got = {(r.file.rpartition("/")[2], r.line): r.value for r in flags.numbered_lines(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {(name, i + 1): x for name, lines in texts.items() for i, x in enumerate(lines)}
    if texts["2.txt"][-1] == "":  # no line follows the last end of a line
        del want["2.txt", len(texts["2.txt"])]
    assert got == want


def test_all_errors_of_a_list_are_told(spark, tmp_path):
    (tmp_path / "list").write_text("# list\nw:r | a | thin | really #1\n\nw:r | a\nw:r | a | \nw:q | a | no\nw:r | a b | two\nw:r | z | no\n\tw:r |a| again\n")
    edges = spark.createDataFrame([("w:r", "a")], "node string, move string")
    lines = flags.numbered_lines(spark, str(tmp_path / "list"))
    found = {r.line: r.error for r in flags.flagged_list(lines, edges).collect()}
    assert found == {2: None, 4: "expected three fields parted by |", 5: "the reason is empty", 6: "no such node", 7: "the middle field must name one move", 8: "no such move", 9: "already flagged"}
    with pytest.raises(ValueError, match=r"(?s)6 lines are wrong.*list:4: expected.*list:9: already"):
        flags.sound(flags.flagged_list(lines, edges))
    assert [tuple(r) for r in flags.sound(flags.flagged_list(lines.where("line < 4"))).collect()] == [("w:r", "a", "thin | really #1")]
    assert flags.flagged_list(lines.where("false"), edges).count() == 0


def test_requests_in_any_order_are_decided_as_in_a_table(spark, tmp_path):
    rng = random.Random(8)
    times = [("a", round(100 + rng.random() * 4, 4)) for _ in range(120)] + [("b", 101.0)] * 45 + [("b", 103.0), ("c", 100.5), (None, 100.0)]
    again = [("b", 900.0), ("b", 900.0), ("a", 901.0)]  # after the timers of idle clients
    want = service.replayed(spark.createDataFrame(times + again, "client string, at double"))
    key = lambda r: (r[0], r[1], not r[2], r[3])
    want = sorted(map(tuple, want.collect()), key=key)
    rng.shuffle(times)
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for k, part in enumerate([times[:60], times[60:110], times[110:], [("z", 400.0)], again, [("z", 2000.0)]]):  # one trigger each
            spark.createDataFrame(part, "client string, at double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = service.ordered_allowances(spark.readStream.schema("client string, at double").parquet(f"{tmp_path}/in"))
            run = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
            assert run.awaitTermination(120)
            if k == 2:  # nothing is decided before its time
                assert spark.read.parquet(f"{tmp_path}/out").count() == 0
    finally:
        spark.conf.unset(provider)
    got = sorted((tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect() if r.client != "z"), key=key)
    assert got == want and sum(not r[2] for r in got) > 10


def test_shards_of_ids_whose_product_does_not_fit(spark):
    factor, ids = 92233720368547, [0, 1, 99_999, 100_000, 100_001, 6_000_000, 2**62, -1]
    got = spark.createDataFrame([(x,) for x in ids], "id long").select(tallies.product64(F.col("id"), factor).alias("p")).select("p", tallies.shard(F.col("p")).alias("s")).collect()
    wrapped = [x * factor % 2**64 for x in ids]
    assert [r.p % 2**64 for r in got] == wrapped and [r.s for r in got] == [x >> 58 for x in wrapped]
