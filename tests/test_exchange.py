"""Step gate as state, order of operations, upkeep of the store, static tables joined to streams."""

import os

import pytest
from pyspark.sql import functions as F

from gridsteps.operators import cube
from gridsteps.streaming import gate, steps as S

ROWS = "variable string, cell long, band int, year int, step long, value double"


def put(spark, rows, folder, name):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{folder}/{name}")


def test_gate_releases_each_year_once_and_restarts(spark, tmp_path):
    gate.use_state(spark)
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    os.makedirs(source)
    expected = spark.createDataFrame([("a", 2000, 3), ("b", 2000, 1), ("a", 2001, 2), ("b", 2001, 1)], "variable string, year int, n long")

    def run():
        stream = spark.readStream.schema(ROWS).parquet(f"{source}/*")

        def keep(batch, batch_id):
            batch.write.mode("append").parquet(out)

        gate.release_years(stream, expected).writeStream.outputMode("update").foreachBatch(keep).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.read.schema(gate.RELEASED).parquet(out).collect()))

    row = lambda v, c, y, s=0: (v, c, 0, y, s, 1.0)
    put(spark, [row("a", 1, 2000), row("a", 2, 2000), row("a", 1, 2000), row("b", 1, 2001), row("z", 1, 2000), row("a", 1, 1999)], source, "f1")
    assert run() == []
    # A key that came before the restart does not count again.
    put(spark, [row("a", 2, 2000), row("b", 1, 2000), row("a", None, 2000)], source, "f2")
    assert run() == []
    put(spark, [row("a", 3, 2000), row("a", 1, 2001, 5)], source, "f3")
    assert run() == [(2000, 4, 0)]
    put(spark, [row("a", 3, 2000), row("a", 9, 2000), row("a", 1, 2001, 6)], source, "f4")
    assert run() == [(2000, 4, 0), (2001, 3, 0)]


def test_gate_spreads_a_year_over_pages(spark, tmp_path, monkeypatch):
    gate.use_state(spark)
    monkeypatch.setattr(gate, "PAGE_KEYS", 10)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, [("a", c, b, 2000, 0, 1.0) for c in range(100) for b in range(2)], source, "f1")
    expected = spark.createDataFrame([("a", 2000, 200)], "variable string, year int, n long")
    stream = spark.readStream.schema(ROWS).parquet(f"{source}/*")

    def keep(batch, batch_id):
        batch.write.mode("append").parquet(out)

    gate.count_keys(stream, expected).writeStream.outputMode("update").foreachBatch(keep).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    pages = spark.read.parquet(out)
    assert pages.count() == 20 and pages.agg(F.sum("added")).first()[0] == 200


LOG = "run string, seq long, year int, operation string"


def test_ledger_violations(spark):
    send, read = S.SEND, S.READ
    good = [("good", i, y, o) for i, (y, o) in enumerate([(1999, read), (2000, send), (2000, read), (2001, send), (2001, read)])]
    bad = [("bad", i, y, o) for i, (y, o) in enumerate([
        (1999, read),    # fine
        (2000, read),    # its input has not been sent
        (2001, send),    # 2000 is not done
        (2000, send),    # late, but nothing before it is open
        (1999, send),    # before coupling starts
        (2000, send),    # again
        (2001, read),    # fine: all before it is done
        (2050, read)])]  # outside the calendar
    calendar = spark.createDataFrame([(y,) for y in (1999, 2000, 2001)], "year int")
    log = spark.createDataFrame(good + bad, LOG)
    got = {(r.run, r.seq): r.violation for r in S.ledger_violations(log, calendar, 2000, 1999).collect()}
    assert got == {("bad", 1): "output before input", ("bad", 2): "before an earlier year is done", ("bad", 4): "not expected",
                   ("bad", 5): "repeated", ("bad", 7): "not expected"}
    assert S.ledger_violations(log.filter("false"), calendar, 2000, 1999).count() == 0
    lost = spark.createDataFrame([("r", 0, 2001, send)], LOG)
    assert [r.violation for r in S.ledger_violations(lost, calendar, 2000, 1999).collect()] == ["before an earlier year is done"]


def files_below(path):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(path) for name in names)


def test_store_stays_small(spark, tmp_path, monkeypatch):
    """What every batch opens does not grow with the number of batches."""
    monkeypatch.setattr(S, "FOLD", 4)
    store = S.StepStore(str(tmp_path / "store"))
    rows = spark.createDataFrame([("v", 1, 0, 2000, 0, 1.0), ("v", 2, 0, 2001, 0, 1.0)], ROWS).coalesce(1)
    most = 0
    for batch in range(24):
        store.fold(spark, batch, 4)
        store.add_arrivals(rows, batch)
        if batch % 3 == 0:
            store.record(spark, batch, 1900 + batch, [(1900 + batch, S.READ)])
        most = max(most, files_below(store.path("counts")) + files_below(store.path("ledger")))
    assert most <= 2 * (4 + 2)
    assert {(r.year, r.n) for r in store.counts(spark).groupBy("year").agg(F.sum("n").alias("n")).collect()} == {(2000, 24), (2001, 24)}
    assert store.ledger(spark).count() == 8 and store.closed_year(spark) == 1921 and store.closed_year(spark, before=21) == 1918
    assert store.arrivals(spark).count() == 48 and store.arrivals(spark, [2001]).count() == 24
    # A replayed batch leaves the same rows.
    store.add_arrivals(rows, 23)
    assert store.arrivals(spark).count() == 48


def test_snapshot_cut_short_is_ignored(spark, tmp_path):
    store = S.StepStore(str(tmp_path / "store"))
    for batch in range(3):
        store.record(spark, batch, batch, [(batch, S.READ)])
    os.makedirs(f"{store.path('ledger')}/snapshot=1")
    assert store.ledger(spark).count() == 3
    store.fold(spark, 3, 2)
    assert store.ledger(spark).count() == 3 and store.closed_year(spark) == 2


def test_static_table_is_pinned(spark, tmp_path):
    store = S.StepStore(str(tmp_path / "store"))
    cells = spark.createDataFrame([(1, 0.5, 1.5)], "cell long, lon double, lat double")
    assert store.static(spark, "cells", cells).count() == 1
    more = cells.unionByName(spark.createDataFrame([(2, 0.0, 0.0)], cells.schema))
    assert store.static(spark, "cells", more).count() == 1
    put(spark, [("v", 1, 0, 2000, 0, 1.0), ("v", 2, 0, 2000, 0, 2.0)], str(tmp_path / "in"), "f")
    stream = cube.attach_coords(spark.readStream.schema(ROWS).parquet(str(tmp_path / "in/*")), store.static(spark, "cells", more))
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert {(r.cell, r.lon) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(1, 0.5), (2, None)}
    with pytest.raises(Exception, match="repeated key"):
        cube.attach_coords(spark.createDataFrame([(1,)], "cell long"), cells.unionByName(cells)).collect()
