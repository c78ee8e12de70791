import pytest
from pyspark.sql import functions as F

from gridsteps.model import VALUES
from gridsteps.operators.select import year_calendar
from gridsteps.streaming import steps as S


def rows_of(year, cells=3, bands=2, variable="out"):
    return [(variable, c, b, year, 1, float(year + c + b)) for c in range(cells) for b in range(bands)]


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, VALUES).coalesce(1).write.parquet(f"{folder}/{name}")


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "in"), S.StepStore(str(tmp_path / "store")), str(tmp_path / "checkpoint")


@pytest.fixture
def expected(spark):
    return spark.createDataFrame([("out", 6)], "variable string, n long")


def source(spark, folder):
    return spark.readStream.schema(VALUES).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_operations_left(spark):
    calendar = year_calendar(spark, 2020, 2022, 2023)
    done = spark.createDataFrame([(2020, S.READ), (2022, S.SEND)], S.LEDGER.replace("batch bigint, ", ""))
    left = S.operations_left(calendar, done, start_coupling=2022, output_year=2021)
    assert [tuple(r) for r in left.collect()] == [
        (2021, 1, S.READ), (2022, 1, S.READ), (2023, 0, S.SEND), (2023, 1, S.READ)]
    assert tuple(S.next_operation(left).first()) == (2021, 1, S.READ)


def test_history_and_stream_equal_batch(spark):
    values = spark.createDataFrame(sum((rows_of(y) for y in range(2018, 2024)), []), VALUES)
    history = S.read_history(values, 2019, 2022)
    assert {str(r.time) for r in history.select("time").distinct().collect()} == {
        "2019-12-31", "2020-12-31", "2021-12-31"}
    assert history.count() + S.read_step(values, 2022).count() == 4 * 6


def test_complete_steps(spark, expected):
    values = spark.createDataFrame(rows_of(2000) + rows_of(2000)[:2] + rows_of(2001)[1:], VALUES)
    got = {r.year: (r.complete, r.missing) for r in S.complete_steps(values, expected).collect()}
    assert got == {2000: (True, 0), 2001: (False, 1)}


def test_run_steps_in_order(spark, place, expected):
    folder, store, checkpoint = place
    calls = []

    def model(outputs, year):
        calls.append(year)
        return outputs.groupBy("cell").agg(F.sum("value").alias("value")).select(
            F.lit("in").alias("variable"), "cell", F.lit(0).alias("band"), F.lit(year + 1).alias("year"), "value")

    def run():
        S.run_steps(source(spark, folder), model, store, expected, checkpoint, 2000, 2003).awaitTermination()

    land(spark, folder, "a", rows_of(2001) + rows_of(2000)[:3])
    run()
    assert calls == []  # 2001 is there, 2000 is not complete
    land(spark, folder, "b", rows_of(2000)[2:])  # one row arrives twice
    run()
    assert calls == [2000, 2001]
    land(spark, folder, "c", rows_of(2000)[:1] + rows_of(2003))
    run()
    assert calls == [2000, 2001] and store.quarantine(spark).count() == 1
    land(spark, folder, "d", rows_of(2002))
    run()
    assert calls == [2000, 2001, 2002]
    sums = {(r.year, r.cell): r.value for r in store.inputs(spark).collect()}
    # a repeated delivery stays in the store; the model sees what arrived
    assert sums[2002, 1] == 2001 + 1 + 2001 + 2 and set(y for y, _ in sums) == {2001, 2002, 2003}
    done = {(r.year, r.operation) for r in store.ledger(spark).collect()}
    assert done == {(y, S.READ) for y in range(2000, 2004)} | {(y, S.SEND) for y in range(2001, 2004)}


def test_replayed_batch_changes_nothing(spark, place):
    _, store, _ = place
    batch = spark.createDataFrame(rows_of(2000) + rows_of(1999), VALUES)
    S._accept(batch, 4, store, 2000)
    store.record(spark, 4, 2000, [(2000, S.READ)])
    S._accept(batch, 4, store, 2000)  # its own ledger entry must not make it late
    assert store.arrivals(spark).count() == 6 and store.quarantine(spark).count() == 6
    S._accept(batch, 5, store, 2000)
    assert store.arrivals(spark).count() == 6 and store.quarantine(spark).count() == 18
    assert store.closed_year(spark) == 2000 and store.closed_year(spark, before=4) is None


def test_write_step_rejects_and_keeps(spark, place):
    _, store, _ = place
    registry = spark.createDataFrame([("in", "int", 1)], "variable string, datatype string, nband int")
    schema = "variable string, cell long, band int, year int, value double"
    good = spark.createDataFrame([("in", 1, 0, 2000, 1.0), ("in", 2, 0, 2000, 2.0)], schema)
    S.write_step(good, 2000, store, registry, ncell=2)
    for bad in (good.withColumn("year", F.lit(2001)), good.filter("cell = 1"),
                good.withColumn("value", F.lit(0.5)), good.withColumn("variable", F.lit("zz"))):
        with pytest.raises(ValueError):
            S.write_step(bad, 2000, store, registry, ncell=2)
    assert sorted(r.value for r in store.inputs(spark).collect()) == [1.0, 2.0]
