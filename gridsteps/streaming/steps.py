"""Ordered step exchange.

Outputs of a step arrive in any order on a stream; a step is used once it is
complete, and steps are used in ascending order. A folder on shared storage
holds everything that outlives a micro-batch:

    arrivals/year=Y/batch_id=N   rows as they came
    counts/batch_id=N            rows per (variable, year) of that batch
    inputs/variable=V/year=Y     inputs written for a step
    quarantine/batch_id=N        rows that came after their step was closed
    ledger/batch_id=N/step=Y     operations done when step Y was used
    static/NAME                  a table that all steps are joined to, as first seen

Every write replaces its own folder, so a replayed micro-batch leaves the same
tables behind. What every batch looks at, counts and ledger, is folded now and then:
``snapshot=N`` holds all batches up to N, whose own folders then go. So a batch opens a
bounded number of files, whatever came before it; arrivals are listed by year.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from gridsteps.model import KEYS, VALUES
from gridsteps.operators.combine import write_years
from gridsteps.operators.validate import validate

# The two operations of a step, in their order.
SEND, READ = "send_input", "read_output"

LEDGER = "batch bigint, year int, operation string"
COUNTS = "variable string, year int, n bigint"
# Batches between two snapshots.
FOLD = 20


def read_history(values: DataFrame, output_year: int, start_coupling: int) -> DataFrame:
    """Steps before the exchange starts, with their year-end date."""
    return (
        values.filter((F.col("year") >= output_year) & (F.col("year") < start_coupling))
        .withColumn("time", F.make_date(F.col("year"), F.lit(12), F.lit(31)))
    )


def read_step(values: DataFrame, year: int) -> DataFrame:
    """One step with its year-end date; the year prunes partitions."""
    return read_history(values, year, year + 1)


def operations_left(calendar: DataFrame, done: DataFrame, start_coupling: int,
                    output_year: int) -> DataFrame:
    """Open operations (year, position, operation), inputs before outputs.

    ``done`` carries (year, operation).
    """
    y = F.col("year")
    expected = calendar.select("year", F.explode(F.array(
        F.when(y >= start_coupling, F.struct(F.lit(0).alias("position"), F.lit(SEND).alias("operation"))),
        F.when(y >= output_year, F.struct(F.lit(1).alias("position"), F.lit(READ).alias("operation"))),
    )).alias("o")).filter(F.col("o").isNotNull()).select("year", "o.position", "o.operation")
    return expected.join(done.select("year", "operation"), ["year", "operation"], "left_anti").select(
        "year", "position", "operation").orderBy("year", "position")


def next_operation(left: DataFrame) -> DataFrame:
    """The one operation that may come next: the first of the first open year."""
    return left.orderBy("year", "position").limit(1)


def complete_steps(values: DataFrame, expected: DataFrame) -> DataFrame:
    """(year, complete, missing) per expected year.

    ``expected`` carries (variable, n) or (variable, year, n): the number of
    keys a variable delivers per year; static variables are left out of it. A
    year of the latter form that has no rows at all is incomplete; the former
    names no years, so those that have rows count.
    Keys are made distinct first, so a repeated delivery counts once.
    """
    keys = values.select("variable", "year", "cell", "band", "step").distinct()
    got = keys.groupBy("year", "variable").agg(F.count(F.lit(1)).alias("got"))
    if "year" in expected.columns:
        wanted = expected.select("variable", "year", "n")
    else:
        years = got.agg(F.array_distinct(F.collect_set("year"))).scalar()
        wanted = expected.select("variable", "n").withColumn("year", F.explode(years))
    return (
        wanted.join(got, ["year", "variable"], "left")
        .withColumn("lack", F.greatest(F.col("n") - F.coalesce("got", F.lit(0)), F.lit(0)))
        .groupBy("year")
        .agg((F.sum("lack") == 0).alias("complete"), F.sum("lack").cast("bigint").alias("missing"))
    )


def route_late(values: DataFrame, open_year: int | None) -> tuple[DataFrame, DataFrame]:
    """(accepted, late): rows before the open year, or without one, carry a reason."""
    reason = F.when(F.col("year").isNull(), F.lit("row without a step"))
    if open_year is not None:
        reason = reason.when(F.col("year") < open_year, F.lit(f"step closed, open step is {open_year}"))
    marked = values.withColumn("reason", reason)
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


def ledger_violations(log: DataFrame, calendar: DataFrame, start_coupling: int, output_year: int,
                      run: str = "run") -> DataFrame:
    """(run, seq, year, operation, violation): operations of each run's log that come out of order.

    ``log`` carries the run, ``seq``, which orders its rows, year and operation; ``calendar`` carries the years. Per
    year inputs are sent, from ``start_coupling`` on, before outputs are read, from ``output_year`` on; a year begins when
    nothing of the years before is open. An operation is judged by all that came before it in its run: it is ``not
    expected`` in the calendar, ``repeated``, comes ``before an earlier year is done``, or reads an ``output before
    input``. The first that holds is reported. Rows without seq, or of equal seq, have no order and count as simultaneous.

    Only the first time of each operation decides what is done when, so per run no more rows than the calendar asks
    for are ordered, however long its log is.
    """
    expected = operations_left(calendar.select("year").distinct(), calendar.sparkSession.createDataFrame(
        [], "year int, operation string"), start_coupling, output_year).select("year", "position", "operation")
    firsts = log.groupBy(run, "year", "operation").agg(F.min("seq").alias("first"))
    grid = log.select(run).distinct().select(run, F.inline(expected.agg(F.collect_list(
        F.struct("year", "position", "operation"))).scalar()))
    # An operation that never comes is done after everything.
    never = F.struct(F.lit(1).alias("never"), F.lit(None).cast("bigint").alias("at"))
    came = F.struct(F.lit(0).alias("never"), F.col("first").cast("bigint").alias("at"))
    state = grid.join(firsts, [run, "year", "operation"], "left").withColumn(
        "done", F.when(F.col("first").isNull(), never).otherwise(came))
    years = Window.partitionBy(run).orderBy("year").rangeBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy(run, "year")
    state = state.select(
        run, "year", "operation", "first", F.max("done").over(years).alias("earlier"),
        F.max(F.when(F.col("operation") == SEND, F.col("done"))).over(same).alias("sent"))
    now = F.struct(F.lit(0).alias("never"), F.col("seq").cast("bigint").alias("at"))
    violation = (
        F.when(F.col("expected").isNull(), F.lit("not expected"))
        .when(F.col("seq") > F.col("first"), F.lit("repeated"))
        .when(F.col("earlier") > now, F.lit("before an earlier year is done"))
        .when((F.col("operation") == READ) & (F.col("sent") > now), F.lit("output before input")))
    return (
        log.join(state.withColumn("expected", F.lit(True)), [run, "year", "operation"], "left")
        .select(run, "seq", "year", "operation", violation.alias("violation")).filter("violation IS NOT NULL")
    )


def _hadoop(spark: SparkSession, path: str):
    """Spark's own file system of a path, and the path in its terms."""
    jvm = spark.sparkContext._jvm
    own = jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


@dataclass(frozen=True)
class StepStore:
    """Tables of one exchange below a shared folder."""

    root: str

    def path(self, table: str, batch_id: int | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{table}"
        return base if batch_id is None else f"{base}/batch_id={batch_id}"

    def _read(self, spark: SparkSession, table: str, schema, paths: list[str] | None = None) -> DataFrame:
        try:
            return spark.read.schema(schema).option("basePath", self.path(table)).parquet(
                *(paths or [self.path(table)]))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def arrivals(self, spark: SparkSession, years: list[int] | None = None) -> DataFrame:
        """Rows as they came; with ``years``, which all have rows, only their folders are listed."""
        paths = years and [f"{self.path('arrivals')}/year={y}" for y in years]
        return self._read(spark, "arrivals", VALUES, paths).select(VALUES.fieldNames())

    def _folders(self, spark: SparkSession, table: str) -> tuple[int | None, list[int]]:
        """The last whole snapshot of a table, and the batches that came after it."""
        fs, path = _hadoop(spark, self.path(table))
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        numbers = lambda kind: sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))
        done = [n for n in numbers("snapshot") if fs.exists(_hadoop(spark, f"{self.path(table)}/snapshot={n}/_SUCCESS")[1])]
        last = done[-1] if done else None
        return last, [n for n in numbers("batch_id") if last is None or n > last]

    def _folded(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        """Rows of the last snapshot and of the batches after it."""
        last, tail = self._folders(spark, table)
        paths = [f"{self.path(table)}/batch_id={n}" for n in tail]
        if last is not None:
            paths.append(f"{self.path(table)}/snapshot={last}")
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)

    def fold(self, spark: SparkSession, batch_id: int, every: int = FOLD) -> None:
        """Before a batch: fold what batches before it left, if that is ``every`` folders or more."""
        for table, schema in (("counts", COUNTS), ("ledger", LEDGER)):
            last, tail = self._folders(spark, table)
            old = [n for n in tail if n < batch_id]
            if len(old) < every:
                continue
            paths = [f"{self.path(table)}/batch_id={n}" for n in old]
            if last is not None:
                paths.append(f"{self.path(table)}/snapshot={last}")
            rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)
            if table == "counts":
                rows = rows.groupBy("variable", "year").agg(F.sum("n").alias("n"))
            rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path(table)}/snapshot={old[-1]}")
            for path in paths:
                fs, gone = _hadoop(spark, path)
                fs.delete(gone, True)

    def counts(self, spark: SparkSession) -> DataFrame:
        return self._folded(spark, "counts", COUNTS)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([*VALUES.fields, T.StructField("reason", T.StringType())])
        return self._read(spark, "quarantine", schema).drop("batch_id")

    def inputs(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "inputs", VALUES).select(*KEYS, "value")

    def ledger(self, spark: SparkSession) -> DataFrame:
        return self._folded(spark, "ledger", LEDGER)

    def static(self, spark: SparkSession, name: str, table: DataFrame) -> DataFrame:
        """A table as it was when the exchange first asked for it, whatever became of its source since.

        The first call stores it; a restarted query, and every batch, reads the stored rows.
        """
        fs, done = _hadoop(spark, f"{self.path('static')}/{name}/_SUCCESS")
        if not fs.exists(done):
            table.write.mode("overwrite").parquet(f"{self.path('static')}/{name}")
        return spark.read.schema(table.schema).parquet(f"{self.path('static')}/{name}")

    def add_arrivals(self, batch: DataFrame, batch_id: int) -> None:
        """Rows partitioned by year, files evened out, plus their counts."""
        rows = batch.select(VALUES.fieldNames())
        rows.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", "year").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("year", "batch_id").parquet(self.path("arrivals"))
        (
            rows.groupBy("variable", "year").agg(F.count(F.lit(1)).alias("n"))
            .coalesce(1).write.mode("overwrite").parquet(self.path("counts", batch_id))
        )

    def add_quarantine(self, late: DataFrame, batch_id: int) -> None:
        late.select(*VALUES.fieldNames(), "reason").write.mode("overwrite").parquet(
            self.path("quarantine", batch_id))

    def record(self, spark: SparkSession, batch_id: int, step: int,
               done: list[tuple[int, str]]) -> None:
        rows = F.array(*[F.struct(F.lit(year).alias("year"), F.lit(operation).alias("operation"))
                         for year, operation in done])
        entries = spark.range(1).select(
            F.lit(batch_id).cast("bigint").alias("batch"), F.inline(rows))
        entries.coalesce(1).write.mode("overwrite").parquet(
            f"{self.path('ledger', batch_id)}/step={step}")

    def closed_year(self, spark: SparkSession, before: int | None = None) -> int | None:
        """Last year whose outputs were used, optionally by batches before one."""
        done = self.ledger(spark).filter(F.col("operation") == READ)
        if before is not None:
            done = done.filter(F.col("batch") < before)
        return done.agg(F.max("year")).first()[0]


def stream_steps(stream: DataFrame, store: StepStore, checkpoint: str,
                 first_year: int | None = None, **trigger) -> StreamingQuery:
    """Append a value stream to the store; late rows go to quarantine."""
    def step(batch: DataFrame, batch_id: int) -> None:
        _accept(batch, batch_id, store, first_year)

    return (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def _accept(batch: DataFrame, batch_id: int, store: StepStore, first_year: int | None) -> None:
    store.fold(batch.sparkSession, batch_id)
    # Only earlier batches count, so a replay routes its rows as the first run did.
    closed = store.closed_year(batch.sparkSession, before=batch_id)
    open_year = first_year if closed is None else closed + 1
    batch = batch.persist()  # the source is read once for both tables
    try:
        accepted, late = route_late(batch, open_year)
        store.add_arrivals(accepted, batch_id)
        store.add_quarantine(late, batch_id)
    finally:
        batch.unpersist()


def write_step(inputs: DataFrame, year: int, store: StepStore, registry: DataFrame | None = None,
               ncell: int | None = None) -> None:
    """Validate the inputs of one step and replace its partitions.

    With a registry (variable, datatype, nband) any violation is an error and
    nothing is written. The checks and the write share one evaluation.
    """
    inputs = inputs.persist()
    try:
        if registry is not None:
            broken = validate(inputs, registry, year=year, ncell=ncell).agg(
                F.count(F.lit(1)).alias("n"),
                F.min(F.concat_ws(" ", "rule", "variable", "year", "detail")).alias("first")).first()
            if broken.n:
                raise ValueError(f"{broken.n} violations in the inputs of {year}: {broken['first']}")
        write_years(inputs, store.path("inputs"))
    finally:
        inputs.unpersist()


def _ready_years(spark: SparkSession, store: StepStore, expected: DataFrame,
                 open_year: int, last_year: int) -> list[int]:
    """Complete years from the open one on, ascending, up to the first gap.

    Stored counts rule most years out; only the years they allow are checked by
    distinct keys. The list is as long as the calendar at most.
    """
    window = F.col("year").between(open_year, last_year)
    counts = store.counts(spark).filter(window).groupBy("variable", "year").agg(
        F.sum("n").alias("got"))
    dated = expected if "year" in expected.columns else expected.withColumn(
        "year", F.explode(F.sequence(F.lit(open_year), F.lit(last_year))))
    likely = (
        dated.filter(window).join(counts, ["variable", "year"], "left").groupBy("year")
        .agg(F.min(F.coalesce(F.col("got"), F.lit(0)) >= F.col("n")).alias("enough"))
        .filter("enough").select("year")
    )
    years = sorted(r.year for r in likely.collect())
    run = [y for i, y in enumerate(years) if y == open_year + i]
    if not run:
        return []
    dated = dated.filter(F.col("year").between(run[0], run[-1]))
    sure = {r.year for r in complete_steps(store.arrivals(spark, run), dated).filter("complete").select("year").collect()}
    ready = []
    for y in run:
        if y not in sure:
            break
        ready.append(y)
    return ready


def run_steps(stream: DataFrame, fn: Callable[[DataFrame, int], DataFrame], store: StepStore,
              expected: DataFrame, checkpoint: str, first_year: int, last_year: int,
              registry: DataFrame | None = None, ncell: int | None = None,
              **trigger) -> StreamingQuery:
    """Feedback loop: outputs of year y give the inputs of year y + 1.

    ``fn(outputs, y)`` takes the outputs of a complete year and returns the rows
    of the next year's inputs. Years run in ascending order inside the
    micro-batch that completes them. A year in the ledger never runs again; a
    year cut off before its ledger entry runs again on the same stored rows and
    replaces its own partitions.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _accept(batch, batch_id, store, first_year)
        closed = store.closed_year(spark)
        open_year = first_year if closed is None else closed + 1
        for year in _ready_years(spark, store, expected, open_year, last_year):
            outputs = read_step(store.arrivals(spark, [year]), year).drop("time")
            if year < last_year:
                write_step(fn(outputs, year), year + 1, store, registry, ncell)
                store.record(spark, batch_id, year, [(year, READ), (year + 1, SEND)])
            else:
                store.record(spark, batch_id, year, [(year, READ)])

    return (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
