"""Result tables: written in batches, read back, merged over runs.

A run owns one folder per format.  Every table is partitioned by batch and a batch replaces its
own partitions, so writing it twice is the same as once.  A row in the manifest, written
last, says that all tables of a batch are complete: a run is taken up again after the batches
of the manifest, and readers ignore what lies outside of it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

RESULTS, INFLUENCE, SAMPLES, MANIFEST = "results", "influence", "sample_sets", "batches"
MANIFEST_SCHEMA = "batch_id int, run_id string, questions int, sample_sets array<bigint>"


@dataclass(frozen=True)
class Outputs:
    """Where results go; nothing is written by default.

    ``parquet``: folder of a run with ``results``, ``influence``, ``sample_sets`` and the manifest
    ``batches``.  ``json``: folder of JSON lines with the results; the other tables are below it
    in folders that begin with an underscore, which readers of results pass over.
    """

    json: str | None = None
    parquet: str | None = None

    @property
    def any(self) -> bool:
        return self.json is not None or self.parquet is not None

    @property
    def results_path(self) -> str:
        return self.path("parquet", RESULTS)

    def path(self, kind: str, table: str) -> str:
        if kind == "parquet":
            return f"{self.parquet.rstrip('/')}/{table}"
        base = self.json.rstrip("/")
        return base if table == RESULTS else f"{base}/_{table}"

    def kinds(self) -> list[str]:
        return [k for k in ("parquet", "json") if getattr(self, k)]

    def read(self, spark: SparkSession, kind: str, table: str) -> DataFrame:
        """A table of the finished batches, without their numbers unless it is the results."""
        schema = _schema(spark, self.path(kind, table)) if kind == "json" else None
        reader = spark.read.schema(schema) if schema is not None else spark.read
        rows = reader.format(kind).load(self.path(kind, table))
        done = F.array(*[F.lit(b) for b in sorted(self.finished(spark))]).cast("array<int>")
        rows = rows.where(F.array_contains(done, F.col("batch_id")))
        return rows if table == RESULTS else rows.drop("batch_id")

    def initialize(self, spark: SparkSession) -> None:
        """Clear what an earlier run left in this run's own folders; the manifest goes first."""
        for kind in self.kinds():
            for table in (MANIFEST, RESULTS, INFLUENCE, SAMPLES):
                _delete(spark, self.path(kind, table))

    def manifest(self, spark: SparkSession) -> list:
        """Rows of the batches that are complete in every format."""
        found = []
        for kind in self.kinds():
            try:
                rows = spark.read.format(kind).schema(MANIFEST_SCHEMA).load(
                    self.path(kind, MANIFEST)).collect()  # a row per batch
            except AnalysisException:
                rows = []
            found.append({r["batch_id"]: r for r in rows})
        shared = reduce(lambda a, b: a & b, [set(f) for f in found]) if found else set()
        return [found[0][b] for b in sorted(shared)]

    def finished(self, spark: SparkSession) -> set[int]:
        return {r["batch_id"] for r in self.manifest(spark)}

    def append(self, got, batch: int = 1) -> None:
        """Write one batch in place of what an earlier attempt left of it."""
        spark = got.results.sparkSession
        sets = []
        if got.sample_sets is not None:
            sets = [r[0] for r in got.sample_sets.select("sample_set_id").distinct().collect()]
        run = got.results.select("run_id").first()
        entry = spark.createDataFrame(
            [(batch, run[0] if run else None, got.results.select("idx").distinct().count(), sets)],
            MANIFEST_SCHEMA)
        for kind in self.kinds():
            for table, rows in ((INFLUENCE, got.influence), (SAMPLES, got.sample_sets),
                                (RESULTS, got.results), (MANIFEST, entry)):
                if rows is not None:
                    _replace(rows.withColumn("batch_id", F.lit(batch)), kind, self.path(kind, table))


def _replace(rows: DataFrame, kind: str, path: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if kind == "json":  # readers of lines cannot tell a missing column from nulls
        writer = writer.option("ignoreNullFields", "false")
    writer.partitionBy("batch_id").format(kind).save(path)


def _schema(spark: SparkSession, path: str):
    """Columns of JSON lines, with whole numbers for the number of a batch."""
    found = spark.read.json(path).schema
    for f in found:
        if f.name == "batch_id":
            from pyspark.sql.types import IntegerType

            f.dataType = IntegerType()
    return found


def _file(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    system, at = _file(spark, path)
    if system.exists(at):
        system.delete(at, True)


def sample_references(results: DataFrame) -> DataFrame:
    """Per batch and question either an own list of rows or the place (from 1, inside
    the batch) of the earlier question whose list is the same: only a change of the
    variables starts a new list."""
    once = results.groupBy("batch_id", "idx").agg(F.first("sample_set_id").alias("sample_set_id"))
    order = Window.partitionBy("batch_id").orderBy("idx")
    place = F.row_number().over(order)
    before = F.lag("sample_set_id").over(order)
    fresh = before.isNull() | (before != F.col("sample_set_id"))
    marked = once.withColumns({"place": place, "fresh": fresh})
    last = F.last(F.when(F.col("fresh"), F.col("place")), ignorenulls=True).over(order)
    return marked.select(
        "batch_id", "idx", "sample_set_id",
        F.when(~F.col("fresh"), last).cast("bigint").alias("same_as"),
    )


def write_arrow(df: DataFrame, path: str, batch_rows: int | None = None) -> None:
    """Arrow IPC files, one per partition, below a folder that all executors share; record
    batches hold ``batch_rows`` rows at most."""
    schema = df.schema

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        ctx = TaskContext.get()
        system, base = fs.FileSystem.from_uri(path) if "://" in path else (
            fs.LocalFileSystem(), path.removeprefix("file:"))
        system.create_dir(base, recursive=True)
        name = f"{base}/part-{ctx.partitionId():05d}"
        draft = f"{name}.attempt-{ctx.taskAttemptId()}"
        rows, sink, writer = 0, system.open_output_stream(draft), None
        with sink:
            for b in batches:
                writer = writer or pa.ipc.new_file(sink, b.schema)
                step = batch_rows or max(1, b.num_rows)
                for at in range(0, b.num_rows, step):
                    writer.write_batch(b.slice(at, step))
                rows += b.num_rows
            if writer is not None:
                writer.close()
        # A second attempt of the task replaces the file as a whole.
        if writer is not None:
            system.move(draft, f"{name}.arrow")
        else:
            system.delete_file(draft)
        yield pa.RecordBatch.from_pydict({"rows": [rows]})

    if not schema:
        raise ValueError("nothing to write")
    df.mapInArrow(write, "rows bigint").agg(F.sum("rows")).collect()


def write_results(results: DataFrame, outputs: Outputs) -> None:
    """All results in one go."""
    if outputs.parquet:
        results.write.mode("overwrite").parquet(outputs.results_path)
    if outputs.json:
        results.write.mode("overwrite").json(outputs.json)


def _of_runs(spark: SparkSession, prefix: str, table: str) -> DataFrame:
    """A table of every run whose folder starts with the prefix, with folder and batch."""
    # One read however many runs there are; the batch is taken from the path.
    read = (
        spark.read.option("mergeSchema", True)
        .option("recursiveFileLookup", True)
        .parquet(f"{prefix}*/{table}")
    )
    path = F.col("_metadata.file_path")
    batch = F.expr("try_cast(regexp_extract(_metadata.file_path, 'batch_id=([0-9]+)', 1) AS int)")
    if "batch_id" in read.columns:
        batch = F.coalesce(F.col("batch_id"), batch)
    return read.withColumns(
        {"source": F.regexp_extract(path, f"(.*)/{table}/", 1), "batch_id": batch})


def _complete(spark: SparkSession, prefix: str, rows: DataFrame) -> DataFrame:
    """Rows of batches in the manifest of their run; runs without one are taken whole."""
    try:
        listed = _of_runs(spark, prefix, MANIFEST).select("source", "batch_id").distinct()
    except AnalysisException:
        return rows
    runs = listed.select("source").distinct()
    return rows.join(listed, ["source", "batch_id"], "left_semi").unionByName(
        rows.join(runs, "source", "left_anti"))


def read_results(spark: SparkSession, prefix: str) -> DataFrame:
    """Results of every run whose folder starts with the prefix, in order of folder
    name, batch number and question."""
    rows = _complete(spark, prefix, _of_runs(spark, prefix, RESULTS))
    return rows.orderBy("source", "batch_id", "idx", "estimator")


def merged_set_id(source: str = "source", set_id: str = "sample_set_id"):
    """An id for the rows of a set in a run: sets of the same variables in two runs differ."""
    return F.when(F.col(set_id).isNotNull(), F.shiftrightunsigned(
        F.xxhash64(F.col(source), F.col(set_id)), 1))


def read_influence(spark: SparkSession, prefix: str) -> DataFrame | None:
    """Influence values of every run with ``source``; None if no run kept any."""
    try:
        return _complete(spark, prefix, _of_runs(spark, prefix, INFLUENCE)).drop("batch_id")
    except AnalysisException:
        return None


def read_sample_sets(spark: SparkSession, prefix: str) -> DataFrame | None:
    """Rows used by every run, each set with an id of its run; None if no run kept any."""
    try:
        rows = _complete(spark, prefix, _of_runs(spark, prefix, SAMPLES))
    except AnalysisException:
        return None
    return rows.select(merged_set_id().alias("sample_set_id"), "SAMPLE_ID", "source")


def merge_results(spark: SparkSession, prefix: str, outputs: Outputs | None = None) -> DataFrame:
    """Results of all runs as one table; with outputs, also their influence values (by
    ``source`` and question) and sample sets, whose ids tell the runs apart."""
    results = read_results(spark, prefix).withColumn("sample_set_id", merged_set_id())
    if outputs is not None:
        write_results(results, outputs)
        for table, rows in ((INFLUENCE, read_influence(spark, prefix)),
                            (SAMPLES, read_sample_sets(spark, prefix))):
            for kind in outputs.kinds():
                if rows is not None:
                    rows.write.mode("overwrite").format(kind).save(outputs.path(kind, table))
    return results
