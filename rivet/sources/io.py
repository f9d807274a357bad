"""Sources and sinks.

Explicit schemas everywhere (no inference on hot paths), overwrite sinks,
append-only run snapshots partitioned by ``run_ts`` with the latest one
selected by partition pruning, and model artifacts saved next to a
``model_runs`` table that names the current path per model and stage.
Scratch output goes under the shared checkpoint folder, never a
machine-local directory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivet.session import ensure_checkpoint_dir, materialize

TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/rivet-io/{name}-{uuid.uuid4().hex[:12]}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with header and a declared schema (A1)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that parse, lines that don't) of a CSV (A1): no line is lost. A
    line with a missing or surplus column or a value of another type is
    returned as it is, in column ``line``."""
    rows = spark.read.schema(f"{schema}, line string").options(
        header=header, mode="PERMISSIVE", columnNameOfCorruptRecord="line").csv(path)
    rows = materialize(rows, "csv-rows")  # parsed once, with all columns
    return rows.filter("line is null").drop("line"), rows.filter("line is not null").select("line")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink, overwrite, header, no index (A2)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_json_object(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Whole-file JSON documents, e.g. one limits object per file (A3)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines as written by ``write_json``."""
    return spark.read.schema(schema).json(path)


def write_json_objects(df: DataFrame, path: str, key: str) -> None:
    """One pretty-printed JSON document per value of ``key``, which must be
    unique, each in a folder of its own."""
    whole = F.to_json(F.struct(*df.columns), {"pretty": "true"})
    df.select(F.col(key).alias("document"), whole.alias("value")).write.mode("overwrite").partitionBy("document").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines sink; nested structs and arrays are kept (A4)."""
    df.write.mode("overwrite").json(path)


def parse_timestamp(c, fmt: str = TS_FORMAT):
    """String -> TIMESTAMP_NTZ at ingest."""
    return F.to_timestamp_ntz(F.col(c) if isinstance(c, str) else c, F.lit(fmt))


def format_timestamp(c, fmt: str = "yyyy-MM-dd HH:mm:ss.SSSSSS"):
    return F.date_format(F.col(c) if isinstance(c, str) else c, fmt)


def write_snapshot(df: DataFrame, path: str, run_ts: str) -> None:
    """Append one run of a job as partition ``run_ts`` (A5)."""
    df.withColumn("run_ts", F.lit(run_ts)).write.mode("append").partitionBy("run_ts").parquet(path)


def newest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The run whose files were written last (A6), whatever its name: the
    greatest file time, read from the files' metadata without their columns."""
    files = spark.read.parquet(path).select("run_ts", F.col("_metadata.file_modification_time").alias("at"))
    newest = files.agg(F.max(F.struct("at", "run_ts")).alias("m")).first()["m"]
    if newest is None:
        raise LookupError(f"no run under {path}")
    return spark.read.parquet(path).filter(F.col("run_ts") == F.lit(newest["run_ts"])).drop("run_ts")


def write_sorted(df: DataFrame, path: str, order: list[str]) -> None:
    """Parquet sink in order (F2): each file is sorted and the files follow
    each other by name; a range-partitioned sort, not one task."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def read_in_file_order(spark: SparkSession, path: str, out: str = "place") -> DataFrame:
    """Rows with their 1-based place in the written order."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))  # one row per file
    offsets = counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(offsets), "_file").withColumn(out, F.col("_before") + F.col("_row") + 1)
            .drop("_file", "_row", "_before"))


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest run (A6): the greatest ``run_ts`` folder name, listed from
    the path's file system without reading data, then a literal filter that
    prunes every other partition."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().getName() for f in found]
    latest = max(n.removeprefix("run_ts=") for n in names if n.startswith("run_ts="))
    return spark.read.parquet(path).filter(F.col("run_ts") == F.lit(latest)).drop("run_ts")


RUNS_SCHEMA = ("name string, version int, stage string, path string, "
               "params map<string,string>, metrics map<string,double>, logged_at timestamp")


def read_runs(spark: SparkSession, runs_path: str) -> DataFrame | None:
    """Current state of the run table: of each (name, version) the row logged
    last; None where nothing was logged yet. Any other read failure raises."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(runs_path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    rows = spark.read.schema(RUNS_SCHEMA).parquet(runs_path)
    last = F.max_by(F.struct("stage", "path", "params", "metrics", "logged_at"), "logged_at")
    return rows.groupBy("name", "version").agg(last.alias("r")).select("name", "version", "r.*")


def _append_run(spark: SparkSession, runs_path: str, row: tuple) -> None:
    df = spark.createDataFrame([row], RUNS_SCHEMA.rpartition(", ")[0])
    df.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(runs_path)


def log_run(spark: SparkSession, runs_path: str, name: str, path: str, params: dict,
            metrics: dict, stage: str = "None") -> int:
    """Append a run row; version = max(version) + 1 for the name."""
    runs = read_runs(spark, runs_path)
    prev = runs.filter(F.col("name") == name).agg(F.max("version")).first()[0] if runs is not None else None
    version = (prev or 0) + 1
    _append_run(spark, runs_path, (name, version, stage, path, {k: str(v) for k, v in params.items()},
                                   {k: float(v) for k, v in metrics.items()}))
    return version


def promote(spark: SparkSession, runs_path: str, name: str, metric: str, stage: str = "Staging",
            maximize: bool = True) -> Row:
    """Store ``stage`` on the best run of ``name`` by ``metric`` (ties: lowest
    version) and return that run. The table only grows: a stage change is a
    later row of the same version."""
    runs = read_runs(spark, runs_path).filter(F.col("name") == name)
    m = F.col("metrics")[metric]
    key = F.struct(m if maximize else -m, -F.col("version"))
    best = runs.agg(F.max_by(F.struct("name", "version", "path", "params", "metrics"), key).alias("b")).select("b.*").first()
    _append_run(spark, runs_path, (best["name"], best["version"], stage, best["path"], best["params"], best["metrics"]))
    return best


def staged(spark: SparkSession, runs_path: str, name: str, stage: str) -> Row:
    """The newest version of ``name`` in ``stage``."""
    runs = read_runs(spark, runs_path)
    row = None if runs is None else (runs.filter((F.col("name") == name) & (F.col("stage") == stage))
                                     .orderBy(F.col("version").desc()).first())
    if row is None:
        raise LookupError(f"no run of {name!r} in stage {stage!r}")
    return row


def load_model(spark: SparkSession, runs_path: str, name: str, stage: str):
    """The MLlib model of the newest version of ``name`` in ``stage``, loaded
    from its artifact."""
    from pyspark.ml.util import DefaultParamsReader
    return DefaultParamsReader.loadParamsInstance(staged(spark, runs_path, name, stage)["path"], spark)
