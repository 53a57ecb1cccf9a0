"""Tables, reports, run log and model artifacts."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.functions.scalars import log_line
from duelframe.operators.boosting import Trees
from duelframe.operators.logistic import LogisticModel
from duelframe.operators.models import BoostedModel, ConstantModel, VectorModel
from duelframe.operators.splits import season_split, split_counts
from duelframe.schema import CLASSES, FEATURES


def write_splits(matches: DataFrame, path: str, lists: Mapping[str, Sequence[str]]) -> DataFrame:
    """One write, laid out by split; rows of no listed season stay under ``other``. Returns the row counts.

    The full table is all folders, a split is one of them, so nothing is written twice.
    """
    named = matches.withColumn("split", F.coalesce(season_split("season", lists), F.lit("other")))
    named.write.mode("overwrite").partitionBy("split").parquet(path)
    return split_counts(matches.sparkSession.read.parquet(path))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV folder, one part per task: row-level reports grow with the data."""
    df.write.mode("overwrite").csv(path, header=True)


def write_small_csv(df: DataFrame, path: str, run_date: str | None = None) -> None:
    """Single-part CSV for metric and report rows, which are few by construction; optionally under a run date."""
    target = f"{path}/run_date={run_date}" if run_date else path
    df.coalesce(1).write.mode("overwrite").csv(target, header=True)


def _sorted_struct(value: Any):
    """Literal columns of a nested dict, keys sorted at every level."""
    if isinstance(value, Mapping):
        return F.struct(*[_sorted_struct(value[k]).alias(str(k)) for k in sorted(value)])
    if isinstance(value, (list, tuple)):
        return F.array(*[_sorted_struct(v) for v in value])
    return F.lit(value)


def write_json(spark: SparkSession, report: Mapping[str, Any], path: str) -> None:
    row = spark.range(1).select(*[_sorted_struct(report[k]).alias(str(k)) for k in sorted(report)])
    row.write.mode("overwrite").json(path)


def append_run_log(spark: SparkSession, path: str, event: str, fields: Mapping[str, Any], at: dt.datetime | None = None) -> None:
    """Append one row: time, event, values as text, and the printed line."""
    stamp = (at or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    columns = {k: (F.lit(v), isinstance(v, float)) for k, v in fields.items()}
    entries = [F.lit(x) for k in sorted(fields) for x in (k, str(fields[k]))]
    row = spark.range(1).select(
        F.lit(stamp).alias("ts"),
        F.lit(event).alias("event"),
        (F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")).alias("payload"),
        log_line(F.lit(stamp), F.lit(event), columns).alias("line"),
    )
    row.write.mode("append").parquet(path)


# --- model artifacts --------------------------------------------------------------------------------


def save_model(spark: SparkSession, model, path: str, metadata: Mapping[str, Any], version: str) -> str:
    """Save under ``<path>/<version>`` and point ``<path>/latest`` at it; returns the version folder."""
    folder = f"{path.rstrip('/')}/{version}"
    meta: dict[str, Any] = {"feature_columns": list(FEATURES), "class_order": list(CLASSES), "version": version, **metadata}
    if isinstance(model, ConstantModel):
        meta |= {"kind": "constant", "probs": list(model.probs)}
    elif isinstance(model, VectorModel):
        meta |= {"kind": "vector", "model": json.dumps(vars(model.fitted))}
    elif isinstance(model, BoostedModel):
        parts = {"columns": model.columns, "medians": model.medians, "calibrators": model.calibrators}
        meta |= {"kind": "boosted", "method": model.method, "model": json.dumps(parts)}
        # Parts of some rounds each; all rounds together are about a megabyte.
        rows = [(i, bytearray(t.to_bytes())) for i, t in enumerate(model.blocks)]
        spark.createDataFrame(rows, "block int, trees binary").write.mode("overwrite").parquet(f"{folder}/trees")
    else:
        raise TypeError(f"cannot save {type(model).__name__}")
    write_json(spark, meta, f"{folder}/metadata")
    write_json(spark, {"version": version}, f"{path.rstrip('/')}/latest")
    return folder


def load_model(spark: SparkSession, path: str, version: str | None = None):
    """The model and its metadata row; the latest version unless one is named."""
    root = path.rstrip("/")
    if version is None:
        version = spark.read.json(f"{root}/latest").first()["version"]
    folder = f"{root}/{version}"
    meta = spark.read.json(f"{folder}/metadata").first().asDict(recursive=True)
    if meta["kind"] == "constant":
        return ConstantModel(tuple(meta["probs"])), meta
    parts = json.loads(meta["model"])
    if meta["kind"] == "vector":
        return VectorModel(LogisticModel(**(parts | {"columns": tuple(parts["columns"])}))), meta
    blocks = [Trees.from_bytes(bytes(r["trees"])) for r in spark.read.parquet(f"{folder}/trees").orderBy("block").collect()]
    return BoostedModel(tuple(parts["columns"]), parts["medians"], blocks, parts["calibrators"], meta["method"]), meta
