"""Stored pipelines, the run log and the model table."""

from __future__ import annotations

import json
import os
import uuid
from typing import TYPE_CHECKING
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.lake import LakePaths

if TYPE_CHECKING:
    from marquee.plans.modeling import Fitted

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

MODEL_TABLE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)

BEST_MODEL = "best_model_pipeline"


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_rows(fitted: Fitted, run_name: str, run_id: str | None = None) -> list[tuple]:
    """Metrics, stage parameters and model name of a run, in log form.

    The model's name is that of its last stage, in tuned runs too.
    """
    run_id = run_id or uuid.uuid4().hex
    model = type(fitted.model.stages[-1]).__name__
    rows = [("metric", k, repr(float(v))) for k, v in fitted.metrics.items()]
    for stage in fitted.model.stages:
        for param, value in stage.extractParamMap().items():
            rows.append(("param", f"{type(stage).__name__}_{param.name}", str(value)))
    rows.append(("param", "Model Name", model))
    return [(run_id, run_name, model, *row) for row in rows]


def log_run(
    spark: SparkSession,
    lake: LakePaths,
    fitted: Fitted,
    run_name: str,
    keep_model: bool = True,
) -> str:
    """Append a run to the log and keep its pipeline; returns the run id."""
    run_id = uuid.uuid4().hex
    # The pipeline first: a run in the log always has it.
    if keep_model:
        save_model(fitted.model, run_model_path(lake, run_id))
    rows = run_rows(fitted, run_name, run_id)
    spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(
        lake.gold("run_log")
    )
    return run_id


def run_model_path(lake: LakePaths, run_id: str) -> str:
    return lake.gold(f"runs/{run_id}/model")


def read_runs(spark: SparkSession, lake: LakePaths) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(lake.gold("run_log"))


def run_metrics(runs: DataFrame, metric: str = "rmse") -> DataFrame:
    """One row per run with the value of ``metric``."""
    return runs.filter((F.col("kind") == "metric") & (F.col("key") == metric)).select(
        "run_id", "model", F.col("value").cast("double").alias(metric)
    )


def select_best(runs: DataFrame, metric: str = "rmse", tie: str = "model") -> DataFrame:
    """The run with the lowest metric, ties by name."""
    return runs.orderBy(F.col(metric).asc_nulls_last(), F.col(tie).asc_nulls_last()).limit(1)


def publish_model(spark: SparkSession, lake: LakePaths, model: PipelineModel, name: str) -> int:
    """Store the model as the next version under ``name``; returns the version.

    The artefact gets a folder of its own, and a version is a record that is created only if there
    is none yet: of publishers that race for a version one gets it and the others go on to the
    next.  One that fails before its record exists has blocked nothing.
    """
    path = lake.gold(f"models/{quote(name, safe='')}/{uuid.uuid4().hex}")
    model.save(path)
    kind = type(model.stages[-1]).__name__
    version = (published_models(spark, lake, name).agg(F.max("version")).first()[0] or 0) + 1
    while not _claim(spark, _record(lake, name, version), [name, version, kind, path]):
        version += 1
    return version


def _record(lake: LakePaths, name: str, version: int) -> str:
    return f"{lake.gold('model_table')}/{version:08d}@{quote(name, safe='')}.json"


def _claim(spark: SparkSession, path: str, row: list) -> bool:
    """Create the record unless there is one; whether it is ours."""
    text = json.dumps(dict(zip(MODEL_TABLE.names, row)))
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    if fs.getUri().getScheme() == "file":
        # A local file system creates without a check of its own that is atomic; a link is.
        place = target.toUri().getPath()
        draft = f"{os.path.dirname(place)}/.{uuid.uuid4().hex}"
        with open(draft, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, place)
        except FileExistsError:
            return False
        finally:
            os.remove(draft)
        return True
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in _type_of(error):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    # Where the store does not refuse to create twice, the last writer's record is there.
    return spark.read.schema(MODEL_TABLE).json(path).first()["path"] == row[-1]


def _type_of(error: Py4JJavaError) -> str:
    return error.java_exception.getClass().getName()


def published_models(
    spark: SparkSession, lake: LakePaths, name: str | None = None
) -> DataFrame:
    try:
        table = spark.read.schema(MODEL_TABLE).json(lake.gold("model_table"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], MODEL_TABLE)
    return table if name is None else table.filter(F.col("name") == name)


def load_published(
    spark: SparkSession, lake: LakePaths, name: str, version: int | None = None
) -> PipelineModel:
    """The given version, or the latest."""
    table = published_models(spark, lake, name)
    if version is not None:
        table = table.filter(F.col("version") == version)
    row = table.orderBy(F.col("version").desc()).first()
    if row is None:
        raise LookupError(f"no model {name!r}, version {version or 'any'}")
    return load_model(row["path"])
