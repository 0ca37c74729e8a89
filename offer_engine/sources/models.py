"""Versioned model files and a table of the runs that made them."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offer_engine.operators.trees import FOLDER, Forest

RUNS_SCHEMA = (
    "model string, version int, path string, params map<string,string>, "
    "metrics map<string,double>, features array<string>, signature string, sample string"
)
#: Rows of model input and output that a run records.
SAMPLE = 10


@dataclass(frozen=True)
class ModelStore:
    """Models as <root>/<name>/v=<n> and one row per saved version below <root>/model_runs."""

    spark: SparkSession
    root: str

    @property
    def _runs_path(self) -> str:
        return f"{self.root}/model_runs"

    def runs(self) -> DataFrame:
        """All runs; none where nothing was saved yet."""
        try:
            reader = self.spark.read.schema(RUNS_SCHEMA).option("recursiveFileLookup", True)
            return reader.parquet(self._runs_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RUNS_SCHEMA)

    def latest(self) -> DataFrame:
        """The newest version of every model."""
        newest = F.max_by(F.struct("version", "path", "params", "metrics", "features"), "version")
        return self.runs().groupBy("model").agg(newest.alias("run")).select("model", "run.*")

    def _claimed(self, name: str, version: int) -> int:
        """The first free version from this one on, claimed by a file that only one run can make."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        while True:
            folder = hadoop.Path(f"{self.root}/{name}")
            files = folder.getFileSystem(conf)
            free = not files.exists(hadoop.Path(folder, f"v={version}"))
            if free and files.createNewFile(hadoop.Path(folder, f"_claim-{version}")):
                return version
            version += 1

    def save(
        self,
        name: str,
        model: Forest,
        params: Mapping[str, object],
        metrics: Mapping[str, float],
        features: list[str],
        train: DataFrame,
    ) -> int:
        """Write the next version of a model with its parameters, metrics, signature and a sample.

        A version is claimed before it is written, and listed when it is complete. A run that finds
        a version claimed takes the next one, so runs at the same time keep apart.
        The sample is the first SAMPLE training rows by account and offer with their predictions.
        """
        newest = self.runs().filter(F.col("model") == name).agg(F.max("version")).first()[0]
        version = self._claimed(name, (newest or 0) + 1)
        path = f"{self.root}/{name}/v={version}"
        model.save(path, self.spark)
        order = [c for c in ("account_id", "offer_id") if c in train.columns]
        first = (train.orderBy(*order) if order else train).limit(SAMPLE)
        sample = model.transform(first.select("features")).select("features", "prediction")
        lines = [[r["features"].toArray().tolist(), r["prediction"]] for r in sample.collect()]
        row = (
            name,
            version,
            path,
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items() if v is not None},
            features,
            sample.schema.simpleString(),
            json.dumps(lines),
        )
        # A folder of its own: two runs that append to one folder would clear each other's files.
        self.spark.createDataFrame([row], RUNS_SCHEMA).write.parquet(
            f"{self._runs_path}/{name}-{version}"
        )
        return version

    def samples(self) -> DataFrame:
        """The recorded rows of every version: model, version, features and prediction."""
        kind = "array<struct<features: array<double>, prediction: double>>"
        lines = F.transform(
            F.from_json("sample", "array<array<string>>"),
            lambda x: F.struct(
                F.from_json(x[0], "array<double>").alias("features"), x[1].cast("double").alias("prediction")
            ),
        )
        return self.runs().select("model", "version", F.inline(lines.cast(kind)))

    def load(self, name: str, version: int | None = None) -> Forest | RandomForestRegressionModel:
        """A version of a model, by default the newest, also one saved by Spark ML."""
        runs = self.runs().filter(F.col("model") == name)
        if version is not None:
            runs = runs.filter(F.col("version") == version)
        found = runs.agg(F.max_by("path", "version")).first()[0]
        if found is None:
            raise LookupError(f"no model {name} version {version or 'latest'}")
        own = self.spark._jvm.org.apache.hadoop.fs.Path(found, FOLDER)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        if own.getFileSystem(conf).exists(own):
            return Forest.load(found, self.spark)
        return RandomForestRegressionModel.load(found)
