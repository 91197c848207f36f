"""The models as Spark ML stages: one ``Pipeline`` to fit, one
``PipelineModel`` to save, load and score new customers with.

    features -> FeatureMatrix -> RobustScaling -> IsolationForest
             -> PeerVectors -> PeerClusters (an MLlib KMeansModel)

The state of the Python stages is JSON in their one parameter, which
``DefaultParamsWritable`` keeps; the forest's node table (bounded by trees and
sample) is a parquet table beside it. A loaded model scores any number of
customers without the population it was fitted on: the range of raw scores
that are scaled to 0..1 and the size of the trees' samples are part of it, and
scores of new customers beyond that range are clipped.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import write_stage_table
from . import anomaly as AN
from . import peers as PE


class _State(Params):
    """One parameter that holds what a stage knows."""

    state = Param(Params._dummy(), "state", "what the stage knows, as JSON", typeConverter=TypeConverters.toString)

    def known(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def knowing(self, **known):
        self._set(state=json.dumps(known))
        return self


class FeatureMatrixModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Customers' features as model inputs, ``<typology>__<feature>``."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = self.known()
        return AN.prepare_matrix(dataset, known["sets"], set(known["logged"]))


class FeatureMatrix(Estimator, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Resolves the feature sets and which columns are taken as logarithms."""

    def _fit(self, dataset: DataFrame) -> FeatureMatrixModel:
        sets = AN.feature_sets(dataset)
        return FeatureMatrixModel().knowing(sets=sets, logged=sorted(AN.log_columns(dataset, sets)))


class RobustScalingModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return AN.robust_scale(dataset, self.known()["params"])


class RobustScaling(Estimator, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Median and interquartile range of every column but ``customer_id``."""

    def _fit(self, dataset: DataFrame) -> RobustScalingModel:
        dataset = write_stage_table(dataset, "model-matrix")
        return RobustScalingModel().knowing(params=AN.robust_params(dataset, [c for c in dataset.columns if c != "customer_id"]))


class _NodesWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        AN.node_frame(self.sparkSession, self.instance.nodes).write.parquet(f"{path}/nodes")


class _NodesReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.nodes = self.sparkSession.read.parquet(f"{path}/nodes").toPandas()  # bounded by trees and sample
        return model


class IsolationForestModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    """``customer_id`` and a score in 0..1 per typology."""

    nodes: pd.DataFrame | None = None

    def write(self) -> _NodesWriter:
        return _NodesWriter(self)

    @classmethod
    def read(cls) -> _NodesReader:
        return _NodesReader(cls)

    def copy(self, extra=None):
        that = super().copy(extra)
        that.nodes = self.nodes
        return that

    def raw_scores(self, dataset: DataFrame) -> DataFrame:
        return AN.score_forest(dataset, self.known()["sets"], self.nodes, per_tree=self.known()["per_tree"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return AN.scaled_scores(self.raw_scores(dataset), self.known()["ranges"])


class IsolationForest(Estimator, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Grows the trees of all typologies over a matrix."""

    @keyword_only
    def __init__(self, *, trees: int = K.FOREST_TREES, sample: int = K.FOREST_SAMPLE, seed: int = K.FOREST_SEED):
        super().__init__()
        self.knowing(**{"trees": trees, "sample": sample, "seed": seed, **self._input_kwargs})

    def _fit(self, dataset: DataFrame) -> IsolationForestModel:
        known = self.known()
        mat = write_stage_table(dataset, "model-matrix")
        sets = {t: [c.split("__", 1)[1] for c in mat.columns if c.startswith(f"{t}__")] for t in K.TYPOLOGIES}
        model = forest_model(AN.train_forest(mat, sets, known["trees"], known["sample"], known["seed"]), sets,
                             min(known["sample"], mat.count()))
        return model.knowing(**{**model.known(), "ranges": AN.score_ranges(model.raw_scores(mat))})


def forest_model(nodes: pd.DataFrame, sets: dict[str, list[str]], per_tree: int, ranges: dict | None = None) -> IsolationForestModel:
    model = IsolationForestModel().knowing(sets=sets, per_tree=per_tree, ranges=ranges or {})
    model.nodes = nodes
    return model


class PeerVectorsModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    """The scores with a vector of them, robust-scaled, as ``features``."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        params = self.known()["params"]
        scaled = [(F.coalesce(F.col(c), F.lit(0.0)) - F.lit(params[c][0])) / F.lit(params[c][1]) for c in PE.IF_COLS]
        return dataset.withColumn("features", array_to_vector(F.array(*scaled)))


class PeerVectors(Estimator, _State, DefaultParamsReadable, DefaultParamsWritable):
    def _fit(self, dataset: DataFrame) -> PeerVectorsModel:
        scores = dataset.select("customer_id", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in PE.IF_COLS])
        return PeerVectorsModel().knowing(params=AN.robust_params(write_stage_table(scores, "peer-scores"), PE.IF_COLS))


class PeerClusters(Estimator, _State, DefaultParamsReadable, DefaultParamsWritable):
    """The k-means fit that ``peers.choose_clusters`` keeps."""

    @keyword_only
    def __init__(self, *, min_size: int = K.KMEANS_MIN_CLUSTER, restarts: int = K.KMEANS_RESTARTS):
        super().__init__()
        self.knowing(**{"min_size": min_size, "restarts": restarts, **self._input_kwargs})

    def _fit(self, dataset: DataFrame) -> KMeansModel:
        known = self.known()
        vectors = write_stage_table(dataset.select("customer_id", "features"), "peer-vectors")
        return PE.choose_clusters(vectors, min_size=known["min_size"], restarts=known["restarts"])[0]


def scoring_pipeline(trees: int = K.FOREST_TREES, min_cluster: int = K.KMEANS_MIN_CLUSTER,
                     restarts: int = K.KMEANS_RESTARTS) -> Pipeline:
    """Features in; scores, ``features`` vector and ``prediction`` (cluster) out."""
    return Pipeline(stages=[FeatureMatrix(), RobustScaling(), IsolationForest(trees=trees), PeerVectors(),
                            PeerClusters(min_size=min_cluster, restarts=restarts)])
