"""The models as one pipeline: fitted, saved, loaded, and used on others."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from txnrisk import constants as K
from txnrisk.operators import anomaly as AN
from txnrisk.operators import models as MO
from txnrisk.operators import peers as PE
from txnrisk.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fitted(spark):
    f = Q.features(spark, SF)
    return f, MO.scoring_pipeline(trees=8, min_cluster=1, restarts=1).fit(f)


def scores(df):
    return {r.customer_id: (tuple(r[c] for c in PE.IF_COLS), r.prediction) for r in df.collect()}


def test_saved_and_loaded_scores_are_equal(spark, fitted, tmp_path):
    f, model = fitted
    was = scores(model.transform(f))
    assert len(was) == f.count()
    model.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert [type(s).__name__ for s in loaded.stages] == [
        "FeatureMatrixModel", "RobustScalingModel", "IsolationForestModel", "PeerVectorsModel", "KMeansModel"]
    assert scores(loaded.transform(f)) == was
    # customers are scored alike whoever else is there
    one = min(was)
    assert scores(loaded.transform(f.where(F.col("customer_id") == one))) == {one: was[one]}
    assert loaded.transform(f.limit(0)).count() == 0
    model.write().overwrite().save(str(tmp_path / "m"))


def test_fit_equals_the_functions(fitted):
    f, model = fitted
    plain = {r.customer_id: tuple(r[c] for c in PE.IF_COLS) for r in AN.anomaly_scores(f, trees=8).collect()}
    for c, (got, _) in scores(model.transform(f)).items():
        assert np.allclose(got, plain[c])  # scaling the inputs moves no path


def test_scores_of_others_are_clipped(spark):
    raw = spark.createDataFrame(pd.DataFrame({"customer_id": [1, 2, 3]} | {f"raw_{t}": [0.1, 0.5, 0.9] for t in K.TYPOLOGIES}))
    got = AN.scaled_scores(raw, {t: [0.4, 0.6] for t in K.TYPOLOGIES[:-1]} | {K.TYPOLOGIES[-1]: [0.5, 0.5]})
    rows = {r.customer_id: [round(r[c], 9) for c in PE.IF_COLS] for r in got.collect()}
    assert rows == {1: [0.0] * 5, 2: [0.5] * 4 + [0.0], 3: [1.0] * 4 + [0.0]}


def test_an_empty_forest_can_be_saved(spark, tmp_path):
    model = MO.forest_model(AN.node_frame(spark, pd.DataFrame()).toPandas(), {t: [] for t in K.TYPOLOGIES}, 0)
    model.write().save(str(tmp_path / "m"))
    assert len(MO.IsolationForestModel.load(str(tmp_path / "m")).nodes) == 0
