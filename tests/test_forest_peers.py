import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from txnrisk import constants as K
from txnrisk.operators import anomaly as AN


def _matrix(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    data = {"customer_id": np.arange(n)}
    for t in K.TYPOLOGIES:
        for j in range(3):
            data[f"{t}__f{j}"] = rng.normal(size=n)
    pdf = pd.DataFrame(data)
    for t in K.TYPOLOGIES:
        pdf.loc[pdf.customer_id == 7, f"{t}__f0"] = 25.0     # planted outlier
    sets = {t: [f"f{j}" for j in range(3)] for t in K.TYPOLOGIES}
    return spark.createDataFrame(pdf), sets


def test_forest_deterministic_and_finds_outlier(spark):
    mat, sets = _matrix(spark)
    n1 = AN.train_forest(mat, sets, trees=50)
    n2 = AN.train_forest(mat.repartition(3), sets, trees=50)
    cols = ["typology", "tree", "node", "feature", "split"]
    a = n1.sort_values(cols[:3]).reset_index(drop=True)[cols]
    b = n2.sort_values(cols[:3]).reset_index(drop=True)[cols]
    assert a.equals(b), "forest must not depend on partitioning"
    s = AN.normalise_scores(AN.score_forest(mat, sets, n1)).toPandas()
    for t in K.TYPOLOGIES:
        c = f"if_score_{t}"
        assert s[c].between(0, 1).all()
        top = s.sort_values(c, ascending=False).head(4)["customer_id"].tolist()
        assert 7 in top, t


def test_depth_limit_and_c_factor():
    assert AN.c_factor(1) == 0.0 and AN.c_factor(2) == 1.0
    assert abs(AN.c_factor(256) - 10.244770920116851) < 1e-9
    rng = np.random.default_rng(0)
    nodes = AN._grow_tree(rng.normal(size=(256, 4)), rng, 8)
    assert max(n[6] for n in nodes) <= 8


def test_resolve_feature_cols():
    avail = ["count_card", "sum_card", "card_x", "total_volume_vs_ind_median"]
    assert AN.resolve_feature_cols(["count_card", "card_", "_vs_ind_median"], avail) == \
        ["count_card", "card_x", "total_volume_vs_ind_median"]


def _blobs(spark, centers, n, scale, seed):
    from pyspark.ml.feature import VectorAssembler

    from txnrisk.operators import peers as PE

    rng = np.random.default_rng(seed)
    x = np.vstack([c + rng.normal(scale=scale, size=(n, 5)) for c in np.array(centers, dtype=float)])
    pdf = pd.DataFrame(x, columns=PE.IF_COLS)
    pdf.insert(0, "customer_id", np.arange(len(pdf)))
    df = spark.createDataFrame(pdf).repartition(4)
    return VectorAssembler(inputCols=PE.IF_COLS, outputCol="features").transform(df).select("customer_id", "features")


def test_kmeans_recovers_blobs_and_survives_saving(spark, tmp_path):
    from pyspark.ml.clustering import KMeansModel

    from txnrisk.operators import peers as PE

    v = _blobs(spark, [[0, 0, 0, 0, 0], [6, 6, 0, 0, 0], [0, 0, 6, 6, 6]], 120, 0.3, 2)
    model, k = PE.choose_clusters(v, start_k=5, floor_k=2, min_size=100, restarts=3)
    assert k == 3 and sorted(model.summary.clusterSizes) == [120, 120, 120]
    was = {r.customer_id: r.cluster for r in PE.assign_clusters(v, model).collect()}
    assert [len({was[i] for i in range(a, a + 120)}) for a in (0, 120, 240)] == [1, 1, 1] and len(set(was.values())) == 3
    model.write().save(str(tmp_path / "m"))
    loaded = KMeansModel.load(str(tmp_path / "m"))
    assert {r.customer_id: r.cluster for r in PE.assign_clusters(v, loaded).collect()} == was


def test_a_k_that_cannot_pass_is_not_fitted(spark, monkeypatch):
    from txnrisk.operators import peers as PE

    fitted = []
    fit = PE.fit_best
    monkeypatch.setattr(PE, "fit_best", lambda v, k, *a: fitted.append(k) or fit(v, k, *a))
    v = _blobs(spark, [[0, 0, 0, 0, 0], [6, 6, 0, 0, 0]], 50, 0.3, 2)
    _, k = PE.choose_clusters(v, start_k=6, floor_k=2, min_size=30, restarts=1)
    assert k == 2 and fitted == [3, 2]  # 100 customers: four clusters of 30 are too many
    fitted.clear()
    assert PE.choose_clusters(v, start_k=6, floor_k=4, min_size=300, restarts=1)[1] == 4 and fitted == [4]


def test_silhouette_prefers_true_k(spark):
    from txnrisk.operators import peers as PE

    v = _blobs(spark, [[0, 0, 0, 0, 0], [8, 0, 0, 0, 0], [0, 8, 0, 0, 0]], 80, 0.4, 4)
    sil = {r["k"]: r["silhouette"] for r in PE.silhouette_by_k(v, [2, 3, 4], restarts=3).collect()}
    assert max(sil, key=sil.get) == 3


def test_constant_scores_are_zero_and_leaves_hold_lengths(spark):
    mat, sets = _matrix(spark, n=40)
    same = mat.select("customer_id", *[F.lit(1.0).alias(c) for c in mat.columns if c != "customer_id"])
    nodes = AN.train_forest(same, sets, trees=8)
    scores = AN.normalise_scores(AN.score_forest(same, sets, nodes)).toPandas()
    assert (scores.drop(columns="customer_id") == 0).all().all()
    nodes = AN.train_forest(mat, sets, trees=8)
    flat = AN.flat_trees(nodes)
    one = nodes[(nodes.typology == K.TYPOLOGIES[0]) & (nodes.tree == 0)].sort_values("node")
    leaf = one[one.is_leaf == 1].iloc[0]
    assert flat[K.TYPOLOGIES[0]][0][4][leaf.node] == leaf.depth + AN.c_factor(leaf["size"])


def test_pairs_of_rows_and_trees_are_kept_in_a_compiled_loop(spark):
    mat, sets = _matrix(spark, n=60)
    pairs = AN.kept_pairs(mat, sets, trees=40, pair_thr=0.1, seed=3)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan  # a function of arrays is interpreted, element by element
    assert all("*(" in line for line in plan.splitlines())
    h = F.pmod(F.xxhash64("customer_id", "typology", "tree", F.lit(3)), F.lit(1 << 52)).cast("double") / float(1 << 52)
    every = (mat.select("customer_id").crossJoin(spark.createDataFrame([(t,) for t in K.TYPOLOGIES], "typology string"))
             .crossJoin(spark.range(40).select(F.col("id").cast("int").alias("tree"))))
    wanted = {tuple(r) for r in every.where(h < 0.1).select("customer_id", "typology", "tree").collect()}
    got = pairs.select("customer_id", "typology", "tree").collect()
    assert len(got) == len(wanted) and {tuple(r) for r in got} == wanted
