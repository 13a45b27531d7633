import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ambar.fixed import PRESETS, SEARCH_SPACE
from ambar.operators import clusters, evaluate, explain, models, prep, splits, tuning
from ambar.plans import flows
from ambar.session import stored
from ambar.sources import tpch

SHORT = {"n_estimators": 3, "max_depth": 2}
FEATURES = ["presenca", "caderno", "rede"]


@pytest.fixture(scope="module")
def editions(spark, sf_dir):
    return stored(tpch.alunos(spark, sf_dir, (1999, 2000)), ["ano"])


@pytest.fixture(scope="module")
def split(editions):
    return splits.temporal_split(editions, "ano", 1999, 2000)


@pytest.fixture(scope="module")
def model(split):
    train, _ = split
    return models.fit(models.build_pipeline(train, "individual", "alfabetizado", FEATURES, **SHORT), train)


def test_median_is_interpolated_and_from_train(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "a double")
    out = prep.impute_median(train, spark.createDataFrame([(None,), (9.0,)], "a double"), ["a"])
    assert [r["a"] for r in out.collect()] == [2.5, 9.0]


def test_preprocessor_handles_unseen_missing_and_constant(spark):
    train = spark.createDataFrame([(1.0, 5, "a"), (3.0, 5, "b"), (None, 5, None)], "x double, k int, c string")
    fitted = prep.TabularPreprocessor(["x", "k"], ["c"]).fit(train)
    test = spark.createDataFrame([(2.0, 5, "new"), (float("nan"), 5, "b"), (2.0, 6, None)], "x double, k int, c string")
    out = fitted.transform(test)
    assert [r["feature"] for r in fitted.names().orderBy("position").collect()] == ["x", "k", "c_a", "c_b", "c_missing"]
    rows = [list(r[0]) for r in out.select(vector_to_array("features")).collect()]
    assert rows == [[0, 0, 0, 0, 0], [0, 0, 0, 1, 0], [0, 1, 0, 0, 1]]
    scaled = [r[0][0] for r in fitted.transform(train).select(vector_to_array("features")).collect()]
    assert scaled == pytest.approx([-1.224744871, 1.224744871, 0.0])


@pytest.mark.parametrize("limit", [None, 0])
def test_fifty_thousand_categories_fit_score_and_survive_saving(spark, tmp_path, limit):
    train = spark.range(60_000).select(
        F.concat(F.lit("k"), F.least("id", F.lit(49_999)).cast("string")).alias("c"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y")
    )
    fitted = prep.TabularPreprocessor(["x"], ["c"], limit_bytes=limit).fit(train)
    assert fitted.broadcast == (limit is None)
    assert fitted.width() == 50_001 == fitted.names().select("position").distinct().count()
    names = {r["feature"]: r["position"] for r in fitted.names().where("feature IN ('x', 'c_k0', 'c_k49999', 'c_k777')").collect()}
    path = str(tmp_path / "prep")
    fitted.save(path)
    again = prep.TabularModel.load(path)
    rows = spark.createDataFrame([("k777", 1.0), ("k0", 1.0), ("k49999", 1.0), ("new", 1.0), (None, 1.0)], "c string, x double")
    for model in (fitted, again):
        got = {r["c"]: r["features"] for r in model.transform(rows).select("c", "features").collect()}
        for value in ("k777", "k0", "k49999"):
            assert len(got[value]) == 50_001 and got[value][names[f"c_{value}"]] == 1.0 and got[value].numNonzeros() == 2
        assert got["new"].numNonzeros() == got[None].numNonzeros() == 1


def test_dictionary_numbers_values_in_order(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), (None, 2), ("b", None)], "c string, d int")
    got = {(r["column"], r["value"]): (r["index"], r["n"]) for r in prep.category_dictionary(df, ["c", "d"]).collect()}
    assert got == {("c", "a"): (0, 1), ("c", "b"): (1, 2), ("d", "1"): (0, 2), ("d", "2"): (1, 1)}
    assert prep.category_dictionary(df.where("false"), ["c"], "none").count() == 0


def test_one_hot_vector_names_its_entries(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    vectors, names = prep.one_hot_vector(df, df, "c")
    place = {r["feature"]: r["index"] for r in names.collect()}
    assert [r["c_hot"][place[f"c_{r['c']}"]] for r in vectors.collect()] == [1.0] * 3


def test_one_hot_columns(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    out = prep.one_hot(train, spark.createDataFrame([("a",), ("z",), (None,)], "c string"), "c")
    assert out.columns == ["c", "c_a", "c_b"]
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0), (0, 0), (0, 0)]


@pytest.mark.parametrize("preset", list(PRESETS))
def test_presets_reach_the_classifier(spark, preset):
    wanted, got = PRESETS[preset], models.booster(preset, "y")
    assert (got.getMaxIter(), got.getMaxDepth(), got.getStepSize()) == (wanted["n_estimators"], wanted["max_depth"], wanted["learning_rate"])
    assert got.getSubsamplingRate() == wanted["subsample"] and got.getFeatureSubsetStrategy() == str(wanted["colsample_bytree"])
    assert got.getMinInstancesPerNode() == wanted.get("min_child_weight", 1) and got.getMinInfoGain() == wanted.get("gamma", 0.0)


def test_model_beats_chance_and_survives_saving(spark, split, model, tmp_path):
    _, test = split
    scored = models.score(model, test, "alfabetizado")
    assert {"label", "prediction", "score", "id_registro"} <= set(scored.columns)
    assert evaluate.roc_auc(scored).first()[0] > 0.55
    path = str(tmp_path / "model")
    models.save_model(model, path)
    again = models.score(models.load_model(spark, path), test, "alfabetizado")
    assert scored.select("id_registro", "score").exceptAll(again.select("id_registro", "score")).count() == 0


def test_leaky_model_looks_better(split):
    train, test = split
    got = {
        r["model"]: r["roc_auc"]
        for r in models.leakage_experiment(train, test, "alfabetizado", [*FEATURES, "proficiencia"], ["proficiencia"], **SHORT).collect()
    }
    assert got["with_leakage"] > 0.9 > got["without_leakage"] > 0.5


def test_importances_are_named_and_complete(split, model):
    _, test = split
    table = models.feature_importance(model, None).collect()
    assert sum(r["importance"] for r in table) == pytest.approx(1)
    assert table[0]["feature"] == "presenca" and any(r["feature"].startswith("rede_") for r in table)
    shares, needed = models.importance_cumulative(model, [0.8, 0.9])
    assert shares.agg(F.max("cumulative_share")).first()[0] == pytest.approx(1)
    assert 1 <= needed.first()["n_80"] <= needed.first()["n_90"]


def test_cross_validation_and_training(split):
    train, _ = split
    folded = splits.stratified_folds(train, "alfabetizado", "id_registro", folds=2)
    pipeline = models.build_pipeline(train, "individual", "alfabetizado", FEATURES, **SHORT)
    fitted, per_fold = models.train_model(pipeline, folded, "alfabetizado", "fold", folds=2)
    rows = per_fold.collect()
    assert sorted(r["fold"] for r in rows) == [0, 1] and all(0.4 < r["roc_auc"] < 1 for r in rows)
    assert models.cv_summary(per_fold).first()["n_folds"] == 2
    assert fitted.transform(train).count() == train.count()


def test_random_search_ranks_candidates(split):
    train, _ = split
    folded = splits.stratified_folds(train, "alfabetizado", "id_registro", folds=2)
    best, ranked = tuning.random_search(
        folded, "alfabetizado", prep.TabularPreprocessor(["presenca"], ["rede"]), draws=2, folds=2, n_estimators=2, max_depth=2
    )
    rows = ranked.orderBy("rank").collect()
    assert len(rows) == 2 and rows[0]["mean_auc"] >= rows[1]["mean_auc"]
    assert models.score(best, train, "alfabetizado").count() == train.count()


def test_candidates_are_distinct_and_from_the_space():
    drawn = tuning.draw_candidates(SEARCH_SPACE, 30, 42)
    assert len({tuple(c.items()) for c in drawn}) == 30
    assert all(c[name] in options for c in drawn for name, options in SEARCH_SPACE.items())
    assert drawn == tuning.draw_candidates(SEARCH_SPACE, 30, 42)
    assert len(tuning.draw_candidates({"a": [1, 2]}, 30, 42)) == 2


def test_attributions_add_up_to_the_score(split, model):
    train, test = split
    n, orders = 16, 3
    background = explain.background_rows(train, FEATURES, "id_registro", n)
    phi = explain.shapley_values(model, test, background, FEATURES, "id_registro", n, orders)
    got = {r["id_registro"]: r["s"] for r in phi.groupBy("id_registro").agg(F.sum("phi").alias("s")).collect()}
    paths = explain.shapley_paths(test, background, FEATURES, "id_registro", n, orders)
    ends = model.transform(paths).select("id_registro", "_step", vector_to_array("probability")[1].alias("p"))
    want = ends.groupBy("id_registro").agg(
        (F.sum(F.when(F.col("_step") == len(FEATURES), F.col("p")).when(F.col("_step") == 0, -F.col("p"))) / orders).alias("s")
    )
    assert len(got) == test.count()
    assert all(got[r["id_registro"]] == pytest.approx(r["s"], abs=1e-9) for r in want.collect())
    full = {r["id_registro"]: r["p"] for r in ends.where(f"_step = {len(FEATURES)}").collect()}
    scores = {r["id_registro"]: r["score"] for r in models.score(model, test, "alfabetizado").collect()}
    assert all(full[i] == pytest.approx(s) for i, s in scores.items())
    assert explain.shapley_summary(phi).first()["feature"] == "presenca"


def test_clusters_cover_all_rows(spark, sf_dir):
    features = tpch.features_ml(tpch.indicadores(tpch.alunos(spark, sf_dir)))
    _, clustered = clusters.kmeans(features, starts=2)
    profile = clusters.cluster_profile(clustered).collect()
    assert len(profile) == 5 and sum(r["n_rows"] for r in profile) == features.count()
    assert [r["mean_rate"] for r in profile] == sorted(r["mean_rate"] for r in profile)


def test_flows_hold_out_the_later_edition(spark, sf_dir, editions):
    fitted = flows.pupil_flow(editions, 1999, 2000, **SHORT)
    ids = lambda df: {r["id_aluno"] for r in df.select("id_aluno").collect()}
    assert not ids(fitted.train) & ids(fitted.test)
    assert fitted.scored().count() == fitted.test.count()


def test_flow_on_a_stratified_sample(editions):
    fitted = flows.pupil_flow(editions, 1999, 2000, fraction=0.5, **SHORT)
    whole = {r["ano"]: r["count"] for r in flows.pupil_frame(editions).groupBy("ano").count().collect()}
    # Only the rows to fit are sampled; every test row is scored.
    assert 0.25 * whole[1999] < fitted.train.count() < 0.75 * whole[1999]
    assert fitted.test.count() == whole[2000]
