"""Cross-fitted scores, stored context, screens, curves by corners, match rates."""

import random
import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ambar.operators import context, evaluate, explain, lookup, models, prep, splits, tuning
from ambar.operators.prep import TabularPreprocessor
from ambar.operators.running import next_values
from ambar.plans import flows
from ambar.session import stored
from ambar.sources import bucketed, samples, tpch

SHORT = {"n_estimators": 3, "max_depth": 2}


@pytest.fixture(scope="module")
def editions(spark, sf_dir):
    return stored(tpch.alunos(spark, sf_dir, (1999, 2000)), ["ano"])


@pytest.fixture(scope="module")
def engineered(editions):
    return flows.engineered_flow(editions, 1999, 2000, **SHORT)


def test_every_train_row_is_scored_once_by_a_model_that_has_not_seen_it(engineered):
    found = engineered.out_of_fold(3)
    ids = [r["id_registro"] for r in found.select("id_registro").collect()]
    assert sorted(ids) == sorted(r["id_registro"] for r in engineered.train.select("id_registro").collect())
    assert found is engineered.out_of_fold() and found.select("fold").distinct().count() == 3
    # Scores of rows that a model has seen are better than those of rows that it hasn't.
    inside = evaluate.roc_auc(engineered.scored("train")).first()[0]
    assert evaluate.roc_auc(found).first()[0] < inside
    assert {r["fold"] for r in engineered.cross_validation().collect()} == {0, 1, 2}


def test_cut_comes_from_out_of_fold_scores(engineered):
    best = evaluate.best_threshold(engineered.out_of_fold()).first()
    assert engineered.cut() == best["threshold"]
    rows = engineered.at_cut().select("score", "prediction").collect()
    assert all(r["prediction"] == int(r["score"] >= best["threshold"]) for r in rows)


def test_saved_model_with_context_scores_raw_rows_alike(spark, editions, engineered, tmp_path):
    path = str(tmp_path / "whole")
    models.save_model(engineered.whole(), path)
    again = models.load_model(spark, path)
    assert isinstance(again, PipelineModel) and isinstance(again.stages[0], lookup.StoredContext)
    raw = flows.pupil_frame(editions).where("ano = 2000")
    got = {r["id_registro"]: r["score"] for r in models.score(again, raw, "alfabetizado").collect()}
    assert got == {r["id_registro"]: r["score"] for r in engineered.scored().collect()}


def test_one_row_scores_as_it_does_among_all(spark, editions, engineered):
    raw = flows.pupil_frame(editions).where("ano = 2000").limit(1)
    one = models.score(engineered.whole(), raw, "alfabetizado").first()
    assert engineered.scored().where(F.col("id_registro") == one["id_registro"]).first()["score"] == one["score"]


PUPILS = [(1, 10, "11", "x", 2000, 0.5, 1), (2, 10, "11", "x", 2000, 0.7, 0), (3, 10, "11", "x", 2001, 0.9, 1), (4, 20, "12", "y", 2001, None, None), (5, None, None, "x", 2001, 0.2, 0)]
PUPIL_SCHEMA = "id_registro long, id_escola long, id_municipio string, rede string, ano int, presenca double, alfabetizado int"


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_context_of_known_new_and_earlier_editions(spark, limit):
    model = lookup.fit_groups(spark.createDataFrame(PUPILS, PUPIL_SCHEMA), limit_bytes=limit)
    new = [(11, 10, "11", "x", 2000, 0.5, 1), (12, 10, "11", "x", 2003, 0.5, None), (13, 10, "11", "x", 1990, 0.5, None), (14, 99, "11", "x", 2001, 0.5, None), (15, None, "11", "x", 2001, 0.5, None)]
    got = {r["id_registro"]: r for r in model.transform(spark.createDataFrame(new, PUPIL_SCHEMA)).collect()}
    assert len(got) == 5
    # Its own edition: the own label is taken out. A later edition: the last known one, nothing taken out.
    assert (got[11]["escola_num_alunos"], got[11]["escola_taxa_loo"]) == (2, 0.0)
    assert (got[12]["escola_num_alunos"], got[12]["escola_taxa_loo"], got[12]["escola_presenca_media"]) == (1, 1.0, 0.9)
    assert (got[13]["escola_num_alunos"], got[13]["escola_taxa_loo"]) == (2, 0.5)
    assert got[14]["escola_num_alunos"] is None and got[14]["mun_rede_num_alunos"] == 1 and got[15]["escola_num_alunos"] is None


def test_one_scan_gives_what_the_single_steps_give(spark, editions):
    base = flows.pupil_frame(editions)
    frame, _ = flows.engineered_frame(editions)
    steps = context.network_features(context.school_features(base)).drop("escola_taxa_alfabetizacao")
    steps = context.interaction_features(context.leave_one_out_rate(steps))
    columns = sorted(steps.columns)
    assert sorted(frame.columns) == columns
    rounded = lambda df: {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(columns).collect()}
    assert rounded(frame) == rounded(steps)


def test_the_base_is_scanned_twice(spark, editions, monkeypatch):
    reads = []
    base = stored(flows.pupil_frame(editions))
    folder = base.inputFiles()[0].rsplit("/", 1)[0]
    kept = lookup.materialise
    monkeypatch.setattr(lookup, "materialise", lambda df: (reads.append(df._jdf.queryExecution().executedPlan().toString().count("FileScan")), kept(df))[1])
    model = lookup.fit_groups(base)
    plan = model.transform(base)._jdf.queryExecution().optimizedPlan().toString()
    assert reads == [1]
    final = [line for line in plan.splitlines() if "Relation" in line]
    assert len(final) == 3 and folder  # the pupils once, and the two small tables


def test_lagged_history_never_comes_from_later(spark):
    rows = [("1100001", "x", 2000, 50.0, 700.0), ("1100001", "x", 2001, 60.0, 710.0)]
    past = lookup.fit_history(spark.createDataFrame(rows, "id_municipio string, rede string, ano int, taxa_alfabetizacao double, media_portugues double"))
    pupils = spark.createDataFrame([("1100001", "x", y) for y in (1999, 2000, 2001, 2002, 2005)], "id_municipio string, rede string, ano int")
    got = {r["ano"]: (r["taxa_hist"], r["taxa_uf_hist"]) for r in past.transform(pupils).collect()}
    assert got == {1999: (None, None), 2000: (None, None), 2001: (50.0, 50.0), 2002: (60.0, 60.0), 2005: (60.0, 60.0)}


def test_leakage_screen_finds_the_leak_and_ids(spark):
    draw = random.Random(2)
    rows = [(i, y := draw.randint(0, 1), float(y * 10 + draw.random()), draw.random(), f"k{i}", float("nan"), draw.choice("ab")) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, y int, leak double, noise double, key string, none double, kind string")
    got = {r["column"]: r for r in evaluate.leakage_screen(df, "y", ["leak", "noise", "key", "none", "kind"]).collect()}
    assert set(got) == {"leak", "noise", "key", "kind"}
    assert got["leak"]["suspicious"] and got["key"]["suspicious"] and got["leak"]["roc_auc"] == 1
    assert not got["noise"]["suspicious"] and got["kind"]["separation"] < 0.7 and got["leak"]["n_known"] == 400


def test_next_values_reach_over_slices(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v"), (F.col("id") % 5).alias("w")).repartition(13)
    order = {r["v"]: r["w"] for r in df.collect()}
    got = {r["v"]: r["next_w"] for r in next_values(df, [F.desc("v")], ["w"]).collect()}
    assert got == {v: order.get(v - 1) for v in order}
    assert next_values(df.where("false"), ["v"], ["w"]).count() == 0


def test_corners_keep_the_area(spark):
    draw = random.Random(5)
    rows = [(y := draw.randint(0, 1), 0, draw.choice([round(draw.random(), 2), 0.5, y * 0.7])) for _ in range(3000)]
    scored = spark.createDataFrame(rows, "label int, prediction int, score double")
    full, compact = evaluate.roc_curve(scored), evaluate.roc_curve_compact(scored)
    assert compact.count() < full.count()
    assert compact.exceptAll(full).count() == 0
    areas = [evaluate.curve_area(c).first()["area"] for c in (full, compact)]
    assert areas == pytest.approx([evaluate.roc_auc(scored).first()[0]] * 2)


def test_rollup_has_every_level(spark):
    rows = [("a", "x", 1, 1), ("a", "y", 0, 1), ("b", "x", 1, 0), (None, "x", 1, 1)]
    got = {(r["s"], r["n"], r["level"]): (r["n_rows"], r["accuracy"]) for r in evaluate.metrics_rollup(spark.createDataFrame(rows, "s string, n string, label int, prediction int"), ["s", "n"]).collect()}
    assert got[None, None, 0] == (4, 0.5) and got["a", None, 1] == (2, 0.5) and got[None, None, 1] == (1, 1.0) and got["b", "x", 2] == (1, 0.0)
    assert len(got) == 8


def test_joins_that_match_nothing_are_noticed(spark):
    df = spark.createDataFrame([(1, "11"), (2, "35"), (3, "99")], "id int, sigla_uf string")
    targets = spark.createDataFrame([("RO", 2024, 60.0), ("SP", 2024, 70.0)], "sigla_uf string, ano_meta int, meta double")
    right = context.enrich_targets_observed(df, targets, [2024], "letters")
    assert {r["id"]: r["meta_uf_2024"] for r in right.frame.collect()} == {1: 60.0, 2: 70.0, 3: None}
    assert right.counts() == (3, 2) and right.require() == pytest.approx(2 / 3)
    wrong = context.enrich_targets_observed(df, targets, [2024])
    wrong.frame.collect()
    with pytest.raises(ValueError):
        wrong.require()
    indicators = spark.createDataFrame([("11", 5.0)], "sigla_uf string, taxa double")
    found = context.enrich_indicators_observed(df.withColumn("id_municipio", F.col("sigla_uf")), indicators, ["sigla_uf"], columns=["taxa"])
    assert {r["id"]: r["mun_taxa"] for r in found.frame.collect()} == {1: 5.0, 2: None, 3: None} and found.rate() == pytest.approx(1 / 3)


def test_export_counts_while_it_writes(spark, tmp_path):
    frames = {"a": spark.range(10).selectExpr("id", "'x\ny' AS t"), "b": spark.range(0).selectExpr("id")}
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("export", "")
    got = {r["table"]: r["n_rows"] for r in samples.export_samples(frames, str(tmp_path)).collect()}
    assert got == {"a": 10, "b": 0}
    assert len(jobs.getJobIdsForGroup("export")) <= 3
    spark.sparkContext.setJobGroup("tests", "")


def test_antithetic_orders_are_reversed_and_add_up(spark, editions):
    features = ["presenca", "caderno", "rede"]
    train, test = splits.temporal_split(editions, "ano", 1999, 2000)
    model = models.fit(models.build_pipeline(train, "individual", "alfabetizado", features, **SHORT), train)
    background = explain.background_rows(train, features, "id_registro", 8)
    paths = explain.shapley_paths(test, background, features, "id_registro", 8, 4, antithetic=True)
    orders = {(r["id_registro"], r["_perm"]): r["_order"] for r in paths.select("id_registro", "_perm", "_order").distinct().collect()}
    assert all(orders[i, p] == orders[i, p - 1][::-1] for i, p in orders if p % 2)
    found = explain.shapley_with_error(model, test, background, features, "id_registro", 8, pairs=2)
    rows = found.collect()
    assert all(r["std_error"] >= 0 and r["n_pairs"] == 2 for r in rows)
    narrow = explain.shapley_until(model, test.limit(20), background, features, "id_registro", 8, tolerance=0.02, pairs=2, most=8)
    assert {r["n_pairs"] for r in narrow.collect()} <= {2, 4, 8} and narrow.count() == 60


def test_rows_without_a_key_are_dealt_evenly(spark):
    df = spark.range(2000).selectExpr("CAST(NULL AS long) AS k", "id", "CAST(id % 2 AS int) AS y")
    folded = splits.stratified_folds(df, "y", "k", folds=4)
    assert {r["count"] for r in folded.groupBy("y", "fold").count().collect()} == {250}


@pytest.mark.parametrize("rungs", [1, 2])
def test_search_by_rungs_ranks_all_candidates(spark, editions, rungs):
    train, _ = splits.temporal_split(editions, "ano", 1999, 2000)
    folded = splits.stratified_folds(train, "alfabetizado", "id_registro", folds=2)
    best, ranked = tuning.random_search(folded, "alfabetizado", TabularPreprocessor(["presenca"], ["rede"]), draws=3, folds=2, rungs=rungs, n_estimators=4, max_depth=2)
    assert [r["rank"] for r in ranked.orderBy("rank").collect()] == [1, 2, 3]
    assert models.score(best, train, "alfabetizado").count() == train.count()


def test_the_model_is_fitted_beside_its_fold_models(editions, monkeypatch):
    fitted = flows.pupil_flow(editions, 1999, 2000, **SHORT)
    barrier, kept = threading.Barrier(4, timeout=120), models.fit
    monkeypatch.setattr(models, "fit", lambda *a: (barrier.wait(), kept(*a))[1])
    # Breaks if any of the four fits waits for another.
    assert fitted.out_of_fold(3).select("fold").distinct().count() == 3
    assert fitted.model is fitted.model and fitted.scored().count() == fitted.test.count()


def test_boosting_has_no_more_tasks_than_cores():
    assert [models.tasks_for(n, 12) for n in (0, 50_000, 300_000, 1_800_000, 9_000_000)] == [1, 1, 6, 12, 18]


def test_search_reads_cells_and_not_rows(spark, tmp_path):
    """However many rows there are, fits read one per combination of bins, and all rows count in it."""
    sizes = []
    for n in (20_000, 80_000):
        df = spark.range(n).selectExpr(
            "id", "CAST((id * 7919) % 10007 / 10007 AS double) AS x", "IF(id % 11 = 0, NULL, CAST(id % 3 AS string)) AS c",
            "CAST((id * 31) % 100 < 20 + 60 * ((id * 7919) % 10007) / 10007 AS int) AS y", "CAST(id % 2 AS int) AS fold",
        ).withColumn("x", F.when(F.col("id") % 13 != 0, F.col("x")))
        bins, fitted, vectors = tuning.prepared(df, "y", TabularPreprocessor(["x"], ["c"]), F.col("fold") == 0)
        held = {r["held_back"]: r["n"] for r in vectors.groupBy("held_back").agg(F.sum("n_rows").alias("n")).collect()}
        assert held == {True: n / 2, False: n / 2} and len(bins.ends["x"]) == 31
        sizes.append(vectors.count())
        assert sizes[-1] <= 32 * 4 * 2 * (tuning.PARTS + 1)
    assert sizes[1] < 1.5 * sizes[0]
    best, ranked = tuning.random_search(df, "y", TabularPreprocessor(["x"], ["c"]), draws=2, folds=2, n_estimators=4, max_depth=2)
    assert ranked.agg(F.max("mean_auc")).first()[0] > 0.6
    scored = models.score(best, df, "y").select("id", "score")
    path = str(tmp_path / "best")
    models.save_model(best, path)
    again = models.score(models.load_model(spark, path), df, "y").select("id", "score")
    assert scored.count() == 80_000 and scored.exceptAll(again).count() == 0


def test_bins_keep_few_values_and_missing_ones(spark):
    df = spark.createDataFrame([(float(i % 5), float(i)) for i in range(100)] + [(None, float("nan"))], "few double, many double")
    bins = prep.fit_bins(df, ["few", "many"])
    assert bins.ends["few"] == [0, 1, 2, 3, 4] and len(bins.ends["many"]) == prep.BINS
    new = spark.createDataFrame([(1.5, 1e9), (None, float("nan")), (9.0, -5.0)], "few double, many double")
    assert [tuple(r) for r in bins.transform(new).collect()] == [(2.0, 99.0), (None, None), (4.0, bins.ends["many"][0])]


def test_past_results_replace_those_of_the_same_edition(spark, sf_dir):
    features = tpch.features_ml(tpch.indicadores(tpch.alunos(spark, sf_dir)))
    fitted = flows.aggregate_flow(features, 1999, 2000, past=True, **SHORT)
    assert "media_portugues_anterior" in fitted.train.columns and "media_portugues" not in fitted.train.columns
    before = {(r["id_municipio"], r["rede"]): r["media_portugues"] for r in features.where("ano = 1998").collect()}
    assert all(before[r["id_municipio"], r["rede"]] == r["media_portugues_anterior"] for r in fitted.train.collect())


def test_bucketed_joins_need_no_exchange(spark, editions):
    rows = stored(editions.select("id_registro", "id_escola", "ano", "presenca", "alfabetizado"))
    table = bucketed.bucketed(rows, context.SCHOOL_KEYS, buckets=4)
    out = bucketed.with_group_stats(table, context.SCHOOL_KEYS, context.school_stats())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    rounded = lambda df: {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(sorted(out.columns)).collect()}
    assert rounded(out) == rounded(context.school_features(rows))
