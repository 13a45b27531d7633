"""Each stage of the pipeline on its own input, against brute force."""

import corpus_pipeline as pipeline
from ambar.llm.common import setup
from ambar.llm.queries import QUERIES
from ambar.llm.tokens import public_path
from tests.llm.test_near_dup import brute
from tests.llm.test_packing_and_counts import check_packing, library
from tests.llm.test_rules_and_matches import brute_hits


def test_stages_one_by_one(spark, sf_dir):
    docs = setup(spark).read.parquet(f"{sf_dir}/documents.parquet").cache()
    stage = dict(pipeline.STAGES)
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "quality", "near_dup", "decontaminate", "packing"]
    rows = {r["doc_id"]: r for r in docs.collect()}
    predicted = {r["doc_id"]: r["predicted"] for r in QUERIES["op2_toxicity"](spark, sf_dir).collect()}
    quality = {r["doc_id"]: r["kept"] for r in QUERIES["op7_site_quality"](spark, sf_dir).collect()}
    component, _ = brute([(i, r["text"]) for i, r in rows.items()])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {
        "toxicity": {i for i in rows if not predicted[i]},
        "quality": {i for i in rows if quality[i]},
        "near_dup": {i for i in rows if component[i] == i},
        "decontaminate": {i for i, r in rows.items() if not brute_hits(r["text"], items)[4]},
    }
    for name, ids in want.items():
        out = stage[name](spark, docs, sf_dir)
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.collect()} == {tuple(rows[i]) for i in ids}, name


def test_run_packs_what_all_stages_keep(spark, sf_dir):
    docs = setup(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
    check_packing(pipeline.run(spark, sf_dir).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, library(public_path("word_bpe_49k.json")))


def test_a_broken_run_goes_on_where_it_stopped(spark, sf_dir, tmp_path, monkeypatch):
    import pytest

    def broken(spark, docs, sf_dir):
        raise RuntimeError("lost")

    folder, whole = str(tmp_path / "run"), list(pipeline.STAGES)
    monkeypatch.setattr(pipeline, "STAGES", [*whole[:2], ("near_dup", broken), *whole[3:]])
    with pytest.raises(RuntimeError):
        pipeline.run(spark, sf_dir, folder)
    # The finished stages aren't computed again.
    monkeypatch.setattr(pipeline, "STAGES", [(whole[0][0], broken), (whole[1][0], broken), *whole[2:]])
    again = pipeline.run(spark, sf_dir, folder)
    assert sorted(p.name for p in (tmp_path / "run").iterdir()) == [f"{i}-{name}" for i, (name, _) in enumerate(whole, 1)]
    monkeypatch.setattr(pipeline, "STAGES", whole)
    first = pipeline.run(spark, sf_dir)
    assert again.exceptAll(first).count() == first.exceptAll(again).count() == 0


def test_edge_rows(spark, sf_dir):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "x y z", "en", "s", 5), (3, "x y z", "en", "s", 5), (None, "x y z", None, None, 1)]
    docs = setup(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf_dir).collect()
        if name == "near_dup":
            assert sorted(r["doc_id"] for r in out if r["doc_id"] is not None) == [1, 2, 3]
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
