import re

import corpus_pipeline
import pytest
from riskweave.llm import decontamination, queries, simhash, substrings
from riskweave.session import new_path


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf).write.parquet(path)
        docs = kept[name] = spark.read.parquet(path)
    return kept


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "decontamination", "mixing"]
    for name in [*stages][:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_toxicity_drops_what_the_operator_rejects(spark, sf, stages):
    said = {r.doc_id: r.predicted for r in queries.QUERIES["op6_toxicity"](spark, sf).collect()}
    assert {r.doc_id for r in stages["toxicity"].select("doc_id").collect()} == {i for i, p in said.items() if not p}


def test_one_of_each_near_duplicate_group_stays(stages):
    near = simhash.near_duplicates(stages["toxicity"]).collect()
    assert sorted(r.doc_id for r in stages["near_duplicates"].select("doc_id").collect()) == sorted({r.component_id for r in near})


def test_repeats_are_cut_and_documents_stay(stages):
    before = {r.doc_id: r for r in stages["near_duplicates"].collect()}
    after = {r.doc_id: r for r in stages["substring_dedup"].collect()}
    assert set(before) == set(after)
    cut = {r.doc_id: r for r in substrings.deduplicate(stages["near_duplicates"]).collect()}
    assert all(after[i].text == bytes(cut[i].kept).decode("utf-8", "ignore") and after[i].n_chars == len(after[i].text) for i in after)
    assert any(after[i].text != before[i].text for i in after)


def test_no_benchmark_window_is_left(spark, sf, stages):
    hit = decontamination.contamination(stages["substring_dedup"], spark.read.parquet(f"{sf}/benchmark.parquet")).where("contaminated")
    gone = {r.doc_id for r in hit.collect()}
    assert {r.doc_id for r in stages["decontamination"].select("doc_id").collect()} == {r.doc_id for r in stages["substring_dedup"].select("doc_id").collect()} - gone


def test_mix_takes_about_its_target(stages):
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in stages["decontamination"].collect()}
    taken, target = {}, {}
    texts = {r.doc_id: r.text for r in stages["decontamination"].collect()}
    for r in stages["mixing"].collect():
        assert r.text == texts[r.doc_id]
        assert 0 < r.taken <= 3 * r.size == 3 * sizes[r.doc_id]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= 48


def test_registered_queries():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline", *queries.QUERIES} <= names and set(queries.ORACLE) <= set(queries.QUERIES)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


def test_run_leaves_only_its_result_in_the_shared_folder(spark, sf):
    import os

    from riskweave.session import shared_dir

    folder = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(folder))
    result = corpus_pipeline.run(spark, sf)
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and left.pop().startswith("mixing-") and result.count() > 0
