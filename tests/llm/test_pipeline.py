import pytest

import corpus_pipeline as pipeline
from nightgrid.llm.common import written


@pytest.fixture(scope="module", params=["odd", "sf0.001"])
def stages(request, spark, odd_dir, sf_dir):
    path = odd_dir if request.param == "odd" else sf_dir
    docs = spark.read.parquet(f"{path}/documents.parquet")
    results = [docs]
    for name, stage in pipeline.STAGES:
        results.append(written(stage(spark, results[-1], path), name))
    return path, results


def test_columns_and_rows(stages):
    _, results = stages
    assert all(r.columns == pipeline.COLUMNS for r in results[1:-1])
    counts = [r.count() for r in results]
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] == counts[-3] > 0


def test_one_of_each_group_stays(stages):
    _, results = stages
    before, after = results[1].collect(), results[2].collect()
    assert {r.text for r in after} <= {r.text for r in before}
    assert len({r.text for r in after}) == len(after)


def test_no_personal_data_or_benchmark_left(stages, spark):
    from nightgrid.llm import decontamination, pii

    path, results = stages
    assert all(not pii.base_spans(r.text) for r in results[4].collect())
    items = spark.read.parquet(f"{path}/benchmark.parquet")
    assert decontamination.find_contamination(results[3], items).where("n_hit > 0").count() == 0


def test_ids_decode(stages):
    from nightgrid.llm.bpe import TOKENIZER, coder
    from nightgrid.llm.common import tokenizer_path

    _, results = stages
    texts = {r.doc_id: r.text for r in results[4].collect() if r.doc_id is not None}
    tokenizer = coder(tokenizer_path(TOKENIZER)).tokenizer
    for r in results[5].collect():
        if r.doc_id is not None:
            assert tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids == list(r.token_ids)


def test_empty_tables(spark, empty_dir):
    assert pipeline.run(spark, empty_dir).count() == 0
