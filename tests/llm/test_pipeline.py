"""The pipeline over the small tables, against the operators' own brute-force twins."""

import os

import pytest

import corpus_pipeline
from pairmine.llm import decontaminate, quality

from .test_simhash import brute_classes

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = []
    for number, (name, function) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        function(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append((name, docs))
        if number < 4:
            assert docs.columns == columns
            assert docs.filter("n_chars <> length(text)").count() == 0
    by = dict(seen)
    first = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(first, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.score(first, model).collect() if r.score >= quality.KEEP_FROM}
    assert {r.doc_id for r in by["quality classifier"].collect()} == good
    from pairmine.llm import simhash

    cleaned = {r.doc_id: r.text for r in by["line dedup"].collect()}
    ids = sorted(cleaned)
    codes = [int(c) for c in simhash.fingerprints([simhash.shingle_hashes(cleaned[i]) for i in ids])]
    classes, kept = brute_classes(codes), {}
    for i, c in zip(ids, codes, strict=True):
        kept.setdefault(classes[c], i)
    assert {r.doc_id for r in by["simhash near-dedup"].collect()} == set(kept.values())
    items = [(str(r.item_id), decontaminate.split_words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    masks, _ = decontaminate.Patterns(items).search([decontaminate.split_words(cleaned[i]) for i in sorted(kept.values())])
    clean = {i for i, m in zip(sorted(kept.values()), masks, strict=True) if not m.any()}
    assert {r.doc_id for r in by["benchmark decontamination"].collect()} == clean
    assert {r.doc_id for r in by["packing"].select("doc_id").distinct().collect()} == clean


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
