import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairmine.functions import vectors
from pairmine.operators import enrichment, report, skew
from pairmine.operators.quantiles import exact_quantiles

ASSETS = "image_url string, http_ok boolean, declared_length long, width int, height int, decodable boolean"


def test_asset_reasons(spark):
    cases = {
        "http://e/ok.png": (True, 5120, 224, 224, True, None),
        "http://e/err.png": (False, 9000, 300, 300, True, "http_error"),
        "http://e/nolen.png": (True, None, 300, 300, True, "too_small"),
        "http://e/small.png": (True, 5119, 300, 300, True, "too_small"),
        "http://e/narrow.png": (True, 9000, 223, 300, True, "low_resolution"),
        "http://e/flat.png": (True, 9000, 300, 223, True, "low_resolution"),
        "http://e/bad.png": (True, 9000, None, None, False, "undecodable"),
        "ftp://e/x.png": (True, 9000, 300, 300, True, "invalid_url"),
    }
    assets = spark.createDataFrame([(u, *c[:5]) for u, c in cases.items()], ASSETS)
    pending = spark.createDataFrame(
        [(u, u, "text") for u in [*cases, "http://e/missing.png"]],
        "prediction_id string, image_url string, predicted_text string",
    )
    out = {r.image_url: r for r in enrichment.admit_assets(pending, assets).collect()}
    assert {u: out[u].reject_reason for u in cases} == {u: c[5] for u, c in cases.items()}
    assert out["http://e/missing.png"].reject_reason == "http_error"
    assert out["http://e/ok.png"].image_local_path.endswith("_ok.png")
    assert out["http://e/bad.png"].image_local_path is None


def test_similarity(spark):
    rows = [
        ("same", [1.0, 2.0], [2.0, 4.0], "t"), ("orthogonal", [1.0, 0.0], [0.0, 3.0], "t"),
        ("opposite", [1.0, 0.0], [-1.0, 0.0], "t"), ("none", None, [1.0], "t"), ("blank", [1.0], [1.0], ""),
        ("zero", [0.0], [1.0], "t"), ("sizes", [1.0], [1.0, 2.0], "t"),
    ]
    df = spark.createDataFrame(rows, "k string, a array<float>, b array<float>, t string")
    score = enrichment.pair_similarity(F.col("t"), F.col("a"), F.col("b"))
    out = {r.k: r.s for r in df.select("k", score.alias("s")).collect()}
    assert out["same"] == pytest.approx(1.0) and out["orthogonal"] == 0.0
    assert out["opposite"] == pytest.approx(-1.0) and out["zero"] == 0.0
    assert out["none"] is None and out["blank"] is None and out["sizes"] is None


def test_outcomes_and_counters(spark):
    rows = [("a", None, 0.5), ("b", "too_small", None), ("c", None, None)]
    df = spark.createDataFrame(rows, "prediction_id string, reject_reason string, clip_score double")
    out = df.withColumn("error_message", enrichment.error_message())
    assert {r.prediction_id: r.error_message for r in out.collect()} == {
        "a": None, "b": "Download/Validation failed", "c": "CLIP scoring failed",
    }
    assert tuple(enrichment.enrichment_counters(out).first()) == (3, 1, 1, 1)


def test_text_encoder_hook(spark):
    def make():
        return lambda lengths: np.stack([lengths, -lengths], axis=1).astype(np.float32)

    df = spark.createDataFrame([(1.0,), (2.0,)], "x float")
    out = df.select(enrichment.embed(make, "x").alias("e")).collect()
    assert sorted(r.e for r in out) == [[1.0, -1.0], [2.0, -2.0]]


def test_hot_keys_are_spread_without_changing_the_join(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.4 else (None if rng.random() < 0.2 else f"k{i % 50}")) for i in range(2000)]
    left = spark.createDataFrame(rows, "id long, key string")
    right = spark.createDataFrame([(f"k{i}", i) for i in range(40)] + [("hot", -1)], "key string, v int")
    for how in ("left", "inner"):
        plain = left.join(right, "key", how).select("id", "key", "v").collect()
        hot = skew.hot_keys(left, "key", 3)
        salted = skew.salted_join(left, right, "key", "id", hot, how, salts=16).select("id", "key", "v").collect()
        assert sorted(plain, key=str) == sorted(salted, key=str)


@pytest.mark.parametrize("kind", ["uniform", "heavy", "ties", "tiny"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(7)
    values = {
        "uniform": rng.random(60_000),
        "heavy": np.exp(rng.normal(size=60_000) * 4),
        "ties": np.where(rng.random(60_000) < 0.35, 0.25, rng.integers(0, 5, 60_000) / 4.0),
        "tiny": np.array([3.0, 1.0, 2.0]),
    }[kind]
    df = spark.createDataFrame([("m", float(v)) for v in values], "measure string, value double").repartition(6)
    qs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    out = {r.probability: r.value for r in exact_quantiles(df, "measure", "value", qs).collect()}
    for q in qs:
        assert out[q] == pytest.approx(float(np.quantile(values, q)), rel=1e-12)


@pytest.mark.parametrize("kind", ["uniform", "heavy", "ties", "wide"])
def test_quantiles_by_narrowing(spark, monkeypatch, kind):
    from pairmine.operators import quantiles

    monkeypatch.setattr(quantiles, "BAND_VALUES", 20)
    rng = np.random.default_rng(8)
    values = {
        "uniform": rng.random(60_000),
        "heavy": np.exp(rng.normal(size=60_000) * 40),
        "ties": np.where(rng.random(60_000) < 0.35, 0.25, rng.random(60_000)),
        "wide": np.concatenate([rng.random(59_998) * 1e-9, [1e300, -1e300]]),
    }[kind]
    ranked, bands = quantiles._ranked, []

    def watched(rows, targets, group):
        bands.extend(targets.collect())
        return ranked(rows, targets, group)

    monkeypatch.setattr(quantiles, "_ranked", watched)
    df = spark.createDataFrame([("m", float(v)) for v in values], "measure string, value double").repartition(6)
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    out = {r.probability: r.value for r in exact_quantiles(df, "measure", "value", qs).collect()}
    for q in qs:
        assert out[q] == pytest.approx(float(np.quantile(values, q)), rel=1e-12)
    for band in bands:
        assert len(set(values[(values >= band["_low"]) & (values <= band["_high"])])) <= 40


RESULTS = (
    "prediction_id string, image_url string, predicted_text string, start_confidence double, "
    "end_confidence double, average_confidence double, span_confidence double, clip_score double"
)


def test_report(spark):
    rows = [(str(i), f"u{i}", "word " * 20, i / 9, 1 - i / 9, 0.5, i / 18, i / 10 - 0.2) for i in range(10)]
    df = spark.createDataFrame(rows, RESULTS)
    preview = report.preview(df).collect()
    assert [r.clip_score for r in preview] == ["0.7000", "0.6000", "0.5000", "0.4000", "0.3000"]
    assert len(preview[0].description) == 53
    summary = {r.measure: r for r in report.summary(df).collect()}
    assert summary["clip_score"].n == 10 and summary["clip_score"].median == pytest.approx(0.25)
    assert {r.measure: r.pearson for r in report.correlation(df).collect()}["start_confidence"] == pytest.approx(1.0)
    assert sum(r.n for r in report.histogram(df).collect()) == 10
    box = {r.measure: r for r in report.boxplot(df).collect()}
    assert box["clip_score"].outliers == 0 and box["clip_score"].whisker_high == pytest.approx(0.7)
    assert sum(r.n for r in report.heatmap(df).collect()) == 10


def test_self_similarity_is_one(spark):
    rng = np.random.default_rng(1)
    rows = [([float(x) for x in rng.normal(size=16)],) for _ in range(50)]
    df = spark.createDataFrame(rows, "e array<float>")
    out = df.select(vectors.cosine(F.col("e"), F.col("e")).alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in out)


def test_values_outside_have_bins_of_their_own(spark):
    from pairmine.operators import report

    values = [-1.5, -1.0, -0.95, 0.0, 0.999, 1.0, 1.0001, None]
    df = spark.createDataFrame([(v,) for v in values], "clip_score double")
    assert {r.bin: r.n for r in report.histogram(df).collect()} == {-1: 1, 0: 2, 10: 1, 19: 2, 20: 1}
