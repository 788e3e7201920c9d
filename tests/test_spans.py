import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairmine.functions import spans
from pairmine.operators import metrics, prediction, training
from pairmine.schemas import METRIC_HISTORY

LABELLED = "start_token int, end_token int, true_start_token int, true_end_token int"


def labelled(spark, truths):
    rows = [(*p, *t) for p, t in zip([(5, 10), (2, 2), (7, 9)], truths)]
    return spark.createDataFrame(rows, LABELLED)


def test_exact_match_and_iou(spark):
    first = labelled(spark, [(5, 10), (2, 2), (7, 8)])
    assert metrics.exact_match(first).first()[0] == pytest.approx(2 / 3)
    assert metrics.mean_iou(first).first()[0] == pytest.approx(8 / 9)
    second = labelled(spark, [(5, 10), (2, 5), (7, 8)])
    assert metrics.mean_iou(second).first()[0] == pytest.approx(23 / 36)
    inverted = labelled(spark, [(5, 10), (2, 1), (7, 8)])
    assert metrics.mean_iou(inverted).first()[0] == pytest.approx((1 + 0 + 2 / 3) / 3)


def test_metrics_without_rows(spark):
    none = spark.createDataFrame([], LABELLED)
    assert metrics.exact_match(none).first()[0] == 0.0
    assert metrics.mean_iou(none).first()[0] == 0.0


LOGITS = "context_id string, start_logits array<float>, end_logits array<float>, seq_len int, sequence_tokens array<string>"
TOKENS = ["[CLS]", "it", "'", "s", "red", ".", "[IMG]", "[SEP]"]


def logits(spark, *cases):
    rows = []
    for i, (start, end) in enumerate(cases):
        a, b = [0.0] * 10, [0.0] * 10
        a[start], b[end] = 2.0, 1.0
        rows.append((str(i), a, b, 8, TOKENS))
    return spark.createDataFrame(rows, LOGITS)


def test_decoding(spark):
    df = logits(spark, (1, 5), (5, 1), (9, 9), (6, 7), (0, 1))
    out = {r.context_id: r for r in prediction.decode_predictions(df).collect()}
    # Inverted, in the padding and without text: dropped.
    assert set(out) == {"0", "4"}
    assert out["0"].predicted_text == "it's red."
    assert out["4"].predicted_text == "it"
    start, end = math.exp(2) / (math.exp(2) + 9), math.e / (math.e + 9)
    assert out["0"].start_confidence == pytest.approx(start)
    assert out["0"].average_confidence == pytest.approx((start + end) / 2)
    assert out["0"].span_confidence == pytest.approx(math.sqrt(start * end))
    product = prediction.decode_predictions(df, "product").first()
    assert product.span_confidence == pytest.approx(start * end)
    counters = prediction.inference_counters(df, prediction.decode_predictions(df)).first()
    assert tuple(counters) == (5, 2)


def test_first_maximum_wins_and_softmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "l array<float>")
    row = df.select(
        spans.argmax(F.col("l")),
        spans.softmax(F.col("l")),
        spans.peak_probability(F.col("l")),
        spans.cross_entropy(F.col("l"), F.lit(0)),
    ).first()
    p = np.exp([1.0, 3.0, 3.0]) / np.exp([1.0, 3.0, 3.0]).sum()
    assert row[0] == 1
    assert row[1] == pytest.approx(list(p))
    assert row[2] == pytest.approx(p[1])
    assert row[3] == pytest.approx(-math.log(p[0]))


def test_decoding_from_ids(spark):
    vocab = spark.createDataFrame([("red", 5), ("car", 6), ("a", 7)], "token string, token_id int")
    df = spark.createDataFrame(
        [("1", [2, 7, 5, 6, 4, 3], 6, 2, 4), ("2", [2, 4, 3], 3, 1, 1)],
        "context_id string, sequence array<int>, seq_len int, start_token int, end_token int",
    )
    out = prediction.decode_spans(prediction.token_strings(df, "context_id", vocab)).collect()
    assert [(r.context_id, r.predicted_text) for r in out] == [("1", "red car")]
    wide = prediction.token_strings(df, "context_id", vocab, vocabulary_rows=10**9)
    assert prediction.decode_spans(wide).collect()[0].predicted_text == "red car"


def test_any_model_plugs_in(spark):
    def make():
        def predict(input_ids, attention_mask):
            ids = np.asarray(input_ids, dtype=np.float32)
            return {"start_logits": ids, "end_logits": -ids}

        return predict

    df = spark.createDataFrame(
        [("a", [1, 5, 2], [1, 1, 1])] * 70, "context_id string, input_ids array<int>, attention_mask array<int>"
    )
    out = prediction.predict_logits(df, make, max_len=3, batch_size=8).distinct().collect()
    assert [(r.start_logits, r.end_logits) for r in out] == [([1.0, 5.0, 2.0], [-1.0, -5.0, -2.0])]


def history(spark, runs, metric="val_loss"):
    rows = [(run, i, metric, float(v)) for run, values in runs.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, METRIC_HISTORY)


def test_best_epoch_and_early_stop(spark):
    df = history(spark, {"a": [3, 2, 2.5, 2.4, 1], "b": [5, 4, 3, 2.5, 1.5]})
    best = {r.run_id: (r.epoch, r.value) for r in training.best_epochs(df, "val_loss", patience=2).collect()}
    assert best == {"a": (1, 2.0), "b": (4, 1.5)}
    assert training.select_best_run(df, "val_loss", patience=2).first().run_id == "b"
    assert training.select_best_run(df, "val_loss", patience=10).first().run_id == "a"


def test_selection_by_overlap_takes_the_largest(spark):
    df = history(spark, {"a": [0.1, 0.6], "b": [0.2, 0.5]}, "val_iou")
    assert tuple(training.select_best_run(df, "val_iou").first()) == ("a", 1, 0.6)


def examples(spark, count=60):
    from pairmine.operators import encoding

    rows = []
    for i in range(count):
        before, width = i % 5, 2 + i % 2
        sequence = [2] + [20 + i % 7] * before + [4] + [50 + width] * 6 + [3]
        start = 1 + before
        rows.append((str(i), sequence, len(sequence), start, start + width - 1))
    schema = "context_id string, sequence array<int>, seq_len int, true_start_token int, true_end_token int"
    return encoding.pad_and_mask(spark.createDataFrame(rows, schema), 24)


def test_training_learns_and_survives_a_reload(spark, tmp_path):
    data = examples(spark).cache()
    model, log = training.train_span_model(
        spark, data, data, 24, reg_params=[0.0, 1.0], max_epochs=10, monitor="val_iou", buckets=64, learning_rate=0.3
    )
    values = {(r.run_id, r.metric, r.epoch): r.value for r in log.collect()}
    assert {(run, name, e) for run in ("reg=0.0", "reg=1.0") for name in ("loss", "val_loss", "val_iou", "val_exact_match")
            for e in range(10)} == set(values)
    lengths = [len(r.sequence) for r in data.select("sequence").collect()]
    assert values[("reg=0.0", "loss", 0)] == pytest.approx(np.log(lengths).mean())
    losses = [values[("reg=0.0", "loss", e)] for e in range(10)]
    assert losses == sorted(losses, reverse=True) and max(values[("reg=0.0", "val_iou", e)] for e in range(10)) > 0.7
    # What an epoch validates is the loss that the next one starts from.
    for e in range(9):
        assert values[("reg=0.0", "val_loss", e)] == pytest.approx(losses[e + 1], abs=1e-4)
    model.save(str(tmp_path / "model"))
    training.write_history(log, str(tmp_path / "history"))
    loaded = training.PointerModel.load(str(tmp_path / "model"))
    assert loaded.buckets == 64 and np.array_equal(loaded.weights, model.weights)
    assert training.evaluate(loaded, data, 24) == training.evaluate(model, data, 24)
    best = training.select_best_run(log, "val_iou").first()
    assert training.evaluate(model, data, 24)["iou"] == pytest.approx(best.value)
    assert spark.read.json(str(tmp_path / "history")).count() == log.count()


def test_gradients_match_differences_and_partitions(spark):
    data = examples(spark, 20)
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(2, training.weight_count(16)))
    gradient, loss, count = training.gradient_sums(data.repartition(5), {"a": weights}, 16)["a"]
    assert count == 20
    again = training.gradient_sums(data.coalesce(1), {"a": weights, "b": weights * 0}, 16)
    assert np.allclose(again["a"][0], gradient) and again["a"][1] == pytest.approx(loss)
    for head, place in [(0, 4), (1, 16 + 2), (0, 3 * 16 + training.MAX_DISTANCE), (1, 3 * 16 + training.MAX_DISTANCE + 1)]:
        moved = weights.copy()
        moved[head, place] += 1e-5
        there = training.gradient_sums(data, {"a": moved}, 16)["a"][1]
        assert (there - loss) / 1e-5 == pytest.approx(gradient[head, place], abs=1e-3)


def test_patience_ends_a_run_and_keeps_its_best_epoch(spark):
    data = examples(spark, 24).cache()
    # Steps this large overshoot, so the loss rises again.
    model, log = training.train_span_model(
        spark, data, data, 24, reg_params=[3.0], max_epochs=30, patience=2, buckets=32, learning_rate=2.0
    )
    values = {r.epoch: r.value for r in log.filter("metric = 'val_loss'").collect()}
    best = min(values, key=lambda e: (values[e], e))
    assert len(values) < 30 and max(values) == best + 2
    assert training.evaluate(model, data, 24)["loss"] == pytest.approx(values[best])


def test_small_steps_and_no_validation(spark):
    data = examples(spark, 24)
    model, log = training.train_span_model(spark, data, None, 24, reg_params=[0.0], max_epochs=3, buckets=32, steps=2)
    assert {r.metric for r in log.collect()} == {"loss"} and log.count() == 3
    assert training.evaluate(model, data, 24)["loss"] < log.filter("epoch = 0").first().value


def test_scorer_agrees_with_the_features(spark):
    data = examples(spark, 5)
    weights = np.random.default_rng(2).normal(size=(2, training.weight_count(32)))
    scored = prediction.predict_logits(data, training.PointerModel(weights, 32).make_predict_fn(), 24).collect()
    for row in scored:
        tokens = np.array(row.sequence)
        features = training.position_features(tokens, np.array([0]), np.array([len(tokens)]), 32)
        own = sum(weights[0][f] for f in features)
        assert row.start_logits[: len(tokens)] == pytest.approx(own.tolist(), abs=1e-4)
        assert set(row.start_logits[len(tokens):]) <= {-10_000.0}


def test_runs_are_evaluated_in_one_pass(spark):
    rng = np.random.default_rng(5)
    rows = [([2, 7, 4, 9, 3] + [0] * 3, [1] * 5 + [0] * 3, s, e) for s, e in ((2, 3), (0, 4), (None, 3), (3, 9))]
    df = spark.createDataFrame(rows, "input_ids array<int>, attention_mask array<int>, true_start_token int, true_end_token int")
    models = {n: training.PointerModel(rng.normal(size=(2, training.weight_count(32))), 32, 8) for n in ("a", "b")}
    got = training.evaluate_all(models, df, 8)
    for name, model in models.items():
        assert got[name] == training.evaluate(model, df, 8)
        scored = prediction.best_positions(prediction.predict_logits(df, model.make_predict_fn(), 8))
        loss = (spans.cross_entropy(F.col("start_logits"), F.col("true_start_token")) + spans.cross_entropy(F.col("end_logits"), F.col("true_end_token"))) / 2
        columns = [F.col(c) for c in ("start_token", "end_token", "true_start_token", "true_end_token")]
        row = scored.agg(
            F.avg(loss).alias("loss"), F.avg(spans.is_exact_match(*columns).cast("double")).alias("exact_match"), F.avg(spans.span_iou(*columns)).alias("iou")
        ).first()
        assert all(abs(got[name][k] - row[k]) < 1e-9 for k in ("loss", "exact_match", "iou"))
    assert training.evaluate(models["a"], df.limit(0), 8) == {"loss": 0.0, "exact_match": 0.0, "iou": 0.0}
