"""Span-scorer training by epochs with distributed gradients, and model selection.

Two pointer models score every position of a sequence, one as the start and one
as the end of the description; a softmax over the positions of the sequence makes them
probabilities.  Features of a position: its token, both neighbours (one-hot buckets of their
ids) and its signed distance to the image.

The weights are a small array of fixed size.  In every step each partition sums the gradient of
its examples, an aggregation sums the partitions, and Adam moves the weights.  All runs
of a grid share the passes over the examples.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairmine import settings
from pairmine.functions import spans
from pairmine.operators.vocabulary import IMG_ID, PAD_ID
from pairmine.schemas import METRIC_HISTORY

TOKEN_BUCKETS = 1024
MAX_DISTANCE = 32
LEARNING_RATE = 0.1
MAX_EPOCHS = 10
_ENCODER = "has_vocabulary boolean, max_len int, buckets int"
_WEIGHTS = "head string, place int, weight double"
_HEADS = ("start", "end")
_SUMS = "run string, gradient array<double>, loss double, examples long"
_CHUNK = 512
_SCORED = (
    "run string, start_token int, end_token int, true_start_token int, true_end_token int, "
    "start_loss double, end_loss double"
)

# Metrics of which the largest value is the best.
HIGHER_IS_BETTER = {"val_iou", "val_exact_match"}


def weight_count(buckets: int) -> int:
    return 3 * buckets + 2 * MAX_DISTANCE + 1


def position_features(
    tokens: np.ndarray, opens: np.ndarray, lengths: np.ndarray, buckets: int = TOKEN_BUCKETS
) -> list[np.ndarray]:
    """The four features of every position of sequences that lie one behind another.

    ``opens`` is where each sequence starts.  A sequence without an image counts distances from
    its first position.
    """
    before, after = np.roll(tokens, 1), np.roll(tokens, -1)
    before[opens] = PAD_ID
    after[opens + lengths - 1] = PAD_ID
    owner = np.repeat(np.arange(len(opens)), lengths)
    place = np.arange(len(tokens)) - opens[owner]
    found = np.where(tokens == IMG_ID, place, len(tokens))
    image = np.minimum.reduceat(found, opens)
    image[image == len(tokens)] = 0
    distance = np.clip(place - image[owner], -MAX_DISTANCE, MAX_DISTANCE)
    return [
        tokens % buckets,
        buckets + before % buckets,
        2 * buckets + after % buckets,
        3 * buckets + distance + MAX_DISTANCE,
    ]


def loss_and_gradient(
    weights: np.ndarray, features: list[np.ndarray], opens: np.ndarray, lengths: np.ndarray, targets: np.ndarray
) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of the start and end positions (their mean), and its gradient.

    ``weights`` and ``targets`` have a row for the start and one for the end.
    """
    loss, gradient = 0.0, np.zeros_like(weights)
    for head in range(2):
        scores = sum(weights[head][f] for f in features)
        scores = scores - np.repeat(np.maximum.reduceat(scores, opens), lengths)
        exps = np.exp(scores)
        totals = np.add.reduceat(exps, opens)
        chosen = opens + targets[head]
        loss += float(np.sum(np.log(totals) - scores[chosen])) / 2
        error = exps / np.repeat(totals, lengths)
        error[chosen] -= 1
        for f in features:
            gradient[head] += np.bincount(f, error, minlength=weights.shape[1])[: weights.shape[1]] / 2
    return loss, gradient


def gradient_sums(
    examples: DataFrame, runs: dict[str, np.ndarray], buckets: int = TOKEN_BUCKETS
) -> dict[str, tuple[np.ndarray, float, int]]:
    """Per run (name to weights) the summed gradient, the summed loss and the number of examples: one job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {name: [np.zeros_like(w), 0.0, 0] for name, w in runs.items()}
        for batch in batches:
            for low in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(low, _CHUNK)
                lists = part.column(0)
                tokens = lists.flatten().to_numpy().astype(np.int64)
                lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                opens = np.cumsum(lengths) - lengths
                targets = np.stack([part.column(k).to_numpy() for k in (1, 2)])
                features = position_features(tokens, opens, lengths, buckets)
                for name, weights in runs.items():
                    loss, gradient = loss_and_gradient(weights, features, opens, lengths, targets)
                    own = sums[name]
                    own[0] += gradient
                    own[1] += loss
                    own[2] += len(lengths)
        names, rows = list(sums), list(sums.values())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names),
                pa.array([r[0].ravel() for r in rows], pa.list_(pa.float64())),
                pa.array([r[1] for r in rows], pa.float64()),
                pa.array([r[2] for r in rows], pa.int64()),
            ],
            names=["run", "gradient", "loss", "examples"],
        )

    usable = examples.filter("size(sequence) > 0 and true_start_token < size(sequence) and true_end_token < size(sequence)")
    given = usable.select("sequence", "true_start_token", "true_end_token")
    parts = given.mapInArrow(run, _SUMS).withColumn("gradient", array_to_vector("gradient"))
    summed = parts.groupBy("run").agg(
        Summarizer.sum(F.col("gradient")).alias("gradient"), F.sum("loss").alias("loss"), F.sum("examples").alias("n")
    )
    return {  # one row per run
        r["run"]: (r["gradient"].toArray().reshape(2, -1), r["loss"], r["n"]) for r in summed.collect()
    }


@dataclass
class Adam:
    """Moves one run's weights along its gradients."""

    weights: np.ndarray
    rate: float = LEARNING_RATE
    steps: int = 0
    mean: np.ndarray = field(init=False)
    square: np.ndarray = field(init=False)

    def __post_init__(self):
        self.mean, self.square = np.zeros_like(self.weights), np.zeros_like(self.weights)

    def step(self, gradient: np.ndarray) -> None:
        self.steps += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.999 * self.square + 0.001 * gradient**2
        mean = self.mean / (1 - 0.9**self.steps)
        square = self.square / (1 - 0.999**self.steps)
        self.weights = self.weights - self.rate * mean / (np.sqrt(square) + 1e-8)


@dataclass
class PointerModel:
    """A start and an end scorer: a row of weights each."""

    weights: np.ndarray
    buckets: int = TOKEN_BUCKETS
    max_len: int = settings.MAX_LEN
    vocab: DataFrame | None = None

    def save(self, path: str) -> None:
        """The scorers, and beside them how their token ids are made."""
        spark = SparkSession.active()
        if self.vocab is not None:
            self.vocab.write.mode("overwrite").parquet(f"{path}/vocabulary")
        facts = [(self.vocab is not None, self.max_len, self.buckets)]
        spark.createDataFrame(facts, _ENCODER).coalesce(1).write.mode("overwrite").json(f"{path}/encoder")
        rows = [
            (head, place, float(w)) for head, own in zip(_HEADS, self.weights, strict=True) for place, w in enumerate(own)
        ]
        spark.createDataFrame(rows, _WEIGHTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")

    @staticmethod
    def load(path: str) -> PointerModel:
        spark = SparkSession.active()
        facts = spark.read.schema(_ENCODER).json(f"{path}/encoder").first()
        vocab = spark.read.parquet(f"{path}/vocabulary") if facts["has_vocabulary"] else None
        weights = np.zeros((2, weight_count(facts["buckets"])))
        for row in spark.read.schema(_WEIGHTS).parquet(f"{path}/weights").collect():  # a fixed number
            weights[_HEADS.index(row["head"]), row["place"]] = row["weight"]
        return PointerModel(weights, facts["buckets"], facts["max_len"], vocab)

    def make_predict_fn(self) -> Callable:
        """Scorer for ``predict_logits``; carries only the weights."""
        return _scorer(self.weights.astype(np.float32), self.buckets)


def _scorer(weights: np.ndarray, buckets: int) -> Callable:
    def make():
        def predict(input_ids, attention_mask):
            ids = np.asarray(input_ids, dtype=np.int64)
            real = np.asarray(attention_mask) > 0
            lengths = np.full(len(ids), ids.shape[1])
            opens = np.cumsum(lengths) - lengths
            features = position_features(ids.ravel(), opens, lengths, buckets)
            logits = []
            for own in weights:
                scores = sum(own[f] for f in features).reshape(ids.shape)
                logits.append(np.where(real, scores, np.float32(-1e4)).astype(np.float32))
            return {"start_logits": logits[0], "end_logits": logits[1]}

        return predict

    return make


def evaluate(model: PointerModel, examples: DataFrame, max_len: int) -> dict[str, float]:
    """Loss, exact match and overlap of padded, labelled examples: one job, one row."""
    return evaluate_all({"": model}, examples, max_len)[""]


def evaluate_all(models: dict[str, PointerModel], examples: DataFrame, max_len: int) -> dict[str, dict[str, float]]:
    """The same for each of several models in one pass.  Logits stay in the task; what leaves it are positions and losses."""
    makers = {name: model.make_predict_fn() for name, model in models.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = {name: make() for name, make in makers.items()}
        for batch in batches:
            for low in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(low, _CHUNK)
                ids, mask = (part.column(k).flatten().to_numpy(zero_copy_only=False).reshape(-1, max_len) for k in (0, 1))
                for name, score in scorers.items():
                    logits = score(ids, mask)
                    start, end = logits["start_logits"], logits["end_logits"]
                    columns = [
                        pa.array([name] * len(ids), pa.string()),
                        pa.array(start.argmax(axis=1), pa.int32()),
                        pa.array(end.argmax(axis=1), pa.int32()),
                        part.column(2),
                        part.column(3),
                        _cross_entropies(start, part.column(2)),
                        _cross_entropies(end, part.column(3)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=_SCORED.replace(",", "").split()[::2])

    places = [F.col(c).cast("int") for c in ("true_start_token", "true_end_token")]
    scored = examples.select("input_ids", "attention_mask", *places).mapInArrow(run, _SCORED)
    columns = [F.col(c) for c in ("start_token", "end_token", "true_start_token", "true_end_token")]
    rows = scored.groupBy("run").agg(
        F.coalesce(F.avg((F.col("start_loss") + F.col("end_loss")) / 2), F.lit(0.0)).alias("loss"),
        F.coalesce(F.avg(spans.is_exact_match(*columns).cast("double")), F.lit(0.0)).alias("exact_match"),
        F.coalesce(F.avg(spans.span_iou(*columns)), F.lit(0.0)).alias("iou"),
    )
    found = {r["run"]: {k: v for k, v in r.asDict().items() if k != "run"} for r in rows.collect()}  # one row per run
    return {name: found.get(name, {"loss": 0.0, "exact_match": 0.0, "iou": 0.0}) for name in models}


def _cross_entropies(logits: np.ndarray, targets: pa.Array) -> pa.Array:
    """Negative log softmax at the targets; null where there is no such position."""
    wide = logits.astype(np.float64)
    top = wide.max(axis=1)
    totals = top + np.log(np.exp(wide - top[:, None]).sum(axis=1))
    place = targets.fill_null(-1).to_numpy(zero_copy_only=False)
    known = (place >= 0) & (place < wide.shape[1])
    chosen = wide[np.arange(len(wide)), np.where(known, place, 0)]
    return pa.array(totals - chosen, pa.float64(), mask=~known)


def train_span_model(
    spark: SparkSession,
    train: DataFrame,
    validation: DataFrame | None,
    max_len: int,
    reg_params: list[float] = (0.0, 0.01),
    max_epochs: int = MAX_EPOCHS,
    monitor: str = "val_loss",
    patience: int = settings.EARLY_STOPPING_PATIENCE,
    buckets: int = TOKEN_BUCKETS,
    learning_rate: float = LEARNING_RATE,
    steps: int = 1,
) -> tuple[PointerModel, DataFrame]:
    """The best model of a small grid, with the weights of its best epoch, and the history of all runs.

    ``train`` and ``validation`` are padded examples with their ``sequence``; write them (or
    checkpoint them) first, for every epoch reads them again.  An epoch is ``steps`` steps, each
    over the examples that one value of a hash chooses.  It records the loss before its
    steps and, with ``validation``, the metrics after them.  A run stops ``patience`` epochs after its
    last best value of ``monitor`` (without validation, of the loss).
    """
    metric = monitor if validation is not None else "loss"
    sign = -1.0 if metric in HIGHER_IS_BETTER else 1.0
    penalties = {f"reg={r}": r for r in reg_params}
    movers = {name: Adam(np.zeros((2, weight_count(buckets))), learning_rate) for name in penalties}
    best: dict[str, tuple[float, int, np.ndarray]] = {}
    rows, active = [], list(penalties)
    for epoch in range(max_epochs):
        losses = {name: [0.0, 0] for name in active}
        used = {name: movers[name].weights for name in active}
        for step in range(steps):
            some = train if steps == 1 else train.filter(F.pmod(F.xxhash64("sequence"), F.lit(steps)) == step)
            sums = gradient_sums(some, {name: movers[name].weights for name in active}, buckets)
            for name, (gradient, loss, count) in sums.items():
                losses[name][0] += loss
                losses[name][1] += count
                if count:
                    movers[name].step(gradient / count + penalties[name] * movers[name].weights)
        if validation is not None:
            used = {name: movers[name].weights for name in active}
            models = {name: PointerModel(weights, buckets, max_len) for name, weights in used.items()}
            found = evaluate_all(models, validation, max_len)
        for name in list(active):
            loss, count = losses[name]
            values = {"loss": loss / max(1, count)}
            weights = used[name]
            if validation is not None:
                values |= {f"val_{k}": v for k, v in found[name].items()}
            rows += [(name, epoch, k, float(v)) for k, v in values.items()]
            cost = sign * values[metric]
            if name not in best or cost < best[name][0]:
                best[name] = (cost, epoch, weights)
            elif epoch - best[name][1] >= patience:
                active.remove(name)
        if not active:
            break
    history = spark.createDataFrame(rows, METRIC_HISTORY)
    chosen = select_best_run(history, metric, patience=patience).first()["run_id"]
    return PointerModel(best[chosen][2], buckets, max_len), history


def best_epochs(
    history: DataFrame, metric: str, mode: str | None = None, patience: int = settings.EARLY_STOPPING_PATIENCE
) -> DataFrame:
    """``(run_id, epoch, value)``: each run's best epoch up to its early stop.

    A run stops at the first epoch that is ``patience`` epochs behind its last
    improvement.
    """
    mode = mode or ("max" if metric in HIGHER_IS_BETTER else "min")
    sign = -1.0 if mode == "max" else 1.0
    by_epoch = Window.partitionBy("run_id").orderBy("epoch")
    earlier = by_epoch.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_epoch.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = history.filter(F.col("metric") == metric).select(
        "run_id",
        "epoch",
        "value",
        (F.col("value") * sign).alias("cost"),
        F.row_number().over(by_epoch).alias("step"),
    )
    best_before = F.min("cost").over(earlier)
    improved = best_before.isNull() | (F.col("cost") < best_before)
    marked = runs.withColumn("improved", improved)
    waited = F.col("step") - F.max(F.when(F.col("improved"), F.col("step"))).over(so_far)
    stopped = marked.withColumn("waited", waited).withColumn(
        "stopped_before", F.coalesce(F.max((F.col("waited") >= patience).cast("int")).over(earlier), F.lit(0))
    )
    return (
        stopped.filter("stopped_before = 0")
        .groupBy("run_id")
        .agg(F.min_by(F.struct("epoch", "value"), F.struct("cost", "epoch")).alias("b"))
        .select("run_id", "b.epoch", "b.value")
    )


def select_best_run(
    history: DataFrame, metric: str = "val_loss", mode: str | None = None,
    patience: int = settings.EARLY_STOPPING_PATIENCE,
) -> DataFrame:
    """One row: the run and epoch with the best value of ``metric``."""
    mode = mode or ("max" if metric in HIGHER_IS_BETTER else "min")
    value = F.col("value").desc() if mode == "max" else F.col("value").asc()
    return best_epochs(history, metric, mode, patience).orderBy(value, "run_id").limit(1)


def write_history(history: DataFrame, path: str) -> None:
    """Metric history as JSON lines."""
    history.write.mode("overwrite").json(path)
