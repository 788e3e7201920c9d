import random

import pytest
from pyspark.sql import functions as F

from pairmine import schemas
from pairmine.operators import store
from pairmine.sources import tables

FOUND = (
    "warc_path string, record_offset long, img_pos int, page_url string, image_url string, "
    "alt_text string, context_before string, context_after string, found_alt_in_context boolean"
)


def found(spark, *rows):
    return spark.createDataFrame(list(rows), FOUND)


def row(image, page, offset=1, pos=0, warc="w1", before="b", flag=False):
    return (warc, offset, pos, page, image, "alt", before, "a", flag)


def table(spark, *rows, mode="training"):
    return store.to_context_rows(store.dedup_contexts(found(spark, *rows)), mode)


def predictions(spark, pairs):
    rows = [(c, t, 5, 10, 0.9, 0.8, 0.85, 0.72) for c, t in pairs]
    spans = spark.createDataFrame(
        rows,
        "context_id string, predicted_text string, start_token int, end_token int, "
        "start_confidence double, end_confidence double, average_confidence double, span_confidence double",
    )
    return spans


def test_first_write_wins_per_image_and_page(spark):
    kept = table(
        spark, row("img1", "page1"), row("img1", "page1", offset=2, before="dup"), row("img1", "page2", offset=3)
    ).collect()
    assert sorted((r.page_url, r.context_before) for r in kept) == [("page1", "b"), ("page2", "b")]
    assert len({r.context_id for r in kept}) == 2


def test_insertion_order_decides(spark):
    kept = table(
        spark,
        row("i", "p", warc="w2", offset=0, before="late"),
        row("i", "p", warc="w1", offset=9, pos=1, before="second"),
        row("i", "p", warc="w1", offset=9, pos=0, before="first"),
    )
    assert [r.context_before for r in kept.collect()] == ["first"]


def test_hot_key_is_cut_before_the_shuffle(spark):
    rows = found(spark, *[row("hot" if i % 3 else f"i{i}", "p", offset=i) for i in range(300)])
    kept = store.dedup_contexts(rows)
    assert kept.count() == 101
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


@pytest.mark.parametrize("rows", [None, 3])
def test_insert_ignores_stored_keys(spark, rows):
    stored = table(spark, row("img1", "page1"))
    batch = found(spark, row("img1", "page1", before="again"), row("img1", "page2"), row("img2", "page1"))
    new = store.insert_contexts(batch, stored, rows)
    assert sorted((r.image_url, r.page_url) for r in new.collect()) == [("img1", "page2"), ("img2", "page1")]
    both = store.to_context_rows(new).unionByName(stored)
    assert store.insert_contexts(batch, both, rows).count() == 0


def test_unprocessed_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "x" * 10) for i in range(20)], "k long, payload string")
    done = spark.range(0, 20, 2).withColumnRenamed("id", "k")
    expected = list(range(1, 20, 2))
    assert sorted(r.k for r in store.unprocessed(rows, done, "k").collect()) == expected
    monkeypatch.setattr(store.settings, "BROADCAST_ROW_LIMIT", 3)
    assert sorted(r.k for r in store.unprocessed(rows, done, "k").collect()) == expected
    assert store.unprocessed(rows, done.filter("false"), "k").count() == 20


def test_flags_and_modes(spark):
    rows = [row("i1", "p", flag=True), row("i2", "p", offset=2), row("i3", "p", offset=3, flag=True)]
    flagged = table(spark, *rows)
    assert flagged.filter("is_training_candidate").count() == 2
    assert table(spark, *rows, mode="inference").filter("is_training_candidate").count() == 0
    assert {r.status_extraction for r in flagged.collect()} == {"processed"}
    ids = flagged.filter("image_url = 'i2'").select("context_id")
    assert store.mark_training_candidates(flagged, ids.union(ids)).filter("is_training_candidate").count() == 3
    with pytest.raises(ValueError):
        table(spark, *rows, mode="other")


def test_reads_and_pages(spark):
    rows = [row("i1", "p", flag=True), row("i2", "p", offset=2), row("i3", "p", offset=3, flag=True)]
    contexts = table(spark, *rows)
    assert store.training_contexts(contexts).count() == 2
    ids = {r.image_url: r.context_id for r in contexts.collect()}
    assert [r.context_id for r in store.training_contexts(contexts, 1).collect()] == [ids["i1"]]
    assert [r.context_id for r in store.training_contexts(contexts, 1, 1).collect()] == [ids["i3"]]
    assert [r.image_url for r in store.inference_contexts(contexts, 2, 1).collect()] == ["i2", "i3"]
    assert store.inference_contexts(contexts).count() == 3


def test_predictions_queue_results_and_status(spark):
    contexts = table(spark, row("img1", "p1"), row("img2", "p2", offset=2))
    ids = {r.image_url: r.context_id for r in contexts.collect()}
    spans = predictions(spark, [(ids["img1"], "pred1"), (ids["img2"], "pred2")])
    first = store.to_prediction_rows(spans, "m")
    assert {r.status_enrichment for r in first.collect()} == {"pending"}
    other = store.to_prediction_rows(predictions(spark, [(ids["img1"], "pred3")]), "n")
    every = first.unionByName(other)
    assert store.append_predictions(first, every).count() == 0
    done = every.withColumn(
        "status_enrichment", F.when(F.col("predicted_text") == "pred2", "clip_scored").otherwise("pending")
    )
    queue = store.pending_predictions(done, contexts).collect()
    assert {r.predicted_text for r in queue} == {"pred1", "pred3"}
    one, two = (store.pending_predictions(done, contexts, 1, o).collect() for o in (0, 1))
    assert len(one) == len(two) == 1 and one != two

    pid = first.filter("predicted_text = 'pred1'").first().prediction_id

    def result(score, error, version):
        rows = [("r", pid, "/p.jpg" if score else None, score, "clip", None, error, version)]
        return spark.createDataFrame(rows, schemas.CLIP_RESULT)

    good = store.upsert_results(result(0.75, None, 1), result(None, None, 0))
    assert [(r.clip_score, r.error_message) for r in good.collect()] == [(0.75, None)]
    status = {r.prediction_id: r.status_enrichment for r in store.apply_status(every, good).collect()}
    assert status[pid] == "clip_scored" and sorted(status.values()) == ["clip_scored", "pending", "pending"]
    bad = store.upsert_results(good, result(None, "Download failed", 2))
    assert [(r.clip_score, r.error_message) for r in bad.collect()] == [(None, "Download failed")]
    status = {r.prediction_id: r.status_enrichment for r in store.apply_status(every, bad).collect()}
    assert status[pid] == "failed_clip"
    split = store.apply_status(every, bad, split_download_status=True).collect()
    assert {r.prediction_id: r.status_enrichment for r in split}[pid] == "failed_download"

    assert store.final_results(every, contexts, bad).count() == 0
    final = store.final_results(every, contexts, good).collect()
    assert [(r.image_url, r.clip_score) for r in final] == [("img1", 0.75)]
    assert store.final_results(every, contexts, good, min_score=0.8).count() == 0
    assert store.final_results(every, contexts, good, min_score=0.75, limit=1).count() == 1


def test_tables(spark, tmp_path):
    root = str(tmp_path / "store")
    tables.create_tables(spark, root)
    tables.create_tables(spark, root)
    assert {n: tables.read_table(spark, root, n).count() for n in schemas.TABLES} == dict.fromkeys(schemas.TABLES, 0)
    tables.write_batch(table(spark, row("i", "p")), root, "image_context", "b1")
    tables.write_batch(table(spark, row("i", "p"), row("j", "p")), root, "image_context", "b2")
    tables.write_batch(table(spark, row("k", "p"), row("j", "p")), root, "image_context", "b2")
    tables.create_tables(spark, root)
    stored = tables.read_table(spark, root, "image_context")
    assert stored.schema == schemas.IMAGE_CONTEXT
    assert sorted(r.image_url for r in stored.collect()) == ["i", "j", "k"]
    assert tables.read_table(spark, root, "image_context", without_batch="b2").count() == 1


def keyed(spark, numbers):
    return spark.createDataFrame([(f"k{i}",) for i in numbers], "context_id string").withColumn("note", F.lit("x"))


def store_with(spark, root):
    from pairmine.sources import tables

    tables.create_tables(spark, root)

    def write(numbers, batch):
        empty = tables.read_table(spark, root, "image_context").limit(0)
        rows = empty.drop("context_id").unionByName(spark.createDataFrame([], empty.drop("context_id").schema))
        full = keyed(spark, numbers).join(rows.withColumn("note", F.lit("x")), "note", "left").drop("note")
        return full, batch

    return write


def test_bucketed_keys(spark, tmp_path, monkeypatch):
    from pairmine.sources import keys, tables

    monkeypatch.setattr(keys, "NAMED_KEYS", 5)
    root = str(tmp_path)
    write = store_with(spark, root)
    table = keys.KeyTable(spark, root, "image_context", "context_id")
    assert table.missing(keyed(spark, range(3)), "one").count() == 3
    keys.add_context_batch(*[write(range(40), "one")[0], root, "one"])
    keys.add_context_batch(*[write(range(40, 60), "two")[0], root, "two"])

    def new(numbers, batch, count=None):
        return sorted(r.context_id for r in table.missing(keyed(spark, numbers), batch, count).collect())

    assert new(range(50, 65), "three") == [f"k{i}" for i in range(60, 65)]
    assert new([1, 59, 70], "three", 3) == ["k70"]
    assert new([1, 59, 70], "one", 3) == ["k1", "k70"]
    # The stored side lies in buckets: only the batch is shuffled.
    plan = table.missing(keyed(spark, range(50, 65)), "three")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    named = table.missing(keyed(spark, [1, 2]), "three", 2)._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 2 out of 64" in named or "SelectedBucketsCount: 1 out of 64" in named
    # A batch whose keys were lost is read from the table; keys without their batch do not count.
    tables.write_batch(write(range(100, 110), "three")[0], root, "image_context", "three")
    assert new(range(105, 112), "four") == [f"k{i}" for i in range(105, 112)]
    table.repair()
    assert new(range(105, 112), "four") == ["k110", "k111"]
    table.append(keyed(spark, [500]), "died")
    assert new([500], "four") == ["k500"]


def test_files_of_keys_are_bounded(spark, tmp_path, monkeypatch):
    from pairmine.sources import keys, tables

    monkeypatch.setattr(keys, "MAX_FILES", 2)
    root = str(tmp_path)
    write = store_with(spark, root)
    table = keys.KeyTable(spark, root, "image_context", "context_id", buckets=4)
    most = 0
    for n in range(12):
        tables.write_batch(write(range(10 * n, 10 * n + 10), f"b{n}")[0], root, "image_context", f"b{n}")
        table.append(keyed(spark, range(10 * n, 10 * n + 10)), f"b{n}")
        most = max(most, table.file_count())
    assert most <= 4 * 2 and table.version() > 0 and len(table._children(table.folder)) == 1
    assert table.missing(keyed(spark, range(125)), "new").count() == 5


def test_far_pages_equal_sorted_slices(spark):
    chosen = random.Random(8)
    rows = [
        (i, chosen.choice([None, "", "a", "b", "c"]), chosen.choice([None, *range(0, 900)]), chosen.randrange(3))
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "id long, warc_path string, record_offset long, img_pos int").repartition(4)
    order = ["warc_path", "record_offset", "img_pos", "id"]
    whole = [r.id for r in df.orderBy(*order).collect()]
    for offset, limit in [(0, 5), (100, 40), (117, 300), (590, 50), (599, 1), (600, 5), (0, 600), (250, 0)]:
        got = [r.id for r in store.ranked_page(df, order, limit, offset, stretch=50).collect()]
        assert got == whole[offset : offset + limit], (offset, limit)
    assert store.ranked_page(df.limit(0), order, 5, 0).count() == 0


def test_far_pages_read_their_stretch_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "DIRECT_ROWS", 100)
    rows = [row(f"i{n}", "p", offset=100 * n, warc=f"w{n // 500}") for n in range(2_000)]
    store.to_context_rows(store.with_context_id(found(spark, *rows)), "inference").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    page = store.inference_contexts(stored, limit=30, offset=1_200)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "GreaterThanOrEqual(warc_path,w2)" in plan
    assert [r.image_url for r in page.collect()] == [f"i{n}" for n in range(1_200, 1_230)]
    near = store.inference_contexts(stored, limit=30, offset=20)
    assert [r.image_url for r in near.collect()] == [f"i{n}" for n in range(20, 50)]
