import gzip
import io
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairmine.operators import contexts, training, vocabulary
from pairmine.plans import analyze, enrich, extract, predict, train
from pairmine.sources import images, tables, warc
from pairmine.streaming import incremental
from workload.adapters import png

WORDS = "the quick brown fox jumps over the lazy dog near a quiet river bank while many birds sing".split()


def page_html(number):
    paragraphs = []
    for i in range(3):
        alt = " ".join(WORDS[(number + i) % 9 : (number + i) % 9 + 4])
        paragraphs.append(f'<p>{" ".join(WORDS)} {i}</p><img src="img{i}.png" alt="{alt}"><p>{" ".join(WORDS[::-1])}</p>')
    return f"<html><body>{''.join(paragraphs)}</body></html>"


def record(url, html, kind="text/html", record_type="response", http=True):
    head = f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\n\r\n" if kind else "HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    payload = (head.encode() if http else b"") + html
    fields = f"WARC/1.0\r\nWARC-Type: {record_type}\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(payload)}\r\n\r\n"
    return fields.encode() + payload + b"\r\n\r\n"


def write_crawl(folder, name, numbers, extra=b""):
    os.makedirs(folder, exist_ok=True)
    records = [record("urn:info", b"software: x", record_type="warcinfo", http=False)]
    records += [record(f"http://e.com/{n}", page_html(n).encode()) for n in numbers]
    with open(os.path.join(folder, name), "wb") as out:
        for r in records:
            out.write(gzip.compress(r) if name.lower().endswith(".gz") else r)
        out.write(extra)


def test_archive_scan(spark, tmp_path):
    folder = str(tmp_path)
    write_crawl(folder, "a.warc.gz", range(5))
    write_crawl(folder, "B.WARC", range(5, 8))
    write_crawl(folder, "sub/c.warc".split("/")[1], range(8, 9))
    write_crawl(f"{folder}/sub", "d.warc", range(9, 10))
    (tmp_path / "notes.txt").write_text("no archive")
    with open(f"{folder}/a.warc.gz", "ab") as out:
        out.write(gzip.compress(record("http://e.com/x.json", b"{}" * 100, "application/json")))
        out.write(gzip.compress(record("http://e.com/untyped", b"x" * 200, None)))
        out.write(gzip.compress(record("http://e.com/raw", b"x" * 200, http=False)))
    rows = warc.read_warc(spark, folder).collect()
    assert len(rows) == 12
    assert {r.warc_path for r in rows} == {"a.warc.gz", "B.WARC", "c.warc"}
    by_url = {r.page_url: r for r in rows}
    assert bytes(by_url["http://e.com/3"].html_bytes).decode() == page_html(3)
    assert by_url["http://e.com/x.json"].html_bytes is None
    assert by_url["http://e.com/x.json"].content_length == 200
    assert by_url["http://e.com/untyped"].content_type is None
    assert by_url["http://e.com/raw"].http_parsed is False
    assert len({(r.warc_path, r.record_offset) for r in rows}) == 12
    assert warc.read_warc(spark, folder, recursive=True).count() == 13
    assert warc.read_warc(spark, f"{folder}/B.WARC").count() == 3
    deep = {r.warc_path for r in warc.read_warc(spark, folder, recursive=True).select("warc_path").collect()}
    assert deep == {"a.warc.gz", "B.WARC", "sub/d.warc", "c.warc"}
    with pytest.raises(Exception):
        warc.archives(f"{folder}/missing")


def test_damaged_archive_keeps_what_came_before(spark, tmp_path):
    cut = gzip.compress(record("http://e.com/cut", b"x" * 500))[:-100]
    write_crawl(str(tmp_path), "cut.warc.gz", range(3), extra=cut)
    write_crawl(str(tmp_path), "odd.warc", range(3, 5), extra=b"garbage\r\n")
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sum(r.page_url is not None for r in rows) == 5
    assert sorted((r.warc_path, r.damage) for r in rows if r.damage) == [("cut.warc.gz", "bad member"), ("odd.warc", "junk")]


def every_range(folder, name, step):
    size = os.path.getsize(f"{folder}/{name}")
    return [
        row
        for low in range(0, size, step)
        for batch in warc.read_archive(f"{folder}/{name}", low=low, high=min(size, low + step))
        for row in batch.to_pylist()
    ]


def damaged_crawl(folder):
    """Archives with damage of every kind, and the pages that must survive it."""
    rng = np.random.default_rng(3)
    pages = [record(f"http://e.com/{n}", rng.bytes(40) * 9 + page_html(n).encode()) for n in range(30)]
    quoted = record("http://e.com/quoted", b"<pre>\r\n\r\n" + record("http://fake/", b"x" * 50) + b"</pre>")
    members = [gzip.compress(p) for p in pages]
    bad = bytearray(members[7])
    bad[len(bad) // 2] ^= 0xFF
    both = gzip.compress(pages[10] + pages[11])
    half = len(pages[12]) // 2
    parts = [
        *members[:3], b"\0" * 700, *members[3:5], b"junk that is no member", members[5], members[6][: len(members[6]) // 2],
        bytes(bad), members[8], members[9][:-8] + b"\1" * 8, both, gzip.compress(pages[12][:half]), gzip.compress(pages[12][half:]),
        gzip.compress(quoted), gzip.compress(pages[13][:-200]), *members[14:], b"\x1f\x8b\x08 no end",
    ]
    with open(f"{folder}/mixed.warc.gz", "wb") as out:
        out.write(b"".join(parts))
    with open(f"{folder}/one.warc.gz", "wb") as out:
        out.write(gzip.compress(b"".join(pages)))
    with open(f"{folder}/plain.warc", "wb") as out:
        out.write(b"".join([b"junk first\r\n", *pages[:9], b"junk\r\nmore\r\n", quoted, *pages[9:], pages[0][:-300]]))
    lost = {6, 7, 9, 13}
    return {f"http://e.com/{n}" for n in range(30)} - {f"http://e.com/{n}" for n in lost} | {"http://e.com/quoted"}


def test_rows_do_not_depend_on_ranges(spark, tmp_path):
    survive = damaged_crawl(str(tmp_path))
    for name in ("mixed.warc.gz", "one.warc.gz", "plain.warc"):
        whole = every_range(tmp_path, name, 1 << 30)
        for step in (97, 1_000, 4_096):
            assert every_range(tmp_path, name, step) == whole
    mixed = every_range(tmp_path, "mixed.warc.gz", 1 << 30)
    assert {r["page_url"] for r in mixed if not r["damage"]} == survive
    assert sorted(r["damage"] for r in mixed if r["damage"]) == [*["bad member"] * 3, "cut off", "junk", "junk"]
    assert len({r["record_offset"] for r in mixed}) == len(mixed)
    plain = every_range(tmp_path, "plain.warc", 1 << 30)
    assert len(plain) == 31 + 3 and [r["damage"] for r in plain if r["damage"]] == ["junk", "junk", "cut off"]
    assert "http://fake/" not in {r["page_url"] for r in [*mixed, *plain]}
    split = warc.read_warc(spark, str(tmp_path), split_bytes=5_000)
    assert split.rdd.getNumPartitions() > 10
    assert sorted(split.collect(), key=str) == sorted(warc.read_warc(spark, str(tmp_path)).collect(), key=str)


def test_filters_reach_the_source(spark, tmp_path):
    from pairmine.operators import pages

    write_crawl(str(tmp_path), "a.warc", range(4), extra=record("http://e.com/x.json", b"{}" * 99, "application/json"))
    write_crawl(str(tmp_path), "b.warc.gz", range(4, 6), extra=gzip.compress(record("http://e.com/s", b"<p>", "text/html")))
    read = warc.read_warc(spark, str(tmp_path), html_only=False)
    kept = pages.admit_pages(read, read_payload=False)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]
    rows = kept.collect()
    assert sorted(r.page_url[-1] for r in rows) == list("012345")
    assert [r.page_url for r in read.filter("media_type = 'application/json'").collect()] == ["http://e.com/x.json"]
    assert read.filter("content_length between 1 and 10 and page_url like '%/s'").count() == 1
    assert read.filter("not(page_url = 'http://e.com/s') and http_parsed").count() == 7
    assert read.filter("length(html_bytes) = 3 and media_type in ('text/html', 'x')").count() == 1
    assert read.filter("damage is not null").count() == 0


def test_unwanted_bodies_are_not_read():
    big = record("http://e.com/big", b"b" * (8 << 20)) + record("http://e.com/a", b"x" * 200)

    class Watched(io.BytesIO):
        total = 0

        def read(self, size=-1):
            data = super().read(size)
            Watched.total += len(data)
            return data

    rows = list(warc.iter_responses(warc._Counting(Watched(big)), wanted=lambda head: head[4] < 1_000))
    assert [r[1] for r in rows] == ["http://e.com/a"] and Watched.total < 4 << 20


def test_junk_between_records_costs_no_record():
    whole = record("http://e.com/a", b"x" * 200) + b"junk\r\nmore junk\n" + record("http://e.com/b", b"y" * 200)
    bad_length = record("http://e.com/c", b"z" * 200).replace(b"Content-Length: ", b"Content-Length: x", 1)
    stream = warc._Counting(io.BytesIO(whole + bad_length + record("http://e.com/d", b"w" * 200)))
    uris = [row[1] for row in warc.iter_responses(stream)]
    assert [u for u in uris if u] == ["http://e.com/a", "http://e.com/b", "http://e.com/d"]
    assert uris.count(None) == 2


def test_bodies_that_are_not_html_are_skipped_unread():
    big = b"b" * (8 << 20)

    def response(kind, body):
        payload = b"HTTP/1.1 200 OK\r\nContent-Type: " + kind + b"\r\n\r\n" + body
        head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://e.com/\r\n"
        return head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload + b"\r\n\r\n"

    class Watched(io.BytesIO):
        largest = 0

        def read(self, size=-1):
            data = super().read(size)
            Watched.largest = max(Watched.largest, len(data))
            return data

    raw = Watched(response(b"video/mp4", big) + response(b"text/html", b"page"))
    rows = [row[2:6] for row in warc.iter_responses(warc._Counting(raw), html_only=True)]
    assert rows == [(True, "video/mp4", len(big), None), (True, "text/html", 4, b"page")]
    assert Watched.largest <= 1 << 20
    raw.seek(0)
    assert [row[5] for row in warc.iter_responses(warc._Counting(raw))] == [big, b"page"]


def test_storage_errors_are_raised():
    class Broken(io.BytesIO):
        def read(self, *size):
            if self.tell() > 300:
                raise OSError("connection reset")
            return super().read(*size)

        def readline(self, *size):
            if self.tell() > 300:
                raise OSError("connection reset")
            return super().readline(*size)

    whole = record("http://e.com/a", b"x" * 200) + record("http://e.com/b", b"y" * 200)
    with pytest.raises(OSError, match="reset"):
        list(warc.iter_responses(warc._Counting(Broken(whole))))


def test_image_scan(spark, tmp_path):
    (tmp_path / "good.png").write_bytes(png(300, 240, 7))
    (tmp_path / "small.png").write_bytes(png(100, 100, 9))
    (tmp_path / "bad.png").write_bytes(b"not an image")
    scanned = images.scan_images(spark, str(tmp_path))
    out = {os.path.basename(r.local_path): r for r in scanned.collect()}
    assert (out["good.png"].width, out["good.png"].height, out["good.png"].decodable) == (300, 240, True)
    assert out["good.png"].declared_length == (tmp_path / "good.png").stat().st_size
    assert (out["bad.png"].width, out["bad.png"].decodable) == (None, False)
    fetched = spark.createDataFrame(
        [("http://e/1", True, "good.png"), ("http://e/2", False, "gone.png")],
        "image_url string, http_ok boolean, local_name string",
    )
    assets = {r.image_url: r for r in images.to_assets(fetched, scanned).collect()}
    assert assets["http://e/1"].width == 300 and assets["http://e/2"].decodable is False


def fixed_assets(contexts_):
    width = F.when(F.col("image_url").endswith("img2.png"), 100).otherwise(300)
    return contexts_.select("image_url").distinct().select(
        "image_url",
        F.lit(True).alias("http_ok"),
        F.lit(9000).cast("bigint").alias("declared_length"),
        width.alias("width"),
        F.lit(300).alias("height"),
        F.lit(True).alias("decodable"),
    )


def add_embeddings(rows):
    size = F.length("predicted_text").cast("float")
    return rows.withColumns(
        {
            "image_embedding": F.array(F.lit(1.0).cast("float"), F.lit(2.0).cast("float")),
            "text_embedding": F.array(size, F.lit(1.0).cast("float")),
        }
    )


def test_all_stages(spark, tmp_path):
    crawl, root, model = str(tmp_path / "crawl"), str(tmp_path / "store"), str(tmp_path / "model")
    write_crawl(crawl, "one.warc.gz", range(12))
    counters = extract.extract_archives(spark, crawl, root, "one", mode="training")
    assert counters == {
        "records": 12, "damaged": 0, "html_responses": 12, "parsed_pages": 12, "quarantined": 0,
        "contexts_added": 36, "contexts_marked": 36,
    }
    # The same archives again, as another batch and as the same one.
    assert extract.extract_archives(spark, crawl, root, "again", mode="training")["contexts_added"] == 0
    assert extract.extract_archives(spark, crawl, root, "one", mode="training")["contexts_added"] == 36
    assert tables.read_table(spark, root, "image_context").count() == 36

    history = train.train_from_store(
        spark, root, model, "set", max_len=64, reg_params=[0.01], max_epochs=4, buckets=128
    )
    assert {"loss", "val_loss", "val_iou", "val_exact_match"} == {r.metric for r in history.collect()}
    assert tables.read_table(spark, root, "training_data").count() == 36

    first = predict.predict_from_store(spark, root, model, "p1", max_len=64)
    assert first["attempted"] == 36 and 0 < first["added"] <= 36
    again = predict.predict_from_store(spark, root, model, "p2", max_len=64)
    assert again["attempted"] == 36 - first["added"] and again["added"] == 0
    stored = tables.read_table(spark, root, "predicted_descriptions")
    assert stored.count() == first["added"]

    assets = fixed_assets(tables.read_table(spark, root, "image_context"))
    done = enrich.enrich_from_store(spark, root, assets, add_embeddings, "e1")
    assert done["processed"] == first["added"]
    assert done["scored"] + done["failed_download"] == done["processed"] and done["failed_download"] > 0
    assert enrich.enrich_from_store(spark, root, assets, add_embeddings, "e2")["processed"] == 0
    statuses = {r.status_enrichment for r in enrich.current_predictions(spark, root).collect()}
    assert statuses == {"clip_scored", "failed_clip"}

    pairs = analyze.ranked_pairs(spark, root).collect()
    assert len(pairs) == done["scored"]
    assert [p.clip_score for p in pairs] == sorted((p.clip_score for p in pairs), reverse=True)
    paths = analyze.write_report(spark, root, str(tmp_path / "report"))
    assert spark.read.parquet(paths["summary"]).count() == 5


def test_quarantine_is_written_on_the_way(spark, tmp_path):
    crawl, root = str(tmp_path / "crawl"), str(tmp_path / "store")
    extra = [record("http://e.com/n", b"<body>no picture</body>".ljust(200)), record("http://e.com/j", b"{}" * 99, "text/json")]
    extra = b"".join(map(gzip.compress, extra)) + gzip.compress(record("http://e.com/cut", b"x" * 500))[:-30]
    write_crawl(crawl, "one.warc.gz", range(4), extra=extra)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    counters = extract.extract_archives(spark, crawl, root, "one")
    assert set(os.listdir(shared)) == before
    assert (counters["records"], counters["damaged"], counters["quarantined"], counters["contexts_added"]) == (6, 1, 3, 12)
    reasons = {r.page_url: r.reason for r in tables.read_table(spark, root, "quarantine").collect()}
    assert reasons == {"http://e.com/n": "no_image_tag", "http://e.com/j": "not_html", None: "damaged: bad member"}
    found = {tuple(r) for r in extract.contexts_of_records(warc.read_warc(spark, crawl)).select("page_url", "img_pos", "alt_text").collect()}
    stored = tables.read_table(spark, root, "image_context").select("page_url", "img_pos", "alt_text").collect()
    assert {tuple(r) for r in stored} == found


def test_a_failed_rewrite_keeps_the_batch(spark, tmp_path):
    root = str(tmp_path / "store")
    tables.create_tables(spark, root)
    row = spark.createDataFrame([("a.warc", 1, "http://e.com/", "too_short")], "warc_path string, record_offset long, page_url string, reason string")
    tables.write_batch(row, root, "quarantine", "one")
    broken = row.withColumn("reason", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.write_batch(broken, root, "quarantine", "one")
    assert [r.reason for r in tables.read_table(spark, root, "quarantine").collect()] == ["too_short"]
    tables.write_batch(row.withColumn("reason", F.lit("not_html")), root, "quarantine", "one")
    assert [r.reason for r in tables.read_table(spark, root, "quarantine").collect()] == ["not_html"]
    assert sorted(n for n in os.listdir(f"{root}/quarantine") if n[0] != ".") == ["batch=created", "batch=one"]


def test_a_model_brings_its_vocabulary_and_length(spark, tmp_path):
    crawl, root, model = str(tmp_path / "crawl"), str(tmp_path / "store"), str(tmp_path / "model")
    write_crawl(crawl, "one.warc.gz", range(6))
    extract.extract_archives(spark, crawl, root, "one", mode="training")
    stored = tables.read_table(spark, root, "image_context")
    texts = ["context_before", "context_after", "alt_text"]
    vocabulary.build_vocabulary(stored, texts).write.parquet(str(tmp_path / "vocab"))
    vocab = spark.read.parquet(str(tmp_path / "vocab"))
    train.train_from_store(
        spark, root, model, "set", max_len=64, vocab=vocab, reg_params=[0.01], max_epochs=2, buckets=128
    )
    loaded = training.PointerModel.load(model)
    assert (loaded.max_len, loaded.buckets) == (64, 128)
    assert sorted(loaded.vocab.collect()) == sorted(vocab.collect())
    trained = tables.read_table(spark, root, "training_data").select("context_id", "input_ids")
    again = predict.inference_inputs(stored, loaded.max_len, (64 - 3) // 2, loaded.vocab)
    trained_on = {r.context_id: set(r.input_ids) for r in trained.collect()}
    applied_to = {r.context_id: r for r in again.collect()}
    ids = {r.token: r.token_id for r in vocab.collect()}
    assert trained_on and set(trained_on) <= set(applied_to)
    for key, seen in trained_on.items():
        row = applied_to[key]
        assert seen <= set(row.input_ids) | {0}
        for number, token in zip(row.input_ids, row.sequence_tokens):
            assert token in ("[CLS]", "[IMG]", "[SEP]") or ids[token] == number
    pieces = [(w[:3], 5 + i) for i, w in enumerate(sorted({w[:3] for w in WORDS}))]
    pieces += [(f"##{c}", 100 + i) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789")]
    cut, by_piece = str(tmp_path / "pieces"), spark.createDataFrame(pieces, "piece string, piece_id int")
    train.train_from_store(spark, root, cut, "pieces", max_len=64, vocab=by_piece, reg_params=[0.01], max_epochs=1, buckets=128)
    assert predict.predict_from_store(spark, root, cut, "p0")["attempted"] == stored.count()
    said = tables.read_table(spark, root, "predicted_descriptions").filter(F.col("model_path") == cut).collect()
    assert all("##" not in r.predicted_text for r in said)
    assert predict.predict_from_store(spark, root, model, "p1")["attempted"] == stored.count()
    with pytest.raises(ValueError, match="length 64"):
        predict.predict_from_store(spark, root, model, "p2", max_len=128)


def test_streams_add_each_thing_once(spark, tmp_path):
    crawl, root = str(tmp_path / "crawl"), str(tmp_path / "store")
    write_crawl(crawl, "one.warc.gz", range(6))

    def ingest(name="contexts"):
        found = extract.contexts_of_records(warc.stream_archives(spark, crawl))
        incremental.stream_contexts(found, root, name).awaitTermination()
        return tables.read_table(spark, root, "image_context").count()

    assert ingest() == 18
    assert ingest() == 18
    write_crawl(crawl, "two.warc", range(3, 9))
    assert ingest() == 27
    assert ingest("other") == 27

    def model():
        def score(input_ids, attention_mask):
            ids = np.asarray(input_ids)
            start = np.zeros(ids.shape, np.float32)
            start[:, 2] = 3
            end = np.zeros(ids.shape, np.float32)
            end[:, 4] = 3
            return {"start_logits": start, "end_logits": end}

        return score

    assert predict.predict_from_store(spark, root, "m", "p1", model, max_len=64)["added"] == 27
    assets = fixed_assets(tables.read_table(spark, root, "image_context"))

    def drain():
        incremental.stream_enrichment(spark, root, assets, add_embeddings).awaitTermination()
        return tables.read_table(spark, root, "clip_results").count()

    assert drain() == 27
    assert drain() == 27
    predict.predict_from_store(spark, root, "m2", "p2", model, max_len=64)
    assert drain() == 54
    assert {r.status_enrichment for r in enrich.current_predictions(spark, root).collect()} == {
        "clip_scored", "failed_clip",
    }


def test_page_table_extraction_matches_archive_extraction(spark, tmp_path):
    write_crawl(str(tmp_path), "one.warc.gz", range(4))
    columns = ["page_url", "img_pos", "image_url", "context_before", "context_after", "alt_text"]
    archived = extract.contexts_of_records(warc.read_warc(spark, str(tmp_path))).select(*columns)
    pages = spark.createDataFrame(
        [(f"http://e.com/{n}", page_html(n)) for n in range(4)], "page_url string, html string"
    )
    assert sorted(contexts.extract_contexts(pages).select(*columns).collect()) == sorted(archived.collect())
