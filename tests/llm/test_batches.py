import pyarrow as pa

import corpus_pipeline

from .helpers import DOCS


def test_stages_send_batches_of_bounded_bytes(spark):
    rows = [(i, "x" * 100_000, "en", "s", 100_000) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)

    @corpus_pipeline._in_small_batches
    def sizes(spark, docs, sf_dir):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["rows"])

        return docs.mapInArrow(run, "rows long")

    found = [r.rows for r in sizes(spark, docs, "").collect()]
    assert sum(found) == 200 and max(found) <= 2 * (2 << 20) // 100_000 + 1
