"""Row types of the stored tables."""

from pyspark.sql import types as T


def _field(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# One crawled response as the archive reader yields it.
CRAWL_RECORD = T.StructType(
    [
        _field("warc_path", T.StringType()),
        _field("record_offset", T.LongType()),
        _field("page_url", T.StringType()),
        _field("http_parsed", T.BooleanType()),
        _field("content_type", T.StringType()),
        _field("content_length", T.LongType()),
        _field("html_bytes", T.BinaryType()),
        # The content type without parameters, in lower case.
        _field("media_type", T.StringType()),
        # What stands in the archive instead of a record.
        _field("damage", T.StringType()),
    ]
)

IMAGE_CONTEXT = T.StructType(
    [
        _field("context_id", T.StringType()),
        _field("image_url", T.StringType()),
        _field("page_url", T.StringType()),
        _field("warc_path", T.StringType()),
        _field("record_offset", T.LongType()),
        _field("img_pos", T.IntegerType()),
        _field("context_before", T.StringType()),
        _field("context_after", T.StringType()),
        _field("alt_text", T.StringType()),
        _field("is_training_candidate", T.BooleanType()),
        _field("status_extraction", T.StringType()),
        _field("extraction_timestamp", T.TimestampType()),
    ]
)

TRAINING_DATA = T.StructType(
    [
        _field("context_id", T.StringType()),
        _field("input_ids", T.ArrayType(T.IntegerType())),
        _field("attention_mask", T.ArrayType(T.IntegerType())),
        _field("true_start_token", T.IntegerType()),
        _field("true_end_token", T.IntegerType()),
        _field("alt_text_used", T.StringType()),
        _field("created_timestamp", T.TimestampType()),
    ]
)

PREDICTION = T.StructType(
    [
        _field("prediction_id", T.StringType()),
        _field("context_id", T.StringType()),
        _field("model_path", T.StringType()),
        _field("predicted_text", T.StringType()),
        _field("start_token", T.IntegerType()),
        _field("end_token", T.IntegerType()),
        _field("start_confidence", T.DoubleType()),
        _field("end_confidence", T.DoubleType()),
        _field("average_confidence", T.DoubleType()),
        _field("span_confidence", T.DoubleType()),
        _field("status_enrichment", T.StringType()),
        _field("prediction_timestamp", T.TimestampType()),
    ]
)

CLIP_RESULT = T.StructType(
    [
        _field("clip_result_id", T.StringType()),
        _field("prediction_id", T.StringType()),
        _field("image_local_path", T.StringType()),
        _field("clip_score", T.DoubleType()),
        _field("clip_model_name", T.StringType()),
        _field("enrichment_timestamp", T.TimestampType()),
        _field("error_message", T.StringType()),
        _field("version", T.LongType()),
    ]
)

METRIC_HISTORY = T.StructType(
    [
        _field("run_id", T.StringType()),
        _field("epoch", T.IntegerType()),
        _field("metric", T.StringType()),
        _field("value", T.DoubleType()),
    ]
)

# A record that cannot yield any context.
QUARANTINE = T.StructType(
    [
        _field("warc_path", T.StringType()),
        _field("record_offset", T.LongType()),
        _field("page_url", T.StringType()),
        _field("reason", T.StringType()),
    ]
)

# Table name -> row type of everything the store keeps.
TABLES = {
    "image_context": IMAGE_CONTEXT,
    "training_data": TRAINING_DATA,
    "predicted_descriptions": PREDICTION,
    "clip_results": CLIP_RESULT,
    "quarantine": QUARANTINE,
}
