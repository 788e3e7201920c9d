"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmine.llm import (
    chat,
    collocations,
    decontaminate,
    linedup,
    mixing,
    packing,
    pagetext,
    quality,
    rules,
    runs,
    sharding,
    simhash,
    urlrules,
)
from pairmine.llm.common import table, words


def vocabulary_path() -> str:
    """The public byte-level vocabulary; every machine has the same files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    return urlrules.judge(table(spark, sf, "pages"), urlrules.rule_table(spark, urlrules.RULES))


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf, "documents"), vocabulary_path())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("token_ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


#: A conversation of control strings, formatted along with the given ones.
_PROBE = "</s>[INST] ok [/INST]"


def op3_chat(spark: SparkSession, sf: str) -> DataFrame:
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).selectExpr(
        "-7L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role", f"'{_PROBE}' as text"
    )
    formatted = chat.format_turns(given.unionByName(probe))
    return chat.digest_conversations(chat.read_turns(formatted))


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"), keep_text=False
    )
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op5_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(table(spark, sf, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return linedup.dedup_lines(docs, linedup.ALL_LINES).select("doc_id", "n_lines", "n_removed", "text")


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_page_text(spark: SparkSession, sf: str) -> DataFrame:
    return pagetext.extract(table(spark, sf, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs, table(spark, sf, "labels")), keep_text=False)
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.KEEP_FROM).cast("int").alias("predicted"),
        "n_passages",
        "top_passage",
    )


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rules.judge(table(spark, sf, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def _planted(docs: DataFrame) -> DataFrame:
    """Repeats words at the end of the texts whose id has a checksum divisible by ten."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    first = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words(F.col("text"))))
    sized = first.withColumn("n", F.size("w").cast("long")).withColumn("g", F.floor(F.col("h") / 10))
    start = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    given = start.withColumn("p", period)
    repeated = F.expr("array_join(transform(sequence(0L, n - 1), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return given.select("doc_id", F.when(F.col("p").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.find_runs(_planted(table(spark, sf, "documents").select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


def op13_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    weights = mixing.quality_weights(table(spark, sf, "labels"))
    return mixing.mix(table(spark, sf, "documents"), weights)


QUERIES = {
    "op1_url_rules": op1_url_rules,
    "op2_packing": op2_packing,
    "op3_chat": op3_chat,
    "op4_decontamination": op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash": op7_simhash,
    "op8_page_text": op8_page_text,
    "op9_quality": op9_quality,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_collocations": op12_collocations,
    "op13_source_mix": op13_source_mix,
}
