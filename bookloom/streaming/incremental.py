"""Resumable reading of arriving documents: each batch is measured once and put over what is known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bookloom.functions import text as T


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, bytes, words, reasons, hash) of documents."""
    rows = docs.select("doc_id", F.octet_length("text").alias("bytes"), T.word_count(F.col("text")).alias("words"), F.sha2("text", 256).alias("hash"))
    return rows.withColumn("reasons", T.quality_reasons(F.col("bytes"), F.col("words")))


def measure_arrivals(spark: SparkSession, source: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Measure all Parquet files that have arrived in ``source`` since the last run and append them to ``sink``, each once."""
    stream = spark.readStream.schema("doc_id bigint, text string").parquet(source)
    return measured(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(sink)
