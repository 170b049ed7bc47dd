"""Queries over finished units and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookloom.functions import keys as K
from bookloom.functions.identity import unit_anchor
from bookloom.functions.text import word_count
from bookloom.operators import retrieval, units
from bookloom.plans import documents
from bookloom.plans.portfolio import FILE_BYTES, FILE_TOKENS, file_packing
from bookloom.plans.sql import contributor_steps
from bookloom.session import materialize
from bookloom.sources.tables import table

#: Surnames in a file's name at most, and its length.
SURNAMES, NAME_LENGTH = 4, 80


def _units(spark: SparkSession, folder: str) -> DataFrame:
    """One row per work, unit and content: of several the greatest in count, author and title."""
    u = table(spark, folder, "book_units").groupBy("workId", "unitIndex", "content").agg(F.max(F.struct("unitCount", "author", "title")).alias("r"))
    return u.select("workId", "unitIndex", "r.unitCount", "r.author", "r.title", "content")


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    """(id, unit, author, title, content, size) of every unit as last loaded, the row that is packed."""
    u = table(spark, folder, "book_units").where("workId IS NOT NULL AND content IS NOT NULL").groupBy(F.col("workId").alias("id"), F.col("unitIndex").cast("bigint").alias("unit")).agg(F.max(F.struct("loadedAt", "corpus", "title", "content", "author")).alias("r"))
    return u.select("id", "unit", "r.author", "r.title", "r.content", F.octet_length("r.content").alias("size"))


def retrieval_units(spark: SparkSession, folder: str) -> DataFrame:
    """Every unit with its context, as sizes and the hash of what it carries."""
    made = retrieval.retrieval_units(_units(spark, folder))
    return made.select("workId", "unitIndex", F.octet_length("text").alias("bytes"), "payload", F.size("sections").alias("sections"))


def retrieval_payload(spark: SparkSession, folder: str) -> DataFrame:
    """The hash of what each finished unit carries, which equals that of its source."""
    return retrieval_units(spark, folder).select("workId", "unitIndex", F.col("payload").alias("hash")).distinct()


def retrieval_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Finished units that break a rule, by rule."""
    return retrieval.broken_units(retrieval.retrieval_units(_units(spark, folder))).groupBy("problem").agg(F.count(F.lit(1)).alias("units"))


def surname_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Per corpus the bytes each surname stands for: a unit's bytes are shared among its authors."""
    u = table(spark, folder, "book_units").select("corpus", "workId", "unitIndex", "author", F.octet_length("content").alias("size")).distinct()
    names = F.transform(K.contributors(F.col("author")), K.given_first)
    rows = u.withColumn("n", F.greatest(F.size(names), F.lit(1))).select("corpus", "n", "size", F.posexplode_outer(names).alias("place", "name"))
    surname = F.coalesce(F.nullif(F.element_at(F.split(K.ascii_key(F.col("name")), " "), -1), F.lit("")), F.lit("books"))
    return rows.withColumn("surname", surname).groupBy("corpus", "surname").agg(F.round(F.sum(F.col("size") / F.col("n")), 4).alias("weight"))


def file_names(spark: SparkSession, folder: str) -> DataFrame:
    """The name of each packed file: its number and the surnames of most weight that fit."""
    packed = file_packing(spark, folder).where("file IS NOT NULL").select("id", "unit", "corpus", "file")
    return _names(packed, _latest(spark, folder).select("id", "unit", "author", "size"))


def _names(packed: DataFrame, u: DataFrame) -> DataFrame:
    names = F.transform(K.contributors(F.col("author")), K.given_first)
    rows = materialize(packed.join(u, ["id", "unit"]).withColumn("n", F.greatest(F.size(names), F.lit(1))).select("corpus", "file", "n", "size", F.explode_outer(names).alias("name")), "names")
    surname = F.coalesce(F.nullif(F.element_at(F.split(K.ascii_key(F.col("name")), " "), -1), F.lit("")), F.lit("books"))
    weights = rows.withColumn("surname", surname).groupBy("corpus", "file", "surname").agg(F.sum(F.col("size") / F.col("n")).alias("w"))
    first = weights.withColumn("k", F.row_number().over(Window.partitionBy("corpus", "file").orderBy(F.col("w").desc(), "surname"))).where(F.col("k") <= SURNAMES)
    listed = first.groupBy("corpus", "file").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "surname"))), lambda s: s["surname"]).alias("s"))
    room = NAME_LENGTH - 6
    joined = F.aggregate("s", F.struct(F.lit("").alias("stem"), F.lit(True).alias("more")), lambda a, x: F.struct(F.when(a["more"] & (F.length(a["stem"]) + F.length(x) + F.when(a["stem"] == "", 0).otherwise(1) <= room), F.concat(a["stem"], F.when(a["stem"] == "", "").otherwise("_"), x)).otherwise(a["stem"]).alias("stem"), (a["more"] & (F.length(a["stem"]) + F.length(x) + F.when(a["stem"] == "", 0).otherwise(1) <= room)).alias("more")))["stem"]
    stem = F.coalesce(F.nullif(joined, F.lit("")), F.substring(F.get("s", F.lit(0)), 1, room))
    return listed.select("corpus", "file", F.concat(F.lpad(F.col("file").cast("string"), 2, "0"), F.lit("_"), stem, F.lit(".md")).alias("name"))


def file_report(spark: SparkSession, folder: str) -> DataFrame:
    """Books, units, bytes, words and largest unit of every packed file."""
    packed = file_packing(spark, folder).where("file IS NOT NULL").select("id", "unit", "corpus", "file")
    u = _latest(spark, folder).select("id", "unit", "size", word_count(F.col("content")).alias("words"))
    return packed.join(u, ["id", "unit"]).groupBy("corpus", "file").agg(F.countDistinct("id").alias("books"), F.count(F.lit(1)).alias("units"), F.sum("size").alias("bytes"), F.sum("words").alias("words"), F.max("size").alias("largest"))


def _named_units(spark: SparkSession, folder: str) -> DataFrame:
    """Packed units with file name and anchor, as merged files take them."""
    packed = materialize(file_packing(spark, folder).where("file IS NOT NULL").select("id", "unit", "corpus", "file"), "packed")
    u = materialize(_latest(spark, folder), "units")
    names = _names(packed, u.select("id", "unit", "author", "size"))
    counts = packed.groupBy("id").agg(F.count(F.lit(1)).alias("unitCount"))
    rows = packed.join(u, ["id", "unit"]).join(names, ["corpus", "file"]).join(counts, "id")
    return rows.select("corpus", "file", "name", F.col("id").alias("workId"), "author", "title", F.col("unit").alias("unitIndex"), "unitCount", unit_anchor(F.col("id"), F.col("unit")).alias("anchor"), "content")


def merged_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every merged file with its name, bytes and the books it holds."""
    bodies = units.merged_bodies(_named_units(spark, folder))
    return bodies.select("corpus", "file", "name", F.octet_length("text").alias("bytes"), F.regexp_count("text", F.lit(r"(?m)^## BOOK: ")).alias("books"))


def index_links(spark: SparkSession, folder: str) -> DataFrame:
    """Per corpus the parts packed, the links of its index, and how many targets are not linked as often as they stand there."""
    rows = materialize(_named_units(spark, folder), "named")
    links = materialize(units.index_targets(units.corpus_index(rows)), "links")
    expected = rows.select("corpus", F.concat_ws("#", "name", "anchor").alias("target"))
    wrong = units.target_differences(expected, links).groupBy("corpus").agg(F.count(F.lit(1)).alias("wrong"))
    counts = expected.groupBy("corpus").agg(F.count(F.lit(1)).alias("parts")).join(links.groupBy("corpus").agg(F.count(F.lit(1)).alias("links")), "corpus", "left")
    return counts.join(wrong, "corpus", "left").na.fill(0)


def book_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Every unit, cut into parts of at most half a file, as counts and bytes."""
    u = _latest(spark, folder).select(F.concat_ws("#", "id", "unit").alias("workId"), "content")
    parts = units.book_units(u, FILE_BYTES // 2, FILE_TOKENS // 2)
    return parts.groupBy("workId").agg(F.max("unitCount").alias("parts"), F.sum("bytes").alias("bytes"))


QUERIES = {f.__name__: f for f in (retrieval_units, retrieval_payload, retrieval_problems, surname_weights, file_names, file_report, merged_files, index_links, book_parts)}
SQL = {
    "surname_weights": f"""WITH u AS (SELECT DISTINCT corpus, workId, unitIndex, author, strlen(content) AS size FROM book_units), {contributor_steps('c', 'u')},
n AS (SELECT corpus, size / greatest(len(nameKeys), 1) AS w, unnest(CASE WHEN len(nameKeys) = 0 THEN [''] ELSE nameKeys END) AS k FROM c3)
SELECT corpus, CASE WHEN k = '' THEN 'books' ELSE string_split(k, ' ')[-1] END AS surname, round(sum(w), 4) AS weight FROM n GROUP BY ALL""",
    "retrieval_payload": documents.SQL["payload_hash"],
    "book_parts": "SELECT workId || '#' || unitIndex AS workId, 1 AS parts, strlen(content) AS bytes FROM (SELECT *, row_number() OVER (PARTITION BY workId, unitIndex ORDER BY loadedAt DESC NULLS LAST, corpus DESC NULLS LAST, title DESC NULLS LAST, content DESC) AS k FROM book_units WHERE workId IS NOT NULL AND content IS NOT NULL) WHERE k = 1 AND strlen(content) <= 5505024",
}
