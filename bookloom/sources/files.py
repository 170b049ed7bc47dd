"""Folders of books as tables: scans, heads, EPUB sections, JSON in and out."""

from __future__ import annotations

import html
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from pathlib import PurePosixPath
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from bookloom.functions.keys import stable_id

#: Formats that are read, and bytes of the head that metadata are looked for in.
FORMATS, HEAD_BYTES, MARKDOWN_CHARS = ["md", "epub", "pdf"], 131_072, 20_000
#: HTML entries of an EPUB sample at most, and characters after which it ends.
SAMPLE_ENTRIES, SAMPLE_CHARS = 8, 12_000
# Names of EPUB entries that hold no text of the book, read last.
NOISE = r"(?:cover|toc|nav|title|copyright|contents)"

_BREAK = re.compile(r"</(?:p|div|h[1-6]|li|tr|blockquote|section)>|<br\s*/?>", re.I)
_HIDDEN = re.compile(r"<(script|style|head)\b.*?</\1>", re.I | re.S)
_TAG = re.compile(r"<[^>]+>")


def any_case(extension: str) -> str:
    """A glob that finds an extension in any case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)


def scan(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """(id, relativePath, extension, size, mtimeMs, sha256) of every book file; system files are skipped.

    The hash needs the content, which is read only where ``sha256`` is selected.
    Names that begin with ``_`` or ``.`` are not seen by Spark's file sources.
    """
    glob = "*.{" + ",".join(any_case(x) for x in FORMATS) + "}"
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", glob).load(folder)
    root = "(?i)^(?:file:)?/*" + re.escape(folder.removeprefix("file:").strip("/")) + "/"
    path = F.regexp_replace(F.regexp_replace("path", "%20", " "), root, "")
    rows = raw.select(path.alias("relativePath"), F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).alias("extension"), F.col("length").alias("size"), (F.unix_micros("modificationTime") / 1000).alias("mtimeMs"), F.sha2("content", 256).alias("sha256"))
    return rows.where(~F.col("relativePath").rlike(r"(^|/)(?:__MACOSX/|\._|\.DS_Store)")).withColumn("id", stable_id("file", F.col("relativePath")))


def unchanged(now: DataFrame, before: DataFrame) -> DataFrame:
    """``now`` with ``reuse``: the size is the same and the time within a millisecond, so nothing need be read again."""
    old = before.groupBy("relativePath").agg(F.max(F.struct("size", "mtimeMs")).alias("old"))
    same = (F.col("old.size") == F.col("size")) & (F.abs(F.col("old.mtimeMs") - F.col("mtimeMs")) < 1)
    return now.join(old, "relativePath", "left").withColumn("reuse", F.coalesce(same, F.lit(False))).drop("old")


def beginnings(spark: SparkSession, folder: str, extension: str, size: int) -> DataFrame:
    """(path, head): the first ``size`` bytes of every file of an extension; no more of a file is read."""
    from pyarrow import fs

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*." + any_case(extension)).load(folder).select("path")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path in pdf["path"]:
                local = re.match(r"(?:file:)?(?://)?(/.*)", path)
                system, own = (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(quote(path, safe=":/"))
                with system.open_input_stream(own) as stream:
                    out.append((path, stream.read(size)))
            yield pd.DataFrame(out, columns=["path", "head"])

    return listed.mapInPandas(read, "path string, head binary")


def heads(spark: SparkSession, folder: str) -> DataFrame:
    """(path, title, author) from the first bytes of Markdown files: front matter keys, else the first heading."""
    raw = beginnings(spark, folder, "md", HEAD_BYTES)
    head = F.decode("head", "utf-8")
    field = lambda k: F.nullif(F.trim(F.regexp_extract(head, rf"(?mi)^{k}:[ \t]*[\"']?(.*?)[\"']?[ \t]*\r?$", 1)), F.lit(""))
    first = F.nullif(F.trim(F.regexp_extract(head, r"(?m)^#[ \t]+(.+?)\r?$", 1)), F.lit(""))
    return raw.select("path", F.coalesce(field("title"), first).alias("title"), field("author").alias("author"))


def markdown_samples(spark: SparkSession, folder: str, chars: int = MARKDOWN_CHARS) -> DataFrame:
    """(path, sample): the first characters of every Markdown file; four bytes a character at most are read."""
    return beginnings(spark, folder, "md", 4 * chars).select("path", F.substring(F.decode("head", "utf-8"), 1, chars).alias("sample"))


def pdf_pages(spark: SparkSession, folder: str, open_pages: Callable[[bytes], Iterator[str]]) -> DataFrame:
    """(path, page, pages, text, error) of every page of every PDF, by a reader that yields the pages' texts.

    No reader is part of this library; one is passed in.  A file whose reader
    fails is one row with the error and no page, however many it had yielded.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*." + any_case("pdf")).load(folder).select("path", "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    texts = list(open_pages(content))
                    rows = [(path, k, len(texts), t, None) for k, t in enumerate(texts, 1)] or [(path, 0, 0, None, "no pages")]
                except Exception as e:  # one broken book is no reason to lose the others
                    rows = [(path, 0, 0, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["path", "page", "pages", "text", "error"])

    return raw.mapInPandas(read, "path string, page int, pages int, text string, error string")


def pdf_samples(pages: DataFrame) -> DataFrame:
    """(path, sample): the first four pages, of which the fourth counts once, and the last of each PDF."""
    wanted = pages.where("error IS NULL AND (page <= 4 OR page = pages)")
    rows = wanted.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("p"))
    return rows.select("path", F.array_join(F.transform("p", lambda x: F.coalesce(x["text"], F.lit(""))), "\n\n").alias("sample"))


def pdf_markdown(pages: DataFrame) -> DataFrame:
    """(path, markdown, error): a block for every page under ``## Page N``; under ten words in all is a failure."""
    rows = pages.groupBy("path").agg(F.array_sort(F.collect_list(F.when(F.col("error").isNull(), F.struct("page", "text")))).alias("p"), F.max("error").alias("error"))
    text = F.array_join(F.transform("p", lambda x: F.concat(F.lit("## Page "), x["page"].cast("string"), F.lit("\n\n"), F.trim(F.coalesce(x["text"], F.lit(""))))), "\n\n")
    words = F.aggregate("p", F.lit(0), lambda n, x: n + F.regexp_count(F.coalesce(x["text"], F.lit("")), F.lit(r"\S+")))
    error = F.coalesce("error", F.when(words < 10, "fewer than ten words"))
    return rows.select("path", F.when(error.isNull(), F.concat(text, F.lit("\n"))).alias("markdown"), error.alias("error"))


def by_format(scanned: DataFrame) -> DataFrame:
    """``scanned`` with ``place``: preferred formats first, then by name.  A bounded list of staged files is numbered in one task."""
    rank = F.coalesce(*[F.when(F.col("extension") == f".{x}", k) for k, x in enumerate(FORMATS)], F.lit(len(FORMATS)))
    return scanned.withColumn("place", F.row_number().over(Window.orderBy(rank, "relativePath")))


def plain_text(markup: str) -> str:
    """HTML as text: blocks parted by blank lines, entities decoded."""
    text = html.unescape(_TAG.sub("", _BREAK.sub("\n\n", _HIDDEN.sub(" ", markup))))
    text = re.sub(r"[ \t\r\f\v]+", " ", text)
    return re.sub(r"\s*\n\s*\n\s*", "\n\n", text).strip()


def epub_entries(content: bytes) -> list[tuple[str, str]]:
    """(name, text) of an EPUB's HTML entries in reading order: by the spine, else by name."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in z.namelist() if re.search(r"\.x?html?$", n, re.I)]
        package = next((n for n in z.namelist() if n.lower().endswith(".opf")), None)
        order: list[str] = []
        if package:
            opf, base = z.read(package).decode("utf-8", "replace"), PurePosixPath(package).parent
            items = {}
            for tag in re.findall(r"<item\b[^>]*>", opf):
                at = dict(re.findall(r'([\w-]+)\s*=\s*"([^"]*)"', tag))
                items[at.get("id")] = str(base / html.unescape(at.get("href", "")))
            order = [items[i] for i in re.findall(r'<itemref\b[^>]*idref="([^"]+)"', opf) if items.get(i) in names]
        order += sorted(n for n in names if n not in order)
        return [(n, plain_text(z.read(n).decode("utf-8", "replace"))) for n in order]


def epub_metadata(content: bytes) -> tuple[str | None, str | None]:
    """(title, authors) of an EPUB's package, several authors joined by ``; ``."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        package = next((n for n in z.namelist() if n.lower().endswith(".opf")), None)
        opf = z.read(package).decode("utf-8", "replace") if package else ""
    get = lambda k: [html.unescape(_TAG.sub("", x)).strip() for x in re.findall(rf"<dc:{k}\b[^>]*>(.*?)</dc:{k}>", opf, re.S)]
    return next(iter(get("title")), None), "; ".join(get("creator")) or None


def epub_sections(spark: SparkSession, folder: str) -> DataFrame:
    """(path, ordinal, name, text, title, author, error) of every section of every EPUB.

    A file that cannot be read is one row with its error and no text.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*." + any_case("epub")).load(folder).select("path", "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    title, author = epub_metadata(content)
                    out += [(path, k, name, text, title, author, None) for k, (name, text) in enumerate(epub_entries(content), 1)]
                except Exception as e:  # one broken book is no reason to lose the others
                    out.append((path, 0, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "ordinal", "name", "text", "title", "author", "error"])

    return raw.mapInPandas(read, "path string, ordinal int, name string, text string, title string, author string, error string")


def epub_samples(sections: DataFrame) -> DataFrame:
    """(path, sample): the first entries of each EPUB up to a number of characters, entries without text of the book last."""
    noise = F.when(F.lower("name").rlike(NOISE), 1).otherwise(0)
    rows = sections.where("text <> ''").groupBy("path").agg(F.sort_array(F.collect_list(F.struct(noise.alias("noise"), "ordinal", "text"))).alias("s"))
    texts = F.transform(F.slice("s", 1, SAMPLE_ENTRIES), lambda x: x["text"])
    return rows.select("path", F.substring(F.array_join(texts, "\n\n"), 1, SAMPLE_CHARS).alias("sample"))


def epub_markdown(sections: DataFrame) -> DataFrame:
    """(path, sections, markdown): sections of ten words or more under their original numbers; fewer than ten words in all give null."""
    kept = sections.where(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+")) >= 10)
    rows = kept.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("ordinal", "text"))).alias("s"))
    parts = F.transform("s", lambda x: F.concat(F.lit("## Section "), x["ordinal"], F.lit("\n\n"), x["text"]))
    return sections.select("path").distinct().join(rows.select("path", F.size("s").alias("sections"), F.concat(F.array_join(parts, "\n\n"), F.lit("\n")).alias("markdown")), "path", "left")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jvm)


def read_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A JSON document or JSON Lines table of a stated schema; empty where there is none.

    Where a writer was stopped between its two renames, the table before it is read.
    """
    for place in (path, path + ".old"):
        if _exists(spark, place):
            return spark.read.schema(schema).json(place)
    return spark.createDataFrame([], schema)


def without_keys(df: DataFrame, volatile: list[str]) -> DataFrame:
    """``df`` without the named columns and, however deep, the named fields of structs."""

    def pruned(column: Column, kind: DataType) -> Column:
        if isinstance(kind, StructType):
            kept = [pruned(column[f.name], f.dataType).alias(f.name) for f in kind.fields if f.name not in volatile]
            return F.when(column.isNotNull(), F.struct(*kept)) if kept else F.lit(None).cast("string")
        if isinstance(kind, ArrayType) and isinstance(kind.elementType, (StructType, ArrayType)):
            return F.transform(column, lambda x: pruned(x, kind.elementType))
        return column

    return df.select(*[pruned(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields if f.name not in volatile])


def content_hash(df: DataFrame, volatile: list[str]) -> str:
    """One hash of all rows whatever their order, without the columns and fields that change from run to run."""
    rows = without_keys(df, volatile)
    text = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    sums = rows.select(F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g")).agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(h)").alias("x"), F.sum(F.col("g").cast("decimal(38,0)")).alias("s"))
    return str(tuple(sums.first()))


def write_if_changed(df: DataFrame, path: str, volatile: list[str] | None = None) -> bool:
    """Replace the JSON Lines table at ``path`` by ``df`` where their lasting content differs.

    The new table is written beside the old one, which is renamed, not deleted,
    before the new one takes its place; so one of the two can be read at any time.
    """
    spark, volatile = df.sparkSession, volatile or []
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    there = fs.exists(jvm(path))
    if there and content_hash(read_json(spark, path, df.schema), volatile) == content_hash(df, volatile):
        return False
    df.write.mode("overwrite").json(path + ".next")
    if there:
        fs.delete(jvm(path + ".old"), True)
        fs.rename(jvm(path), jvm(path + ".old"))
    fs.rename(jvm(path + ".next"), jvm(path))
    fs.delete(jvm(path + ".old"), True)
    return True


def write_text(texts: DataFrame, folder: str) -> None:
    """Texts (name, text) as one text file for each name."""
    texts.select("name", F.col("text").alias("value")).repartition("name").write.mode("overwrite").partitionBy("name").text(folder)


def remove_orphans(spark: SparkSession, folder: str, names: set[str]) -> list[str]:
    """Delete entries of a folder that no name keeps, and list them; hidden ones stay."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = jvm.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    entries = [e.getPath() for e in fs.listStatus(jvm)] if fs.exists(jvm) else []
    gone = [p for p in entries if p.getName() not in names and not p.getName().startswith((".", "_"))]
    for p in gone:
        fs.delete(p, True)
    return sorted(p.getName() for p in gone)


def preflight(scanned: DataFrame) -> DataFrame:
    """(problem, subject): what keeps a folder's files from being taken in: none at all, empty files, names that differ in case only."""
    rows = scanned.select("relativePath", "size", F.lower("relativePath").alias("low"))
    none = rows.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("no_files").alias("problem"), F.lit("").alias("subject"))
    empty = rows.where("size = 0").select(F.lit("empty_file"), "relativePath")
    alike = rows.groupBy("low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("name_collision"), "low")
    return none.union(empty).union(alike)


def write_routed(rows: DataFrame, folder: str, group: Column) -> None:
    """Rows as Parquet, a folder for each group; rows without one go to ``unclassified``."""
    rows.withColumn("readyGroup", F.coalesce(group, F.lit("unclassified"))).write.mode("overwrite").partitionBy("readyGroup").parquet(folder)


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """``old`` with the rows of ``new`` put over those of the same key.

    Of several new rows of a key the greatest in ``order``, then in all columns, counts.
    """
    rest = [c for c in new.columns if c not in key and c not in (order or [])]
    best = new.groupBy(*key).agg(F.max(F.struct(*(order or []), *rest)).alias("_r"))
    one = best.select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in new.columns]) if len(new.columns) > len(key) else new.distinct()
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(one, allowMissingColumns=True)
