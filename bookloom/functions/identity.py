"""Who wrote what, from paths and typed bylines: hints, keys of one work, names of files; as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom.functions import keys as K

# Shapes of file names that tell author and title apart.
BRACKETED, BY = r"^\[([^\]]+)\]\s*(.+)$", r"(?i)^(.{4,}?)\s+by\s+(.{3,80})$"
# Names of folders that are an author's: with a count of books, a turned name, and "ebooks of".
FOLDER_COUNT, FOLDER_NAME, FOLDER_OF = r"(?i)\(\s*\d+\s+books?\b", r"^[^,]{2,50},\s*[^,]{2,50}(?:\s*\([^)]*\))?$", r"(?i)^ebooks?\s+of\s+(.+)$"
# Folders that hold many works of one author.
BUNDLES = r"(?i)\(\s*\d+\s+books?\b|ebooks?\s+of\b|complete\s+(?:works|collection)"
# Words between authors, editors' marks, and what parts a title from its subtitle.
JOINTS, EDITORS, SUBTITLE = r"(?i)\s+(?:and|a|&|et)\s+|;", r"\b(?:ed|editor|editors|eds|et al)\b", r"\s*:\s*|\s+[–—-]\s+"
# A volume in a subtitle, a part of a work in a title, marks of an article, and texts about a work.
VOLUME = r"(?i)\b(?:vol|volume|book|part|svazek|d[ií]l)\s*[ivx\d]+\b"
PARTIAL = r"(?i)\b(?:books?|vol(?:ume)?s?|parts?|chapters?|selections?|extracts?)\b"
ARTICLE = r"(?i)\b(?:article|excerpts?)\b"
PARATEXT = r"(?i)\b(?:introduction|afterword|foreword|preface|review|letter|response|commentary|obituary|errata|addendum)\b"
# Names of the two preferred languages, and of an unknown one.
PREFERRED, UNKNOWN = r"^(?:en|english|anglictina|cs|cz|czech|cestina)$", ["", "unknown", "neznamy"]
# Characters of author, title and both in the name of a file.
AUTHOR_CHARS, TITLE_CHARS, NAME_CHARS = 70, 120, 190
# How much a kind of evidence is worth.
EVIDENCE = {"web_research": 5, "known_work": 4, "provided_metadata": 3, "path_or_filename": 2, "uncertain": 1}


def _filled(column: Column) -> Column:
    return F.when(column != "", column)


def name_hints(path: Column, title: Column, author: Column) -> Column:
    """struct<author, title, rawBase, context> of a file, from its metadata, its name and its folders, in this order.

    A name may say ``[Author] Title``, ``Title by Author`` or ``Author - Title``;
    of the folders the first may be an author's.  The context is the last three
    folders.
    """
    folders = F.filter(F.split(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), "/"), lambda p: (p != "") & (p != "."))
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    base = K.title_hint(F.regexp_replace(name, r"(.)\.[^.]*$", "$1"))
    parts = F.filter(F.transform(F.split(base, r"\s+-\s+"), K.squeezed), lambda p: p != "")
    several = F.size(parts) >= 2
    top = F.coalesce(F.get(folders, F.lit(0)), F.lit(""))
    owner = F.when(top.rlike(FOLDER_COUNT) | top.rlike(FOLDER_NAME), F.regexp_replace(top, r"\s*\([^)]*\)\s*$", "")).otherwise(_filled(F.regexp_extract(top, FOLDER_OF, 1)))
    meta = lambda c, kind: F.when(K.useful_metadata(c, kind), K.squeezed(c))
    whose = F.coalesce(meta(author, "author"), _filled(F.regexp_replace(F.regexp_extract(base, BRACKETED, 1), r"\s*,\s*", ", ")), _filled(F.regexp_extract(base, BY, 2)), F.when(several, F.get(parts, F.lit(0))), owner, F.lit(""))
    what = F.coalesce(meta(title, "title"), _filled(F.regexp_extract(base, BRACKETED, 2)), _filled(F.regexp_extract(base, BY, 1)), F.when(several, F.array_join(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), " - ")), base)
    context = F.array_join(F.slice(folders, F.greatest(F.size(folders) - 2, F.lit(1)), 3), " / ")
    return F.struct(K.title_hint(whose).alias("author"), K.title_hint(what).alias("title"), base.alias("rawBase"), context.alias("context"))


def bundle_like(path: Column) -> Column:
    """Whether the first folder of a path holds many works of one author."""
    return F.coalesce(F.get(F.filter(F.split(path, r"[\\/]"), lambda p: p != ""), F.lit(0)), F.lit("")).rlike(BUNDLES)


def _bare_key(decomposed: Column) -> Column:
    """An ``ascii_key`` of text that is decomposed already."""
    bare = F.lower(F.regexp_replace(K.squeezed(decomposed), r"[\x{300}-\x{36F}]", ""))
    return F.trim(F.regexp_replace(F.replace(bare, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def _last_word(text: Column) -> Column:
    return F.element_at(F.split(text, " +"), -1)


def canonical_key(said: Column, author: Column, title: Column, kind: Column, source: Column) -> Column:
    """``authors|title`` under which records of one work meet.

    ``said`` is a key given as ``author | title``, which goes before the shown
    author and title.  Authors are their sorted last words.  A subtitle is
    dropped after at least three words, unless it names a volume; titles of
    parts stay as shown, and so do articles, unless the key marks them as such.
    Another kind than a book whose file, but not whose title, names a text about
    a work has that said behind the title.  Nulls are empty.
    """
    said, author, title, source = (F.coalesce(c, F.lit("")) for c in (said, author, title, source))
    parts = F.transform(F.split(said, r"\|"), K.squeezed)
    given = F.size(parts) >= 2
    who = F.when(given, F.get(parts, F.lit(0))).otherwise(author)
    what = F.when(given, F.array_join(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), " | ")).otherwise(title)
    what = F.when(what == "", title).otherwise(what)
    marks = F.transform(F.split(K.decomposed(who), JOINTS), lambda a: F.trim(F.regexp_replace(_bare_key(a), EDITORS, " ")))
    signatures = F.array_join(F.array_sort(F.transform(F.filter(marks, lambda a: a != ""), _last_word)), "+")
    authors = F.when(signatures != "", signatures).otherwise(K.ascii_key(F.when(who != "", who).otherwise(author)))
    pieces = F.filter(F.transform(F.split(what, SUBTITLE), F.trim), lambda p: p != "")
    first = F.get(pieces, F.lit(0))
    short = (F.size(pieces) > 1) & (F.size(F.split(first, " ")) >= 3) & ~F.array_join(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), " ").rlike(VOLUME)
    chosen = F.when(kind == "article", F.when(what.rlike(ARTICLE), what).otherwise(title)).when(title.rlike(PARTIAL), title).when(short, first).otherwise(what)
    key = K.edition_free(K.ascii_key(chosen))
    about = (F.coalesce(kind, F.lit("")) != "book") & source.rlike(PARATEXT) & ~title.rlike(PARATEXT)
    return F.concat(authors, F.lit("|"), key, F.when(about, F.concat(F.lit("|paratext "), K.edition_free(K.ascii_key(source)))).otherwise(""))


def lead_author(author: Column) -> Column:
    """The last word of the first of several authors, as a key; commas part authors too."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(K.decomposed(F.coalesce(author, F.lit(""))), r"[\x{300}-\x{36F}]", "")), EDITORS, " ")
    first = F.coalesce(F.get(F.filter(F.transform(F.split(bare, r"\s+(?:and|a|&|et)\s+|[;,]"), F.trim), lambda p: p != ""), F.lit(0)), F.lit(""))
    key = _bare_key(first)
    return F.when(key != "", _last_word(key)).otherwise(first)


def language_rank(language: Column) -> Column:
    """0 for the two preferred languages, 1 for an unknown one, 2 for others."""
    key = K.ascii_key(language)
    return F.when(key.rlike(PREFERRED), 0).when(key.isin(UNKNOWN), 1).otherwise(2)


def evidence_rank(evidence: Column) -> Column:
    """The worth of a kind of evidence, 0 for others."""
    return F.coalesce(*[F.when(evidence == k, v) for k, v in EVIDENCE.items()], F.lit(0))


def output_name(author: Column, title: Column, extension: Column) -> Column:
    """``Author - Title.ext``, safe in a file name."""
    base = F.concat(K.file_part(F.coalesce(author, F.lit("")), AUTHOR_CHARS), F.lit(" - "), K.file_part(F.coalesce(title, F.lit("")), TITLE_CHARS))
    return F.concat(K.file_part(base, NAME_CHARS), F.lower(extension))


def unique_names(works: DataFrame, name: str, id_: str, out: str = "outputName") -> DataFrame:
    """``works`` with names that differ in more than case: all of one name but the one of smallest id get eight characters of their id."""
    least = works.groupBy(F.lower(name).alias("_low")).agg(F.min(id_).alias("_first"))
    rows = works.withColumn("_low", F.lower(name)).join(least, "_low")
    marked = F.regexp_replace(name, r"(\.[^.]*)$", "")
    tail = F.concat(marked, F.lit(" ["), F.right(id_, F.lit(8)), F.lit("]"), F.regexp_extract(name, r"(\.[^.]*)$", 1))
    return rows.withColumn(out, F.when(F.col(id_) == F.col("_first"), F.col(name)).otherwise(tail)).drop("_low", "_first")


def selection_identity(author: Column, title: Column) -> Column:
    """struct<author, title>, trimmed, by which a selected book is known again."""
    return F.struct(F.trim(F.coalesce(author, F.lit(""))).alias("author"), F.trim(F.coalesce(title, F.lit(""))).alias("title"))


def unit_anchor(work: Column, part: Column) -> Column:
    """The anchor of one part of a work."""
    return F.concat(K.slug(K.ascii_key(work)), F.lit("-"), part.cast("string"))
