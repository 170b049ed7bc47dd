"""Keys and names as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters that count as white space, for Java and RE2 alike.
SPACE = r"[\s\x{0B}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
# Metadata that says nothing, of any kind, as a title, as an author.
EMPTY_METADATA = r"^(?:\[?no data\]?|unknown|untitled|null|none)$"
EMPTY_TITLE = r"^(?:pii\s*:|microsoft word\b|c\d+$|document\d*$|\d*[ _-]*cover\b|\d+\s+introduction$)"
EMPTY_AUTHOR = r"^(?:administrator|user|owner|scanner|uploader|unknown)$"
# Words of an edition and of publishers that do not tell works apart.
EDITION_WORDS = "edition|edn|revised|expanded|illustrated|retail|ebook|press|publisher"
PUBLISHERS = "oxford|cambridge|penguin|routledge|springer|harvard|princeton|viking|anchor|norton"
# Marks of editors and of further authors, and what stands between two names.
EDITOR, EDITOR_END, OTHERS, CONJUNCTION = r"(?i)\((?:ed|eds|editor|editors)\.?\)", r"(?i)\b(?:ed|eds|editor|editors)\.?$", r"(?i)\bet\s+al\.?\b", r"(?i)\s+(?:and|a|&|et)\s+|;"
# Tails of file names that are not part of a title.
TITLE_TAILS = [r"(?i)\s+--\s+isbn\d*[\s\S]*$", r"(?i)\s+--\s+[a-f0-9]{16,}[\s\S]*$", r"(?i)\s*\((?:copy|retail|ebook|pdf)\s*\d*\)\s*$", r"\s+\(\d+\)\s*$"]


def squeezed(column: Column) -> Column:
    """Null as empty, white space reduced to single spaces and trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(column, F.lit("")), SPACE + "+", " "))


@F.pandas_udf(StringType())
def decomposed(text: pd.Series) -> pd.Series:
    """Compatibility decomposition, which Spark has no function for."""
    import pyarrow as pa
    import pyarrow.compute as pc

    return pc.utf8_normalize(pa.array(text, type=pa.string()), form="NFKD").to_pandas()


def ascii_key(column: Column) -> Column:
    """Lower-case letters a to z and digits, everything else single spaces; ``&`` is ``and``."""
    bare = F.lower(F.regexp_replace(decomposed(squeezed(column)), r"[\x{300}-\x{36F}]", ""))
    return F.trim(F.regexp_replace(F.replace(bare, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def title_hint(column: Column) -> Column:
    """A title from a file name, without prefixes, underscores, ISBN and hash tails and copy numbers."""
    out = F.regexp_replace(F.regexp_replace(F.coalesce(column, F.lit("")), r"(?i)^title:\s*", ""), "_+", " ")
    for tail in TITLE_TAILS:
        out = F.regexp_replace(out, tail, "")
    return squeezed(out)


def useful_metadata(column: Column, kind: str) -> Column:
    """Whether a metadata value says something; kind is ``title`` or ``author``."""
    text = squeezed(column)
    return (text != "") & ~text.rlike("(?i)" + EMPTY_METADATA) & ~text.rlike("(?i)" + (EMPTY_TITLE if kind == "title" else EMPTY_AUTHOR))


def edition_free(key: Column) -> Column:
    """An :func:`ascii_key` without years and words of editions and publishers."""
    for words in (r"(?:19|20)\d{2}", f"(?:{EDITION_WORDS})", f"(?:{PUBLISHERS})"):
        key = F.regexp_replace(key, rf"\b{words}\b", " ")
    return F.trim(F.regexp_replace(key, r"\s+", " "))


def work_hint_key(author_key: Column, title_key: Column) -> Column:
    """``author|title`` of two keys, empty where the title is too short to tell works apart."""
    short = (F.length(title_key) < 8) | ((author_key == "") & (F.size(F.split(title_key, " ")) < 4))
    return F.when(short, "").otherwise(F.concat_ws("|", author_key, title_key))


def contributors(column: Column) -> Column:
    """The names in a byline, in order.

    Conjunctions and semicolons part names.  So do commas where a part has at
    least two, or one in a byline with a conjunction; but one comma after a
    single word and before at most two is a name turned around.
    """
    text = squeezed(column)
    for mark in (EDITOR, EDITOR_END, OTHERS):
        text = F.regexp_replace(text, mark, " ")
    text = squeezed(text)
    joined = text.rlike(CONJUNCTION)
    count = lambda words: F.size(F.split(words, r"\s+"))

    def names(part: Column) -> Column:
        pieces = F.filter(F.transform(F.split(part, ","), squeezed), lambda p: p != "")
        turned = (count(F.get(pieces, F.lit(0))) == 1) & (count(F.get(pieces, F.lit(1))) <= 2)
        listed = (F.size(pieces) > 2) | ((F.size(pieces) == 2) & joined & ~turned)
        return F.when(listed, pieces).otherwise(F.array(squeezed(part)))

    return F.filter(F.flatten(F.transform(F.split(text, CONJUNCTION), names)), lambda n: n != "")


def given_first(name: Column) -> Column:
    """``Surname, Given`` turned around where the surname has at most three words."""
    pieces = F.filter(F.transform(F.split(name, ","), squeezed), lambda p: p != "")
    surname, given = F.get(pieces, F.lit(0)), F.get(pieces, F.lit(1))
    return F.when((F.size(pieces) == 2) & (F.size(F.split(surname, r"\s+")) <= 3), F.concat_ws(" ", given, surname)).otherwise(name)


def file_part(column: Column, most: int = 180) -> Column:
    """Text safe in a file name, ``Unknown`` where nothing is left."""
    text = F.regexp_replace(squeezed(column), r'[\x{00}-\x{1F}<>:"/\\|?*]', " ")
    text = squeezed(F.regexp_replace(text, r"\.+$", ""))
    return F.trim(F.substring(F.when(text == "", "Unknown").otherwise(text), 1, most))


def slug(key: Column, most: int = 72) -> Column:
    """An :func:`ascii_key` with hyphens, cut to a length."""
    return F.regexp_replace(F.substring(F.replace(key, F.lit(" "), F.lit("-")), 1, most), "-+$", "")


def stable_id(prefix: str, column: Column) -> Column:
    """A prefix and the first 16 hex digits of SHA-1."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha1(column), 1, 16))
