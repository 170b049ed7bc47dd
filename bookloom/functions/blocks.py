"""What a block of a book is: start of the text, front matter, end matter, lists, references; and cuts by it."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from bookloom.functions.text import cleaned, even_line_ends, even_spacing, word_count

# The characters trimmed from both ends of a line.
BLANKS = " \t\n\x0b\f\r\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
# First lines with which a book's text begins, and numbers at the end of a line that make it an entry of a table.
TEXT_BEGINS = r"(?i)^(introduction|preface|prologue|foreword|chapter\s+(1|one)\b|book\s+(1|one)\b|part\s+(1|one)\b|section\s+(1|one)\b)"
NUMBER_ENDS = r"(?i)\b([ivxlcdm]+|\d+)\s*$"
# Phrases about an author, two of which make a note on the author.
AUTHOR_NOTE = [r"\bwas born in\b", r"\bstudied at\b", r"\breceived .* doctorate\b", r"\bbooks include\b", r"\bis the author of\b", r"\bassociate professor\b", r"\bedited by\b"]
# Phrases of a publisher, two of which make a publisher's block.
PUBLISHER = [
    r"\bfirst (?:anchor|paperback|edition)\b", r"\bpublished in the united states\b", r"\boriginally published\b", r"\bmap of\b.*copyright", r"\bgrateful acknowledgement\b", r"\bthe library of congress has cataloged\b",
    r"\bcataloging[- ]in[- ]publication\b", r"\ba catalogue record for this title\b", r"\bprinted and bound\b", r"\bfor further information\b", r"\bvisit our website\b",
]
# Phrases any of which makes an advertisement.
MARKETING = [r"\bwhat'?s next on\b", r"\byour reading list\b", r"\bdiscover your next great read\b", r"\bget personalized book picks\b", r"\bsign up now\b", r"\bavailable from routledge\b", r"\balso of interest in\b", r"\btitles by [a-z]", r"\babout the author\b"]
# Phrases any of which makes front matter.
FRONT = [
    r"also by", r"praise for", r"all rights reserved", r"\backnowledg?ments\b", r"library of congress", r"\bcopyright\b", r"\bcontents\b", r"\bdedication\b", r"\bepigraph\b", r"\bcover\b", r"\btitle page\b", r"\bisbn\b",
    r"\bpublisher'?s note\b", r"\bpublished by\b", r"\bprinted in\b", r"\bthis page intentionally left blank\b", r"internet archive", r"created with hocr-to-epub", r"\blccn\b", r"\bcip\b", r"\babout the author\b",
    r"\balso available\b", r"\bpenguin classics\b", r"\bthe university of chicago press\b",
]
# Words any of which makes end matter, and first lines that open it.
END = [r"\bindex\b", r"\bendnotes\b", r"\bnotes\b", r"\bbibliography\b", r"\breferences\b", r"\bworks cited\b", r"\bfurther reading\b", r"\b(?:a note about|notes? (?:about|on)) sources\b", r"\bsources\b", r"\bconcordance\b", r"\billustrations\b"]
END_OPENS = r"(?i)^(index|bibliography|references|works cited|further reading|(?:a note about|notes? (?:about|on)) sources|sources|concordance|illustrations|acknowledg?ments|notes(?:\s+to)?)\b"
# Lines of a list of references, of a table of contents, and of an attribution.
REFERENCE_LINE = r"(?i)^>|\bhttps?://|\b(journal|press|university|working paper|proceedings|review|vol\.|vol |pp?\.|ed\.|eds\.|trans\.)\b|^\d+\."
CONTENTS_LINE = r"(?i)\b(contents|title page|copyright|dedication|epigraph|maps|illustrations|appendix|index)\b|\d+\s*$"
ATTRIBUTION_LINE = r"^(?:[-—–]|â€”)\s*[A-Z]"
# Headings of a bibliography at the end of a text.
BIBLIOGRAPHY = "## (?:References|Bibliography|Sources|Further Reading|Works Cited)"
#: Blocks looked at for the start of the text, blocks at the end in which a heading ends it, words of a bibliography that is dropped.
START_WITHIN, END_WITHIN, BIBLIOGRAPHY_WORDS = 30, 35, 250
#: Share of a book after which end matter may begin, share of the blocks left that must be end matter, blocks that need not.
END_FROM, SUSTAINED, FEW = 0.8, 0.55, 4

FLAGS = ["contentStart", "authorNote", "epigraph", "listLike", "publisher", "marketing", "references", "contents", "mainText", "frontMatter", "endMatter", "endStart"]


def trimmed(text: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def heading_and_body(block: Column) -> Column:
    """(heading, body) of a block, parted at its first blank line; without one all is heading."""
    text = even_line_ends(block)
    at = F.instr(text, F.lit("\n\n"))
    return F.struct(F.when(at > 0, trimmed(F.substr(text, F.lit(1), at - 1))).otherwise(trimmed(text)).alias("heading"), F.when(at > 0, trimmed(F.substr(text, at + 2))).otherwise("").alias("body"))


def block_flags(blocks: DataFrame, body: str) -> DataFrame:
    """``blocks`` with the twelve boolean columns ``FLAGS`` about the text in ``body``; null is as empty."""
    lines = F.filter(F.transform(F.split(even_line_ends(F.coalesce(F.col(body), F.lit(""))), "\n"), trimmed), lambda x: x != "")
    rows = blocks.withColumns({"_lines": lines, "_low": F.lower(F.coalesce(F.col(body), F.lit(""))), "_words": word_count(F.coalesce(F.col(body), F.lit("")))})
    share = lambda test: F.size(F.filter("_lines", test))
    rows = rows.withColumns({
        "_n": F.size("_lines"), "_first": F.coalesce(F.get("_lines", F.lit(0)), F.lit("")), "_quotes": share(lambda x: x.startswith(">")), "_short": share(lambda x: F.length(x) <= 40), "_middling": share(lambda x: F.length(x) <= 120), "_long": share(lambda x: F.length(x) >= 60),
        "_refs": share(lambda x: x.rlike(REFERENCE_LINE)), "_entries": share(lambda x: x.rlike(CONTENTS_LINE)), "_signed": F.exists("_lines", lambda x: x.rlike(ATTRIBUTION_LINE)),
    })
    low = F.col("_low")
    some = lambda patterns: low.rlike("|".join(patterns))

    def at_least_two(patterns: list[str]) -> Column:
        return sum((low.rlike(p).cast("int") for p in patterns), F.lit(0)) >= 2

    n = F.col("_n")
    rows = rows.withColumns({
        "contentStart": ~F.col("_first").rlike(NUMBER_ENDS) & F.col("_first").rlike(TEXT_BEGINS),
        "authorNote": at_least_two(AUTHOR_NOTE),
        "epigraph": ((n > 0) & (F.col("_quotes") >= 2) & (F.col("_quotes") > 0.4 * n) & (F.col("_words") < 180)) | (n.between(2, 10) & (F.col("_words") < 220) & F.col("_signed") & (F.col("_middling") > 0.7 * n)),
        "listLike": (n > 0) & (F.col("_short") > 0.45 * n),
        "publisher": at_least_two(PUBLISHER),
        "marketing": some(MARKETING),
        "references": (n >= 6) & (F.col("_refs") > 0.45 * n),
        "contents": low.rlike(r"\bcontents\b") & (F.col("_entries") >= 3),
        "endMatter": some(END),
        "endStart": F.regexp_replace("_first", r"^#{1,6}\s*", "").rlike(END_OPENS),
    })
    rows = rows.withColumn("frontMatter", some(FRONT) | F.col("publisher") | F.col("contents") | F.col("marketing") | F.col("authorNote") | F.col("epigraph"))
    main = (n > 0) & (F.col("_words") >= 80) & ~F.col("frontMatter") & ~F.col("contents") & ~F.col("listLike") & (F.col("_long") >= F.greatest(F.lit(2), F.floor(n * 0.3)))
    return rows.withColumn("mainText", main).select(*blocks.columns, *FLAGS)


def without_front(blocks: DataFrame, book: str, index: str) -> DataFrame:
    """Flagged ``blocks`` of each book without the front matter before its text, and with ``at``, the place from 0 of what is left.

    A start of the text or main text within the first blocks, but not the very
    first, cuts all before it; else the leading run of front matter goes.
    """
    order = Window.partitionBy(book).orderBy(index)
    placed = blocks.withColumn("_at", F.row_number().over(order) - 1)
    starts = F.col("contentStart") | F.col("mainText")
    cuts = placed.groupBy(book).agg(F.min(F.when(starts & (F.col("_at") <= START_WITHIN), F.col("_at"))).alias("_start"), F.min(F.when(starts | ~F.col("frontMatter"), F.col("_at"))).alias("_other"), F.count(F.lit(1)).alias("_n"))
    cuts = cuts.select(book, F.when(F.col("_start") > 0, F.col("_start")).otherwise(F.coalesce("_other", "_n")).alias("_from"))
    return placed.join(cuts, book).where("_at >= _from").withColumn("at", F.col("_at") - F.col("_from")).drop("_at", "_from")


def without_end(blocks: DataFrame, book: str, at: str = "at") -> DataFrame:
    """Flagged ``blocks`` of each book, placed from 0 in ``at``, without the end matter after its text."""
    whole = Window.partitionBy(book)
    rest = Window.partitionBy(book).orderBy(F.col(at).desc()).rowsBetween(Window.unboundedPreceding, 0)
    back = F.col("endStart") | F.col("references") | (F.col("endMatter") & F.col("listLike")) | F.col("marketing")
    rows = blocks.withColumns({"_n": F.count(F.lit(1)).over(whole), "_back": F.sum(back.cast("int")).over(rest)})
    left = F.col("_n") - F.col(at)
    sustained = (left < FEW) | (F.col("_back") >= SUSTAINED * left)
    ends = (F.col("endStart") & ((left <= END_WITHIN) | sustained)) | F.col("marketing") | (F.col("endMatter") & (F.col("listLike") | F.col("references")) & sustained) | (F.col("references") & sustained)
    rows = rows.withColumn("_cut", F.min(F.when(ends & (F.col(at) >= F.floor(F.col("_n") * END_FROM)), F.col(at))).over(whole))
    return rows.where(F.col("_cut").isNull() | (F.col(at) < F.col("_cut"))).drop("_n", "_back", "_cut")


def without_bibliography(text: Column) -> Column:
    """Without the last bibliography of a text where it has few words."""
    before = F.regexp_extract(text, rf"(?s)^(.*){BIBLIOGRAPHY}", 1)
    found = text.rlike(BIBLIOGRAPHY)
    return F.when(found & (word_count(F.substr(text, F.length(before) + 1)) <= BIBLIOGRAPHY_WORDS), trimmed(before)).otherwise(text)


# A contents page run into the text, what stands before it, and headings that end a text, alone or after a page mark.
_CONTENTS_RUN = re.compile(r"\bINTRODUCTION\b(?:(?!\bPage\s+(?:[ivxlcdm]+|\d+)\b)[\s\S]){0,300}\bPage\s+(?:[ivxlcdm]+|\d+)\b", re.A)
_BEFORE_TEXT = re.compile(r"\b(?:contents|copyright|all rights reserved|isbn|acknowledg?ments|title page|series editor)\b", re.A | re.I)
_PAGE_END = re.compile(r"\bPage\s+\d+\s+(?:BIBLIOGRAPHY|REFERENCES|WORKS CITED|FURTHER READING|INDEX)\b", re.A)
_HEADING_END = re.compile(r"(?:^|\n)(?:#{1,6}\s*)?(?:bibliography|references|works cited|further reading)\s*(?:\n|\Z)", re.I)
_TITLE = re.compile(r"# .+\n\n")
#: Share of a text in which front matter may end, share after which end matter may begin, characters before the text at least.
FRONT_PART, BACK_PART, FRONT_LEAST = 0.2, 0.65, 100


def inline_front_cut(text: str) -> str:
    """Front matter run into the text cut off, the title kept."""
    lead = text[: int(len(text) * FRONT_PART)]
    last = None
    for last in _CONTENTS_RUN.finditer(lead):
        pass
    if last is None or last.start() < FRONT_LEAST or not _BEFORE_TEXT.search(lead, 0, last.start()):
        return text
    title = _TITLE.match(text)
    return (title[0] if title else "") + text[last.start() :].strip(BLANKS)


def inline_end_cut(text: str) -> str:
    """End matter run into the text cut off: at the first page mark with a heading, or the last heading if that is earlier."""
    least = int(len(text) * BACK_PART)
    marks = [m.start() for m in _PAGE_END.finditer(text) if m.start() >= least][:1]
    headings = [m.start() for m in _HEADING_END.finditer(text) if m.start() >= least][-1:]
    cut = min([*marks, *headings], default=None)
    return text if cut is None else text[:cut].strip(BLANKS)


@F.pandas_udf(StringType())
def _inline_cuts(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None else inline_end_cut(inline_front_cut(t)))


def finished(text: Column) -> Column:
    """A converted text made ready: cleaned, front and end matter run into it and a short bibliography cut, spacing even."""
    return even_spacing(without_bibliography(_inline_cuts(cleaned(text))))
