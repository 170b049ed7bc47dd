"""Cleaning and measuring of texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wrongly decoded signs and what they stand for, in the order they are replaced.
MOJIBAKE = [("â€™", "'"), ("â€˜", "'"), ("â€œ", '"'), ("â€\x9d", '"'), ("â€ť", '"'), ("â€¦", "..."), ("â€”", " - "), ("â€“", " - "), ("â€¢", " - "), ("â„¢", "™"), ("Â©", "©"), ("Â®", "®"), ("Â", ""), ("\xa0", " ")]
# Markup that is removed, and whether it is found in any case.
MARKUP = [r"(?i)<\?xml[^>]*\?>\s*", r"(?i)<!DOCTYPE[^>]*>\s*", r"(?i)<img\b[^>]*>", r"!\[[^\]]*\]\([^)]+\)"]
TAGS = r"(?i)</?(?:div|span|section|article|body|html)[^>]*>"
CONTROLS = r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}]"
# Emphasis marks and escapes that are dropped around their text.
EMPHASIS = [(r"(\*\*|__)([^*\n_][^\n]*?)(\1)", "$2"), (r"(^|[^*])\*([^*\n]+?)\*(?!\*)", "$1$2"), (r"(^|[^_])_([^_\n]+?)_(?!_)", "$1$2"), (r"\\([\[\]().])", "$1")]
# Traces of wrong decoding in finished texts.
SIGNALS = r"ï¿½|â€|Ã.|\x{FFFD}"
# How lines begin that were put into a text: headings, anchors, context lines.
NO_PAYLOAD = r"^(?:#{1,6}\s+|<a id=\"retrieval-[^\"]+\"></a>$|\[CORPUS_CONTEXT:)"
# Words and traces of wrong decoding in a sample, and what parts its head from its tail.
SAMPLE_WORDS, SAMPLE_MARKS, SAMPLE_END = r"[\p{L}\p{N}]+", "Ã.|Â.|â€|ðŸ", "\n\n[END SAMPLE]\n\n"
# What is taken out of an extracted sample, and its length.
SAMPLE_DROPS, SAMPLE_CHARS = [r"(?i)<script[\s\S]*?</script>", r"(?i)<style[\s\S]*?</style>", r"<[^>]+>", r"[_*#>`\[\]]"], 9000
# Noise in the first and the last characters of a text.
FRONT_NOISE, END_NOISE = r"(?i)PRAISE FOR|promotional download", r"(?i)what(?:'|’)s next on your reading list|also of interest"
#: Limits of a usable text.
LEAST_BYTES, LEAST_WORDS = 2000, 300


def even_line_ends(text: Column) -> Column:
    """CRLF and CR as LF."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def mended_signs(text: Column) -> Column:
    """Known wrongly decoded signs replaced."""
    for wrong, right in MOJIBAKE:
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def without_markup(text: Column) -> Column:
    """XML declarations, doctypes, images, comments and container tags removed, links unwrapped."""
    for pattern in MARKUP:
        text = F.regexp_replace(text, pattern, "")
    text = F.regexp_replace(text, r"\[([^\]]+)\]\(([^)]+)\)", "$1")
    return F.regexp_replace(F.regexp_replace(text, r"<!--[\s\S]*?-->", ""), TAGS, "")


def without_emphasis(text: Column) -> Column:
    """Bold and italic marks and escapes removed."""
    for pattern, kept in EMPHASIS:
        text = F.regexp_replace(text, pattern, kept)
    return text


def even_spacing(text: Column) -> Column:
    """No spaces before line ends and punctuation, no runs of spaces or of blank lines."""
    for pattern, put in ((r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"), (r"[ \t]{2,}", " "), (r" +([,.;:!?])", "$1"), (r"^\s+|\s+$", "")):
        text = F.regexp_replace(text, pattern, put)
    return text


def cleaned(text: Column) -> Column:
    """All cleaning steps in their order."""
    text = without_markup(mended_signs(even_line_ends(text)))
    return even_spacing(without_emphasis(F.regexp_replace(text, CONTROLS, "")))


def normal_markdown(text: Column) -> Column:
    """Line ends, signs and control characters put right, one line end at the end, nothing for nothing."""
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(mended_signs(even_line_ends(text)), CONTROLS, ""), r"^\n+", ""), r"\s+$", "")
    return F.when(out == "", "").otherwise(F.concat(out, F.lit("\n")))


def word_count(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_count(text, F.lit(r"\S+"))


def quality_reasons(size: Column, words: Column) -> Column:
    """What keeps a text from use: ``too_small``, ``too_few_words``."""
    return F.array_compact(F.array(F.when(size < LEAST_BYTES, "too_small"), F.when(words < LEAST_WORDS, "too_few_words")))


def corrupted_line(line: Column) -> Column:
    """Whether a line is destroyed: signals are many, dense, or nearly all there is.  Headings never are."""
    body = F.trim(line)
    signals = F.regexp_count(body, F.lit(SIGNALS))
    visible = F.greatest(F.length(F.regexp_replace(body, r"\s", "")), F.lit(1))
    letters, wordy = F.regexp_count(body, F.lit(r"\p{L}")), F.regexp_count(body, F.lit(r"[\p{L}\p{N}]{2,}"))
    dense = signals / visible
    destroyed = ((signals >= 8) & (dense >= 0.08)) | ((signals >= 4) & (dense >= 0.14)) | ((signals >= 6) & (letters / visible < 0.18) & (wordy < 5))
    return (body != "") & ~body.rlike(r"^#{1,6}\s") & destroyed


def payload(text: Column) -> Column:
    """The lines that carry text: no blanks, headings, anchors and context lines."""
    return F.array_join(F.filter(F.split(text, r"\r?\n"), lambda x: x.rlike(r"\S") & ~x.rlike(NO_PAYLOAD)), "\n")


def sample_status(lost: Column, marks: Column, words: Column, failed: Column) -> Column:
    """``extraction_failed``, ``unreadable``, ``too_short`` or ``ok`` for the counts of a sample."""
    return F.when(failed, "extraction_failed").when((lost > 20) | (marks > 60), "unreadable").when(words < 30, "too_short").otherwise("ok")


def extracted_sample(text: Column) -> Column:
    """A sample without scripts, styles, markup and Markdown signs, in single spaces, cut to a length."""
    text = F.coalesce(text, F.lit(""))
    for pattern in SAMPLE_DROPS:
        text = F.regexp_replace(text, pattern, " ")
    return F.substring(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), 1, SAMPLE_CHARS)


def duration(milliseconds: Column) -> Column:
    """A time as hours, minutes and seconds; ``unknown`` for null, negative and no number."""
    s = F.round(milliseconds / 1000).cast("bigint")
    parts = [F.when(s >= 3600, F.concat(F.floor(s / 3600).cast("string"), F.lit("h"))), F.when(s >= 60, F.concat(F.floor(s % 3600 / 60).cast("string"), F.lit("m"))), F.concat((s % 60).cast("string"), F.lit("s"))]
    bad = milliseconds.isNull() | F.isnan(milliseconds.cast("double")) | (milliseconds < 0)
    return F.when(bad, "unknown").otherwise(F.concat_ws(" ", *parts))
