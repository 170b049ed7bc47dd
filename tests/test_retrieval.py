"""Context is put into texts without touching what they say."""

import random

import pytest

from bookloom.operators import retrieval as R

BOOK = """# A Book

Front words.

## Page 1

Chapter 1 The Start

Text of the first page.

# Nested

## Page 2

chapter 1  the start

More text.
## Section 3

Preface

Words.
"""


def test_sections_are_found_and_reused():
    made, sections = R.with_context(BOOK, "w1", "Ann | B", "A Book")
    assert [(k, t) for k, t, _ in sections] == [("CHAPTER", "Chapter 1 The Start"), ("PREFACE", "Preface")]
    assert made.count('<a id="retrieval-') == 2 and "##### SOURCE HEADING: Nested" in made and "AUTHOR=Ann B" in made
    assert R.payload_hash(made) == R.payload_hash(BOOK)
    assert made.startswith("### SOURCE TITLE: A Book\n") and "#### SOURCE SECTION: 3" in made and sections[0][2] == "retrieval-w1-1-chapter-1-the-start"
    assert R.with_context("## Page 1\n\ntext", "w", None, None)[0].startswith("### FRONT MATTER: Source opening")


def test_titles():
    yes = ["Part IV", "Appendix B: Tables", "Preface", "1.2 The Scope of It", "Chapter 12 On Bridges"]
    no = ["Page 12 of the book", "The market opened. It closed", "Too long " * 20, "iv PREFACE TO", "12", "A line, and more,", "Results in 1990", "Of Free Bridges and Harbours"]
    assert all(R.is_title(x) for x in yes) and not any(R.is_title(x) for x in no)
    assert R.is_title("Of Free Bridges and Harbours", collection=True) and R.is_title("THE HARBOUR OF OLD", collection=True) and not R.is_title("the harbour of old words", collection=True)
    assert not R.is_title("Of Free Bridges and Harbours", "A. Writer", "Free Bridges, Harbours", True) and R.echoes_book("Writer", "Ann Writer", "Some Words")
    assert R.leading_title(["", "3", "Of Free Bridges and Harbours", "text"], None, None, True) == "3 Of Free Bridges and Harbours" and R.kind_of("3 Of Free Bridges") == "CHAPTER"
    assert R.leading_title(["Preface", "goes on"], None, None) == "" and R.leading_title(["1.2 The Scope", "", "more"], None, None) == "1.2 The Scope"
    assert R.tidy_title("CONTENTS xiv") == "CONTENTS"


@pytest.mark.parametrize("seed", range(20))
def test_any_text_keeps_its_payload(seed):
    random.seed(seed)
    bits = ["# H", "## Page 4", "", "text line ", "12", "Chapter 2", "\ttab", "x" * 5000, "###### Section iv", "[CORPUS_CONTEXT: old]", "ž😀"]
    text = "\n".join(random.choice(bits) for _ in range(40))
    made, _ = R.with_context(text, "w", None, None)
    assert R.payload_hash(made) == R.payload_hash(text)


def test_long_texts_repeat_their_context():
    made, _ = R.with_context("line of text\n\n" * 2000, "w", "a", "t")
    assert made.count(R.CONTEXT) >= 5


def test_rules(spark):
    rows = [("a", 1, R.with_context(BOOK, "a", "x", "y")[0]), ("b", 1, "# top\nno context"), ("c", 1, "[CORPUS_CONTEXT: x]\n#### PAGE: 1\n" + "x\n" * 9)]
    got = {tuple(r) for r in R.broken_units(spark.createDataFrame(rows, "workId string, unitIndex bigint, text string")).collect()}
    assert got == {("b", 1, "missing_context"), ("b", 1, "nested_heading"), ("c", 1, "boundary_without_context")}
    units = spark.createDataFrame([("w", 1, 2, None, None, None), ("w", 1, 2, None, None, None), (None, 1, 2, "a", "t", "x")], "workId string, unitIndex bigint, unitCount int, author string, title string, content string")
    assert {r["text"].count("PART=1/2") for r in R.retrieval_units(units).collect()} == {1}
