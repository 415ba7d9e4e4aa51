"""Cleaning of captured lines: annotation blocks, Markdown, tables and page furniture."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import flat, fold, fold_ordinal
from .running import last_event


# Links that run scripts, links, images, leading marks, a separator's cell, and format marks.
SCRIPT_LINK, LINK, IMAGE = r"(?i)\[[^\]]*\]\(javascript:[^)]*\)+", r"\[([^\]]*)\]\([^)]*\)", r"!\[[^\]]*\]\([^)]*\)"
LEADING, SEPARATOR, MARKS = r"(?U)^\s*[-#*>]+\s*", r"^:?-{2,}:?$", "*_<>~`"


def _any(words: list[str]) -> str:
    return "|".join(re.escape(w).replace("\\ ", " ") for w in words)


def annotation_event(line: Column) -> Column:
    """1 where an annotation block may start, 0 at a structural line, else null."""
    plain = fold(line)
    return F.when(plain.rlike(fixed.STRUCTURAL), 0).when(plain.rlike(fixed.ANNOTATION), 1)


def outside_annotations(rows: DataFrame, key: str) -> DataFrame:
    """Lines (key, line_no, line) that aren't in an annotation block: the last marker or structural line up to them isn't a marker."""
    return last_event(rows, key, annotation_event(F.col("line")), "__state").where("coalesce(__state, 0) = 0").drop("__state")


def unlink(line: Column) -> Column:
    """Script links go, other links become their text; images that are left go; leading marks go."""
    x = F.regexp_replace(line, SCRIPT_LINK, " ")
    x = F.regexp_replace(F.regexp_replace(x, LINK, "$1"), IMAGE, " ")
    return F.regexp_replace(x, LEADING, "")


def linear_table(line: Column) -> Column:
    """A table row as its cells with single spaces; a separator row becomes empty."""
    inner = F.regexp_replace(F.regexp_replace(line, r"(?U)^\s+|\s+$", ""), r"^\|+|\|+$", "")
    cells = F.transform(F.split(inner, r"\|"), lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    separator = F.forall(cells, lambda c: c.rlike(SEPARATOR))
    return F.when(F.contains(line, F.lit("|")), F.when(separator, "").otherwise(F.array_join(F.filter(cells, lambda c: c != ""), " "))).otherwise(line)


def without_marks(line: Column) -> Column:
    """Format marks to spaces, backslashes removed, white space collapsed."""
    return flat(F.translate(F.replace(line, F.lit("\\"), F.lit("")), MARKS, " " * len(MARKS)))


def junk(folded: Column) -> Column:
    """Why a folded line is page furniture; null if it isn't."""
    short = (F.length(folded) < fixed.SHORT_LINE) & folded.rlike(f"^({_any(fixed.JUNK_SHORT)})($|[ :])")
    return (
        F.when((folded == "") | (folded == "---"), "empty")
        .when(folded.rlike(_any(fixed.JUNK_PHRASES)), "phrase")
        .when(folded.rlike(fixed.JUNK_LINE), "line")
        .when(short, "navigation")
        .when(folded.rlike(r"(?U)^[\d\s]+$"), "page_number")
    )


def clean_line(line: Column) -> Column:
    return without_marks(linear_table(unlink(line)))


def clean(rows: DataFrame, key: str) -> DataFrame:
    """(key, line_no, line): the cleaned lines that are left, in the order annotation blocks, Markdown, furniture."""
    cleaned = outside_annotations(rows, key).select(key, "line_no", clean_line(F.col("line")).alias("line"))
    return cleaned.where(junk(fold_ordinal("line")).isNull())
