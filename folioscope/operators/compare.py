"""Documents compared with their sources, article by article."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.similarity import BLOCK, first_difference, letters, text_ratio
from ..functions.text import context, flat, fold_ordinal, norm_key
from ..sources.shared import checkpointed
from .running import count_events

# An article's header, also with ordinal signs, and the ratio from which texts are near.
ARTICLE = r"(?U)^\s*(?:ART[ÍI]CULO|Art[íi]culo)\s+(\d+(?:\.\d+)*[A-Za-z]?|nuevo)(?=[\.\s,:;]|$)"
ARTICLE_ORDINAL = r"(?U)^\s*(?:ART[ÍI]CULO|Art[íi]culo)\s+(\d+(?:\.\d+)*(?:[A-Za-z]|[°º])?|nuevo)(?=[\.\s,:;]|$)"
NEAR = 0.98


def segments(rows: DataFrame, doc: str, ordinals: bool = False) -> DataFrame:
    """(doc, key, copy_no from 0, text) of the articles of cleaned lines (doc, line_no, line); what comes before the first is left out.

    With `ordinals`, headers numbered like 1° open an article too.
    """
    header = F.regexp_extract("line", ARTICLE_ORDINAL if ordinals else ARTICLE, 1)
    laid = rows.select(doc, "line_no", "line", F.nullif(header, F.lit("")).alias("header"))
    numbered = count_events(laid, doc, F.col("header"), "seg").where("seg > 0")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    found = numbered.groupBy(doc, "seg").agg(norm_key(F.max("header")).alias("key"), flat(F.array_join(ordered, " ")).alias("text"))
    copy = F.row_number().over(W.partitionBy(doc, "key").orderBy("seg")) - 1
    return found.select(doc, "key", copy.cast("bigint").alias("copy_no"), "text")


def offsets(docs: DataFrame, doc: str, text: str = "text") -> DataFrame:
    """(doc, key, start, end): where articles lie in a text, in characters, from one header to the next; what comes before the first is left out."""
    # White space before a header is its line's own, not that of empty lines above.
    opening = "(?m)(?=" + ARTICLE.replace(r"^\s*", r"^[^\S\n]*") + ")"
    cut = docs.select(doc, F.posexplode(F.split(F.col(text), opening)).alias("at", "piece"))
    w = W.partitionBy(doc).orderBy("at")
    end = F.sum(F.length("piece")).over(w).cast("bigint")
    found = cut.select(doc, F.nullif(F.regexp_extract("piece", ARTICLE, 1), F.lit("")).alias("header"), end.alias("end"), F.length("piece").alias("n"))
    return found.where("header IS NOT NULL").select(doc, norm_key("header").alias("key"), (F.col("end") - F.col("n")).cast("bigint").alias("start"), "end")


def missing(a: DataFrame, b: DataFrame, doc: str) -> DataFrame:
    """(doc, key) of articles in a without a counterpart in b."""
    return a.select(doc, "key").distinct().join(b.select(doc, "key").distinct(), [doc, "key"], "left_anti")


def exact(corpus: DataFrame, source: DataFrame, doc: str) -> DataFrame:
    """(doc, key) of articles of which some pair of copies is equal when folded; a hash join, no pairs."""
    own = lambda s: s.select(doc, "key", F.sha2(fold_ordinal("text"), 256).alias("h")).distinct()
    return own(corpus).join(own(source), [doc, "key", "h"]).select(doc, "key").distinct()


#: Pairs of an article's copies that are all compared; with more, those that can't be the best are ruled out first.
FEW_PAIRS = 64
#: Ratios that are tried as the best one of many copies, from the highest on.
STEPS = (0.98, 0.95, 0.9, 0.8, 0.6, 0.4, 0.2, 0.0)
_ROUNDING = 1e-9


def best_pairs(left: DataFrame, right: DataFrame, keys: list[str], few: int = FEW_PAIRS) -> DataFrame:
    """(keys, ratio, i, j, compared): each key's pair of texts of highest ratio, of equals the first, and how many pairs the matcher saw.

    left: (keys, i, a), right: (keys, j, b).  With more than `few` pairs a key is
    searched from high ratios down.  Texts can't be more alike than their lengths
    and, up to one block, their counts of letters allow, so at each step only
    pairs whose bound reaches it go to the matcher; once the best of them reaches
    it too, no other pair can be better.  Lengths are joined by classes as wide
    as the step allows.
    """
    sizes = left.groupBy(*keys).agg(F.count("*").alias("na")).join(right.groupBy(*keys).agg(F.count("*").alias("nb")), keys)
    many = sizes.where(F.col("na") * F.col("nb") > few).select(*keys)
    most = lambda rows: rows.groupBy(*keys).agg(F.min(F.struct((-F.col("ratio")).alias("r"), "i", "j")).alias("x"), F.count("*").alias("compared")).select(*keys, (-F.col("x.r")).alias("ratio"), "x.i", "x.j", "compared")
    direct = left.join(right, keys).join(many, keys, "left_anti").withColumn("ratio", text_ratio("a", "b"))
    if many.isEmpty():
        return most(direct)
    many = checkpointed(many)
    own = lambda s, x: checkpointed(s.join(many, keys, "left_semi").withColumn("n", F.length(x)).withColumn("letters", letters(x)))
    a, b = own(left, "a"), own(right, "b")
    best = None
    for step, above in zip(STEPS, (2.0, *STEPS), strict=False):
        pairs = _within(a.drop("a"), b.drop("b"), many, keys, step, above)
        scored = pairs.join(a.select(*keys, "i", "a"), [*keys, "i"]).join(b.select(*keys, "j", "b"), [*keys, "j"]).select(*keys, "i", "j", text_ratio("a", "b").alias("ratio"))
        found = most(scored).select(*keys, "ratio", "i", "j", "compared")
        if best is not None:
            order = F.min(F.struct((-F.col("ratio")).alias("r"), "i", "j")).alias("x")
            found = found.unionByName(best).groupBy(*keys).agg(order, F.sum("compared").alias("compared")).select(*keys, (-F.col("x.r")).alias("ratio"), "x.i", "x.j", "compared")
        best = checkpointed(found)
        many = checkpointed(many.join(best.where(F.col("ratio") >= step).select(*keys), keys, "left_anti"))
        if many.isEmpty():
            break
    return most(direct).unionByName(best)


def _within(a: DataFrame, b: DataFrame, keys_left: DataFrame, keys: list[str], step: float, above: float) -> DataFrame:
    """(keys, i, j) of pairs of the keys left whose bound is at least `step` and less than `above`."""
    a, b = (s.join(keys_left, keys, "left_semi") for s in (a, b))
    on = list(keys)
    if step:
        # Lengths whose quotient the step allows are in neighbouring classes at most.
        width = math.log((2 - step) / step) + _ROUNDING
        band = F.floor(F.log(F.col("n")) / width)
        a, b = a.where("n > 0").withColumn("band", band), b.where("n > 0").withColumn("band", F.explode(F.array(band - 1, band, band + 1)))
        on.append("band")
    pairs = a.select(*on, "i", F.col("n").alias("m"), F.col("letters").alias("u")).join(b.select(*on, "j", "n", F.col("letters").alias("v")), on)
    both = F.greatest(F.col("m") + F.col("n"), F.lit(1))
    shared = F.aggregate(F.zip_with("u", "v", lambda x, y: F.least(x, y)), F.lit(0), lambda acc, x: acc + x)
    bound = F.when(F.greatest("m", "n") <= BLOCK, shared).otherwise(F.least("m", "n")) * 2.0 / both + _ROUNDING
    return pairs.withColumn("bound", bound).where((F.col("bound") >= step) & (F.col("bound") < above)).select(*keys, "i", "j")


def compare(corpus: DataFrame, source: DataFrame, doc: str, near: float = NEAR) -> DataFrame:
    """(doc, key, state, ratio, left, right, compared) of every article of the corpus.

    Only articles without an exact pair reach the matcher, and of copies with
    the same text only the first.  Of several pairs of copies the best counts,
    and the first of equals; `compared` is how many the matcher saw.
    """
    keys = corpus.select(doc, "key").distinct()
    same = exact(corpus, source, doc).withColumn("same", F.lit(True))
    rest = corpus.join(same, [doc, "key"], "left_anti")
    copies = lambda s, i, x: s.select(doc, "key", "copy_no", fold_ordinal("text").alias(x)).groupBy(doc, "key", x).agg(F.min("copy_no").alias(i))
    a, b = checkpointed(copies(rest, "i", "a")), checkpointed(copies(source.join(same, [doc, "key"], "left_anti"), "j", "b"))
    best = best_pairs(a, b, [doc, "key"]).join(a, [doc, "key", "i"]).join(b, [doc, "key", "j"])
    shown = best.select(doc, "key", "ratio", "compared", first_difference("a", "b").alias("__diff"))
    joined = keys.join(same, [doc, "key"], "left").join(shown, [doc, "key"], "left")
    state = F.when(F.col("same"), "exacto").when(F.col("ratio").isNull(), "ausente_en_fuente").when(F.col("ratio") >= near, "casi").otherwise("divergente")
    return joined.select(doc, "key", state.alias("state"), F.round(F.when(F.col("same"), 1.0).otherwise(F.col("ratio")), 4).alias("ratio"), "__diff.left", "__diff.right", F.coalesce("compared", F.lit(0)).cast("bigint").alias("compared"))


def keyword(articles: DataFrame, doc: str, number: str, needle: str, width: int = 200) -> DataFrame:
    """(doc, copy_no, shown): a word, accents ignored, with its surroundings in one numbered article; null where that lacks it."""
    own = articles.where(F.col("key") == norm_key(F.lit(number)))
    return own.select(doc, "copy_no", context("text", needle, width).alias("shown"))


def summary(report: DataFrame, docs: DataFrame, doc: str, strict: bool = True) -> DataFrame:
    """(doc, exact, near, divergent, verdict); what is absent counts as divergent.

    A document without articles has proven nothing: strict says SIN_ARTICULOS.
    """
    counts = report.groupBy(doc).agg(F.count_if(F.col("state") == "exacto").alias("exact"), F.count_if(F.col("state") == "casi").alias("near"), F.count_if(F.col("state").isin("divergente", "ausente_en_fuente")).alias("divergent"))
    rows = docs.select(doc).distinct().join(counts, doc, "left").na.fill(0, ["exact", "near", "divergent"])
    empty = (F.col("exact") + F.col("near") + F.col("divergent") == 0) & F.lit(strict)
    return rows.withColumn("verdict", F.when(empty, "SIN_ARTICULOS").when(F.col("divergent") == 0, "VERIFICADA").otherwise("NO_VERIFICADA"))


def reports(report: DataFrame, corpus: DataFrame, source: DataFrame, doc: str, strict: bool = True) -> DataFrame:
    """(doc, veredicto, informe): each document's comparison as one JSON text.

    It has the results by article, their counts, the verdict, and the source's
    articles that the corpus lacks; one report is bounded by one document.
    """
    shown = F.struct(F.col("key").alias("articulo"), F.col("state").alias("estado"), F.col("ratio").alias("similitud"), F.col("left").alias("corpus"), F.col("right").alias("fuente"))
    results = report.groupBy(doc).agg(F.array_sort(F.collect_list(shown)).alias("resultados"))
    extra = missing(source, corpus, doc).groupBy(doc).agg(F.array_sort(F.collect_list("key")).alias("sin_contraparte"))
    docs = report.select(doc).unionByName(source.select(doc))
    totals = summary(report, docs, doc, strict)
    joined = totals.join(results, doc, "left").join(extra, doc, "left")
    counted = F.struct(F.col("exact").alias("exactos"), F.col("near").alias("casi"), F.col("divergent").alias("divergentes"))
    empty = F.array().cast("array<string>")
    told = F.struct(F.col(doc).cast("string").alias("documento"), F.col("verdict").alias("veredicto"), counted.alias("resumen"), F.coalesce("resultados", F.from_json(F.lit("[]"), "array<struct<articulo:string,estado:string,similitud:double,corpus:string,fuente:string>>")).alias("resultados"), F.coalesce("sin_contraparte", empty).alias("sin_contraparte"))
    return joined.select(doc, F.col("verdict").alias("veredicto"), F.to_json(told, {"ignoreNullFields": "false"}).alias("informe"))


def causes(report: DataFrame) -> DataFrame:
    """A report with a column `cause`: ordered guesses at why articles differ."""
    letters = lambda c: F.regexp_replace(F.col(c), r"(?U)[^\p{L}\p{N}]", "")
    cause = (
        F.when(F.col("state").isin("exacto", "casi"), "none")
        .when(F.col("state") == "ausente_en_fuente", "absent")
        .when(letters("left") == letters("right"), "punctuation")
        .when(F.col("ratio") >= 0.9, "small_edit")
        .when(F.col("ratio") >= 0.5, "partial_text")
        .otherwise("other_text")
    )
    return report.withColumn("cause", cause)
