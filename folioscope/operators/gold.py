"""Gold cases: citations, counts and absences checked against the corpus, and answers scored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import flat, fold, is_blank
from ..sources.corpus import is_pattern, lines

#: Fixed values of the case format.
CITATION = r"^([^\n]+?\.md)#L(\d+)(?:-L(\d+))?$"
KINDS, SCOPES = ("cita", "conteo", "ausente"), ("archivo", "corpus", "nombres")
PROFILE = {
    "articulos_numerados": r"^\*\*articulo\s+\d+\.",
    "titulos": "^### titulo",
    "capitulos": "^#### capitulo",
    "menciones_paragrafo": "paragrafo",
    "articulos_nuevo": r"^\*\*articulo nuevo",
    "anotaciones_derogada": "derogad",
    "anotaciones_suprime": "suprime",
    "disposiciones": r"disposiciones?\s+(adicional|transitoria|derogatoria|final)",
}
#: Patterns that one pass over the lines counts.
PATTERNS_PER_PASS = 200


def parse_citation(x: str) -> list[Column]:
    """Columns file, l1, l2 of a citation; all null if it isn't one."""
    part = lambda i: F.nullif(F.regexp_extract(x, CITATION, i), F.lit(""))
    l1 = part(2).try_cast("bigint")
    return [part(1).alias("file"), l1.alias("l1"), F.coalesce(part(3).try_cast("bigint"), l1).alias("l2")]


#: Spans or patterns that one row takes to a file's lines; a file with more of them is split over several rows.
AT_ONCE = 1_000


def _with_lines(wanted: DataFrame, what: list[str], docs: DataFrame, name: str, text: str, each: Callable[[Column], Column] = lambda x: x) -> DataFrame:
    """(file, n_lines, lines, wanted): the lines, each made by `each`, of the files asked for, beside arrays of about AT_ONCE of the distinct (file, what...) at most.

    A file that isn't there has no row.
    """
    asked = wanted.select("file", *what).distinct()
    parts = asked.groupBy("file").agg(F.ceil(F.count("*") / AT_ONCE).alias("__parts"))
    grouped = asked.join(parts, "file").groupBy("file", F.pmod(F.xxhash64(*what), "__parts").alias("__part")).agg(F.collect_list(F.struct(*what)).alias("wanted"))
    # The lines are made below the join, so what is above it looks them up.
    own = docs.select(F.col(name).alias("file"), F.col(text).alias("text")).join(asked.select("file").distinct(), "file", "left_semi")
    cut = own.select("file", F.transform(F.split("text", "\n"), each).alias("lines"))
    return cut.join(grouped, "file").select("file", F.size("lines").cast("bigint").alias("n_lines"), "lines", "wanted")


def cited(claims: DataFrame, docs: DataFrame, name: str = "filename", text: str = "text") -> DataFrame:
    """Claims (id, cita, verbatim) with what they cite: file, l1, l2, n_lines and the lines' text joined by line feeds.

    A file's text is cut into lines once, and each distinct span is a slice of
    them; what moves is the cited files and the claims.
    """
    parsed = claims.select("id", "cita", "verbatim", *parse_citation("cita"))
    laid = _with_lines(parsed, ["l1", "l2"], docs, name, text)
    there = lambda s: (s["l1"] >= 1) & (s["l1"] <= s["l2"]) & (s["l2"] <= F.col("n_lines"))
    slice_of = lambda s: F.array_join(F.slice("lines", s["l1"].cast("int"), (s["l2"] - s["l1"] + 1).cast("int")), "\n")
    spans = laid.select("file", "n_lines", F.explode(F.transform("wanted", lambda s: F.struct(s["l1"], s["l2"], F.when(there(s), slice_of(s)).alias("span")))).alias("s")).select("file", "n_lines", "s.*")
    same = [F.col("p.file") == F.col("s.file"), F.col("p.l1").eqNullSafe(F.col("s.l1")), F.col("p.l2").eqNullSafe(F.col("s.l2"))]
    return parsed.alias("p").join(spans.alias("s"), same, "left").select("id", "cita", "verbatim", "p.file", "p.l1", "p.l2", "n_lines", "span")


def check_citations(claims: DataFrame, docs: DataFrame, strict: bool = False, name: str = "filename", text: str = "text") -> DataFrame:
    """(id, outcome): 'ok' or why a citation fails. White space is collapsed on both sides unless strict."""
    clean = fold if strict else lambda x: fold(flat(x))
    found = cited(claims, docs, name, text)
    outcome = (
        F.when(F.col("file").isNull(), "malformed")
        .when(F.col("n_lines").isNull(), "no_such_file")
        .when(F.col("span").isNull(), "bad_range")
        .when(F.contains(clean(F.col("span")), clean(F.coalesce("verbatim", F.lit("")))), "ok")
        .otherwise("not_found")
    )
    return found.select("id", outcome.alias("outcome"))


def check_counts(cases: DataFrame, docs: DataFrame, name: str = "filename", text: str = "text") -> DataFrame:
    """(id, n_found, ok): lines of the named file whose folded form has the pattern, against the expected value.

    A pattern that can't be compiled, or a file that isn't there, has no count
    and isn't ok; `count_problems` says which.
    """
    asked = cases.select("id", "valor", F.col("norma").alias("file"), "patron").withColumn("good", is_pattern(F.col("patron")))
    laid = _with_lines(asked.where("good"), ["patron"], docs, name, text, fold)
    # A pattern is compiled once for all lines of a file.
    found = lambda w: F.size(F.filter("lines", lambda x: F.regexp_instr(x, F.concat(F.lit("(?i)"), w["patron"])) > 0)).cast("bigint")
    counted = laid.select("file", F.explode(F.transform("wanted", lambda w: F.struct(w["patron"], found(w).alias("n_found")))).alias("c")).select("file", "c.*")
    rows = asked.join(counted, ["file", "patron"], "left").select("id", "valor", "n_found")
    return rows.select("id", "n_found", F.coalesce(F.col("n_found").cast("string") == F.col("valor"), F.lit(False)).alias("ok"))


def count_problems(cases: DataFrame, docs: DataFrame, name: str = "filename") -> DataFrame:
    """(id, problem) of counts and absences that can't be checked: invalid_pattern or no_such_file."""
    rows = cases.select("id", "norma", "patron").join(docs.select(F.col(name).alias("norma"), F.lit(True).alias("there")).distinct(), "norma", "left")
    problem = F.when(~is_pattern(F.col("patron")), "invalid_pattern").when(F.col("there").isNull(), "no_such_file")
    return rows.select("id", problem.alias("problem")).where("problem IS NOT NULL")


def pattern_counts(rows: DataFrame, text: str, patterns: list[str]) -> DataFrame:
    """(pattern, n): rows whose folded text has each of the stated patterns; one pass for every PATTERNS_PER_PASS."""
    found = None
    folded = rows.select(fold(text).alias("f"))
    for at in range(0, len(patterns), PATTERNS_PER_PASS):
        own = patterns[at : at + PATTERNS_PER_PASS]
        counts = folded.agg(*[F.count_if(F.col("f").rlike(f"(?i){p}")).alias(f"c{i}") for i, p in enumerate(own)])
        part = counts.select(F.explode(F.array(*[F.struct(F.lit(p).alias("pattern"), F.col(f"c{i}").alias("n")) for i, p in enumerate(own)])).alias("x")).select("x.*")
        found = part if found is None else found.unionByName(part)
    return found


def check_absent_in_files(cases: DataFrame, docs: DataFrame, name: str = "filename", text: str = "text") -> DataFrame:
    """(id, n_found, ok): absent in the named file."""
    return check_counts(cases.withColumn("valor", F.lit("0")), docs, name, text)


def check_absent(rows: DataFrame, text: str, patterns: list[str]) -> DataFrame:
    """(pattern, n, ok) over all rows, or a problem for patterns that can't be compiled."""
    spark = rows.sparkSession
    vetted = spark.createDataFrame([(p,) for p in patterns], "pattern string").withColumn("fine", is_pattern(F.col("pattern"))).collect() if patterns else []
    bad = [r.pattern for r in vetted if not r.fine]
    found = spark.createDataFrame([(p, None, "invalid_pattern") for p in bad], "pattern string, n bigint, problem string")
    if good := [r.pattern for r in vetted if r.fine]:
        found = pattern_counts(rows, text, good).withColumn("problem", F.lit(None).cast("string")).unionByName(found)
    return found.select("pattern", "n", (F.col("problem").isNull() & F.coalesce(F.col("n") == 0, F.lit(False))).alias("ok"), "problem")


def pattern_examples(rows: DataFrame, key: str, text: str, pattern: str, most: int = 5) -> DataFrame:
    """(key, line_no) of the first few rows (key, line_no, text) whose folded text has a pattern; what a failed absence shows."""
    return rows.where(fold(text).rlike(f"(?i){pattern}")).select(key, "line_no").orderBy(key, "line_no").limit(most)


def structure_profile(docs: DataFrame, key: str, text: str = "text", patterns: dict[str, str] | None = None) -> DataFrame:
    """Counts of lines with each pattern by document, all in one pass."""
    rows = lines(docs, key, text).select(key, fold("line").alias("f"))
    return rows.groupBy(key).agg(*[F.count_if(F.col("f").rlike(f"(?i){p}")).alias(n) for n, p in (patterns or PROFILE).items()])


def structure_rules(cases: DataFrame) -> DataFrame:
    """(id, code) of every rule that a case breaks.

    cases: (id, categoria, norma, alcance, pregunta, valor, cita, verbatim, patron)
    """
    kind, scope = F.col("categoria"), F.col("alcance")
    known = F.coalesce(kind.isin(*KINDS), F.lit(False))
    rules = {
        "duplicate_id": F.col("__n") > 1,
        "blank_question": is_blank("pregunta"),
        "unknown_kind": ~known,
        "unknown_scope": (kind == "ausente") & ~F.coalesce(scope.isin(*SCOPES), F.lit(False)),
        "malformed_citation": (kind == "cita") & ~F.coalesce(F.col("cita").rlike(CITATION), F.lit(False)),
        "blank_verbatim": (kind == "cita") & is_blank("verbatim"),
        "count_not_a_number": (kind == "conteo") & ~F.coalesce(F.col("valor").rlike(r"^\d+$"), F.lit(False)),
        "blank_pattern": kind.isin("conteo", "ausente") & is_blank("patron"),
        "no_file": ((kind == "conteo") | (kind == "ausente") & (scope == "archivo")) & is_blank("norma"),
        "citation_of_other_file": (kind == "cita") & F.col("norma").isNotNull() & (F.regexp_extract("cita", CITATION, 1) != F.col("norma")),
    }
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for code, c in rules.items()]))
    return cases.withColumn("__n", F.count("*").over(W.partitionBy("id"))).select("id", F.explode(broken).alias("code"))


def answer_rules(answers: DataFrame, cases: DataFrame) -> DataFrame:
    """(id, code): what is wrong with a set of answers."""
    # One row an id on either side, so that many of one id don't meet each other.
    unknown = ~F.coalesce(F.col("tipo_respuesta").isin(*KINDS), F.lit(False))
    a = answers.groupBy("id").agg(F.count("*").alias("n"), F.bool_or(unknown).alias("unknown"))
    joined = cases.select("id", F.lit(True).alias("asked")).distinct().join(a, "id", "full_outer")
    rules = {
        "no_answer": F.col("asked") & F.col("n").isNull(),
        "not_asked": F.col("asked").isNull(),
        "answered_twice": F.col("n") > 1,
        "unknown_kind": F.col("unknown"),
    }
    return joined.select("id", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules.items()]))).alias("code"))


def score(cases: DataFrame, answers: DataFrame, files: DataFrame) -> DataFrame:
    """(id, outcome) of every case: correct, wrong, citada-y-resuelta, cita-invalida or sin-respuesta.

    answers: (id, tipo_respuesta, valor, cita); files: (filename, n_lines).
    """
    a = answers.select("id", "tipo_respuesta", F.col("valor").alias("given"), F.col("cita").alias("cited"), *parse_citation("cita"))
    rows = cases.select("id", "categoria", "norma", "valor").join(a, "id", "left").join(files.withColumnRenamed("filename", "file"), "file", "left")
    resolves = F.coalesce((F.col("file") == F.col("norma")) & (F.col("l1") >= 1) & (F.col("l1") <= F.col("l2")) & (F.col("l2") <= F.col("n_lines")), F.lit(False))
    outcome = (
        F.when(F.col("tipo_respuesta").isNull(), "sin-respuesta")
        .when(F.col("categoria") == "ausente", F.when((F.col("tipo_respuesta") == "ausente") & is_blank("cited"), "correct").otherwise("wrong"))
        .when(F.col("categoria") == "conteo", F.when(F.col("given").eqNullSafe(F.col("valor")), "correct").otherwise("wrong"))
        .otherwise(F.when(resolves, "citada-y-resuelta").otherwise("cita-invalida"))
    )
    return rows.select("id", outcome.alias("outcome"))


def totals(scored: DataFrame) -> DataFrame:
    """One row: mechanical (correct without a reader), human (cited, to be read), total."""
    return scored.agg(F.count_if(F.col("outcome") == "correct").alias("mechanical"), F.count_if(F.col("outcome") == "citada-y-resuelta").alias("human"), F.count("*").alias("total"))
