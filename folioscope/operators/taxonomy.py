"""A taxonomy of elements: its rules, statistics and derived documents.

Elements are (id, categoria, nombre, descripcion, fase_lectura, estado, origen,
tipo_campo, requiere_ref_articulo, dependencias, glosario_terminos).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import is_blank, pad

FIELDS = ["id", "categoria", "nombre", "descripcion", "fase_lectura", "estado", "origen", "tipo_campo", "requiere_ref_articulo", "dependencias", "glosario_terminos"]
# The form of an element's id, alone and in running text.
ELEMENT = r"^[A-Z]\.\d+[a-z]?$"
REFERENCE = r"[A-Z]\.\d+[a-z]?"


def rules(elements: DataFrame) -> DataFrame:
    """(code, id, detail) of every broken rule; all single-row rules in one pass."""
    rows = elements.withColumn("__n", F.count("*").over(W.partitionBy("id")))
    outside = lambda c, known: F.col(c).isNotNull() & ~F.col(c).isin(known)
    checks = [(f"E002:{f}", F.col(f).isNull()) for f in FIELDS]
    checks += [
        ("E001:", (F.col("__n") > 1) & F.col("id").isNotNull()),
        ("E004:", outside("categoria", fixed.CATEGORIES)),
        ("E005:", ~F.col("fase_lectura").between(0, fixed.PHASES - 1)),
        ("E006:", outside("estado", fixed.STATES)),
        ("E007:", outside("origen", fixed.ORIGINS)),
        ("E008:", outside("tipo_campo", fixed.FIELD_TYPES)),
        ("E009:", ~F.col("id").rlike(ELEMENT)),
        ("E010:", F.col("nombre").isNotNull() & is_blank("nombre")),
        ("W001:", F.col("descripcion").isNotNull() & is_blank("descripcion")),
    ]
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in checks]))
    single = rows.select("id", F.explode(broken).alias("k")).select(F.split_part("k", F.lit(":"), F.lit(1)).alias("code"), "id", F.split_part("k", F.lit(":"), F.lit(2)).alias("detail"))
    deps = broken_dependencies(elements).select(F.lit("E003").alias("code"), "id", F.col("target").alias("detail"))
    phases = parent_phases(elements).where("NOT same").select(F.lit("E013").alias("code"), "id", F.col("parent").alias("detail"))
    return single.unionByName(deps).unionByName(phases).distinct()


def meta_rules(meta: DataFrame, derived: tuple[str, ...] = ("total_elementos", "categorias", "fases_lectura")) -> DataFrame:
    """(code, detail) over a (key, value) description: version and date are needed, derived figures aren't stored."""
    stored = meta.where(F.col("key").isin(*derived)).select(F.lit("W002").alias("code"), F.col("key").alias("detail"))
    needed = meta.sparkSession.createDataFrame([("E011", "version"), ("E012", "fecha")], "code string, detail string")
    have = meta.where(~is_blank("value")).select(F.col("key").alias("detail"))
    return needed.join(have, "detail", "left_anti").select("code", "detail").unionByName(stored)


def broken_dependencies(elements: DataFrame) -> DataFrame:
    """(id, target) of dependencies on elements that don't exist."""
    edges = elements.select("id", F.explode("dependencias").alias("target"))
    return edges.join(elements.select(F.col("id").alias("target")).distinct(), "target", "left_anti").select("id", "target").distinct()


def parent_phases(elements: DataFrame) -> DataFrame:
    """(id, parent, same): elements with a letter against the phase of the element they belong to."""
    child = elements.select("id", "fase_lectura", F.regexp_extract("id", r"^([A-Z]\.\d+)[a-z]$", 1).alias("parent")).where("parent <> ''")
    parent = elements.groupBy(F.col("id").alias("parent")).agg(F.min("fase_lectura").alias("p"))
    return child.join(parent, "parent").select("id", "parent", F.col("fase_lectura").eqNullSafe(F.col("p")).alias("same")).distinct()


def stats(elements: DataFrame) -> DataFrame:
    """(grouping, value, n): elements by category and by phase, and the totals."""
    by = lambda c, g: elements.groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit(g).alias("grouping"), "value", "n")
    total = elements.agg(F.count("*").alias("elementos"), F.countDistinct("categoria").alias("categorias"), F.countDistinct("fase_lectura").alias("fases"))
    totals = total.select(F.explode(F.array(*[F.struct(F.lit("total").alias("grouping"), F.lit(k).alias("value"), F.col(k).alias("n")) for k in ("elementos", "categorias", "fases")])).alias("x")).select("x.*")
    return by("categoria", "categoria").unionByName(by("fase_lectura", "fase")).unionByName(totals)


def matrix(elements: DataFrame, by_element: bool = False) -> DataFrame:
    """(categoria, A..M): dependencies from each category on each, by the target's category.

    by_element takes the letter of the target's id for its category.
    """
    edges = elements.select("categoria", F.explode("dependencias").alias("target"))
    if by_element:
        found = edges.withColumn("to", F.substring("target", 1, 1))
    else:
        found = edges.join(elements.groupBy(F.col("id").alias("target")).agg(F.min("categoria").alias("to")), "target")
    return found.groupBy("categoria").pivot("to", fixed.CATEGORIES).count().na.fill(0)


def sensitivity(elements: DataFrame) -> DataFrame:
    """(categoria, n_out, score, stars): outgoing dependencies and a score from 1 to 5."""
    out = elements.groupBy("categoria").agg(F.sum(F.coalesce(F.size("dependencias"), F.lit(0))).alias("n_out"))
    score = F.least(F.lit(5), F.greatest(F.lit(1), F.floor(F.col("n_out") / 3) + 1)).cast("int")
    return out.withColumn("score", score.cast("bigint")).withColumn("stars", F.concat(F.repeat(F.lit("★"), score), F.repeat(F.lit("☆"), 5 - score)))


def glossary(elements: DataFrame) -> DataFrame:
    """(term, refs): elements by term, with the implicit terms as far as their elements exist."""
    spark = elements.sparkSession
    own = elements.select(F.explode("glosario_terminos").alias("term"), F.col("id").alias("ref"))
    implicit = spark.createDataFrame([(t, r) for t, refs in fixed.IMPLICIT_TERMS.items() for r in refs], "term string, ref string")
    known = implicit.join(elements.select(F.col("id").alias("ref")).distinct(), "ref", "left_semi").select("term", "ref")
    return own.unionByName(known).groupBy("term").agg(F.array_join(F.array_sort(F.collect_set("ref")), ", ").alias("refs"))


def propagation(elements: DataFrame) -> DataFrame:
    """(origin, targets): the propagation rules as far as their elements exist."""
    spark = elements.sparkSession
    ids = elements.select("id").distinct()
    rows = spark.createDataFrame([(o, i, d) for o, ds in fixed.PROPAGATION.items() for i, d in enumerate(ds)], "origin string, at int, target string")
    held = rows.join(ids.withColumnRenamed("id", "origin"), "origin", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")
    return held.groupBy("origin").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "target"))), lambda x: x["target"]), ", ").alias("targets"))


def _ordered(rows: DataFrame, by: list[str], order: list[str], line: str, out: str) -> DataFrame:
    """Lines of a group joined in order."""
    return rows.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, line))), lambda x: x[line]), "\n").alias(out))


def category_pages(elements: DataFrame) -> DataFrame:
    """(categoria, n, main_phase, phases, page, page_sha256): one listing for each category."""
    line = F.concat(pad("id", 5), F.lit(" "), pad(F.coalesce("nombre", F.lit("")), 37), F.lit(" "), F.coalesce("estado", F.lit("")))
    pages = _ordered(elements.withColumn("line", line), ["categoria"], ["id"], "line", "page")
    facts = elements.groupBy("categoria").agg(F.count("*").alias("n"), F.min_by("fase_lectura", F.struct("id", "fase_lectura")).cast("bigint").alias("main_phase"), F.array_join(F.array_sort(F.collect_set("fase_lectura")), ",").alias("phases"))
    return facts.join(pages, "categoria").withColumn("page_sha256", F.sha2("page", 256))


def record_schema(elements: DataFrame) -> DataFrame:
    """(fase, fields, schema): a JSON Schema for the fields of each phase; an article reference is needed where an element asks for it."""
    one = F.concat(F.lit('"'), F.col("id"), F.lit('": {"type": "object", "properties": {"completado": {"type": "boolean"}, "na": {"type": "boolean"}, "valor": {"type": ["string", "null"]}, "ref_articulo": {"type": "string"'), F.when(F.col("requiere_ref_articulo"), ', "minLength": 1').otherwise(""), F.lit("}}}"))
    rows = elements.where("id IS NOT NULL").groupBy(F.col("fase_lectura").cast("bigint").alias("fase"), "id").agg(F.min(one).alias("line"))
    found = rows.groupBy("fase").agg(F.count("*").alias("fields"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "line"))), lambda x: x["line"]), ", ").alias("body"))
    return found.select("fase", "fields", F.concat(F.lit('{"type": "object", "properties": {'), "body", F.lit("}}")).alias("schema"))


#: SQL types of the fields' kinds.
# Column types by field type.
SQL_TYPES = {"checkbox": "BOOLEAN", "texto": "TEXT", "numero": "NUMERIC", "fecha": "DATE", "lista": "TEXT", "formula": "TEXT", "tabla": "TEXT"}


def ddl(elements: DataFrame) -> DataFrame:
    """(table_name, n_columns, statement): a wide table for each category."""
    kind = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in SQL_TYPES.items() for x in kv]), F.col("tipo_campo")), F.lit("TEXT"))
    columns = elements.where("id IS NOT NULL AND categoria IS NOT NULL").groupBy("categoria", "id").agg(F.min(F.concat(F.lower(F.replace(F.col("id"), F.lit("."), F.lit("_"))), F.lit(" "), kind)).alias("line"))
    found = columns.groupBy("categoria").agg(F.count("*").alias("n_columns"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "line"))), lambda x: x["line"]), ", ").alias("body"))
    name = F.concat(F.lit("valores_cat_"), F.lower("categoria"))
    return found.select(name.alias("table_name"), "n_columns", F.concat(F.lit("CREATE TABLE "), name, F.lit(" (id_ficha TEXT PRIMARY KEY, "), "body", F.lit(");")).alias("statement"))


# The tables, indexes and names that every model has.
NORMAS = [
    "CREATE TABLE IF NOT EXISTS normas (", "    id SERIAL PRIMARY KEY,", "    urn VARCHAR(255) UNIQUE,", "    tipo VARCHAR(50),", "    numero VARCHAR(50),", "    titulo TEXT,", "    autoridad_emisora VARCHAR(255),",
    "    fecha_expedicion DATE,", "    fecha_publicacion DATE,", "    fecha_vigencia DATE,", "    estado VARCHAR(50),", "    texto_original TEXT,", "    texto_consolidado TEXT,", "    created_at TIMESTAMP DEFAULT NOW()", ");",
]
FICHAS = [
    "CREATE TABLE IF NOT EXISTS fichas (", "    id SERIAL PRIMARY KEY,", "    id_ficha VARCHAR(100) UNIQUE NOT NULL,", "    norma_id INTEGER REFERENCES normas(id),", "    analista VARCHAR(255),", "    organizacion VARCHAR(255),",
    "    proposito TEXT,", "    estado VARCHAR(50),", "    fecha_analisis TIMESTAMP,", "    puntuacion_calidad INTEGER CHECK (puntuacion_calidad BETWEEN 0 AND 50),", "    created_at TIMESTAMP DEFAULT NOW()", ");",
]
CATEGORIAS = ["CREATE TABLE IF NOT EXISTS categorias (", "    codigo CHAR(1) PRIMARY KEY,", "    nombre VARCHAR(100) NOT NULL,", "    total_elementos INTEGER", ");"]
INDEXES = [("normas", "tipo", "tipo"), ("normas", "autoridad", "autoridad_emisora"), ("normas", "fecha", "fecha_vigencia"), ("fichas", "norma", "norma_id"), ("fichas", "estado", "estado")]
CATEGORY_NAMES = {
    "A": "METADATOS DE IDENTIFICACION", "B": "ESTRUCTURA FORMAL INTERNA", "C": "ESTADOS DE VIGENCIA", "D": "RELACIONES NORMATIVAS", "E": "CONTROL DE VERSIONES", "F": "ANALISIS OPERATIVO", "G": "METADATOS DEL ANALISIS",
    "H": "ELEMENTOS ESPECIALES", "I": "JERARQUIA Y VALIDEZ FORMAL", "J": "INTERPRETACION Y APLICACION", "K": "EFICACIA Y APLICABILIDAD", "L": "ANALISIS ECONOMICO / AIR", "M": "MECANISMOS DE GOBERNANZA Y SEGUIMIENTO",
}


def relational_model(elements: DataFrame) -> DataFrame:
    """(part, name, statement): the whole SQL model, in the order of (part, name); `model_lines` has its comments too.

    Base tables, a wide table of five columns an element for each category,
    indexes, the table of categories and its upserts.
    """
    spark = elements.sparkSession
    fixed_rows = [(0, "normas", "\n".join(NORMAS)), (1, "fichas", "\n".join(FICHAS))]
    fixed_rows += [(3, f"{i}", f"CREATE INDEX idx_{t}_{n} ON {t}({c});") for i, (t, n, c) in enumerate(INDEXES)] + [(4, "categorias", "\n".join(CATEGORIAS))]
    base = spark.createDataFrame(fixed_rows, "part int, name string, statement string")
    safe = F.replace(F.col("id"), F.lit("."), F.lit("_"))
    parts = [("completado", "BOOLEAN DEFAULT FALSE"), ("na", "BOOLEAN DEFAULT FALSE"), ("valor", "TEXT"), ("ref_articulo", "VARCHAR(100)"), ("notas", "TEXT")]
    columns = F.concat(*[x for suffix, kind in parts for x in (F.lit("    "), safe, F.lit(f"_{suffix} {kind},\n"))])
    known = elements.where("id IS NOT NULL AND categoria IS NOT NULL")
    own = known.select("categoria", F.coalesce(F.regexp_extract("id", r"\.(\d+)", 1).try_cast("bigint"), F.lit(0)).alias("no"), "id", columns.alias("line")).distinct()
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "id", "line"))), lambda x: x["line"]), "")
    head = F.concat(F.lit("CREATE TABLE IF NOT EXISTS valores_cat_"), "categoria", F.lit(" (\n    id SERIAL PRIMARY KEY,\n    ficha_id INTEGER REFERENCES fichas(id) ON DELETE CASCADE,\n"))
    wide = own.groupBy("categoria").agg(body.alias("body")).select(F.lit(2).alias("part"), F.col("categoria").alias("name"), F.concat(head, "body", F.lit("    UNIQUE(ficha_id)\n);")).alias("statement"))
    names = F.create_map(*[F.lit(x) for kv in CATEGORY_NAMES.items() for x in kv])
    upserts = known.groupBy("categoria").agg(F.count("*").alias("n")).select(F.lit(5).alias("part"), F.col("categoria").alias("name"), "categoria", "n")
    upserts = upserts.select("part", "name", F.concat(F.lit("INSERT INTO categorias (codigo, nombre, total_elementos) VALUES ('"), "categoria", F.lit("', '"), F.coalesce(F.try_element_at(names, F.col("categoria")), F.col("categoria")), F.lit("', "), F.col("n").cast("string"), F.lit(") ON CONFLICT (codigo) DO UPDATE SET total_elementos = EXCLUDED.total_elementos;")).alias("statement"))
    return base.unionByName(wide).unionByName(upserts)


# Comments of the model before its parts.
MODEL_TITLE, MODEL_RULER = "-- MODELO RELACIONAL", "-- " + "=" * 64
MODEL_HEADS = {0: "-- TABLAS PRINCIPALES", 3: "-- INDICES", 4: "-- DATOS DE CATEGORIAS (maestra)"}


def model_lines(elements: DataFrame, version: str, source_date: str, fingerprint: str, product: str, source: str) -> DataFrame:
    """(part, name, at, line): the model's file line by line, in the order of part, name and at; fingerprint is that of the source.

    The title and the heads of parts have an empty name.  An empty line follows
    each statement, but neither indexes nor upserts among themselves.
    """
    spark = elements.sparkSession
    stated = relational_model(elements).select("part", "name", F.posexplode(F.split("statement", "\n")).alias("at", "line"))
    after = relational_model(elements).where("part IN (0, 1, 2, 4)").select("part", "name", F.lit(1_000_000).alias("at"), F.lit("").alias("line"))
    ends = [(3, "~", 0, ""), (5, "~", 0, "")]
    head = [f"{MODEL_TITLE} — {product}", f"-- Version: {version}", f"-- Hash fuente: {fingerprint}", f"-- Generado: {source_date}", f"-- Fuente: {source}", ""]
    fixed_rows = [(-1, "", i, x) for i, x in enumerate(head)] + [(part, "", i, x) for part, title in MODEL_HEADS.items() for i, x in enumerate((MODEL_RULER, title, MODEL_RULER, ""))]
    frame = spark.createDataFrame(fixed_rows + ends, "part int, name string, at int, line string")
    return frame.unionByName(stated).unionByName(after).withColumn("at", F.col("at").cast("bigint"))


def reading_form(elements: DataFrame) -> DataFrame:
    """(fase, categoria, section): the elements to read in each phase, by category."""
    line = F.concat(F.lit("- [ ] "), "id", F.lit(" "), F.coalesce("nombre", F.lit("")), F.when(F.col("requiere_ref_articulo"), " (art.)").otherwise(""))
    return _ordered(elements.withColumn("line", line).withColumn("fase", F.col("fase_lectura").cast("bigint")), ["fase", "categoria"], ["id"], "line", "section")


def broken_references(texts: DataFrame, elements: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, ref) of references in running text to elements that don't exist."""
    refs = texts.select(key, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)))).alias("ref"))
    return refs.join(elements.select(F.col("id").alias("ref")).distinct(), "ref", "left_anti").select(key, "ref")


# Shapes in which running text states a total, and lines of a history that don't count.
TOTALS = [
    ("elementos", r"(?i)\btotal\s+(?:de\s+)?elementos\s*[:=|]\s*(\d{1,4})\b"),
    ("elementos", r"(?i)\belementos\s+totales\s*[:=|]\s*(\d{1,4})\b"),
    ("elementos", r"(?i)^\s*\|?\s*elementos\s*\|\s*(\d{1,4})\b"),
    ("categorias", r"(?i)^\s*\|?\s*categorias\s*\|\s*(\d{1,4})\b"),
    ("fases", r"(?i)\b(\d{1,4})\s+fases\b"),
    ("fases", r"(?i)\bfases(?:\s+de\s+lectura)?\s*[:=|]\s*(\d{1,4})\b"),
]
HISTORY = r"(?i)^\s*(?:\d{4}-\d{2}-\d{2}|\|\s*\d+\s*\||v?\d+\.\d+\.\d+)"


def stale_totals(rows: DataFrame, elements: DataFrame, key: str) -> DataFrame:
    """(key, line_no, what, stated, computed) of totals in lines (key, line_no, line) that the elements don't bear out."""
    kept = rows.where(~F.col("line").rlike(HISTORY))

    def stated(what: str, pattern: str):
        return F.transform(F.regexp_extract_all("line", F.lit(pattern), F.lit(1)), lambda n: F.struct(F.lit(what).alias("what"), n.cast("bigint").alias("stated")))

    found = F.flatten(F.array(*[stated(what, p) for what, p in TOTALS]))
    said = kept.select(key, "line_no", F.explode(found).alias("x")).select(key, "line_no", "x.*")
    computed = stats(elements).where("grouping = 'total'").select(F.col("value").alias("what"), F.col("n").alias("computed"))
    return said.join(computed, "what").where("stated <> computed").select(key, "line_no", "what", "stated", "computed").distinct()


def missing_files(expected: DataFrame, files: DataFrame) -> DataFrame:
    """(filename) of narrative files that should be there."""
    return expected.select("filename").join(files.select("filename"), "filename", "left_anti")


#: The derived documents by name.
ARTIFACTS = {"pages": category_pages, "schema": record_schema, "ddl": ddl, "form": reading_form, "matrix": matrix, "propagation": propagation, "glossary": glossary}


def generate(elements: DataFrame, names: tuple[str, ...] = tuple(ARTIFACTS), check: bool = True) -> dict[str, DataFrame]:
    """The chosen documents of a taxonomy; errors (not warnings) in its rules stop it, unless the check is off."""
    unknown = [n for n in names if n not in ARTIFACTS]
    if unknown:
        raise ValueError(f"unknown documents: {unknown}")
    if check and not rules(elements).where("code LIKE 'E%'").isEmpty():
        raise RuntimeError("the taxonomy breaks its rules")
    return {n: ARTIFACTS[n](elements) for n in names}


def union_all(found: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, found)
