"""Documents of a taxonomy as ordered lines: category pages, the reading form, and the schema of a record.

Lines are rows, so that no document has to fit one value; `sources.corpus.write_artifact`
writes them in their order.  Elements may have a column `orden` for their place
in the source; without it they go by id and name, and a column `fuente`, if there
is one, tells the order of those that have both alike.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.canonical import json_canonical, list_fingerprints
from ..functions.text import pad
from .taxonomy import CATEGORY_NAMES

# Names of the phases, blanks of the form, its summary and its list of quality points, and the fields' properties.
PHASE_NAMES = {
    0: "PREPARACION", 1: "IDENTIFICACION FORMAL", 2: "VIGENCIA Y EFICACIA", 3: "VERSIONES", 4: "RELACIONES NORMATIVAS", 5: "ANALISIS OPERATIVO",
    6: "INTERPRETACION", 7: "ELEMENTOS ESPECIALES", 8: "ANALISIS ECONOMICO / AIR", 9: "CIERRE Y METADATOS",
}
BLANK = "_______________"
SUMMARY = ["Elementos N/A: _____", "Conflictos detectados: _____", "Nivel de certeza: [ ] Alta  [ ] Media  [ ] Baja"]
QUALITY = [
    ("Todos los metadatos de identificacion completos (A)", 5), ("Estructura formal mapeada (B)", 5), ("Estado de vigencia verificado (C)", 5), ("Relaciones normativas trazadas (D)", 5), ("Versiones documentadas (E)", 5),
    ("Analisis operativo completo (F+M)", 10), ("Interpretacion aplicada (J)", 5), ("Metadatos del analisis registrados (G)", 5), ("Elementos especiales identificados (H)", 5),
]
META = {
    "id_ficha": {"type": "string", "pattern": "^NP-FICHA-[A-Z]+-[0-9]+-[0-9]{4}-[0-9]+$"},
    "version": {"type": "string"},
    "fecha_analisis": {"type": "string", "format": "date-time"},
    "analista": {"type": "string"},
    "organizacion": {"type": "string"},
    "proposito": {"type": "string"},
    "estado": {"type": "string", "enum": fixed.RECORD_STATES},
    "norma_archivo": {"type": "string", "pattern": "^[^/\\\\]+\\.md$"},
    "corpus_set_hash": {"type": "string", "pattern": "^[0-9a-f]{64}$"},
}
EVIDENCE = {
    "type": "array",
    "minItems": 1,
    "items": {
        "type": "object",
        "required": ["campo", "cita", "tipo", "verbatim"],
        "properties": {
            "campo": {"type": "string", "pattern": "^[A-M]\\.[0-9]+[a-z]?$"},
            "cita": {"type": "string", "pattern": "^[^\\n]+\\.md#L[0-9]+(-L[0-9]+)?$"},
            "tipo": {"type": "string", "enum": fixed.EVIDENCE_KINDS},
            "verbatim": {"type": "string", "minLength": 1},
        },
    },
}


def stamp(version: str, source_date: str) -> str:
    """What ties a derived document to its source: the source's version and date, never the clock."""
    return f"v{version}  {source_date}"


def thousands(n: Column | str) -> Column:
    """A whole number with commas between thousands."""
    return F.format_number(F.col(n) if isinstance(n, str) else n, 0)


def _order(elements: DataFrame) -> list[str]:
    return ["orden", "id"] if "orden" in elements.columns else ["id", "nombre", *[c for c in ("fuente",) if c in elements.columns]]


def _names(names: dict, key: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), key), F.lit(""))


def category_documents(elements: DataFrame, version: str, source_date: str) -> DataFrame:
    """(categoria, section, at, line): title and stamp (0), elements with description and origin (1), facts (2)."""
    known = elements.where("categoria IS NOT NULL")
    key = F.col("categoria")
    at = (F.row_number().over(W.partitionBy("categoria").orderBy(*_order(elements))) - 1).cast("bigint")
    origin = F.when(F.coalesce(F.col("origen"), F.lit("base")) != "base", F.concat(F.lit(" ["), F.upper("origen"), F.lit("]"))).otherwise("")
    text = F.concat(pad("id", 5), F.lit(" "), pad(F.coalesce("nombre", F.lit("")), 37), F.lit(" "), F.replace(F.coalesce("descripcion", F.lit("")), F.lit("\n"), F.lit(" ")), origin)
    listed = known.select("categoria", F.lit(1).alias("section"), at.alias("at"), text.alias("line"))
    first = F.min_by("fase_lectura", F.struct(*_order(elements)))
    facts = known.groupBy("categoria").agg(F.count("*").alias("n"), first.alias("fase"), F.array_join(F.array_sort(F.collect_set("origen")), ", ").alias("origins"))
    rows = [("Categoria     ", key), ("Elementos     ", F.col("n").cast("string")), ("Fase principal", F.coalesce(F.col("fase").cast("string"), F.lit(""))), ("Origenes      ", F.col("origins"))]
    fact = lambda name, value: F.concat(F.lit(f"| {name} | "), value, F.lit(" |"))
    told = facts.select("categoria", F.lit(2).alias("section"), F.posexplode(F.array(*[fact(*row) for row in rows])).alias("at", "line")).withColumn("at", F.col("at").cast("bigint"))
    # The source's elements are rows up to the digest: a category as one JSON value would have to fit a task's memory.
    one = json_canonical(F.to_json(F.struct(*[c for c in elements.columns if c not in ("orden", "fuente")])))
    prints = list_fingerprints(known.select("categoria", *_order(elements), one.alias("__one")), "categoria", _order(elements), "__one")
    printed = prints.select("categoria", F.lit(2).alias("section"), F.lit(len(rows)).cast("bigint").alias("at"), fact("Hash fuente   ", F.left("print", F.lit(16))).alias("line"))
    title = [F.concat(F.lit("# CATEGORIA "), key, F.lit(" — "), _names(CATEGORY_NAMES, key)), F.concat(F.lit("# NP-CAT-"), key, F.lit(f"  {stamp(version, source_date)}"))]
    head = known.select("categoria").distinct().select("categoria", F.lit(0).alias("section"), F.posexplode(F.array(*title)).alias("at", "line")).withColumn("at", F.col("at").cast("bigint"))
    return head.unionByName(listed).unionByName(told).unionByName(printed)


# What a category's page has around its title, elements and facts; {source} is what they were read from, {n} the number of elements.
RULER = "=" * 80
PAGE_DEFINITION = ["", RULER, "1.  DEFINICION", RULER, "", "[Auto-generado desde {source} — {n} elementos]", "", RULER, "2.  ELEMENTOS", RULER, "", "#     Elemento                              Descripcion", "----- ------------------------------------- -----------------------------------"]
PAGE_FACTS = ["", RULER, "3.  METADATOS", RULER, "", "| Campo          | Valor |", "|----------------|-------|"]


def category_pages_whole(elements: DataFrame, version: str, source_date: str, source: str) -> DataFrame:
    """(categoria, block, at, line): whole pages in the order of block and at, with all that the format has around the rows of `category_documents`."""
    own = category_documents(elements, version, source_date).select("categoria", (F.col("section") * 2).alias("block"), "at", "line")
    counts = elements.where("categoria IS NOT NULL").groupBy("categoria").agg(F.count("*").cast("string").alias("n"))
    frame = [counts.select("categoria", F.lit(block).alias("block"), F.posexplode(F.array(*[F.replace(F.lit(x.replace("{source}", source)), F.lit("{n}"), F.col("n")) for x in rows])).alias("at", "line")) for block, rows in ((1, PAGE_DEFINITION), (3, PAGE_FACTS), (5, [""]))]
    return frame[0].unionByName(frame[1]).unionByName(frame[2]).withColumn("at", F.col("at").cast("bigint")).unionByName(own).select("categoria", "block", "at", "line")


def form_document(elements: DataFrame, version: str, source_date: str) -> DataFrame:
    """(fase, categoria, at, part, line) of the form: phase -1 opens it, phase 99 is summary and quality points.

    Within a phase the title has an empty category and the decision the category
    '~', which sorts behind all others; an element has the parts 0 to 3: itself,
    value, reference and notes.
    """
    spark = elements.sparkSession
    known = elements.where("fase_lectura IS NOT NULL AND categoria IS NOT NULL").withColumn("fase", F.col("fase_lectura").cast("bigint"))
    totals = known.agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("categoria")), ", ").alias("cats"), F.countDistinct("categoria").alias("nc"), F.countDistinct("fase").alias("nf"), F.array_join(F.array_sort(F.collect_set("fase")).cast("array<string>"), ", ").alias("phases"))
    line = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    text = lambda c: F.col(c).cast("string")
    opening = [F.lit(f"# NP-FICHA  {stamp(version, source_date)}"), line("**Total de campos:** ", text("n")), line("**Categorias:** ", text("nc"), " (", F.col("cats"), ")"), line("**Fases:** ", text("nf"), " (", F.col("phases"), ")")]
    closing = [line("Elementos completados: _____ / ", text("n")), *map(F.lit, SUMMARY), *[F.lit(f"- [ ] {what} ... {points} pts") for what, points in QUALITY], F.lit(f"**PUNTUACION TOTAL: _____ / {sum(p for _, p in QUALITY)}**")]
    ends = [totals.select(F.lit(f).cast("bigint").alias("fase"), F.lit("").alias("categoria"), F.posexplode(F.array(*rows)).alias("at", "line")) for f, rows in ((-1, opening), (99, closing))]
    phases = known.select("fase").distinct()
    title = phases.select("fase", F.lit("").alias("categoria"), F.lit(0).alias("at"), line("FASE ", text("fase"), " — ", _names(PHASE_NAMES, F.col("fase").cast("int"))).alias("line"))
    decision = phases.select("fase", F.lit("~").alias("categoria"), F.posexplode(F.array(line("**Decision Fase ", text("fase"), ":** [ ] CONTINUAR  [ ] PAUSAR  [ ] ABANDONAR"), F.lit(f"**Firma:** {BLANK}  **Fecha:** {BLANK}"))).alias("at", "line"))
    heads = known.groupBy("fase", "categoria").agg(F.count("*").alias("k")).select("fase", "categoria", F.lit(0).alias("at"), line("### Categoria ", F.col("categoria"), " (", text("k"), " elementos)").alias("line"))
    at = F.row_number().over(W.partitionBy("fase", "categoria").orderBy(*_order(elements)))
    four = F.array(line("- [ ] **", F.col("id"), "** — ", F.coalesce("nombre", F.lit(""))), F.lit(f"  - VALOR: {BLANK}"), line(f"  - REF. ARTICULO: {BLANK}", F.when(F.col("requiere_ref_articulo"), " (obligatorio)").otherwise("")), F.lit(f"  - NOTAS: {BLANK}"))
    # Numbered before the parts are laid out, or the parts would be numbered.
    body = known.withColumn("at", at).select("fase", "categoria", "at", F.posexplode(four).alias("part", "line"))
    single = ends[0].unionByName(ends[1]).unionByName(title).unionByName(decision).unionByName(heads).withColumn("part", F.lit(0))
    return single.unionByName(body).select("fase", "categoria", F.col("at").cast("bigint").alias("at"), F.col("part").cast("bigint").alias("part"), "line")


def schema_parts(elements: DataFrame) -> DataFrame:
    """(part, name, body) of a record's schema: its meta and evidencia, and a property for each element under its phase."""
    text = lambda extra="": '{"type": "string"' + extra + "}"
    body = F.concat(
        F.lit('{"type": "object", "properties": {"completado": {"type": "boolean"}, "na": {"type": "boolean"}, "valor": ' + text() + ', "ref_articulo": {"type": "string"'),
        F.when(F.col("requiere_ref_articulo"), ', "minLength": 1').otherwise(""),
        F.lit('}, "notas": ' + text() + "}}"),
    )
    own = elements.where("id IS NOT NULL").groupBy(F.col("fase_lectura").cast("string").alias("part"), F.col("id").alias("name")).agg(F.max(body).alias("body"))
    fixed_rows = [("meta", k, json.dumps(x)) for k, x in META.items()] + [("evidencia", "", json.dumps(EVIDENCE))]
    return elements.sparkSession.createDataFrame(fixed_rows, "part string, name string, body string").unionByName(own)


def whole_schema(elements: DataFrame, version: str) -> dict:
    """The schema as one document, for a taxonomy of bounded size; its parts stream to the driver."""
    phases = {str(i): {"type": "object", "properties": {}} for i in range(fixed.PHASES)}
    meta: dict = {}
    evidence: dict = {}
    for r in schema_parts(elements).orderBy("part", "name").toLocalIterator():
        if r.part == "meta":
            meta[r.name] = json.loads(r.body)
        elif r.part == "evidencia":
            evidence = json.loads(r.body)
        elif r.part in phases:
            phases[r.part]["properties"][r.name] = json.loads(r.body)
    properties = {"meta": {"type": "object", "properties": meta}, "evidencia": evidence, "fases": {"type": "object", "properties": phases}}
    return {"$schema": "http://json-schema.org/draft-07/schema#", "version": version, "type": "object", "required": ["meta", "fases", "evidencia"], "properties": properties}
