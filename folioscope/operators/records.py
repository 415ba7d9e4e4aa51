"""Evidence-backed records checked by five families of rules.

Records come in flat form: meta (record_id, estado, norma_archivo, hash), fields
(record, fase, campo, completado, na, valor, ref_articulo) and evidence (record,
pos, campo, cita, tipo, verbatim).  Every rule returns (record, code, detail)
rows; no rows mean that a record passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import is_blank
from .gold import CITATION, check_citations


def _broken(rows: DataFrame, checks: dict, detail: str) -> DataFrame:
    codes = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in checks.items()]))
    return rows.select("record", F.explode(codes).alias("code"), F.col(detail).alias("detail"))


def meta_rules(meta: DataFrame) -> DataFrame:
    """V1: the forms of id, state, file and seal."""
    wrong = lambda c, pattern: ~F.coalesce(F.col(c).rlike(pattern), F.lit(False))
    checks = {"V1:id": wrong("record_id", fixed.RECORD_ID), "V1:estado": ~F.coalesce(F.col("estado").isin(fixed.RECORD_STATES), F.lit(False)), "V1:norma": wrong("norma_archivo", fixed.RECORD_FILE), "V1:hash": wrong("hash", fixed.SEAL)}
    return _broken(meta, checks, "record_id")


def seal_rules(meta: DataFrame, set_hash: str | None, offline: bool = False) -> DataFrame:
    """V2: a well-formed seal that isn't the corpus's, or a corpus without one."""
    formed = F.col("hash").rlike(fixed.SEAL)
    if set_hash is None:
        return _broken(meta, {"V2:no_manifest": F.lit(not offline)}, "record_id")
    return _broken(meta, {"V2:other_corpus": formed & (F.col("hash") != set_hash)}, "record_id")


def field_rules(fields: DataFrame, evidence: DataFrame, elements: DataFrame) -> DataFrame:
    """V3: completed fields stand under their phase, have the article reference they need, and evidence."""
    known = elements.groupBy(F.col("id").alias("campo")).agg(F.min("fase_lectura").alias("canonical"), F.max("requiere_ref_articulo").alias("needs_ref"))
    proven = evidence.select("record", "campo").distinct().withColumn("proven", F.lit(True))
    rows = fields.join(known, "campo").join(proven, ["record", "campo"], "left")
    answered = F.col("completado") & ~F.coalesce("na", F.lit(False))
    checks = {
        "V3:misplaced": F.col("fase") != F.col("canonical"),
        "V3:no_reference": answered & F.col("needs_ref") & is_blank("ref_articulo"),
        "V3:no_evidence": answered & F.col("proven").isNull(),
    }
    return _broken(rows, checks, "campo")


def presence_rules(meta: DataFrame, evidence: DataFrame) -> DataFrame:
    """V3: a record has evidence at all, whatever its fields."""
    bare = meta.join(evidence.select("record").distinct(), "record", "left_anti")
    return bare.select("record", F.lit("V3:empty_evidence").alias("code"), F.col("record_id").alias("detail"))


def evidence_rules(evidence: DataFrame, elements: DataFrame) -> DataFrame:
    """V4: the forms of evidence, and fields that exist."""
    known = elements.select(F.col("id").alias("campo")).distinct().withColumn("known", F.lit(True))
    rows = evidence.join(known, "campo", "left").withColumn("at", F.concat_ws("#", F.coalesce("campo", F.lit("")), F.col("pos").cast("string")))
    formed = F.coalesce(F.col("campo").rlike(fixed.FIELD_ID), F.lit(False))
    checks = {
        "V4:campo": ~formed,
        "V4:unknown_field": formed & F.col("known").isNull(),
        "V4:cita": ~F.coalesce(F.col("cita").rlike(CITATION), F.lit(False)),
        "V4:tipo": ~F.coalesce(F.col("tipo").isin(fixed.EVIDENCE_KINDS), F.lit(False)),
        "V4:verbatim": is_blank("verbatim"),
    }
    return _broken(rows, checks, "at")


def verbatim_rules(evidence: DataFrame, docs: DataFrame) -> DataFrame:
    """V5: well-formed evidence stands, verbatim, in the lines that it cites."""
    formed = evidence.where(F.col("cita").rlike(CITATION) & ~is_blank("verbatim"))
    claims = formed.select(F.struct("record", "pos", "campo").alias("id"), "cita", "verbatim")
    bad = check_citations(claims, docs, strict=True).where("outcome <> 'ok'")
    return bad.select("id.record", F.concat(F.lit("V5:"), "outcome").alias("code"), F.concat_ws("#", F.coalesce("id.campo", F.lit("")), F.col("id.pos").cast("string")).alias("detail"))


def coverage(fields: DataFrame, evidence: DataFrame) -> DataFrame:
    """(record, completed, not_applicable, proven): progress of each record; zero completed fields are a warning."""
    proven = evidence.select("record", "campo").distinct().withColumn("p", F.lit(1))
    rows = fields.join(proven, ["record", "campo"], "left")
    done = F.col("completado") & ~F.coalesce("na", F.lit(False))
    counts = rows.groupBy("record").agg(F.count_if(done).alias("completed"), F.count_if(F.col("na")).alias("not_applicable"), F.count_if(done & F.col("p").isNotNull()).alias("proven"))
    return counts.withColumn("warning", F.col("completed") == 0)
