"""Queries of cleaning, comparison, taxonomy, records, the director, errata and the gate."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from ..functions import canonical, fixed, html
from ..functions import text as T
from ..operators import chunks as C
from ..operators import cleaning as L
from ..operators import compare as K
from ..operators import director as D
from ..operators import documents as O
from ..operators import errata as E
from ..operators import gate
from ..operators import gold as G
from ..operators import manifest as M
from ..operators import records as R
from ..operators import runs as N
from ..operators import taxonomy as X
from ..sources import corpus
from ..streaming import ingest
from .corpus_queries import _ANSWERS as _SCORED
from .corpus_queries import _MANIFEST, _now, gold_totals
from .registry import CHUNKED, DOCS, FLAT, FOLD, chunked, docs, numbered_rows, query, stored, table

LF = "chr(10)"
_LINES = f"{DOCS}, split AS (SELECT filename, doc_id, string_split(text, {LF}) AS l FROM docs), rows_ AS (SELECT filename, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS line_no FROM split)"

# Lines with marks, links, tables, annotation blocks and page furniture, by their numbers.
_DIRTY_CASES = """CASE line_no % 17 WHEN 3 THEN '**Concordancias:**' WHEN 5 THEN '### Capítulo ' || line_no WHEN 7 THEN '| ' || left(line, 12) || ' | | b |' WHEN 8 THEN '| --- | :---: |' WHEN 9 THEN '- [' || left(line, 9) || '](http://x.y/z) *fin*'
  WHEN 10 THEN '[ver](javascript:open(1)) ' || left(line, 15) WHEN 11 THEN 'Última Actualización: hoy' WHEN 12 THEN 'Imprimir: ' || left(line, 5) WHEN 13 THEN ' 12 34 ' WHEN 14 THEN '> ![logo](a.png) ' || left(line, 10) WHEN 15 THEN 'LEY 142 de 1994 77' WHEN 16 THEN line_no || 'o. inciso\\\\_' || left(line, 8) ELSE line END"""
_DIRTY = f"{_LINES}, dirty AS (SELECT filename, line_no, {_DIRTY_CASES.replace(chr(92) * 2, chr(92))} AS line FROM rows_)"
# RE2 has no lookarounds; what follows an ordinal is captured and put back.
_ORDINAL = r"regexp_replace({}, '([0-9])(?:o|°|º)([\s.,;:)]|$)', '\1\2', 'g')"
_EVENTS = (
    _DIRTY
    + rf""", events AS (SELECT *, CASE WHEN regexp_matches({FOLD.format('line')}, '^\s*(#{{1,4}}\s|\**\s*articulo\s+([0-9]|nuevo)\b|\**\s*(titulo|capitulo|seccion|paragrafo)\b)') THEN 0 WHEN regexp_matches({FOLD.format('line')}, '^\s*\**\s*(concordancias|doctrina|modificaciones|vigencia|interpretacion)\s*:?\s*\**$') THEN 1 END AS event FROM dirty),
outside AS (SELECT filename, line_no, line FROM (SELECT *, last_value(event IGNORE NULLS) OVER (PARTITION BY filename ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM events) WHERE coalesce(state, 0) = 0)"""
)
_UNLINKED = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(line, '\[[^\]]*\]\(javascript:[^)]*\)+', ' ', 'gi'), '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '!\[[^\]]*\]\([^)]*\)', ' ', 'g'), '^\s*[-#*>]+\s*', '')"
_CELLS = r"list_transform(string_split(trim(trim(u), '|'), '|'), lambda c : trim(c))"
_TABLE = f"CASE WHEN contains(u, '|') THEN CASE WHEN len(list_filter({_CELLS}, lambda c : NOT regexp_full_match(c, ':?-{{2,}}:?'))) = 0 THEN '' ELSE array_to_string(list_filter({_CELLS}, lambda c : c <> ''), ' ') END ELSE u END"
_CLEANED = f"unlinked AS (SELECT filename, line_no, {_UNLINKED} AS u FROM @source), cleaned AS (SELECT filename, line_no, {FLAT.format(f'translate(replace({_TABLE}, chr(92), {chr(39) * 2}), {chr(39)}*_<>~`{chr(39)}, {chr(39)}      {chr(39)})')} AS line FROM unlinked)"
_PHRASES, _SHORT = "|".join(p.replace("(", "\\(").replace(")", "\\)") for p in fixed.JUNK_PHRASES), "|".join(fixed.JUNK_SHORT)
_JUNK = rf"judged AS (SELECT *, CASE WHEN f IN ('', '---') THEN 'empty' WHEN regexp_matches(f, '{_PHRASES}') THEN 'phrase' WHEN regexp_matches(f, '{fixed.JUNK_LINE}') THEN 'line' WHEN length(f) < 80 AND regexp_matches(f, '^({_SHORT})($|[ :])') THEN 'navigation' WHEN regexp_matches(f, '^[0-9\s]+$') THEN 'page_number' END AS reason FROM (SELECT *, {_ORDINAL.format(FOLD.format('line'))} AS f FROM cleaned))"


def _dirty(spark, sf_dir):
    rows = corpus.lines(docs(spark, sf_dir), "filename")
    return rows.select("filename", "line_no", F.expr(_DIRTY_CASES).alias("line"))


@query(f"WITH {_EVENTS} SELECT filename, line_no, line FROM outside")
def annotation_islands(spark, sf_dir):
    return L.outside_annotations(_dirty(spark, sf_dir), "filename")


@query(f"WITH {_DIRTY}, {_CLEANED.replace('@source', 'dirty')} SELECT filename, line_no, line FROM cleaned")
def clean_markdown(spark, sf_dir):
    return _dirty(spark, sf_dir).select("filename", "line_no", L.clean_line(F.col("line")).alias("line"))


@query(f"WITH {_DIRTY}, unlinked AS (SELECT filename, line_no, line AS u FROM dirty WHERE contains(line, '|')) SELECT filename, line_no, {_TABLE} AS line FROM unlinked")
def table_linearise(spark, sf_dir):
    return _dirty(spark, sf_dir).where("contains(line, '|')").select("filename", "line_no", L.linear_table(F.col("line")).alias("line"))


@query(f"WITH {_DIRTY}, {_CLEANED.replace('@source', 'dirty')}, {_JUNK} SELECT filename, line_no, reason FROM judged WHERE reason IS NOT NULL")
def junk_lines(spark, sf_dir):
    return clean_markdown(spark, sf_dir).select("filename", "line_no", L.junk(T.fold_ordinal("line")).alias("reason")).where("reason IS NOT NULL")


@query(f"WITH {_EVENTS}, {_CLEANED.replace('@source', 'outside')}, {_JUNK} SELECT filename, line_no, line FROM judged WHERE reason IS NULL")
def clean_text(spark, sf_dir):
    return L.clean(_dirty(spark, sf_dir), "filename")


@query()
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.html_text("html").alias("text"))


# Articles: turns of a conversation, numbered, some of them in two copies; the source lacks some and changes some.
def _article_rows(spark, sf_dir, source: bool):
    t = table(spark, sf_dir, "conversations")
    if source:
        t = t.where("turn <> 2")
    number = F.when(F.col("turn") == 5, 1).otherwise(F.col("turn") + 1).cast("string")
    body = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    if source:
        body = F.when((F.col("turn") == 1) & (F.col("conv_id") % 2 == 0), F.concat(body, F.lit(" añadido"))).otherwise(F.translate(body, 'aeiou', 'AEIOU'))
        number = F.when(F.col("turn") == 3, "99").otherwise(number)
    head = F.concat(F.when(F.col("turn") % 3 == 1, "Artículo ").otherwise("ARTÍCULO "), number, F.when(F.col("turn") % 2 == 0, "o. ").otherwise(". "))
    lines = F.array(F.concat(head, body), F.concat(F.lit("Parágrafo "), F.col("turn").cast("string")))
    return t.select("conv_id", F.posexplode(lines).alias("i", "line"), "turn").select("conv_id", (F.col("turn") * 2 + F.col("i")).alias("line_no"), "line")


def _articles_sql(source: bool) -> str:
    body = "replace(text, chr(10), ' ')"
    number = "CASE WHEN turn = 5 THEN '1' ELSE CAST(turn + 1 AS VARCHAR) END"
    if source:
        body = f"CASE WHEN turn = 1 AND conv_id % 2 = 0 THEN {body} || ' añadido' ELSE translate({body}, 'aeiou', 'AEIOU') END"
        number = f"CASE WHEN turn = 3 THEN '99' ELSE {number} END"
    return f"(SELECT conv_id, {number} AS key, row_number() OVER (PARTITION BY conv_id, {number} ORDER BY turn) - 1 AS copy_no, {FLAT.format(f'''(CASE WHEN turn % 3 = 1 THEN 'Artículo ' ELSE 'ARTÍCULO ' END) || ({number}) || (CASE WHEN turn % 2 = 0 THEN 'o. ' ELSE '. ' END) || ({body}) || ' Parágrafo ' || turn''')} AS text FROM conversations {'WHERE turn <> 2' if source else ''})"


_ART = f"a AS {_articles_sql(False)}, b AS {_articles_sql(True)}, same AS (SELECT DISTINCT conv_id, key FROM a JOIN b USING (conv_id, key) WHERE {_ORDINAL.format(FOLD.format('a.text'))} = {_ORDINAL.format(FOLD.format('b.text'))})"


def _articles(spark, sf_dir, source: bool):
    return K.segments(_article_rows(spark, sf_dir, source), "conv_id")


@query(f"WITH {_ART} SELECT * FROM a")
def article_segments(spark, sf_dir):
    return _articles(spark, sf_dir, False)


@query(f"WITH {_ART} SELECT * FROM same")
def article_exact(spark, sf_dir):
    return K.exact(_articles(spark, sf_dir, False), _articles(spark, sf_dir, True), "conv_id")


@query(f"WITH {_ART} SELECT DISTINCT conv_id, key FROM a WHERE (conv_id, key) NOT IN (SELECT conv_id, key FROM b)")
def article_missing(spark, sf_dir):
    return K.missing(_articles(spark, sf_dir, False), _articles(spark, sf_dir, True), "conv_id")


@query(f"WITH {_ART} SELECT DISTINCT conv_id, key FROM b WHERE (conv_id, key) NOT IN (SELECT conv_id, key FROM a)")
def article_extra(spark, sf_dir):
    return K.missing(_articles(spark, sf_dir, True), _articles(spark, sf_dir, False), "conv_id")


@query()
def article_best_pair(spark, sf_dir):
    return K.compare(_articles(spark, sf_dir, False), _articles(spark, sf_dir, True), "conv_id").select("conv_id", "key", "state", "ratio")


@query()
def first_diff(spark, sf_dir):
    return K.causes(K.compare(_articles(spark, sf_dir, False), _articles(spark, sf_dir, True), "conv_id")).where("left IS NOT NULL").select("conv_id", "key", "left", "right", "cause")


@query()
def verdict_summary(spark, sf_dir):
    return K.summary(K.compare(_articles(spark, sf_dir, False), _articles(spark, sf_dir, True), "conv_id"), table(spark, sf_dir, "conversations"), "conv_id")


# What of a comparison needs no matcher: equal articles, absent ones, and the rest.
_STATES = f"{_ART}, states AS (SELECT DISTINCT conv_id, key, CASE WHEN (conv_id, key) IN (SELECT conv_id, key FROM same) THEN 'exacto' WHEN (conv_id, key) NOT IN (SELECT conv_id, key FROM b) THEN 'ausente_en_fuente' ELSE 'distinto' END AS state FROM a)"


def _compared(spark, sf_dir):
    return K.compare(_articles(spark, sf_dir, False), _articles(spark, sf_dir, True), "conv_id")


@query(f"WITH {_STATES} SELECT * FROM states")
def article_states(spark, sf_dir):
    return _compared(spark, sf_dir).select("conv_id", "key", F.when(F.col("state").isin("casi", "divergente"), "distinto").otherwise(F.col("state")).alias("state"))


@query(f"WITH {_STATES}, c AS (SELECT conv_id, count(*) FILTER (state = 'exacto') AS exact, count(*) FILTER (state <> 'exacto') AS other FROM states GROUP BY 1) SELECT conv_id, coalesce(exact, 0) AS exact, coalesce(other, 0) AS other, CASE WHEN coalesce(exact + other, 0) = 0 THEN 'SIN_ARTICULOS' WHEN other = 0 THEN 'VERIFICADA' ELSE 'NO_TODA_IGUAL' END AS verdict FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN c USING (conv_id)")
def verdict_counts(spark, sf_dir):
    s = K.summary(_compared(spark, sf_dir), table(spark, sf_dir, "conversations"), "conv_id")
    other = (F.col("near") + F.col("divergent")).alias("other")
    return s.select("conv_id", "exact", other, F.when(F.col("verdict") == "SIN_ARTICULOS", F.col("verdict")).when(other == 0, "VERIFICADA").otherwise("NO_TODA_IGUAL").alias("verdict"))


# The whole report of each conversation; its ratios have no SQL form.
@query()
def comparison_report(spark, sf_dir):
    a, b = _articles(spark, sf_dir, False), _articles(spark, sf_dir, True)
    return K.reports(K.compare(a, b, "conv_id"), a, b, "conv_id")


@query(f"WITH {_ART}, f AS (SELECT conv_id, copy_no, text, strpos({FOLD.format('text')}, 'the') AS p FROM a WHERE key = '1') SELECT conv_id, copy_no, CASE WHEN p > 0 THEN substring(text, CAST(greatest(p - 20, 1) AS BIGINT), CAST(p - greatest(p - 20, 1) + 23 AS BIGINT)) END AS shown FROM f")
def article_keyword(spark, sf_dir):
    return K.keyword(_articles(spark, sf_dir, False), "conv_id", "1o.", "the", 20)


@query(f"""WITH {DOCS}, cut AS (SELECT filename, string_split(text, chr(10)) AS l FROM docs), rows_ AS (SELECT filename, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM cut), laid AS (SELECT filename, i, 'Artículo ' || i || '. ' || line AS line FROM rows_ WHERE i > 1 UNION ALL SELECT filename, i, line FROM rows_ WHERE i = 1)
SELECT filename, CAST(i - 1 AS VARCHAR) AS n, CAST(sum(length(line) + 1) OVER (PARTITION BY filename ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS "start", CAST(sum(length(line) + 1) OVER (PARTITION BY filename ORDER BY i) - CASE WHEN lead(i) OVER (PARTITION BY filename ORDER BY i) IS NULL THEN 1 ELSE 0 END AS BIGINT) AS "end" FROM laid QUALIFY i > 1""")
def article_offsets(spark, sf_dir):
    # Every line but the first opens an article.
    numbered = F.array_join(F.transform(F.split("text", "\n"), lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit("Artículo "), (i + 1).cast("string"), F.lit(". "), x))), "\n")
    found = K.offsets(docs(spark, sf_dir).select("filename", numbered.alias("text")), "filename")
    return found.select("filename", (F.col("key").cast("bigint") - 1).cast("string").alias("n"), "start", "end")


@query(r"SELECT p_partkey, lower(regexp_replace(regexp_replace(trim(k), '\.+$', ''), '([0-9])(?:o|°|º)$', '\1')) AS key FROM (SELECT p_partkey, ' ' || p_size || CASE p_partkey % 5 WHEN 0 THEN 'o.' WHEN 1 THEN '°' WHEN 2 THEN 'º..' WHEN 3 THEN '.2A' ELSE '.' END || ' ' AS k FROM part)")
def norm_keys(spark, sf_dir):
    k = F.expr("' ' || p_size || CASE p_partkey % 5 WHEN 0 THEN 'o.' WHEN 1 THEN '°' WHEN 2 THEN 'º..' WHEN 3 THEN '.2A' ELSE '.' END || ' '")
    return table(spark, sf_dir, "part").select("p_partkey", T.norm_key(k).alias("key"))


@query(f"WITH {DOCS}, found AS (SELECT doc_id, text, strpos({FOLD.format('text')}, 'the') AS p FROM docs) SELECT doc_id, replace(substring(text, CAST(greatest(p - 30, 1) AS BIGINT), CAST(p - greatest(p - 30, 1) + 33 AS BIGINT)), chr(10), ' ') AS shown FROM found WHERE p > 0")
def keyword_context(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.context("text", "the", 30).alias("shown")).where("shown IS NOT NULL")


# The eight patterns of a law's structure, over documents whose lines are turned into headings and notes.
_LAW = """CASE i % 11 WHEN 1 THEN '**Artículo ' || i || '. x' WHEN 2 THEN '### TÍTULO ' || i WHEN 3 THEN '#### Capítulo' WHEN 4 THEN 'Parágrafo ' || l[i] WHEN 5 THEN '**ARTÍCULO NUEVO' WHEN 6 THEN '(Derogado)' WHEN 7 THEN 'Suprime ' || l[i] WHEN 8 THEN 'Disposición final' WHEN 9 THEN 'disposiciones transitorias' ELSE l[i] END"""
_PROFILED = ", ".join(f"len(list_filter(f, lambda x : regexp_matches(x, '{p}'))) AS {n}" for n, p in G.PROFILE.items())


@query(f"WITH {DOCS}, s AS (SELECT filename, string_split(text, chr(10)) AS l FROM docs), t AS (SELECT filename, list_transform(range(1, len(l) + 1), lambda i : {FOLD.format(f'({_LAW})')}) AS f FROM s) SELECT filename, {_PROFILED} FROM t")
def structure_profile_law(spark, sf_dir):
    line = lambda x, i: F.when(i % 11 == 1, F.concat(F.lit("**Artículo "), i, F.lit(". x"))).when(i % 11 == 2, F.concat(F.lit("### TÍTULO "), i)).when(i % 11 == 3, "#### Capítulo").when(i % 11 == 4, F.concat(F.lit("Parágrafo "), x)).when(i % 11 == 5, "**ARTÍCULO NUEVO").when(i % 11 == 6, "(Derogado)").when(i % 11 == 7, F.concat(F.lit("Suprime "), x)).when(i % 11 == 8, "Disposición final").when(i % 11 == 9, "disposiciones transitorias").otherwise(x)
    laid = F.array_join(F.transform(F.split("text", "\n"), lambda x, i: line(x, i + 1)), "\n")
    return G.structure_profile(docs(spark, sf_dir).select("filename", laid.alias("text")), "filename")


# A taxonomy from parts, with a fault of each kind at some modulus.
def _element(k: str, engine: str) -> str:
    text = "VARCHAR" if engine == "duck" else "STRING"
    return f"(substring('ABCDEFGHIJKLM', CAST({k} % 13 + 1 AS INT), 1) || '.' || CAST(({k} - {k} % 13) / 13 AS {'BIGINT' if engine == 'duck' else 'BIGINT'})::{text})"


def _elements_sql(engine: str) -> str:
    e = lambda k: _element(k, engine)
    arr = (lambda *x: f"[{', '.join(x)}]") if engine == "duck" else (lambda *x: f"array({', '.join(x)})")
    joined = (lambda a, b: f"list_concat({a}, {b})") if engine == "duck" else (lambda a, b: f"concat({a}, {b})")
    some = lambda cond, x: f"CASE WHEN {cond} THEN {arr(x)} ELSE {'[]' if engine == 'duck' else 'cast(array() AS array<string>)'} END"
    return f"""SELECT CASE WHEN p_partkey % 97 = 0 THEN 'A.1' WHEN p_partkey % 67 = 0 THEN 'no id' WHEN p_partkey % 17 = 0 AND p_partkey > 26 THEN {e('(p_partkey - 13)')} || 'a' ELSE {e('p_partkey')} END AS id,
  CASE WHEN p_partkey % 89 = 0 THEN 'Z' ELSE substring('ABCDEFGHIJKLM', CAST(p_partkey % 13 + 1 AS INT), 1) END AS categoria,
  CASE WHEN p_partkey % 59 = 0 THEN NULL WHEN p_partkey % 83 = 0 THEN '  ' ELSE p_name END AS nombre, CASE WHEN p_partkey % 79 = 0 THEN '' ELSE p_type END AS descripcion,
  CAST(CASE WHEN p_partkey % 73 = 0 THEN 12 WHEN p_partkey % 34 = 0 THEN (p_partkey - 13) % 10 ELSE p_partkey % 10 END AS INT) AS fase_lectura,
  CASE WHEN p_partkey % 71 = 0 THEN 'x' ELSE 'validado' END AS estado, CASE WHEN p_partkey % 61 = 0 THEN 'otro' ELSE 'base' END AS origen, CASE WHEN p_partkey % 53 = 0 THEN 'mapa' WHEN p_partkey % 3 = 0 THEN 'fecha' ELSE 'texto' END AS tipo_campo,
  p_partkey % 4 = 0 AS requiere_ref_articulo, {joined(joined(some('p_partkey % 2 = 0', e('(p_partkey + 13)')), some('p_partkey % 5 = 0', e('(p_partkey + 1)'))), some('p_partkey % 47 = 0', chr(39) + 'Q.99' + chr(39)))} AS dependencias, {arr('p_brand')} AS glosario_terminos FROM part"""


_EL = f"el AS ({_elements_sql('duck')})"


def _elements(spark, sf_dir):
    return _placed_elements(spark, sf_dir).drop("fuente")


def _placed_elements(spark, sf_dir):
    """The elements with their place in the source, by which rows of one id and name stay in their order."""
    return spark.sql(_elements_sql("spark").replace(" FROM part", ", p_partkey AS fuente FROM {part}"), part=table(spark, sf_dir, "part"))


@query(f"""WITH {_EL} SELECT 'categoria' AS grouping, categoria AS value, count(*) AS n FROM el GROUP BY categoria UNION ALL SELECT 'fase', CAST(fase_lectura AS VARCHAR), count(*) FROM el GROUP BY fase_lectura
UNION ALL SELECT 'total', 'elementos', count(*) FROM el UNION ALL SELECT 'total', 'categorias', count(DISTINCT categoria) FROM el UNION ALL SELECT 'total', 'fases', count(DISTINCT fase_lectura) FROM el""")
def tax_stats(spark, sf_dir):
    return X.stats(_elements(spark, sf_dir))


_DEPS = f"{_EL}, deps AS (SELECT DISTINCT id, unnest(dependencias) AS target FROM el), broken AS (SELECT * FROM deps WHERE target NOT IN (SELECT id FROM el)), phase AS (SELECT id, min(fase_lectura) AS p FROM el GROUP BY id), kids AS (SELECT DISTINCT el.id, left(el.id, length(el.id) - 1) AS parent, fase_lectura = p AS same FROM el JOIN phase ON phase.id = left(el.id, length(el.id) - 1) WHERE regexp_matches(el.id, '^[A-Z]\\.[0-9]+[a-z]$'))"


@query(f"""WITH {_DEPS}, n AS (SELECT *, count(*) OVER (PARTITION BY id) AS c FROM el)
SELECT DISTINCT 'E001' AS code, id, '' AS detail FROM n WHERE c > 1 UNION ALL SELECT DISTINCT 'E002', id, 'nombre' FROM el WHERE nombre IS NULL UNION ALL SELECT 'E003', id, target FROM broken
UNION ALL SELECT DISTINCT 'E004', id, '' FROM el WHERE categoria = 'Z' UNION ALL SELECT DISTINCT 'E005', id, '' FROM el WHERE fase_lectura > 9 UNION ALL SELECT DISTINCT 'E006', id, '' FROM el WHERE estado = 'x' UNION ALL SELECT DISTINCT 'E007', id, '' FROM el WHERE origen = 'otro'
UNION ALL SELECT DISTINCT 'E008', id, '' FROM el WHERE tipo_campo = 'mapa' UNION ALL SELECT DISTINCT 'E009', id, '' FROM el WHERE id = 'no id' UNION ALL SELECT DISTINCT 'E010', id, '' FROM el WHERE trim(nombre) = '' UNION ALL SELECT 'E013', id, parent FROM kids WHERE NOT same UNION ALL SELECT DISTINCT 'W001', id, '' FROM el WHERE descripcion = ''""")
def tax_rules(spark, sf_dir):
    return X.rules(_elements(spark, sf_dir))


# A description whose date and stored figures follow from the table.
@query("""WITH m AS (SELECT 'version' AS key, CASE WHEN count(*) > 0 THEN '1' ELSE '' END AS value FROM part UNION ALL SELECT 'fecha', CASE WHEN count(*) % 2 = 0 THEN ' ' ELSE '2024' END FROM part UNION ALL SELECT CASE WHEN count(*) > 0 THEN 'categorias' ELSE 'otra' END, CAST(count(*) AS VARCHAR) FROM part)
SELECT code, detail FROM (VALUES ('E011', 'version'), ('E012', 'fecha')) AS t(code, detail) WHERE detail NOT IN (SELECT key FROM m WHERE trim(value) <> '') UNION ALL SELECT 'W002', key FROM m WHERE key IN ('total_elementos', 'categorias', 'fases_lectura')""")
def tax_meta_rules(spark, sf_dir):
    n = table(spark, sf_dir, "part").agg(F.count("*").alias("n"))
    return X.meta_rules(n.selectExpr("inline(array(named_struct('key', 'version', 'value', if(n > 0, '1', '')), named_struct('key', 'fecha', 'value', if(n % 2 = 0, ' ', '2024')), named_struct('key', if(n > 0, 'categorias', 'otra'), 'value', string(n))))"))


@query(f"WITH {_DEPS} SELECT * FROM kids")
def tax_parent_phase(spark, sf_dir):
    return X.parent_phases(_elements(spark, sf_dir))


@query(f"WITH {_DEPS} SELECT * FROM broken")
def tax_broken_deps(spark, sf_dir):
    return X.broken_dependencies(_elements(spark, sf_dir))


@query(f"WITH {_EL}, edges AS (SELECT categoria, unnest(dependencias) AS target FROM el), home AS (SELECT id AS target, min(categoria) AS c FROM el GROUP BY id) SELECT categoria, {', '.join(f'count(*) FILTER (c = {chr(39)}{c}{chr(39)}) AS {chr(34)}{c}{chr(34)}' for c in fixed.CATEGORIES)} FROM edges JOIN home USING (target) GROUP BY categoria")
def tax_matrix(spark, sf_dir):
    return X.matrix(_elements(spark, sf_dir))


@query(f"WITH {_EL}, s AS (SELECT categoria, CAST(sum(len(dependencias)) AS BIGINT) AS n_out FROM el GROUP BY categoria) SELECT *, CAST(least(5, greatest(1, n_out // 3 + 1)) AS BIGINT) AS score, repeat('★', CAST(score AS INT)) || repeat('☆', CAST(5 - score AS INT)) AS stars FROM s")
def tax_sensitivity(spark, sf_dir):
    return X.sensitivity(_elements(spark, sf_dir))


_TERMS = ", ".join(f"('{t}', '{r}')" for t, refs in fixed.IMPLICIT_TERMS.items() for r in refs)


@query(f"WITH {_EL}, every AS (SELECT unnest(glosario_terminos) AS term, id AS ref FROM el UNION SELECT term, ref FROM (VALUES {_TERMS}) AS t(term, ref) WHERE ref IN (SELECT id FROM el)) SELECT term, string_agg(DISTINCT ref, ', ' ORDER BY ref) AS refs FROM every GROUP BY term")
def tax_glossary(spark, sf_dir):
    return X.glossary(_elements(spark, sf_dir))


_PROP = ", ".join(f"('{o}', {i}, '{d}')" for o, ds in fixed.PROPAGATION.items() for i, d in enumerate(ds))


@query(f"WITH {_EL} SELECT o AS origin, string_agg(d, ', ' ORDER BY i) AS targets FROM (VALUES {_PROP}) AS t(o, i, d) WHERE o IN (SELECT id FROM el) AND d IN (SELECT id FROM el) GROUP BY o")
def tax_propagation(spark, sf_dir):
    return X.propagation(_elements(spark, sf_dir))


@query(f"""WITH {_EL}, lines AS (SELECT *, CASE WHEN length(id) < 5 THEN rpad(id, 5, ' ') ELSE id END || ' ' || CASE WHEN length(coalesce(nombre, '')) < 37 THEN rpad(coalesce(nombre, ''), 37, ' ') ELSE nombre END || ' ' || estado AS line FROM el),
pages AS (SELECT categoria, count(*) AS n, CAST(first(fase_lectura ORDER BY id, fase_lectura) AS BIGINT) AS main_phase, string_agg(line, chr(10) ORDER BY id, line) AS page FROM lines GROUP BY categoria), phases AS (SELECT categoria, string_agg(fase_lectura, ',' ORDER BY fase_lectura) AS phases FROM (SELECT DISTINCT categoria, fase_lectura FROM el) GROUP BY categoria)
SELECT categoria, n, main_phase, phases, page, sha256(page) AS page_sha256 FROM pages JOIN phases USING (categoria)""")
def tax_pages(spark, sf_dir):
    return X.category_pages(_elements(spark, sf_dir))


@query(f"""WITH {_EL}, one AS (SELECT CAST(fase_lectura AS BIGINT) AS fase, id, min('"' || id || '": {{"type": "object", "properties": {{"completado": {{"type": "boolean"}}, "na": {{"type": "boolean"}}, "valor": {{"type": ["string", "null"]}}, "ref_articulo": {{"type": "string"' || CASE WHEN requiere_ref_articulo THEN ', "minLength": 1' ELSE '' END || '}}}}}}') AS line FROM el GROUP BY ALL)
SELECT fase, count(*) AS fields, '{{"type": "object", "properties": {{' || string_agg(line, ', ' ORDER BY id) || '}}}}' AS schema FROM one GROUP BY fase""".replace("AS line FROM el GROUP BY ALL", "AS line FROM el GROUP BY 1, 2"))
def tax_ficha_schema(spark, sf_dir):
    return X.record_schema(_elements(spark, sf_dir))


@query(f"""WITH {_EL}, one AS (SELECT categoria, id, min(lower(replace(id, '.', '_')) || ' ' || CASE tipo_campo WHEN 'fecha' THEN 'DATE' ELSE 'TEXT' END) AS line FROM el GROUP BY 1, 2)
SELECT 'valores_cat_' || lower(categoria) AS table_name, count(*) AS n_columns, 'CREATE TABLE valores_cat_' || lower(categoria) || ' (id_ficha TEXT PRIMARY KEY, ' || string_agg(line, ', ' ORDER BY id) || ');' AS statement FROM one GROUP BY categoria""")
def tax_ddl(spark, sf_dir):
    return X.ddl(_elements(spark, sf_dir))


# Whole documents as lines; the fingerprint of a category's source has no SQL form and is tested apart.
_CATEGORY_NAMES, _PHASE_NAMES = (", ".join(f"({k!r}, '{v}')" for k, v in names.items()) for names in (X.CATEGORY_NAMES, O.PHASE_NAMES))


@query(f"""WITH {_EL}, names AS (SELECT * FROM (VALUES {_CATEGORY_NAMES}) AS t(categoria, name)), ranked AS (SELECT *, row_number() OVER (PARTITION BY categoria ORDER BY id, nombre NULLS FIRST) - 1 AS "at" FROM el),
facts AS (SELECT categoria, count(*) AS n, min_by(fase_lectura, "at") AS fase, string_agg(DISTINCT origen, ', ' ORDER BY origen) AS origins FROM ranked GROUP BY categoria), f AS (SELECT categoria, unnest(['| Categoria      | ' || categoria || ' |', '| Elementos      | ' || n || ' |', '| Fase principal | ' || fase || ' |', '| Origenes       | ' || origins || ' |']) AS line, unnest([0, 1, 2, 3]) AS "at" FROM facts)
SELECT categoria, CAST(0 AS INT) AS section, CAST(0 AS BIGINT) AS "at", '# CATEGORIA ' || categoria || ' — ' || coalesce(name, '') AS line FROM (SELECT DISTINCT categoria FROM el) LEFT JOIN names USING (categoria)
UNION ALL SELECT DISTINCT categoria, 0, 1, '# NP-CAT-' || categoria || '  v1.0  2024-01-01' FROM el
UNION ALL SELECT categoria, 1, "at", CASE WHEN length(id) < 5 THEN rpad(id, 5, ' ') ELSE id END || ' ' || CASE WHEN length(coalesce(nombre, '')) < 37 THEN rpad(coalesce(nombre, ''), 37, ' ') ELSE nombre END || ' ' || descripcion || CASE WHEN origen <> 'base' THEN ' [' || upper(origen) || ']' ELSE '' END FROM ranked
UNION ALL SELECT categoria, 2, "at", line FROM f""")
def tax_category_document(spark, sf_dir):
    return O.category_documents(_placed_elements(spark, sf_dir), "1.0", "2024-01-01").where("NOT startswith(line, '| Hash fuente')")


# The pages whole, but for the fingerprint of their source, which has no SQL form.
_PAGE_ROWS = ", ".join(f"({block}, {i}, '{line}')" for block, rows in ((1, O.PAGE_DEFINITION), (3, O.PAGE_FACTS), (5, [""])) for i, line in enumerate(rows))


@query(f"""WITH {_EL}, names AS (SELECT * FROM (VALUES {_CATEGORY_NAMES}) AS t(categoria, name)), ranked AS (SELECT *, row_number() OVER (PARTITION BY categoria ORDER BY id, nombre NULLS FIRST) - 1 AS "at" FROM el),
facts AS (SELECT categoria, count(*) AS n, min_by(fase_lectura, "at") AS fase, string_agg(DISTINCT origen, ', ' ORDER BY origen) AS origins FROM ranked GROUP BY categoria), f AS (SELECT categoria, unnest(['| Categoria      | ' || categoria || ' |', '| Elementos      | ' || n || ' |', '| Fase principal | ' || fase || ' |', '| Origenes       | ' || origins || ' |']) AS line, unnest([0, 1, 2, 3]) AS "at" FROM facts)
SELECT categoria, block, CAST(i AS BIGINT) AS "at", replace(replace(line, '{{source}}', 'part'), '{{n}}', CAST(n AS VARCHAR)) AS line FROM facts, (VALUES {_PAGE_ROWS}) AS t(block, i, line)
UNION ALL SELECT categoria, 0, CAST(0 AS BIGINT), '# CATEGORIA ' || categoria || ' — ' || coalesce(name, '') FROM (SELECT DISTINCT categoria FROM el) LEFT JOIN names USING (categoria)
UNION ALL SELECT DISTINCT categoria, 0, 1, '# NP-CAT-' || categoria || '  v1.0  2024-01-01' FROM el
UNION ALL SELECT categoria, 2, "at", CASE WHEN length(id) < 5 THEN rpad(id, 5, ' ') ELSE id END || ' ' || CASE WHEN length(coalesce(nombre, '')) < 37 THEN rpad(coalesce(nombre, ''), 37, ' ') ELSE nombre END || ' ' || descripcion || CASE WHEN origen <> 'base' THEN ' [' || upper(origen) || ']' ELSE '' END FROM ranked
UNION ALL SELECT categoria, 4, "at", line FROM f""")
def tax_category_pages(spark, sf_dir):
    return O.category_pages_whole(_placed_elements(spark, sf_dir), "1.0", "2024-01-01", "part").where("NOT startswith(line, '| Hash fuente')")


_CLOSING = ", ".join(f"({i}, '{line}')" for i, line in enumerate([*O.SUMMARY, *[f"- [ ] {what} ... {points} pts" for what, points in O.QUALITY], f"**PUNTUACION TOTAL: _____ / {sum(p for _, p in O.QUALITY)}**"], 1))


@query(f"""WITH {_EL}, names AS (SELECT * FROM (VALUES {_PHASE_NAMES}) AS t(fase, name)), k AS (SELECT CAST(fase_lectura AS BIGINT) AS fase, categoria, id, nombre, requiere_ref_articulo AS need, row_number() OVER (PARTITION BY fase_lectura, categoria ORDER BY id, nombre NULLS FIRST) AS "at" FROM el), ph AS (SELECT DISTINCT fase FROM k)
SELECT fase, '' AS categoria, CAST(0 AS BIGINT) AS "at", CAST(0 AS BIGINT) AS part, 'FASE ' || fase || ' — ' || coalesce(name, '') AS line FROM ph LEFT JOIN names USING (fase)
UNION ALL SELECT fase, '~', 0, 0, '**Decision Fase ' || fase || ':** [ ] CONTINUAR  [ ] PAUSAR  [ ] ABANDONAR' FROM ph UNION ALL SELECT fase, '~', 1, 0, '**Firma:** {O.BLANK}  **Fecha:** {O.BLANK}' FROM ph
UNION ALL SELECT fase, categoria, 0, 0, '### Categoria ' || categoria || ' (' || count(*) || ' elementos)' FROM k GROUP BY 1, 2
UNION ALL SELECT fase, categoria, "at", 0, '- [ ] **' || id || '** — ' || coalesce(nombre, '') FROM k UNION ALL SELECT fase, categoria, "at", 1, '  - VALOR: {O.BLANK}' FROM k UNION ALL SELECT fase, categoria, "at", 2, '  - REF. ARTICULO: {O.BLANK}' || CASE WHEN need THEN ' (obligatorio)' ELSE '' END FROM k UNION ALL SELECT fase, categoria, "at", 3, '  - NOTAS: {O.BLANK}' FROM k
UNION ALL SELECT -1, '', i, 0, line FROM (SELECT unnest([0, 1, 2, 3]) AS i, unnest(['# NP-FICHA  v1.0  2024-01-01', '**Total de campos:** ' || count(*), '**Categorias:** ' || count(DISTINCT categoria) || ' (' || string_agg(DISTINCT categoria, ', ' ORDER BY categoria) || ')', '**Fases:** ' || count(DISTINCT fase) || ' (' || array_to_string(list_sort(list_distinct(list(fase))), ', ') || ')']) AS line FROM k)
UNION ALL SELECT 99, '', 0, 0, 'Elementos completados: _____ / ' || count(*) FROM k UNION ALL SELECT 99, '', i, 0, line FROM (VALUES {_CLOSING}) AS t(i, line)""")
def tax_form_document(spark, sf_dir):
    return O.form_document(_placed_elements(spark, sf_dir), "1.0", "2024-01-01")


_FIXED_PARTS = ", ".join(f"('{part}', '{name}', '{json.dumps(body)}')" for part, name, body in [*[("meta", k, x) for k, x in O.META.items()], ("evidencia", "", O.EVIDENCE)])


@query(f"""WITH {_EL} SELECT CAST(fase_lectura AS VARCHAR) AS part, id AS name, CASE WHEN bool_or(requiere_ref_articulo) AND NOT bool_and(requiere_ref_articulo) THEN greatest(max(x), max(y)) ELSE max(CASE WHEN requiere_ref_articulo THEN x ELSE y END) END AS body FROM (SELECT *, '{{"type": "object", "properties": {{"completado": {{"type": "boolean"}}, "na": {{"type": "boolean"}}, "valor": {{"type": "string"}}, "ref_articulo": {{"type": "string"' AS a, '}}, "notas": {{"type": "string"}}}}}}' AS z, a || ', "minLength": 1' || z AS x, a || z AS y FROM el) GROUP BY 1, 2 UNION ALL SELECT part, name, body FROM (VALUES {_FIXED_PARTS}) AS t(part, name, body)""")
def tax_schema_parts(spark, sf_dir):
    return O.schema_parts(_elements(spark, sf_dir))


# The whole SQL model; a test compares it with the statements that it should have.
@query()
def tax_model(spark, sf_dir):
    return X.relational_model(_elements(spark, sf_dir))


@query(f"""WITH {_EL}, lines AS (SELECT CAST(fase_lectura AS BIGINT) AS fase, categoria, id, '- [ ] ' || id || ' ' || coalesce(nombre, '') || CASE WHEN requiere_ref_articulo THEN ' (art.)' ELSE '' END AS line FROM el) SELECT fase, categoria, string_agg(line, chr(10) ORDER BY id, line) AS section FROM lines GROUP BY 1, 2""")
def tax_form(spark, sf_dir):
    return X.reading_form(_elements(spark, sf_dir))


_NARR = "'Ver ' || chr(65 + CAST(doc_id % 14 AS INT)) || '.' || doc_id || ' y A.1a. '"


@query(f"WITH {_EL}, n AS (SELECT doc_id, list_distinct(regexp_extract_all({_NARR} || text, '[A-Z]\\.[0-9]+[a-z]?')) AS refs FROM documents), r AS (SELECT doc_id, unnest(refs) AS ref FROM n) SELECT * FROM r WHERE ref NOT IN (SELECT id FROM el)")
def narrative_refs(spark, sf_dir):
    prefix = F.concat(F.lit("Ver "), F.char(65 + F.col("doc_id") % 14), F.lit("."), "doc_id", F.lit(" y A.1a. "))
    return X.broken_references(table(spark, sf_dir, "documents").select("doc_id", F.concat(prefix, "text").alias("text")), _elements(spark, sf_dir), "doc_id")


@query(f"""WITH {_EL}, l AS (SELECT doc_id, unnest(string_split(text, {LF})) AS line, generate_subscripts(string_split(text, {LF}), 1) AS line_no FROM documents),
said AS (SELECT doc_id, line_no, CASE (doc_id + line_no) % 9 WHEN 2 THEN 'fases' WHEN 5 THEN 'fases' WHEN 4 THEN 'categorias' ELSE 'elementos' END AS what, (doc_id + line_no) % 300 AS stated FROM l WHERE (doc_id + line_no) % 9 IN (1, 2, 3, 4, 5, 6)),
t AS (SELECT 'elementos' AS what, count(*) AS computed FROM el UNION ALL SELECT 'fases', count(DISTINCT fase_lectura) FROM el UNION ALL SELECT 'categorias', count(DISTINCT categoria) FROM el) SELECT DISTINCT doc_id, CAST(line_no AS BIGINT) AS line_no, what, stated, computed FROM said JOIN t USING (what) WHERE stated <> computed""")
def narrative_totals(spark, sf_dir):
    # Every line but some states a total, in one of the six ways, and goes on with its text's letters.
    n, rest = "(doc_id + line_no) % 300", "' ' || translate(line, '0123456789:=|', '')"
    line = F.expr(f"CASE (doc_id + line_no) % 9 WHEN 0 THEN '2024-01-01 total elementos: 7' WHEN 1 THEN 'Total de elementos: ' || {n} || {rest} WHEN 2 THEN 'Son ' || {n} || ' fases' || {rest} WHEN 3 THEN 'Elementos totales = ' || {n} || {rest} WHEN 4 THEN '| Categorias | ' || {n} || ' |' || {rest} WHEN 5 THEN 'fases de lectura: ' || {n} || {rest} WHEN 6 THEN 'Elementos | ' || {n} || {rest} ELSE translate(line, '0123456789:=|', '') END")
    rows = corpus.lines(table(spark, sf_dir, "documents"), "doc_id")
    return X.stale_totals(rows.select("doc_id", "line_no", line.alias("line")), _elements(spark, sf_dir), "doc_id")


# A record for each document; some have no evidence.
def _records(spark, sf_dir):
    d = docs(spark, sf_dir)
    rid = "CASE WHEN doc_id % 60 = 1 THEN 'bad' ELSE 'NP-FICHA-LEY-' || doc_id || '-1994-1' END AS record_id"
    meta = d.selectExpr("doc_id AS record", rid, "CASE WHEN doc_id % 80 = 2 THEN 'nueva' ELSE 'abierta' END AS estado", "CASE WHEN doc_id % 100 = 3 THEN 'a/' || filename ELSE filename END AS norma_archivo", "CASE WHEN doc_id % 40 = 0 THEN 'zz' WHEN doc_id % 40 = 1 THEN sha2('other', 256) ELSE sha2('corpus', 256) END AS hash")
    fields = d.selectExpr("doc_id AS record", "explode(array(named_struct('campo', 'A.' || (1 + doc_id % 9), 'i', 0), named_struct('campo', 'B.' || (1 + doc_id % 7), 'i', 1))) AS f", "doc_id").selectExpr("record", "(doc_id + f.i) % 10 AS fase", "f.campo AS campo", "doc_id % 5 <> 4 AS completado", "doc_id % 7 = 6 AS na", "'v' AS valor", "CASE WHEN doc_id % 3 = 0 THEN 'art. 1' ELSE ' ' END AS ref_articulo")
    ev = d.where("doc_id % 60 <> 50").selectExpr("doc_id AS record", "0L AS pos", "CASE WHEN doc_id % 60 = 20 THEN 'x' WHEN doc_id % 60 = 21 THEN 'M.9999' ELSE 'A.' || (1 + doc_id % 9) END AS campo", "CASE WHEN doc_id % 60 = 22 THEN 'none' WHEN doc_id % 60 = 40 THEN filename || '#L90000' ELSE filename || '#L1' END AS cita", "CASE WHEN doc_id % 60 = 23 THEN 'foto' ELSE 'texto' END AS tipo", "CASE WHEN doc_id % 60 = 41 THEN '' WHEN doc_id % 60 = 42 THEN 'not there at all' ELSE left(split(text, '\n')[0], 30) END AS verbatim")
    return meta, fields, ev


_REC = f"{DOCS}, d AS (SELECT * FROM docs)"
_FORMED = "doc_id % 60 <> 22 AND doc_id % 60 <> 41 AND trim(left(split_part(text, chr(10), 1), 30)) <> ''"


@query(f"WITH {_REC}, m AS (SELECT doc_id AS record, CASE WHEN doc_id % 60 = 1 THEN 'bad' ELSE 'NP-FICHA-LEY-' || doc_id || '-1994-1' END AS detail, doc_id FROM d) SELECT record, 'V1:id' AS code, detail FROM m WHERE doc_id % 60 = 1 UNION ALL SELECT record, 'V1:estado', detail FROM m WHERE doc_id % 80 = 2 UNION ALL SELECT record, 'V1:norma', detail FROM m WHERE doc_id % 100 = 3 UNION ALL SELECT record, 'V1:hash', detail FROM m WHERE doc_id % 40 = 0")
def ficha_rules_v1(spark, sf_dir):
    return R.meta_rules(_records(spark, sf_dir)[0])


@query(f"WITH {_REC} SELECT doc_id AS record, 'V2:other_corpus' AS code, CASE WHEN doc_id % 60 = 1 THEN 'bad' ELSE 'NP-FICHA-LEY-' || doc_id || '-1994-1' END AS detail FROM d WHERE doc_id % 40 = 1")
def ficha_rules_v2(spark, sf_dir):
    return R.seal_rules(_records(spark, sf_dir)[0], hashlib.sha256(b"corpus").hexdigest())


_FIELDS = f"{_REC}, {_EL}, known AS (SELECT id AS campo, min(fase_lectura) AS canonical, bool_or(requiere_ref_articulo) AS needs FROM el GROUP BY id), ev AS (SELECT doc_id AS record, CASE WHEN doc_id % 60 = 20 THEN 'x' WHEN doc_id % 60 = 21 THEN 'M.9999' ELSE 'A.' || (1 + doc_id % 9) END AS campo FROM d WHERE doc_id % 60 <> 50), f AS (SELECT doc_id AS record, doc_id, 'A.' || (1 + doc_id % 9) AS campo, doc_id % 10 AS fase FROM d UNION ALL SELECT doc_id, doc_id, 'B.' || (1 + doc_id % 7), (doc_id + 1) % 10 FROM d), ff AS (SELECT *, doc_id % 5 <> 4 AND doc_id % 7 <> 6 AS done, (record, campo) IN (SELECT record, campo FROM ev) AS proven FROM f)"


@query(f"WITH {_FIELDS}, j AS (SELECT * FROM ff JOIN known USING (campo)) SELECT record, 'V3:misplaced' AS code, campo AS detail FROM j WHERE fase <> canonical UNION ALL SELECT record, 'V3:no_reference', campo FROM j WHERE done AND needs AND doc_id % 3 <> 0 UNION ALL SELECT record, 'V3:no_evidence', campo FROM j WHERE done AND NOT proven UNION ALL SELECT doc_id, 'V3:empty_evidence', 'NP-FICHA-LEY-' || doc_id || '-1994-1' FROM d WHERE doc_id % 60 = 50")
def ficha_rules_v3(spark, sf_dir):
    meta, fields, ev = _records(spark, sf_dir)
    return R.field_rules(fields, ev, _elements(spark, sf_dir)).unionByName(R.presence_rules(meta, ev))


@query(f"WITH {_REC}, {_EL}, e AS (SELECT doc_id AS record, doc_id, text, CASE WHEN doc_id % 60 = 20 THEN 'x' WHEN doc_id % 60 = 21 THEN 'M.9999' ELSE 'A.' || (1 + doc_id % 9) END AS campo FROM d WHERE doc_id % 60 <> 50), t AS (SELECT *, campo || '#0' AS detail FROM e) SELECT record, 'V4:campo' AS code, detail FROM t WHERE campo = 'x' UNION ALL SELECT record, 'V4:unknown_field', detail FROM t WHERE campo <> 'x' AND campo NOT IN (SELECT id FROM el) UNION ALL SELECT record, 'V4:cita', detail FROM t WHERE doc_id % 60 = 22 UNION ALL SELECT record, 'V4:tipo', detail FROM t WHERE doc_id % 60 = 23 UNION ALL SELECT record, 'V4:verbatim', detail FROM t WHERE doc_id % 60 = 41 OR doc_id % 60 <> 42 AND trim(left(split_part(text, chr(10), 1), 30)) = ''")
def ficha_rules_v4(spark, sf_dir):
    return R.evidence_rules(_records(spark, sf_dir)[2], _elements(spark, sf_dir))


@query(f"WITH {_REC} SELECT doc_id AS record, CASE WHEN doc_id % 60 = 40 THEN 'V5:bad_range' ELSE 'V5:not_found' END AS code, CASE WHEN doc_id % 60 = 20 THEN 'x' WHEN doc_id % 60 = 21 THEN 'M.9999' ELSE 'A.' || (1 + doc_id % 9) END || '#0' AS detail FROM d WHERE {_FORMED} AND doc_id % 60 IN (40, 42)")
def ficha_rules_v5(spark, sf_dir):
    return R.verbatim_rules(_records(spark, sf_dir)[2], docs(spark, sf_dir))


@query(f"WITH {_FIELDS} SELECT record, count(*) FILTER (done) AS completed, count(*) FILTER (doc_id % 7 = 6) AS not_applicable, count(*) FILTER (done AND proven) AS proven, count(*) FILTER (done) = 0 AS warning FROM ff GROUP BY record")
def evidence_coverage(spark, sf_dir):
    _, fields, ev = _records(spark, sf_dir)
    return R.coverage(fields, ev)


# The director, over conversations as documents and events as its log.
_ANCHORS = {"start": "^## (system|user) 0", "answer": "^## assistant", "mention": "the and", "across": "1 [a-zà-ü]+ ", "never": "xyzzy"}


@query(f"""WITH {CHUNKED}, s AS (SELECT conv_id, string_split(text, chr(10)) AS l FROM chunked), r AS (SELECT conv_id, unnest(l) AS line, generate_subscripts(l, 1) AS line_no FROM s), two AS (SELECT *, {FLAT.format("line || coalesce(' ' || lead(line) OVER (PARTITION BY conv_id ORDER BY line_no), '')")} AS two FROM r),
f AS ({' UNION ALL '.join(f"SELECT conv_id, '{n}' AS anchor, coalesce(min(line_no) FILTER (regexp_matches(line, '(?i){p}')), min(line_no) FILTER (regexp_matches(two, '(?i){p}'))) AS line_no FROM two GROUP BY conv_id" for n, p in _ANCHORS.items())}) SELECT conv_id, anchor, line_no FROM f WHERE line_no IS NOT NULL""")
def anchors(spark, sf_dir):
    return D.anchors(corpus.lines(chunked(spark, sf_dir), "conv_id"), _ANCHORS, "conv_id")


def _tasks(spark):
    return spark.createDataFrame([("T1", 0, "A", "a", "b"), ("T2", 1, "", "b", "c"), ("T3", 2, "C", "c", "d"), ("T4", 3, "", "d", "none")], "task string, fase bigint, prefix string, first string, last string")


@query(f"""WITH {_EL}, t AS (SELECT * FROM (VALUES ('T1', 0, 'A', 5, 8), ('T2', 1, '', 9, 19), ('T3', 2, 'C', 20, 24), ('T4', 3, '', 25, 27)) AS t(task, fase, prefix, l1, l2))
SELECT task, CAST(fase AS BIGINT) AS fase, coalesce((SELECT string_agg(DISTINCT id, ',' ORDER BY id) FROM el WHERE fase_lectura = fase AND starts_with(id, prefix)), '') AS objectives, CAST(l1 AS BIGINT) AS l1, CAST(l2 AS BIGINT) AS l2 FROM t""")
def plan_tasks(spark, sf_dir):
    spots = spark.createDataFrame([("a", 5), ("b", 9), ("c", 20), ("d", 25)], "anchor string, line_no bigint")
    return D.plan(_elements(spark, sf_dir), _tasks(spark), spots, 200)


@query(f"WITH {_LINES} SELECT filename, CAST(1 AS BIGINT) AS fragment, left(string_agg(line_no || chr(9) || line, chr(10) ORDER BY line_no), 500) AS body, least(500, length(string_agg(line_no || chr(9) || line, chr(10) ORDER BY line_no))) AS n_chars FROM rows_ WHERE line_no BETWEEN 2 AND 6 GROUP BY filename")
def fragment_delivery(spark, sf_dir):
    d = docs(spark, sf_dir)
    spans = d.selectExpr("filename", "1L AS fragment", "2L AS l1", "6L AS l2")
    return D.deliver(corpus.lines(d, "filename"), spans, "filename", 500)


_ANSWERS = "(VALUES ('A.1', 'v', 'OWN#L1', '', 'art'), ('A.2', ' ', 'OWN#L1', '', ''), ('A.3', 'v', 'nothing', '', ''), ('A.4', 'v', 'doc-0000000008.md#L1', '', 'art'), ('Z.9', 'v', 'OWN#L1', '', ''), ('A.5', 'v', 'OWN#L9999', '', 'art'), ('A.6', 'v', 'OWN#L1', 'surely absent 123', 'art')) AS t(campo, valor, cita, verbatim, ref)"


@query(rf"""WITH {DOCS}, an AS (SELECT campo, valor, replace(cita, 'OWN', 'doc-0000000007.md') AS cita, verbatim, ref, regexp_extract(cita, '^(.+\.md)#L', 1) AS file FROM (SELECT campo, valor, replace(cita, 'OWN', 'doc-0000000007.md') AS cita, verbatim, ref FROM {_ANSWERS})), ob AS (SELECT 'A.' || i AS campo, i % 2 = 0 AS need FROM range(1, 10) AS t(i)), sk AS (SELECT * FROM (VALUES ('Q.1', 'r'), ('A.1', 'r'), ('A.7', ' ')) AS t(campo, motivo)),
c AS (SELECT an.*, need, need IS NOT NULL AS asked, string_split(d.text, chr(10)) AS l, CAST(nullif(regexp_extract(cita, '#L(\d+)$', 1), '') AS BIGINT) AS n FROM an LEFT JOIN ob USING (campo) LEFT JOIN docs d ON d.filename = an.file)
SELECT 'T1' AS task, code, campo FROM (SELECT 'not_an_objective' AS code, campo FROM c WHERE NOT asked UNION ALL SELECT 'blank_value', campo FROM c WHERE asked AND trim(valor) = '' UNION ALL SELECT 'malformed_citation', campo FROM c WHERE asked AND n IS NULL UNION ALL SELECT 'other_file', campo FROM c WHERE asked AND n IS NOT NULL AND file <> 'doc-0000000007.md' UNION ALL SELECT 'no_reference', campo FROM c WHERE asked AND need AND trim(ref) = ''
UNION ALL SELECT 'bad_range', campo FROM c WHERE asked AND l IS NOT NULL AND n NOT BETWEEN 1 AND len(l) UNION ALL SELECT 'not_found', campo FROM c WHERE asked AND n BETWEEN 1 AND len(l) AND NOT contains({FOLD.format('l[n]')}, verbatim)
UNION ALL SELECT 'skips_no_objective', campo FROM sk WHERE campo NOT IN (SELECT campo FROM ob) UNION ALL SELECT 'skips_answered', campo FROM sk WHERE campo IN (SELECT campo FROM ob) AND campo IN (SELECT campo FROM an) UNION ALL SELECT 'no_reason', campo FROM sk WHERE campo IN (SELECT campo FROM ob) AND trim(motivo) = '' UNION ALL SELECT 'unanswered', campo FROM ob WHERE campo NOT IN (SELECT campo FROM an UNION SELECT campo FROM sk) AND campo <> 'A.9')""")
def response_rules(spark, sf_dir):
    own = "doc-0000000007.md"
    answers = spark.createDataFrame([("T1", "A.1", "v", f"{own}#L1", "", "art"), ("T1", "A.2", " ", f"{own}#L1", "", ""), ("T1", "A.3", "v", "nothing", "", ""), ("T1", "A.4", "v", "doc-0000000008.md#L1", "", "art"), ("T1", "Z.9", "v", f"{own}#L1", "", ""), ("T1", "A.5", "v", f"{own}#L9999", "", "art"), ("T1", "A.6", "v", f"{own}#L1", "surely absent 123", "art")], "task string, campo string, valor string, cita string, verbatim string, ref_articulo string")
    skipped = spark.createDataFrame([("T1", "Q.1", "r"), ("T1", "A.1", "r"), ("T1", "A.7", " ")], "task string, campo string, motivo string")
    objectives = spark.createDataFrame([("T1", f"A.{i}", i % 2 == 0) for i in range(1, 10)], "task string, campo string, needs_ref boolean")
    stored = spark.createDataFrame([("T1", "A.9")], "task string, campo string")
    return D.answer_rules(answers, skipped, objectives, docs(spark, sf_dir), own, stored, last=True)


# Answers about every document, with a fault of each kind at some modulus.
@query(f"""WITH {DOCS}, ob AS (SELECT doc_id, 'A.' || i AS campo, i % 2 = 0 AS need FROM docs, range(1, 6) AS t(i)),
an AS (SELECT doc_id, filename, text, 'A.1' AS campo, 'v' AS valor, filename || '#L1' AS cita, CASE WHEN doc_id % 8 = 0 THEN 'surely absent 123' ELSE '' END AS verbatim, 'art' AS ref FROM docs
UNION ALL SELECT doc_id, filename, text, 'A.2', CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE 'v' END, CASE WHEN doc_id % 9 = 0 THEN 'other.md#L1' ELSE filename || '#L1' END, '', CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'art' END FROM docs
UNION ALL SELECT doc_id, filename, text, 'A.3', 'v', CASE doc_id % 4 WHEN 0 THEN 'nothing' WHEN 1 THEN filename || '#L99999' ELSE filename || '#L1' END, '', '' FROM docs UNION ALL SELECT doc_id, filename, text, 'Z.9', 'v', 'nothing', '', '' FROM docs WHERE doc_id % 5 = 0),
sk AS (SELECT doc_id, 'A.4' AS campo, CASE WHEN doc_id % 6 = 0 THEN ' ' ELSE 'r' END AS motivo FROM docs UNION ALL SELECT doc_id, 'A.5', 'r' FROM docs WHERE doc_id % 7 <> 0 UNION ALL SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'A.1' ELSE 'Q.1' END, 'r' FROM docs WHERE doc_id % 11 = 0),
g AS (SELECT an.*, need, need IS NOT NULL AS asked, regexp_extract(cita, '^(.+\\.md)#L', 1) AS file, CAST(nullif(regexp_extract(cita, '#L([0-9]+)$', 1), '') AS BIGINT) AS n FROM an LEFT JOIN ob USING (doc_id, campo))
SELECT CAST(doc_id AS VARCHAR) AS task, code, campo FROM (SELECT doc_id, 'not_an_objective' AS code, campo FROM g WHERE NOT asked UNION ALL SELECT doc_id, 'blank_value', campo FROM g WHERE asked AND trim(valor) = '' UNION ALL SELECT doc_id, 'malformed_citation', campo FROM g WHERE asked AND n IS NULL
UNION ALL SELECT doc_id, 'other_file', campo FROM g WHERE asked AND n IS NOT NULL AND file <> filename UNION ALL SELECT doc_id, 'no_reference', campo FROM g WHERE asked AND need AND trim(ref) = '' UNION ALL SELECT doc_id, 'bad_range', campo FROM g WHERE asked AND file = filename AND n > len(string_split(text, {LF}))
UNION ALL SELECT doc_id, 'not_found', campo FROM g WHERE asked AND file = filename AND n = 1 AND NOT contains({FOLD.format(f'split_part(text, {LF}, 1)')}, verbatim) UNION ALL SELECT doc_id, 'skips_no_objective', campo FROM sk WHERE campo = 'Q.1' UNION ALL SELECT doc_id, 'skips_answered', campo FROM sk WHERE campo = 'A.1' UNION ALL SELECT doc_id, 'no_reason', campo FROM sk WHERE trim(motivo) = ''
UNION ALL SELECT doc_id, 'unanswered', 'A.5' FROM docs WHERE doc_id % 7 = 0)""")
def response_rules_all(spark, sf_dir):
    d = docs(spark, sf_dir)
    entry = lambda campo, valor, cita, verbatim, ref: f"named_struct('campo', '{campo}', 'valor', {valor}, 'cita', {cita}, 'verbatim', {verbatim}, 'ref_articulo', {ref})"
    own = "filename || '#L1'"
    answers = [
        entry("A.1", "'v'", own, "if(doc_id % 8 = 0, 'surely absent 123', '')", "'art'"),
        entry("A.2", "if(doc_id % 3 = 0, ' ', 'v')", f"if(doc_id % 9 = 0, 'other.md#L1', {own})", "''", "if(doc_id % 7 = 0, '', 'art')"),
        entry("A.3", "'v'", f"CASE doc_id % 4 WHEN 0 THEN 'nothing' WHEN 1 THEN filename || '#L99999' ELSE {own} END", "''", "''"),
    ]
    sent = d.selectExpr("cast(doc_id AS string) AS task", "filename AS file", f"inline(array({', '.join(answers)}))").unionByName(d.where("doc_id % 5 = 0").selectExpr("cast(doc_id AS string) AS task", "filename AS file", "'Z.9' AS campo", "'v' AS valor", "'nothing' AS cita", "'' AS verbatim", "'' AS ref_articulo"))
    skip = lambda where, campo, motivo: d.where(where).selectExpr("cast(doc_id AS string) AS task", f"{campo} AS campo", f"{motivo} AS motivo")
    skipped = skip("true", "'A.4'", "if(doc_id % 6 = 0, ' ', 'r')").unionByName(skip("doc_id % 7 <> 0", "'A.5'", "'r'")).unionByName(skip("doc_id % 11 = 0", "if(doc_id % 2 = 0, 'A.1', 'Q.1')", "'r'"))
    objectives = d.selectExpr("cast(doc_id AS string) AS task", "explode(sequence(1, 5)) AS i").selectExpr("task", "'A.' || i AS campo", "i % 2 = 0 AS needs_ref")
    none = spark.createDataFrame([], "task string, campo string")
    return D.answer_rules(sent, skipped, objectives, d, F.col("file"), none, last=True)


# Reading runs: every document is one, with two tasks and up to two fragments in the first.
_RUNS = f"{DOCS}, r AS (SELECT doc_id, filename, string_split(text, chr(10)) AS l, len(l) AS n FROM docs)"


def _first_version(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("run"), "filename", F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"))
    spots = d.selectExpr("run", "n_lines", "inline(array(named_struct('anchor', 'top', 'l1', 1L, 'l2', cast(null AS bigint)), named_struct('anchor', 'mid', 'l1', if(n_lines >= 4, 2L, null), 'l2', 4L)))").drop("n_lines")
    tasks = spark.createDataFrame([(0, "T1", 1, "identity", "A.", ["mid", "top"]), (1, "T2", 2, "force", "C.", ["top"])], "idx bigint, task string, fase bigint, titulo string, prefix string, names array<string>")
    plan = N.plan(tasks, spots, _elements(spark, sf_dir), d.select("run", "n_lines"))
    path = stored(spark, sf_dir, ("documents", "part"), lambda to: N.begin(plan, d.select("run", F.col("filename").alias("file")), to), "runs-0")
    return N.Version.load(spark, path)


# One call that checks every document against its seal, looks for its anchors and makes the state of those that hold.
@query(f"""WITH {_LINES}, two AS (SELECT doc_id, line, {FLAT.format("line || coalesce(' ' || lead(line) OVER (PARTITION BY doc_id ORDER BY line_no), '')")} AS two, line_no FROM rows_),
f AS (SELECT doc_id, coalesce(min(line_no) FILTER (regexp_matches(line, '(?i)the')), min(line_no) FILTER (regexp_matches(two, '(?i)the'))) AS mark FROM two GROUP BY doc_id),
p AS (SELECT doc_id, 'altered' AS code FROM docs WHERE doc_id % 50 = 0 UNION ALL SELECT doc_id, 'not_sealed' FROM docs WHERE doc_id % 70 = 1 UNION ALL SELECT doc_id, 'anchor_missing' FROM f WHERE mark IS NULL),
c AS (SELECT doc_id, string_agg(code, ',' ORDER BY code) AS problems FROM p GROUP BY doc_id)
SELECT CAST(doc_id AS VARCHAR) AS run, problems IS NULL AS started, coalesce(problems, '') AS problems, CASE WHEN problems IS NULL THEN mark END AS l1 FROM docs JOIN f USING (doc_id) LEFT JOIN c USING (doc_id)""")
def run_start(spark, sf_dir):
    d = docs(spark, sf_dir)
    runs = d.select(F.col("doc_id").cast("string").alias("run"), F.col("filename").alias("file"))
    sealed = M.manifest(d.where("doc_id % 70 <> 1").select("filename", F.when(F.col("doc_id") % 50 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text")), "filename")
    tasks = spark.createDataFrame([(0, "T1", 1, "identity", "A.", ["mark"])], "idx bigint, task string, fase bigint, titulo string, prefix string, names array<string>")

    def write(to: str) -> None:
        _, _, problems = N.start(d, sealed, runs, {"mark": "the"}, tasks, _elements(spark, sf_dir), {"version": "1.0", "fecha_analisis": "2024-01-01"}, f"{to}/run")
        problems.write.parquet(f"{to}/problems")

    path = stored(spark, sf_dir, ("documents", "part"), write, "runs-start")
    version, problems = N.Version.load(spark, f"{path}/run"), spark.read.parquet(f"{path}/problems")
    told = problems.groupBy("run").agg(F.array_join(F.array_sort(F.collect_list("code")), ",").alias("problems"))
    first = version.tasks.select("run", F.try_element_at("fragmentos", F.lit(1))["l1"].alias("l1"))
    return runs.select("run").join(version.state.select("run", F.lit(True).alias("started")), "run", "left").join(told, "run", "left").join(first, "run", "left").select("run", F.coalesce("started", F.lit(False)).alias("started"), F.coalesce("problems", F.lit("")).alias("problems"), "l1")


def _document_lines(spark, sf_dir):
    return corpus.lines(docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("run"), "text"), "run")


@query(f"""WITH {_RUNS}, {_EL}, o AS (SELECT count(DISTINCT id) AS k FROM el WHERE fase_lectura = 1 AND starts_with(id, 'A.')), t AS (SELECT *, least(n, 3) AS b, array_to_string(list_transform(range(1, CAST(least(n, 3) AS BIGINT) + 1), lambda i : i || chr(9) || l[i]), chr(10)) AS body FROM r)
SELECT CAST(doc_id AS VARCHAR) AS run, 'T1' AS task, '1/2' AS avance, CAST(1 AS BIGINT) AS de, CASE WHEN n >= 4 THEN CAST(2 AS BIGINT) ELSE 1 END AS de_total, CAST(1 AS BIGINT) AS l1, b AS l2, k AS objectives, left(body, 400) AS texto FROM t, o""")
def run_delivery(spark, sf_dir):
    found = N.next_delivery(_first_version(spark, sf_dir), _document_lines(spark, sf_dir), _elements(spark, sf_dir), 400)
    return found.select("run", "task", "avance", "de", "de_total", "l1", "l2", F.size("objetivos").cast("bigint").alias("objectives"), "texto")


def _submitted(spark, sf_dir):
    """One step: a good answer, one that cites another file, a fragment without changes, and nothing, by doc_id % 4."""
    elements, d = _elements(spark, sf_dir), docs(spark, sf_dir)
    campo = elements.where("fase_lectura = 1 AND startswith(id, 'A.')").agg(F.min("id").alias("campo"))
    answers = d.where("doc_id % 4 < 2").join(F.broadcast(campo)).selectExpr("cast(doc_id AS string) AS run", "'T1' AS task", "campo", "'v' AS valor", "CASE WHEN doc_id % 4 = 0 THEN filename || '#L1' ELSE 'other.md#L1' END AS cita", "left(split(text, '\n')[0], 10) AS verbatim", "'art. 1' AS ref_articulo", "'' AS notas", "'texto' AS tipo")
    skipped = spark.createDataFrame([], "run string, task string, campo string, motivo string")
    verified = d.where("doc_id % 4 = 2").selectExpr("cast(doc_id AS string) AS run")
    first = _first_version(spark, sf_dir)
    path = stored(spark, sf_dir, ("documents", "part"), lambda to: N.submit(first, answers, skipped, d, "2024-01-01T00:00:00Z", elements, to, verified), "runs-1")
    return N.Version.load(spark, path)


@query(f"""WITH {_RUNS}, {_EL}, o AS (SELECT count(DISTINCT id) AS k FROM el WHERE fase_lectura = 1 AND starts_with(id, 'A.')), s AS (SELECT *, doc_id % 4 AS m, CASE WHEN m = 0 THEN n >= 4 OR k = 1 WHEN m = 2 THEN true ELSE false END AS ok FROM r, o)
SELECT CAST(doc_id AS VARCHAR) AS run, CASE WHEN ok AND n < 4 THEN CAST(1 AS BIGINT) ELSE 0 END AS idx, CASE WHEN ok AND n >= 4 THEN CAST(1 AS BIGINT) ELSE 0 END AS cursor, CASE WHEN ok THEN CAST(1 AS BIGINT) ELSE 0 END AS entregas,
CASE WHEN m = 3 THEN NULL WHEN m = 2 THEN 'verificacion-sin-cambios' WHEN ok THEN 'aceptada' ELSE 'rechazada' END AS resultado, CASE WHEN m = 0 AND ok THEN CAST(1 AS BIGINT) ELSE 0 END AS fields FROM s""")
def run_submission(spark, sf_dir):
    v = _submitted(spark, sf_dir)
    counted = v.fields.groupBy("run").agg(F.count("*").alias("fields"))
    return v.state.join(v.log.select("run", "resultado"), "run", "left").join(counted, "run", "left").select("run", "idx", "cursor", "entregas", "resultado", F.coalesce("fields", F.lit(0)).cast("bigint").alias("fields"))


_LOG = "log AS (SELECT user_id % 8 AS task, event_id AS seq, 'A.' || event_id % 40 AS campo, event_type AS valor, event_type <> 'error' AS accepted, props AS response FROM events)"


def _log(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("user_id % 8 AS task", "event_id AS seq", "'A.' || event_id % 40 AS campo", "event_type AS valor", "event_type <> 'error' AS accepted", "props AS response")


_MERGED = f"{_LOG}, merged AS (SELECT task, campo, max_by(valor, seq) AS valor, count(DISTINCT valor) AS n_evidence, count(*) AS n_writes FROM log WHERE accepted GROUP BY 1, 2)"


@query(f"WITH {_MERGED} SELECT * FROM merged")
def merge_log(spark, sf_dir):
    return D.merge_log(_log(spark, sf_dir))


# Corrections of all events, in batches of twenty; a bad entry rejects its batch.
@query(f"""WITH {_MERGED}, c AS (SELECT event_id // 20 AS batch, user_id % 8 AS task, 'A.' || event_id % 60 AS campo, 'c' || event_id AS valor, event_id FROM events), good AS (SELECT batch FROM c GROUP BY batch HAVING bool_and(event_id % 91 <> 0 AND event_id % 77 <> 0)),
final AS (SELECT task, campo, max_by(valor, event_id) AS after FROM c WHERE batch IN (SELECT batch FROM good) GROUP BY 1, 2) SELECT task, campo, coalesce(after, valor) AS valor, valor AS before, after IS NOT NULL AS corrected FROM merged FULL JOIN final USING (task, campo)""")
def apply_corrections(spark, sf_dir):
    c = table(spark, sf_dir, "events").selectExpr("event_id", "event_id DIV 20 AS batch", "user_id % 8 AS task", "'A.' || event_id % 60 AS campo", "CASE WHEN event_id % 91 = 0 THEN ' ' ELSE 'c' || event_id END AS valor", "CASE WHEN event_id % 77 = 0 THEN 'x' ELSE 'f.md#L1' END AS cita", "true AS ref_ok")
    return D.apply_corrections(D.merge_log(_log(spark, sf_dir)), c, seq="event_id")


@query(f"WITH {_LOG} SELECT task, count(*) FILTER (accepted) AS deliveries, count(*) FILTER (NOT accepted) AS rejected, count(DISTINCT campo) FILTER (accepted) AS fields, round(count(DISTINCT campo) FILTER (accepted) / 50, 4) AS share FROM log GROUP BY task")
def task_progress(spark, sf_dir):
    return D.progress(_log(spark, sf_dir), 50)


@query(f"WITH {_LOG}, {_LINES.replace('docs AS', 'docs AS', 1)}, del AS (SELECT least(500, length(string_agg(line_no || chr(9) || line, chr(10)))) AS n FROM rows_ WHERE line_no BETWEEN 2 AND 6 GROUP BY filename) SELECT count(*) FILTER (accepted) AS entries, CAST(sum(length(response)) FILTER (accepted) AS BIGINT) AS response_chars, (SELECT CAST(sum(n) AS BIGINT) FROM del) AS delivered_chars FROM log")
def budget(spark, sf_dir):
    return D.budget(_log(spark, sf_dir), fragment_delivery(spark, sf_dir))


# What a finished run has shown: scores of the gold cases, and a hash of the fields that the log has led to.
@query(f"""WITH {_MERGED}, {_SCORED}, named AS (SELECT task || '/' || campo AS name, sha256(coalesce(valor, '')) AS h FROM merged), s AS (SELECT count(*) AS fields, sha256(string_agg(name || ':' || h || {LF}, '' ORDER BY name)) AS fields_hash FROM named),
g AS (SELECT count(*) FILTER (outcome = 'correct') AS mechanical, count(*) FILTER (outcome = 'citada-y-resuelta') AS human, count(*) AS total FROM outcomes)
SELECT '2024-01-01' AS created_at, mechanical, human, total, fields, fields_hash, sha256('{{"created_at": "2024-01-01", "fields": ' || fields || ', "fields_hash": "' || fields_hash || '", "gold": {{"human": ' || human || ', "mechanical": ' || mechanical || ', "total": ' || total || '}}}}') AS fingerprint FROM s, g""")
def run_certificate(spark, sf_dir):
    d = docs(spark, sf_dir)
    sealed = M.manifest(d, "filename")
    rows = gate.run(spark, {"integrity": lambda: M.integrity_diff(M.manifest(docs(spark, sf_dir), "filename"), sealed)})
    found = D.certificate(M.integrity_diff(sealed, sealed), gold_totals(spark, sf_dir), rows, D.merge_log(_log(spark, sf_dir)), "2024-01-01")
    gold = found["gold"]
    return spark.createDataFrame([(found["created_at"], gold["mechanical"], gold["human"], gold["total"], found["fields"], found["fields_hash"], found["fingerprint"])], "created_at string, mechanical bigint, human bigint, total bigint, fields bigint, fields_hash string, fingerprint string")


# Errata. RE2 has no lookarounds, so the oracle marks the pairs in two overlapping passes.
def _glued_rows(spark, sf_dir):
    rows = corpus.lines(docs(spark, sf_dir), "filename")
    return rows.select("filename", "line_no", F.when(F.col("line_no") % 2 == 0, F.regexp_replace("line", r"([a-z])[.,]? ([A-Z][a-z])", "$1$2")).otherwise(F.regexp_replace("line", r"^([A-Z]{2})", "1994$1")).alias("line"))


_GLUED = f"""{_LINES}, glued AS (SELECT filename, line_no, CASE WHEN line_no % 2 = 0 THEN regexp_replace(line, '([a-z])[.,]? ([A-Z][a-z])', '\\1\\2', 'g') ELSE regexp_replace(line, '^([A-Z]{{2}})', '1994\\1') END AS line FROM rows_),
fixed AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(line, '([a-záéíóúñ0-9])([A-ZÁÉÍÓÚÑ][a-záéíóúñ])', '\\1 \\2', 'g'), '([a-záéíóúñ0-9])([A-ZÁÉÍÓÚÑ][a-záéíóúñ])', '\\1 \\2', 'g'), '([0-9])([A-ZÁÉÍÓÚÑ]{{2,}}[a-záéíóúñ])', '\\1 \\2', 'g') AS f FROM glued)"""


@query(f"WITH {_GLUED} SELECT filename, line_no, left(trim(line), 160) AS before, left(trim(f), 160) AS after, length(f) - length(line) AS n_splits FROM fixed WHERE f <> line")
def glued_words(spark, sf_dir):
    return E.glued_words(_glued_rows(spark, sf_dir), "filename")


@query(f"WITH {_GLUED}, n AS (SELECT filename, count(*) AS n FROM fixed WHERE f <> line GROUP BY filename) SELECT filename, n, row_number() OVER (ORDER BY n DESC, filename) AS place FROM n")
def repair_order(spark, sf_dir):
    return numbered_rows(E.repair_summary(glued_words(spark, sf_dir), "filename"), "place")


@query(f"""WITH {_GLUED} SELECT filename, sha256(string_agg(f, {LF} ORDER BY line_no)) AS sha256 FROM fixed GROUP BY filename""")
def repair_version(spark, sf_dir):
    """A repaired corpus, written as a version of its own and read back."""
    def write(to: str) -> None:
        own = _glued_rows(spark, sf_dir).groupBy("filename").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"))
        E.write_version(E.apply_unglue(own), to, "repaired", "filename")

    path = stored(spark, sf_dir, "documents", write, "repaired")
    return spark.read.parquet(f"{path}/version=repaired").select("filename", T.sha256("text").alias("sha256"))


@query(f"WITH {_GLUED} SELECT filename, CAST(i AS BIGINT) AS span_id, count(*) AS n_lines FROM fixed, (VALUES (1, 1, 4), (2, 3, 30)) AS s(i, l1, l2) WHERE f <> line AND line_no BETWEEN l1 AND l2 GROUP BY 1, 2")
def errata_overlap(spark, sf_dir):
    return E.overlap(glued_words(spark, sf_dir), _errata_spans(docs(spark, sf_dir)), "filename")


def _errata_spans(d):
    return d.selectExpr("filename", "inline(array(named_struct('span_id', 1L, 'l1', 1L, 'l2', 4L), named_struct('span_id', 2L, 'l1', 3L, 'l2', 30L)))")


@query(f"WITH {DOCS}, e AS (SELECT filename, text, CASE WHEN doc_id % 2 = 0 THEN left(text, 25) ELSE 'the' END AS b FROM docs), n AS (SELECT *, (length(text) - length(replace(text, b, ''))) // length(b) AS n FROM e) SELECT filename, n AS n_found, CASE WHEN n = 1 THEN 'aplicada' WHEN n = 0 THEN 'no_encontrada' ELSE 'ambigua' END AS state, CASE WHEN n = 1 THEN replace(text, b, '<corregido>') ELSE text END AS text FROM n")
def unique_replace(spark, sf_dir):
    d = docs(spark, sf_dir)
    return E.unique_replace(d, d.selectExpr("filename", "CASE WHEN doc_id % 2 = 0 THEN left(text, 25) ELSE 'the' END AS buscar", "'<corregido>' AS reemplazar"), "filename")


@query(f"WITH {_LINES}, old AS (SELECT * FROM rows_ WHERE doc_id % 11 <> 0), new AS (SELECT filename, doc_id, line_no, CASE WHEN doc_id % 5 = 0 AND line_no % 3 = 0 THEN line || '.' ELSE line END AS line FROM rows_ WHERE doc_id % 13 <> 0 AND NOT (doc_id % 4 = 0 AND line_no > 5)), j AS (SELECT filename, o.line AS o, n.line AS n FROM old o FULL JOIN new n USING (filename, line_no)), g AS (SELECT filename, count(o) AS no, count(n) AS nn, count(*) FILTER (o IS DISTINCT FROM n) AS n_changed FROM j GROUP BY filename) SELECT filename, CASE WHEN no = 0 THEN 'NUEVO' WHEN nn = 0 THEN 'SIN_DESTINO' WHEN n_changed > 0 THEN 'MODIFICADO' ELSE 'SIN_CAMBIOS' END AS status, n_changed FROM g")
def dry_run_diff(spark, sf_dir):
    rows = corpus.lines(docs(spark, sf_dir), ["filename", "doc_id"])
    new = rows.where("doc_id % 13 <> 0 AND NOT (doc_id % 4 = 0 AND line_no > 5)").withColumn("line", F.expr("CASE WHEN doc_id % 5 = 0 AND line_no % 3 = 0 THEN line || '.' ELSE line END"))
    return E.dry_run(rows.where("doc_id % 11 <> 0"), new, "filename")


@query(f"WITH {_MANIFEST}, x AS (SELECT count(*) FILTER (doc_id % 97 = 0) + count(*) FILTER (doc_id % 97 <> 0 AND doc_id % 101 = 0) + count(*) FILTER (doc_id % 103 = 0) AS n FROM docs) SELECT CAST(0 AS BIGINT) AS position, 'lossless' AS stage, 'pass' AS outcome, CAST(0 AS BIGINT) AS violations UNION ALL SELECT 1, 'integrity', 'fail', n FROM x UNION ALL SELECT 2, 'taxonomy', 'not_run', NULL")
def gate_report(spark, sf_dir):
    d = docs(spark, sf_dir)
    checks = {
        "lossless": lambda: C.lossless(d, C.chunks(d, "filename"), "filename").where("NOT lossless"),
        "integrity": lambda: M.integrity_diff(M.manifest(_now(spark, sf_dir), "filename"), M.manifest(d, "filename")),
        "taxonomy": lambda: X.rules(_elements(spark, sf_dir)),
    }
    return gate.run(spark, checks, order=("lossless", "integrity", "taxonomy"))


@query("""SELECT event_id, sha256('{"k": ' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}') AS fingerprint FROM events""")
def canonical_fingerprint(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", canonical.json_fingerprint("props").alias("fingerprint"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2")
def log_tumbling(spark, sf_dir):
    return ingest.tumbling_log(table(spark, sf_dir, "events"), "ts", "event_type")


@query(f"WITH {DOCS}, expected AS (SELECT 'readme.md' AS filename UNION ALL SELECT 'doc-' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') || '.md' FROM part) SELECT filename FROM expected WHERE filename NOT IN (SELECT filename FROM docs)")
def narrative_missing(spark, sf_dir):
    named = table(spark, sf_dir, "part").select(F.format_string("doc-%010d.md", "p_partkey").alias("filename"))
    expected = spark.createDataFrame([("readme.md",)], "filename string").unionByName(named)
    return X.missing_files(expected, docs(spark, sf_dir))
