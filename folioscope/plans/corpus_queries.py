"""Queries of sealing, segmentation, search and gold cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunks as C
from ..operators import gold as G
from ..operators import manifest as M
from ..operators import positional as P
from ..operators import search as S
from ..sources import corpus
from .registry import CHUNKED, CHUNKS, DOCS, FLAT, FOLD, chunked, docs, query, stored, table

_MANIFEST = f"{DOCS}, sealed AS (SELECT filename, doc_id, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS bytes FROM docs)"
#: The current state: some documents gone, some changed, some new.
_CURRENT = (
    _MANIFEST
    + ", now AS (SELECT filename, doc_id, CASE WHEN doc_id % 101 = 0 THEN text || '!' ELSE text END AS text FROM docs WHERE doc_id % 97 <> 0 UNION ALL SELECT 'new-' || filename, doc_id, text FROM docs WHERE doc_id % 103 = 0), current AS (SELECT filename, sha256(text) AS sha256 FROM now)"
)


def _now(spark, sf_dir):
    d = docs(spark, sf_dir)
    kept = d.where("doc_id % 97 <> 0").withColumn("text", F.when(F.col("doc_id") % 101 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return kept.unionByName(d.where("doc_id % 103 = 0").withColumn("filename", F.concat(F.lit("new-"), "filename")))


@query(f"WITH {_MANIFEST} SELECT filename, sha256, bytes FROM sealed")
def manifest_docs(spark, sf_dir):
    return M.manifest(docs(spark, sf_dir), "filename")


@query(f"WITH {_MANIFEST} SELECT count(*) AS file_count, CAST(sum(bytes) AS BIGINT) AS total_bytes, sha256(string_agg(filename || ':' || sha256 || chr(10), '' ORDER BY filename)) AS set_hash FROM sealed")
def manifest_set_hash(spark, sf_dir):
    return M.set_hash(M.manifest(docs(spark, sf_dir), "filename"))


@query(f"""WITH {_CURRENT} SELECT filename, CASE WHEN s.sha256 IS NULL THEN 'added' WHEN c.sha256 IS NULL THEN 'removed' ELSE 'modified' END AS status, s.sha256 AS sealed_sha, c.sha256 AS current_sha
FROM sealed s FULL JOIN current c USING (filename) WHERE s.sha256 IS DISTINCT FROM c.sha256""")
def integrity_diff(spark, sf_dir):
    return M.integrity_diff(M.manifest(_now(spark, sf_dir), "filename"), M.manifest(docs(spark, sf_dir), "filename"))


def _seal(spark, sf_dir):
    """The documents' seal, written once, and that of the current state, an update of it that holds what changed."""
    base = stored(spark, sf_dir, "documents", lambda to: M.Seal.write(M.manifest(docs(spark, sf_dir), "filename"), to, 2), "seal")
    seal = M.Seal.open(spark, [base])
    d = docs(spark, sf_dir)
    gone = d.where("doc_id % 97 = 0").selectExpr("filename", "cast(null AS string) AS sha256", "0L AS bytes")
    other = d.where("doc_id % 97 <> 0 AND doc_id % 101 = 0").select("filename", F.concat("text", F.lit("!")).alias("text"))
    new = d.where("doc_id % 103 = 0").select(F.concat(F.lit("new-"), "filename").alias("filename"), "text")
    changes = gone.unionByName(M.manifest(other.unionByName(new), "filename"))
    now = stored(spark, sf_dir, "documents", lambda to: seal.update(changes, to), "seal-now")
    return seal, M.Seal.open(spark, [base, now])


@query(f"""WITH {_CURRENT} SELECT filename, CASE WHEN s.sha256 IS NULL THEN 'added' WHEN c.sha256 IS NULL THEN 'removed' ELSE 'modified' END AS status, s.sha256 AS sealed_sha, c.sha256 AS current_sha
FROM sealed s FULL JOIN current c USING (filename) WHERE s.sha256 IS DISTINCT FROM c.sha256""")
def seal_diff(spark, sf_dir):
    seal, now = _seal(spark, sf_dir)
    return seal.diff(now)


@query(f"""WITH {_CURRENT}, i AS (SELECT filename FROM now WHERE doc_id % 89 <> 0)
SELECT 'disk_not_indexed' AS difference, filename FROM (SELECT filename FROM now EXCEPT SELECT filename FROM i)
UNION ALL SELECT 'indexed_not_on_disk', filename FROM (SELECT filename FROM i EXCEPT SELECT filename FROM now)
UNION ALL SELECT 'sealed_not_indexed', filename FROM (SELECT filename FROM sealed EXCEPT SELECT filename FROM i)
UNION ALL SELECT 'indexed_not_sealed', filename FROM (SELECT filename FROM i EXCEPT SELECT filename FROM sealed)""")
def coverage_report(spark, sf_dir):
    now = _now(spark, sf_dir)
    return M.coverage(now.where("doc_id % 89 <> 0"), now, docs(spark, sf_dir))


@query(f"WITH {DOCS} SELECT filename, i AS line_no, string_split(text, chr(10))[i] AS line FROM docs, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i)")
def lines_numbered(spark, sf_dir):
    return corpus.lines(docs(spark, sf_dir), "filename")


@query(f"WITH {DOCS} SELECT filename, CASE WHEN doc_id % 5 = 0 AND NOT regexp_matches(text, '[^\\x00-\\xFF]') AND length(text) <> octet_length(encode(text)) THEN 'latin-1' ELSE 'utf-8' END AS encoding, sha256(text) AS text_sha256, true AS reversible FROM docs")
def decode_lossless(spark, sf_dir):
    # Every fifth document is in Latin-1 if it can be.
    latin = (F.col("doc_id") % 5 == 0) & ~F.col("text").rlike(r"[^\x00-\xFF]")
    raw = docs(spark, sf_dir).select("filename", F.when(latin, F.encode("text", "ISO-8859-1")).otherwise(F.col("text").cast("binary")).alias("content"))
    text, encoding = corpus.decode("content")
    read = raw.select("filename", "content", text.alias("text"), encoding.alias("encoding"))
    return read.select("filename", "encoding", T.sha256("text").alias("text_sha256"), (corpus.encode("text", "encoding") == F.col("content")).alias("reversible"))


@query(f"SELECT doc_id, sha256({FOLD.format('text')}) AS folded_sha256, sha256({FLAT.format('text')}) AS flat_sha256 FROM documents")
def fold_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.sha256(T.fold("text")).alias("folded_sha256"), T.sha256(T.flat("text")).alias("flat_sha256"))


@query(rf"""SELECT p_partkey, regexp_replace({FOLD.format("p_partkey || 'o. Parágrafo ' || p_size || 'o, ' || p_name || ' ' || p_size || '° ' || p_brand || 'o'")}, '([0-9])(?:o|°)([\s.,;:)]|$)', '\1\2', 'g') AS folded FROM part""")
def fold_ordinals(spark, sf_dir):
    x = F.concat("p_partkey", F.lit("o. Parágrafo "), "p_size", F.lit("o, "), "p_name", F.lit(" "), "p_size", F.lit("° "), "p_brand", F.lit("o"))
    return table(spark, sf_dir, "part").select("p_partkey", T.fold_ordinal(x).alias("folded"))


_TOKENS = rf"toks AS (SELECT doc_id, unnest(regexp_extract_all({FOLD.format('text')}, '[\p{{L}}\p{{N}}_]+')) AS token FROM documents), df AS (SELECT token, count(DISTINCT doc_id) AS df, count(*) AS tf FROM toks GROUP BY token)"


def _postings_of_documents(spark, sf_dir):
    """The documents' index, written once for a table and session and read by every search."""
    path = stored(spark, sf_dir, "documents", lambda to: S.write_postings(table(spark, sf_dir, "documents"), "doc_id", to), "index")
    return spark.read.parquet(path)


@query(f"WITH {_TOKENS} SELECT * FROM df")
def token_df(spark, sf_dir):
    path = stored(spark, sf_dir, "documents", lambda to: S.document_frequency(table(spark, sf_dir, "documents"), "doc_id").write.parquet(to), "frequencies")
    return spark.read.parquet(path)


@query(f"WITH {_TOKENS} SELECT * FROM df WHERE df BETWEEN 1 AND 8")
def rare_tokens(spark, sf_dir):
    return S.rare(token_df(spark, sf_dir))


_WORDS = r"wl AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-zÁÉÍÓÚÜÑáéíóúüñ]{6,}') AS l FROM documents), ws AS (SELECT doc_id, unnest(l) AS raw, lower(raw) AS w, generate_subscripts(l, 1) AS i FROM wl)"


@query(f"WITH {_WORDS} SELECT doc_id, count(DISTINCT w) AS n_words, min_by(w, i) AS first_word FROM ws GROUP BY doc_id")
def word_sample(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", T.words("text").alias("w")).where(F.size("w") > 0)
    return found.select("doc_id", F.size("w").cast("bigint").alias("n_words"), F.col("w")[0].alias("first_word"))


_FIRST = f"{_TOKENS}, {_WORDS}, firsts AS (SELECT doc_id, strip_accents(w) AS token, min(i) AS place FROM ws GROUP BY ALL), ranked AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS pos, token FROM firsts JOIN df USING (token) WHERE df BETWEEN 1 AND 8), first_rare AS (SELECT * FROM ranked WHERE pos <= 3)"


@query(f"WITH {_FIRST} SELECT * FROM first_rare")
def first_k_rare(spark, sf_dir):
    return C.rank_in_text(table(spark, sf_dir, "documents"), ["doc_id"], "text", 3, rare_tokens(spark, sf_dir))


@query(f"WITH {CHUNKS} SELECT conv_id, chunk_no, md5(conv_id || ':' || chunk_no) AS place FROM chunks ORDER BY place LIMIT 60")
def sample_chunks(spark, sf_dir):
    place = F.md5(F.concat_ws(":", "conv_id", "chunk_no").cast("binary"))
    return C.chunks(chunked(spark, sf_dir), "conv_id").select("conv_id", "chunk_no", place.alias("place")).orderBy("place").limit(60)


@query(f"WITH {CHUNKS} SELECT conv_id, chunk_no, heading, sha256(text) AS sha256 FROM chunks")
def chunk_headings(spark, sf_dir):
    return C.chunks(chunked(spark, sf_dir), "conv_id").select("conv_id", "chunk_no", "heading", T.sha256("text").alias("sha256"))


@query(f"WITH {CHUNKS}, rebuilt AS (SELECT conv_id, sha256(string_agg(text, '' ORDER BY chunk_no)) AS rebuilt_sha256 FROM chunks GROUP BY conv_id) SELECT conv_id, sha256(text) AS sha256, rebuilt_sha256, sha256(text) = rebuilt_sha256 AS lossless FROM chunked JOIN rebuilt USING (conv_id)")
def lossless_reconstruct(spark, sf_dir):
    d = chunked(spark, sf_dir)
    return C.lossless(d, C.chunks(d, "conv_id"), "conv_id")


@query(f"""WITH {CHUNKS} SELECT conv_id, chunk_no, CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "start", CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY chunk_no) AS BIGINT) AS "end" FROM chunks""")
def chunk_stats(spark, sf_dir):
    return C.spans(C.chunks(chunked(spark, sf_dir), "conv_id"), "conv_id")


_POSTINGS = rf"{CHUNKS}, posted AS (SELECT conv_id, chunk_no, 'text' AS field, unnest(regexp_extract_all({FOLD.format('text')}, '[\p{{L}}\p{{N}}_]+')) AS token FROM chunks UNION ALL SELECT conv_id, chunk_no, 'heading', unnest(regexp_extract_all({FOLD.format('heading')}, '[\p{{L}}\p{{N}}_]+')) FROM chunks WHERE heading IS NOT NULL)"


def _postings(spark, sf_dir):
    return C.postings(C.chunks(chunked(spark, sf_dir), "conv_id"), ["conv_id", "chunk_no"], {"text": "text", "heading": "heading"})


@query(f"WITH {_POSTINGS} SELECT field, count(DISTINCT token) AS n_tokens, count(DISTINCT (token, conv_id, chunk_no)) AS n_postings, count(*) AS occurrences FROM posted GROUP BY field")
def postings_stats(spark, sf_dir):
    tokens = _postings(spark, sf_dir).groupBy("field", "token").agg(F.count("*").alias("n"), F.sum("tf").alias("tf"))
    return tokens.groupBy("field").agg(F.count("*").alias("n_tokens"), F.sum("n").alias("n_postings"), F.sum("tf").alias("occurrences"))


#: Searches: the first three rare words of every hundredth document.
_SEARCHES = f"{_FIRST}, searches AS (SELECT doc_id AS q, token FROM first_rare WHERE doc_id % 100 = 0), held AS (SELECT DISTINCT doc_id, token FROM toks), hits AS (SELECT q, doc_id FROM searches JOIN held USING (token) GROUP BY q, doc_id HAVING count(*) = (SELECT count(*) FROM searches s WHERE s.q = searches.q))"


def _searches(spark, sf_dir):
    # A few words for each query, put down as such: several joins read them.
    docs_ = table(spark, sf_dir, "documents").where("doc_id % 100 = 0")
    found = C.rank_in_text(docs_, ["doc_id"], "text", 3, rare_tokens(spark, sf_dir))
    return found.select(F.col("doc_id").alias("q"), "token")


def _stored_searches(spark, sf_dir):
    path = stored(spark, sf_dir, "documents", lambda to: _searches(spark, sf_dir).write.mode("overwrite").parquet(to), "searches")
    return spark.read.parquet(path)


@query(f"WITH {_SEARCHES} SELECT * FROM hits")
def search_and(spark, sf_dir):
    return S.search_and(_postings_of_documents(spark, sf_dir), _stored_searches(spark, sf_dir), ["doc_id"])


@query(f"WITH {_SEARCHES} SELECT * FROM hits")
def search_brute(spark, sf_dir):
    return S.search_scan(table(spark, sf_dir, "documents"), _stored_searches(spark, sf_dir), "doc_id")


# Both sides are computed: by counts of the terms held, and by the absence of a term that isn't.
@query(f"""WITH {_SEARCHES}, brute AS (SELECT DISTINCT s.q, h.doc_id FROM searches s JOIN held h USING (token) WHERE NOT EXISTS (SELECT 1 FROM searches t WHERE t.q = s.q AND NOT EXISTS (SELECT 1 FROM held x WHERE x.doc_id = h.doc_id AND x.token = t.token))),
differing AS (SELECT DISTINCT q FROM ((SELECT * FROM hits EXCEPT SELECT * FROM brute) UNION ALL (SELECT * FROM brute EXCEPT SELECT * FROM hits))), n AS (SELECT count(DISTINCT q) AS n FROM searches), d AS (SELECT count(*) AS d FROM differing)
SELECT n AS n_queries, n - d AS n_agree, d AS n_disagree, d = 0 AND n >= 5 AS passed FROM n, d""")
def search_disagreement(spark, sf_dir):
    differing = S.disagreement(search_and(spark, sf_dir), search_brute(spark, sf_dir), ["q", "doc_id"])
    return S.verdict(_stored_searches(spark, sf_dir), differing, least=5)


@query(f"WITH {_SEARCHES} SELECT DISTINCT token AS term, doc_id FROM held WHERE token IN (SELECT token FROM searches)")
def term_scan_files(spark, sf_dir):
    return S.term_scan(table(spark, sf_dir, "documents"), _stored_searches(spark, sf_dir).withColumnRenamed("token", "term"), "doc_id")


# Full triples of rare words: the whole control, C1 and C2 and what is dispersed.
_RAW = r"raw AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS token FROM documents)"


@query(f"""WITH {_SEARCHES}, {_RAW}, triples AS (SELECT q FROM searches GROUP BY q HAVING count(*) = 3), s AS (SELECT * FROM searches WHERE q IN (SELECT q FROM triples)), plain AS (SELECT q FROM s GROUP BY q HAVING bool_and(regexp_full_match(token, '[\\x00-\\x7F]*'))),
h AS (SELECT * FROM hits WHERE q IN (SELECT q FROM triples)), found AS (SELECT q, doc_id FROM s JOIN raw USING (token) WHERE q IN (SELECT q FROM plain) GROUP BY 1, 2 HAVING count(*) = 3),
c2 AS (SELECT count(DISTINCT q) AS bad FROM h WHERE q IN (SELECT q FROM plain) AND (q, doc_id) NOT IN (SELECT q, doc_id FROM found)), t AS (SELECT (SELECT count(*) FROM triples) AS n, (SELECT count(*) FROM plain) AS p, (SELECT count(*) FROM found WHERE (q, doc_id) NOT IN (SELECT q, doc_id FROM h)) AS d)
SELECT n AS n_queries, n AS c1_agree, p AS c2_queries, p - bad AS c2_agree, d AS dispersed, n >= 15 AND bad = 0 AS passed FROM t, c2""")
def search_verdict(spark, sf_dir):
    found, d = _stored_searches(spark, sf_dir), table(spark, sf_dir, "documents")
    queries = found.join(found.groupBy("q").agg(F.count("*").alias("n")).where("n = 3"), "q", "left_semi").select("q", "token")
    hits = S.search_and(_postings_of_documents(spark, sf_dir), queries, ["doc_id"])
    return S.differential(queries, hits, S.search_scan(d, queries, "doc_id"), S.raw_scan(d, queries.withColumnRenamed("token", "term"), "doc_id"), "doc_id")


# Positional searches: words of every hundredth document, against all documents.
_PLACED = rf"pos AS (SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS place FROM (SELECT doc_id, regexp_extract_all({FOLD.format('text')}, '[\p{{L}}\p{{N}}_]+') AS l FROM documents))"


def _positions(spark, sf_dir):
    path = stored(spark, sf_dir, "documents", lambda to: P.write_index(table(spark, sf_dir, "documents"), "doc_id", to), "positions")
    return P.Index(spark, path, "doc_id")


def _words_at(spark, sf_dir, first: int, n: int, step: int = 1):
    """(q, i, token): n words of each hundredth document, from a place on."""
    own = table(spark, sf_dir, "documents").where("doc_id % 100 = 0").select(F.col("doc_id").alias("q"), T.tokens("text").alias("own"))
    picked = F.array(*[F.try_element_at("own", F.lit(first + 1 + j * step)) for j in range(n)])
    return own.where(F.size("own") > first + (n - 1) * step).select("q", F.posexplode(picked).alias("i", "token"))


@query(f"""WITH {_PLACED}, a AS (SELECT doc_id AS q, place - 2 AS i, token FROM pos WHERE doc_id % 100 = 0 AND place BETWEEN 2 AND 4), w AS (SELECT q FROM a GROUP BY q HAVING count(*) = 3)
SELECT q, doc_id, count(*) AS n, min(start) AS first FROM (SELECT q, doc_id, place - i AS start FROM a JOIN pos USING (token) WHERE q IN (SELECT q FROM w) GROUP BY ALL HAVING count(*) = 3) GROUP BY q, doc_id""")
def phrase_search(spark, sf_dir):
    return P.phrases(_positions(spark, sf_dir), _words_at(spark, sf_dir, 2, 3))


@query(f"""WITH {_PLACED}, a AS (SELECT doc_id AS q, place AS i, token FROM pos WHERE doc_id % 100 = 0 AND place IN (0, 4, 8)), w AS (SELECT q FROM a GROUP BY q HAVING count(*) = 3), t AS (SELECT q, token, row_number() OVER (PARTITION BY q ORDER BY min(i)) AS i, count(*) OVER (PARTITION BY q) AS m FROM a WHERE q IN (SELECT q FROM w) GROUP BY q, token),
e AS (SELECT q, doc_id, m, place, max(place) FILTER (i = 1) OVER v AS x, max(place) FILTER (i = 2) OVER v AS y, max(place) FILTER (i = 3) OVER v AS z FROM t JOIN pos USING (token) WINDOW v AS (PARTITION BY q, doc_id ORDER BY place)),
g AS (SELECT q, doc_id, min(greatest(place - CASE m WHEN 1 THEN x WHEN 2 THEN least(x, y) ELSE least(x, y, z) END - 1, 0)) AS gap FROM e WHERE x IS NOT NULL AND (m < 2 OR y IS NOT NULL) AND (m < 3 OR z IS NOT NULL) GROUP BY q, doc_id) SELECT * FROM g WHERE gap <= 10""")
def near_search(spark, sf_dir):
    return P.near(_positions(spark, sf_dir), _words_at(spark, sf_dir, 0, 3, 4), 10)


@query(rf"""WITH {_PLACED}, len AS (SELECT doc_id, len(regexp_extract_all({FOLD.format('text')}, '[\p{{L}}\p{{N}}_]+')) AS n FROM documents), mean AS (SELECT count(*) AS docs, avg(n) AS mean FROM len), tf AS (SELECT doc_id, token, count(*) AS tf FROM pos GROUP BY ALL), dfs AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
a AS (SELECT DISTINCT doc_id AS q, token FROM pos WHERE doc_id % 100 = 0 AND place < 5 AND doc_id IN (SELECT doc_id FROM len WHERE n >= 5)),
s AS (SELECT q, doc_id, CAST(sum(CAST(floor(1000000 * ln(1 + (CAST(docs AS DOUBLE) - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / mean)))) AS BIGINT)) AS BIGINT) AS score FROM a JOIN tf USING (token) JOIN dfs USING (token) JOIN len USING (doc_id), mean GROUP BY q, doc_id)
SELECT q, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s QUALIFY rank <= 10""")
def ranked_search(spark, sf_dir):
    return P.ranked(_positions(spark, sf_dir), _words_at(spark, sf_dir, 0, 5), 10)


# Gold cases: every document is cited, every seventieth wrongly.
_CLAIMS = rf"""{DOCS}, parts AS (SELECT filename, doc_id, string_split(text, chr(10)) AS l, 1 + doc_id % 3 AS a, 1 + doc_id % 3 + doc_id % 2 AS b FROM docs),
claims AS (SELECT doc_id AS id, filename, l, a, b, CASE WHEN doc_id % 90 = 0 THEN 'nowhere' ELSE filename || '#L' || a || CASE WHEN b > a THEN '-L' || b ELSE '' END END AS cita, CASE WHEN doc_id % 70 = 0 THEN 'zzz ' ELSE '' END || translate(left({FLAT.format('coalesce(l[a], chr(32))')}, 40), 'aeiou', 'AEIOU') AS verbatim FROM parts)"""


def _claims(spark, sf_dir):
    a = 1 + F.col("doc_id") % 3
    b = a + F.col("doc_id") % 2
    line = F.coalesce(F.try_element_at(F.split("text", "\n"), a.cast("int")), F.lit(" "))
    cita = F.when(F.col("doc_id") % 90 == 0, "nowhere").otherwise(F.concat("filename", F.lit("#L"), a, F.when(b > a, F.concat(F.lit("-L"), b)).otherwise("")))
    verbatim = F.concat(F.when(F.col("doc_id") % 70 == 0, "zzz ").otherwise(""), F.translate(F.left(T.flat(line), F.lit(40)), "aeiou", "AEIOU"))
    return docs(spark, sf_dir).select(F.col("doc_id").alias("id"), cita.alias("cita"), verbatim.alias("verbatim"))


def _cited_sql(clean: str) -> str:
    span = clean.format("array_to_string(l[a:b], chr(10))")
    return f"WITH {_CLAIMS} SELECT id, CASE WHEN cita = 'nowhere' THEN 'malformed' WHEN b > len(l) THEN 'bad_range' WHEN contains({span}, {clean.format('verbatim')}) THEN 'ok' ELSE 'not_found' END AS outcome FROM claims"


@query(_cited_sql(FOLD.format(FLAT)))
def gold_citation(spark, sf_dir):
    return G.check_citations(_claims(spark, sf_dir), docs(spark, sf_dir))


@query(_cited_sql(FOLD))
def gold_citation_strict(spark, sf_dir):
    return G.check_citations(_claims(spark, sf_dir), docs(spark, sf_dir), strict=True)


_MATCHING = "len(list_filter(string_split(text, chr(10)), lambda x : regexp_matches({}, {})))"


def _count_cases(d):
    return d.select(F.col("doc_id").alias("id"), F.col("filename").alias("norma"), (F.col("doc_id") % 7).cast("string").alias("valor"), F.lit("^(th|la)").alias("patron"))


@query(f"WITH {DOCS} SELECT doc_id AS id, {_MATCHING.format(FOLD.format('x'), chr(39) + '^(th|la)' + chr(39))} AS n_found, n_found = doc_id % 7 AS ok FROM docs")
def gold_count(spark, sf_dir):
    d = docs(spark, sf_dir)
    return G.check_counts(_count_cases(d), d)


# Cases whose pattern or file is wrong, by their ids.
@query(f"""WITH {DOCS}, cases AS (SELECT doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN 'lost.md' ELSE filename END AS norma, doc_id % 5 IN (0, 1) AS bad FROM docs)
SELECT id, CASE WHEN bad THEN 'invalid_pattern' ELSE 'no_such_file' END AS problem FROM cases WHERE bad OR norma = 'lost.md'""")
def gold_problems(spark, sf_dir):
    d = docs(spark, sf_dir)
    return G.count_problems(d.selectExpr("doc_id AS id", "CASE WHEN doc_id % 7 = 0 THEN 'lost.md' ELSE filename END AS norma", "CASE doc_id % 5 WHEN 0 THEN '(the' WHEN 1 THEN ' ' ELSE '^(the|la)' END AS patron"), d)


@query(f"WITH {DOCS}, l AS (SELECT filename, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM docs) SELECT filename, line_no FROM l WHERE regexp_matches({FOLD.format('line')}, 'the and|la de') ORDER BY filename, line_no LIMIT 5")
def gold_examples(spark, sf_dir):
    return G.pattern_examples(corpus.lines(docs(spark, sf_dir), "filename"), "filename", "line", "the and|la de")


def _absent_cases(d):
    pattern = F.when(F.col("doc_id") % 2 == 0, "idiot|trash").otherwise("[0-9]{3}")
    return d.select(F.col("doc_id").alias("id"), F.col("filename").alias("norma"), pattern.alias("patron"))


@query(f"WITH {DOCS} SELECT doc_id AS id, {_MATCHING.format(FOLD.format('x'), 'CASE WHEN doc_id % 2 = 0 THEN ' + chr(39) + 'idiot|trash' + chr(39) + ' ELSE ' + chr(39) + '[0-9]{3}' + chr(39) + ' END')} AS n_found, n_found = 0 AS ok FROM docs")
def gold_absent_file(spark, sf_dir):
    d = docs(spark, sf_dir)
    return G.check_absent_in_files(_absent_cases(d), d)


_ABSENT = ["xylophone", r"\bthe and\b", "^ein", "creative commons", "[0-9]{12}"]


@query("\nUNION ALL ".join(rf"SELECT '{p}' AS pattern, CAST(count(*) FILTER (regexp_matches(f, '{p}')) AS BIGINT) AS n, n = 0 AS ok, CAST(NULL AS VARCHAR) AS problem FROM (SELECT {FOLD.format('unnest(string_split(text, chr(10)))')} AS f FROM documents)" for p in _ABSENT))
def gold_absent_corpus(spark, sf_dir):
    return G.check_absent(corpus.lines(docs(spark, sf_dir), "filename"), "line", _ABSENT)


@query("\nUNION ALL ".join(f"SELECT '{p}' AS pattern, CAST(count(*) FILTER (regexp_matches(f, '{p}')) AS BIGINT) AS n, n = 0 AS ok, CAST(NULL AS VARCHAR) AS problem FROM (WITH {DOCS} SELECT filename AS f FROM docs)" for p in ("doc-00000000[01]", "decreto", "9[.]md$")))
def gold_absent_names(spark, sf_dir):
    return G.check_absent(docs(spark, sf_dir), "filename", ["doc-00000000[01]", "decreto", "9[.]md$"])


_CASES = f"""{DOCS}, cases AS (SELECT CAST(CASE WHEN doc_id % 53 = 0 THEN 1 ELSE doc_id END AS BIGINT) AS id, CASE doc_id % 4 WHEN 0 THEN 'cita' WHEN 1 THEN 'conteo' WHEN 2 THEN 'ausente' ELSE CASE WHEN doc_id % 11 = 0 THEN 'otra' ELSE 'cita' END END AS categoria,
  CASE WHEN doc_id % 13 <> 0 THEN filename END AS norma, CASE doc_id % 5 WHEN 0 THEN 'archivo' WHEN 1 THEN 'corpus' WHEN 2 THEN 'nombres' WHEN 3 THEN 'total' END AS alcance, CASE WHEN doc_id % 17 = 0 THEN '  ' ELSE 'what?' END AS pregunta,
  CASE WHEN doc_id % 19 = 0 THEN 'three' ELSE CAST(doc_id % 6 AS VARCHAR) END AS valor, CASE WHEN doc_id % 23 = 0 THEN 'no citation' WHEN doc_id % 29 = 0 THEN 'other.md#L1' ELSE filename || '#L1' END AS cita, CASE WHEN doc_id % 31 = 0 THEN '' ELSE 'text' END AS verbatim, CASE WHEN doc_id % 37 <> 0 THEN 'x' END AS patron FROM docs)"""


def _cases(spark, sf_dir):
    i = "doc_id"
    return docs(spark, sf_dir).selectExpr(
        "CAST(CASE WHEN doc_id % 53 = 0 THEN 1 ELSE doc_id END AS BIGINT) AS id",
        "CASE doc_id % 4 WHEN 0 THEN 'cita' WHEN 1 THEN 'conteo' WHEN 2 THEN 'ausente' ELSE CASE WHEN doc_id % 11 = 0 THEN 'otra' ELSE 'cita' END END AS categoria",
        "CASE WHEN doc_id % 13 <> 0 THEN filename END AS norma",
        "CASE doc_id % 5 WHEN 0 THEN 'archivo' WHEN 1 THEN 'corpus' WHEN 2 THEN 'nombres' WHEN 3 THEN 'total' END AS alcance",
        "CASE WHEN doc_id % 17 = 0 THEN '  ' ELSE 'what?' END AS pregunta",
        "CASE WHEN doc_id % 19 = 0 THEN 'three' ELSE CAST(doc_id % 6 AS STRING) END AS valor",
        "CASE WHEN doc_id % 23 = 0 THEN 'no citation' WHEN doc_id % 29 = 0 THEN 'other.md#L1' ELSE filename || '#L1' END AS cita",
        "CASE WHEN doc_id % 31 = 0 THEN '' ELSE 'text' END AS verbatim",
        "CASE WHEN doc_id % 37 <> 0 THEN 'x' END AS patron",
        f"{i} AS doc_id",
    )


@query(f"""WITH {_CASES}, flagged AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM cases)
SELECT id, 'duplicate_id' AS code FROM flagged WHERE n > 1
UNION ALL SELECT id, 'blank_question' FROM cases WHERE trim(pregunta) = ''
UNION ALL SELECT id, 'unknown_kind' FROM cases WHERE categoria NOT IN ('cita', 'conteo', 'ausente')
UNION ALL SELECT id, 'unknown_scope' FROM cases WHERE categoria = 'ausente' AND coalesce(alcance, '') NOT IN ('archivo', 'corpus', 'nombres')
UNION ALL SELECT id, 'malformed_citation' FROM cases WHERE categoria = 'cita' AND cita = 'no citation'
UNION ALL SELECT id, 'blank_verbatim' FROM cases WHERE categoria = 'cita' AND verbatim = ''
UNION ALL SELECT id, 'count_not_a_number' FROM cases WHERE categoria = 'conteo' AND valor = 'three'
UNION ALL SELECT id, 'blank_pattern' FROM cases WHERE categoria IN ('conteo', 'ausente') AND patron IS NULL
UNION ALL SELECT id, 'no_file' FROM cases WHERE (categoria = 'conteo' OR categoria = 'ausente' AND alcance = 'archivo') AND norma IS NULL
UNION ALL SELECT id, 'citation_of_other_file' FROM cases WHERE categoria = 'cita' AND norma IS NOT NULL AND cita <> norma || '#L1'""")
def gold_structure(spark, sf_dir):
    return G.structure_rules(_cases(spark, sf_dir))


_ANSWERS = f"""{_CASES.replace('CASE WHEN doc_id % 53 = 0 THEN 1 ELSE doc_id END', 'doc_id')}, outcomes AS (SELECT id, CASE WHEN id % 41 = 0 THEN 'sin-respuesta' WHEN categoria = 'ausente' THEN CASE WHEN id % 3 > 0 THEN 'correct' ELSE 'wrong' END
  WHEN categoria = 'conteo' THEN CASE WHEN valor = CAST(id % 6 AS VARCHAR) THEN 'correct' ELSE 'wrong' END WHEN norma IS NOT NULL AND cita = norma || '#L1' AND id % 43 > 0 THEN 'citada-y-resuelta' ELSE 'cita-invalida' END AS outcome FROM cases)"""


def _scored(spark, sf_dir):
    cases = _cases(spark, sf_dir).withColumn("id", F.col("doc_id"))
    answers = cases.where("id % 41 > 0").selectExpr("id", "CASE WHEN categoria = 'ausente' AND id % 3 = 0 THEN 'cita' ELSE categoria END AS tipo_respuesta", "CAST(id % 6 AS STRING) AS valor", "CASE WHEN categoria = 'ausente' THEN '' WHEN id % 43 = 0 THEN norma || '#L0' ELSE cita END AS cita")
    files = docs(spark, sf_dir).select("filename", F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"))
    return G.score(cases, answers, files)


@query(f"WITH {_ANSWERS} SELECT * FROM outcomes")
def gold_score(spark, sf_dir):
    return _scored(spark, sf_dir)


@query(f"WITH {_ANSWERS} SELECT count(*) FILTER (outcome = 'correct') AS mechanical, count(*) FILTER (outcome = 'citada-y-resuelta') AS human, count(*) AS total FROM outcomes")
def gold_totals(spark, sf_dir):
    return G.totals(_scored(spark, sf_dir))


@query(f"""WITH {_CASES}, asked AS (SELECT DISTINCT id FROM cases), given AS (SELECT id, count(*) AS n, bool_or(categoria = 'otra') AS other FROM cases WHERE id % 3 > 0 GROUP BY id UNION ALL SELECT -1, 1, false)
SELECT id, 'no_answer' AS code FROM asked WHERE id NOT IN (SELECT id FROM given) UNION ALL SELECT -1, 'not_asked'
UNION ALL SELECT id, 'answered_twice' FROM given WHERE n > 1 UNION ALL SELECT id, 'unknown_kind' FROM given WHERE other""")
def gold_answer_rules(spark, sf_dir):
    cases = _cases(spark, sf_dir)
    answers = cases.where("id % 3 > 0").selectExpr("id", "categoria AS tipo_respuesta").unionByName(spark.sql("SELECT -1L AS id, 'cita' AS tipo_respuesta"))
    return G.answer_rules(answers, cases)


@query(f"WITH {CHUNKED} SELECT conv_id, len(list_filter(fs, lambda x : regexp_matches(x, '^## user'))) AS users, len(list_filter(fs, lambda x : regexp_matches(x, '^the'))) AS the_lines, len(list_filter(fs, lambda x : regexp_matches(x, 'parte'))) AS mentions, len(fs) AS all_lines FROM (SELECT conv_id, list_transform(string_split(text, chr(10)), lambda x : {FOLD.format('x')}) AS fs FROM chunked)")
def structure_profile(spark, sf_dir):
    return G.structure_profile(chunked(spark, sf_dir), "conv_id", patterns={"users": "^## user", "the_lines": "^the", "mentions": "parte", "all_lines": ""})
