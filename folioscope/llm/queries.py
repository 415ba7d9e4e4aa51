"""The registered queries of the data-preparation operators, with production parameters.

Each query applies its operator to the whole of its intended table.  SQL gives
the same rows where SQL can express them.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, html_text, packing, periodic, quality_classifier, quality_rules, resampling, sentencepiece, sharding, simhash, token_counts, toxicity
from .common import table, tokenizer_path


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One more conversation says control strings.
    own = spark.sql("SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.format_chats(turns))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, token_counts.sample_edits("text"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.statistics(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), n_shards=24)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


def planted_run(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A text's words, in one of ten documents with a run from a place and with a period that follow from the id."""
    h, n = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head = words[a : a + p]
    return words[:a] + (head * (-(-(n - a) // len(head))))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), reword=planted_run)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_token_counts": op2_token_counts,
    "op3_simhash": op3_simhash,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_html_extraction": op7_html_extraction,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_quality_rules": op9_quality_rules,
    "op10_sharding": op10_sharding,
    "op11_resampling": op11_resampling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_packing": op13_packing,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every mark that the chat template adds, and what its escapes count.
_MARKS = r"(\\|<s>|</s>|\[SYS\]|\[/SYS\]|\[INST\]|\[/INST\]|\[OUT\]|\[TURN |\[/TURN\])"

SQL: dict[str, str] = {
    "op1_chat_formatting": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t.turn, t.role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
), numbered AS (
  SELECT *, row_number() OVER w - 1 AS position, coalesce(lag(role) OVER w, '') AS before, lead(role) OVER w IS NULL AS last,
         length(text) + len(regexp_extract_all(text, '{_MARKS}'))
           + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 9
             ELSE 14 + length(role) + len(regexp_extract_all(role, '{_MARKS}')) + length(role) - length(replace(role, ']', '')) END AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), checked AS (
  SELECT *, NOT (role = 'user' AND before IN ('', 'system', 'assistant') OR role = 'assistant' AND before = 'user' OR role = 'system' AND before = '' AND position = 0) AS bad FROM numbered
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY position)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY position) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars,
  NOT bool_or(bad) AND max_by(role, position) = 'assistant' AS valid, min(position) FILTER (bad) AS first_bad_turn
FROM checked GROUP BY conv_id""",
    "op5_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win FROM (SELECT * FROM d, sizes WHERE len(w) >= size), unnest(range(1, len(w) - size + 2)) AS t(i)),
hits AS (SELECT doc_id, i, size, item FROM dw JOIN bw USING (win, size)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, i, size FROM hits), unnest(range(i, i + size)) AS t(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op9_quality_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
windows AS (SELECT doc_id, i, array_to_string(words[i : i + 4], ' ') AS win FROM w, unnest(range(1, len(words) - 3)) AS t(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 5)) AS t(p) GROUP BY doc_id),
s AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[A-Za-z]')) AS n_letters
  FROM w LEFT JOIN repeats USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > word_chars OR 100 * n_dup_lines > 50 * n_lines OR word_chars > 20 * n_words OR (100 * n_upper > 70 * n_letters AND n_letters >= 10)) AS kept
FROM s""",
    "op11_resampling": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
df AS (SELECT doc_id, unnest(w) AS f FROM d UNION ALL SELECT doc_id, w[i] || ' ' || w[i + 1] FROM d, unnest(range(1, len(w))) AS t(i)),
bf AS (SELECT unnest(w) AS f FROM b UNION ALL SELECT w[i] || ' ' || w[i + 1] FROM b, unnest(range(1, len(w))) AS t(i)),
crcs AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) AS r(i))),
known AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
placed AS (SELECT f, xor(list_reduce(range(length(h) // 2), lambda c, k : xor(c >> 8, t[1 + (xor(c, CAST('0x' || h[2 * k + 1 : 2 * k + 2] AS BIGINT)) & 255)]), 4294967295), 4294967295) % 10000 AS bucket FROM known, crcs),
source AS (SELECT bucket, count(*) AS s FROM df JOIN placed USING (f) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM bf JOIN placed USING (f) GROUP BY bucket),
sums AS (SELECT CAST(coalesce((SELECT sum(s) FROM source), 0) AS DOUBLE) AS n_source, CAST(coalesce((SELECT sum(t) FROM target), 0) AS DOUBLE) AS n_target),
gained AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (n_source + 10000) / ((s + 1) * (n_target + 10000)))) AS BIGINT) AS gain FROM source LEFT JOIN target USING (bucket), sums),
summed AS (SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM df JOIN placed USING (f) JOIN gained USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN (total - (total % n + n) % n) // n ELSE 0 END AS weight,
  CAST('0x' || sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) AS h FROM d LEFT JOIN summed USING (doc_id)),
final AS (SELECT doc_id, n_words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM final WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * (SELECT count(*) FROM ranked) // 100 THEN place END AS rank FROM final LEFT JOIN ranked USING (doc_id)""",
}
