"""Registration of queries with the SQL that gives the same rows, and the stand-ins for corpus inputs.

The tables have no legal texts, so inputs of the right shape are derived from
them, in Spark and in SQL alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import checkpointed, remove, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: By session, folder and what is stored: the tables' state and the folder.
_STORED: dict[tuple, tuple] = {}


def stored(spark: SparkSession, sf_dir: str, names: str | tuple[str, ...], write: Callable[[str], None], what: str) -> str:
    """The folder of what `write` has made of tables, made anew when the session, a folder or any of the tables' files change.

    names are all tables that `write` reads.  A table's state is the names,
    lengths and times of its files.  The result lies in the cluster's shared
    folder; a session without one that isn't local is refused.  What an older
    state of the tables had given is removed.
    """
    tables = (names,) if isinstance(names, str) else names
    place = (spark.sparkContext.applicationId, sf_dir, what)
    state = tuple(_state(spark, f"{sf_dir}/{n}.parquet") for n in tables)
    if _STORED.get(place, (None,))[0] != state:
        folder = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
        write(folder)
        if place in _STORED:
            remove(spark, _STORED[place][1])
        _STORED[place] = state, folder
    return _STORED[place][1]


def forget() -> None:
    """Let stored results be made anew."""
    _STORED.clear()


def _state(spark: SparkSession, path: str) -> tuple:
    """Names, lengths and times of a table's files."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    files = system.listFiles(hadoop, True)
    found = []
    while files.hasNext():
        one = files.next()
        found.append((one.getPath().getName(), one.getLen(), one.getModificationTime()))
    return tuple(sorted(found))


#: SQL of folding, of collapsing white space, and of a document's file name.
FOLD, FLAT = "lower(strip_accents({}))", r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
NAME = "'doc-' || lpad(CAST(doc_id AS VARCHAR), 10, '0') || '.md'"


def name(key: str = "doc_id"):
    return F.concat(F.lit("doc-"), F.lpad(F.col(key).cast("string"), 10, "0"), F.lit(".md"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(filename, doc_id, text)."""
    return table(spark, sf_dir, "documents").select(name().alias("filename"), "doc_id", "text")


DOCS = f"docs AS (SELECT {NAME} AS filename, doc_id, text FROM documents)"


def chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, text): a conversation as a document with a heading for each turn."""
    piece = F.concat(F.lit("## "), F.col("role"), F.lit(" "), F.col("turn").cast("string"), F.lit("\n"), F.col("text"), F.lit("\n"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", piece.alias("piece")).alias("t"))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["piece"]), "").alias("text"))


CHUNKED = "chunked AS (SELECT conv_id, string_agg('## ' || role || ' ' || turn || chr(10) || text || chr(10), '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id)"
#: Chunks in SQL: a separator goes before each heading, and an empty first part goes away.
CHUNKS = (
    CHUNKED
    + r""", cut AS (SELECT conv_id, list_filter(string_split(regexp_replace(text, '(^|\n)(#{1,6} )', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x, i : i > 1 OR x <> '') AS parts FROM chunked),
chunks AS (SELECT conv_id, i - 1 AS chunk_no, nullif(trim(regexp_extract(parts[i], '^(#{1,6} [^\n]*)', 1)), '') AS heading, parts[i] AS text FROM cut, unnest(range(1, len(parts) + 1)) AS t(i))"""
)


def numbered_rows(ordered: DataFrame, name: str) -> DataFrame:
    """The rows of an ordered frame with their places from 1, without one task for all: parts keep the order, and each starts where those before it end."""
    placed = checkpointed(ordered.withColumn("__at", F.monotonically_increasing_id()).withColumn("__part", F.spark_partition_id()))
    counts = sorted((r["__part"], r["count"], r["first"]) for r in placed.groupBy("__part").agg(F.count("*").alias("count"), F.min("__at").alias("first")).collect())
    starts, before = [], 0
    for part, n, first in counts:
        starts.append((part, before - first + 1))
        before += n
    shift = ordered.sparkSession.createDataFrame(starts, "__part int, __shift bigint")
    return placed.join(F.broadcast(shift), "__part").withColumn(name, F.col("__at") + F.col("__shift")).drop("__at", "__part", "__shift")
