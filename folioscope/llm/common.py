"""Pieces that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Limits of one Arrow batch.  A batch closes at whichever comes first, so a
#: Python worker holds a few MB of text however long single texts are.
BATCH_ROWS = 4000
BATCH_BYTES = 8 << 20

#: A byte table that lower-cases A-Z and nothing else.
LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder.

    The folder is the session's spark.checkpoint.dir; see `shared_folder`.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the context's folder if one was set in code.

    Where neither is set, a temporary folder serves a local session, and a
    cluster is refused: executors of other machines couldn't read it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="folioscope-checkpoint-")


#: Rows of one key that a join may deal to one task, and the most values that a join broadcasts without a further look at their size.
HOT_ROWS, BROADCAST_ROWS = 200_000, 100_000


def skew_join(left: DataFrame, right: DataFrame, on: str, rows: str, total: int) -> DataFrame:
    """Inner join of left with a right side of one row for each key, whatever share of left one key holds.

    right has in `rows` how many rows of left have the key, and total is how
    many left has.  Keys of more than HOT_ROWS rows, or of a BROADCAST_ROWS-th
    of all, whichever is more, are broadcast; by their definition they are at
    most BROADCAST_ROWS.  The others are joined by a shuffle in which no key is
    large.  The result has no `rows` column.
    """
    least = max(HOT_ROWS, total // BROADCAST_ROWS)
    columns = [c for c in right.columns if c != rows]
    if total <= least:
        return left.join(right.select(columns), on)
    hot = checkpointed(right.where(F.col(rows) > least).select(columns))
    if hot.isEmpty():
        return left.join(right.select(columns), on)
    cold = left.join(F.broadcast(hot.select(on)), on, "left_anti").join(right.where(F.col(rows) <= least).select(columns), on)
    return left.join(F.broadcast(hot), on).unionByName(cold)


def fresh(name: str, columns: list[str]) -> str:
    """A column name that none of the columns has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def located(df: DataFrame, file: str, row: str) -> DataFrame:
    """The rows of a frame read from Parquet, with a hash of their file's path and their position in it.

    A frame that isn't a plain read, whose rows could share a position, is first
    written to the shared folder.
    """
    if _plain_read(df):
        try:
            return _with_position(df, file, row)
        except AnalysisException:
            pass  # A source without positions.
    folder = f"{shared_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return _with_position(df.sparkSession.read.schema(df.schema).parquet(folder), file, row)


def _plain_read(df: DataFrame) -> bool:
    """Whether a frame is a read of files, of which at most columns and rows are chosen."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan.getClass().getSimpleName() == "LogicalRelation"


def _with_position(df: DataFrame, file: str, row: str) -> DataFrame:
    hidden = df.metadataColumn("_metadata")
    found = df.select("*", F.xxhash64(hidden["file_path"]).alias(file), hidden["row_index"].alias(row))
    found.schema  # noqa: B018  (an absent hidden column shows here)
    return found


#: Positions to drop that are sent to the executors at most, 16 bytes each.
DROPPED = 4_000_000


def drop_rows(placed: DataFrame, dropped: DataFrame, columns: list[str], most: int = DROPPED) -> DataFrame:
    """The rows of a `located` frame, without its two last columns, whose position isn't among the distinct (f, r) of `dropped`.

    Up to `most` positions are broadcast, so rows stay where they are read; more
    of them are joined by position, which shuffles the rows.
    """
    file, row = placed.columns[-2:]
    if dropped.count() > most:
        return placed.join(dropped.select(F.col("f").alias(file), F.col("r").alias(row)), [file, row], "left_anti").select(*columns)
    limit_batches(placed.sparkSession)
    found = dropped.toArrow()
    f, r = found.column("f").to_numpy(), found.column("r").to_numpy()
    order = np.lexsort((r, f))
    f, r = f[order], r[order]
    files, starts = np.unique(f, return_index=True)
    sent = placed.sparkSession.sparkContext.broadcast(dict(zip(files.tolist(), np.split(r, starts[1:]), strict=True)) if len(files) else {})
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, rows = batch.column(n).to_numpy(), batch.column(n + 1).to_numpy()
            kept = np.ones(len(own), bool)
            for x in np.unique(own).tolist():
                if x in sent.value:
                    kept &= ~((own == x) & np.isin(rows, sent.value[x]))
            yield pa.RecordBatch.from_arrays(batch.columns[:n], names=batch.schema.names[:n]).filter(pa.array(kept))

    return placed.mapInArrow(run, placed.select(*placed.columns[:n]).schema)


def utf8(column: str) -> Column:
    """The text as UTF-8 bytes; null counts as an empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds, F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, folds: int, held_out: int, rows: int) -> DataFrame:
    """(y, t) of about `rows` labelled rows outside the held-out fold, picked by hashes; y is whether the label isn't 0.

    One scan of the documents with a broadcast of the picked keys, whose number
    is counted first.  Equal rows count once, and where one key has many
    different texts the rows are picked once more by their text, so at most
    about twice `rows` are left however often keys repeat.
    """
    known = labels.where((fold_of(key, folds) != held_out) & F.col(label).isNotNull()).select(F.col(key).alias("k"), (F.col(label) != 0).cast("int").alias("y")).distinct()
    picked = known.where(_picked(F.xxhash64("k", F.lit(label)), rows, known.count()))
    own = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).join(F.broadcast(picked), "k")
    sample = checkpointed(own.groupBy("k", "y", F.xxhash64("t").alias("h")).agg(F.first("t").alias("t")))
    n = sample.count()
    return sample.where(_picked(F.xxhash64("h", F.lit("rows")), rows, n) if n > 2 * rows else F.lit(True)).select("y", "t")


def _picked(hashed: Column, rows: int, total: int) -> Column:
    """Whether a hash lies in the share of `rows` in `total`."""
    return F.pmod(hashed, F.lit(1 << 24)) < int(min(1.0, rows / max(total, 1)) * (1 << 24)) + 1


def map_texts(df: DataFrame, keys: list[str | Column], text: str, fn: Callable[..., list], schema: str, with_keys: bool = False) -> DataFrame:
    """Run fn over Arrow batches of UTF-8 texts.

    fn gets the batch's texts as bytes, and with_keys the first key's values, and
    returns one sequence or Arrow array for each column after the keys.  schema
    names all columns, keys first.
    """
    spark = df.sparkSession
    limit_batches(spark)
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                more = [batch.column(0).to_pylist()] if with_keys else []
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], *map(_array, fn(batch.column(n).to_pylist(), *more))], names=names)

    narrow = df.select(*[F.col(k) if isinstance(k, str) else k for k in keys], utf8(text).alias("__utf8"))
    names = [field.name for field in T._parse_datatype_string(schema).fields]
    return narrow.mapInArrow(run, schema)


def filter_texts(df: DataFrame, text: str, keep: Callable[[list[bytes]], list[bool]]) -> DataFrame:
    """The whole rows whose text passes; keep gets a batch's texts as UTF-8 bytes."""
    limit_batches(df.sparkSession)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(raw_texts(batch.column(at))), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def raw_texts(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _array(values) -> pa.Array:
    return values if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values)


def limit_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get, by rows and by bytes.

    Spark reads these settings when a job runs, so they stay set in the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies: FOLIOSCOPE_TOKENIZERS, else the installed package."""
    folder = os.environ.get("FOLIOSCOPE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
