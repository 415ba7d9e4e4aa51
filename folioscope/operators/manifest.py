"""Sealing a corpus: manifests, the set hash, and what differs from a seal."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import sha256
from ..sources.shared import checkpointed

#: Files in a leaf of a seal, about; nodes or leaves that reach a scan as literals at most.
LEAF, LITERAL_LEAVES = 256, 2_000


def manifest(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """(filename, sha256, bytes) of every document."""
    return docs.select(F.col(name).alias("filename"), sha256(text).alias("sha256"), F.octet_length(text).cast("bigint").alias("bytes"))


def set_hash(files: DataFrame) -> DataFrame:
    """One row (file_count, total_bytes, set_hash): SHA-256 over `name:sha` lines in the order of names.

    The lines are sorted in parallel; the digest itself is sequential by
    definition and streams through one task that holds one batch.
    """
    lines = files.select("filename", F.concat_ws(":", "filename", "sha256").alias("line"), F.col("bytes").cast("bigint").alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, count, total = hashlib.sha256(), 0, 0
        for batch in batches:
            if batch.num_rows:
                digest.update(("\n".join(batch.column(0).to_pylist()) + "\n").encode())
                count += batch.num_rows
                total += sum(x or 0 for x in batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64()), pa.array([total], pa.int64()), pa.array([digest.hexdigest()])], names=["file_count", "total_bytes", "set_hash"])

    # A one-partition range keeps the global order; its sort spills to disk.
    ordered = lines.repartition(1).sortWithinPartitions("filename").select("line", "bytes")
    return ordered.mapInArrow(run, "file_count bigint, total_bytes bigint, set_hash string")


def bucket_hash(files: DataFrame, buckets: int = 256) -> DataFrame:
    """One row (file_count, total_bytes, bucket_hash): a seal whose digests are taken side by side.

    Files are dealt to buckets by a hash of their name; each bucket's lines are
    sorted and digested in a task of their own, and the seal is the digest of the
    buckets' digests in their order.  It isn't the set hash, whose one digest is
    sequential, but tells the same changes at any number of files.
    """
    bucket = F.pmod(F.xxhash64("filename"), F.lit(buckets)).cast("int")
    lines = files.select(bucket.alias("bucket"), "filename", F.concat_ws(":", "filename", "sha256").alias("line"), F.col("bytes").cast("bigint").alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest, count, total = None, hashlib.sha256(), 0, 0
        row = lambda: pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([count], pa.int64()), pa.array([total], pa.int64()), pa.array([digest.hexdigest()])], names=["bucket", "n", "bytes", "digest"])
        for batch in batches:
            for b, line, size in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if b != own:
                    if own is not None:
                        yield row()
                    own, digest, count, total = b, hashlib.sha256(), 0, 0
                digest.update(f"{line}\n".encode())
                count, total = count + 1, total + (size or 0)
        if own is not None:
            yield row()

    dealt = lines.repartition("bucket").sortWithinPartitions("bucket", "filename").select("bucket", "line", "bytes")
    each = dealt.mapInArrow(run, "bucket int, n bigint, bytes bigint, digest string")
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "digest"))), lambda x: F.concat(x["bucket"].cast("string"), F.lit(":"), x["digest"])), "\n")
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("file_count"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"), F.sha2(parts, 256).alias("bucket_hash"))


def integrity_diff(current: DataFrame, sealed: DataFrame) -> DataFrame:
    """(filename, status, sealed_sha, current_sha) of every file added, removed or modified; no rows mean the seal holds."""
    a, b = sealed.select("filename", F.col("sha256").alias("sealed_sha")), current.select("filename", F.col("sha256").alias("current_sha"))
    status = F.when(F.col("sealed_sha").isNull(), "added").when(F.col("current_sha").isNull(), "removed").when(F.col("sealed_sha") != F.col("current_sha"), "modified")
    return a.join(b, "filename", "full_outer").withColumn("status", status).where("status IS NOT NULL").select("filename", "status", "sealed_sha", "current_sha")


def coverage(indexed: DataFrame, disk: DataFrame, sealed: DataFrame) -> DataFrame:
    """(difference, filename): files that one of index, disk and manifest has and another lacks, by one pass over all three."""
    flags = [s.select("filename").distinct().withColumn(n, F.lit(True)) for s, n in ((indexed, "i"), (disk, "d"), (sealed, "s"))]
    joined = flags[0].join(flags[1], "filename", "full_outer").join(flags[2], "filename", "full_outer")
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    kinds = F.array_compact(F.array(*[F.when(has(a) & ~has(b), F.lit(name)) for a, b, name in (("d", "i", "disk_not_indexed"), ("i", "d", "indexed_not_on_disk"), ("s", "i", "sealed_not_indexed"), ("i", "s", "indexed_not_sealed"))]))
    return joined.select(F.explode(kinds).alias("difference"), "filename")


class Seal:
    """A stored tree of digests over a manifest: a base, and the updates that followed.

    A file belongs to the leaf that the first `depth` hex digits of its name's
    digest tell.  A leaf's digest is that of its sorted `name:sha` lines, an
    inner node's that of its children's.  `files` are sorted by leaf, and `nodes`
    by their parent.  An update writes the leaves that it touches and the nodes
    above them, with its number; of each leaf and node the newest counts.
    """

    FILES, NODES = "leaf string, filename string, sha256 string, bytes bigint, step int", "parent string, prefix string, digest string, step int"

    def __init__(self, spark: SparkSession, paths: list[str], depth: int):
        self.spark, self.paths, self.depth = spark, paths, depth

    @classmethod
    def write(cls, files: DataFrame, path: str, depth: int | None = None) -> Seal:
        """The seal of a manifest (filename, sha256, bytes); without a depth its leaves have some LEAF files."""
        if depth is None:
            depth = max(1, math.ceil(math.log(max(1, files.count() / LEAF), 16)))
        files.sparkSession.createDataFrame([(depth,)], "depth int").write.parquet(f"{path}/depth")
        return cls(files.sparkSession, [], depth)._write(files.select(_leaf(depth), "filename", "sha256", F.col("bytes").cast("bigint").alias("bytes")), None, path)

    @classmethod
    def open(cls, spark: SparkSession, paths: list[str]) -> Seal:
        """The seal that was written to the first folder, with the updates in the others."""
        return cls(spark, paths, spark.read.parquet(f"{paths[0]}/depth").first()["depth"])

    def _write(self, files: DataFrame, touched: DataFrame | None, path: str) -> Seal:
        """Put down leaves, the touched of which can be empty now, and all nodes above them."""
        new, step = Seal(self.spark, [*self.paths, path], self.depth), F.lit(len(self.paths)).alias("step")
        files.select("leaf", "filename", "sha256", "bytes", step).repartitionByRange("leaf").sortWithinPartitions("leaf", "filename").write.parquet(f"{path}/files")
        lines = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "filename", "sha256"))), "\n")
        nodes = self.spark.read.schema(self.FILES).parquet(f"{path}/files").groupBy(F.col("leaf").alias("prefix")).agg(sha256(lines).alias("digest"))
        if touched is not None:
            # A leaf without files has no digest.
            nodes = touched.select(F.col("leaf").alias("prefix")).distinct().join(nodes, "prefix", "left")
        for level in range(self.depth, -1, -1):
            laid = nodes.select(F.substring("prefix", 1, max(0, level - 1)).alias("parent"), "prefix", "digest", step)
            laid.repartitionByRange("parent").sortWithinPartitions("parent").write.parquet(f"{path}/nodes/{level}")
            if level:
                # All children, of this step and of earlier ones, of the nodes above what was touched.
                above = self.spark.read.schema(self.NODES).parquet(f"{path}/nodes/{level}").select("parent").distinct()
                known = F.array_join(F.array_sort(F.collect_list(F.when(F.col("digest").isNotNull(), F.concat_ws(":", "prefix", "digest")))), "\n")
                nodes = new._nodes(level, above).groupBy(F.col("parent").alias("prefix")).agg(F.when(F.count("digest") > 0, sha256(known)).alias("digest"))
        return new

    def _nodes(self, level: int, parents: DataFrame | None = None) -> DataFrame:
        """(parent, prefix, digest, step) of a level's newest nodes, of all or some parents."""
        every = self.spark.read.schema(self.NODES).parquet(*[f"{p}/nodes/{level}" for p in self.paths])
        if parents is not None:
            every = _among(every, "parent", parents)
        if len(self.paths) == 1:
            return every
        return every.groupBy("parent", "prefix").agg(F.max_by(F.struct("digest", "step"), "step").alias("x")).select("parent", "prefix", "x.*")

    def root(self) -> str | None:
        """The digest of all files, the same for equal files whatever updates led to them; null if there are none."""
        found = self._nodes(0).first()
        return found["digest"] if found else None

    def files(self, leaves: DataFrame | None = None) -> DataFrame:
        """(leaf, filename, sha256, bytes), of all or some leaves."""
        every = self.spark.read.schema(self.FILES).parquet(*[f"{p}/files" for p in self.paths])
        if leaves is not None:
            every = _among(every, "leaf", leaves)
        if len(self.paths) > 1:
            parents = leaves.select(F.substring(leaves.columns[0], 1, self.depth - 1)).distinct() if leaves is not None else None
            newest = self._nodes(self.depth, parents).select(F.col("prefix").alias("leaf"), "step")
            every = every.join(newest, ["leaf", "step"], "left_semi")
        return every.select("leaf", "filename", "sha256", "bytes")

    def update(self, changes: DataFrame, path: str) -> Seal:
        """The seal after changes (filename, sha256, bytes), a null sha256 for a file that is gone; writes only touched leaves and the nodes above them."""
        changes = checkpointed(changes.select(_leaf(self.depth), "filename", "sha256", F.col("bytes").cast("bigint").alias("bytes")))
        touched = checkpointed(changes.select("leaf").distinct())
        kept = self.files(touched).join(changes.select("filename"), "filename", "left_anti")
        return self._write(kept.unionByName(changes.where("sha256 IS NOT NULL")), touched, path)

    def unequal(self, other: Seal) -> DataFrame:
        """(prefix) of the leaves that differ; looks only below nodes that do."""
        if self.depth != other.depth:
            raise ValueError("seals of different depth have no nodes in common")
        found = None
        for level in range(self.depth + 1):
            a, b = (s._nodes(level, found).select("prefix", "digest") for s in (self, other))
            found = checkpointed(a.join(b.withColumnRenamed("digest", "other"), "prefix", "full_outer").where("NOT (digest <=> other)").select("prefix"))
        return found

    def diff(self, current: Seal) -> DataFrame:
        """What `integrity_diff` gives for the files of both, this being the sealed side; reads the leaves that differ."""
        leaves = self.unequal(current)
        return integrity_diff(current.files(leaves), self.files(leaves))


def _leaf(depth: int) -> Column:
    return F.substring(sha256("filename"), 1, depth).alias("leaf")


def _among(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose column is one of a frame's first column; few values, which are counted, reach the scan as literals."""
    found = [r[0] for r in wanted.limit(LITERAL_LEAVES + 1).collect()]
    if len(found) <= LITERAL_LEAVES:
        return rows.where(F.col(column).isin(found))
    return rows.join(wanted.select(F.col(wanted.columns[0]).alias(column)), column, "left_semi")
