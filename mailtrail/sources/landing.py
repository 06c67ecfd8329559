"""The landing folder: manifest, candidates, fingerprints, staging check.

The folder is listed by Spark itself. Spark's scans leave out zero-length files, so the
manifest joins the names (which include them) to the scan's sizes and times.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import layout

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listed_in_shares(spark: SparkSession) -> Iterator[None]:
    """Scans opened inside list their paths in a few tasks a core, not in a task for each path."""
    before = spark.conf.get(LISTING_TASKS, None)
    spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(LISTING_TASKS)
        else:
            spark.conf.set(LISTING_TASKS, before)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, r"[/\\]"), -1)


def full_path(spark: SparkSession, folder: str) -> str:
    """The folder with its file system: one name however it is given."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _scan(spark: SparkSession, paths: str | list[str], glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)


def file_manifest(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(file_name, file_path, size_bytes, modified_at), zero-length files included.

    Names go through the driver, as in every Spark file scan; sizes and times do not.
    A zero-length file has no modification time here.
    """
    scan = _scan(spark, folder, glob)
    names = spark.createDataFrame(
        [(unquote(uri), unquote(uri).rsplit("/", 1)[-1]) for uri in scan.inputFiles()],
        "file_path string, file_name string",
    )
    sizes = scan.select(
        base_name(F.col("path")).alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )
    return names.join(sizes, "file_name", "left").select(
        "file_name", "file_path", F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"),
        "modified_at",
    )


def candidate_files(manifest: DataFrame) -> DataFrame:
    """Files with a valid report name, in text order of the name."""
    return manifest.filter(F.col("file_name").rlike(layout.REPORT_NAME_PATTERN)).orderBy("file_name")


def matched_files(spark: SparkSession, folder: str, glob: str = layout.REPORT_GLOB) -> DataFrame:
    """Files of the looser name glob; an error when there is none."""
    manifest = file_manifest(spark, folder, glob)
    if manifest.isEmpty():
        raise FileNotFoundError(f"No files match {glob} in {folder}")
    return manifest


def file_contents(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """(file_name, content): the bytes of every file that has any.

    A file is one value, whatever its size and file system; SHA-256 reads it in sequence
    anyway. A value holds 2 GB, and Spark refuses a larger file by name.
    """
    return _scan(spark, paths, glob).select(base_name(F.col("path")).alias("file_name"), "content")


def file_checksums(manifest: DataFrame, contents: DataFrame) -> DataFrame:
    """(file_name, size_bytes, checksum_sha256) of the files of a manifest.

    Digests are taken where the bytes are read; a file without bytes has that of none.
    """
    digests = contents.select("file_name", F.sha2("content", 256).alias("checksum_sha256"))
    empty = F.when(F.col("size_bytes") == 0, F.sha2(F.lit(b""), 256))
    return manifest.join(digests, "file_name", "left").select(
        "file_name", "size_bytes", F.coalesce("checksum_sha256", empty).alias("checksum_sha256")
    )


def staging_check(advertised: DataFrame, staged: DataFrame) -> DataFrame:
    """Advertised (file_name, size_bytes) against the staged copy: OK, MISSING, SIZE_MISMATCH."""
    copy = staged.select("file_name", F.col("size_bytes").alias("staged_bytes"))
    return advertised.join(copy, "file_name", "left").select(
        "file_name", "size_bytes", "staged_bytes",
        F.when(F.col("staged_bytes").isNull(), "MISSING")
        .when(F.col("staged_bytes") != F.col("size_bytes"), "SIZE_MISMATCH")
        .otherwise("OK").alias("staging_state"),
    )
