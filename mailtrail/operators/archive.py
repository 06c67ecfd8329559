"""The archive dataset and its verification.

The archive holds whole file contents. Digests are taken where the bytes are read, so only
digests are ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.status import archive_name


def archive_rows(manifest: DataFrame, contents: DataFrame, run_id: str) -> DataFrame:
    """run_id, archive_name, file_name, content; zero-length files included."""
    empties = manifest.filter("size_bytes = 0").select("file_name", F.lit(b"").alias("content"))
    return contents.select("file_name", "content").unionByName(empties).select(
        F.lit(run_id).alias("run_id"),
        archive_name(F.col("file_name"), F.lit(run_id)).alias("archive_name"),
        "file_name", "content",
    )


def verify_archive(registered: DataFrame, archive: DataFrame) -> DataFrame:
    """Per registered file: OK, MISSING, DUPLICATE_MEMBER, EMPTY or CHECKSUM_MISMATCH.

    ``registered`` brings the size and checksum_sha256 that were taken when the file came in;
    a source that changed since does not pass for what was loaded.
    """
    kept = archive.select(
        "file_name", F.sha2("content", 256).alias("_digest"),
        F.octet_length("content").cast("bigint").alias("_bytes"),
    ).groupBy("file_name").agg(
        F.count(F.lit(1)).alias("_copies"), F.max("_bytes").alias("_bytes"),
        F.max("_digest").alias("_digest"),
    )
    same = F.col("_digest").eqNullSafe(F.col("checksum_sha256"))
    return registered.select("file_name", "size_bytes", "checksum_sha256").join(
        kept, "file_name", "left"
    ).select(
        "file_name", "size_bytes",
        F.when(F.col("_copies").isNull(), "MISSING")
        .when(F.col("_copies") > 1, "DUPLICATE_MEMBER")
        .when((F.col("_bytes") == 0) & (F.col("size_bytes") > 0), "EMPTY")
        .when(~same, "CHECKSUM_MISMATCH")
        .otherwise("OK").alias("archive_state"),
    )
