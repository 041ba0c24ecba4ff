"""Query op6: pages to archives and back."""

import re

from pyspark.sql import DataFrame, functions as F

from textsignal.llm.registry import Source, query
from textsignal.llm.warc import archive_files, parse_archives, read_archives, records, spoiled, write_archives
from textsignal.session import scratch_path

SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT page_id, html, h, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, cast(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
           ((cast('0x' || substr(h, cast(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> cast(5 * (3 - i % 4) AS BIGINT)) & 31) + 1]), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to,
       page_id % 20 <> 7 AS salvaged
FROM m
"""


@query("op6_salvage", SQL)
def op6(t: Source) -> DataFrame:
    """Each page as the archives give it back; ``salvaged``: also from archives in which one record in twenty is damaged."""
    folder = shared_folder(t.spark, "warc")
    write_archives(t("pages"), folder)
    hurt = records(parse_archives(spoiled(archive_files(t.spark, folder), 20, 7)))
    left = hurt.select(F.col("page_id").alias("id"), F.lit(True).alias("left")).distinct()
    found = records(read_archives(t.spark, folder)).join(left, F.col("page_id") == F.col("id"), "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return found.select(*columns, F.coalesce("left", F.lit(False)).alias("salvaged"))


def shared_folder(spark, name: str) -> str:
    """A new folder of the shared scratch with its scheme: that of Hadoop's default file system unless it names one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/(?!/)", "file:///", re.sub(r"^s3[an]:", "s3:", whole))
