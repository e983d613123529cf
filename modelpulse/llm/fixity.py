"""Merkle fixity audit of archives of records held in two replicas.

A record has a place (archive, offset) and the digest of its bytes. Records are hashed in the order of their
offsets within ranges of a fixed number of bytes, and 16 neighbouring ranges at a time are hashed into the
range above, up to one root for each archive. Ranges follow from offsets alone, so both replicas have the same tree
shape, no window runs over an archive, and a group is bounded by the bytes of a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from modelpulse.llm.registry import query
from modelpulse.llm.text import documents
from modelpulse.session import pin

RANGE_BYTES = 1 << 16
FANOUT = 16
# Pages of an archive.
ARCHIVE_RECORDS = 1000


def warc_records(pages: DataFrame) -> DataFrame:
    """``page_id``, ``archive``, ``offset``, ``length``, ``digest`` of every page as a response record.

    Archives hold the pages of a range of ids. Pages with a null id go to archives of their own, dealt by the hash of
    the page. A null url or html is empty. Equal pages follow each other in the archive.
    """
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"),
    )
    unnamed = -1 - F.pmod(F.xxhash64(url, html), F.lit(1 << 30))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.floor(F.col("page_id") / ARCHIVE_RECORDS), unnamed).cast("bigint").alias("archive"),
        F.octet_length(record).cast("bigint").alias("length"),
        F.sha2(record.cast("binary"), 256).alias("digest"),
    )
    order = Window.partitionBy("archive").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("offset", F.sum("length").over(order) - F.col("length")).select("page_id", "archive", "offset", "length", "digest")


def merkle_levels(records: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes (``archive``, ``node``, ``hash``) of every level, the ranges first, the roots last."""
    leaf = F.struct("offset", "length", "digest")
    base = records.groupBy("archive", F.floor(F.col("offset") / RANGE_BYTES).alias("node")).agg(F.sort_array(F.collect_list(leaf)).alias("leaves"))
    line = lambda r: F.concat_ws(":", r["offset"].cast("string"), r["length"].cast("string"), r["digest"])
    out = [pin(base.select("archive", "node", F.sha2(F.array_join(F.transform("leaves", line), "\n"), 256).alias("hash")))]
    for _ in range(levels):
        children = F.sort_array(F.collect_list(F.struct("node", "hash")))
        up = out[-1].groupBy("archive", F.floor(F.col("node") / FANOUT).alias("node")).agg(children.alias("c"))
        joined = F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["node"].cast("string"), x["hash"])), "\n")
        out.append(pin(up.select("archive", "node", F.sha2(joined, 256).alias("hash"))))
    return out


def fixity_audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records in which the replicas differ: ``archive``, ``offset``, ``status`` and the columns of ``primary``.

    ``status`` is changed, missing (not in the replica) or extra (in the replica alone; then the primary's other columns
    come from the replica). Both sides need ``archive``, ``offset``, ``length`` and ``digest``, none of them null, and the same
    other columns; one named ``status`` is replaced. Several records at one offset, repeated ones among them, are
    compared in the order of their digests. Empty tables are alike.
    """
    top = primary.agg(F.max("offset").alias("m")).union(replica.agg(F.max("offset"))).agg(F.max("m")).first()[0] or 0
    levels, span = 0, top // RANGE_BYTES
    while span:
        levels, span = levels + 1, span // FANOUT
    ours, theirs = merkle_levels(primary, levels), merkle_levels(replica, levels)
    wrong = None
    for level in range(levels, -1, -1):
        a, b = ours[level], theirs[level].withColumnRenamed("hash", "other")
        if wrong is not None:
            # Only below what differed one level higher.
            parent = wrong.select("archive", F.col("node").alias("_up"))
            a, b = (x.withColumn("_up", F.floor(F.col("node") / FANOUT)).join(parent, ["archive", "_up"], "left_semi").drop("_up") for x in (a, b))
        wrong = pin(a.join(b, ["archive", "node"], "full").where(~F.col("hash").eqNullSafe(F.col("other"))).select("archive", "node"))
    tie = Window.partitionBy("archive", "offset").orderBy("digest")
    others = [c for c in primary.columns if c not in ("archive", "offset", "status")]

    def suspects(records: DataFrame, out: str) -> DataFrame:
        # The row travels as one column, so that none of its names can clash.
        packed = records.select("archive", "offset", "digest", F.struct(*[F.col(f"`{c}`") for c in others]).alias(out))
        near = packed.withColumn("node", F.floor(F.col("offset") / RANGE_BYTES)).join(wrong, ["archive", "node"], "left_semi")
        return near.withColumn("_tie", F.row_number().over(tie)).drop("node", "digest")

    both = suspects(primary, "_mine").join(suspects(replica, "_copy"), ["archive", "offset", "_tie"], "full")
    same = (F.col("_mine.digest") == F.col("_copy.digest")) & (F.col("_mine.length") == F.col("_copy.length"))
    status = F.when(F.col("_copy").isNull(), "missing").when(F.col("_mine").isNull(), "extra").when(~same, "changed")
    value = lambda c: F.coalesce(F.col("_mine").getField(c), F.col("_copy").getField(c)).alias(c)
    return both.withColumn("_status", status).where("_status IS NOT NULL").select("archive", "offset", F.col("_status").alias("status"), *[value(c) for c in others])


def faulty_replica(pages: DataFrame, records: DataFrame) -> DataFrame:
    """A copy of the records as a bad disk leaves it, to be found by the audit: by a rule on the id, the first
    character of some pages is overwritten and some records are gone."""
    mark = (F.col("page_id") % 1000003) * 7919 % 97
    hurt = pages.where(mark.isin(3, 40)).where(F.length("html") > 0).withColumn("html", F.overlay("html", F.lit("#"), F.lit(1), F.lit(1)))
    record = warc_records(hurt).select("page_id", F.col("digest").alias("_bad"))
    return records.where(~F.coalesce(mark == 5, F.lit(False))).join(record.distinct(), "page_id", "left").select(
        "page_id", "archive", "offset", "length", F.coalesce("_bad", "digest").alias("digest")
    )


SQL = f"""
WITH records AS (
  SELECT page_id, html, CAST(floor(page_id / {ARCHIVE_RECORDS}) AS BIGINT) AS archive,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
         || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
         || html || chr(13) || chr(10) || chr(13) || chr(10) AS record,
         (page_id % 1000003) * 7919 % 97 AS mark
  FROM pages),
placed AS (
  SELECT *, strlen(record) AS length, sha256(record) AS digest,
         CAST(sum(strlen(record)) OVER (PARTITION BY archive ORDER BY page_id) - strlen(record) AS BIGINT) AS "offset"
  FROM records)
SELECT archive, "offset", CASE WHEN mark = 5 THEN 'missing' ELSE 'changed' END AS status, page_id, length, digest
FROM placed WHERE mark = 5 OR (mark IN (3, 40) AND length(html) > 0 AND html[1] <> '#')
"""


@query(SQL)
def op9_fixity_audit(spark, sf_dir):
    pages = documents(spark, sf_dir, "pages")
    records = pin(warc_records(pages))
    return fixity_audit(records, faulty_replica(pages, records))
