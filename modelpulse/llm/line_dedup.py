"""Line dedup: lines whose key stands in many documents go from all of them.

Only hashes travel: lines are exploded to the 128-bit hash of their key, counted once per document
with map-side combine, and the hashes over the threshold are joined back to the lines. The places to
drop depend on the text alone, so they are looked up by the hash of the text; rows with equal or null
ids need no special case, and a copied text is exploded as often as it occurs but dropped from alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelpulse.llm.registry import query
from modelpulse.llm.text import documents

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\x0c\r"
MIN_DOCUMENTS = 10
MIN_CHARS = 1


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; texts without other characters take the faster built-in function."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_keys(text: Column) -> Column:
    """The keys of all lines, in order."""
    return F.transform(F.split(ascii_lower(text), "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)))


def _pair(value: Column) -> Column:
    """A 128-bit hash: two of 64 bits with different seeds."""
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b"))


def repeated_lines(docs: DataFrame, text_col: str = "text", min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per distinct text that has lines to drop: ``text_key`` and ``drops``, the places of these lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(_pair(text).alias("text_key"), F.posexplode(line_keys(text)).alias("pos", "key"))
    lines = lines.where(F.char_length("key") >= min_chars).select("text_key", "pos", _pair(F.col("key")).alias("line"))
    # A key counts once in a document, at its first line there.
    keys = F.array_distinct(F.filter(line_keys(text), lambda k: F.char_length(k) >= min_chars))
    once = docs.select(F.explode(F.transform(keys, _pair)).alias("line"))
    frequent = once.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_documents).select("line")
    return (
        lines.join(frequent, "line", "left_semi")
        .groupBy("text_key")
        .agg(F.sort_array(F.collect_set("pos")).alias("drops"))
    )


def drop_repeated_lines(docs: DataFrame, text_col: str = "text", min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns of ``docs``, the text without repeated lines, and ``n_lines``, ``n_dropped``.

    A row is a document. A null text is one empty line and comes back as an empty text. Columns of the
    input with the names of the new ones are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    drops = repeated_lines(docs, text_col, min_documents, min_chars).select(
        F.col("text_key").alias("_key"), F.col("drops").alias("_drops")
    )
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # The row travels as one column, so that none of its names can clash.
    rows = docs.select(F.struct(*keep).alias("_doc"), _pair(text).alias("_row"))
    joined = rows.join(drops, F.col("_row") == F.col("_key"), "left")
    whole = F.coalesce(F.col("_doc").getField(text_col), F.lit(""))
    joined = joined.select("_doc", "_drops", whole.alias("_text"), F.split(whole, "\n", -1).alias("_lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drops"))
    rest = F.array_join(F.transform(places, lambda i: F.element_at("_lines", i + 1)), "\n")
    kept = F.when(F.col("_drops").isNotNull(), rest).otherwise(F.col("_text"))
    return joined.select(
        *[(kept if c == text_col else F.col("_doc").getField(c)).alias(c) for c in keep],
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_drops"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, line, pos,
         translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
frequent AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT l.*, f.key IS NOT NULL AS drop FROM lines l LEFT JOIN frequent f USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN drop THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query(SQL)
def op6_line_dedup(spark, sf_dir):
    kept = drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
