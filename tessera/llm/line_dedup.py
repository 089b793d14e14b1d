"""Line de-duplication by hashed keys and per-document keep bitmaps, in DataFrame operations only.

Texts are split once; their line hashes are range-partitioned with documents
and positions as the secondary order, so a line that every document has is
spread over many tasks. Each task streams its sorted range and marks the first
occurrence of every (line, document): a running number over that order, for
which Spark plans no further shuffle or sort. The marked rows are counted per
line, first in the task. What comes back to the documents are bitmaps, never
text: 62 lines to a word, and only words with a dropped line are stored.

Nulls, empties, ties: null and empty texts have one empty line. Lines whose key
is shorter than ``min_chars`` stay. Rows of one doc_id count as one document
(null is a doc_id) but keep their own bitmaps if their texts differ; repeated
rows get the same result each. An empty table gives no rows. Other columns
pass through, except that ``n_lines`` and ``n_dropped`` are replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import common

SPACE = " \t\n\x0b\x0c\r"
BITS = 62


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; a text of ASCII alone takes the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"_text": text, "_tk": F.xxhash64(text)})


def _lines(text: str) -> Column:
    return F.split(text, "\n", -1)


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """_doc, _tk (hash of the text), _keep: map of word number to keep bits, for documents that lose lines.

    A line goes if its key is found in at least ``min_docs`` documents; with
    ``keep_first``, its first occurrence by (doc_id, position) stays.
    """
    spark = common.prepare(docs.sparkSession)
    lines = (_rows(docs).select(F.col("doc_id").alias("_doc"), "_tk", F.posexplode(_lines("_text")).alias("pos", "line"))
             .withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_chars)
             .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "_doc", "_tk", "pos"))
    lines = common.materialise(lines, "line-hashes")  # so that finding the ranges does not split the texts again
    ranged = lines.repartitionByRange(common.n_partitions(spark), "h1", "h2", "_doc").sortWithinPartitions(
        "h1", "h2", "_doc", "pos")
    # all rows of a (line, document) lie in one range, in order of position: the window streams over them
    in_order = Window.partitionBy("h1", "h2", "_doc").orderBy("pos")
    lines = common.materialise(ranged.withColumn("nth", F.row_number().over(in_order)), "line-order")
    common_lines = (lines.filter("nth = 1").groupBy("h1", "h2")
                    .agg(F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("_doc", "pos")).alias("first"))
                    .filter(F.col("n_docs") >= min_docs).select("h1", "h2", "first"))
    # Written, so that its size is known: Spark broadcasts it below its threshold and splits hot lines beyond.
    common_lines = common.materialise(common_lines, "common-lines")
    gone = lines.join(common_lines, ["h1", "h2"])
    if keep_first:
        gone = gone.filter(~F.struct("_doc", "pos").eqNullSafe(F.col("first")))
    return (gone.groupBy("_doc", "_tk", F.expr(f"cast(pos div {BITS} as int)").alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {BITS})")).alias("dropped"))
            .groupBy("_doc", "_tk")
            .agg(F.map_from_entries(F.collect_list(F.struct(
                "word", F.expr(f"(shiftleft(1L, {BITS}) - 1) ^ dropped").alias("bits")))).alias("_keep")))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as text, n_lines (before) and n_dropped."""
    rows = _rows(docs)
    on = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_tk") == F.col("_tk2"))
    rows = rows.join(bitmaps.withColumnRenamed("_tk", "_tk2"), on, "left")
    kept = F.expr(f"filter(split(_text, '\\n', -1), (x, i) -> "
                  f"shiftright(coalesce(try_element_at(_keep, i div {BITS}), -1L), i % {BITS}) & 1 = 1)")
    dropped = F.expr(f"aggregate(map_values(_keep), 0L, (n, w) -> n + {BITS} - bit_count(w))")
    return rows.withColumns({
        "n_lines": F.size(_lines("_text")).cast("long"),
        "n_dropped": F.coalesce(dropped, F.lit(0)).cast("long"),
        "text": F.when(F.col("_keep").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")),
    }).drop("_text", "_tk", "_tk2", "_doc", "_keep")


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, min_docs, min_chars, keep_first))
