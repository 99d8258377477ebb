"""Exact duplicates with a heavy-hitter split, in DataFrame operations only.

A Misra-Gries summary (Spark's approx_top_k family keeps one, with a bound on the
items it tracks) names digests that may be frequent. An exact count verifies them; the
verified winners, at most ``max_winners`` rows whatever the input's size, are broadcast
and settle their rows where they lie, without a shuffle. All other digests have
few rows each, so an ordinary shuffle on the digest is even.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stash

#: Entries a summary tracks; a digest with more than about rows / TRACKED rows can't be missed.
TRACKED = 4096
#: Most winners that are broadcast (about 100 bytes each).
MAX_WINNERS = 1000
#: Summaries are merged into so many, and only their lists of items meet, so that no task merges those of all input tasks.
MERGE_WIDTH = 64


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest): SHA-256 of the text with A-Z lower-cased, null as empty."""
    return docs.select(F.col(id_col).alias("id"), F.sha2(ascii_lower(F.col(text_col)).cast("binary"), 256).alias("digest"))


def frequent(keyed: DataFrame, max_winners: int = MAX_WINNERS, tracked: int = TRACKED, least: int = 3) -> DataFrame:
    """(digest, keep_id, group_size) of digests that the summary names and the exact count verifies; max_winners rows at most."""
    summaries = keyed.groupBy((F.spark_partition_id() % MERGE_WIDTH).alias("part")).agg(
        F.expr(f"approx_top_k(digest, {max_winners}, {tracked})").alias("top")
    )
    # whatever is frequent in all rows is as frequent in one part at least, so the parts' lists together miss none
    named = (
        summaries.selectExpr("inline(top)")
        .groupBy(F.col("item").alias("digest"))
        .agg(F.sum("count").alias("estimate"))
        .orderBy(F.desc("estimate"), "digest")
        .limit(max_winners)
        .select("digest")
    )
    return (
        keyed.join(F.broadcast(named), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") >= least)
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_winners: int = MAX_WINNERS, tracked: int = TRACKED) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; of a group, the row with the largest
    id stays. Null and empty texts form one group. Repeated rows (same id, same text) all point to that
    id and all count as kept: they can't be told apart. Rows with a null id count in group_size; keep_id is
    null only when every id of the group is. An empty table gives an empty result. Very long texts are
    read whole; only their digests travel. Other columns are ignored.
    """
    keyed = stash(digests(docs, id_col, text_col), "digests")
    winners = stash(frequent(keyed, max_winners, tracked), "winners")
    marked = keyed.join(F.broadcast(winners), "digest", "left")
    done = marked.where(F.col("group_size").isNotNull())
    same = Window.partitionBy("digest")
    rest = (
        marked.where(F.col("group_size").isNull())
        .select("id", "digest")
        .withColumn("keep_id", F.max("id").over(same))
        .withColumn("group_size", F.count(F.lit(1)).over(same))
    )
    return done.select("id", "digest", "keep_id", "group_size").unionByName(rest).select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
