"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries, one per input task and merged in two levels, find the digests that may be
frequent. A second pass counts those exactly; the verified winners, at most ``WINNERS`` rows, are
broadcast, so copies of a very frequent text are settled where they are read. All other digests
meet by an ordinary shuffle, where no group is frequent any more.

Defined results: null text is the empty text, and empty texts are equal. Without an id a row ranks below
all rows with one. A row repeated with its id gets the same decision each time; ``survivors``
returns it once. An empty table gives no rows. Texts of any length are hashed whole. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import written

#: Counters in each Misra-Gries summary, and the most winners that are broadcast.
TRACKED = 1024
WINNERS = 256
SENT = 1 << 18
_MERGES = 64


def text_digest(text: Column, normalise: Callable[[Column], Column] | None = None) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return F.sha2(normalise(whole) if normalise else whole, 256)


def frequent_digests(digests: DataFrame) -> DataFrame:
    """``(digest, keep_id, group_size)`` of the digests that a Misra-Gries pass proposes and an exact
    count confirms to be repeated; at most ``WINNERS`` rows of ``digests`` ``(id, digest)``."""
    part = digests.select("digest", F.pmod(F.spark_partition_id(), F.lit(_MERGES)).alias("part"))
    summaries = part.groupBy("part").agg(F.expr(f"approx_top_k(digest, {WINNERS}, {TRACKED})").alias("counters"))
    proposed = (
        summaries.select(F.explode("counters").alias("top"))
        .groupBy(F.col("top.item").alias("digest"))
        .agg(F.sum("top.count").alias("counter"))
        .orderBy(F.desc("counter"), "digest")
        .limit(WINNERS)
        .select("digest")
    )
    counted = (
        digests.join(F.broadcast(proposed), "digest")
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    return written(counted.where("group_size > 1"), "winners")


def decisions(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id`` (the largest id of equal texts),
    ``group_size``, ``kept`` and ``text_sha256`` of the (normalised) text."""
    digests = written(
        docs.select(F.col(id_column).alias("id"), text_digest(F.col(text_column), normalise).alias("digest")),
        "digests",
    )
    winners = frequent_digests(digests)
    frequent = digests.join(F.broadcast(winners), "digest")
    others = digests.join(F.broadcast(winners), "digest", "left_anti")
    groups = others.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    settled = frequent.unionByName(others.join(groups, "digest"))
    return settled.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def survivors(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns.

    Ids and digests alone are shuffled to find the rows that go. Losing copies of the winners go where they are read, and so do
    all others by a broadcast of their ids and digests, as long as these are ``SENT`` at most; above that rows are
    joined with them. Only rows whose id and text both repeat are compared whole; the one with the greatest values stays.
    """
    digest = text_digest(F.col(text_column), normalise).alias("digest")
    digests = written(docs.select(F.col(id_column).alias("id"), digest), "digests")
    winners = frequent_digests(digests).select("digest", "keep_id")
    others = digests.join(F.broadcast(winners), "digest", "left_anti")
    groups = others.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("n")).where("n > 1")
    groups = written(groups.select("digest", "keep_id"), "groups")
    other_id = ~F.col("id").eqNullSafe(F.col("keep_id"))
    lost = written(others.join(groups, "digest").where(other_id).select("digest", "id").distinct(), "lost")
    lost_rows = lost.select(F.col("digest").alias("lost_digest"), F.col("id").alias("lost_id"))
    if lost.count() <= SENT:
        lost_rows = F.broadcast(lost_rows)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), digest)
    left = rows.join(F.broadcast(winners), "digest", "left").where(F.col("keep_id").isNull() | ~other_id)
    same = (F.col("digest") == F.col("lost_digest")) & F.col("id").eqNullSafe(F.col("lost_id"))
    left = left.join(lost_rows, same, "left_anti")
    kept = digests.join(winners.unionByName(groups), "digest").where(~other_id)
    twice = written(kept.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "twice")
    if not twice.limit(1).count():
        return left.select("row.*")
    once = left.join(twice, "digest", "left_anti").select("row")
    again = left.join(twice, "digest").groupBy("digest").agg(F.max_by("row", F.to_json("row")).alias("row"))
    return once.unionByName(again.select("row")).select("row.*")
