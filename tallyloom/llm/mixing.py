"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source's words are dealt to shards by a seeded hash, laid out in a seeded order there and cut
into blocks of ``BLOCK`` words. Seats are blocks: the highest quotients target / (2k + 1) give each
source an integer number of blocks, and the same rule over shard sizes gives each shard of a source
its quota. A quota takes all blocks of its shard as often as it covers them, and for the rest a run
of blocks from a seeded place, round the end, so that every block is as likely as any other.

Only documents' ids and sizes are shuffled. Sources, and the seats of sources and shards, are ranked and summed in ranges of their
order, however many there are; windows run over the documents of a shard, which holds about ``SHARD_WORDS`` words.

Defined results: null text has size 0, takes nothing and is returned. Sources are taken by code point,
null last; weights repeat. Rows that repeat are documents of their own. An empty table gives no rows. Words of a text of any length are counted whole. Columns beyond the
three named ones are ignored, whatever their names; ``mixed_documents`` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import written

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK = 16
SHARD_WORDS = 1 << 20
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"

_HUGE = "decimal(38,0)"


def draw(*parts: Column | str) -> Column:
    """An integer from 0 to 2^52 - 1 that depends on the parts alone."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def running(rows: DataFrame, order: Sequence[Column], values: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``<value>_before`` for each of ``values``: its total over all rows before in ``order``.

    Rows are dealt to tasks by ranges of the order and written, and each range has running totals of its own. Only the ranges'
    totals, at most as many rows as there are shuffle partitions, meet in one task.
    """
    dealt = rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    dealt = written(dealt, label)
    earlier = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy(F.col("range").alias("range_no")).agg(*[F.sum(v).alias(v) for v in values])
    ranges = ranges.select("range_no", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"{v}_earlier") for v in values])
    line = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = [F.coalesce(F.sum(v).over(line), F.lit(0)).alias(f"{v}_inside") for v in values]
    return (
        dealt.select("*", *inside)
        .join(ranges, F.col("range") == F.col("range_no"))
        .select(*rows.columns, *[(F.col(f"{v}_inside") + F.col(f"{v}_earlier")).alias(f"{v}_before") for v in values])
    )


def seats(parties: DataFrame, within: Sequence[str], key: str, votes: str, total: str) -> DataFrame:
    """``parties`` with ``quota``: ``total`` seats shared by highest quotients votes / (2k + 1).

    ``total`` is a column equal in all parties of a group ``within`` (none for one group of all). A party's seats differ from
    its exact share by less than half its share times the number of parties, plus one, so that
    only seats in that reach are listed and ranked: about five a party. Groups of any number of parties are
    ranked in ranges of the quotients.
    """
    columns = parties.columns
    groups = [*within] or ["all_parties"]
    rows = written(parties if within else parties.withColumn("all_parties", F.lit(0)), "parties")
    sums = rows.groupBy(*groups).agg(
        F.sum(F.col(votes).cast("double")).alias("all_votes"), F.count("*").alias("parties")
    )
    part = F.col(votes).cast("double") / F.col("all_votes")
    exact, reach = F.col(total) * part, part * F.col("parties") / 2 + 1
    bounded = (
        rows.join(sums, groups)
        .withColumn("sure", F.when(F.col("all_votes") > 0, F.greatest(F.lit(0), F.floor(exact - reach))).otherwise(0))
        .withColumn("most", F.when(F.col("all_votes") > 0, F.ceil(exact + reach)).otherwise(0))
    )
    contested = bounded.where(F.col(votes) > 0).select(
        *groups, key, votes, F.explode(F.sequence(F.col("sure"), F.col("most"))).alias("k"), F.lit(1).alias("one")
    )
    quotient = F.col(votes).cast("double") / (2 * F.col("k") + 1)
    order = [*[F.col(g).asc() for g in groups], quotient.desc(), F.col(key).asc(), F.col("k").asc()]
    ranked = written(running(contested, order, ["one"], "seats"), "ranked-seats")
    starts = ranked.groupBy(*groups).agg(F.min("one_before").alias("start"))
    left = bounded.groupBy(*groups).agg((F.max(total) - F.sum("sure")).alias("open"))
    won = ranked.join(starts.join(left, groups), groups).where("one_before - start < open")
    gained = won.groupBy(*groups, key).agg(F.count("*").alias("gained"))
    return (
        bounded.join(gained, [*groups, key], "left")
        .withColumn("quota", (F.col("sure") + F.coalesce("gained", F.lit(0))).cast("long"))
        .select(*columns, "quota")
    )


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``(source, source_rank, source_size, target, words)`` of ``sizes`` ``(source, size)``; ``words`` is the size of all sources.

    Targets share all words by weight; one that would pass ``MOST_REPEATS`` times its source's words
    stops there and the rest is shared anew. Sources in order of words per weight reach that limit
    one after another, so the last common share follows from running sums, which are made in ranges of sources.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("one_before"), F.lit(len(weights))) + 1).cast("int"))
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1))
    named = running(written(sums, "source-sizes"), [F.col("source").asc_nulls_last()], ["one"], "source-names")
    sources = written(
        named.select("source", "source_size", F.col("one_before").cast("long").alias("source_rank"), weight.cast("long").alias("weight"))
        .withColumn("limit", F.col("source_size") * MOST_REPEATS),
        "source-weights",
    )
    all_weight, words = sources.agg(F.sum("weight"), F.sum("source_size")).first()
    by_room = [(F.col("source_size").cast("double") / F.col("weight")).asc(), F.col("source_rank").asc()]
    sources = (
        running(sources, by_room, ["weight", "limit"], "source-room")
        .withColumn("left_weight", F.lit(all_weight).cast("long") - F.col("weight_before"))
        .withColumn("left_words", F.lit(words).cast("long") - F.col("limit_before"))
    )
    full = F.col("limit").cast(_HUGE) * F.col("left_weight") <= F.col("weight") * F.col("left_words").cast(_HUGE)
    share = sources.where(~full).agg(F.max(F.col("left_words").cast("double") / F.col("left_weight"))).first()[0]
    return sources.select(
        "source",
        "source_rank",
        "source_size",
        F.when(full, F.col("limit").cast("double")).otherwise(F.col("weight") * F.lit(share).cast("double")).alias("target"),
        F.lit(words).cast("long").alias("words"),
    )


def _cover(start: Column, size: Column, first: Column, end: Column) -> Column:
    """Words of [start, start + size) that lie in [first, end)."""
    return F.greatest(F.lit(0), F.least(start + size, end) - F.greatest(start, first))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = WEIGHTS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target`` of its source and ``taken``,
    the words that the mix takes of it, repeats counted."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    sizes = written(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(source_column).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        ),
        "sizes",
    )
    blocks = F.round(F.col("words").cast("double") / BLOCK).cast("long")
    targets = source_targets(sizes, weights).withColumn("blocks", blocks).drop("words")
    sources = written(seats(targets, [], "source_rank", "target", "blocks"), "sources")
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS))
    name = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    placed = sizes.join(
        sources.withColumnRenamed("source", "source_name"), F.col("source").eqNullSafe(F.col("source_name"))
    ).select(
        "id", "size", "source_rank", "source_size", "target", F.col("quota").alias("source_quota"),
        F.pmod(draw(seed, "shard", name), shards).alias("shard"),
        draw(seed, "order", name).alias("draw"),
    )
    shard_sizes = placed.groupBy("source_rank", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    quotas = seats(shard_sizes, ["source_rank"], "shard", "shard_size", "source_quota").select(
        F.col("source_rank").alias("rank"), F.col("shard").alias("shard_no"), "shard_size", "quota"
    )
    line = Window.partitionBy("source_rank", "shard").orderBy("draw", "id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    laid = placed.withColumn("start", F.coalesce(F.sum("size").over(line), F.lit(0))).join(
        quotas, (F.col("source_rank") == F.col("rank")) & (F.col("shard") == F.col("shard_no"))
    )
    n = F.greatest(F.lit(1), F.ceil(F.col("shard_size") / BLOCK))
    quota = F.least(F.col("quota"), n * MOST_REPEATS)
    rest = F.pmod(quota, n)
    first = F.pmod(draw(seed, "run", F.col("source_rank").cast("string"), F.col("shard").cast("string")), n)
    wrapped = F.greatest(F.lit(0), first + rest - n)
    once = _cover(F.col("start"), F.col("size"), first * BLOCK, (first + rest) * BLOCK) + _cover(
        F.col("start"), F.col("size"), F.lit(0), wrapped * BLOCK
    )
    return laid.select(
        F.col("id").alias(id_column),
        "size",
        "source_size",
        "target",
        (F.floor(quota / n) * F.col("size") + once).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source"
) -> DataFrame:
    """The documents of the mix, each as often as it is taken; a document that the border of a
    selection cuts (two a shard at most) goes with the nearer side. Columns stay as they are."""
    taken = mix(docs, id_column, text_column, source_column)
    copies = taken.where("size > 0").select(
        F.col(id_column).alias("mix_id"), F.round(F.col("taken") / F.col("size")).cast("int").alias("copies")
    )
    copies = copies.groupBy("mix_id").agg(F.max("copies").alias("copies")).where("copies > 0")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("mix_id"))
    return rows.join(copies, rows["mix_id"].eqNullSafe(copies["mix_id"])).select(
        "row", F.explode(F.sequence(F.lit(1), F.col("copies")))
    ).select("row.*")
