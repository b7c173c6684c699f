"""Mixing sources to target weights, by blocks of words and pseudorandom permutations.

The words of a source, document after document, are cut into blocks of fixed length. A source's target is a number of
block slots, and the mix is written in output shards of so many slots. Every slot of a shard draws its source with the
sources' shares as weights, so a shard's counts are multinomial. Over all shards a source may then have a few slots too
many or too few: shard after shard, it keeps what it drew until its target is met, and the places it gives up go to the
sources that still lack slots. A source numbers its slots through the shards; each pass over the source's blocks maps
slot numbers to block numbers through a keyed permutation of its own, and slots are joined with blocks by that number.

The short last block of a source keeps the last place of each pass, and the last slot is cut. So a
source's words are its target, rounded, and no block is taken more often than there are passes.

All that is pseudorandom follows from a seed by whole numbers below 2**31: another seed gives another mix, and the
same one the same mix, in whatever order tasks run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowvigil.llm.shared import shuffle_width
from flowvigil.operators.ordering import running_totals
from flowvigil.staging import Staging

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Words of the mix for each word of the input.
SHARE = 1.5
#: Times that a source may be repeated at most.
REPEATS = 2
#: Words in a block, and slots in an output shard.
BLOCK = 128
SHARD_SLOTS = 65_536
#: Slots of one lookup row when slots are dealt to sources.
SPAN = 65_536
SEED = 42
#: Numbers below this are scrambled to numbers below this, by a factor and shifts.
RANGE, FACTOR, SHIFTS = 1 << 31, 73_244_475, (16, 15, 13)
#: Rounds of the permutation, what tells them apart, and how often a number outside is mapped on: a number is outside
#: with a chance below 1 / sqrt(blocks), and of fewer than 16 blocks no way outside is so long.
ROUNDS, ROUND_KEY, WALK = 4, 15_485_863, 64


def sizes(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source"
) -> DataFrame:
    """doc_id, source and size (words) of every row; a null text has none."""
    return df.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_column).cast("string"), F.lit(WORD)), F.lit(0))
        .cast("bigint")
        .alias("size"),
    )


def targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """One row per source: rank (by code point, null last), source, source_size, target.

    Sources below the water line ``level`` times weight get ``repeats`` times their size; the
    line is where the first source, by size for its weight, isn't filled by what is left.
    The windows without a partition run over one row per source.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    names = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.select(
        "source", "source_size", (F.row_number().over(names) - 1).cast("bigint").alias("rank")
    ).select(
        "*",
        F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
        .cast("double")
        .alias("weight"),
        (F.col("source_size") * repeats).cast("double").alias("most"),
    )
    fills = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    whole = fills.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = fills.rowsBetween(Window.unboundedPreceding, -1)
    later = fills.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    leveled = ranked.withColumn(
        "level",
        (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
        / F.sum("weight").over(later),
    ).withColumn("full", F.col("most") / F.col("weight") <= F.col("level"))
    line = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(whole)
    return leveled.withColumn("line", line).select(
        "rank",
        "source",
        "source_size",
        F.when(F.col("full"), F.col("most")).otherwise(F.col("line") * F.col("weight")).alias("target"),
    )


def quotas(wanted: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per source of some size: its blocks, passes in full, words after those, slots, first slot."""
    counted = (
        wanted.where(F.col("source_size") > 0)
        .withColumn("words", F.floor(F.col("target") + 0.5))
        .withColumn("blocks", F.ceil(F.col("source_size") / block))
        .withColumn("passes", F.floor(F.col("words") / F.col("source_size")))
        .withColumn("over", F.col("words") - F.col("passes") * F.col("source_size"))
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("over") / block))
    )
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(
        "rank",
        "source_size",
        "blocks",
        "passes",
        "over",
        "slots",
        F.coalesce(F.sum("slots").over(before), F.lit(0)).alias("first_slot"),
    )


def scrambled(x: Column) -> Column:
    """A pseudorandom number below ``RANGE`` for one that is not negative."""
    shifts = F.array(*[F.lit(n) for n in SHIFTS])
    return F.aggregate(shifts, (x % RANGE).cast("bigint"), lambda h, n: h.bitwiseXOR(F.call_function("shiftright", h, n)) * FACTOR % RANGE)


def permuted(index: Column, key: Column, size: Column) -> Column:
    """Where a permutation of the numbers below ``size``, chosen by ``key``, puts ``index``.

    A Feistel network over pairs (l, r), l below the root of ``size`` rounded up, walks on until it is inside.
    """
    width = F.ceil(F.sqrt(size.cast("double")))
    height = F.ceil(size / width)

    def network(x: Column) -> Column:
        def turn(pair: Column, n: Column) -> Column:
            left, right = pair["left"], pair["right"]
            own, other = F.when(n % 2 == 0, left).otherwise(right), F.when(n % 2 == 0, right).otherwise(left)
            moved = (own + scrambled(key + n * ROUND_KEY + other)) % F.when(n % 2 == 0, width).otherwise(height)
            return F.struct(F.when(n % 2 == 0, moved).otherwise(left).alias("left"), F.when(n % 2 == 0, right).otherwise(moved).alias("right"))

        pair = F.struct((x % width).alias("left"), F.floor(x / width).alias("right"))
        return F.aggregate(F.array(*[F.lit(n).cast("bigint") for n in range(ROUNDS)]), pair, turn, lambda p: p["right"] * width + p["left"])

    steps = F.sequence(F.lit(1), F.lit(WALK))
    return F.aggregate(steps, network(index), lambda x, _: F.when(x < size, x).otherwise(network(x)))


def _lots(counts: DataFrame, n: str, order: str, name: str) -> DataFrame:
    """``order`` repeated ``n`` times, numbered through all rows by ``name``; a row per shard or source."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    some = counts.where(F.col(n) > 0).withColumn("_first", F.coalesce(F.sum(n).over(before), F.lit(0)))
    return some.select(order, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col(n) - 1)).alias(name))


def counts_of_shards(quota: DataFrame, staging: Staging, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """shard, rank and n: how many of a shard's slots a source has; a source's are its slots of ``quota``, staged."""
    spark = quota.sparkSession
    total = quota.agg(F.sum("slots")).first()[0] or 0
    spans = quota.where(F.col("slots") > 0).select(
        "rank",
        "first_slot",
        "slots",
        F.explode(
            F.sequence(
                F.floor(F.col("first_slot") / SPAN),
                F.floor((F.col("first_slot") + F.col("slots") - 1) / SPAN),
            )
        ).alias("span"),
    )
    high = scrambled(scrambled(F.lit(seed) + F.floor(F.col("id") / RANGE)) + F.col("id"))
    place = (high * RANGE + scrambled(high + F.col("id"))) % F.lit(max(1, total))
    # Every place lies in the range of one source; sources are found by the span they reach into.
    drawn = (
        spark.range(0, total, 1, shuffle_width(spark))
        .select(F.floor(F.col("id") / shard_slots).alias("shard"), place.alias("place"))
        .withColumn("span", F.floor(F.col("place") / SPAN))
        .join(spans, "span")
        .where((F.col("place") >= F.col("first_slot")) & (F.col("place") < F.col("first_slot") + F.col("slots")))
        .groupBy("rank", "shard", "slots")
        .agg(F.count("*").alias("drawn"))
    )
    through = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    room = F.greatest(F.col("slots") - F.coalesce(F.sum("drawn").over(through), F.lit(0)), F.lit(0))
    kept = staging.table(drawn.withColumn("n", F.least("drawn", room)), "drawn")
    free = _lots(kept.groupBy("shard").agg(F.sum(F.col("drawn") - F.col("n")).alias("free")), "free", "shard", "at")
    held = kept.groupBy("rank").agg(F.sum("n").alias("held"))
    lacks = quota.join(held, "rank", "left").select("rank", (F.col("slots") - F.coalesce("held", F.lit(0))).alias("lacks"))
    given = free.join(_lots(lacks, "lacks", "rank", "at"), "at").groupBy("shard", "rank").agg(F.count("*").alias("n"))
    return staging.table(
        kept.select("shard", "rank", "n").unionByName(given).groupBy("shard", "rank").agg(F.sum("n").alias("n")).where("n > 0"), "shards"
    )


def draw(
    quota: DataFrame, staging: Staging, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED
) -> DataFrame:
    """All slots of the mix: shard, rank, slot (number in the source), turn, block and words.

    ``quota`` is read several times; stage it before.
    """
    counts, width = counts_of_shards(quota, staging, shard_slots, seed), shuffle_width(quota.sparkSession)
    through = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counts.withColumn("offset", F.coalesce(F.sum("n").over(through), F.lit(0)))
    # Dealt anew, so that the shards of a large source become slots in many tasks.
    slots = numbered.repartition(width, "rank", "shard").select(
        "shard", "rank", F.explode(F.sequence(F.col("offset"), F.col("offset") + F.col("n") - 1)).alias("slot")
    )
    placed = slots.join(quota.drop("first_slot"), "rank").withColumn(
        "turn", F.floor(F.col("slot") / F.col("blocks"))
    ).withColumn("index", F.col("slot") % F.col("blocks"))
    last = F.col("blocks") - 1
    short = F.col("source_size") - last * block
    key = scrambled(scrambled(F.lit(seed + 1) + F.col("rank")) + F.col("turn"))
    return placed.select(
        "shard",
        "rank",
        "slot",
        "turn",
        F.when(F.col("index") == last, last)
        .otherwise(permuted(F.col("index"), key, F.greatest(last, F.lit(1))))
        .alias("block"),
        F.when(
            (F.col("turn") == F.col("passes")) & (F.col("slot") == F.col("slots") - 1),
            F.col("over") - F.col("index") * block,
        )
        .when(F.col("index") == last, short)
        .otherwise(F.lit(block).cast("bigint"))
        .alias("words"),
    )


def blocks_of(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each document and block it reaches into: ``first`` to ``end`` are its words there."""
    reach = F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    )
    spread = placed.where(F.col("size") > 0).select("*", F.explode(reach).alias("block"))
    return spread.select(
        "doc_id",
        "rank",
        "size",
        "start",
        "block",
        F.greatest(F.col("start") - F.col("block") * block, F.lit(0)).alias("first"),
        F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block)).alias("end"),
    )


def mixture(
    df: DataFrame,
    staging: Staging,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    block: int = BLOCK,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(placed documents, slots, sources): what ``mix`` and ``mixed_documents`` are derived from."""
    sized = staging.table(sizes(df, id_column, text_column, source_column), "sizes")
    wanted = staging.table(targets(sized, weights, share, repeats), "targets")
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    known = wanted.withColumn("words_before", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    ranked = sized.join(
        known.withColumnRenamed("source", "known"), F.col("source").eqNullSafe(F.col("known"))
    ).drop("known")
    order = [F.col("rank"), F.col("doc_id"), F.col("size")]
    placed = running_totals(ranked, order, {"upto": "size"}, staging).withColumn(
        "start", F.col("upto") - F.col("size") - F.col("words_before")
    )
    placed = staging.table(placed.drop("upto", "words_before"), "placed")
    return placed, draw(staging.table(quotas(wanted, block), "quotas"), staging, block, shard_slots, seed), wanted


def taken_pieces(placed: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """What every slot takes of every document in its block: words ``low`` to ``high`` of the document, for a shard."""
    pieces = blocks_of(placed, block).join(slots.select("shard", "rank", "turn", "block", "words"), ["rank", "block"])
    low = F.col("block") * block + F.col("first") - F.col("start")
    length = F.greatest(F.least("end", "words") - F.col("first"), F.lit(0))
    return pieces.select("shard", "rank", "start", "doc_id", "size", "turn", low.alias("low"), (low + length).alias("high"))


def mix(df: DataFrame, staging: Staging, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, start, taken and n_shards, one row per input row.

    ``start`` counts the words of the source before the document, ``taken`` the words that the mix takes of it,
    repeats counted, and ``n_shards`` the output shards they go to. Options are those of ``mixture``.

    A null text has size 0 and nothing taken. Null sources are one source, the last. Repeated
    rows are rows of their own; a null doc_id stands first in its source. Among rows of one
    doc_id and source the shorter stands first. An empty table gives an empty result. Other columns are not read.
    """
    placed, slots, _ = mixture(df, staging, **options)
    pieces = taken_pieces(placed, slots, options.get("block", BLOCK)).where(F.col("high") > F.col("low"))
    # A document has no more rows than blocks and passes.
    in_shard = pieces.groupBy("rank", "start", "shard").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    taken = in_shard.groupBy("rank", "start").agg(F.sum("taken").alias("taken"), F.count("*").alias("n_shards"))
    # Only documents without words share their start with another one.
    nothing = F.lit(0).cast("bigint")
    some = placed.where(F.col("size") > 0).join(taken, ["rank", "start"], "left")
    none = placed.where(F.col("size") == 0).withColumns({"taken": nothing, "n_shards": nothing})
    documents = some.unionByName(none).withColumns({c: F.coalesce(c, nothing) for c in ("taken", "n_shards")})
    return documents.select("doc_id", "source", "size", "source_size", "target", "start", "taken", "n_shards")


def mixed_documents(
    df: DataFrame, staging: Staging, text_column: str = "text", source_column: str = "source", **options
) -> DataFrame:
    """The rows of ``df`` as often and as far as the mix takes them, with the same columns, whatever their names.

    A pass over a source gives a row for each document it takes words of. A document taken whole keeps
    its text as it is; of another one the words taken stand, in order, with one space between them. Documents
    without words, or with a null text, are in no block and so in no mix. Null ids and repeated rows are rows like
    all others; an empty table gives an empty result.
    """
    given = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("given")
    rows = staging.table(df.select(given).withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    text, source = F.col("given").getField(text_column), F.col("given").getField(source_column)
    asked = rows.select(F.col("row").alias("doc_id"), text.alias("text"), source.alias("source"))
    placed, slots, _ = mixture(asked, staging, **options)
    pieces = taken_pieces(placed, slots, options.get("block", BLOCK)).where(F.col("high") > F.col("low"))
    # As many spans as the document has blocks.
    taken = pieces.groupBy(F.col("doc_id").alias("row"), "turn").agg(
        F.first("size").alias("size"),
        F.sum(F.col("high") - F.col("low")).alias("taken"),
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"),
    )
    parts = F.flatten(
        F.transform(
            "spans",
            lambda s: F.slice(F.col("words"), (s["low"] + 1).cast("int"), (s["high"] - s["low"]).cast("int")),
        )
    )
    joined = rows.join(taken, "row")
    whole = joined.where(F.col("taken") == F.col("size")).withColumn("made", text)
    cut = joined.where(F.col("taken") < F.col("size")).withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    cut = cut.withColumn("made", F.array_join(parts, " "))
    columns = [F.col("made").alias(c) if c == text_column else F.col("given").getField(c).alias(c) for c in df.columns]
    return whole.select(*columns).unionByName(cut.select(*columns))
