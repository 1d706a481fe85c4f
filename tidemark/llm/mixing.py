"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, order_of, shielded, table, with_running_sum
from tidemark.session import materialize

#: Fixed values of the mix: weights by place in the order of sources, share of all words, and most uses of a source.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
#: About so many blocks in a mix, within these block sizes in words.
BLOCKS = 1 << 22
LEAST, MOST = 64, 1024
#: The golden ratio's fractional part, as a step in units of 2^-53.
GOLDEN = 5566755282872655
UNIT = 1 << 53
CELLS = 4096


def words_of(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, target) of (source, source_size).

    Sources are ordered by code point, null last. target = min(REPEATS * size, level * weight), where the level
    makes the targets add up to SHARE of all words: the fixed point of sharing excess out again by weight. One row
    per source; the windows go over sources alone.
    """
    place = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), F.pmod(F.row_number().over(place) - 1, F.lit(len(WEIGHTS))))
    marked = sizes.select("source", "source_size", weight.alias("weight"))
    marked = marked.withColumn("_cap", F.lit(float(REPEATS)) * F.col("source_size")).withColumn(
        "_fill", F.col("_cap") / F.col("weight")
    )
    tied = Window.orderBy("_fill", F.col("source").isNull(), "source")
    before, after = tied.rowsBetween(Window.unboundedPreceding, -1), tied.rowsBetween(0, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(1))
    levels = marked.withColumns(
        {
            "_full": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
            "_open": F.sum("weight").over(after),
            "_goal": F.lit(SHARE) * F.sum("source_size").over(every),
        }
    ).withColumn("_level", (F.col("_goal") - F.col("_full")) / F.col("_open"))
    # the level holds from the first source on that it doesn't fill
    level = F.max(F.when(F.col("_level") <= F.col("_fill"), F.col("_level"))).over(every)
    return levels.withColumn("target", F.least("_cap", F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))).select(
        "source", "source_size", "weight", F.col("target").cast("double").alias("target")
    )


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int | None = None, step: int = GOLDEN):
    """(plan, schedule) of the mix.

    ``plan``: a row for each row of ``docs`` with ``doc_id``, ``_th`` (hash of the text), ``_tie`` (tells equal rows apart),
    ``source``, ``size``, ``source_size``, ``target``, ``first`` and ``second`` (words that the first and the second pass
    take: the leading ones of the document) and ``first_slot`` and ``second_slot`` (the slot of the mix in which each
    pass starts on the document; null without words taken). ``schedule``: (slot, source, block, pass, words).

    A source's documents are laid end to end in hash order and cut into blocks of equal words. Slot i of the mix
    takes the source in whose share of the cumulated targets the i-th golden-ratio point falls; its rank among the
    slots of that source says which block is next, and a source starts over when it is through, REPEATS times at
    most. So a block is used once or twice, and a mix cut short at any slot is near the weights. A document's words are
    taken where the blocks that got a slot hold them, and it stands in the mix at the slot of its first block.

    The points give a source its target within a few blocks. That is settled in the source's last slot, whatever the
    ``block`` (in words, by default from the size of the table): its block is cut at the target's last word, or it takes the
    blocks that are still lacking; a source too small for any slot gets one by its hash. ``step`` is that of the points.

    Null texts have no words, null sources are a source of their own, rows equal in id and text count each.
    A table without words gives an empty schedule.
    """
    sized = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("_th"),
            F.col(source_col).alias("source"),
            words_of(text_col).alias("size"),
        ).withColumns({"_id": order_of("doc_id"), "_tie": F.monotonically_increasing_id()}),
        "sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sources), "targets")
    rows, total = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = block or max(LEAST, min(MOST, round(total / BLOCKS)))
    slots = round(SHARE * total / block)

    # cumulated shares, one row per source
    before = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    goal = F.round("target").cast("long")
    shares = targets.where("target > 0").select(
        "source",
        F.ceil(F.col("source_size") / block).alias("n_blocks"),
        F.least(goal, "source_size").alias("_words0"),
        F.greatest(goal - F.col("source_size"), F.lit(0)).alias("_words1"),
        (F.coalesce(F.sum("target").over(before), F.lit(0.0)) / F.sum("target").over(every)).alias("_from"),
    )
    following = Window.orderBy("_from", F.col("source").isNull(), "source")
    shares = materialize(shares.withColumn("_upto", F.coalesce(F.lead("_from").over(following), F.lit(1.0))), "shares")
    schedule = materialize(_schedule(docs.sparkSession, shares, slots, block, step), "schedule")

    # words of a source that each pass takes: its leading blocks
    uses = schedule.groupBy("source", "pass").agg(F.sum("words").alias("n"))
    passes = uses.groupBy(F.col("source").alias("_src")).agg(
        *[F.coalesce(F.max(F.when(F.col("pass") == k, F.col("n"))), F.lit(0)).alias(f"_n{k}") for k in range(REPEATS)]
    )
    by_source = targets.join(passes, _same(F.col("source"), F.col("_src")), "left").select(
        F.col("source").alias("_s"),
        "source_size",
        "target",
        *[F.coalesce(f"_n{k}", F.lit(0)).alias(f"_w{k}") for k in range(REPEATS)],
    )
    by_source = materialize(by_source, "passes")
    laid = with_running_sum(
        sized.withColumn("_mix", F.xxhash64("_id", "_th", F.lit("mix"))), ["source"], ["_mix", "_id", "_th", "_tie"], "size", "_at", rows
    )
    joined = laid.join(by_source, _same(F.col("source"), F.col("_s")))
    part = [F.greatest(F.lit(0), F.least(F.col("size"), F.col(f"_w{k}") - F.col("_at"))) for k in range(REPEATS)]
    plan = joined.withColumns({"first": part[0], "second": part[1], "_block": F.floor(F.col("_at") / block)})
    # a row for each source and block: no key is hot
    places = schedule.groupBy(F.col("source").alias("_ps"), F.col("block").alias("_pb")).agg(
        *[F.min(F.when(F.col("pass") == k, F.col("slot"))).alias(f"_slot{k}") for k in range(REPEATS)]
    )
    plan = plan.join(places, _same(F.col("source"), F.col("_ps")) & (F.col("_block") == F.col("_pb")), "left").select(
        "doc_id",
        "_th",
        "_tie",
        "source",
        "size",
        "source_size",
        "target",
        "first",
        "second",
        F.when(F.col("first") > 0, F.col("_slot0")).alias("first_slot"),
        F.when(F.col("second") > 0, F.col("_slot1")).alias("second_slot"),
    )
    return plan, schedule


def _cell(x: str) -> Column:
    return F.floor(F.col(x) * CELLS)


def _schedule(spark, shares: DataFrame, slots: int, size: int, step: int = GOLDEN, chunk: int = 1 << 16) -> DataFrame:
    """(slot, source, block, pass, words): ranks within a source are counted by chunk of slots and moved by the chunks before.

    ``size`` is that of a block. Blocks that a source's words need beyond its slots fall to its last one.
    """
    points = spark.range(slots).select(
        F.col("id").alias("slot"),
        F.floor(F.col("id") / chunk).alias("_chunk"),
        (F.pmod(F.col("id").cast("decimal(38,0)") * F.lit(step), F.lit(UNIT)).cast("double") / F.lit(float(UNIT))).alias("_x"),
    )
    # a share lies in the cells it touches; the points are spread evenly over the cells, so no cell is hot
    cells = shares.withColumn("_cell", F.explode(F.sequence(_cell("_from"), _cell("_upto"))))
    points = points.withColumn("_cell", _cell("_x"))
    inside_share = (F.col("_x") >= F.col("_from")) & (F.col("_x") < F.col("_upto"))
    hit = points.join(cells, (points._cell == cells._cell) & inside_share).select("slot", "_chunk", "source")
    before = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = hit.groupBy("source", "_chunk").agg(F.count("*").alias("_n")).select(
        F.col("source").alias("_s"), F.col("_chunk").alias("_c"), "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    bases = materialize(bases, "bases")
    inside = Window.partitionBy("source", "_chunk").orderBy("slot")
    wanted = F.ceil(F.col("_words0") / size) + F.ceil(F.col("_words1") / size)
    needs = shares.select(F.col("source").alias("_src"), "n_blocks", "_words0", "_words1", wanted.alias("_wanted"))
    moved = bases.join(needs, _same(F.col("_s"), F.col("_src"))).drop("_src", "_n")
    ranked = hit.withColumn("_in", F.row_number().over(inside) - 1).join(
        moved, _same(F.col("source"), F.col("_s")) & (F.col("_chunk") == F.col("_c"))
    )
    ranked = ranked.withColumn("_rank", F.col("_in") + F.col("_base")).where("_rank < _wanted")
    met = hit.groupBy(F.col("source").alias("_s")).agg(F.count("*").alias("_met"), F.max("slot").alias("_last"))
    lacking = needs.join(met, _same(F.col("_src"), F.col("_s")), "left").withColumn("_met", F.coalesce("_met", F.lit(0)))
    lacking = lacking.where("_met < _wanted").withColumn("_rank", F.explode(F.sequence("_met", F.col("_wanted") - 1)))
    any_slot = F.pmod(F.xxhash64("_src", F.lit("slot")), F.lit(max(1, slots)))
    lacking = lacking.withColumn("slot", F.coalesce("_last", any_slot))
    columns = ["slot", "n_blocks", "_words0", "_words1", "_rank"]
    every = ranked.select("source", *columns).unionByName(lacking.select(F.col("_src").alias("source"), *columns))
    number = F.pmod("_rank", "n_blocks")
    turn = F.floor(F.col("_rank") / F.col("n_blocks")).cast("int")
    left = F.when(turn == 0, F.col("_words0")).otherwise(F.col("_words1")) - number * size
    return every.select(
        "slot", "source", number.alias("block"), turn.alias("pass"), F.least(F.lit(size).cast("long"), left).alias("words")
    )


def op6_mixing(spark, sf_dir):
    plan, _ = mix(table(spark, sf_dir, "documents"))
    taken = (F.col("first") + F.col("second")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken, "first_slot", "second_slot")


def take_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int | None = None,
    step: int = GOLDEN,
) -> DataFrame:
    """The mix as documents: ``docs`` with the leading words that each pass takes, one row per document and pass, in the
    order of the slots at which they stand in the mix.

    ``n_chars``, where there, is set to the new length; all other columns are kept whatever their names. Null and empty
    texts and those without words go, as nothing of them is taken. Rows equal in id, text and source can't be told apart and
    share evenly what the mix takes of them; an empty table gives an empty mix.
    """
    rows, named = shielded(docs, (id_col, text_col, source_col, "n_chars"))
    plan, _ = mix(rows, id_col, text_col, source_col, block, step)
    takes = plan.groupBy(order_of("doc_id").alias("_pid"), F.col("_th").alias("_pth"), F.col("source").alias("_ps")).agg(
        F.count("*").alias("_copies"),
        F.max("size").alias("_size"),
        *[F.sum(c).alias(f"_{c}") for c in ("first", "second")],
        *[F.min(f"{c}_slot").alias(f"_{c}_slot") for c in ("first", "second")],
    )
    takes = materialize(takes.where("_first > 0"), "takes").hint("shuffle_hash")
    keyed = rows.withColumns(
        {"_id": order_of(id_col), "_th": F.xxhash64(F.coalesce(text_col, F.lit(""))), "_tie": F.xxhash64(F.monotonically_increasing_id())}
    )
    same = (F.col("_id") == F.col("_pid")) & (F.col("_th") == F.col("_pth")) & _same(F.col(source_col), F.col("_ps"))
    # of n equal rows each takes an n-th, and the words left over go to as many of them as there are words
    share = lambda c: F.floor(F.col(c) / F.col("_copies")) + (F.pmod("_tie", "_copies") < F.pmod(c, "_copies")).cast("long")
    taken = keyed.join(takes, same).withColumn(
        "_piece",
        F.explode(
            F.array(*[F.struct(share(f"_{c}").alias("words"), F.col(f"_{c}_slot").alias("slot")) for c in ("first", "second")])
        ),
    )
    taken = taken.where("_piece.words > 0").withColumn("_take", F.least("_piece.words", "_size"))
    pieces = F.regexp_extract_all(text_col, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("_take").cast("int")), "")
    taken = taken.withColumn(text_col, F.when(F.col("_take") == F.col("_size"), F.col(text_col)).otherwise(cut))
    if "n_chars" in docs.columns:
        taken = taken.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return taken.orderBy("_piece.slot", "_id", "_th").select(*named)
