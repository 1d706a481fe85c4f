"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, order_of, table

#: Three subtables of so many cells; every digest has one cell in each.
TABLES, CELLS = 3, 8
#: Peeling steps before a sketch counts as failed, and how often a failed one is retried larger.
ROUNDS, RETRIES = 6, 4
#: A retry has a sketch for each so many digests that differ, at most so many at a time where its parts fail again.
LOAD, PARTS = 1, 64
#: Documents of neighbouring ids that are shuffled together.
NEIGHBOURS = 256
#: Paragraphs are lines, and in them sentences or fields, cut after their marks.
SENTENCE = r"\n+|(?<=[.!?|;*#$%&])\s+"
#: Longer ones are cut at words, and where words are long at characters, by content: after about every so many of them,
#: as the hash of the last WINDOW says, and after MOST times as many at the latest.
WORDS, CHARACTERS, WINDOW, MOST = 12, 128, 3, 2

CELL = "struct<n:int,key:bigint,check:bigint>"
FOUND = "array<struct<n:int,key:bigint>>"
PART = "array<struct<keys:array<struct<n:int,key:bigint>>,load:double>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body, or a lambda in it, reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cut(units: Column, between: str, every: int, piece: str) -> Column:
    """The pieces of a list of units: cut where their own hash says so, so that a change moves no cut beyond the next one."""

    def marked(unit: Column, at: Column) -> Column:
        last = F.slice(units, F.greatest(at - (WINDOW - 2), F.lit(1)), F.least(at + 1, F.lit(WINDOW)))
        cut = (F.pmod(F.xxhash64(last), F.lit(every)) == 0) & (at + 1 < F.size(units))
        return F.when(cut, F.concat(unit, F.lit("\n"))).otherwise(unit)

    pieces = F.split(F.array_join(F.transform(units, marked), between), "\n" + between)
    return F.flatten(F.transform(pieces, lambda p: F.regexp_extract_all(p, F.lit(piece), F.lit(0))))


def _cut_words(sentence: Column) -> Column:
    piece = rf"(?:\S++\s*+){{1,{MOST * WORDS}}}"
    cut = let(F.split(F.trim(sentence), r"\s+"), lambda units: F.when(
        F.size(units) > MOST * WORDS, _cut(units, " ", WORDS, piece)
    ).otherwise(F.array(sentence)))
    # others cannot hold so many words, even with an empty one at either end, and are not split
    long = (F.length(sentence) >= 2 * MOST * WORDS - 2) & F.rlike(sentence, F.lit(rf"^\s*+(?:\S++\s++){{{MOST * WORDS - 2}}}\S"))
    return F.when(long, cut).otherwise(F.array(sentence))


def _cut_characters(text: Column) -> Column:
    piece = rf"(?s).{{1,{MOST * CHARACTERS}}}"
    return F.when(
        F.length(text) > MOST * CHARACTERS, let(F.split(text, ""), lambda units: _cut(units, "", CHARACTERS, piece))
    ).otherwise(F.array(text))


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text, by one rule at every length."""
    pieces = F.flatten(F.transform(F.split(text, SENTENCE), _cut_words))
    pieces = F.flatten(F.transform(pieces, _cut_characters))
    return F.array_distinct(F.transform(F.filter(pieces, lambda p: p != ""), lambda p: F.xxhash64(p)))


def _placed(key: Column, level: int) -> Column:
    """A digest with its check and its cell in each subtable: nine bits of the digest for each level."""
    return F.struct(
        key.alias("key"),
        F.xxhash64(key).alias("check"),
        *[
            (F.shiftrightunsigned(key, 9 * level + 3 * t).bitwiseAND(F.lit(CELLS - 1)) + CELLS * t).cast("int").alias(f"c{t}")
            for t in range(TABLES)
        ],
    )


def _hits(placed: Column, cell: Column) -> Column:
    return (placed["c0"] == cell) | (placed["c1"] == cell) | (placed["c2"] == cell)


def _cell(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), key.alias("key"), check.alias("check"))


def _cells(signed: Column) -> Column:
    """The cells of signed digests (n, d): the sum of the signs in each, and the xor of the digests and of their checks."""
    zero = _cell(F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))

    def add(now: Column, s: Column) -> Column:
        return _cell(now["n"] + s["n"], now["key"].bitwiseXOR(s["d"]["key"]), now["check"].bitwiseXOR(s["d"]["check"]))

    def subtable(placed: Column, t: int) -> Column:
        return F.transform(
            F.sequence(F.lit(CELLS * t), F.lit(CELLS * (t + 1) - 1)),
            lambda cell: F.aggregate(F.filter(placed, lambda s: s["d"][f"c{t}"] == cell), zero, add),
        )

    return let(signed, lambda placed: F.concat(*[subtable(placed, t) for t in range(TABLES)]))


def sketch(keys: Column) -> Column:
    """The published cells of a set of digests: how many fall in each, and the xor of them and of their checks."""
    return _cells(F.transform(keys, lambda key: F.struct(F.lit(1).alias("n"), _placed(key, 0).alias("d"))))


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(
        left,
        right,
        lambda a, b: _cell(a["n"] - b["n"], a["key"].bitwiseXOR(b["key"]), a["check"].bitwiseXOR(b["check"])),
    )


def peel(cells: Column, level: int = 0) -> Column:
    """(failed, found): the digests that are in one version alone, n = 1 in the left one and -1 in the right one.

    A cell that holds one digest shows it by its check; taking that digest out of its other cells lays further ones
    bare. It failed when cells are left over.
    """

    nothing = _cell(F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))

    def plus(now: Column, cell: Column, sign: int) -> Column:
        return _cell(
            now["n"] + sign * cell["n"], now["key"].bitwiseXOR(cell["key"]), now["check"].bitwiseXOR(cell["check"])
        )

    def step(state: Column, _: Column) -> Column:
        def bare(cell: Column) -> Column:
            return (F.abs(cell["n"]) == 1) & (cell["check"] == F.xxhash64(cell["key"]))

        def shown(cell: Column) -> Column:
            return F.struct(cell["n"].alias("n"), _placed(cell["key"], level).alias("d"))

        def without(pure: Column) -> Column:
            def take(cell: Column) -> Callable[[Column, Column], Column]:
                return lambda now, p: F.when(
                    _hits(p["d"], cell),
                    _cell(
                        now["n"] - p["n"],
                        now["key"].bitwiseXOR(p["d"]["key"]),
                        now["check"].bitwiseXOR(p["d"]["check"]),
                    ),
                ).otherwise(now)

            # the first subtable adds up to all digests: where those laid bare do too, no cell is left
            total = F.aggregate(F.slice(state["cells"], 1, CELLS), nothing, lambda now, cell: plus(now, cell, 1))
            rest = F.aggregate(pure, total, lambda now, p: plus(now, F.struct(p["n"].alias("n"), p["d"]["key"].alias("key"), p["d"]["check"].alias("check")), -1))
            complete = let(rest, lambda r: (r["n"] == 0) & (r["key"] == 0) & (r["check"] == 0))
            left = (
                F.when(F.size(pure) == 0, state["cells"])
                .when(complete, F.array().cast(f"array<{CELL}>"))
                .otherwise(F.transform(state["cells"], lambda cell, at: F.aggregate(pure, cell, take(at))))
            )
            found = F.transform(pure, lambda p: F.struct(p["n"].alias("n"), p["d"]["key"].alias("key")))
            return F.struct(
                left.alias("cells"), F.concat(state["found"], found).alias("found"), (F.size(pure) > 0).alias("going")
            )

        peeled = let(F.array_distinct(F.transform(F.filter(state["cells"], bare), shown)), without)
        return F.when(state["going"], peeled).otherwise(state)

    start = F.struct(
        cells.cast(f"array<{CELL}>").alias("cells"), F.array().cast(FOUND).alias("found"), F.lit(True).alias("going")
    )
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return let(
        end,
        lambda e: F.struct(
            F.exists(e["cells"], lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0)).alias("failed"),
            e["found"].alias("found"),
        ),
    )


def _larger(left: str, right: str, load: Column) -> Column:
    """(found, rest): a larger sketch of both versions' digests, its first subtable read, with CELLS cells for each of ``load``.

    Digests are brought together by cell in one sort of their places, and only cells that hold any are made. A cell adds up to
    the difference of both versions; one that is left with a single digest shows it. ``rest`` are the digests of the others.
    """
    keys, ours = F.concat(F.col(left), F.col(right)), F.size(left)
    # an odd number, so that a cell says little about the bits that its digests are dealt by next
    cells = (F.floor(load * (CELLS / LOAD)) + 1).bitwiseOR(F.lit(1))
    nothing = _cell(F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))

    def sign(place: Column) -> Column:
        return F.when(place < ours, 1).otherwise(-1)

    def read(both: Column) -> Column:
        placed = F.transform(
            both["keys"],
            lambda key, at: F.shiftleft(F.pmod(F.shiftrightunsigned(key, 17), both["cells"]), 32).bitwiseOR(at.cast("bigint")),
        )
        return let(F.sort_array(placed), lambda order: grouped(both["keys"], order))

    def grouped(keys: Column, order: Column) -> Column:
        def first(at: Column) -> Column:
            return (at == 0) | (F.shiftright(F.get(order, at), 32) != F.shiftright(F.get(order, at - 1), 32))

        def held(starts: Column) -> Column:
            return F.transform(starts, lambda start, n: F.slice(order, start + 1, F.coalesce(F.get(starts, n + 1), F.size(order)) - start))

        places = F.filter(F.sequence(F.lit(0), F.size(order) - 1), first)
        return let(let(places, held), lambda members: decided(keys, members))

    def decided(keys: Column, members: Column) -> Column:
        def place(packed: Column) -> Column:
            return packed.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")

        def add(now: Column, packed: Column) -> Column:
            def plus(key: Column) -> Column:
                return _cell(now["n"] + sign(place(packed)), now["key"].bitwiseXOR(key), now["check"].bitwiseXOR(F.xxhash64(key)))

            return let(F.get(keys, place(packed)), plus)

        def several(cell: Column) -> Column:
            empty = (cell["n"] == 0) & (cell["key"] == 0) & (cell["check"] == 0)
            bare = (F.abs(cell["n"]) == 1) & (cell["check"] == F.xxhash64(cell["key"]))
            return F.when(empty, 0).when(bare, 1).otherwise(2)

        def signed(packed: Column) -> Column:
            return F.struct(sign(place(packed)).alias("n"), F.get(keys, place(packed)).alias("key"))

        made = F.transform(members, lambda m: F.struct(m.alias("m"), F.aggregate(m, nothing, add).alias("cell")))
        told = F.transform(made, lambda c: F.struct(c["m"].alias("m"), c["cell"].alias("cell"), several(c["cell"]).alias("several")))
        return let(
            told,
            lambda t: F.struct(
                F.transform(F.filter(t, lambda c: c["several"] == 1), lambda c: F.struct(c["cell"]["n"].alias("n"), c["cell"]["key"].alias("key"))).alias("found"),
                F.transform(
                    F.filter(t, lambda c: c["several"] == 2),
                    lambda c: F.struct(F.transform(c["m"], signed).alias("keys"), F.size(c["m"]).cast("double").alias("load")),
                ).alias("rest"),
            ),
        )

    return let(F.struct(keys.alias("keys"), cells.alias("cells")), read)


def _parts(shift: int) -> Callable[[Column], Column]:
    """Deals the signed digests of both versions into parts for LOAD that differ, by further bits of them."""

    def parts(pair: Column) -> Column:
        def dealt(both: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), both["count"] - 1),
                lambda part: F.struct(
                    F.transform(
                        F.filter(both["hashed"], lambda h: h["part"] == part), lambda h: F.struct(h["k"]["n"].alias("n"), h["k"]["key"].alias("key"))
                    ).alias("keys"),
                    (pair["load"] / both["count"]).alias("load"),
                ),
            )

        def hashed(count: Column) -> Column:
            marked = F.transform(
                pair["keys"],
                lambda k: F.struct(k.alias("k"), F.pmod(F.shiftrightunsigned(k["key"], shift), count).alias("part")),
            )
            return let(F.struct(marked.alias("hashed"), count.alias("count")), dealt)

        return let(F.least(F.lit(PARTS), F.floor(pair["load"] / LOAD).cast("int") + 1), hashed)

    return parts


def _tries(level: int) -> Callable[[Column], Column]:
    """A part with its larger sketch peeled: signed digests add up to the difference of both versions' sketches.

    The sketch's first subtable is read first: where each of its cells is empty or holds one digest, all are found, and
    the other subtables are not made.
    """
    zero = _cell(F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))

    def add(now: Column, k: Column) -> Column:
        return _cell(now["n"] + k["n"], now["key"].bitwiseXOR(k["key"]), now["check"].bitwiseXOR(F.xxhash64(k["key"])))

    def tries(part: Column) -> Column:
        keys = part["keys"]
        subtable = F.transform(
            F.sequence(F.lit(0), F.lit(CELLS - 1)),
            lambda cell: F.aggregate(
                F.filter(keys, lambda k: F.shiftrightunsigned(k["key"], 9 * level).bitwiseAND(F.lit(CELLS - 1)) == cell), zero, add
            ),
        )

        def read(cells: Column) -> Column:
            held = F.filter(cells, lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))
            several = F.exists(held, lambda c: (F.abs(c["n"]) != 1) | (c["check"] != F.xxhash64(c["key"])))
            signed = F.transform(keys, lambda k: F.struct(k["n"].alias("n"), _placed(k["key"], level).alias("d")))
            found = F.transform(held, lambda c: F.struct(c["n"].alias("n"), c["key"].alias("key")))
            return F.when(several, peel(_cells(signed), level)).otherwise(
                F.struct(F.lit(False).alias("failed"), found.alias("found"))
            )

        return F.struct(keys.alias("keys"), let(subtable, read).alias("p"))

    return tries


def _difference(df: DataFrame, left: str, right: str, left_cells: str, right_cells: str, out: str) -> DataFrame:
    """Adds ``out``: the digests of one version alone, from the published sketches or, where those fail, larger ones.

    A failed sketch is retried larger, the larger the more digests differ as the published cells tell. What its first
    subtable does not show is dealt by hash into parts of about LOAD, with a sketch of fresh cells in three subtables for
    each. Parts that fail again are cut again. What still fails after RETRIES is compared digest by digest, so nothing is
    lost. All of it happens in the row, in time linear in the digests.
    """
    tried, larger, found, rest = (f"_{out}_{part}" for part in ("tried", "larger", "found", "rest"))
    df = df.withColumn(tried, peel(subtract(F.col(left_cells), F.col(right_cells))))
    # the counts' squares add up to about three times the number of digests that differ
    squares = F.aggregate(
        F.zip_with(left_cells, right_cells, lambda x, y: (x["n"] - y["n"]) * (x["n"] - y["n"])), F.lit(0), lambda s, x: s + x
    )
    load = F.least(squares / 3 + LOAD, (F.size(left) + F.size(right)).cast("double"))
    df = df.withColumn(larger, F.when(F.col(tried)["failed"], _larger(left, right, load)))
    df = df.withColumns(
        {
            found: F.coalesce(F.col(larger)["found"], F.col(tried)["found"]).cast(FOUND),
            rest: F.coalesce(F.col(larger)["rest"], F.array().cast(PART)).cast(PART),
        }
    )
    for level in range(1, RETRIES + 1):
        # the columns are read more than once, so that Spark keeps each level's work to itself
        dealt = F.flatten(F.transform(rest, _parts(35 + 5 * level)))
        df = df.withColumn(tried, F.when(F.size(rest) > 0, F.transform(dealt, _tries(level))))
        more = F.flatten(F.transform(F.filter(tried, lambda t: ~t["p"]["failed"]), lambda t: t["p"]["found"]))
        left_over = F.transform(
            F.filter(tried, lambda t: t["p"]["failed"]),
            lambda t: F.struct(t["keys"].alias("keys"), F.size(t["keys"]).cast("double").alias("load")),
        )
        df = df.withColumns(
            {
                found: F.when(F.col(tried).isNull(), F.col(found)).otherwise(F.concat(found, more)),
                rest: F.when(F.col(tried).isNull(), F.col(rest)).otherwise(left_over),
            }
        )

    def alone(part: Column) -> Column:
        keys = part["keys"]
        return F.filter(keys, lambda k: ~F.exists(keys, lambda o: (o["key"] == k["key"]) & (o["n"] != k["n"])))

    return df.withColumn(out, F.concat(F.col(found), F.flatten(F.transform(rest, alone)))).drop(tried, larger, found, rest)


def likeness(difference: str, left: str, right: str) -> Column:
    """Share of the digests of both versions that the other has too; two versions without any are alike."""
    total = F.size(left) + F.size(right)
    return F.when(total == 0, F.lit(1.0)).otherwise(1 - F.size(difference) / total).cast("double")


def as_text(cells: Column) -> Column:
    """The cells in hexadecimal digits: count, digests and checks of each."""
    wide = lambda x, n: F.substring(F.lpad(F.hex(x), 16, "0"), 17 - n, n)
    return F.lower(F.array_join(F.transform(cells, lambda c: F.concat(wide(c["n"].cast("bigint"), 4), wide(c["key"], 16), wide(c["check"], 8))), ""))


def with_next_text(docs: DataFrame, **derived: Column) -> DataFrame:
    """``docs`` (_id, _th, text, ...) with ``next_text``: that of the next document by (_id, _th), the first after the last.

    ``derived`` columns are worked out once for each row, after the shuffle, from the text or the ones before, and given for
    the text and as ``next_...`` for the next one.

    Documents are shuffled once, by blocks of neighbouring ids, as wide as leaves about NEIGHBOURS rows in each however
    sparse ids are; rows without an id are dealt over blocks of their own by their text's hash. Only the first text of each
    block is sent to the block before it; blocks find their successors within spans of 2^16 blocks, and spans in a list
    that has a row for some 2^24 rows.
    """
    known = F.col("_id") < LAST_ID
    low, high, some, every = docs.agg(
        F.min(F.when(known, F.col("_id"))), F.max(F.when(known, F.col("_id"))), F.count(F.when(known, 1)), F.count("*")
    ).first()
    low, high = (low, high) if some else (0, 0)
    width = max(NEIGHBOURS, -(-(high - low + 1) // max(1, some // NEIGHBOURS)))
    beyond = (high - low) // width + 1
    parts = max(1, (every - some) // NEIGHBOURS)
    # differences of ids may exceed 64 bits
    place = F.floor((F.col("_id").cast("decimal(38,0)") - F.lit(low).cast("decimal(38,0)")) / F.lit(width).cast("decimal(38,0)"))
    unknown = F.least(F.floor((F.col("_th") / F.lit(2.0**64) + 0.5) * parts), F.lit(parts - 1)).cast("long") + F.lit(beyond)
    blocks = docs.withColumn("_block", F.when(known, place.cast("long")).otherwise(unknown))
    heads = blocks.groupBy("_block").agg(F.min_by("text", F.struct("_id", "_th")).alias("_head"))
    spanned = heads.select("_block", F.floor(F.col("_block") / (1 << 16)).alias("_span"), "_head")
    spans = spanned.groupBy("_span").agg(F.min("_block").alias("_first"))
    in_order = Window.orderBy("_span")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = spans.select(
        F.col("_span").alias("_s"),
        F.coalesce(F.lead("_first").over(in_order), F.min("_first").over(whole)).alias("_after"),
    )
    names = spanned.select("_block", "_span").withColumn("_next", F.lead("_block").over(Window.partitionBy("_span").orderBy("_block")))
    names = names.join(spans, names._span == spans._s).select(F.col("_block").alias("_b"), F.coalesce("_next", "_after").alias("_next"))
    following = names.join(spanned.select(F.col("_block").alias("_n"), "_head"), F.col("_next") == F.col("_n")).select("_b", "_head")
    near = Window.partitionBy("_block").orderBy("_id", "_th")
    carried = ["text", *derived]

    def enlarged(df: DataFrame) -> DataFrame:
        for name, of in derived.items():
            df = df.withColumn(name, of)
        return df

    placed = enlarged(blocks.repartition("_block")) if derived else blocks
    marked = placed.withColumns({"_lead": F.lead(F.struct(*carried)).over(near), "_last": F.lead("_id").over(near).isNull()})
    heads = enlarged(following.select("_b", F.col("_head").alias("text"))).select("_b", F.struct(*carried).alias("_head"))
    joined = marked.join(heads, (F.col("_block") == F.col("_b")) & F.col("_last"), "left")
    after = F.coalesce("_lead", "_head")
    return joined.withColumns({f"next_{name}": after[name] for name in carried}).drop("_block", "_lead", "_last", "_b", "_head")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edited version and the next document's text, by their sketches.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many of the next document.
    Returns doc_id, n_chars, edited_sha256, the two fingerprints, ``edited_found`` and ``next_found`` (the digests of one
    side alone, n = 1 in the text and -1 in the other) and the likenesses near_edited and near_next.

    Null texts count as empty; an empty text has no paragraphs, and two such are alike. Rows without an id come last,
    equal ids in the order of their texts' hashes; a single row is its own next document.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        order_of(id_col).alias("_id"),
        F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("_th"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    n = F.length("text").cast("long")
    cut = F.floor(n / 4).cast("int")
    paired = with_next_text(rows, own=digests(F.col("text")), own_cells=sketch(F.col("own"))).withColumn("n_chars", n)
    paired = paired.withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), F.length("text") - cut), F.substring("next_text", F.lit(1), cut))
    )
    sets = paired.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "own",
        digests(F.col("edited")).alias("new"),
        F.col("next_own").alias("other"),
        "own_cells",
        F.col("next_own_cells").alias("other_cells"),
    )
    sets = sets.withColumn("new_cells", sketch(F.col("new")))
    sets = _difference(sets, "own", "new", "own_cells", "new_cells", "edited_found")
    sets = _difference(sets, "own", "other", "own_cells", "other_cells", "next_found")
    return sets.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own_cells")).alias("fingerprint"),
        as_text(F.col("new_cells")).alias("edited_fingerprint"),
        "edited_found",
        "next_found",
        likeness("edited_found", "own", "new").alias("near_edited"),
        likeness("next_found", "own", "other").alias("near_next"),
    )


def op3_fingerprints(spark, sf_dir):
    return fingerprint_edits(table(spark, sf_dir, "documents")).drop("edited_found", "next_found")
