"""Mixing sources to target weights by proportionate fair scheduling, with DataFrame and SQL functions only.

The rows of a source, in the order of a digest of their id, are cut into blocks of ``block_rows``, and every block gets a
slot. With the target weight ``w`` the n-th block of a source (from 0) is released at slot ``floor(n / w)`` and due before
slot ``ceil((n + 1) / w)``; every slot goes to the released block that is due first, ties to the first source by name. The
weights add up to one, so every block gets a slot in its window, and after any number of slots each source is less than
one block from its target, as long as it has rows. A source that runs out leaves its later slots empty and the others keep
their proportions; no row is dropped or repeated.

Every source is scheduled by its own weight, however many there are. ``schedule`` goes slot by slot in one row, which is for
at most ``MOST_SOURCES`` sources and twice ``MOST_SLOTS`` slots; slots are handed on in stretches, for appending to one long
array copies it. ``schedule_spread`` makes the same schedule of any number of blocks in tasks of bounded size. By default
``block_rows`` grows with the rows so that there are about ``MOST_SLOTS`` slots. Rows are numbered inside a source in
buckets of the digest, so a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rowtide.functions.lists import broadcast_if_short
from rowtide.functions.ordered import dense_index
from rowtide.llm.common import carried_row, stored

# A source without a weight takes one slot in so many. More than an eighth as many sources make it more.
LEAST = 1024
BLOCK_ROWS = 16
MOST_SLOTS, MOST_SOURCES, STRETCH = 32768, 1024, 256
# Default weights are the sources' row counts to this power, so that a large source does not crowd out the rest.
TEMPER = 0.5
# Rows numbered in one window.
BUCKET_ROWS = 64
# Blocks and slots that a task of ``schedule_spread`` sorts, and rounds of it between two stored tables.
SPREAD_ROWS, ROUNDS = 1 << 17, 6
# What a quotient may miss a whole number by and still count as one.
NEAR = 1e-6


def shares(counts: DataFrame, weights: dict[str, float] | None, temper: float) -> DataFrame:
    """``source, n, share``: the target weight of every source of ``counts`` (``source, n``); they add up to one.

    Sources that ``weights`` does not name or gives nothing take one slot in ``LEAST`` each and the others share the rest;
    if all are such, they are equal.
    """
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(temper))
    elif weights:
        pairs = [F.lit(x) for name, w in weights.items() for x in (name, float(w))]
        weight = F.greatest(F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), F.lit(0.0)), F.lit(0.0))
    else:
        weight = F.lit(0.0)
    weighed = counts.select("source", "n", weight.alias("weight"))
    every, without, sources = weighed.agg(F.sum("weight"), F.count_if(F.col("weight") == 0), F.count(F.lit(1))).first()
    if not every:
        return weighed.select("source", "n", F.lit(1 / max(1, sources)).alias("share"))
    least = 1 / max(LEAST, 1 << (8 * sources).bit_length())
    share = F.when(F.col("weight") == 0, least).otherwise(F.col("weight") / every * (1 - without * least))
    return weighed.select("source", "n", share.alias("share"))


def release(n: Column, share: Column) -> Column:
    """The first slot a block may have."""
    return F.floor(n / share + NEAR)


def deadline(n: Column, share: Column) -> Column:
    """The slot before which a block has to come."""
    return F.ceil((n + 1) / share - NEAR)


def schedule(lanes: DataFrame, slots: int) -> DataFrame:
    """``lane, share, block, slot`` of every block: earliest deadline first over ``slots`` slots.

    ``lanes`` has ``lane, share, blocks``. What is released is known per lane by its next block, so a slot looks at each
    lane once.
    """
    row = lanes.agg(F.sort_array(F.collect_list(F.struct("lane", "share", "blocks"))).alias("lanes"))
    window = "cast(floor({n} / {w} + {near}) as bigint)", "cast(ceil(({n} + 1) / {w} - {near}) as bigint)"

    def at(n: str, i: str) -> list[str]:
        """A lane's next block: its window, none if the lane has no more."""
        given = {"n": n, "w": f"lanes[{i}].share", "near": NEAR}
        opens, due = (w.format(**given) for w in window)
        return [f"if({n} < lanes[{i}].blocks, {opens}, {1 << 62}L) as opens", f"{due} as due"]

    def struct(*fields: str) -> str:
        return "named_struct(" + ", ".join(f"'{f.rsplit(' as ', 1)[1]}', {f.rsplit(' as ', 1)[0]}" for f in fields) + ")"

    first = f"transform(lanes, (x, i) -> {struct(*at('0L', 'i'), 'i as i', '0L as n')})"
    moved = struct(*at("(x.n + 1)", "x.i"), "x.i as i", "x.n + 1 as n")
    open_now = "filter(state.next, x -> x.opens <= t)"
    picked = f"array_min(transform({open_now}, x -> {struct('x.due as due', 'x.i as i', 'x.n as n')}))"
    step = f"""transform(array({picked}), p -> if(p is null, state, named_struct(
        'next', transform(state.next, x -> if(x.i = p.i, {moved}, x)),
        'out', concat(state.out, array(named_struct('slot', t, 'i', p.i, 'n', p.n))))))[0]"""
    slot_type = "array<struct<slot: bigint, i: int, n: bigint>>"
    stretch = f"""aggregate(sequence(k * {STRETCH}L, k * {STRETCH}L + {STRETCH - 1}L),
        named_struct('next', whole.next, 'out', cast(array() as {slot_type})), (state, t) -> {step})"""
    every = f"""aggregate(sequence(0L, {max(0, -(-slots // STRETCH) - 1)}L),
        named_struct('next', {first}, 'out', cast(array() as array<{slot_type}>)),
        (whole, k) -> transform(array({stretch}), done -> named_struct(
            'next', done.next, 'out', concat(whole.out, array(done.out))))[0]).out"""
    taken = row.filter("size(lanes) > 0").select("lanes", F.explode(F.expr(every)).alias("stretch"))
    taken = taken.select("lanes", F.explode("stretch").alias("x"))
    own = (F.expr(f"lanes[x.i].{c}").alias(c) for c in ("lane", "share"))
    return taken.select(*own, F.col("x.n").alias("block"), F.col("x.slot").alias("slot"))


def _queued(rows: DataFrame, count: int, largest: int) -> DataFrame:
    """Adds ``before`` and ``idle`` to ``node, value, is_slot, id, first``: blocks of the first half that come before a row of
    its node, and the slots before its value that these blocks leave empty. A node has at most ``largest`` of the ``count`` rows; if that is
    more than a task should hold, rows are dealt by ranges and the sums are carried from range to range."""
    order = ["value", "is_slot", "id"]

    def within(*group: str) -> DataFrame:
        window = Window.partitionBy(*group).orderBy(*order)
        before = F.coalesce(F.sum("first").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        idle = F.max(F.col("value") - F.col("before")).over(window.rowsBetween(Window.unboundedPreceding, 0))
        return rows.withColumn("before", before).withColumn("idle", idle)

    if largest <= SPREAD_ROWS:
        return within("node")
    rows = stored(rows.repartitionByRange(-(-count // SPREAD_ROWS), "node", *order).withColumn("part", F.spark_partition_id()), "mixing-ranges")
    held = within("node", "part")
    sums = held.groupBy("node", "part").agg(F.sum("first").alias("count"), F.max("idle").alias("top"))
    earlier = Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("passed", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    sums = sums.withColumn("least", F.max(F.col("top") - F.col("passed")).over(earlier))
    # a row per range and node in it
    held = held.join(F.broadcast(sums.select("node", "part", "passed", "least")), ["node", "part"])
    return held.select(
        "node", "value", "is_slot", "id", "first", (F.col("before") + F.col("passed")).alias("before"),
        F.greatest(F.col("idle") - F.col("passed"), "least").alias("idle"),
    )


def schedule_spread(lanes: DataFrame) -> DataFrame:
    """What ``schedule`` gives, for any number of lanes and blocks.

    A block takes the first slot from its release on that no block due before it takes, so the blocks due first can be
    scheduled without the others, and which slots they fill together follows from their releases alone: the i-th of them
    by release comes at the i-th slot, or later by the slots found empty until then. Every round halves the blocks by their
    rank in the order of deadlines: the slots that the first half fills are that half's, the others the second half's, and
    both go on with their slots numbered anew. In the end each block has one slot. A round is a sort and running sums.
    """
    blocks = lanes.select("lane", "share", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))
    blocks = blocks.withColumn("due", deadline(F.col("block"), F.col("share")))
    count = lanes.agg(F.sum("blocks")).first()[0] or 0
    ranges = -(-max(1, count) // SPREAD_ROWS)
    blocks = blocks.repartitionByRange(ranges, "due", "lane", "block").withColumn("part", F.spark_partition_id())
    order = [F.col(c) for c in ("due", "lane", "block")]
    ranked = stored(dense_index(stored(blocks, "mixing-blocks"), [], F.col("part"), order, "rank"), "mixing-ranks")
    rows = ranked.select(
        F.lit(0).cast("long").alias("node"), release(F.col("block"), F.col("share")).alias("value"),
        F.lit(False).alias("is_slot"), F.col("rank").alias("id"), F.lit(1).cast("long").alias("first"),
    )
    # the slots filled at all; from here on they are counted without the empty ones
    held = stored(_queued(rows, count, count), "mixing-filled")
    rows = held.select("node", (F.col("value") - F.col("idle")).alias("value"), "is_slot", "id")
    slots = held.select("node", F.col("before").alias("value"), F.lit(True).alias("is_slot"), (F.col("before") + F.col("idle")).alias("id"))
    rows = rows.unionByName(slots)
    for number, bit in enumerate(range(max(0, count - 1).bit_length() - 1, -1, -1), 1):
        first = F.when(~F.col("is_slot") & (F.shiftright("id", bit).bitwiseAND(F.lit(1)) == 0), 1).otherwise(0)
        held = _queued(rows.withColumn("first", first.cast("long")), 2 * count, min(2 * count, 4 << bit))
        # the first half's slots before a row's value, and whether a slot is the first half's
        filled = F.col("value") - F.col("idle")
        ours = F.when(F.col("is_slot"), F.col("before") > filled).otherwise(F.col("first") == 1)
        rows = held.select(
            (F.col("node") * 2 + F.when(ours, 0).otherwise(1)).alias("node"),
            F.when(ours, filled).otherwise(F.col("idle")).alias("value"), "is_slot", "id",
        )
        if number % ROUNDS == 0:
            rows = stored(rows, "mixing-halves")
    slots = rows.filter("is_slot").select(F.col("node").alias("rank"), F.col("id").alias("slot"))
    return ranked.join(slots, "rank").select("lane", "share", "block", "slot")


def _digested(docs: DataFrame, id_col: str, source_col: str, carry: bool) -> DataFrame:
    """``id, source, digest, tie``. Rows of equal id are told apart by their other columns; those without id come in the
    order of these."""
    plain = [docs[f.name] for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    tie = F.xxhash64(*plain)
    name = F.coalesce(docs[id_col].cast("string"), F.concat(F.lit("-"), tie.cast("string")))
    digest = F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")
    return docs.select(
        docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), digest.alias("digest"), tie.alias("tie"),
        *carried_row(docs, carry),
    )


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    carry: bool = False,
    block_rows: int = BLOCK_ROWS,
    temper: float = TEMPER,
    growing: bool = True,
) -> DataFrame:
    """``<id_col>, <source_col>, block, release, deadline, slot, position`` for every row; sort by ``position`` to read
    the mix.

    ``block_rows`` is the least size of a block, or its size at any number of rows without ``growing``. ``position`` is ``slot`` times the size of a block plus the place in the
    block, and unique. ``release <= slot < deadline`` by the source's target weight. A null source is a source of its own.
    Null ids and repeated rows get positions like others; rows that differ in nothing may change places. An empty table
    gives no rows. With ``carry`` the whole row comes along as a struct ``row``, so no column name can clash.
    """
    rows = _digested(docs, id_col, source_col, carry)
    # a row per source
    counts = stored(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "mixing-sources")
    wanted = shares(counts, weights, temper)
    sources, largest, longest = wanted.agg(
        F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max(F.col("n") / F.col("share")), F.lit(0.0))
    ).first()
    if growing:
        block_rows = max(block_rows, math.ceil(longest / MOST_SLOTS))
    lanes = wanted.select(F.col("source").alias("lane"), "share", F.expr(f"(n + {block_rows - 1}) div {block_rows}").alias("blocks"))
    lanes = stored(lanes, "mixing-lanes")
    # a lane's last block has its slot by its deadline; one of a single block may wait for all others
    last = F.max(F.when(F.col("blocks") > 1, deadline(F.col("blocks") - 1, F.col("share"))))
    slots = (lanes.agg(last).first()[0] or 0) + sources
    in_a_row = sources <= MOST_SOURCES and slots <= 2 * MOST_SLOTS + MOST_SOURCES
    # a row per block
    taken = stored(schedule(lanes, slots) if in_a_row else schedule_spread(lanes), "mixing-schedule")
    bits = max(4, min(20, (largest // BUCKET_ROWS).bit_length()))
    numbered = dense_index(
        rows, ["source"], F.shiftright("digest", 60 - bits), [F.col("digest"), F.col("id"), F.col("tie")], name="index"
    )
    placed = numbered.withColumn("at", F.expr(f"index div {block_rows}"))
    held = broadcast_if_short(taken)
    found = placed.join(held, F.col("source").eqNullSafe(F.col("lane")) & (F.col("at") == F.col("block")))
    return found.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "block",
        release(F.col("block"), F.col("share")).alias("release"),
        deadline(F.col("block"), F.col("share")).alias("deadline"),
        "slot",
        (F.col("slot") * block_rows + F.col("index") % block_rows).alias("position"),
        *(["row"] if carry else []),
    )
