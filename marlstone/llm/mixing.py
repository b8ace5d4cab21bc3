"""Mixing sources to target weights by entropy balancing, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.storage import store, with_position

#: A word is a run of other characters than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, weights: Sequence[int], share: float, cap: float
) -> DataFrame:
    """Adds ``target`` to (src, source_size), one row per source, none of them null.

    Sources by ``src`` weigh ``weights``, repeating, and share ``share`` times all
    sizes. A target stops at ``cap`` times its source's size; the excess goes to the
    others by weight until none is above. At the end every target is
    least(cap * size, weight * level) with one level for all, which is raised here
    from the sums of the sources that are not capped: two numbers a round, no
    table, reach the driver.
    """
    weight = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int")
    )
    ranked = store(
        with_position(sources, [], ["src"], "_at")
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * cap)
        .drop("_at")
    )
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level = None
    while True:
        over = F.lit(False) if level is None else F.col("most") <= F.col("weight") * level
        capped, free = ranked.agg(
            F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        raised = (total - capped) / free if free else level
        if raised is None or raised == level:
            break
        level = raised if level is None else max(level, raised)
    target = F.least("most", F.col("weight") * F.lit(float(level or 0.0)))
    return store(ranked.withColumn("target", target).drop("weight", "most"))


def _exact(value: Column) -> Column:
    """A double as a decimal, whose sums don't depend on the order of the rows."""
    return value.cast("decimal(28,6)")


def balanced_rates(
    cells: DataFrame, targets: DataFrame, cap: float, tolerance: float = 1e-6, rounds: int = 60
) -> DataFrame:
    """(src, tilt, scale, full): the solution of each source's dual.

    Entropy balancing: of all rates r between 0 and ``cap`` whose words,
    sum(r * size), meet the source's target, the one nearest to taking every document
    once (in relative entropy) is r = min(cap, exp(tilt * size / scale)). The
    tilt solves the convex dual, whose gradient is the words taken less the
    target. ``cells`` holds (src, size, n), a row per different size of a source: as
    rates depend on nothing else, no document is left out by it.

    A Newton round is one aggregate over the cells by source. Steps are taken on the
    logarithm of the words, stay within the bracket seen so far, and end once each
    source meets its target within ``tolerance`` of it. ``scale`` is a mean size,
    for well-sized steps only. Sources at the cap (``full``) take every document
    ``cap`` times.
    """
    means = cells.groupBy("src").agg(
        (F.sum(F.col("n") * F.col("size") * F.col("size").cast("double")).cast("decimal(38,0)")
         / F.sum(F.col("n") * F.col("size"))).cast("double").alias("scale")
    )
    start = (
        targets.where(F.col("source_size") > 0)
        .join(means, "src")
        .withColumn("full", F.col("target") >= F.col("source_size") * cap)
        .select(
            "src", "target", "scale", "full",
            F.log(F.col("target") / F.col("source_size")).alias("tilt"),
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            F.col("full").alias("done"),
        )
    )
    state = store(start)
    rate = F.exp(F.col("tilt") * F.col("size") / F.col("scale"))
    words = F.col("n") * F.col("size") * F.least(rate, F.lit(float(cap)))
    slope = F.when(rate < cap, words * F.col("size") / F.col("scale")).otherwise(0.0)
    for _ in range(rounds):
        if not state.where(~F.col("done")).limit(1).count():
            break
        open_ = state.where(~F.col("done"))
        sums = (
            cells.join(open_, "src")
            .groupBy("src")
            .agg(
                F.sum(_exact(words)).cast("double").alias("words"),
                F.sum(_exact(slope)).cast("double").alias("slope"),
            )
        )
        tilt, target, taken = F.col("tilt"), F.col("target"), F.col("words")
        above = taken > target
        low = F.when(above, F.col("low")).otherwise(tilt)
        high = F.when(above, tilt).otherwise(F.col("high"))
        step = tilt - F.try_divide(taken * F.log(taken / target), F.col("slope"))
        inside = (
            step.isNotNull()
            & ~F.isnan(step)
            & F.coalesce(step > low, F.lit(True))
            & F.coalesce(step < high, F.lit(True))
        )
        wide = F.greatest(F.lit(1.0), F.abs(tilt))
        halved = F.coalesce((low + high) / 2, F.when(above, tilt - wide).otherwise(tilt + wide))
        met = F.abs(taken - target) <= tolerance * target
        moved = open_.join(sums, "src").select(
            "src", "target", "scale", "full",
            F.when(met, tilt).when(inside, step).otherwise(halved).alias("tilt"),
            low.alias("low"),
            high.alias("high"),
            met.alias("done"),
        )
        state = store(moved.union(state.where("done").select(*moved.columns)))
    return state.select("src", "tilt", "scale", "full")


def _rounded(cells: DataFrame, rates: DataFrame, cap: int) -> DataFrame:
    """Whole copies of each cell: (src, size, n, copies), at most ``cap`` * n.

    Systematic rounding: the cells of a source are laid end to end by size, largest
    first, and a copy falls wherever their running sum passes a half. Documents of
    neighbouring cells are of nearly the same size, so errors cancel. Running sums are
    taken over blocks of 256 sizes, then within a block.
    """
    tilt = F.exp(F.col("tilt") * F.col("size") / F.col("scale"))
    rate = F.when(F.col("full"), F.lit(float(cap))).otherwise(F.least(tilt, F.lit(float(cap))))
    wanted = cells.join(rates, "src", "left").select(
        "src", "size", "n",
        F.coalesce(F.col("n") * rate, F.lit(0.0)).cast("decimal(28,9)").alias("wanted"),
        F.expr("size div 256").alias("block"),
    )
    earlier = Window.partitionBy("src").orderBy(F.desc("block")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    none = F.lit(0).cast("decimal(38,9)")
    before = wanted.groupBy("src", "block").agg(F.sum("wanted").alias("in_block")).withColumn(
        "before", F.coalesce(F.sum("in_block").over(earlier), none)
    )
    within = Window.partitionBy("src", "block").orderBy(F.desc("size")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    at = F.col("before") + F.coalesce(F.sum("wanted").over(within), none) + F.lit(0.5).cast("decimal(2,1)")
    return wanted.join(before.drop("in_block"), ["src", "block"]).select(
        "src", "size", "n",
        (F.floor(at + F.col("wanted")) - F.floor(at)).cast("long").alias("copies"),
    )


def _settled(copies: DataFrame, targets: DataFrame, cap: int, rounds: int = 12) -> DataFrame:
    """Cells with copies moved so that each source's words come nearer to its target.

    In each round a source adds or drops copies of its largest cell that fits into the
    words still missing or in excess; it ends when they are below 0.1 % of each
    target or no cell fits.
    """
    for _ in range(rounds):
        taken = copies.groupBy("src").agg(F.sum(F.col("copies") * F.col("size")).alias("words"))
        gaps = taken.join(targets.select("src", "target"), "src").select(
            "src", (F.col("target") - F.col("words")).alias("gap"), "target"
        )
        gaps = gaps.where(F.abs("gap") > 0.001 * F.col("target"))
        room = F.when(F.col("gap") > 0, cap * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("gap")) & (room > 0)
        picked = store(
            copies.join(gaps, "src")
            .where(fits)
            .groupBy("src")
            .agg(
                F.max_by(
                    F.struct(
                        "size",
                        F.least(room, F.floor(F.abs("gap") / F.col("size"))).alias("moved"),
                        F.signum("gap").cast("long").alias("sign"),
                    ),
                    "size",
                ).alias("p")
            )
            .select("src", F.col("p.size"), (F.col("p.moved") * F.col("p.sign")).alias("moved"))
        )
        if not picked.limit(1).count():
            break
        copies = store(
            copies.join(picked, ["src", "size"], "left").select(
                "src", "size", "n",
                (F.col("copies") + F.coalesce("moved", F.lit(0))).cast("long").alias("copies"),
            )
        )
    return copies


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    cap: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, copies, taken, row.

    Size is the words of the text. Targets by source: ``source_targets``. Rates by
    document: ``balanced_rates``. Copies, 0 to ``cap`` of each document: whole numbers
    per source and size (``_rounded``, ``_settled``), spread over the documents of
    that size by a hash of their id; taken = copies * size. ``row`` numbers the
    rows of ``docs``; it can be joined back as long as ``docs`` reads the same rows in
    the same partitions, as stored files do.

    Nothing is drawn at random, and all sums that decide copies are exact, so reruns agree. A
    source or a size with very many rows is pre-aggregated, and its rows are numbered
    in range partitions. Null texts have size 0, a null source is one more source,
    the last; sizes of 0 take no words. Ids may repeat or be null. An empty table gives an
    empty table; other columns are not read.
    """
    source = F.col(source_col).cast("string")
    # Never null: byte order is code point order, and null comes last.
    key = F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))
    rows = store(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("_id"),
            key.alias("src"),
            word_count(F.col(text_col)).alias("size"),
        )
    )
    cells = store(rows.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = cells.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(sources, weights, share, float(cap))
    rates = balanced_rates(cells, targets, float(cap))
    copies = _settled(store(_rounded(cells, rates, cap)), targets, cap)
    dealt = with_position(
        rows.withColumn("_hash", F.xxhash64("_id")), ["src", "size"], ["_hash", "_id", "row"], "_at"
    )
    whole, extra = F.expr("copies div n"), F.col("copies") % F.col("n")
    return (
        dealt.join(copies, ["src", "size"])
        .join(targets, "src")
        .withColumn("copies", (whole + (F.col("_at") < extra).cast("int")).cast("int"))
        .select(
            F.col("_id").alias(id_col),
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            "row",
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, in its own columns."""
    name = "_row"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    copies = mix_sources(docs, **options).where(F.col("copies") > 0)
    numbered = docs.withColumn(name, F.monotonically_increasing_id())
    taken = copies.select(F.col("row").alias(name), F.col("copies").alias(name + "n"))
    repeated = numbered.join(taken, name).withColumn(
        name + "k", F.explode(F.sequence(F.lit(1), F.col(name + "n")))
    )
    return repeated.select(*docs.columns)
