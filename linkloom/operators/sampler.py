"""Elastic throughput sampler.

Per worker, with jobs in time order: the first job sets ``last``; every job is
counted; a job at least one ``rate`` after ``last`` closes the sample, counts in
the sample it closes, and becomes the new ``last``. A gap of g whole rates takes
g slots: the closed sample and g - 1 zeros. What is left at the end is one more,
open sample. Boundaries drift with the jobs, so this is not a tumbling window.

Input is a table of ticks (worker, t, n): n jobs at microsecond t. Output is one
row per non-empty or open sample: (worker, start, idx, jobs, slots, open, since),
where ``since`` is ``last`` at the beginning of the sample.

Workers with few ticks are folded inside one row. Above that limit the chain of
boundaries is found with joins, see ``_chain``: work is linear in the ticks,
the number of rounds is logarithmic in the number of rates covered, and neither
a busy worker nor a busy period ends up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.times import from_micros, micros
from linkloom.session import materialize, spread

FOLD_LIMIT = 50_000
_FOLD_BLOCK = 256
SECOND = 1_000_000
# Bucket widths of the look-up for "first tick at or after". A bucket holds at
# most as many ticks as the width has microseconds (or finer buckets).
_WIDTHS = [SECOND, 3_600 * SECOND]
_SLOT_CHUNK = 100_000


def ticks(log: DataFrame, worker: str = "worker", ts: str = "processed_at") -> DataFrame:
    """Job log -> (worker, t, n). Jobs without a time have no place, see ``untimed``."""
    timed = log.where(F.col(ts).isNotNull())
    return timed.select(F.col(worker).alias("worker"), micros(F.col(ts)).alias("t"), F.lit(1).cast("long").alias("n"))


def untimed(log: DataFrame, worker: str = "worker", ts: str = "processed_at") -> DataFrame:
    """Jobs per worker that ``ticks`` leaves out for want of a time."""
    return log.where(F.col(ts).isNull()).groupBy(F.col(worker).alias("worker")).agg(F.count("*").alias("n_untimed"))


def whole_rates(span: Column, rate: int) -> Column:
    """Whole rates in a non-negative span; exact, as only a multiple is divided."""
    return ((span - span % rate) / rate).cast("long")


def samples(tick_rows: DataFrame, rate_seconds: float, fold_limit: int = FOLD_LIMIT) -> DataFrame:
    """Non-zero and open samples of every worker; the NULL worker is one like any other."""
    rate = round(rate_seconds * SECOND)
    # In a struct a NULL equals a NULL, so the joins below keep such workers.
    tick_rows = tick_rows.withColumn("worker", F.struct("worker"))
    sizes = tick_rows.groupBy("worker").agg(F.count("*").alias("_ticks"), F.min("t").alias("start"))
    busy = materialize(sizes.where(F.col("_ticks") > fold_limit).drop("_ticks"), "busy-workers")
    if busy.isEmpty():
        found = _fold(tick_rows, rate)
    else:
        calm = tick_rows.join(busy.select("worker"), "worker", "left_anti")
        found = _fold(calm, rate).unionByName(_chain(tick_rows.join(busy, "worker"), busy, rate))
    # Stored, as every report reads the samples more than once.
    return materialize(found.withColumn("worker", F.col("worker.worker")), "samples")


def _fold(tick_rows: DataFrame, rate: int) -> DataFrame:
    ordered = tick_rows.groupBy("worker").agg(
        F.array_sort(F.collect_list(F.struct("t", "n"))).alias("_ticks")
    )
    zero = F.lit(0).cast("long")
    start = F.col("_ticks")[0]["t"]

    def sample(state: Column, jobs: Column, slots: Column, is_open: bool) -> Column:
        return F.struct(
            state["idx"].alias("idx"),
            jobs.alias("jobs"),
            slots.alias("slots"),
            F.lit(is_open).alias("open"),
            state["last"].alias("since"),
        )

    nothing = F.array().cast("array<struct<idx:bigint,jobs:bigint,slots:bigint,open:boolean,since:bigint>>")
    begin = F.struct(start.alias("last"), zero.alias("acc"), zero.alias("idx"), nothing.alias("done"))

    def step(state: Column, tick: Column) -> Column:
        slots = whole_rates(tick["t"] - state["last"], rate)
        closes = tick["t"] - state["last"] >= rate
        closed = sample(state, state["acc"] + 1, slots, False)
        return F.struct(
            F.when(closes, tick["t"]).otherwise(state["last"]).alias("last"),
            F.when(closes, tick["n"] - 1).otherwise(state["acc"] + tick["n"]).alias("acc"),
            F.when(closes, state["idx"] + slots).otherwise(state["idx"]).alias("idx"),
            F.when(closes, F.concat(state["done"], F.array(closed))).otherwise(state["done"]).alias("done"),
        )

    def finish(state: Column) -> Column:
        rest = sample(state, state["acc"], F.lit(1).cast("long"), True)
        return F.concat(state["done"], F.array(rest))

    def block(state: Column, start: Column) -> Column:
        """Fold one block; appending per block keeps array copies short."""
        resumed = F.struct(
            state["last"].alias("last"), state["acc"].alias("acc"), state["idx"].alias("idx"), nothing.alias("done")
        )

        def joined(inner: Column) -> Column:
            return F.struct(
                inner["last"].alias("last"),
                inner["acc"].alias("acc"),
                inner["idx"].alias("idx"),
                F.concat(state["done"], inner["done"]).alias("done"),
            )

        return F.aggregate(F.slice("_ticks", start, _FOLD_BLOCK), resumed, step, joined)

    starts = F.sequence(F.lit(1), F.size("_ticks"), F.lit(_FOLD_BLOCK))
    folded = ordered.select(
        "worker", start.alias("start"), F.aggregate(starts, begin, block, finish).alias("_samples")
    )
    # The inner form would fold twice: once to test for emptiness.
    return folded.select("worker", "start", F.inline_outer("_samples")).where("idx is not null")


def _first_at_or_after(points: DataFrame, queries: DataFrame, widths: list[int]) -> DataFrame:
    """(worker, q, found): the smallest point t >= q of the worker, or NULL.

    Both sides meet in one window per time bucket; queries that find nothing in
    their own bucket go on with the first points of coarser buckets.
    """
    width = widths[0] if widths else None
    bucket = (lambda c: F.expr(f"{c} div {width}")) if width else (lambda c: F.lit(0).cast("long"))
    none = F.lit(None).cast("long")
    both = points.select("worker", bucket("t").alias("b"), F.col("t").alias("at"), F.col("t").alias("p"), none.alias("q"))
    both = both.unionByName(
        queries.select("worker", bucket("q").alias("b"), F.col("q").alias("at"), none.alias("p"), "q")
    )
    later = (
        Window.partitionBy("worker", "b")
        .orderBy(F.col("at").desc(), F.col("q").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    looked_up = both.withColumn("found", F.min("p").over(later)).where("q is not null").select("worker", "q", "found")
    if width is None:
        return looked_up
    looked_up = materialize(looked_up, "lookup")
    nxt = F.expr(f"(q div {width} + 1) * {width}")
    open_ends = looked_up.where("found is null").select("worker", "q", nxt.alias("_edge"))
    firsts = points.groupBy("worker", F.expr(f"t div {width}").alias("b")).agg(F.min("t").alias("t")).drop("b")
    edges = open_ends.select("worker", F.col("_edge").alias("q")).distinct()
    coarser = _first_at_or_after(firsts, edges, widths[1:]).select("worker", F.col("q").alias("_edge"), "found")
    return (
        looked_up.where("found is not null")
        .unionByName(open_ends.join(coarser, ["worker", "_edge"]).select("worker", "q", "found"))
    )


def _chain(tick_rows: DataFrame, busy: DataFrame, rate: int) -> DataFrame:
    """Samples of busy workers.

    The time of a worker is cut into cells of one rate, counted from its first
    job. A tick points to the first tick at least one rate later: the boundary
    that would follow if the tick were one. Level l has blocks of 2**l cells and
    keeps, for the ticks that can be the first boundary in their block, the first
    boundary beyond the block. Going up halves the table per level; going down
    from the first job unfolds the boundaries that are really reached.
    """
    from linkloom.operators.ordering import with_running_sums

    unique = tick_rows.groupBy("worker", (F.col("t") - F.col("start")).alias("r")).agg(F.sum("n").alias("n"))
    unique = materialize(unique, "ticks")
    points = unique.select("worker", F.col("r").alias("t"))
    wanted = unique.select("worker", (F.col("r") + rate).alias("q"))
    found = _first_at_or_after(points, wanted, _WIDTHS)
    level = materialize(
        found.select(
            "worker",
            (F.col("q") - rate).alias("r"),
            F.expr(f"(q - {rate}) div {rate}").alias("cell"),
            F.col("found").alias("nxt"),
            F.expr(f"found div {rate}").alias("nxt_cell"),
        ),
        "pointers",
    )
    levels = [level]
    last_cell = level.agg(F.max("cell")).first()[0]
    for up in range(1, int(last_cell).bit_length() + 1):
        level = materialize(_contract(level, up), "pointers")
        levels.append(level)

    reached = materialize(busy.select("worker", F.lit(0).cast("long").alias("r")), "boundaries")
    for down in range(len(levels) - 1, 0, -1):
        below = levels[down - 1]
        steps = reached.join(below, ["worker", "r"]).where(
            f"nxt is not null and shiftright(nxt_cell, {down}) = shiftright(cell, {down})"
        )
        reached = materialize(reached.unionByName(steps.select("worker", F.col("nxt").alias("r"))), "boundaries")

    closings = reached.join(levels[0].where("nxt is not null"), ["worker", "r"]).select(
        "worker",
        F.col("nxt_cell").alias("cell"),
        F.col("r").alias("opened_at"),
        F.col("nxt").alias("closed_at"),
        F.expr(f"(nxt - r) div {rate}").alias("gap"),
    )
    at = F.col("closed_at")
    before = F.when(F.col("r") < at, F.col("n")).when(F.col("r") == at, F.lit(1)).otherwise(0)
    cells = (
        unique.withColumn("cell", F.expr(f"r div {rate}"))
        .join(closings, ["worker", "cell"], "left")
        .groupBy("worker", "cell")
        .agg(
            F.sum(F.when(at.isNull(), 0).otherwise(before)).alias("before"),
            F.sum(F.when(at.isNull(), F.col("n")).otherwise(F.col("n") - before)).alias("after"),
            F.coalesce(F.max("gap"), F.lit(0)).alias("gap"),
            F.max("opened_at").alias("opened_at"),
            F.max("closed_at").alias("closed_at"),
        )
    )
    placed = with_running_sums(cells, ["worker"], ["cell"], {"idx": "gap"})
    parts = placed.select(
        "worker",
        F.inline(
            F.array(
                F.struct(
                    (F.col("idx") - F.col("gap")).alias("idx"),
                    F.col("before").alias("jobs"),
                    F.col("gap").alias("slots"),
                    F.col("opened_at").alias("since"),
                ),
                F.struct(
                    F.col("idx"),
                    F.col("after").alias("jobs"),
                    F.lit(0).cast("long").alias("slots"),
                    F.col("closed_at").alias("since"),
                ),
            )
        ),
    )
    merged = parts.groupBy("worker", "idx").agg(
        F.sum("jobs").alias("jobs"), F.max("slots").alias("slots"), F.coalesce(F.max("since"), F.lit(0)).alias("since")
    )
    return merged.join(busy, "worker").select(
        "worker",
        "start",
        "idx",
        "jobs",
        F.greatest("slots", F.lit(1)).cast("long").alias("slots"),
        (F.col("slots") == 0).alias("open"),
        (F.col("start") + F.col("since")).alias("since"),
    )


def _contract(level: DataFrame, up: int) -> DataFrame:
    """Pointers for blocks of 2**up cells from those for half as many."""
    width = 1 << up
    inner = level.where(f"cell % {width} <> 0")
    first_inner = (
        inner.groupBy("worker", F.expr(f"shiftright(cell, {up})").alias("block"))
        .agg(F.min(F.struct("r", "cell", "nxt", "nxt_cell")).alias("first"))
        .select("worker", "first.*")
    )
    entries = level.where(f"cell % {width} = 0").unionByName(first_inner)
    follow = level.select(
        "worker", F.col("r").alias("nxt"), F.col("nxt").alias("then"), F.col("nxt_cell").alias("then_cell")
    )
    inside = F.expr(f"nxt is not null and shiftright(nxt_cell, {up}) = shiftright(cell, {up})")
    moved = (
        entries.where(inside)
        .join(follow, ["worker", "nxt"])
        .select("worker", "r", "cell", F.col("then").alias("nxt"), F.col("then_cell").alias("nxt_cell"))
    )
    return entries.where(~F.coalesce(inside, F.lit(False))).unionByName(moved)


def dense(sample_rows: DataFrame) -> DataFrame:
    """(worker, idx, jobs) with the zero samples of long gaps written out."""
    chunked = sample_rows.withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(_SLOT_CHUNK).cast("long")))
    )
    # Long gaps become many rows: spread the chunks before they are written out.
    slots = spread(chunked, "worker", "idx", "_from").withColumn(
        "_slot",
        F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + _SLOT_CHUNK, F.col("slots")) - 1)),
    )
    return slots.select(
        "worker",
        (F.col("idx") + F.col("_slot")).alias("idx"),
        F.when(F.col("_slot") == 0, F.col("jobs")).otherwise(0).alias("jobs"),
    )


def sample_start(tick_rows: DataFrame) -> DataFrame:
    """First processed time of each worker."""
    return tick_rows.groupBy("worker").agg(from_micros(F.min("t")).alias("sample_start"))


def sample_bounds(sample_rows: DataFrame, rate_seconds: float) -> DataFrame:
    """Number of samples, start and end of each worker's series (microseconds)."""
    rate = round(rate_seconds * SECOND)
    return (
        sample_rows.groupBy("worker")
        .agg(F.min("start").alias("start"), F.max(F.col("idx") + F.col("slots")).alias("n_samples"))
        .withColumn("end", F.col("start") + F.col("n_samples") * rate)
    )


def overall_bounds(bounds: DataFrame) -> DataFrame:
    """Earliest start and latest end over all workers."""
    return bounds.agg(F.min("start").alias("earliest"), F.max("end").alias("latest"))
