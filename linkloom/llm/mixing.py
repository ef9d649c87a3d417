"""Mix sources to target weights by apportioned blocks of words.

Targets: sources share a part of all words by weight, none above a multiple of its own
size; what a full source cannot take is shared again. Large sources are cut into shards
by a seeded hash of their documents. Every (source, shard) cell is a row of equal-word
blocks in a seeded order of its documents. Sainte-Laguë (highest quotients target / (2 seats + 1))
gives each cell a whole number of blocks. A quota above the cell's number of
blocks takes every block, and a seeded run of blocks once more.

Only one row per cell is looked at by the apportionment, through sums; no source, however large,
passes through one task. The window orders one shard, about ``SHARD_WORDS`` words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm import common
from linkloom.operators.ordering import with_position
from linkloom.session import materialize

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2, 20
SHARD_WORDS = 1 << 18
#: Words of a block at most, and blocks in the smallest positive target at least.
BLOCK_WORDS, LEAST_BLOCKS = 1024, 1024
#: Divisors tried in one pass.
_SECTIONS = 32
WORD = r"[^\x20\x09-\x0D]+"


def words() -> F.Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, place, source_size, target for rows (source, size); NULL source is last."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_position(totals.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "place")
    weighed = placed.select(
        "source", "place", "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).alias("weight"),
    )
    weighed = materialize(weighed, "mix-sources")
    wanted = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    limit, rate, full = F.col("source_size") * most, 0.0, -1
    while True:  # the rate only grows, so a full source stays full
        over = F.lit(rate) * F.col("weight") > limit
        now = weighed.agg(
            F.count(F.when(over, 1)).alias("full"),
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if now["full"] == full or not now["open"]:
            break
        full, rate = now["full"], max(rate, (wanted - now["held"]) / now["open"])
    share_of = F.least(F.lit(rate) * F.col("weight"), limit.cast("double"))
    return weighed.select("source", "place", "source_size", share_of.alias("target"))


def apportion(cells: DataFrame, seats: int, keys: list[str]) -> DataFrame:
    """Add ``quota``: ``seats`` given to rows by highest quotients of ``weight``.

    The divisor is bracketed with sums over all rows; rows that tie in the last bracket
    get the rest by quotient, then by ``keys``.
    """
    n, total, largest = cells.agg(F.count("*"), F.sum("weight"), F.max("weight")).first()
    if not n or not total or seats <= 0:
        return cells.withColumn("quota", F.lit(0).cast("long"))

    def given(divisor: float) -> F.Column:
        return F.floor(F.col("weight") / F.lit(divisor) + 0.5)

    low = total / (seats + n)
    high = min(2.01 * largest, total / (seats - n / 2)) * 1.001 if seats > n / 2 else 2.01 * largest
    while high / low - 1 > 1e-13:
        tried = [low * (high / low) ** (k / (_SECTIONS + 1)) for k in range(1, _SECTIONS + 1)]
        sums = cells.agg(*[F.sum(given(d)).alias(f"s{k}") for k, d in enumerate(tried)]).first()
        enough = [d for d, s in zip(tried, sums, strict=True) if s >= seats]
        short = [d for d, s in zip(tried, sums, strict=True) if s <= seats]
        before = low, high
        low, high = max(enough, default=low), min(short, default=high)
        if low >= high or (low, high) == before:
            break
    high = max(low, high)
    base = materialize(cells.withColumn("quota", given(high)), "mix-quotas")
    rest = seats - base.agg(F.sum("quota")).first()[0]
    quotient = F.col("weight") / (2 * F.col("quota") + 1)
    tied = base.where(given(low) > F.col("quota")).orderBy(quotient.desc(), *keys).limit(max(rest, 0))
    more = tied.select(*keys, F.lit(1).alias("_more"))
    return base.join(more, keys, "left").withColumn("quota", F.col("quota") + F.coalesce("_more", F.lit(0))).drop("_more")


def _between(start: F.Column, end: F.Column) -> F.Column:
    """Words of the document that lie between two offsets of its shard."""
    return F.greatest(F.least("_end", end) - F.greatest(F.col("_end") - F.col("size"), start), F.lit(0))


def mix_rows(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, _row_id, size, source_size, target, taken, copies for stored rows with ``_row_id``.

    ``copies`` are whole copies that come to ``taken`` by systematic rounding: along a shard the parts of documents that are
    taken add up, and where the sum passes a whole number (from a seeded offset on) a document is taken once. So a
    document is taken as often as its part says, however long it is.
    """
    sized = rows.select(
        "doc_id", "_row_id", "source", words().alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_key")
    )
    sized = materialize(sized, "mix-sizes")
    targets = materialize(source_targets(sized, weights, share, most), "mix-targets")
    wanted, least = targets.agg(F.sum("target"), F.min(F.when(F.col("target") > 0, F.col("target")))).first()
    block = int(max(1, min(BLOCK_WORDS, (least or 0) // LEAST_BLOCKS)))
    shards = F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1))
    placed = (
        sized.join(targets.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")))
        .withColumn("shard", F.pmod(F.xxhash64("_key", F.lit(seed)), shards))
        .drop("_of", "source")
    )
    # Documents without words take none; they need no place in a shard, which a source may have any number of.
    empty = placed.where("size = 0").select("doc_id", "_row_id", "size", "source_size", "target", *[F.lit(0).cast("long").alias(c) for c in ("taken", "copies")])
    placed = placed.where("size > 0")
    cells = placed.groupBy("place", "shard").agg(
        F.sum("size").alias("cell_size"), (F.first("target") * F.sum("size") / F.greatest(F.first("source_size"), F.lit(1))).alias("weight")
    )
    cells = materialize(cells, "mix-cells")
    quotas = apportion(cells, round((wanted or 0) / block), ["place", "shard"])
    blocks = F.greatest(F.ceil(F.col("cell_size") / block), F.lit(1))
    quota = F.least("quota", most * blocks)
    quotas = quotas.select(
        "place", "shard", "cell_size", blocks.alias("_blocks"),
        F.floor(quota / blocks).alias("_whole"), (quota % blocks).alias("_extra"),
        F.pmod(F.xxhash64(F.lit(seed), "place", "shard"), blocks).alias("_from"),
    )
    order = Window.partitionBy("place", "shard").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    laid = placed.withColumn("_end", F.sum("size").over(order)).join(quotas, ["place", "shard"])
    until = F.col("_from") + F.col("_extra")
    run = _between(F.col("_from") * block, F.least(until * block, F.col("cell_size")))
    wrapped = _between(F.lit(0), F.greatest(until - F.col("_blocks"), F.lit(0)) * block)
    taken = (F.col("_whole") * F.col("size") + run + wrapped).cast("long")
    laid = laid.withColumn("taken", taken).withColumn("_part", F.col("taken") / F.col("size"))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.lit("offset"), "place", "shard"), F.lit(1 << 20)) / float(1 << 20)
    upto = F.floor(F.sum("_part").over(order) + offset)
    earlier = F.floor(F.coalesce(F.sum("_part").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) + offset)
    counted = laid.withColumn("copies", (upto - earlier).cast("long"))
    return counted.select("doc_id", "_row_id", "size", "source_size", "target", "taken", "copies").unionByName(empty)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``.

    NULL texts have size 0; a NULL source is a source of its own, the last one. Repeated rows
    are mixed like any others; which of two identical rows is taken is not defined,
    how many of them is. Documents without words take 0. Reruns with a seed agree.
    An empty table gives no rows; other columns are not read.
    """
    common.prepare(docs.sparkSession)
    rows = docs.select("doc_id", "source", "text").withColumn("_row_id", F.monotonically_increasing_id())
    return mix_rows(rows, weights, share, most, seed).drop("_row_id", "copies")


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, all columns unchanged, whatever they are called.

    A run of blocks begins and ends inside a document; such a document is taken whole as often as its part in the
    run says, see ``mix_rows``. Documents without words are not taken. An empty table stays empty.
    """
    common.prepare(docs.sparkSession)
    row_id, copy = (common.unused(c, docs.columns) for c in ("_row_id", "_copy"))
    rows = common.with_row_id(docs, "mix-rows", row_id)
    taken = mix_rows(rows.select("doc_id", "source", "text", F.col(row_id).alias("_row_id")), weights, share, most, seed)
    often = taken.where("copies > 0").select(F.col("_row_id").alias(row_id), F.sequence(F.lit(1).cast("long"), "copies").alias(copy))
    return rows.join(often, row_id).withColumn(copy, F.explode(copy)).select(*docs.columns)
