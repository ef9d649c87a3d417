"""Depth-limited frontier expansion over (src, pos, dst) link edges.

Beyond one level the edges are stored, bucketed by source (see ``edges``). Each
level is one equi-join of the frontier with them, aggregated by target before the
shuffle and written to the shared folder, so the plan of a level never contains
the levels before it. Popular targets are reduced map-side; sources with very many
links are sliced over several buckets. The frontier is broadcast only when the
planner finds its files small enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.edges import StoredEdges, for_joins, store
from linkloom.operators.ordering import smallest, with_position, with_running_sums
from linkloom.operators.visited import Visited
from linkloom.operators.visited import create as visited_set
from linkloom.session import materialize


# A url queued more often than this is joined apart from the others.
REPEAT_LIMIT = 1_000_000
# More jobs than any queue holds.
UNLIMITED = 1 << 62


def _union(levels: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, levels)


def _at_depth(df: DataFrame, depth: int) -> DataFrame:
    return df.select(F.lit(depth).cast("int").alias("link_depth"), "*")


def expand_all(seeds: DataFrame, edges: DataFrame, max_depth: int) -> DataFrame:
    """Every job of a crawl that never drops repeats: (link_depth, url, n_jobs).

    A url reached along several paths is several jobs; ``n_jobs`` carries that
    number instead of repeated rows.
    """
    one = F.lit(1).cast("long")
    links = for_joins(edges, ["dst"], max_depth)
    level = materialize(seeds.groupBy("url").agg(F.sum(one).alias("n_jobs")), "frontier")
    levels = [_at_depth(level, 0)]
    for depth in range(1, max_depth + 1):
        reached = links.reached_from(level).groupBy(F.col("dst").alias("url"))
        level = materialize(reached.agg(F.sum("n_jobs").alias("n_jobs")), "frontier")
        if level.isEmpty():
            break
        levels.append(_at_depth(level, depth))
    links.forget()
    return _union(levels)


def expand_distinct(seeds: DataFrame, edges: DataFrame, max_depth: int) -> DataFrame:
    """Every url once, at its smallest depth: (link_depth, url).

    Levels are added to a set bucketed by url, from which the next one is read: a level is
    written once, and no earlier one is shuffled again.
    """
    links = for_joins(edges, ["dst"], max_depth)
    seen = visited_set(seeds.sparkSession)
    seen.add(_at_depth(seeds.select("url").where("url is not null").distinct(), 0), 0)
    for depth in range(1, max_depth + 1):
        level = seen.table.where(F.col("step") == depth - 1).select("url")
        if level.isEmpty():
            break
        new = links.reached_from(level).select(F.col("dst").alias("url")).where("url is not null").distinct()
        seen.add(_at_depth(seen.unseen(new), depth), depth)
    links.forget()
    return seen.table.select("link_depth", "url")


def expand_fifo(
    seeds: DataFrame,
    edges: DataFrame,
    max_depth: int,
    max_jobs: int,
    dedupe: bool = False,
    repeat_limit: int = REPEAT_LIMIT,
) -> DataFrame:
    """The first ``max_jobs`` jobs in queue order, below 1 all of them: (position, link_depth, url).

    Queue order is (depth, position of the parent, position of the link). Seeds
    need ``position`` and edges a dense ``pos`` per source, both from 0. The rank
    of a child is arithmetic: the links of all earlier parents plus ``pos``.
    Without ``dedupe`` that is its position, so parents beyond the budget are cut
    before the join; with it, the first rank of each new url is numbered again.
    """
    if max_jobs < 1:
        max_jobs = UNLIMITED
    seeds = seeds.select("url", "position")
    seen = visited_set(seeds.sparkSession) if dedupe else None
    if seen:
        seeds = _first_of_each(seeds, seen, max_jobs, 0)
    stored = store(edges, ["pos", "dst"])
    degrees = materialize(stored.table.groupBy(F.col("src").alias("url")).agg(F.count("*").alias("_links")), "degrees")
    level = materialize(seeds.where(F.col("position") < max_jobs), "queue")
    levels, done = [_at_depth(level, 0)], 0
    for depth in range(1, max_depth + 1):
        n = level.count()
        done += n
        left = max_jobs - done
        if n == 0 or left <= 0:
            break
        parents = with_running_sums(
            level.join(degrees, "url").withColumn("_all", F.lit(0)), ["_all"], ["position"], {"_upto": "_links"}
        ).select("url", (F.col("_upto") - F.col("_links")).alias("_before"))
        if not dedupe:
            parents = parents.where(F.col("_before") < left)
        if dedupe or n <= repeat_limit:
            reached = stored.reached_from(parents)
        else:
            reached = _reached_with_repeats(stored, parents, repeat_limit)
        children = reached.select(F.col("dst").alias("url"), (F.col("_before") + F.col("pos")).alias("position"))
        if seen:
            children = _first_of_each(children, seen, left, depth)
        level = materialize(children.where(F.col("position") < left), "queue")
        levels.append(_at_depth(level.withColumn("position", F.col("position") + done), depth))
    stored.forget()
    return _union(levels).select("position", "link_depth", "url")


def _reached_with_repeats(stored: StoredEdges, parents: DataFrame, repeat_limit: int) -> DataFrame:
    """Links of parents that may hold the same url many times.

    The links of urls above the limit are stored, so the planner knows their size: few
    are broadcast, and the parents stay where they are; many are joined by shuffles, where
    the adaptive planner splits the parents of one url. With a budget all parents but the last together have no more links than
    it allows, so there are at most budget / limit; without one nothing bounds them, so nothing is hinted.
    """
    parents = materialize(parents, "parents")
    repeats = parents.groupBy("url").agg(F.count("*").alias("_n")).where(F.col("_n") > repeat_limit).select("url")
    repeats = materialize(repeats, "repeats")
    if repeats.isEmpty():
        return stored.reached_from(parents)
    links = materialize(stored.reached_from(repeats), "repeated-links")
    often = parents.join(links, "url")
    once = stored.reached_from(parents.join(repeats, "url", "left_anti"))
    return often.select("_before", "pos", "dst").unionByName(once.select("_before", "pos", "dst"))


def _first_of_each(queued: DataFrame, seen: Visited, wanted: int, depth: int) -> DataFrame:
    """Each url that was not seen, once, in the order of its first position: the first ``wanted``, numbered anew.

    Only those are put in order; the others are told apart from them by counts alone. All new urls are added to the set.
    """
    first = queued.where("url is not null").groupBy("url").agg(F.min("position").alias("_first"))
    new = materialize(seen.unseen(first), "new-urls")
    seen.add(_at_depth(new.select("url"), depth), depth, placed=False)
    return with_position(smallest(new, "_first", wanted), ["_first"]).drop("_first")


def visited(seeds: DataFrame, edges: DataFrame, max_depth: int) -> DataFrame:
    """Set of (link_depth, url) a depth-first crawl visits; order aside, the same
    set as that of a breadth-first crawl."""
    return expand_all(seeds, edges, max_depth).select("link_depth", "url")


def depth_totals(frontier: DataFrame) -> DataFrame:
    """Urls and jobs per depth and the running total of jobs discovered."""
    per_depth = frontier.groupBy("link_depth").agg(
        F.count("*").alias("n_urls"), F.sum("n_jobs").alias("n_jobs")
    )
    # One row per depth level.
    upto = Window.orderBy("link_depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_depth.withColumn("n_discovered", F.sum("n_jobs").over(upto))


def depth_first(seeds: DataFrame, edges: DataFrame, max_depth: int, max_jobs: int = 0) -> DataFrame:
    """Jobs in the order of a crawl that pops the last url pushed: (position, link_depth, url).

    Nothing is ever dropped as a repeat, so a job is a path; the last seed and the last link come first. Seeds need
    ``position`` and edges ``pos``, unique per source. From one on, ``max_jobs`` keeps that many first jobs.

    Positions are pre-order numbers. How many jobs a url stands for depends on the url and the levels left only, so these
    sizes are summed once per url from the deepest level up, as are the sizes of the siblings that
    come before a link. On the way down a child's position is its parent's plus what comes before it: one join per level, and no
    job is ever sorted among the others.
    """
    links = edges.select("src", "pos", "dst").where("src is not null")
    one = F.lit(1).cast("long")
    sizes: DataFrame | None = None  # (url, size) of urls with links, for the levels left below
    before: list[DataFrame] = []  # (src, dst, ahead): jobs of the parent's later links, by levels left
    for _ in range(max_depth):
        sized = links.withColumn("size", one) if sizes is None else links.join(sizes.withColumnRenamed("url", "dst"), "dst", "left")
        sized = sized.select("src", "pos", "dst", F.coalesce("size", one).alias("size"))
        summed = with_running_sums(sized.withColumn("_back", -F.col("pos")), ["src"], ["_back"], {"_upto": "size"})
        before.append(materialize(summed.select("src", "dst", "size", (F.col("_upto") - F.col("size")).alias("ahead")), "siblings"))
        sizes = materialize(before[-1].groupBy(F.col("src").alias("url")).agg((F.sum("size") + 1).alias("size")), "subtree-sizes")
    limit = max_jobs if max_jobs > 0 else UNLIMITED
    roots = seeds.select("url", "position")
    if sizes is not None:
        roots = roots.join(sizes, "url", "left")
    else:
        roots = roots.withColumn("size", one)
    roots = roots.select("url", (-F.col("position")).alias("_back"), F.coalesce("size", one).alias("size"), F.lit(0).alias("_all"))
    placed = with_running_sums(roots, ["_all"], ["_back"], {"_upto": "size"})
    level = materialize(placed.select("url", (F.col("_upto") - F.col("size")).alias("position")).where(F.col("position") < limit), "stack")
    levels = [_at_depth(level, 0)]
    for depth in range(1, max_depth + 1):
        below = level.join(before[max_depth - depth].withColumnRenamed("src", "url"), "url")
        level = below.select(F.col("dst").alias("url"), (F.col("position") + 1 + F.col("ahead")).alias("position"))
        level = materialize(level.where(F.col("position") < limit), "stack")
        if level.isEmpty():
            break
        levels.append(_at_depth(level, depth))
    return _union(levels).select("position", "link_depth", "url")
