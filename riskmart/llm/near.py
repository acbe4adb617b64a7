"""Connected groups over links found through shared keys, without emitting all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.session import drop_staged, staged, staged_mark

#: How many others of its bucket a node meets in the first round between groups, and how many times more in each further one.
MEET, MORE = 8, 16


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Each round hangs every node below its smallest neighbour and contracts the edges to those; at least half of the nodes
    that still have edges go, so the rounds are logarithmic. Rounds are staged tables; sums are combined map-side, so a hub costs no more.
    """
    def tidy(df: DataFrame) -> DataFrame:
        low, high = F.least("a", "b"), F.greatest("a", "b")
        return staged(df.where(F.col("a") != F.col("b")).select(low.alias("a"), high.alias("b")).distinct(), "edges")

    edges = tidy(edges)
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        above = staged(both.groupBy(F.col("a").alias("_n")).agg(F.least(F.min("b"), F.min("a")).alias("_p")), "above")
        if labels is None:
            labels = above.select(F.col("_n").alias("node"), F.col("_p").alias("root"))
        else:
            moved = labels.join(above, F.col("root") == F.col("_n"), "left")
            labels = staged(moved.select("node", F.coalesce("_p", "root").alias("root")), "labels")
        up = above.select(F.col("_n").alias("_m"), F.col("_p").alias("_q"))
        edges = tidy(edges.join(above, F.col("a") == F.col("_n")).join(up, F.col("b") == F.col("_m"))
                     .select(F.col("_p").alias("a"), F.col("_q").alias("b")))
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def bits_apart(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


def linked(keys: DataFrame, nodes: DataFrame, most_bits: int, ratio: float = 0.0, verify: Callable[[DataFrame], DataFrame] = lambda pairs: pairs) -> DataFrame:
    """(node, root) of the groups over all links: a key shared, fingerprints ``most_bits`` apart at most, sizes within ``ratio``, verified.

    ``keys`` is (key, node), ``nodes`` (node, fp, size). Keys of one node go at once (one window over keys and nodes alone). What is left
    of a bucket first links to its smallest node: a star, as many rows as members; a node in several buckets meets one of their smallest
    nodes before the others, which it then skips if they are in its group. Only buckets whose members are then still in different groups are
    joined with themselves, without the smallest node, and of their pairs only those between groups survive the join condition. They meet in
    rounds: a node meets some ``MEET`` others of a bucket, by a hash of the pair, then ``MORE`` times as many, up to all; pairs that an earlier round
    has brought into one group are not verified any more. So a bucket of many like nodes costs its size, and no link that joins two groups is
    lost. ``verify`` keeps those rows of (a, b), a staged table, that are true links.
    """
    bucket = Window.partitionBy("key")
    shared = staged(keys.select("key", "node", F.count("*").over(bucket).alias("_n")).where("_n > 1").select("key", "node"), "shared")
    facts = staged(nodes.join(shared.select("node").distinct(), "node").select("node", "fp", "size"), "facts")
    shared = shared.join(facts, "node").select("key", "node", "fp", "size", F.min(F.struct("node", "fp", "size")).over(bucket).alias("hub"))
    return link_buckets(staged(shared, "buckets"), most_bits, ratio, verify)


def link_buckets(shared: DataFrame, most_bits: int, ratio: float = 0.0, verify: Callable[[DataFrame], DataFrame] = lambda pairs: pairs,
                 carried: Sequence[str] = (), may: Callable[[str, str], Column] = lambda a, b: F.lit(True),
                 likely: Callable[[str, str], Column] = lambda a, b: F.lit(True)) -> DataFrame:
    """The second part of :func:`linked`, from a staged table (key, node, fp, size, hub): the nodes that share a key, and the smallest of them.

    ``shared`` and its hub may have further columns ``carried``; ``may`` tells from them, by the prefixes of two nodes' columns, whether a pair can be a link.
    ``likely`` tells which of its smallest nodes a node meets before the others; it excludes none.
    """
    bucket, mark = Window.partitionBy("key"), staged_mark()

    def near(a: str, b: str) -> Column:
        low, high = F.least(F.col(f"{a}size"), F.col(f"{b}size")), F.greatest(F.col(f"{a}size"), F.col(f"{b}size"))
        return (bits_apart(f"{a}fp", f"{b}fp") <= most_bits) & (low >= F.lit(ratio) * high) & may(a, b)

    def groups(pairs: DataFrame) -> DataFrame:
        """(node, root) over the true links among (a, b), or among the groups (g, h) that they are in; what was staged to find them goes."""
        mark = staged_mark()
        ends = ("g", "h") if "g" in pairs.columns else ("a", "b")
        out = staged(components(verify(pairs).select(*[F.col(c).alias(x) for c, x in zip(ends, "ab")])), "groups")
        drop_staged(out.sparkSession, mark, keep=[out])
        return out

    def mixed(rows: DataFrame) -> DataFrame:
        """``rows`` of buckets with several groups."""
        several = F.min("group").over(bucket) != F.max("group").over(bucket)
        return staged(rows.withColumn("_mixed", several).where("_mixed").drop("_mixed"), "mixed")

    star = shared.where((F.col("node") != F.col("hub.node")) & near("", "hub."))
    # A node in many buckets meets one of their hubs first; most like nodes are then in one group, and their other hubs need no check.
    nearest = staged(star.groupBy(F.col("node").alias("b")).agg(F.min(F.struct(~likely("", "hub."), "hub.node")).getField("node").alias("a")).select("a", "b"), "nearest")
    first = groups(nearest)
    grouped = mixed(shared.join(first, "node", "left").withColumn("group", F.coalesce("root", "node")).drop("root"))
    hub_group = F.max(F.when(F.col("node") == F.col("hub.node"), F.col("group"))).over(bucket)
    others = grouped.withColumn("_of_hub", hub_group).where((F.col("group") != F.col("_of_hub")) & near("", "hub."))
    others = others.select(F.col("hub.node").alias("a"), F.col("node").alias("b"), F.least("group", "_of_hub").alias("g"), F.greatest("group", "_of_hub").alias("h"))
    second = groups(staged(others.distinct().join(nearest, ["a", "b"], "left_anti"), "others"))
    regrouped = grouped.where(F.col("node") != F.col("hub.node")).drop("hub").join(  # a hub has met its whole bucket
        second.select(F.col("node").alias("group"), "root"), "group", "left").withColumn("group", F.coalesce("root", "group"))
    rest = mixed(regrouped.select("key", "node", "fp", "size", *carried, "group", F.count("*").over(bucket).alias("_n")))
    labels, met, reach = merged(first, second), nearest.select("a", "b"), 0
    drop_staged(rest.sparkSession, mark, keep=[labels, rest, nearest])
    while (largest := rest.agg(F.max("_n").alias("n")).first()["n"] or 0) > reach:  # None: no bucket is left
        before, reach = reach, reach * MORE or MEET
        left, right = (rest.select([F.col(c).alias(f"{side}_{c}") for c in rest.columns]) for side in "lr")
        low, high = F.least("l_node", "r_node"), F.greatest("l_node", "r_node")
        turn = F.pmod(F.xxhash64(low, high), F.col("l__n"))
        pairs = left.join(right, (F.col("l_key") == F.col("r_key")) & (F.col("l_group") < F.col("r_group")) & (turn >= before) & (turn < reach) & near("l_", "r_"))
        pairs = pairs.select(low.alias("a"), high.alias("b"), F.col("l_group").alias("g"), F.col("r_group").alias("h")).distinct()
        pairs = staged(pairs.join(met, ["a", "b"], "left_anti"), "pairs")
        more = groups(pairs)
        labels, met = merged(labels, more), met.unionByName(pairs.select("a", "b"))
        if reach < largest:
            rest = mixed(rest.join(more.select(F.col("node").alias("group"), "root"), "group", "left").withColumn("group", F.coalesce("root", "group")).drop("root"))
            drop_staged(rest.sparkSession, mark, keep=[labels, rest, met])
    return labels


def merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """``labels`` (node, root) after the links among their groups, (node, root) of ``more``; a group of one node has no label before."""
    more = more.select(F.col("node").alias("_group"), F.col("root").alias("_root"))
    every = labels.select("node", "root").unionByName(
        more.select(F.col("_group").alias("node"), F.col("_group").alias("root")).join(labels.select("node"), "node", "left_anti"))
    return staged(every.join(more, F.col("root") == F.col("_group"), "left").select("node", F.coalesce("_root", "root").alias("root")), "linked")
