"""Hierarchies, identity groups and neighbours."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import cut

MAX_DEPTH = 30


def closure(nodes: DataFrame, edges: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """ancestor, descendant, depth (the least) of every pair, each node of ``nodes`` with itself at 0.

    Breadth first: each round extends only the pairs found last, so a diamond or
    a cycle costs no more than its pairs. ``edges`` has parent and child.
    """
    steps = edges.where(F.col("parent").isNotNull() & F.col("child").isNotNull()).select("parent", "child").distinct()
    found = cut(nodes.select(F.col("node").alias("ancestor"), F.col("node").alias("descendant")).distinct().withColumn("depth", F.lit(0)))
    frontier = found
    for depth in range(1, max_depth + 1):
        reached = (
            frontier.join(steps, frontier["descendant"] == steps["parent"])
            .select("ancestor", F.col("child").alias("descendant")).distinct()
            .join(found.select("ancestor", "descendant"), ["ancestor", "descendant"], "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        frontier = cut(reached)
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return found


def adjacent(closed: DataFrame, node: str, max_hops: int = 2) -> DataFrame:
    """node, relation (exact, descendant, ancestor), distance: all descendants and the ancestors within ``max_hops``."""
    down = closed.where(F.col("ancestor") == node).select(F.col("descendant").alias("node"), F.when(F.col("depth") == 0, "exact").otherwise("descendant").alias("relation"), F.col("depth").alias("distance"))
    up = closed.where((F.col("descendant") == node) & F.col("depth").between(1, max_hops)).select(F.col("ancestor").alias("node"), F.lit("ancestor").alias("relation"), F.col("depth").alias("distance"))
    best = Window.partitionBy("node").orderBy(relation_rank(F.col("relation")), "distance")
    return down.unionByName(up).withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def relation_rank(relation: Column) -> Column:
    return F.when(relation == "exact", 0).when(relation == "descendant", 1).otherwise(2)


def anchored_area(closed: DataFrame, anchors: DataFrame, default: str) -> DataFrame:
    """node, area of the anchor of least priority among a node and its ancestors; ``anchors`` has node, area, priority."""
    hits = closed.join(anchors.withColumnRenamed("node", "ancestor"), "ancestor").groupBy("descendant").agg(F.min(F.struct("priority", "area")).alias("m"))
    nodes = closed.select("descendant").distinct()
    return nodes.join(hits, "descendant", "left").select(F.col("descendant").alias("node"), F.coalesce("m.area", F.lit(default)).alias("area"))


def identity_groups(names: DataFrame) -> DataFrame:
    """name, group: names that share a key, directly or through others; ``names`` has name and key.

    The group is its smallest name. Labels travel over the keys and jump to the
    label of their label, so rounds grow with the logarithm of a chain.
    """
    pairs = cut(names.where(F.col("name").isNotNull() & F.col("key").isNotNull() & (F.col("key") != "")).select("name", "key").distinct())
    labels = cut(names.where(F.col("name").isNotNull()).select("name").distinct().withColumn("label", F.col("name")))
    while True:
        by_key = pairs.join(labels, "name").groupBy("key").agg(F.min("label").alias("label"))
        seen = pairs.join(by_key, "key").groupBy("name").agg(F.min("label").alias("near"))
        nearer = labels.join(seen, "name", "left").select("name", F.col("label").alias("was"), F.least("label", F.coalesce("near", "label")).alias("label"))
        jump = nearer.select(F.col("name").alias("label"), F.col("label").alias("far"))
        moved = cut(nearer.join(jump, "label", "left").select("name", "was", F.least("label", F.coalesce("far", "label")).alias("label")))
        labels = moved.select("name", "label")
        if moved.where(F.col("was") != F.col("label")).isEmpty():
            return labels.withColumnRenamed("label", "group")


def shared_groups(links: DataFrame, kind: str, weight: float) -> DataFrame:
    """key, member, hub, kind, weight: the edges between all members of a key as edges to the key's smallest member.

    All pairs within a key would grow with its square; the hub carries the same
    connections. ``links`` has member and key.
    """
    clean = links.where(F.col("member").isNotNull() & F.col("key").isNotNull()).select("member", "key").distinct()
    hubs = clean.groupBy("key").agg(F.min("member").alias("hub"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return clean.join(hubs, "key").select("key", "member", "hub", F.lit(kind).alias("kind"), F.lit(weight).alias("weight"))


def neighbours(node: Column, mechanism: DataFrame, indication: DataFrame, born: DataFrame) -> DataFrame:
    """member, kind, weight, born_on of the assets related to one asset.

    Sharing a target is 'mechanism' (1.0); sharing an indication without a
    target is 'competitive' (0.7). An edge exists from the later of its ends'
    birth on; an undated end doesn't delay it. The links have member and key.
    """
    def sharing(links: DataFrame) -> DataFrame:
        keys = links.where(F.col("member") == node).select("key").distinct()
        return links.join(keys, "key", "left_semi").where(F.col("member") != node).select("member").distinct()

    same_target = sharing(mechanism)
    rivals = sharing(indication).join(same_target, "member", "left_anti")
    edges = same_target.withColumn("kind", F.lit("mechanism")).withColumn("weight", F.lit(1.0)).unionByName(
        rivals.withColumn("kind", F.lit("competitive")).withColumn("weight", F.lit(0.7))
    )
    own = born.where(F.col("member") == node).select("born_on").first()
    since = F.lit(own[0] if own else None).cast(born.schema["born_on"].dataType)
    return edges.join(born, "member", "left").select("member", "kind", "weight", F.greatest(F.col("born_on"), since).alias("born_on"))


def walk_up(seeds: DataFrame, edges: DataFrame, max_depth: int, max_nodes: int, stop: Sequence[str] = (), keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """node, depth (the least) of all nodes reached upwards from ``seeds``, which stand at 0.

    Breadth first: a node in ``stop`` is reached and not passed, one that
    ``keep`` rejects isn't reached. No new level begins once ``max_nodes`` are
    found. ``edges`` has parent and child; cycles and diamonds cost nothing.
    """
    steps = edges.where(F.col("parent").isNotNull() & F.col("child").isNotNull()).select("parent", "child").distinct()
    if keep:
        steps = steps.where(keep(F.col("parent")))
    found = cut(seeds.where(F.col("node").isNotNull()).select("node").distinct().withColumn("depth", F.lit(0)))
    frontier = found
    for depth in range(1, max_depth + 1):
        onward = frontier.where(~F.col("node").isin(*stop)) if stop else frontier
        reached = onward.join(steps, onward["node"] == steps["child"]).select(F.col("parent").alias("node")).distinct().join(found.select("node"), "node", "left_anti")
        frontier = cut(reached.withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
        if found.count() >= max_nodes:
            break
    return found


def edge_groups(members: DataFrame, targets: str, indications: str) -> DataFrame:
    """kind, weight, key, member, apart: the edges between all members as memberships of groups.

    Two members of one 'mechanism' group (a shared target, 1.0) are linked, and
    so are two of one 'competitive' group (a shared indication, 0.7) unless
    their ``apart``, the targets, overlap. Groups of one member are left out.
    The rows grow with the members; pairs, which grow with the square of a
    group, are expanded for one member at a time by :func:`neighbours`.
    ``members`` has member and two arrays, which may be null; other columns stay.
    """
    none = F.array().cast(members.schema[targets].dataType)
    own = F.array_sort(F.array_distinct(F.array_compact(F.coalesce(targets, none))))
    rest = [c for c in members.columns if c not in ("member", targets, indications)]
    of = lambda kind, weight, c, apart: members.select(F.lit(kind).alias("kind"), F.lit(weight).alias("weight"), F.explode(F.array_distinct(F.array_compact(F.coalesce(c, none)))).alias("key"), "member", apart.alias("apart"), *rest)
    rows = of("mechanism", 1.0, targets, none).unionByName(of("competitive", 0.7, indications, own))
    shared = rows.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    return rows.join(shared, ["kind", "key"], "left_semi").select("kind", "weight", "key", "member", "apart", *rest)
