"""Connected components by deterministic Boruvka hooking.

In each round every component selects its smallest outgoing edge (edges are
ordered by their two labels, so all choices agree and the only cycles are pairs
that chose the same edge); the smaller of such a pair becomes the root, trees
collapse by pointer doubling, edges are relabelled and deduplicated. At least
half of the components disappear in a round. Only the round's own map is kept,
and the maps, each at most half of the one before, are composed at the end, so
the nodes are touched once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import cut

#: A value with more rows than this is joined by broadcast, apart from the rest.
HOT_ROWS = 100_000
#: The most values treated so: the bound of the broadcast table.
MAX_HOT = 4_000


def mapped(df: DataFrame, column: str, mapping: DataFrame, value: str, rows: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` joined with ``mapping`` (unique ``column`` -> ``value``), safe where one value holds most rows.

    Values with more than ``hot_rows`` rows (at most MAX_HOT, the largest) meet
    their mapping in a broadcast join and never share a task; a value that is
    left out holds less than 1/MAX_HOT of the rows. ``rows``, the number of rows
    of ``df`` if the caller knows it, saves the search where no value can be hot.
    """
    # The hint keeps small rounds from collecting every map on the driver for a broadcast.
    pairs = mapping.select(column, value).hint("merge")
    if rows is not None and rows <= hot_rows:
        return df.join(pairs, column)
    hot = (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
        .orderBy(F.desc("_n"), column).limit(MAX_HOT).select(column)
    )
    few = pairs.join(F.broadcast(hot), column, "left_semi")
    apart = df.join(F.broadcast(few), column)
    rest = df.join(F.broadcast(hot), column, "left_anti").join(pairs, column)
    return apart.unionByName(rest)


def _roots(edges: DataFrame, rows: int) -> DataFrame:
    """node, root of every component label that has an edge in ``edges`` (a < b)."""
    ends = edges.select(F.col("a").alias("node"), "a", "b").unionByName(edges.select(F.col("b").alias("node"), "a", "b"))
    chosen = ends.groupBy("node").agg(F.min(F.struct("a", "b")).alias("e"))
    parent = chosen.select("node", F.when(F.col("e.a") == F.col("node"), F.col("e.b")).otherwise(F.col("e.a")).alias("parent"), "e")
    other = parent.select(F.col("node").alias("parent"), F.col("e").alias("e2"))
    # A pair that chose the same edge points at each other: its smaller end becomes the root.
    parent = cut(
        mapped(parent, "parent", other, "e2", 2 * rows).select(
            "node", F.when((F.col("e") == F.col("e2")) & (F.col("node") < F.col("parent")), F.col("node")).otherwise(F.col("parent")).alias("parent")
        )
    )
    while True:
        doubled = cut(_doubled(_doubled(parent, rows), rows))
        parent = doubled.select("node", "parent")
        if doubled.where("moved").isEmpty():
            return parent.withColumnRenamed("parent", "root")


def _doubled(parent: DataFrame, rows: int) -> DataFrame:
    up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
    return mapped(parent.select("node", "parent"), "parent", up, "grand", 2 * rows).select(
        "node", F.col("grand").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")
    )


def components(edges: DataFrame) -> DataFrame:
    """node, label of every node in ``edges`` (columns a and b of one orderable type).

    Nodes get the same label exactly if they are linked directly or through
    others; the label is one of the component's nodes, not always the smallest.
    Self-loops, repeated edges and either direction are fine; edges with a null
    end are left out. No edges give no rows.
    """
    ordered = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    current = cut(ordered.distinct())
    loops = current.where(F.col("a") == F.col("b")).select(F.col("a").alias("node"))
    current = current.where(F.col("a") != F.col("b"))
    maps: list[tuple[DataFrame, int]] = []
    while (rows := current.count()) > 0:
        roots = _roots(current, rows)
        maps.append((roots, 2 * rows))
        ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = mapped(mapped(current, "a", ra, "ra", rows), "b", rb, "rb", rows)
        current = cut(
            moved.where(F.col("ra") != F.col("rb"))
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
    if not maps:
        return loops.select("node", F.col("node").alias("label"))
    total = maps[-1][0]
    for earlier, rows in reversed(maps[:-1]):
        # A root of an earlier round that has no edge later keeps its label.
        later = total.select(F.col("node").alias("root"), F.col("root").alias("_final"))
        roots = earlier.select("root").distinct().join(later, "root", "left").withColumn("_final", F.coalesce("_final", "root"))
        total = mapped(earlier, "root", roots, "_final", rows).select("node", F.col("_final").alias("root"))
    linked = total.select("node", F.col("root").alias("label"))
    alone = loops.join(linked.select("node"), "node", "left_anti")
    return linked.unionByName(alone.select("node", F.col("node").alias("label")))


def smallest_labels(labels: DataFrame) -> DataFrame:
    """node, group: ``labels`` with each component named by its smallest node."""
    labels = cut(labels)
    least = labels.groupBy("label").agg(F.min("node").alias("group"))
    return mapped(labels, "label", least, "group", labels.count()).select("node", "group")


def alias_groups(aliases: DataFrame, pairs: DataFrame) -> DataFrame:
    """Problem 7: alias_row_id, group_id for every alias_row_id of ``aliases``.

    Rows are linked by an accepted pair that names both, or by an equal string
    among canonical and members. Several rows of one alias_row_id are one node.
    Null ids, null strings and pairs with an end that isn't in ``aliases`` link
    nothing; strings compare exactly (case, blanks and the empty string
    included); a row without links is its own group. Pairs that were accepted
    and also rejected count as accepted. Empty tables give no rows.
    """
    rows = aliases.where(F.col("alias_row_id").isNotNull())
    ids = rows.select(F.col("alias_row_id").cast("long").alias("node")).distinct()
    strings = rows.select(
        F.col("alias_row_id").cast("long").alias("row"),
        F.explode(F.array_distinct(F.concat(F.array("canonical"), F.coalesce("members", F.array().cast("array<string>"))))).alias("string"),
    ).where(F.col("string").isNotNull())
    strings = cut(strings.distinct())
    # A string links its rows through the smallest of them: one edge a row, however many rows share it.
    hubs = strings.groupBy("string").agg(F.min("row").alias("hub"))
    shared = mapped(strings, "string", hubs, "hub", strings.count()).where(F.col("row") != F.col("hub")).select(F.col("hub").alias("a"), F.col("row").alias("b"))
    accepted = pairs.where(F.col("status") == "accepted").select(
        F.col("left_id").cast("long").alias("a"), F.col("right_id").cast("long").alias("b")
    )
    accepted = cut(accepted.where(F.col("a") != F.col("b")).distinct())
    known = lambda c: ids.withColumnRenamed("node", c).withColumn(f"in_{c}", F.lit(True))
    n = accepted.count()
    accepted = mapped(mapped(accepted, "a", known("a"), "in_a", n), "b", known("b"), "in_b", n).select("a", "b")
    groups = smallest_labels(components(shared.unionByName(accepted)))
    return ids.join(groups, "node", "left").select(
        F.col("node").alias("alias_row_id"), F.coalesce("group", "node").alias("group_id")
    )
