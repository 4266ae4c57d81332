"""Walks over (id, parent_id) tables. Edges point from child to parent; a node may have several parents."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.frame import checkpointed, first_by


#: Rounds of a walk after which what is known becomes one table again, so that a deep walk's plan stays short.
COMPACT = 8


def edges_of(nodes: DataFrame) -> DataFrame:
    return nodes.where("parent_id IS NOT NULL").select("id", "parent_id").distinct()


def build_graph(nodes: DataFrame) -> DataFrame:
    """Every node, also a parent without a record of its own."""
    e = edges_of(nodes)
    ids = nodes.select("id", F.lit(True).alias("has_record"))
    parents = e.select(F.col("parent_id").alias("id"), F.lit(False).alias("has_record"))
    return ids.union(parents).groupBy("id").agg(F.max("has_record").alias("has_record"))


def roots(nodes: DataFrame) -> DataFrame:
    return build_graph(nodes).select("id").join(edges_of(nodes).select("id"), "id", "left_anti")


def leaves(nodes: DataFrame) -> DataFrame:
    return build_graph(nodes).select("id").join(edges_of(nodes).select(F.col("parent_id").alias("id")), "id", "left_anti")


def closure(nodes: DataFrame) -> DataFrame:
    """(id, ancestor, hops): every ancestor once, at its fewest hops; a cycle ends where it closes.

    A frontier loop: each round joins the last pairs with the edges and drops pairs that are known, until none is new.
    """
    up = checkpointed(edges_of(nodes).select("id", F.col("parent_id").alias("ancestor")))
    parents = up.select(F.col("id").alias("_at"), F.col("ancestor").alias("_next"))
    known = frontier = up.where("id <> ancestor").withColumn("hops", F.lit(1))
    for hops in count(2):
        step = frontier.join(parents, F.col("ancestor") == F.col("_at")).select("id", F.col("_next").alias("ancestor")).where("id <> ancestor").distinct()
        frontier = checkpointed(step.join(known.select("id", "ancestor"), ["id", "ancestor"], "left_anti").withColumn("hops", F.lit(hops)))
        if frontier.isEmpty():
            break
        known = known.union(frontier)
        if hops % COMPACT == 0:
            known = checkpointed(known.repartition("id"))
    return known


def depths(nodes: DataFrame) -> DataFrame:
    """Number of hops up to the farthest root that is reached."""
    deepest = closure(nodes).groupBy("id").agg(F.max("hops").alias("depth"))
    return build_graph(nodes).select("id").join(deepest, "id", "left").select("id", F.coalesce("depth", F.lit(0)).alias("depth"))


def full_paths(nodes: DataFrame, separator: str = " > ") -> DataFrame:
    """Labels from the root down to each node of a forest."""
    above = closure(nodes).join(nodes.select(F.col("id").alias("ancestor"), F.col("label").alias("_l")), "ancestor")
    lists = above.groupBy("id").agg(F.sort_array(F.collect_list(F.struct((-F.col("hops")).alias("h"), "_l"))).alias("up"))
    return nodes.join(lists, "id", "left").select(
        "id",
        F.array_join(
            F.concat(F.coalesce(F.transform("up", lambda x: x["_l"]), F.array().cast("array<string>")), F.array("label")), separator
        ).alias("full_path"),
    )


def descendants(nodes: DataFrame, root: str) -> DataFrame:
    """(id, hops) of all nodes below ``root``: a walk from the root that never sees the rest of the forest."""
    down = edges_of(nodes).select(F.col("parent_id").alias("src"), F.col("id").alias("dst"))
    return reach(down, down.sparkSession.createDataFrame([(root,)], "id string")).where("level > 0").select("id", F.col("level").alias("hops"))


def children(nodes: DataFrame) -> DataFrame:
    return edges_of(nodes).groupBy(F.col("parent_id").alias("id")).agg(F.count("*").alias("children"))


def siblings(nodes: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Pairs of different nodes with one parent: for the nodes in ``of`` (id), else for all, which is quadratic in a parent's children."""
    e = edges_of(nodes)
    asked = e if of is None else e.join(of.select("id").distinct(), "id", "left_semi")
    other = e.select(F.col("id").alias("sibling"), "parent_id")
    return asked.join(other, "parent_id").where("id <> sibling").select("id", "sibling").distinct()


def sibling_groups(nodes: DataFrame) -> DataFrame:
    """(parent_id, id, siblings): all siblings as members of their parent's group, with the number of the others in it."""
    e = edges_of(nodes)
    sizes = e.groupBy("parent_id").agg((F.count("*") - 1).alias("siblings"))
    return e.join(sizes, "parent_id").select("parent_id", "id", "siblings")


def subtree(nodes: DataFrame, root: str) -> DataFrame:
    """The records of a node and its descendants."""
    below = descendants(nodes, root).select("id").union(nodes.where(F.col("id") == root).select("id"))
    return nodes.join(below.distinct(), "id", "left_semi")


def tree_rows(nodes: DataFrame, root: str, max_depth: int | None = None) -> DataFrame:
    """(id, label, depth, path) of the tree below ``root``, a node once for each way down to it; in the order of ``path`` (an array of
    labels and ids) the rows are the nested tree with children sorted by label. A way ends where it would meet itself."""
    e = edges_of(nodes).select(F.col("parent_id").alias("_up"), F.col("id").alias("_down"))
    one = nodes.groupBy("id").agg(F.coalesce(F.min("label"), F.lit("")).alias("label"))  # a node has a row for each parent
    labels = one.select(F.col("id").alias("_down"), F.col("label").alias("_label"))
    step = lambda label, i: F.struct(label.alias("label"), i.alias("id"))
    start = one.where(F.col("id") == root).select("id", "label", F.lit(0).alias("depth"), F.array(step(F.col("label"), F.col("id"))).alias("path"))
    known = frontier = checkpointed(start)
    for depth in count(1):
        if max_depth is not None and depth > max_depth:
            break
        down = frontier.join(e, F.col("id") == F.col("_up")).join(labels, "_down").where(~F.exists("path", lambda x: x["id"] == F.col("_down")))
        frontier = checkpointed(down.select(
            F.col("_down").alias("id"), F.col("_label").alias("label"), F.lit(depth).alias("depth"), F.concat("path", F.array(step(F.col("_label"), F.col("_down")))).alias("path")
        ))
        if frontier.isEmpty():
            break
        known = known.union(frontier)
    return known


def depth_capped(nodes: DataFrame, max_depth: int) -> DataFrame:
    """Nodes (id, level, parents and refs as arrays) of at most ``max_depth``; parent_id is the first parent that is left, and refs are
    those that are left, in their order."""
    kept = nodes.where(F.col("level") <= max_depth)
    ids = kept.select(F.col("id").alias("_to")).distinct()

    def left_of(c: str) -> DataFrame:
        each = kept.select("id", F.posexplode(c).alias("_at", "_to")).join(ids, "_to", "left_semi")
        return each.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_to"))), lambda x: x["_to"]).alias(f"_{c}"))

    joined = kept.join(left_of("parents"), "id", "left").join(left_of("refs"), "id", "left")
    rest = [c for c in nodes.columns if c not in ("parents", "refs")]
    return joined.select(*rest, F.try_element_at("_parents", F.lit(1)).alias("parent_id"), F.coalesce("_refs", F.array().cast("array<string>")).alias("refs"))


def lineages(nodes: DataFrame, allowed: list[str]) -> DataFrame:
    """For nodes with label and rank: path, the labels of ancestors and self whose rank is allowed (" > "), and lineage, those of all
    ancestors ("; "), both root first."""
    up = closure(nodes).join(nodes.select(F.col("id").alias("ancestor"), F.col("label").alias("_l"), F.col("rank").alias("_r")), "ancestor")
    lists = up.groupBy("id").agg(F.sort_array(F.collect_list(F.struct((-F.col("hops")).alias("h"), "_l", "_r"))).alias("_up"))
    above = F.coalesce("_up", F.array().cast("array<struct<h:int,_l:string,_r:string>>"))
    own = F.when(F.col("rank").isin(allowed), F.array("label")).otherwise(F.array().cast("array<string>"))
    return nodes.join(lists, "id", "left").select(
        "id", F.array_join(F.concat(F.transform(F.filter(above, lambda x: x["_r"].isin(allowed)), lambda x: x["_l"]), own), " > ").alias("path"),
        F.array_join(F.transform(above, lambda x: x["_l"]), "; ").alias("lineage"),
    )


def rank_filter(nodes: DataFrame, ranks: list[str]) -> DataFrame:
    """The nodes of the given ranks; level is a rank's place among them."""
    return nodes.where(F.col("rank").isin(ranks)).withColumn("level", F.array_position(F.array(*map(F.lit, ranks)), F.col("rank")).cast("int") - 1)


def envelope(rows: DataFrame, name: str, version: str, levels: list[tuple[str, str]], last: tuple[str, str] | None = None, parents: list[str] = ()) -> DataFrame:
    """The nodes of an organisation: one for each different value of each of ``levels`` (column, node type) below its parents, with the
    number of rows (publications), a path and an id made of name, level and label.

    ``last`` is a further level below those nodes of the lowest one whose label is in ``parents``; its rows are
    counted by label of the two whatever is above. Ids that meet are one node, that with the first path.
    """
    columns = [c for c, _ in levels]

    def node_id(label: Column, level: int) -> Column:
        return F.concat(F.lit(f"{name}:L{level}:"), F.left(F.replace(F.replace(F.lower(label), F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and")), F.lit(50)))

    def node(level: int, kind: str, label: Column, own: Column, parent: Column) -> list[Column]:
        path = [*columns[: level + 1], label] if level == len(columns) else columns[: level + 1]
        return [
            node_id(own, level).alias("envelope_id"), F.lit(name).alias("envelope_name"), F.lit(version).alias("version"), label.alias("label"), parent.alias("parent_id"),
            F.lit(level).alias("level"), F.concat_ws(" > ", *path).alias("full_path"), F.lit(kind).alias("node_type"), "pub_count",
        ]

    parts = []
    for k, (c, kind) in enumerate(levels):
        some = rows.dropna(subset=columns[: k + 1]).groupBy(*columns[: k + 1]).agg(F.count("*").alias("pub_count"))
        parts.append(some.select(*node(k, kind, F.col(c), F.col(c), node_id(F.col(columns[k - 1]), k - 1) if k else F.lit(None).cast("string"))))
    if last:
        low = columns[-1]
        counts = rows.where(F.col(low).isin(list(parents)) & F.col(last[0]).isNotNull()).groupBy(low, last[0]).agg(F.count("*").alias("pub_count"))
        ways = rows.dropna(subset=columns).select(*columns).distinct().join(counts, low)
        parts.append(ways.select(*node(len(columns), last[1], F.col(last[0]), F.concat_ws("_", low, last[0]), node_id(F.col(low), len(columns) - 1))))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return first_by(every, ["envelope_id"], ["full_path"])


def graph_stats(nodes: DataFrame) -> DataFrame:
    """Nodes, edges, roots, leaves and greatest depth in one row."""
    d = depths(nodes).agg(F.count("*").alias("nodes"), F.max("depth").alias("max_depth"))
    e = edges_of(nodes).agg(F.count("*").alias("edges"))
    r = roots(nodes).agg(F.count("*").alias("roots"))
    v = leaves(nodes).agg(F.count("*").alias("leaves"))
    return d.crossJoin(e).crossJoin(r).crossJoin(v)  # four rows of one


def depth_histogram(nodes: DataFrame) -> DataFrame:
    return depths(nodes).groupBy("depth").agg(F.count("*").alias("n"))


def common_ancestors(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """For pairs (a, b) the ancestor of both (a node counts as its own) with the fewest hops."""
    c = closure(nodes)
    own = c.union(build_graph(nodes).select("id", F.col("id").alias("ancestor"), F.lit(0).alias("hops")))
    a = own.select(F.col("id").alias("a"), "ancestor", F.col("hops").alias("ha"))
    b = own.select(F.col("id").alias("b"), "ancestor", F.col("hops").alias("hb"))
    met = pairs.join(a, "a").join(b, ["b", "ancestor"])
    return first_by(met, ["a", "b"], [F.col("ha") + F.col("hb"), "ancestor"]).select("a", "b", "ancestor")


def find_label(nodes: DataFrame, text: str, exact: bool = False) -> DataFrame:
    hit = F.col("label") == text if exact else F.lower("label").contains(text.lower())
    return nodes.where(hit)


def reach(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(id, level): fewest hops from the start nodes along edges (src, dst)."""
    known = frontier = checkpointed(start.select("id").distinct().withColumn("level", F.lit(0)))
    for level in count(1):
        step = frontier.join(edges, F.col("id") == F.col("src")).select(F.col("dst").alias("id")).distinct()
        frontier = checkpointed(step.join(known.select("id"), "id", "left_anti").withColumn("level", F.lit(level)))
        if frontier.isEmpty():
            break
        known = known.union(frontier)
        if level % COMPACT == 0:
            known = checkpointed(known.repartition("id"))
    return known


def filtered_parent(nodes: DataFrame, allowed: list[str]) -> DataFrame:
    """The nearest ancestor whose rank is allowed."""
    rank = nodes.select(F.col("id").alias("ancestor"), F.col("rank").alias("_r")).where(F.col("_r").isin(allowed))
    near = closure(nodes).join(rank, "ancestor").groupBy("id").agg(F.min_by("ancestor", F.struct("hops", "ancestor")).alias("parent"))
    return nodes.select("id").join(near, "id", "left")


def unconnected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Senses on neither end of a relationship."""
    ends = edges.select(F.col("source_sense_id").alias("sense_id")).union(edges.select("target_sense_id"))
    return nodes.join(ends.distinct(), "sense_id", "left_anti")


def degrees(edges: DataFrame) -> DataFrame:
    """Relationships of each sense; a loop counts once."""
    ends = F.explode(F.array_distinct(F.array("source_sense_id", "target_sense_id")))
    return edges.select(ends.alias("sense_id")).groupBy("sense_id").agg(F.count("*").alias("degree"))


def density(senses: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """Relationships of each kind (type, provenance), and how many there are for a sense."""
    every = senses.agg(F.count("*")).scalar()
    return edges.groupBy(*by).agg(F.count("*").alias("n")).select(*by, "n", F.round(F.col("n") / every, 6).alias("per_sense"))
