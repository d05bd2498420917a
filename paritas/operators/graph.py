"""Cycles in a foreign-key (or any directed) graph (G8), as iterative DataFrame jobs.

Every step is linear in nodes and edges: no pairs of nodes are formed.

1. Self-loops are cycles of length one; they are taken out first (a self-reference keeps
   its node alive through every trim below and would stall them).
2. A graph with at most one out-edge per node (one foreign key per table) needs no search: by
   pointer doubling each node knows where it stands after 2^k steps. After as many
   steps as there are nodes only cycle nodes are reached, and each of them is.
3. Otherwise ``peel`` drops edges whose source has no in-edge or whose target has no
   out-edge. Single rounds take off leaves; chains go as a whole: a node with one
   out-edge follows it by pointer doubling to the end of its chain, and is dropped when
   nothing leads on from there (in-edges alike). So trees and chains of any length take a
   number of rounds that grows with the logarithm of their size.
4. ``strongly_connected``: SCC labels, phase by phase: peel (singletons), forward max-colour propagation, then backward reachability from
   each colour's root inside its colour. Work per round is O(V + E).
5. ``fk_cycles``: one witness path per component. A breadth-first tree grows from the
   component's least node, all components at once, each node with its depth and one parent
   (the least); the first level that leads back to the root closes the cycle, and the nodes between are marked
   along the parent pointers by doubling. Components that are rings take positions from doubling, without a search.

Joins carry the ``merge`` hint: their sides grow with the graph, and a side below Spark's broadcast
threshold would pass through the driver again in each of some hundred rounds.

Every loop round cuts lineage with a reliable ``checkpoint()`` (directory from the
session's ``spark.checkpoint.dir``), so executor loss recomputes at most one round. A checkpoint keeps the
optimizer's estimate of its size, for a join the product of both sides: where a state is joined with itself the digits
of that number double each round, in the driver. Doubling rounds are therefore written as tables, whose size is that of their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.session import reliable_checkpoint as _cut
from paritas.session import reliable_table as _table

#: Leaf rounds before chains are followed; the edges that stay are the same for any number.
LEAF_ROUNDS = 3


def _edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    return (edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
            .filter(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct())


def _degrees(e: DataFrame) -> DataFrame:
    """(node, o, i): whether a node has an out-edge and an in-edge, one aggregation over both edge ends."""
    ends = (e.select(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"))
            .unionByName(e.select(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))))
    return ends.groupBy("node").agg(F.sum("o").alias("o"), F.sum("i").alias("i"))


def _live(e: DataFrame) -> DataFrame:
    """Nodes with both an in- and an out-edge in ``e``."""
    return _degrees(e).filter((F.col("o") > 0) & (F.col("i") > 0)).select("node")


def _between(e: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges with both ends among ``nodes``."""
    return (e.join(nodes.hint("merge"), F.col("src") == F.col("node"), "left_semi")
            .join(nodes.hint("merge"), F.col("dst") == F.col("node"), "left_semi"))


def _jump_ends(pointers: DataFrame) -> DataFrame:
    """(node, end) for ``pointers`` (node, jump), one row per node: where a node's walk stops,
    which is the first node without a pointer. Walks that run in a circle have no row."""
    state = _table(pointers.select("node", "jump", F.lit(True).alias("moving")))
    n, span = state.count(), 1
    while span <= n:
        ahead = state.select(F.col("node").alias("jump"), F.col("jump").alias("next"))
        state = _table(state.join(ahead.hint("merge"), "jump", "left")
                       .select("node", F.coalesce("next", "jump").alias("jump"), F.col("next").isNotNull().alias("moving")))
        if state.filter("moving").isEmpty():
            break
        span *= 2
    return state.filter(~F.col("moving")).select("node", F.col("jump").alias("end"))


def _dead_chains(e: DataFrame, src: str, dst: str) -> DataFrame:
    """Nodes whose only ``src -> dst`` way leads along nodes with one way on to a node without any."""
    single = e.groupBy(F.col(src).alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min(dst).alias("jump")).filter("n = 1")
    ends = _jump_ends(single.select("node", "jump"))
    return ends.join(e.select(F.col(src).alias("end")).hint("merge"), "end", "left_anti").select("node")


def _peel(e: DataFrame) -> DataFrame:
    e = _cut(e)
    n, rounds = e.count(), 0
    while n:
        if rounds % (LEAF_ROUNDS + 1) == LEAF_ROUNDS:
            dead = _cut(_dead_chains(e, "src", "dst").unionByName(_dead_chains(e, "dst", "src")).distinct())
            rest = e.join(dead.hint("merge"), F.col("src") == F.col("node"), "left_anti").join(dead.hint("merge"), F.col("dst") == F.col("node"), "left_anti")
        else:
            rest = _between(e, _live(e))
        rest = _cut(rest)
        m, rounds = rest.count(), rounds + 1
        if m == n and rounds % (LEAF_ROUNDS + 1) != 0:  # a round of leaves that found none
            return rest
        e, n = rest, m
    return e


def peel(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges (src, dst) left after repeatedly removing edges that cannot lie on a cycle."""
    return _peel(_edges(edges, src, dst))


def strongly_connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst); component = largest node id of the SCC."""
    nodes = _cut(edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct())
    rem_e = edges
    done: list[DataFrame] = []
    while not nodes.isEmpty():
        rem_e = _peel(rem_e)  # whole tails and bridges go at once, not a layer a phase
        live = _cut(rem_e.select(F.col("src").alias("node")).distinct())
        done.append(_cut(nodes.join(live.hint("merge"), "node", "left_anti").select("node", F.col("node").alias("component"))))
        if live.isEmpty():
            break
        # forward: colour(v) = max colour over v and its predecessors, to a fixpoint
        colour = live.select("node", F.col("node").alias("colour"))
        while True:
            pushed = (rem_e.join(colour.withColumnRenamed("node", "src").hint("merge"), "src")
                      .select(F.col("dst").alias("node"), "colour", F.lit(False).alias("own")))
            nxt = _cut(colour.select("node", "colour", F.lit(True).alias("own")).unionByName(pushed)
                       .groupBy("node").agg(F.max("colour").alias("colour"),
                                            F.max(F.when(F.col("own"), F.col("colour"))).alias("old")))
            colour = nxt.select("node", "colour")
            if nxt.filter(F.col("colour") != F.col("old")).isEmpty():
                break
        # backward: from each root (colour == node), walk predecessors of the same colour
        member = _cut(colour.filter(F.col("node") == F.col("colour")).select("node", F.col("colour").alias("component")))
        frontier = member
        while True:
            preds = _cut(rem_e.join(frontier.withColumnRenamed("node", "dst").hint("merge"), "dst")
                         .select(F.col("src").alias("node"), "component")
                         .join(colour.hint("merge"), "node").filter(F.col("colour") == F.col("component")).select("node", "component")
                         .join(member.hint("merge"), "node", "left_anti").distinct())
            if preds.isEmpty():
                break
            member = _cut(member.unionByName(preds))
            frontier = preds
        done.append(member)
        gone = member.select("node")
        nodes = _cut(live.join(gone.hint("merge"), "node", "left_anti"))
        rem_e = _cut(rem_e.join(gone.withColumnRenamed("node", "src").hint("merge"), "src", "left_anti")
                     .join(gone.withColumnRenamed("node", "dst").hint("merge"), "dst", "left_anti"))
    if not done:
        t = edges.schema["src"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"node {t}, component {t}")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _split_loops(edges: DataFrame, src: str, dst: str) -> tuple[DataFrame, DataFrame]:
    e = _cut(_edges(edges, src, dst))
    loops = e.filter(F.col("src") == F.col("dst")).select(F.col("src").alias("node"))
    return loops, e.filter(F.col("src") != F.col("dst"))


def _is_functional(e: DataFrame) -> bool:
    """No node has more than one out-edge."""
    return e.groupBy("src").count().filter(F.col("count") > 1).isEmpty()


def _ring_edges(e: DataFrame) -> DataFrame:
    """The edges on cycles of a graph with at most one out-edge per node. Walks that end drop out
    of the inner join; what is reached after at least as many steps as there are edges lies on a cycle."""
    e = _cut(e)
    state, n, span = e.select(F.col("src").alias("node"), F.col("dst").alias("jump")), e.count(), 1
    while span < n:
        ahead = state.select(F.col("node").alias("jump"), F.col("jump").alias("next"))
        state = _table(state.join(ahead.hint("merge"), "jump").select("node", F.col("next").alias("jump")))
        span *= 2
    on = state.select(F.col("jump").alias("node")).distinct()
    return _cut(e.join(on.hint("merge"), F.col("src") == F.col("node"), "left_semi"))


def _rings(ring: DataFrame) -> DataFrame:
    """(node, component, position) for disjoint simple cycles: each ring's least node, and the steps
    from it. Both by pointer doubling: the least id among the 2^k nodes ahead, then the steps
    to the root, which keeps its walk. When a round changes no node's least id, the stretches that follow each
    other around a ring have the same one, which is the ring's: rounds grow with the logarithm of the longest ring."""
    state = _table(ring.select(F.col("src").alias("node"), F.col("dst").alias("jump"), F.least("src", "dst").alias("best"), F.lit(True).alias("moved")))
    while not state.filter("moved").isEmpty():
        ahead = state.select(F.col("node").alias("jump"), F.col("jump").alias("next"), F.col("best").alias("b2"))
        state = _table(state.join(ahead.hint("merge"), "jump").select("node", F.col("next").alias("jump"), F.least("best", "b2").alias("best"), (F.col("b2") < F.col("best")).alias("moved")))
    member = state.select("node", F.col("best").alias("component"))
    root = F.col("node") == F.col("component")
    walk = _table(ring.join(member.hint("merge"), F.col("src") == F.col("node")).select(
        "node", "component", F.when(root, F.col("node")).otherwise(F.col("dst")).alias("jump"), F.when(root, 0).otherwise(1).cast("bigint").alias("steps")))
    while not walk.filter("jump <> component").isEmpty():
        ahead = walk.select(F.col("node").alias("jump"), F.col("jump").alias("next"), F.col("steps").alias("more"))
        walk = _table(walk.join(ahead.hint("merge"), "jump").select("node", "component", F.col("next").alias("jump"), (F.col("steps") + F.col("more")).alias("steps")))
    size = walk.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return walk.join(size.hint("merge"), "component").select("node", "component", F.when(F.col("steps") == 0, 0).otherwise(F.col("size") - F.col("steps")).cast("bigint").alias("position"))


def _components(edges: DataFrame, src: str, dst: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(loops, edges inside components, rings): what stands on cycles of more than one node, the
    edges with their component, and the positions of those components that are rings."""
    loops, rest = _split_loops(edges, src, dst)
    if _is_functional(rest):
        rings = _cut(_rings(_ring_edges(rest)))
        inner = rest.join(rings.select(F.col("node").alias("src"), "component").hint("merge"), "src").limit(0)
        return loops, inner, rings
    core = _peel(rest)
    comp = strongly_connected(core)
    least = comp.groupBy("component").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    comp = _cut(comp.join(least.hint("merge"), "component").select("node", F.col("least").alias("component"), "size"))
    ends = lambda side: comp.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    inner = _cut(core.join(ends("src").hint("merge"), "src").join(ends("dst").hint("merge"), "dst").filter(F.col("c_src") == F.col("c_dst")).select("src", "dst", F.col("c_src").alias("component")))
    ring = inner.groupBy("component").agg(F.count(F.lit(1)).alias("n")).join(comp.select("component", "size").distinct().hint("merge"), "component").filter("n = size").select("component")
    rings = _cut(_rings(inner.join(ring.hint("merge"), "component", "left_semi").select("src", "dst")))
    return loops, inner.join(ring.hint("merge"), "component", "left_anti"), rings


def _searched(inner: DataFrame) -> DataFrame:
    """(component, node, position) of a shortest cycle through each component's least node:
    breadth-first trees of all components at once. A component leaves the search on the level that leads
    back to its root; among a node's parents on a level, and among the nodes that close the cycle, the least counts."""
    inner = _cut(inner)
    root = inner.select("component").distinct()
    tree = _cut(root.select("component", F.col("component").alias("node"), F.lit(None).cast(inner.schema["src"].dataType).alias("parent"), F.lit(0).cast("bigint").alias("depth")))
    frontier, closed, level = tree, None, 0
    while not frontier.isEmpty():
        step = _cut(inner.join(frontier.select(F.col("node").alias("src"), "component").hint("merge"), ["src", "component"]))
        back = step.filter(F.col("dst") == F.col("component")).groupBy("component").agg(F.min("src").alias("node"), F.lit(level).cast("bigint").alias("last"))
        back = _cut(back)
        closed = back if closed is None else _cut(closed.unionByName(back))
        level += 1
        frontier = _cut(step.join(back.hint("merge"), "component", "left_anti").groupBy("component", F.col("dst").alias("node")).agg(F.min("src").alias("parent"))
                        .join(tree.hint("merge"), ["component", "node"], "left_anti").withColumn("depth", F.lit(level).cast("bigint")))
        tree = _cut(tree.unionByName(frontier.select(tree.columns)))
    if closed is None:
        return inner.select("component", F.col("src").alias("node"), F.lit(0).cast("bigint").alias("position")).limit(0)
    marked = closed.select("component", "node")
    jumps = _table(tree.filter(F.col("parent").isNotNull()).select("component", "node", F.col("parent").alias("jump")))
    span = 1
    while span <= level:  # after k rounds the 2^k nodes nearest to the closing one are marked
        marked = _cut(marked.unionByName(marked.join(jumps.hint("merge"), ["component", "node"]).select("component", F.col("jump").alias("node"))).distinct())
        ahead = jumps.select("component", F.col("node").alias("jump"), F.col("jump").alias("next"))
        jumps = _table(jumps.join(ahead.hint("merge"), ["component", "jump"]).select("component", "node", F.col("next").alias("jump")))
        span *= 2
    return marked.join(tree.hint("merge"), ["component", "node"]).select("component", "node", F.col("depth").alias("position"))


def cycle_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Nodes that lie on a directed cycle (self-loops included) and the least node of their
    strongly connected component: (node, component)."""
    loops, inner, rings = _components(edges, src, dst)
    multi = rings.select("node", "component").unionByName(inner.select(F.col("src").alias("node"), "component").distinct())
    alone = loops.join(multi.hint("merge"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return multi.unionByName(alone)


def cycle_nodes(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Nodes that lie on at least one directed cycle (self-loops included): (node)."""
    loops, rest = _split_loops(edges, src, dst)
    if _is_functional(rest):
        return _ring_edges(rest).select(F.col("src").alias("node")).unionByName(loops).distinct()
    comp = strongly_connected(_peel(rest))
    sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    multi = comp.join(sizes.filter(F.col("size") > 1).hint("merge"), "component").select("node")
    return multi.unionByName(loops).distinct()


def fk_cycles(edges: DataFrame, src: str = "parent_table", dst: str = "referenced_table") -> DataFrame:
    """One row per strongly connected component with a cycle: ``component`` (its least node),
    ``n_nodes``, and as witness a shortest cycle through that node: ``cycle_len`` and ``path``
    (the nodes in order, the first one again at the end). A self-loop of that node is its shortest cycle."""
    loops, inner, rings = _components(edges, src, dst)
    own = loops.select(F.col("node").alias("component")).distinct()
    steps = rings.select("component", "node", "position").unionByName(_searched(inner)).join(own.hint("merge"), "component", "left_anti")
    steps = steps.unionByName(own.select("component", F.col("component").alias("node"), F.lit(0).cast("bigint").alias("position")))
    paths = steps.groupBy("component").agg(F.sort_array(F.collect_list(F.struct("position", "node"))).alias("steps"))
    nodes = rings.select("node", "component").unionByName(inner.select(F.col("src").alias("node"), "component").distinct())
    nodes = nodes.unionByName(loops.join(nodes.hint("merge"), "node", "left_anti").select("node", F.col("node").alias("component")))
    sizes = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))
    return (sizes.join(paths.hint("merge"), "component")  # a self-loop of another node than the least one is no component
            .select("component", "n_nodes", F.size("steps").cast("bigint").alias("cycle_len"),
                    F.concat(F.transform("steps", lambda s: s["node"]), F.array("component")).alias("path")))
