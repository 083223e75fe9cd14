"""Repair of bill-of-material graphs.

A graph is an edge table. ``Shape`` names its columns: the site and group columns inside which
codes are compared, the item codes (company side) and the site codes (manufacturer side).
Two operators follow paths: ``find_cycle_edges`` and ``flagged_ancestor``. They shorten paths
instead of walking them: nodes with one way in are folded into the node above by pointer doubling,
labels jump to the label of the node they name, and chains inside components become one edge. The
number of jobs grows with the logarithm of a path's length; each round is written to the shared
work folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.context import RunContext
from supplyprep.functions.clean import join_text
from supplyprep.functions.dates import OPEN_END
from supplyprep.operators.groups import keep_latest, multi_mapped
from supplyprep.operators.joins import (
    all_of,
    exists_in,
    flag_exists,
    not_exists_in,
    not_in,
)
from supplyprep.operators.rows import delete_where, holds, update_where
from supplyprep.sources.readers import latest_version_global
from supplyprep.sources.storage import materialize


@dataclass(frozen=True)
class Shape:
    site: str = "odm"
    father: str = "father_pn"
    father_site: str = "father_site_pn"
    son: str = "son_pn"
    son_site: str = "son_site_pn"
    quantity: str = "qtyper"
    group: str = "alt_group"
    priority: str = "alt_priority"
    start: str = "eff_start"
    end: str = "eff_end"
    created_by: str = "created_by"


BOM = Shape()

ROUNDS_PER_JOB = 2
"""Levels that a graph loop walks before it writes its state (more repeat work inside one job)."""

WAVES_BEFORE_DOMINATORS = 3
"""Waves of walks inside the components after which, if walks still grow in number, the edges still
open are tested for dominators."""

# Content of the dummy edges between an item and its site code.
DUMMY_QUANTITY = 1
DUMMY_GROUP = "1"
DUMMY_PRIORITY = "99"
DUMMY_START = "1971-01-01"


def edges_with_nulls(edges: DataFrame, values: dict[str, Column]) -> list[Column]:
    """Select list in the order of the edge table; columns without a value are typed nulls."""
    return [
        (values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in edges.schema.fields
    ]


# --- cycles ---------------------------------------------------------------------------------


def _same(keys: Sequence[str], column: str, other: str) -> Column:
    """Join condition of a plain table with one whose columns carry two underscores."""
    return all_of([F.col(k) == F.col(f"__{k}") for k in keys] + [F.col(column) == F.col(other)])


def _renamed(df: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"__{c}") for c in [*keys, *columns]])


def _trim(
    edges: DataFrame, keys: Sequence[str], *sides: tuple[str, str]
) -> tuple[DataFrame, int]:
    """Drop the edges whose one end is not the other end of an edge, and so a few times over.

    The bulk of a bill of material are leaves and what is right above them; what is left of the
    edges that cannot lie on a cycle is up to the labels.
    """
    same = [(k, k) for k in keys]
    for _ in range(ROUNDS_PER_JOB):
        for end, other in sides:
            edges = exists_in(edges, edges, [*same, (end, other)])
    return materialize(edges, "trim")


LABELLINGS = 2
"""Independent orders of the nodes whose largest members are spread at a time."""


def _component_labels(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per node and order the largest label that reaches it (``down``) and that it reaches (``up``).

    A label names a node, and what reaches that node reaches all nodes with its label, too. So a
    node takes not only its neighbours' labels but also the label of the node that its own names,
    and labels travel in jumps.
    """
    ends = [f"{way}{k}" for k in range(LABELLINGS) for way in ("down", "up")]
    pairs = edges.select(*keys, "father", "son")
    along = pairs.select(*keys, F.col("father").alias("at"), F.col("son").alias("node"), F.lit("down").alias("way"))
    against = pairs.select(*keys, "son", "father", F.lit("up"))
    nodes = pairs.select(*keys, "father").union(pairs.select(*keys, "son")).distinct()
    own = nodes.select(*keys, "father", F.col("father").alias("node"), F.lit("own"))
    links, _ = materialize(along.union(against).union(own), "links")
    state = links.filter("way = 'own'").select(*keys, "node").withColumns(
        {f"{way}{k}": F.struct(F.xxhash64(F.lit(k), *keys, "node").alias("rank"), "node") for k in range(LABELLINGS) for way in ("down", "up")}
    )
    def step(state: DataFrame) -> DataFrame:
        named = F.explode(F.array(*[F.struct(F.col(f"{e}.node").alias("at"), F.lit(e).alias("way")) for e in ends])).alias("jump")
        jumps = state.select(*keys, "node", named).select(*keys, "jump.at", "node", "jump.way")
        met = links.union(jumps).join(_renamed(state, keys, "node", *ends), _same(keys, "at", "__node"))
        # A jump is good for its own order and way only.
        came = {e: F.max(F.when(F.col("way").isin("own", e[:-1], e), F.col(f"__{e}"))) for e in ends}
        old = {e: F.max(F.when(F.col("way") == "own", F.col(f"__{e}"))) for e in ends}
        moved = F.lit(False)
        for e in ends:
            moved = moved | (came[e] != old[e])
        return met.groupBy(*keys, "node").agg(*[came[e].alias(e) for e in ends], moved.alias("moved"))

    while True:
        state, moving = materialize(step(state), "labels", F.col("moved"))
        if not moving:
            return state


def _cyclic_core(edges: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """The edges inside strongly connected components, which ``component`` tells apart.

    A node whose largest reaching and largest reached label are the same is in that label's
    component, and so is whatever else has both labels. An edge whose ends differ in a label is in
    no component and is cut; what is left without being settled is labelled again. The component
    of the largest label is settled each time.
    """
    done = None
    edges, rows = _trim(edges, keys, ("father", "son"), ("son", "father"))
    ends = [f"{way}{k}" for k in range(LABELLINGS) for way in ("down", "up")]
    while rows:
        labels = _component_labels(edges, keys)
        settled = F.lit(False)
        for k in range(LABELLINGS):
            settled = settled | (F.col(f"down{k}") == F.col(f"up{k}"))
        marked = labels.select(*keys, "node", F.xxhash64(*ends).alias("component"), settled.alias("settled"))
        joined = edges.select(*keys, "father", "son")
        for end in ("father", "son"):
            of = marked.select(
                *[F.col(k).alias(f"__{k}") for k in keys],
                F.col("node").alias("__node"),
                F.col("component").alias(f"{end}_component"),
                "settled",
            )
            joined = joined.join(of if end == "father" else of.drop("settled"), _same(keys, end, "__node"))
            joined = joined.drop("__node", *[f"__{k}" for k in keys])
        kept = joined.filter("father_component = son_component").select(
            *keys, "father", "son", F.col("father_component").alias("component"), "settled"
        )
        kept, rows = materialize(kept, "core", ~F.col("settled"))
        inside = kept.filter("settled").drop("settled")
        done = inside if done is None else done.union(inside)
        if rows:
            edges, rows = _trim(kept.filter("NOT settled"), keys, ("father", "son"), ("son", "father"))
    if done is None:
        return edges.select(*keys, "father", "son", F.lit(0).cast("long").alias("component")), 0
    return materialize(done, "core")


def _doubled(
    pointers: DataFrame, keys: Sequence[str], rows: int, last: str | None = None
) -> DataFrame:
    """Pointers (``node``, ``top``, ``len``) followed until ``top`` has no pointer itself.

    Each step joins the pointers to themselves and doubles their reach. Nodes that lead into a
    circle of pointers are left out. ``last`` is a column that the far pointer's value replaces.
    """
    reach = 1
    while True:
        for _ in range(ROUNDS_PER_JOB + 1):
            onward = _renamed(pointers, keys, "node", "top", "len", *([last] if last else []))
            met = pointers.join(onward, _same(keys, "top", "__node"), "left")
            pointers = met.select(
                *keys,
                "node",
                F.coalesce("__top", "top").alias("top"),
                (F.col("len") + F.coalesce("__len", F.lit(0))).alias("len"),
                *([F.when(F.col("__node").isNull(), F.col(last)).otherwise(F.col(f"__{last}")).alias(last)] if last else []),
                F.col("__node").isNotNull().alias("open"),
            )
            reach *= 2
        pointers, still = materialize(pointers, "pointers", F.col("open"))
        if not still or reach > 2 * rows:
            return pointers.filter("NOT open").drop("open")
        pointers = pointers.drop("open")


def _folded(edges: DataFrame, starts: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame] | None:
    """Fold the nodes with one way in, none of the starts, into the node above.

    Returns pointers from folded nodes to the node that stays (``top``, ``len`` edges above), and
    the edges into nodes that stay, both ends moved there; or nothing if there is no such node.
    Loops among the edges mark a node that its own folded nodes lead back to.
    """
    ways = edges.groupBy(*keys, F.col("son").alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.min("father").alias("top"), F.min("length").alias("len")
    )
    ways = flag_exists(ways, starts, [*keys, "node"], "is_start")
    ways, single = materialize(ways, "ways-in", (F.col("n") == 1) & ~F.col("is_start"))
    if not single:
        return None
    ones = ways.filter("n = 1 AND NOT is_start").drop("n", "is_start")
    pointers = _doubled(ones, keys, single)
    several = ways.filter("n > 1 OR is_start").select(*keys, "node")
    left = exists_in(edges, several, [*[(k, k) for k in keys], ("son", "node")])
    above = _renamed(pointers, keys, "node", "top", "len")
    left = left.join(above, _same(keys, "father", "__node"), "left").select(
        *keys,
        F.col("father").alias("from"),
        F.coalesce("__top", "father").alias("father"),
        "son",
        (F.col("length") + F.coalesce("__len", F.lit(0))).alias("length"),
    )
    # Nothing comes from a node that is neither a start nor below another node.
    alive = several.union(starts.select(*keys, "node"))
    return pointers, exists_in(left, alive, [*[(k, k) for k in keys], ("father", "node")])


def _shorter(moved: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One edge, the shortest, for those between the same nodes; no loops."""
    return moved.filter("father != son").groupBy(*keys, "father", "son").agg(F.min("length").alias("length"))


def _composed(folded: DataFrame | None, pointers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Earlier pointers led on by newer ones."""
    if folded is None:
        return pointers
    onward = _renamed(pointers, keys, "node", "top", "len")
    led = folded.join(onward, _same(keys, "top", "__node"), "left").select(
        *keys, "node", F.coalesce("__top", "top").alias("top"), (F.col("len") + F.coalesce("__len", F.lit(0))).alias("len")
    )
    return led.union(pointers.select(led.columns))


def _nearest(links: DataFrame, starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Nodes below the starts: ``depth`` (1 for a start) and the nearest start's ``ancestor``, the least on ties.

    A node with one way in is as far from any start as the node above plus the edge's length, so it
    is folded into that node by pointer doubling; the edges out of it go over to the node above.
    Edges that then have both ends in common are one, the shortest. This is done again while there
    are nodes with one way in; what is left, if anything, is relaxed.
    """
    edges = not_exists_in(
        links.filter("father != son").select(*keys, "father", "son").distinct(),
        starts,
        [*[(k, k) for k in keys], ("son", "node")],
    ).withColumn("length", F.lit(1))
    edges, rows = materialize(edges, "ways")
    folded = None
    while rows and (round_ := _folded(edges, starts, keys)):
        pointers, moved = round_
        edges, rows = materialize(_shorter(moved, keys), "ways")
        folded = _composed(folded, pointers, keys)
    return _depths(edges, rows, starts, folded, keys)


def _depths(edges: DataFrame, rows: int, starts: DataFrame, folded: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Depths over the edges that are left, then of the nodes folded before; see :func:`_nearest`."""
    state = starts.select(*keys, "node", F.struct(F.lit(1).alias("depth"), "ancestor").alias("value"))
    while rows:
        moved = F.col("value") < F.coalesce("old", F.struct((F.col("value.depth") + 1).alias("depth"), F.col("value.ancestor").alias("ancestor")))
        for _ in range(ROUNDS_PER_JOB):
            came = edges.join(_renamed(state, keys, "node", "value"), _same(keys, "father", "__node")).select(
                *keys,
                F.col("son").alias("node"),
                F.struct((F.col("__value.depth") + F.col("length")).cast("int").alias("depth"), F.col("__value.ancestor").alias("ancestor")).alias("value"),
                F.lit(False).alias("own"),
            )
            state = (
                state.select(*keys, "node", "value", F.lit(True).alias("own"))
                .union(came)
                .groupBy(*keys, "node")
                .agg(F.min("value").alias("value"), F.min(F.when(F.col("own"), F.col("value"))).alias("old"))
                .withColumn("moved", moved)
                .drop("old")
            )
        state, rows = materialize(state, "relaxed", F.col("moved"))
    found = state.select(*keys, "node", "value.depth", "value.ancestor")
    if folded is None:
        return found
    tops = _renamed(found, keys, "node", "depth", "ancestor")
    below = folded.join(tops, _same(keys, "top", "__node")).select(
        *keys, "node", (F.col("__depth") + F.col("len")).cast("int").alias("depth"), F.col("__ancestor").alias("ancestor")
    )
    return materialize(found.union(below), "nearest")[0]


def _marked_above(tree: DataFrame, marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Nodes of a forest (``node``, ``top``: the node right above) that are marked or lie above a marked one.

    Marked nodes mark the node that their pointer names, and pointers double.
    """
    state = flag_exists(tree, marks, [*keys, "node"], "mark")
    while True:
        for _ in range(ROUNDS_PER_JOB):
            up = state.filter("mark AND top IS NOT NULL").select(*keys, F.col("top").alias("node"))
            onward = _renamed(state, keys, "node", "top")
            state = flag_exists(state, up, [*keys, "node"], "above").join(onward, _same(keys, "top", "__node"), "left")
            state = state.select(*keys, "node", F.col("__top").alias("top"), (F.col("mark") | F.col("above")).alias("mark"))
        state, onward_rows = materialize(state, "marks", F.col("mark") & F.col("top").isNotNull())
        if not onward_rows:
            return state.filter("mark").select(*keys, "node")


def _reach_and_cycles(links: DataFrame, starts: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, int]:
    """Depths of the nodes below the starts, and the edges inside strongly connected components, with their number.

    Folding the nodes with one way in keeps every cycle: what enters a folded node comes from the
    node above. So components are found among the few nodes that stay, and handed down: a node
    with a loop is in a component, and a folded node is in that of the node above if an edge of
    that component leaves it or a node folded below it.
    """
    plain = links.select(*keys, "father", "son")
    edges, rows = materialize(plain.filter("father != son").withColumn("length", F.lit(1)), "ways")
    folded, rounds = None, []
    while rows and (round_ := _folded(edges, starts, keys)):
        pointers, moved = round_
        moved, rows = materialize(moved, "moved", F.col("father") != F.col("son"))
        rounds.append((edges, pointers, moved))
        folded = _composed(folded, pointers, keys)
        edges = _shorter(moved, keys)
    into_others = not_exists_in(edges, starts, [*[(k, k) for k in keys], ("son", "node")])
    others = len(into_others.take(1)) if rows else 0
    reach = _depths(into_others, others, starts, folded, keys)

    core, n = _cyclic_core(edges.select(*keys, "father", "son"), keys) if rows else (None, 0)
    component = F.xxhash64(*keys, "node")
    if n:
        members = core.select(*keys, F.col("father").alias("node"), "component").distinct()
    else:
        members = starts.limit(0).select(*keys, "node", component.alias("component"))
    for before, pointers, moved in reversed(rounds):
        loops = moved.filter("father = son").select(*keys, F.col("son").alias("node")).distinct()
        own = loops.select(*keys, "node", component.alias("component"))
        members = members.withColumn("first", F.lit(1)).union(own.withColumn("first", F.lit(2)))
        members = members.groupBy(*keys, "node").agg(F.min_by("component", "first").alias("component"))
        members, some = materialize(members, "members")
        if not some:
            continue
        ends = moved.filter("from != father")
        for end in ("father", "son"):
            of = members.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("node").alias("__node"), F.col("component").alias(f"{end}_component"))
            ends = ends.join(of, _same(keys, end, "__node")).drop("__node", *[f"__{k}" for k in keys])
        leaving = ends.filter("father_component = son_component").select(*keys, F.col("from").alias("node")).distinct()
        tree = exists_in(before, pointers, [*[(k, k) for k in keys], ("son", "node")])
        inside = _marked_above(tree.select(*keys, F.col("son").alias("node"), F.col("father").alias("top")), leaving, keys)
        tops = _renamed(members, keys, "node", "component")
        below = pointers.join(tops, _same(keys, "top", "__node")).select(*keys, "node", F.col("__component").alias("component"))
        members = members.union(exists_in(below, inside, [*keys, "node"]))

    loops = plain.filter("father = son").select(*keys, F.col("father").alias("node")).distinct()
    members = members.withColumn("first", F.lit(1)).union(loops.select(*keys, "node", component.alias("component")).withColumn("first", F.lit(2)))
    members = members.groupBy(*keys, "node").agg(F.min_by("component", "first").alias("component"))
    members, some = materialize(members, "members")
    inside = plain
    for end in ("father", "son"):
        of = members.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("node").alias("__node"), F.col("component").alias(f"{end}_component"))
        inside = inside.join(of, _same(keys, end, "__node")).drop("__node", *[f"__{k}" for k in keys])
    inside = inside.filter("father_component = son_component").select(*keys, "father", "son", F.col("father_component").alias("component"))
    inside, n = materialize(inside, "core") if some else (inside, 0)
    return reach, inside, n


def _waves(
    first: DataFrame,
    advance: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    label: str,
) -> DataFrame:
    """Breadth-first waves over nodes; a node keeps the row of the first wave that reached it.

    ``advance`` turns a wave into one candidate row per next node. The result has ``depth``.
    """
    depth = 1
    frontier, rows = materialize(first.withColumn("depth", F.lit(depth)), label)
    settled = frontier
    while rows:
        seen, wave, found = settled, frontier, None
        for _ in range(ROUNDS_PER_JOB):
            depth += 1
            step = advance(wave).withColumn("depth", F.lit(depth))
            wave = not_exists_in(step, seen, [*keys, "node"])
            seen = seen.union(wave)
            found = wave if found is None else found.union(wave)
        found, rows = materialize(found, label, F.col("depth") == depth)
        settled = settled.union(found)
        frontier = found.filter(F.col("depth") == depth)
    return settled


def _shortened(core: DataFrame, ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The core with chains as one edge: ``father``, ``son``, ``length``, and ``closer``, the father of the chain's last edge.

    Nodes with one edge in and one out are inside a chain unless they are in ``ends``. A walk that
    enters a chain goes through all of it, once, so only its last edge can close a cycle.
    """
    out = core.groupBy(*keys, F.col("father").alias("node")).agg(
        F.count(F.lit(1)).alias("n_out"), F.min("son").alias("top"), F.max(F.col("father") == F.col("son")).alias("loop")
    )
    into = core.groupBy(*[F.col(k).alias(f"__{k}") for k in keys], F.col("son").alias("__node")).agg(F.count(F.lit(1)).alias("n_in"))
    inner = out.join(into, _same(keys, "node", "__node")).filter("n_out = 1 AND n_in = 1 AND NOT loop")
    inner = not_exists_in(inner.select(*keys, "node", "top", F.lit(1).alias("len"), F.col("node").alias("closer")), ends, [*keys, "node"])
    inner, rows = materialize(inner, "inner")
    plain = core.select(*keys, "father", "son", "component", F.lit(1).alias("length"), F.col("father").alias("closer"))
    if not rows:
        return plain
    chains = _doubled(inner, keys, rows, "closer")
    begun = not_exists_in(plain, inner, [*[(k, k) for k in keys], ("father", "node")])
    onward = _renamed(chains, keys, "node", "top", "len", "closer")
    joined = begun.join(onward, _same(keys, "son", "__node"), "left").select(
        *keys,
        "father",
        F.coalesce("__top", "son").alias("son"),
        "component",
        (F.col("length") + F.coalesce("__len", F.lit(0))).alias("length"),
        F.coalesce("__closer", "closer").alias("closer"),
    )
    return materialize(joined, "shortened")[0]


def find_cycle_edges(
    edges: DataFrame,
    roots: Column,
    father: str,
    son: str,
    group: Sequence[str],
) -> DataFrame:
    """Edges that close a cycle on a simple path which starts with a root edge.

    ``roots`` marks the root edges. The result holds ``group``, ``father``, ``son``, the smallest
    level seen and whether the walk can go on behind the edge (``is_leaf``).

    Only edges inside strongly connected components can close a cycle. How far from a root a
    component is entered comes from the shortest ways down. Inside the components chains are one
    edge, and walks are kept as (set of visited nodes, current node), which merges the walks that
    differ only in their order. An edge is settled by the first wave that closes it, or when its
    father turns out to dominate its son (no walk gets to the son without the father, so none
    closes it). A component is left as soon as all its edges are settled.
    """
    keys = [f"g{i}" for i in range(len(group))]
    rows = edges.filter(all_of([F.col(c).isNotNull() for c in [*group, father, son]])).select(
        *[F.col(g).alias(k) for g, k in zip(group, keys)],
        F.col(father).alias("father"),
        F.col(son).alias("son"),
        holds(roots).alias("is_root"),
    )
    pairs = rows.groupBy(*keys, "father", "son").agg(F.max("is_root").alias("is_root"))
    pairs, _ = materialize(pairs, "edges")
    # Edges above others; the leaves, the bulk of the graph, are done with here.
    above, _ = _trim(pairs, keys, ("son", "father"))
    links = above.select(*keys, "father", "son")
    starts = above.filter("is_root").select(*keys, "father", "son")
    first = starts.select(*keys, F.col("son").alias("node"), F.lit(None).cast("string").alias("ancestor")).distinct()
    first, _ = materialize(first, "starts")
    reach, core, rows_left = _reach_and_cycles(links, first, keys)
    if not rows_left:
        return core.limit(0).select(
            *[F.col(k).alias(g) for g, k in zip(group, keys)],
            F.col("father").alias(father),
            F.col("son").alias(son),
            F.lit(0).alias("level"),
            F.lit(True).alias("is_leaf"),
        )

    # A walk enters the core along a reached edge from outside, or by a root edge inside it. The
    # way from the root to such an edge shares no node with what can be reached behind it, or both
    # would belong to one component, so the walk inside the core need not know it.
    outside = not_exists_in(links, core, [*keys, "father", "son"])
    entry_by_edge = _join_node(outside, reach, keys, "father").select(
        *keys, F.col("son").alias("node"), (F.col("__depth") + 1).alias("depth")
    )
    root_outside = not_exists_in(starts, core, [*keys, "father", "son"]).select(
        *keys, F.col("son").alias("node"), F.lit(1).alias("depth")
    )
    entries = (
        entry_by_edge.union(root_outside).groupBy(*keys, "node").agg(F.min("depth").alias("depth"))
    )
    walk_from_entry = exists_in(
        entries, core, [*[(k, k) for k in keys], ("node", "father")]
    ).select(*keys, F.array("node").alias("seen"), F.col("node").alias("at"), "depth")

    root_inside = exists_in(starts, core, [*keys, "father", "son"])
    first_step = root_inside.filter("father != son").select(
        *keys,
        F.sort_array(F.array("father", "son")).alias("seen"),
        F.col("son").alias("at"),
        F.lit(1).alias("depth"),
    )
    closing = root_inside.filter("father = son").select(
        *keys, F.col("father").alias("closer"), "son", F.lit(1).alias("level"), F.lit(1).alias("length")
    )
    walks, _ = materialize(walk_from_entry.union(first_step), "first-walks")
    fathers = root_inside.select(*keys, F.col("father").alias("node"))
    begin = walks.filter("size(seen) = 1").select(*keys, F.col("at").alias("node"))
    starts_inside = begin.union(fathers).distinct()
    entered = exists_in(core, starts_inside, [*[(k, k) for k in keys], ("father", "node")])
    core = exists_in(core, entered, [*keys, "component"])
    ends = walks.select(*keys, F.col("at").alias("node")).union(starts_inside)
    core = _shortened(core, ends, keys)
    edge = [*keys, "closer", "son"]
    unsettled, open_edges = materialize(not_exists_in(core, closing, edge), "unsettled")
    found, tested = [closing], False
    onward, before, wave = 1, 0, 0
    while onward and open_edges:
        at = _merge_walks(walks, keys).select(
            *[F.col(k).alias(f"__{k}") for k in keys], "seen", F.col("at").alias("__at"), "depth"
        )
        inside = exists_in(core, unsettled, [*keys, "component"])
        step = inside.join(at, _same(keys, "father", "__at")).select(
            *keys,
            "closer",
            "son",
            "seen",
            "length",
            (F.col("depth") + F.col("length")).alias("depth"),
            F.array_contains("seen", F.col("son")).alias("closes"),
        )
        step, onward = materialize(step, "walks", ~F.col("closes"))
        found.append(
            step.filter("closes").select(*keys, "closer", "son", F.col("depth").alias("level"), "length")
        )
        walks = step.filter("NOT closes").select(
            *keys,
            F.sort_array(F.array_append("seen", F.col("son"))).alias("seen"),
            F.col("son").alias("at"),
            "depth",
        )
        wave += 1
        growing, before = onward > before, onward
        if not growing:  # the walks run out by themselves
            continue
        # Walks differ in depth, so an edge counts as settled once no walk is left that is short
        # enough to close it earlier.
        least = walks.agg(F.min("depth").alias("least")).scalar()
        closed_now = found[0].filter(F.lit(False))
        for part in found:
            closed_now = closed_now.union(part)
        done = closed_now.groupBy(*edge).agg(F.min("level").alias("level"), F.max("length").alias("length")).filter(
            F.coalesce(F.col("level") <= least + F.col("length"), F.lit(True))
        )
        unsettled, open_edges = materialize(not_exists_in(unsettled, done, edge), "unsettled")
        if open_edges and onward and wave >= WAVES_BEFORE_DOMINATORS and not tested:
            tested = True
            never = _dominated(core, starts_inside, unsettled, keys)
            unsettled, open_edges = materialize(not_exists_in(unsettled, never, edge), "unsettled")

    closed = found[0]
    for part in found[1:]:
        closed = closed.union(part)
    closed = closed.groupBy(*keys, F.col("closer").alias("father"), "son").agg(F.min("level").alias("level"))
    fan_out = pairs.groupBy(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("father").alias("__node")
    ).agg(F.count(F.lit(1)).alias("__out"))
    return closed.join(fan_out, _same(keys, "son", "__node"), "left").select(
        *[F.col(k).alias(g) for g, k in zip(group, keys)],
        F.col("father").alias(father),
        F.col("son").alias(son),
        F.col("level").cast("int").alias("level"),
        (F.coalesce(F.col("__out"), F.lit(0)) <= 1).alias("is_leaf"),
    )


def _dominated(
    core: DataFrame, starts: DataFrame, unsettled: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Edges whose son is reached from no start without passing the father."""
    avoided = unsettled.select(*keys, "component", F.col("father").alias("avoid")).distinct()
    inside = core.select(*keys, "component", F.col("father").alias("node")).distinct()
    seeds = exists_in(inside, starts, [*keys, "node"])
    first = avoided.join(seeds, [*keys, "component"]).filter("node != avoid").select(*keys, "avoid", "node")
    state_keys = [*keys, "avoid"]

    def advance(wave: DataFrame) -> DataFrame:
        above = _renamed(wave, keys, "node", "avoid")
        below = core.join(above, _same(keys, "father", "__node")).filter("son != __avoid")
        return below.select(*keys, F.col("__avoid").alias("avoid"), F.col("son").alias("node")).distinct()

    reached = _waves(first.distinct(), advance, state_keys, "avoiding")
    others = unsettled.filter("father != son")
    return not_exists_in(
        others, reached, [*[(k, k) for k in keys], ("father", "avoid"), ("son", "node")]
    )


def _merge_walks(walks: DataFrame, keys: Sequence[str]) -> DataFrame:
    return walks.groupBy(*keys, "seen", "at").agg(F.min("depth").alias("depth"))


def _join_node(edges: DataFrame, nodes: DataFrame, keys: Sequence[str], end: str) -> DataFrame:
    return edges.join(_renamed(nodes, keys, "node", "depth"), _same(keys, end, "__node"))


def delete_cycle_edges(
    edges: DataFrame, cycles: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Remove edges equal to a reported one on all the columns (null never equals)."""
    return not_exists_in(edges, cycles, list(columns))


def flagged_ancestor(
    edges: DataFrame,
    father: str,
    son: str,
    site: Sequence[str],
    label: Column,
    max_depth: int | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Nearest flagged ancestor of every node that has one.

    ``label`` is non-null on edges whose father is flagged and names the ancestor to report; ties
    give the smallest. Sons of such edges are starts, and everybody else's ancestor is that of the
    nearest start above (on a cycle a node may be its own ancestor); see :func:`_nearest`.
    ``wanted`` (one column of nodes) asks for those only: other leaves are cut first. ``max_depth``
    keeps the ancestors so near. Returns site columns, ``son``, ``ancestor`` and ``distance``.
    """
    keys = [f"g{i}" for i in range(len(site))]
    links = edges.select(
        *[F.col(s).alias(k) for s, k in zip(site, keys)],
        F.col(father).alias("father"),
        F.col(son).alias("son"),
        label.alias("ancestor"),
    ).filter(all_of([F.col(k).isNotNull() for k in keys] + [F.col("son").isNotNull()]))
    links, _ = materialize(links, "links")
    starts = (
        links.filter(F.col("ancestor").isNotNull())
        .groupBy(*keys, F.col("son").alias("node"))
        .agg(F.min("ancestor").alias("ancestor"))
    )
    asked = None if wanted is None else wanted.select(F.col(wanted.columns[0]).alias("node")).distinct()
    if max_depth == 1:
        settled = starts.withColumn("depth", F.lit(1))
    else:
        starts, _ = materialize(starts, "starts")
        ways = links.filter(F.col("father").isNotNull()).select(*keys, "father", "son")
        if asked is not None:
            useful = flag_exists(ways, ways, [*[(k, k) for k in keys], ("son", "father")], "__leads")
            useful = flag_exists(useful, asked, [("son", "node")], "__asked")
            ways = useful.filter("__leads OR __asked").drop("__leads", "__asked")
        settled = _nearest(ways, starts, keys)
        if max_depth is not None:
            settled = settled.filter(F.col("depth") <= max_depth)
    if asked is not None:
        settled = exists_in(settled, asked, ["node"])
    return settled.select(
        *[F.col(k).alias(s) for s, k in zip(site, keys)],
        F.col("node").alias(son),
        "ancestor",
        F.col("depth").alias("distance"),
    )


# --- self loops -----------------------------------------------------------------------------


def drop_self_loops(
    edges: DataFrame,
    group: Sequence[str],
    father: str,
    son: str,
    same: str = "father",
    only: Column | None = None,
) -> DataFrame:
    """Edges from a code to itself.

    If the group holds an edge that is no loop and has the same father (``same="son"``: the same
    son; or the same value in the column named), the loop is removed; otherwise its son becomes
    unknown. Groups are compared by plain equality, so a loop with a missing group code has no
    other edge. ``only`` restricts which loops are touched.
    """
    loop = F.col(father) == F.col(son)
    if only is not None:
        loop &= only
    loop = holds(loop)
    others = edges.filter(F.col(father) != F.col(son))
    shared = {"father": father, "son": son}.get(same, same)
    alone = not_exists_in(edges.filter(loop), others, [*group, shared])
    return edges.filter(~loop).unionByName(update_where(alone, F.lit(True), {son: F.lit(None)}))


# --- levels ---------------------------------------------------------------------------------


def bypass_level(
    edges: DataFrame,
    source: DataFrame,
    upper: Column,
    remove: Column | None = None,
    shape: Shape = BOM,
) -> DataFrame:
    """Skip a middle level: father to middle and middle to son give father to son.

    ``upper`` picks the edges of ``source`` that end at a middle node; they are joined to the
    edges below it by site code. Edges that the table already holds are not added again, where
    missing codes equal each other. ``remove`` deletes edges of the old table afterwards.
    """
    below = source.select(*[F.col(c).alias(f"__b_{c}") for c in source.columns])
    ident = [shape.site, shape.father, shape.father_site]
    above = source.filter(upper).select(*ident, F.col(shape.son_site).alias("__middle"))
    joined = above.join(
        below,
        (F.col(shape.site) == F.col(f"__b_{shape.site}"))
        & (F.col("__middle") == F.col(f"__b_{shape.father_site}")),
    )
    new = joined.select(
        *[F.col(c) if c in ident else F.col(f"__b_{c}").alias(c) for c in source.columns]
    )
    known = [shape.site, shape.father, shape.father_site, shape.son, shape.son_site]
    new = not_exists_in(new, edges, known, null_safe=True)
    kept = edges if remove is None else delete_where(edges, remove)
    return kept.unionByName(new, allowMissingColumns=True)


def insert_dummy_level(
    edges: DataFrame,
    source: DataFrame,
    ctx: RunContext,
    levels: Sequence[tuple[str, str]],
    flag: str | None = None,
    columns: tuple[str, ...] = ("from_odm", "item", "odm_pn", "odm_created_date", "create_time"),
    version: str = "version",
    shape: Shape = BOM,
) -> DataFrame:
    """Turn the newest mapping rows of some sites into edges from the item to its site code.

    ``levels`` are (site, item prefix) pairs. The newest version is that of the whole mapping
    feed. With ``flag`` the edges that carry it are replaced.
    """
    from_site, item, code, start, loaded = columns
    wanted = F.lit(False)
    for site, prefix in levels:
        wanted |= (F.col(from_site) == site) & F.col(item).startswith(prefix)
    newest = latest_version_global(source, F.substring(version, 1, 8)).filter(wanted)
    rows = keep_latest(newest, [from_site, item, code, start], [version])
    values = {
        shape.site: F.col(from_site),
        shape.father: F.col(item),
        shape.father_site: F.col(item),
        shape.son: F.col(code),
        shape.son_site: F.col(code),
        shape.quantity: F.lit(DUMMY_QUANTITY),
        shape.priority: F.lit("1"),
        shape.start: F.col(start),
        shape.end: F.to_date(F.lit(OPEN_END)),
        "src_created_at": F.col(loaded),
        shape.created_by: F.lit(f"{ctx.created_by}_LEVEL"),
        "created_at": F.col(loaded),
        "flag": F.lit(flag),
    }
    new = rows.select(*edges_with_nulls(edges, values))
    kept = edges if flag is None else delete_where(edges, F.col("flag") == flag)
    return kept.unionByName(new)


def clone_site(edges: DataFrame, site_column: str, source: object, target: object) -> DataFrame:
    """Copy all edges of a site under another site code."""
    copy = edges.filter(F.col(site_column) == source).withColumn(
        site_column, F.lit(target).cast(edges.schema[site_column].dataType)
    )
    return edges.unionByName(copy)


# --- rules on edges -------------------------------------------------------------------------


def drop_forbidden_edges(
    edges: DataFrame,
    forbidden: Column,
    allowed: Sequence[tuple[DataFrame, str]],
    father: Column,
    exceptions: tuple[DataFrame, str, Column] | None = None,
) -> DataFrame:
    """Remove forbidden edges unless their father is in one of the allowed code lists.

    ``exceptions`` is one more list with its own father code.
    """
    codes = None
    for table, column in allowed:
        part = table.select(F.col(column).alias("code"))
        codes = part if codes is None else codes.union(part)
    marked = edges.withColumn("__father", father)
    flagged = flag_exists(marked, codes, [("__father", "code")], "__allowed")
    free = F.col("__allowed")
    if exceptions is not None:
        table, column, code = exceptions
        flagged = flag_exists(flagged, table, [(code, column)], "__excepted")
        free |= F.col("__excepted")
    return delete_where(flagged, forbidden & ~free).drop("__father", "__allowed", "__excepted")


def drop_edges_to_both(
    edges: DataFrame, condition: Column, son: str, refs: Sequence[tuple[DataFrame, str]]
) -> DataFrame:
    """Remove edges that meet the condition and whose son is in every one of the lists."""
    hit = edges.filter(condition).select(F.col(son).alias("__code")).distinct()
    for table, column in refs:
        hit = exists_in(hit, table, [("__code", column)])
    flagged = flag_exists(edges, hit, [(son, "__code")], "__both")
    return delete_where(flagged, condition & F.col("__both")).drop("__both")


def drop_redundant_suffix_edges(
    edges: DataFrame,
    dim: DataFrame,
    dim_code: str,
    where: Column | None = None,
    site: str = "odm",
    father: str = "father_pn",
    son: str = "son_pn",
    length: int = 10,
) -> DataFrame:
    """Remove edges to a long code whose short form is the one that carries the structure.

    The long son has no edges of its own, its first ``length`` characters are a known component
    with edges in the same site, and that component is not nested into itself. The test depends on
    (site, son) only and is made once per distinct pair.
    """
    long_code = F.length(son) > length
    if where is not None:
        long_code &= where
    short = F.substring(son, 1, length)
    pairs = edges.filter(long_code).select(site, son).distinct().withColumn("__short", short)
    nested = edges.filter(F.substring(father, 1, length) == F.substring(son, 1, length))
    redundant = not_exists_in(pairs, edges, [site, (son, father)])
    redundant = exists_in(redundant, dim, [("__short", dim_code)])
    redundant = exists_in(redundant, edges, [site, ("__short", father)])
    redundant = not_exists_in(redundant, nested, [site, ("__short", father)])
    flagged = flag_exists(edges, redundant, [site, son], "__redundant")
    return delete_where(flagged, long_code & F.col("__redundant")).drop("__redundant")


def drop_variant_fathers(
    edges: DataFrame, site: str, father: str, father_site: str, mark: str = "$"
) -> DataFrame:
    """Remove edges of marked site fathers if the same father exists unmarked in the site."""
    is_variant = holds(F.contains(F.col(father_site), F.lit(mark)))
    plain = edges.filter(F.col(father_site).isNotNull() & ~is_variant)
    variants = not_exists_in(edges.filter(is_variant), plain, [site, father])
    return edges.filter(~is_variant).unionByName(variants)


def expand_compound_father(
    edges: DataFrame,
    ctx: RunContext,
    marks: Sequence[str] = ("SB20", "SBB"),
    code_length: int = 10,
    shape: Shape = BOM,
) -> DataFrame:
    """Two levels out of a compound father ``A_B`` that holds all the marks.

    One edge leads from B to A with quantity 1, the original edges then start at A. Validity is
    the hull of the merged rows. Returns the new edges only.
    """
    father = F.col(shape.father)
    cut = F.instr(father, "_")
    compound = cut > 0
    for mark in marks:
        compound &= F.contains(father, F.lit(mark))
    rows = edges.filter(compound).withColumns(
        {
            "__first": F.substring_index(father, "_", 1),
            "__second": F.substring(father, cut + 1, F.lit(code_length)),
        }
    )
    hull = [F.min(shape.start).alias(shape.start), F.max(shape.end).alias(shape.end)]
    top = rows.groupBy(shape.site, "__second", "__first", shape.group, shape.priority).agg(*hull)
    low = rows.groupBy(
        shape.site,
        "__first",
        shape.father_site,
        shape.son,
        shape.son_site,
        shape.quantity,
        shape.group,
        shape.priority,
    ).agg(*hull)
    common = {
        c: F.col(c) for c in (shape.site, shape.group, shape.priority, shape.start, shape.end)
    }
    common[shape.created_by] = F.lit(ctx.created_by)
    upper = {
        **common,
        shape.father: F.col("__second"),
        shape.father_site: F.col("__second"),
        shape.son: F.col("__first"),
        shape.son_site: F.col("__first"),
        shape.quantity: F.lit(1),
    }
    lower = {
        **common,
        shape.father: F.col("__first"),
        **{c: F.col(c) for c in (shape.father_site, shape.son, shape.son_site, shape.quantity)},
    }
    return top.select(*edges_with_nulls(edges, upper)).unionByName(
        low.select(*edges_with_nulls(edges, lower))
    )


def part_list(edges: DataFrame, site: str = "odm", father_site: str = "father_site_pn") -> DataFrame:
    return edges.select(site, father_site).distinct()


def null_child_by_dims(
    edges: DataFrame,
    condition: Column | None,
    child: str,
    sub_dim: DataFrame,
    sub_code: str,
    father: Column,
    father_dim: DataFrame,
    father_code: str,
) -> DataFrame:
    """Forget the child code where it is a sub-assembly and the father belongs to one class."""
    marked = flag_exists(edges, sub_dim, [(child, sub_code)], "__sub").withColumn("__f", father)
    marked = flag_exists(marked, father_dim, [("__f", father_code)], "__class")
    hit = F.col("__sub") & F.col("__class")
    if condition is not None:
        hit &= condition
    return update_where(marked, hit, {child: F.lit(None)}).drop("__sub", "__class", "__f")


def readmit_edges(
    edges: DataFrame,
    raw: DataFrame,
    orders: DataFrame,
    order_item: str,
    sub_dim: DataFrame,
    sub_code: str,
    father: str,
    child: str,
) -> DataFrame:
    """Put back raw edges from a father on an open order to a sub-assembly."""
    back = exists_in(exists_in(raw, orders, [(father, order_item)]), sub_dim, [(child, sub_code)])
    return edges.unionByName(back, allowMissingColumns=True)


def drop_by_allow_list(
    edges: DataFrame,
    condition: Column,
    component: DataFrame,
    component_code: str,
    sub_dim: DataFrame,
    sub_code: str,
    father: str,
    son: str,
    allow: DataFrame | None = None,
    allow_code: str = "code",
    son_else: Column | None = None,
) -> DataFrame:
    """Component-to-sub-assembly edges go unless the father is on the allow list.

    For listed fathers it is the other way round: the edges to anything else than a sub-assembly
    go, where ``son_else`` names the code to test. The lists follow the null rules of ``NOT IN``.
    """
    inside = edges.filter(holds(condition))
    outside = edges.filter(~holds(condition))
    hit = exists_in(inside, component, [(father, component_code)])
    hit = exists_in(hit, sub_dim, [(son, sub_code)])
    if allow is not None:
        hit = not_in(hit, father, allow, allow_code)
    hit = hit.select(father, son).distinct()
    kept = not_exists_in(inside, hit, [father, son])
    if allow is not None:
        tested = F.col(son) if son_else is None else son_else
        marked = kept.withColumn("__tested", tested)
        listed = exists_in(marked, allow, [(father, allow_code)])
        other = not_in(listed, "__tested", sub_dim, sub_code).select(father, "__tested").distinct()
        kept = not_exists_in(marked, other, [father, "__tested"]).drop("__tested")
    return outside.unionByName(kept)


def drop_fathers_in(
    edges: DataFrame, condition: Column, father: str, items: DataFrame, item: str
) -> DataFrame:
    """Remove edges that meet the condition and whose father is in the item list."""
    inside = not_exists_in(edges.filter(holds(condition)), items, [(father, item)])
    return edges.filter(~holds(condition)).unionByName(inside)


def exception_list(direct: DataFrame, derived: DataFrame) -> DataFrame:
    """Items allowed as fathers: those named directly and those derived from products."""
    return direct.union(derived).distinct()


# --- items with several site codes -------------------------------------------------------------


def prefer_prefix_mapping(
    edges: DataFrame,
    mapping: DataFrame,
    in_stock: DataFrame,
    condition: Column,
    item_prefix: str,
    code_prefix: str,
    blank_son: bool = False,
    shape: Shape = BOM,
) -> DataFrame:
    """Prefer site codes of one prefix where an item maps to several.

    If the item has a code with the preferred prefix and is in stock, its other codes lose the
    item: on the edges they start, then on the edges that lead to them (there too the father item
    is blanked; ``blank_son`` blanks the son item instead).
    """
    site, item, code = shape.site, shape.father, shape.father_site
    preferred = mapping.filter(F.col(code).startswith(code_prefix))
    others = mapping.filter(
        F.col(item).startswith(item_prefix) & ~F.col(code).startswith(code_prefix)
    )
    others = exists_in(exists_in(others, preferred, [site, item]), in_stock, [site, item])
    others = others.select(F.col(item).alias("__item"), F.col(code).alias("__code")).distinct()
    first = flag_exists(edges, others, [(item, "__item"), (code, "__code")], "__other")
    first = update_where(first, F.col("__other") & condition, {item: F.lit(None)}).drop("__other")
    second = flag_exists(
        first, others, [(shape.son, "__item"), (shape.son_site, "__code")], "__other"
    )
    blanked = shape.son if blank_son else item
    return update_where(second, F.col("__other") & condition, {blanked: F.lit(None)}).drop("__other")


def split_multi_mapped_father(
    edges: DataFrame,
    ctx: RunContext,
    own: Column,
    mapping: DataFrame | None = None,
    shape: Shape = BOM,
) -> DataFrame:
    """Give every site code of a multiply mapped item its own level.

    ``own`` picks the edges that define the mapping, unless it is given. (a) Dummy edges lead from the item to each of
    its site codes; (b) the own edges then start at the site code; (c) sons that map ambiguously
    and have edges of their own lose their item code.
    """
    site, father, father_site = shape.site, shape.father, shape.father_site
    current = own & (F.col(shape.end) >= F.lit(ctx.plan_version))
    if mapping is None:
        mapping = multi_mapped(edges.filter(current), site, father, father_site)

    dummies = mapping.select(
        *edges_with_nulls(
            edges,
            {
                site: F.col(site),
                father: F.col(father),
                shape.son: F.col(father_site),
                shape.son_site: F.col(father_site),
                shape.quantity: F.lit(DUMMY_QUANTITY),
                shape.group: F.lit(DUMMY_GROUP),
                shape.priority: F.lit(DUMMY_PRIORITY),
                shape.start: F.to_date(F.lit(DUMMY_START)),
                shape.end: F.to_date(F.lit(OPEN_END)),
                "src_created_at": F.lit(ctx.run_ts),
                shape.created_by: F.lit("BOM_ADJUST_INSERT"),
                "created_at": F.lit(ctx.run_ts),
            },
        )
    )
    marked = flag_exists(edges, mapping, [site, father, father_site], "__multi")
    renamed = update_where(
        marked,
        F.col("__multi") & own,
        {father: F.col(father_site), shape.created_by: F.lit("BOM_ADJUST_UPDATE")},
    ).drop("__multi")

    sons = mapping.select(
        F.col(site).alias("__s"), F.col(father).alias("__i"), F.col(father_site).alias("__c")
    )
    with_edges = exists_in(sons, edges, [("__s", site), ("__c", father_site)])
    marked = flag_exists(
        renamed, with_edges, [(site, "__s"), (shape.son, "__i"), (shape.son_site, "__c")], "__amb"
    )
    ambiguous = F.col("__amb") & (F.col(shape.son) != F.col(shape.son_site))
    fixed = update_where(
        marked,
        ambiguous,
        {
            shape.created_by: join_text(shape.created_by, F.lit("_FIX")),
            shape.son: F.lit(None),
        },
    ).drop("__amb")
    return fixed.unionByName(dummies)
