"""Strongly connected components of a state graph, and values solved component by component.

A graph's edges are tallies (node, stm, move, child, bucket, n, ww, d); a link is a real move to a node of the graph.
Components are found by trimming (what has no link in or none out is alone) and colouring: every node takes the smallest
node that reaches it, and a colour's first node has as its component what reaches it within the colour. Then that goes,
only links within one colour stay, and the rest is coloured again. All of it is joins whose link table shrinks.

Solving goes by layers of the graph of components, from those without a way out upwards, so every value is computed from
settled ones. A single node takes one backup. Within the other components of a layer, a node is backed up again only if a
child of it has moved by the tolerance or more since it last told its value; a component that does not settle keeps its
picks from its own sweep `freeze_after` on. A band of a component is settled within one task if it has few enough rows.

Values after a given number of backups of the whole graph are no fixed point, so there a layer is computed from its
children's values after every sweep instead: their courses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.functions.constants import FREEZE_AFTER, MOST_SWEEPS, SETTLED
from arbora.operators.graph import TOGETHER, VALUES, around, keeping, step, valued, weighed
from arbora.operators import settling
from arbora.operators.settling import courses, settle, sized
from arbora.operators.tally import add
from arbora.plans.tables import discard, stored


def links(edges: DataFrame) -> DataFrame:
    """(node, child) of the real moves between nodes of the graph, without loops."""
    steps = edges.where(R.is_real(F.col("move")) & F.col("child").isNotNull() & (F.col("node") != F.col("child"))).select("node", "child").distinct()
    return steps.join(edges.select(F.col("node").alias("child")).distinct(), "child", "left_semi").select("node", "child")


def _trimmed(steps: DataFrame) -> DataFrame:
    """Links of which each end has links both in and out, until that holds for all."""
    many = steps.count()
    while many:
        ins, outs = steps.select(F.col("child").alias("node")).distinct(), steps.select(F.col("node").alias("child")).distinct()
        fewer = stored(steps.join(ins, "node", "left_semi").join(outs, "child", "left_semi").select("node", "child"), "trimmed")
        discard(steps)
        steps, before = fewer, many
        many = steps.count()
        if many == before:
            break
    return steps


def _coloured(steps: DataFrame) -> DataFrame:
    """(node, colour): the smallest node that reaches each; only nodes whose colour has changed pass it on."""
    colour = stored(steps.select("node").union(steps.select("child")).distinct().withColumn("colour", F.col("node")), "colour")
    moved = colour
    while True:
        told = steps.join(moved, "node").groupBy(F.col("child").alias("node")).agg(F.min("colour").alias("told"))
        both = stored(colour.join(told, "node", "left").select("node", F.least("colour", "told").alias("colour"), (F.col("told") < F.col("colour")).alias("moved")), "colour")
        discard(colour)
        colour, moved = both.select("node", "colour"), both.where("moved").select("node", "colour")
        if moved.isEmpty():
            out = stored(colour, "coloured")
            discard(both)
            return out
        colour = stored(colour, "colour")
        moved = stored(moved, "moved")
        discard(both)


def _reaching(steps: DataFrame, colour: DataFrame) -> DataFrame:
    """(node, component): what reaches the first node of its colour along links of that colour."""
    seen = stored(colour.where("node = colour").select("node", F.col("colour").alias("component")), "reaching")
    edge = seen
    while True:
        new = steps.join(edge.select(F.col("node").alias("child"), "component"), "child").select("node", "component").distinct()
        edge = stored(new.join(seen.select("node"), "node", "left_anti"), "reached")
        if edge.isEmpty():
            return seen
        more = stored(seen.union(edge), "reaching")
        discard(seen)
        seen = more


def strong_components(edges: DataFrame) -> DataFrame:
    """(node, component, size) of every node of the graph; a component is named after its smallest node."""
    steps, found = stored(links(edges), "links"), []
    while True:
        steps = _trimmed(steps)
        if steps.isEmpty():
            break
        colour = _coloured(steps)
        of = lambda c: colour.select(F.col("node").alias(c), F.col("colour").alias(f"{c}_colour"))
        same = stored(steps.join(of("node"), "node").join(of("child"), "child").where("node_colour = child_colour").select("node", "child"), "links")
        discard(steps)
        own = _reaching(same, colour)
        found.append(own)
        steps = stored(same.join(own.select("node"), "node", "left_anti").join(own.select(F.col("node").alias("child")), "child", "left_anti").select("node", "child"), "links")
        discard(same, colour)
    nodes = edges.select("node").distinct()
    if not found:
        return nodes.select("node", F.col("node").alias("component"), F.lit(1).cast("long").alias("size"))
    known = found[0]
    for more in found[1:]:
        known = known.union(more)
    rows = nodes.join(known, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return rows.join(rows.groupBy("component").agg(F.count("*").alias("size")), "component").select("node", "component", "size")


def condensed(edges: DataFrame, components: DataFrame) -> DataFrame:
    """(component, to): links between different components."""
    of = lambda c, name: components.select(F.col("node").alias(c), F.col("component").alias(name))
    rows = links(edges).join(of("node", "component"), "node").join(of("child", "to"), "child")
    return rows.where("component <> `to`").select("component", "to").distinct()


def layers(edges: DataFrame, components: DataFrame) -> DataFrame:
    """(component, layer): 0 where no link leads out, else one more than the highest layer that a link leads to."""
    steps = stored(condensed(edges, components), "condensed")
    rest, found, layer = stored(components.select("component").distinct(), "rest"), None, 0
    while not rest.isEmpty():
        open_ = steps.select("component").distinct()
        now = rest.join(open_, "component", "left_anti").withColumn("layer", F.lit(layer))
        before, found = found, stored(now if found is None else found.union(now), "layers")
        discard(before)
        more = stored(rest.join(open_, "component", "left_semi"), "rest")
        left = stored(steps.join(found.select(F.col("component").alias("to")), "to", "left_anti").select("component", "to"), "condensed")
        discard(rest, steps)
        rest, steps, layer = more, left, layer + 1
    discard(rest, steps)
    return found if found is not None else components.select("component", F.lit(0).alias("layer")).where("false")


def _together(tables: list[DataFrame]) -> DataFrame | None:
    """The union of all; of many, they become one table."""
    out = None
    for x in tables:
        out = x if out is None else out.unionByName(x)
    if len(tables) >= 12:
        tables[:] = [out := stored(out, "together")]
    return out


def swept(rows: DataFrame, values: DataFrame | None) -> DataFrame:
    """backup() of rows of weighed(), once, from the values of their children."""
    if values is None:
        met = rows.withColumns({"eval_w": F.lit(None).cast("double"), "eval_b": F.lit(None).cast("double")})
    else:
        met = rows.join(values.select(F.col("node").alias("child"), "bucket", "eval_w", "eval_b"), ["child", "bucket"], "left")
    x = lambda c: F.when(F.col("resolved"), F.col(c)).otherwise(F.col("edge"))
    met = met.withColumns({"x_w": x("eval_w"), "x_b": x("eval_b")})
    moves = F.collect_list(F.when(F.col("real"), F.struct("move", F.when(F.col("stm") == "w", F.col("x_w")).otherwise(F.col("x_b")).alias("value"), "prior", "evidence", "strength", "sd")))
    sums = [(F.sum(F.col("n") * F.col(f"x_{c}")) / F.sum("n")).alias(f"chance_{c}") for c in "wb"]
    out = met.groupBy("node", "stm", "bucket").agg(F.first("own").alias("own"), *sums, moves.alias("moves"))
    return valued(out).select(VALUES)


def _iterated(rows: DataFrame, mine: DataFrame, inner: DataFrame, before: DataFrame | None, tolerance: float, freeze_after: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(values with component, sweeps and backups, components whose picks were kept) of the cyclic components of a layer.

    rows: weighed edges. mine: (node, component). inner: (node, child) within a component. Small bands of components are
    settled within a task each, the others by joins.
    """
    part = ["component", "bucket"]
    rows = stored(around(rows, inner, before).join(mine, "node"), "around")
    size = stored(sized(rows, part), "sized")
    found = stored(settle(rows.join(size.where("small"), part, "left_semi"), part, tolerance, freeze_after, most, True), "settled")
    if not found.where("moved").isEmpty():
        raise RuntimeError(f"components have not settled after {most} sweeps, {found.where('moved').count()} values of them still move")
    told, late = found.drop("moved", "frozen"), found.where("frozen").select("component").distinct()
    if not size.where("not small").isEmpty():
        more, late_ = _joined(rows.join(size.where("not small"), part, "left_semi").select(rows.columns), tolerance, freeze_after, most)
        told = told.unionByName(more.select(told.columns))
        late = late if late_ is None else late.union(late_).distinct()
    discard(rows, size)
    return told, late


def _joined(rows: DataFrame, tolerance: float, freeze_after: int, most: int) -> tuple[DataFrame, DataFrame | None]:
    """_iterated() of rows of around() by joins. TOGETHER sweeps are one job; after it, what has settled takes no more part."""
    rows = stored(rows, "around")
    start = {"best_move": F.lit(None).cast(rows.schema["move"].dataType), "eval_w": F.lit(0.5), "eval_b": F.lit(0.5), "sweeps": F.lit(0), "backups": F.lit(0).cast("long"), "moved": F.lit(True)}
    told = stored(rows.where("self").select("node", "stm", "bucket", "component").withColumns(start), "told")
    still, late, sweep = [], None, 0
    while True:
        if sweep >= most:
            raise RuntimeError(f"components have not settled after {most} sweeps, {told.where('moved').count()} values of them still move")
        until = min([most, sweep + TOGETHER] + ([freeze_after] if sweep < freeze_after else []))
        new = told
        for k in range(sweep + 1, until + 1):
            hit = F.lit(True) if k == 1 else F.coalesce("asked", F.lit(False))
            far = F.greatest(*(F.abs(F.col(c) - F.col(f"old.{c}")) for c in ("eval_w", "eval_b")))
            moved = F.col("hit") & (far >= tolerance)
            now = lambda when, c: F.when(F.col(when), F.col(c)).otherwise(F.col(f"old.{c}")).alias(c)
            new = step(rows, new).withColumn("hit", hit).withColumn("moved", moved)
            new = new.select("node", "stm", "bucket", F.col("old.component").alias("component"), now("hit", "best_move"), now("moved", "eval_w"), now("moved", "eval_b"), F.when(F.col("hit"), k).otherwise(F.col("old.sweeps")).alias("sweeps"), (F.col("old.backups") + F.col("hit").cast("long")).alias("backups"), "moved")
        new, old, sweep = stored(new, "told"), told, until
        discard(old)
        restless = stored(new.where("moved").select("component").distinct(), "restless")
        if restless.isEmpty():
            still.append(new)
            return _together(still).drop("moved"), late
        still.append(stored(new.join(restless, "component", "left_anti").select(new.columns), "still"))
        told = stored(new.join(restless, "component", "left_semi").select(new.columns), "told")
        discard(new)
        _together(still)
        if sweep == freeze_after:  # what has settled is not asked for again, so it keeps its values
            rows, before_ = stored(keeping(rows, told), "around"), rows
            discard(before_)
            late = restless


def solve_by_component(edges: DataFrame, tolerance: float = SETTLED, freeze_after: int = FREEZE_AFTER, most: int = MOST_SWEEPS, known: DataFrame | None = None, within: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(values as backup() gives them, census) of the graph's fixed point.

    census: (component, size, layer, sweeps, backups, frozen) by component, with the rows of node and band that were
    backed up. known: values (node, stm, bucket, best_move, eval_w, eval_b) of nodes outside `within`, which are taken as
    they are; then only the nodes of `within` are solved, and both come back. A component that still moves after `most`
    sweeps raises.
    """
    own = edges if within is None else edges.join(within.select("node").distinct(), "node", "left_semi").select(edges.columns)
    own = stored(own, "own")
    rows = weighed(edges) if within is None else weighed(edges).join(within.select("node").distinct(), "node", "left_semi")
    rows = stored(rows, "weighed")
    parts = stored(strong_components(own), "components")
    order = layers(own, parts)
    steps = stored(links(own).unionByName(own.where("node = child").select("node", "child").distinct()), "links")
    loops = steps.where("node = child").select("node").withColumn("loops", F.lit(True))
    placed = stored(parts.join(order, "component").join(loops, "node", "left").select("node", "component", "size", "layer", ((F.col("size") > 1) | F.coalesce("loops", F.lit(False))).alias("cyclic")), "placed")
    kinds = {(r["layer"], r["cyclic"]) for r in placed.select("layer", "cyclic").distinct().collect()}
    settled = [] if known is None else [known.join(placed.select("node"), "node", "left_anti").select(VALUES)]
    census = []
    facts = ["component", "size", "layer", "sweeps", "backups", "frozen"]
    for layer in sorted({k for k, _ in kinds}):
        here = placed.where(F.col("layer") == layer)
        before, found = _together(settled), []
        if (layer, False) in kinds:
            mine = here.where("not cyclic")
            found.append(stored(swept(rows.join(mine.select("node"), "node", "left_semi"), before), "single"))
            census.append(found[0].groupBy("node").agg(F.count("*").alias("backups")).join(mine, "node").withColumns({"sweeps": F.lit(1), "frozen": F.lit(False)}).select(facts))
        if (layer, True) in kinds:
            mine = here.where("cyclic").select("node", "component")
            inner = stored(steps.join(mine, "node").join(mine.select(F.col("node").alias("child"), F.col("component").alias("to")), "child").where("component = to").select("node", "child"), "inner")
            told, late = _iterated(rows.join(mine.select("node"), "node", "left_semi"), mine, inner, before, tolerance, freeze_after, most)
            found.append(told.select(VALUES))
            sizes = here.where("cyclic").select("component", "size", "layer").distinct()
            own_facts = told.groupBy("component").agg(F.max("sweeps").alias("sweeps"), F.sum("backups").alias("backups")).join(sizes, "component")
            own_facts = own_facts.join(late.withColumn("late", F.lit(True)), "component", "left")
            census.append(own_facts.withColumn("frozen", F.coalesce("late", F.lit(False))).select(facts))
            discard(inner)
        settled += found
    found = _together(settled)
    if found is None:
        found = swept(rows, None)  # of no rows
    counted = _together(census)
    if counted is None:
        counted = edges.sparkSession.createDataFrame([], "component string, size long, layer int, sweeps int, backups long, frozen boolean")
    return found, counted


def _followed(rows: DataFrame, most: int) -> DataFrame:
    """courses() by joins. TOGETHER sweeps are one job; each job's values are a piece of the courses."""
    told = stored(rows.where("self").select("node", "stm", "bucket", F.lit(None).cast(rows.schema["move"].dataType).alias("best_move"), F.lit(0.5).alias("eval_w"), F.lit(0.5).alias("eval_b")), "told")
    none = {f"course_{c}": F.array().cast("array<double>") for c in "wb"}
    pieces, done = [], 0
    while done < most:
        until, new = min(most, done + TOGETHER), told.select(VALUES).withColumns(none)
        for k in range(done + 1, until + 1):
            of = lambda c: F.lit(0.5) if k == 1 else F.element_at(c, F.least(F.lit(k - 1), F.size(c)))  # noqa: B023, E731
            now = rows.withColumns({f"x_{c}": F.when(F.col(f"course_{c}").isNull(), F.col(f"x_{c}")).otherwise(of(f"course_{c}")) for c in "wb"})
            new = step(now, new).select(*VALUES, *(F.array_append(f"old.course_{c}", F.col(f"eval_{c}")).alias(f"course_{c}") for c in "wb"))
        told, done = stored(new, "told"), until
        pieces.append(told.select("node", "stm", "bucket", F.lit(done).alias("piece"), "best_move", "course_w", "course_b"))
    all_ = pieces[0]
    for x in pieces[1:]:
        all_ = all_.unionByName(x)
    whole = [F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", f"course_{c}"))), lambda x, c=c: x[f"course_{c}"])).alias(f"course_{c}") for c in "wb"]
    return all_.groupBy("node", "stm", "bucket").agg(F.max_by("best_move", "piece").alias("best_move"), *whole)


def backups_by_component(edges: DataFrame, most: int) -> DataFrame:
    """backup() of the whole graph from 0.5, so many times (at least once), with all components of a layer at a time.

    A node's value after sweep k hangs on its children's after sweep k - 1, so it takes the children's values of all sweeps,
    not only the last ones. Bands of a component, and single nodes of a layer in groups, are swept within a task each if
    they have few enough rows, and by joins otherwise.
    """
    rows = stored(weighed(edges), "weighed")
    parts = stored(strong_components(edges), "components")
    steps = stored(links(edges).unionByName(edges.where("node = child").select("node", "child").distinct()), "links")
    placed = stored(parts.join(layers(edges, parts), "component").select("node", "component", "size", "layer"), "placed")
    single = F.col("size") == 1
    many = {r["layer"]: r["n"] for r in rows.join(placed.where(single), "node").groupBy("layer").agg(F.count("*").alias("n")).collect()}
    known, part = [], ["part", "bucket"]
    for (layer,) in sorted(placed.select("layer").distinct().collect()):
        groups = -(-4 * many.get(layer, 1) // max(settling.MOST_ROWS, 4))
        mine = placed.where(F.col("layer") == layer).select("node", "component", F.when(single, F.concat(F.lit("#"), F.pmod(F.xxhash64("node"), F.lit(groups)).cast("string"))).otherwise(F.concat(F.lit("="), F.col("component").cast("string"))).alias("part"))
        inner = steps.join(mine.select("node", "component"), "node").join(mine.select(F.col("node").alias("child"), F.col("component").alias("to")), "child").where("component = to").select("node", "child")
        own, before = rows.join(mine.select("node"), "node", "left_semi"), _together(known)
        if before is None:
            own = own.withColumns({f"course_{c}": F.lit(None).cast("array<double>") for c in "wb"})
        else:
            own = own.join(before.select(F.col("node").alias("child"), "bucket", *(F.col(f"course_{c}").alias(f"known_{c}") for c in "wb")), ["child", "bucket"], "left")
            own = own.withColumns({f"course_{c}": F.when(F.col("resolved"), F.col(f"known_{c}")) for c in "wb"})
        own = stored(around(own, stored(inner, "inner"), None, ("course_w", "course_b")).join(mine.select("node", "part"), "node"), "around")
        size = stored(sized(own, part), "sized")
        found = courses(own.join(size.where("small"), part, "left_semi"), part, most)
        if not size.where("not small").isEmpty():
            found = found.unionByName(_followed(stored(own.join(size.where("not small"), part, "left_semi").drop("part"), "large"), most))
        known.append(stored(found, "courses"))
        discard(own, size)
    found = _together(known)
    if found is None:
        return swept(rows, None)  # of no rows
    return found.select("node", "stm", "bucket", "best_move", *(F.element_at(f"course_{c}", -1).alias(f"eval_{c}") for c in "wb"))


def census_totals(census: DataFrame) -> DataFrame:
    """(components, cyclic, largest, slowest, backups, frozen) over all components."""
    return census.agg(F.count("*").alias("components"), F.count_if(F.col("size") > 1).alias("cyclic"), F.max("size").alias("largest"), F.max("sweeps").alias("slowest"), F.sum("backups").alias("backups"), F.count_if("frozen").alias("frozen"))


def cone(edges: DataFrame, changed: DataFrame) -> DataFrame:
    """(node): the changed nodes and all that reaches them, whose values may be different now."""
    steps = stored(links(edges), "links")
    seen = stored(changed.select("node").distinct().join(edges.select("node").distinct(), "node", "left_semi"), "cone")
    edge = seen
    while not edge.isEmpty():
        edge = stored(steps.join(edge.select(F.col("node").alias("child")), "child").select("node").distinct().join(seen, "node", "left_anti"), "parents")
        more = stored(seen.union(edge), "cone")
        discard(seen)
        seen = more
    return seen


def add_month(edges: DataFrame, values: DataFrame, delta: DataFrame, tolerance: float = SETTLED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges with the counts of delta, their values, census of what was solved again).

    values: of edges. A node's value hangs on its own counts, on its children's counts and values, and on nothing else, so
    only the changed nodes and what reaches them is solved; its size is that of the census.
    """
    new = stored(add(edges, delta), "edges")
    found, census = solve_by_component(new, tolerance, known=values, within=cone(new, delta))
    return new, found, census
