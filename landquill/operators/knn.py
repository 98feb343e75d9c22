"""Nearest-neighbour joins in the plane or on the ellipsoid, and what is computed from them."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from landquill.functions.geo import with_geodesic
from landquill.shared import checkpointed

#: The kinds of land use that make a family.
FAMILIES = {
    "工業系": ("工業", "工専", "準工"),
    "商業系": ("商業", "近商"),
    "住居系": ("1低専", "2低専", "1中専", "2中専", "1住居", "2住居", "準住居"),
}
#: Pairs, and points, up to which all points are broadcast and compared with all queries of their scope.
BROADCAST_PAIRS, BROADCAST_POINTS = 2_000_000, 50_000
#: Points of a leaf at least, queries of a group and of a part of it, children of a node, nodes at the top at most, nodes beyond which a group goes on as single queries,
#: rows up to which a level of the tree or the nodes that queries still have are broadcast, nodes up to which a level is held in every task, neighbouring ones of these
#: that are first met as one, and distances that a task computes at once.
LEAF, GROUP, PART, FAN, TOP, SPLIT, BROADCAST_NODES, HELD_NODES, BLOCK, DISTANCES = 32, 2048, 32, 16, 128, 2048, 20_000, 1 << 16, 256, 1 << 20
#: Bits of a place along either side of a square of the curve, and squares strung together at most; a place on the curve has 62 bits.
_BITS, _SQUARES = 25, 1 << 12


def with_scopes(points: DataFrame, kind: str = "kind", families: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Each point once for every scope that it belongs to: '' (all), its kind, its family; the column is ``scope``."""
    family = None
    for name, kinds in (families or FAMILIES).items():
        rule = F.col(kind).isin(*kinds)
        family = F.when(rule, name) if family is None else family.when(rule, name)
    scopes = F.array_compact(F.array(F.lit(""), F.nullif(F.col(kind), F.lit("")), family))
    return points.withColumn("scope", F.explode(scopes))


def known_scope(queries: DataFrame, scoped: DataFrame | PointTree, wanted: str) -> DataFrame:
    """``scope``: the wanted one if any point has it, else '' for all points."""
    scopes = scoped.lowest.select(F.col("nscope").alias("_known")) if isinstance(scoped, PointTree) else scoped.filter(_finite("x") & _finite("y")).select(F.col("scope").alias("_known"))
    known = scopes.distinct()  # one row for each kind and family
    return queries.join(F.broadcast(known), F.col(wanted) == F.col("_known"), "left").withColumn("scope", F.coalesce("_known", F.lit(""))).drop("_known")


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    """The k best pairs of each query; the rank's bound also limits what each task passes on to the shuffle."""
    by = Window.partitionBy("_q").orderBy("dist_m", "point_id")
    return pairs.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def _kept(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict[str, object]]:
    """df, its lineage cut, and what was observed meanwhile."""
    seen = Observation()
    return checkpointed(df.observe(seen, *[c.alias(name) for name, c in metrics.items()])), seen.get


def _extent(x: str, y: str) -> dict[str, Column]:
    return {"n": F.count(F.lit(1)), "x0": F.min(x), "x1": F.max(x), "y0": F.min(y), "y1": F.max(y)}


@F.pandas_udf(T.LongType())
def _curve(x: pd.Series, y: pd.Series) -> pd.Series:
    """The place on Hilbert's curve of whole numbers, y below 2^_BITS: unlike other curves it has no leaps, so the box of a run of neighbours on it stays small.

    It ends beside the square that comes next along x, where the curve of that one begins.
    """
    a, b, place = x.to_numpy() & (1 << _BITS) - 1, y.to_numpy(), x.to_numpy() >> _BITS
    for bit in range(_BITS - 1, -1, -1):
        right, upper = a >> bit & 1, b >> bit & 1
        place = place << 2 | (3 * right ^ upper)
        turned = -(right & (1 - upper)) & ((1 << _BITS) - 1)
        a, b = np.where(upper, a, b ^ turned), np.where(upper, b, a ^ turned)
    return pd.Series(place)


def _packed(rows: DataFrame, box: dict[str, object], scope: str, x: str, y: str, last: str, size: int) -> tuple[DataFrame, int]:
    """rows with ``_node``, the number of a run of up to ``size`` neighbours on a space-filling curve, ``_p``, a number of its own, and a bound of the nodes' numbers.

    The curve runs through squares strung along the longer side of the box and stretched to fill it: where it left the box and
    came back elsewhere, a run would have a wide box. Rows are dealt into ranges along the curve and numbered inside each range, so that no task
    sees all of them; a node's number over any whole number is that of a node higher up.
    """
    sides = {c: max(box[high] - box[low], 1e-9) if box["n"] else 1.0 for c, low, high in ((x, "x0", "x1"), (y, "y0", "y1"))}
    along, across = (x, y) if sides[x] >= sides[y] else (y, x)
    height = max(sides[across], sides[along] / _SQUARES)
    squares = round(max(1.0, sides[along] / height))
    lows, size_of = {x: box["x0"] or 0.0, y: box["y0"] or 0.0}, {along: sides[along] / squares, across: height}

    def bits(c: str, n: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit((n << _BITS) - 1), F.floor((F.col(c) - lows[c]) / size_of[c] * (1 << _BITS)).cast("long"))).cast("long")

    order = [F.col(scope), F.col("_z"), F.col(x), F.col(y), F.col(last)]
    dealt = rows.withColumn("_z", _curve(bits(along, squares), bits(across, 1))).repartitionByRange(*order).withColumn("_range", F.spark_partition_id().cast("long"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    numbered, seen = _kept(dealt.withColumn("_inside", inside.cast("long")).withColumn("_p", F.monotonically_increasing_id()), most=F.max("_inside"), last=F.max("_range"))
    width = (seen["most"] or 0) // size + 1  # nodes of a range
    return numbered.withColumn("_node", F.col("_range") * width + F.floor(F.col("_inside") / size)).drop("_z", "_range", "_inside"), ((seen["last"] or 0) + 1) * width


def _boxes(rows: DataFrame, *keys: Column, x: tuple[str, str], y: tuple[str, str], n: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(n.alias("n"), F.min(x[0]).alias("x0"), F.max(x[1]).alias("x1"), F.min(y[0]).alias("y0"), F.max(y[1]).alias("y1"))


class PointTree(NamedTuple):
    """Points made ready for searches of up to ``k`` neighbours: their rows with nodes, the lowest nodes' boxes, and their numbers."""

    rows: DataFrame
    lowest: DataFrame
    leaves: int
    n: int
    k: int
    more: list[str]


def _held(points: DataFrame, k: int) -> tuple[DataFrame, dict[str, object], list[str]]:
    """(point_id, px, py, pscope and more columns of the points that can be among k nearest, their extent, the names of more columns)."""
    more = [c for c in points.columns if c not in ("point_id", "x", "y", "scope")]
    held = points.filter(_finite("x") & _finite("y")).select("point_id", F.col("x").cast("double").alias("px"), F.col("y").cast("double").alias("py"), F.col("scope").alias("pscope"), *more)
    first = F.row_number().over(Window.partitionBy("pscope", "px", "py").orderBy("point_id"))
    return *_kept(held.withColumn("_n", first).filter(F.col("_n") <= k).drop("_n"), **_extent("px", "py")), more


def _finite(c: str) -> Column:
    return F.coalesce(F.abs(F.col(c).cast("double")) < F.lit(float("inf")), F.lit(False))


def _tree(held: DataFrame, box: dict[str, object], k: int, more: list[str]) -> PointTree:
    rows, leaves = _packed(held, box, "pscope", "px", "py", "point_id", max(LEAF, 2 * k))
    lowest = checkpointed(_boxes(rows, F.col("pscope").alias("nscope"), F.col("_node"), x=("px", "px"), y=("py", "py"), n=F.count(F.lit(1))))
    return PointTree(rows, lowest, leaves, box["n"], k, more)


def point_tree(points: DataFrame, k: int) -> PointTree:
    """points (point_id, x, y, scope, and more columns) for several searches; see ``knn_join``."""
    held, box, more = _held(points, k)
    return _tree(held, box, k, more)


def _few(df: DataFrame, rows: int | None) -> DataFrame:
    """df to be broadcast if it has few rows, else surely not: a compressed shuffle that looks small may be large in the driver's memory."""
    return F.broadcast(df) if (rows or 0) <= BROADCAST_NODES else df.hint("shuffle_merge")


def met_pairs(spots: DataFrame, points: PointTree, k: int, slack: float | None = None) -> DataFrame:
    """_q, rank, dist_m, point_id and more columns of the k nearest points, or with ``slack`` of all points within so much of the kth (rank 0).

    spots: _q, x, y, scope. Points are a tree of packed
    nodes with their number and box, queries make groups with a box. A group first meets the lowest level of at most HELD_NODES nodes, which every task
    holds, so that nothing is shuffled above it; below it, level by level, the
    children of the nodes it still has: of the nodes with k points the one whose farthest corner is nearest surely holds enough, and
    nodes that are farther than it from wherever in the group's box a query lies are left behind. A group that keeps many nodes, since it is
    wide, goes on as single queries. Only the leaves that remain are
    compared, wherever the queries lie and however few points a scope has. A group meets all its points in one task, which ranks them, so
    that a query is in two shuffles and no pair in any.
    """
    tree, lowest, leaves, columns = points.rows, points.lowest, points.leaves, ["point_id", *points.more]
    box = spots.agg(*[c.alias(name) for name, c in _extent("x", "y").items()]).first().asDict()
    asked = _packed(spots, box, "scope", "x", "y", "_q", GROUP)[0].withColumnRenamed("_node", "_group")
    groups, seen = _kept(asked.groupBy(F.col("scope").alias("gscope"), "_group").agg(F.min("x").alias("a0"), F.max("x").alias("a1"), F.min("y").alias("b0"), F.max("y").alias("b1")), n=F.count(F.lit(1)))
    top = 0
    while leaves > TOP * FAN**top:
        top += 1
    scopes, seen_scopes = _kept(groups.select(F.col("gscope").alias("nscope")).distinct(), n=F.count(F.lit(1)))
    lowest = lowest.join(_few(scopes, seen_scopes["n"]), "nscope", "left_semi")
    counts = lowest.agg(*[F.count_distinct("nscope", F.floor(F.col("_node") / FAN**level)).alias(f"n{level}") for level in range(top + 1)]).first()
    start = next((level for level in range(top + 1) if counts[level] <= HELD_NODES), None)
    first = top if start is None else start
    room = (1 + (slack or 0.0)) ** 2 * (1 + 1e-9)
    front, rows, singles, n_single = groups.withColumns({"_one": F.lit(-1).cast("long"), "_u": F.lit(float("inf"))}), seen["n"], [], 0
    for level in range(first, -1, -1):
        width = FAN**level
        nodes = _boxes(lowest, F.col("nscope"), F.floor(F.col("_node") / width).alias("_child"), x=("x0", "x1"), y=("y0", "y1"), n=F.sum("n")).withColumn("_up", F.floor(F.col("_child") / FAN))
        held = level == start
        if held:
            known = nodes.select("nscope", "_child", "n", "x0", "x1", "y0", "y1").orderBy("nscope", "_child").toArrow()
            met = _met_at_once(front, known, k, room)
        else:
            n_nodes = counts[level]
            if n_nodes > BROADCAST_NODES:
                front = _few(front, rows)
            below = F.col("gscope") == F.col("nscope")
            children = front.join(_few(nodes, n_nodes) if n_nodes <= BROADCAST_NODES else nodes, below if level == first else below & (F.col("_at") == F.col("_up")))
            met = _bounded(children.drop("nscope", "_at", "_up"), k, room)
            met = met.withColumn("_many", F.count(F.lit(1)).over(Window.partitionBy("gscope", "_group", "_one")))
        met, seen = _kept(met, n=F.count(F.lit(1)), most=F.max(F.when(F.col("_one") < 0, F.col("_many"))))
        rows = seen["n"]
        if (seen["most"] or 0) > SPLIT:
            wide = met.filter((F.col("_many") > SPLIT) & (F.col("_one") < 0))
            split, seen = _kept(wide.select("gscope", "_group").distinct(), n=F.count(F.lit(1)))
            those = asked.withColumnRenamed("scope", "gscope").join(_few(split, seen["n"]), ["gscope", "_group"], "left_semi")
            own, seen = _kept(those.select("gscope", "_group", F.col("_p").alias("_one"), F.col("x").alias("a0"), F.col("x").alias("a1"), F.col("y").alias("b0"), F.col("y").alias("b1"), "_q"), n=F.count(F.lit(1)))
            singles.append(own.select(F.col("_one").alias("_at_q"), "_q"))
            n_single += seen["n"]
            if held:
                single = _met_at_once(own.drop("_q").withColumn("_u", F.lit(float("inf"))), known, k, room)
            else:
                single = wide.drop("_one", "_many", "a0", "a1", "b0", "b1").join(_few(own.drop("_q"), seen["n"]), ["gscope", "_group"])
                single = _bounded(single, k, room).withColumn("_many", F.lit(1).cast("long"))
            single, seen = _kept(single, n=F.count(F.lit(1)))
            rows += seen["n"] or 0
            met = met.filter((F.col("_many") <= SPLIT) | (F.col("_one") >= 0)).unionByName(single.select(*met.columns))
        front = met.select("gscope", "_group", "_one", "a0", "a1", "b0", "b1", F.col("_child").alias("_at"), "_u")
    of_leaf = (F.col("gscope") == F.col("pscope")) & (F.col("_at") == F.col("_node"))
    # A group is compared with all points of its leaves at once; what comes out are the answers.
    tasks = int(tree.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but much work: not to be put together into few tasks
    beyond = lambda low, high, p: F.greatest(F.lit(0.0), F.col(low) - F.col(p), F.col(p) - F.col(high))
    near = _few(front.filter("_one < 0"), rows).join(tree, of_leaf).filter(_square(beyond("a0", "a1", "px"), beyond("b0", "b1", "py")) <= F.col("_u") * room).select("gscope", "_group", "px", "py", *columns)
    mine = asked.select(F.col("scope").alias("gscope"), "_group", "_q", F.col("x").alias("_x"), F.col("y").alias("_y"))
    fields = {f.name: f for f in near.schema.fields}
    schema = T.StructType([asked.schema["_q"], T.StructField("rank", T.IntegerType()), T.StructField("dist_m", T.DoubleType()), *[fields[c] for c in columns]])
    by = ["gscope", "_group"]
    found = near.repartition(tasks, *by).groupBy(*by).cogroup(mine.repartition(tasks, *by).groupBy(*by)).applyInArrow(_comparer(k, room, slack, columns, to_arrow_schema(schema)), schema)
    if not singles:
        return found
    single = _few(front.filter("_one >= 0").select("gscope", "_at", "_u", F.col("_one").alias("_s"), F.col("a0").alias("x"), F.col("b0").alias("y")), rows).join(tree, of_leaf)
    apart = _square(F.col("x") - F.col("px"), F.col("y") - F.col("py"))
    single = single.filter(apart <= F.col("_u") * room).select(F.col("_s").alias("_q"), F.sqrt(apart).alias("dist_m"), *columns)
    whose = functools.reduce(DataFrame.unionByName, singles)
    single = _best(single, k, slack).withColumnRenamed("_q", "_s").join(_few(whose, n_single), F.col("_s") == F.col("_at_q"))
    return found.unionByName(single.select("_q", F.col("rank").cast("int").alias("rank"), "dist_m", *columns))


def _parts(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, k: int, room: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Neighbouring queries of a group, a few at a time, and the points (in order) that can be among their k nearest or within ``room`` of these."""
    slabs = np.array_split(np.argsort(x, kind="stable"), max(1, round((len(x) / PART) ** 0.5)))
    for slab in slabs:
        for part in np.array_split(slab[np.argsort(y[slab], kind="stable")], max(1, round(len(slab) / PART))):
            qx, qy = x[part], y[part]
            x0, x1, y0, y1 = qx.min(), qx.max(), qy.min(), qy.max()
            farthest = np.maximum(px - x0, x1 - px) ** 2 + np.maximum(py - y0, y1 - py) ** 2
            nearest = np.maximum(0, np.maximum(x0 - px, px - x1)) ** 2 + np.maximum(0, np.maximum(y0 - py, py - y1)) ** 2
            at = np.flatnonzero(nearest <= np.partition(farthest, k - 1)[k - 1] * room) if len(px) > k else np.arange(len(px))
            for some in np.array_split(part, max(1, -(-len(part) * len(at) // DISTANCES))):
                yield some, at


def _best(pairs: DataFrame, k: int, slack: float | None) -> DataFrame:
    """Of the pairs of each _q the k nearest, or all within ``slack`` of the kth."""
    if slack is None:
        return _ranked(pairs, k)
    every = Window.partitionBy("_q").orderBy("dist_m").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kth = F.nth_value("dist_m", k).over(every)
    return pairs.withColumn("_kth", kth).filter(F.col("_kth").isNull() | (F.col("dist_m") <= F.col("_kth") * (1 + slack))).drop("_kth").withColumn("rank", F.lit(0))


def _comparer(k: int, room: float, slack: float | None, columns: list[str], schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For the points and queries of a group: each query with its k nearest points, nearer first, then by the smaller point_id; or all within ``slack`` of the kth."""

    def compare(points: pa.Table, queries: pa.Table) -> pa.Table:
        if not points.num_rows or not queries.num_rows:
            return schema.empty_table()
        points = points.take(pc.sort_indices(points.column("point_id"), null_placement="at_start"))
        px, py, x, y = (t.column(c).to_numpy() for t, c in ((points, "px"), (points, "py"), (queries, "_x"), (queries, "_y")))
        whose, which, rank, apart = [], [], [], []
        for part, at in _parts(x, y, px, py, k, room):
            dx, dy = x[part, None] - px[at], y[part, None] - py[at]
            square = dx * dx + dy * dy
            kth = np.partition(square, k - 1, 1)[:, k - 1] if len(at) > k else square.max(1)
            a, b = np.nonzero(square <= (kth * room)[:, None])
            dist = np.sqrt(square[a, b])
            if slack is None:
                order = np.lexsort((b, dist, a))
                a, b, dist = a[order], b[order], dist[order]
                n = np.arange(len(a)) - np.searchsorted(a, a) + 1
                keep = n <= k
            else:
                n, keep = np.zeros(len(a), np.int64), (dist <= np.sqrt(kth)[a] * (1 + slack)) | (len(at) < k)
            whose.append(part[a[keep]])
            which.append(at[b[keep]])
            rank.append(n[keep])
            apart.append(dist[keep])
        whose, which, rank, apart = map(np.concatenate, (whose, which, rank, apart))
        answers = points.select(columns).take(pa.array(which))
        parts = [queries.column("_q").take(pa.array(whose)), pa.array(rank.astype(np.int32)), pa.array(apart), *answers.columns]
        return pa.table(parts, names=schema.names)

    return compare


def _square(a: Column, b: Column) -> Column:
    return a * a + b * b


def _bounded(met: DataFrame, k: int, room: float) -> DataFrame:
    """The pairs of a group (or one query) and a node that can still matter, with ``_u``, the square of a distance that surely holds k points."""
    gap = lambda low, high, a, b: F.greatest(F.lit(0.0), F.col(low) - F.col(b), F.col(a) - F.col(high))
    reach = lambda low, high, a, b: F.greatest(F.col(high) - F.col(a), F.col(b) - F.col(low))
    met = met.withColumns({"_near": _square(gap("x0", "x1", "a0", "a1"), gap("y0", "y1", "b0", "b1")), "_far": _square(reach("x0", "x1", "a0", "a1"), reach("y0", "y1", "b0", "b1"))})
    met = met.filter(F.col("_near") <= F.col("_u") * room)  # by the bound of the level above, before rows are sent
    enough = F.min(F.when(F.col("n") >= k, F.struct("_far", "x0", "x1", "y0", "y1"))).over(Window.partitionBy("gscope", "_group", "_one"))
    met = met.withColumn("_sure", enough).withColumn("_u", F.least("_u", "_sure._far"))

    def excess(q: str, low: str, high: str) -> Column:
        """At one end of the group's box, by how much the square to the far side of the sure node exceeds that to the near side of this one."""
        far = F.greatest(F.abs(F.col(q) - F.col(f"_sure.{low}")), F.abs(F.col(q) - F.col(f"_sure.{high}")))
        near = F.greatest(F.lit(0.0), F.col(low) - F.col(q), F.col(q) - F.col(high))
        return far * far * room - near * near

    # Along either axis the excess is convex in the query's place, so it is greatest at an end of the box.
    most = F.greatest(excess("a0", "x0", "x1"), excess("a1", "x0", "x1")) + F.greatest(excess("b0", "y0", "y1"), excess("b1", "y0", "y1"))
    return met.filter((F.col("_near") <= F.col("_u") * room) & F.coalesce(most >= 0, F.lit(True))).drop("_sure", "_near", "_far")


def _reached(box: np.ndarray, known: np.ndarray, k: int, room: float) -> tuple[np.ndarray, float]:
    """As ``_bounded``, for one box (a0, a1, b0, b1) and nodes in columns (n, x0, x1, y0, y1): the places of those that can matter, and the bound."""
    a0, a1, b0, b1 = box
    n, x0, x1, y0, y1 = known
    near = np.maximum(0, np.maximum(x0 - a1, a0 - x1)) ** 2 + np.maximum(0, np.maximum(y0 - b1, b0 - y1)) ** 2
    far = np.where(n >= k, np.maximum(x1 - a0, a1 - x0) ** 2 + np.maximum(y1 - b0, b1 - y0) ** 2, np.inf)
    sure = far.argmin()
    if far[sure] == np.inf:
        return np.arange(len(n)), np.inf
    at = np.flatnonzero(near <= far[sure] * room)

    def excess(q: float, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return max(abs(q - low[sure]), abs(q - high[sure])) ** 2 * room - np.maximum(0, np.maximum(low[at] - q, q - high[at])) ** 2

    most = np.maximum(excess(a0, x0, x1), excess(a1, x0, x1)) + np.maximum(excess(b0, y0, y1), excess(b1, y0, y1))
    return at[most >= 0], float(far[sure])


def _met_at_once(boxes: DataFrame, nodes: pa.Table, k: int, room: float) -> DataFrame:
    """The rows of ``_bounded`` for boxes and all nodes of their scope, with ``_many``, their number; one row without a node (-1) for a group that keeps over SPLIT.

    nodes: a level of at most HELD_NODES nodes, ordered by scope and number, so that runs of them are near each other. A box meets
    the runs first, as nodes of their own, and then the nodes of those that can matter.
    """
    scopes = nodes.column("nscope").to_pylist()
    starts = [i for i, s in enumerate(scopes) if not i or s != scopes[i - 1]]
    child, known = nodes.column("_child").to_numpy(), np.stack([nodes.column(c).to_numpy().astype(float) for c in ("n", "x0", "x1", "y0", "y1")])
    slices = {scopes[low]: (low, high) for low, high in zip(starts, [*starts[1:], len(scopes)], strict=False)}
    split, block = SPLIT, BLOCK
    fields = {f.name: f for f in boxes.schema.fields}
    schema = T.StructType([*[fields[c] for c in ("gscope", "_group", "_one", "a0", "a1", "b0", "b1")], *[T.StructField(c, kind) for c, kind in (("_child", T.LongType()), ("_u", T.DoubleType()), ("_many", T.LongType()))]])
    out = to_arrow_schema(schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = {}
        for scope, (low, high) in slices.items():
            cuts = np.arange(low, high, block) - low
            own = known[:, low:high]
            runs[scope] = np.stack([f.reduceat(row, cuts) for f, row in zip((np.add, np.minimum, np.maximum, np.minimum, np.maximum), own, strict=True)])

        def made(batch: pa.RecordBatch, whose: list[int], found: list[np.ndarray], u: list[float], many: list[int]) -> pa.RecordBatch:
            times = [len(f) for f in found]
            left = batch.select(out.names[:7]).take(pa.array(np.repeat(whose, times)))
            more = [pa.array(np.concatenate(found)), pa.array(np.repeat(u, times)), pa.array(np.repeat(many, times))]
            return pa.RecordBatch.from_arrays([*left.columns, *more], schema=out)

        for batch in batches:
            sides = np.stack([batch.column(c).to_numpy() for c in ("a0", "a1", "b0", "b1")], 1)
            single = batch.column("_one").to_numpy() >= 0
            whose, found, u, many, rows = [], [], [], [], 0
            for i, scope in enumerate(batch.column("gscope").to_pylist()):
                if scope is None or scope not in slices:
                    continue
                low, high = slices[scope]
                at, bound = _reached(sides[i], runs[scope], k, room)
                at = (low + at[:, None] * block + np.arange(block)).ravel()
                at = at[at < high]
                inside, own_bound = _reached(sides[i], known[:, at], k, room)
                at = at[inside]
                whose.append(i)
                many.append(len(at))
                u.append(min(bound, own_bound))
                found.append(child[at] if single[i] or len(at) <= split else np.array([-1]))
                rows += len(found[-1])
                if rows > 1 << 17:
                    yield made(batch, whose, found, u, many)
                    whose, found, u, many, rows = [], [], [], [], 0
            if whose:
                yield made(batch, whose, found, u, many)

    return boxes.mapInArrow(meet, schema)


def _answers(queries: DataFrame, points: DataFrame | PointTree, k: int, strategy: str, slack: float | None) -> DataFrame:
    """query_id, rank, dist_m, point_id and more columns of the points: the k nearest, or with ``slack`` all within so much of the kth (and no rank)."""
    asked = queries.filter(_finite("x") & _finite("y")).select("query_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "scope")
    if isinstance(points, PointTree):
        if points.k < k:
            raise ValueError(f"a tree for {points.k} neighbours can't give {k}")
        held, n, more, strategy = points.rows, points.n, points.more, "tree"
    else:
        held, held_box, more = _held(points, k)
        n = held_box["n"]
    if strategy == "auto":
        strategy = "broadcast" if n <= BROADCAST_POINTS and n * asked.count() <= BROADCAST_PAIRS else "tree"
    if strategy == "tree":
        found = met_pairs(asked.withColumnRenamed("query_id", "_q"), points if isinstance(points, PointTree) else _tree(held, held_box, k, more), k, slack)
        return found.withColumnRenamed("_q", "query_id")
    spots = checkpointed(asked.select("x", "y", "scope").distinct().withColumn("_q", F.monotonically_increasing_id()))  # ids hold from here on
    dist = F.sqrt((F.col("x") - F.col("px")) * (F.col("x") - F.col("px")) + (F.col("y") - F.col("py")) * (F.col("y") - F.col("py")))
    pairs = spots.join(F.broadcast(held) if n <= BROADCAST_POINTS else held, F.col("scope") == F.col("pscope")).select("_q", dist.alias("dist_m"), "point_id", *more)
    placed = spots.join(_best(pairs, k, slack), "_q").withColumnsRenamed({"x": "_x", "y": "_y", "scope": "_scope"})
    return asked.join(placed, (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y")) & (F.col("scope") == F.col("_scope"))).select("query_id", "rank", "dist_m", "point_id", *more)


def knn_join(queries: DataFrame, points: DataFrame | PointTree, k: int, strategy: str = "auto") -> DataFrame:
    """The k nearest points of each query in metres of the plane, nearer first, then by the smaller point_id.

    queries: query_id, x, y, scope. points: point_id, x, y, scope, and any
    more columns, which come along. Returns query_id, rank, dist_m, point_id
    and those columns; fewer than k rows where the scope has fewer points;
    none for null or non-finite coordinates.

    Of points at one place only the k smallest ids can be among the nearest, so
    that crowded places stay small. Points for several searches can be given as ``point_tree`` makes them. ``tree`` compares a query with the points of the few leaves that can
    matter (see ``met_pairs``); ``broadcast`` compares it with all points of its scope. ``auto`` counts both sides first and takes
    the broadcast only for few points and few pairs.
    """
    return _answers(queries, points, k, strategy, None)


def geodesic_knn_join(queries: DataFrame, points: DataFrame | PointTree, k: int, slack: float = 0.002, strategy: str = "auto") -> DataFrame:
    """As ``knn_join``, but ranked by the distance on the ellipsoid; both sides also have lat and lon.

    Candidates are all points whose distance in the plane is within ``slack`` of the kth, which covers a
    projection whose scale is right to half of that where queries and their neighbours lie.
    """
    more = points.more if isinstance(points, PointTree) else [c for c in points.columns if c not in ("point_id", "x", "y", "scope")]
    places = queries.select("query_id", F.col("lat").alias("_qlat"), F.col("lon").alias("_qlon"))
    found = _answers(queries, points, k, strategy, slack).drop("rank", "dist_m").join(places, "query_id")
    found = with_geodesic(found, "_qlat", "_qlon", "lat", "lon", "dist_m")
    best = Window.partitionBy("query_id").orderBy(F.round(F.col("dist_m") * 1e6), "point_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "dist_m", "point_id", *more)


def idw(neighbours: DataFrame, price: str = "price", power: float = 3.0, eps: float = 1.0) -> DataFrame:
    """query_id, unit_price (inverse-distance weighted, rounded half up), arrays of the neighbours in order, and their spread."""
    weight = F.lit(1.0) / F.pow(F.col("dist_m") + eps, F.lit(power))
    kind = F.col("kind") if "kind" in neighbours.columns else F.lit(None).cast("string")
    item = F.struct("rank", "dist_m", "point_id", F.col(price).cast("long").alias("price"), kind.alias("kind"))
    out = neighbours.groupBy("query_id").agg(
        F.round(F.sum(weight * F.col(price)) / F.sum(weight)).cast("long").alias("unit_price"), F.array_sort(F.collect_list(item)).alias("_all"), F.max("dist_m").alias("max_dist"), F.var_pop("dist_m").alias("variance")
    )
    return out.select("query_id", "unit_price", F.col("_all.point_id").alias("knn_ids"), F.col("_all.dist_m").alias("knn_dist_m"), F.col("_all.price").alias("knn_prices"), F.col("_all.kind").alias("knn_kinds"), "max_dist", "variance")


def nearest_with_fallback(queries: DataFrame, scoped: DataFrame | PointTree, wanted: str = "family", far: float = 1500.0, join: Callable[..., DataFrame] | None = None, **options: object) -> DataFrame:
    """The nearest point of the wanted scope, or of all points if that scope is unknown or its nearest is farther than ``far``.

    Only the queries whose own answer is too far are asked again; a known scope has an answer for every place. ``join`` is
    ``knn_join`` unless given.
    """
    join = join or knn_join
    asked = checkpointed(known_scope(queries, scoped, wanted))
    own, seen = _kept(join(asked, scoped, 1, **options).drop("rank"), n=F.count_if(F.col("dist_m") > far))
    if not seen["n"]:
        return own
    distant = _few(own.filter(F.col("dist_m") > far).select("query_id").distinct(), seen["n"])
    again, seen = _kept(asked.filter("scope <> ''").join(distant, "query_id", "left_semi").withColumn("scope", F.lit("")), n=F.count(F.lit(1)))
    anywhere = join(again, scoped, 1, **options).drop("rank")
    return own.join(_few(again.select("query_id"), seen["n"]), "query_id", "left_anti").unionByName(anywhere)


def point_attribute(ids: DataFrame, points: DataFrame, attribute: str = "kind", id_col: str = "point_id") -> DataFrame:
    """ids with the attribute of their point, '' where there is none."""
    known = points.select(F.col("point_id").alias("_p"), F.col(attribute).alias("_a"))
    return ids.join(known, F.col(id_col) == F.col("_p"), "left").withColumn(attribute, F.coalesce("_a", F.lit(""))).drop("_p", "_a")


def unique_ids(points: DataFrame, base: str, order: str, out: str = "point_id") -> DataFrame:
    """The nth of equal ids, in the given order, becomes id#n from the second on."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(order))
    return points.withColumn("_n", n).withColumn(out, F.when(F.col("_n") == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit("#"), F.col("_n").cast("string")))).drop("_n")


def conflate(first: DataFrame, second: DataFrame, lat: str = "lat", lon: str = "lon", digits: int = 5) -> DataFrame:
    """All of the first survey and those of the second whose coordinates, in units of the last digit, no first one has."""
    key: list[Column] = [F.round(F.col(c) * 10**digits).cast("long") for c in (lat, lon)]
    taken = first.select(key[0].alias("_a"), key[1].alias("_b")).distinct()
    extra = second.join(taken, (key[0] == F.col("_a")) & (key[1] == F.col("_b")), "left_anti")
    return first.withColumn("survey", F.lit(1)).unionByName(extra.withColumn("survey", F.lit(2)))


def conflation_counts(first: DataFrame, second: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: first, second, added, skipped, total."""
    sides = first.select(F.lit(1).alias("f"), F.lit(0).alias("s"), F.lit(0).alias("a")).unionAll(second.select(F.lit(0), F.lit(1), F.lit(0))).unionAll(merged.select(F.lit(0), F.lit(0), (F.col("survey") == 2).cast("int")))
    t = sides.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("first"), F.coalesce(F.sum("s"), F.lit(0)).alias("second"), F.coalesce(F.sum("a"), F.lit(0)).alias("added"))
    return t.select("first", "second", "added", (F.col("second") - F.col("added")).alias("skipped"), (F.col("first") + F.col("added")).alias("total"))
