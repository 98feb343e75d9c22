"""Mixing sources to target weights by pivotal dependent rounding (operator 5)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landquill.llm.common import checkpointed, unit
from landquill.shared import running

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that one task step pairs off one after another.
BLOCK = 64
#: Sources up to which the table of sources is broadcast.
BROADCAST_SOURCES = 10_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, n, source_size, target for each source of (source, size).

    Sources in order of code points, null last, take the weights in turn. They
    share ``budget`` times all sizes by weight; a target stops at ``most``
    times its source's size and the excess is shared by weight among the
    others until none is above. With the sources in ascending order of cap
    over weight, exactly a leading part is capped: the level that the rest
    would get, (budget - caps so far) / (weights left), tells which.
    Running sums over the sources are added up in ranges of that order.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    by_name = [F.col("source").isNull(), F.col("source")]
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_k") % len(weights) + 1).cast("int"))
    ranked = checkpointed(running(per, by_name, _k=F.lit(1)).withColumn("_w", pick).withColumn("_cap", F.lit(most) * F.col("source_size")).drop("_k"))
    words, all_weights = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0.0))).first()
    filled = running(ranked, [F.col("_cap") / F.col("_w"), *by_name], _caps=F.col("_cap"), _weights=F.col("_w"))
    leveled = checkpointed(filled.withColumn("_level", (F.lit(budget * words) - F.col("_caps")) / (F.lit(all_weights) - F.col("_weights"))))
    # The first uncapped source has the level of all that follow; taking its cap
    # away as well lowers the levels that these come to, so it is the largest.
    final = leveled.agg(F.max(F.when(F.col("_level") * F.col("_w") < F.col("_cap"), F.col("_level")))).first()[0]
    target = F.col("_cap") if final is None else F.least("_cap", F.lit(final) * F.col("_w"))
    return leveled.select("source", "n", "source_size", target.alias("target"))


def _pair_off(items: Column, seed: int) -> Column:
    """Pair the items of an array one after another; struct(open, shut).

    Each item is struct(size, doc_id, base, p): base whole copies and one more
    with probability p. Of two open items, words move from one to the other
    until a probability is 0 or 1: either of the two possible transfers, with
    chances that leave both expectations as they are. The words of the two
    together stay the same, and one stays open for the next pair.
    """

    def step(state: Column, x: Column) -> Column:
        y = state["open"]
        wx, wy = x["size"], y["size"]
        mx, my = wx * x["p"], wy * y["p"]
        up = F.least(wx - mx, my)  # words that x can take from y
        down = F.least(mx, wy - my)  # words that x can give to y
        chance = F.when(up + down > 0, down / (up + down)).otherwise(F.lit(0.5))
        move = F.when(unit(F.lit(seed), x["doc_id"], y["doc_id"], x["size"], x["p"], y["p"]) < chance, up).otherwise(-down)
        px, py = (mx + move) / wx, (my - move) / wy
        whole_x = (F.abs(px) < 1e-9) | (F.abs(px - 1) < 1e-9)
        now_x = F.struct(x["size"].alias("size"), x["doc_id"].alias("doc_id"), x["base"].alias("base"), px.alias("p"), x["rep"].alias("rep"))
        now_y = F.struct(y["size"].alias("size"), y["doc_id"].alias("doc_id"), y["base"].alias("base"), py.alias("p"), y["rep"].alias("rep"))
        paired = F.struct(F.when(whole_x, now_y).otherwise(now_x).alias("open"), F.concat(state["shut"], F.array(F.when(whole_x, now_x).otherwise(now_y))).alias("shut"))
        return F.when(y.isNull(), F.struct(x.alias("open"), state["shut"].alias("shut"))).otherwise(paired)

    first = F.struct(F.element_at(items, 1).alias("open"), F.filter(items, lambda x: F.lit(False)).alias("shut"))
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), first, step)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, most: float = 2.0, block: int = BLOCK, seed: int = 17) -> DataFrame:
    """How many words the mix takes of each document.

    A document's size is its number of words; its source's target over the
    source's size is the expected number of copies. The whole part is certain;
    the fraction is rounded by pivotal sampling: within hashed blocks of a
    source documents are paired off (see ``_pair_off``), at most one of a
    block stays open, and the open ones of all blocks form the next, smaller
    level of the tree until one is left in each source. That one is taken in
    part: its expected number of words, rounded. A source's words so differ
    from its target by at most one, however long its documents are. All draws
    are hashes of the pair, so that reruns agree.

    Returns id, size, source_size, target, taken, copies (whole ones). Null and empty texts
    have size 0 and take nothing. The null source is a source. Rows that repeat
    id, source and size are rounded together and get the same copies. A
    source of size 0 has target 0.
    Other columns, whatever their names, play no part; an empty table gives an empty one.
    Of a text only its number of words is kept, however long it is.
    """
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"))
    sized = checkpointed(sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("rep")))
    expanded = sized.groupBy("source").agg(F.sum("rep").alias("n"), F.sum(F.col("size") * F.col("rep")).alias("size"))
    targets = checkpointed(source_targets(expanded.select("source", "size"), weights, budget, most).drop("n").join(expanded.select(F.col("source").alias("_s"), "n"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    known, largest = targets.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    side = targets.select(F.col("source").alias("_s"), "source_size", "target", "n")
    side = F.broadcast(side) if known <= BROADCAST_SOURCES else side
    rated = sized.join(side, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = rated.withColumn("_rate", F.least(rate, F.lit(most))).withColumn("base", F.floor("_rate"))
    rated = rated.withColumn("p", F.when(F.col("size") > 0, F.col("_rate") - F.col("base")).otherwise(F.lit(0.0)))
    whole = (F.col("p") < 1e-9) | (F.col("size") == 0)

    settled = [rated.filter(whole).select("source", "doc_id", "size", "rep", F.col("base").alias("copies"), F.lit(0).cast("long").alias("part"))]
    item = F.struct((F.col("size") * F.col("rep")).cast("double").alias("size"), "doc_id", "base", "p", "rep")
    opened = rated.filter(~whole).select("source", "n", item.alias("item"))
    levels = max(1, math.ceil(math.log(max(2, largest), block)) + 1)
    for level in range(levels):
        last = level == levels - 1
        spread = F.lit(0) if last else F.pmod(F.xxhash64(F.lit(seed + level), F.col("item.doc_id"), F.col("item.size")), F.ceil(F.col("n") / F.lit(float(block) ** (level + 1))).cast("long"))
        blocks = opened.groupBy("source", spread.alias("block")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list("item"), asc=False).alias("items"))
        paired = checkpointed(blocks.select("source", "n", _pair_off(F.col("items"), seed + 1000 * level).alias("got")))
        shut = paired.select("source", F.explode("got.shut").alias("item"))
        settled.append(_closed(shut, F.when(F.col("item.p") >= 0.5, 1).otherwise(0), F.lit(0).cast("long")))
        opened = paired.select("source", "n", F.col("got.open").alias("item"))
    # What the last open document takes beyond its whole copies, in words of all rows that it stands for.
    rest = _closed(opened, F.lit(0), F.round(F.col("item.size") * F.col("item.p")).cast("long"))
    settled.append(rest)

    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    out = out.join(side.drop("n"), F.col("source").eqNullSafe(F.col("_s"))).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rep"))))
    return out.select(F.col("doc_id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies") + F.floor(F.col("part") / F.col("rep")) + F.when(F.col("_copy") <= F.col("part") % F.col("rep"), 1).otherwise(0)).alias("taken"), "copies")


def _closed(items: DataFrame, more: Column, part: Column) -> DataFrame:
    """The documents of items with the copies beyond the base, and the words beyond all copies."""
    own = items.select("source", "item.*", more.alias("more"), part.alias("part"))
    return own.select("source", "doc_id", F.round(F.col("size") / F.col("rep")).cast("long").alias("size"), "rep", (F.col("base") + F.col("more")).alias("copies"), "part")
