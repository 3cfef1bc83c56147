"""Greedy leader selection, the shape shared by box suppression, voting and grouping.

Walk the rows of a group in a fixed order.  A row related to an earlier leader follows the
first such leader; any other row becomes a leader.  The relation may look at both rows but
never at the order of arrival of other followers, so only the leaders so far matter.

Small groups are folded inside the JVM over one sorted array.  Groups above a
checked size are never gathered: they are resolved in rounds that split them by grid cell
(see ``_rounds``).  Both ways give the same rows.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom import scale

RIVALS = 16    # rows of one grid cell compared with each other in a round
PREFIX = 400   # rows of a crowded group resolved together at the start of each round

Related = Callable[[Column, Column], Column]


def _ordered(order: list[tuple[str, bool]]) -> Column:
    """A struct that sorts ascending in the wanted order; descending needs numbers."""
    return F.struct(*[(-F.col(c) if desc else F.col(c)).alias(f"o{i}") for i, (c, desc) in enumerate(order)])


def _fold(df: DataFrame, group: list[str], fields: list[str], related: Related, keep_followers: bool) -> DataFrame:
    """Leaders of small groups; ``df`` carries ``_ord`` and returns with ``_owner``.

    The relation is evaluated on exploded pairs of ``fields``, as plain (compiled) expressions; of each related pair only the two places
    in the order stay, as one number, and a group's rows travel once beside them.  The pairs are walked in order: a row
    follows the first earlier one that does not follow itself.  Nothing is shuffled after the first grouping."""
    rest = [c for c in df.columns if c not in group and c != "_ord"]
    member = F.struct(F.col("_ord"), *[F.col(c) for c in rest])
    packed = df.groupBy(*group).agg(F.sort_array(F.collect_list(member)).alias("_m"))
    packed = packed.withColumn("_f", F.transform("_m", lambda m: F.struct(*[m[c].alias(c) for c in fields])))
    each = packed.select(*group, "_m", "_f", F.posexplode("_f").alias("_i", "_r"))
    pairs = each.select(*group, "_i", "_r", F.when(F.col("_i") == 0, F.col("_m")).alias("_m"), F.posexplode("_f").alias("_j", "_k"))
    head = (F.col("_i") == 0) & (F.col("_j") == 0)
    met = pairs.where(head | ((F.col("_j") < F.col("_i")) & related(F.col("_k"), F.col("_r"))))
    place = F.shiftleft(F.col("_i").cast("long"), 32) + F.col("_j")
    walked = met.groupBy(*group).agg(F.first(F.when(head, F.col("_m")), True).alias("_m"),
                                     F.sort_array(F.collect_list(F.when(~head, place))).alias("_met"))
    none = F.expr("cast(array() as array<int>)")

    def step(acc: Column, p: Column) -> Column:
        i, j = F.shiftright(p, 32).cast("int"), p.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
        settled = F.get(acc["i"], F.size(acc["i"]) - 1).eqNullSafe(i) | F.array_contains(acc["i"], j)
        return F.when(settled, acc).otherwise(F.struct(F.concat(acc["i"], F.array(i)).alias("i"), F.concat(acc["j"], F.array(j)).alias("j")))

    walked = walked.withColumn("_fol", F.aggregate("_met", F.struct(none.alias("i"), none.alias("j")), step))
    if keep_followers:
        def owner(m: Column, i: Column) -> Column:
            at = F.array_position(F.col("_fol.i"), i).cast("int")        # from 1; 0 for a leader
            return F.when(at == 0, m["_ord"]).otherwise(F.get(F.col("_m"), F.get(F.col("_fol.j"), at - 1))["_ord"])
        out = F.transform("_m", lambda m, i: F.struct(m.alias("m"), owner(m, i).alias("_owner")))
    else:
        leads = lambda m, i: ~F.array_contains(F.col("_fol.i"), i)
        walked = walked.withColumn("_lead", F.transform(F.filter("_m", leads), lambda m: m["_ord"]))
        out = F.transform(F.filter("_m", lambda m, i: leads(m, i) | F.array_contains("_lead", m["_ord"])),      # rows of one order go together
                          lambda m: F.struct(m.alias("m"), m["_ord"].alias("_owner")))
    flat = walked.select(*group, F.explode(out).alias("_r"))
    return flat.select(*group, "_r.m.*", "_r._owner")


def _pairs(a: DataFrame, b: DataFrame, group: list[str], fields: list[str], related: Related,
           ) -> DataFrame:
    """(follower order, leader order) pairs that share a cell; ``b`` holds leaders."""
    left = a.select(*group, F.struct("_ord", *fields).alias("m"), F.explode("_cells").alias("_cell"))
    right = b.select(*group, F.struct("_ord", *fields).alias("k"), F.explode("_cells").alias("_cell"))
    k, m = F.col("k"), F.col("m")
    return (left.join(right, [*group, "_cell"]).where((k["_ord"] < m["_ord"]) & related(k, m))
            .select(*group, m["_ord"].alias("_ord"), k["_ord"].alias("_lead")))


def _first_tier(todo: DataFrame, group: list[str]) -> DataFrame:
    """Rows that share no cell with a row of an earlier tier."""
    spread = todo.select(*group, "_ord", F.explode("_cells").alias("_cell"))
    top = spread.groupBy(*group, "_cell").agg(F.min("_ord").alias("_top"))
    late = spread.join(top, [*group, "_cell"]).where(F.col("_ord.o0") != F.col("_top.o0"))
    return todo.join(late.select(*group, "_ord").distinct(), [*group, "_ord"], "left_anti")


def _unrivalled(todo: DataFrame, group: list[str], fields: list[str], related: Related) -> DataFrame:
    """Rows among the first few of each cell they touch that are related to no earlier row.

    Only those first rows of a cell are compared; tasks drop the others before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(*group, "_cell").orderBy("_ord"))
    near = (todo.select(*group, "_ord", F.struct("_ord", *fields).alias("m"), F.size("_cells").alias("_n"),
                        F.explode("_cells").alias("_cell"))
            .withColumn("_rn", rn).where(F.col("_rn") <= RIVALS).drop("_rn"))
    known = near.groupBy(*group, "_ord", "_n").count().where(F.col("count") == F.col("_n")).select(*group, "_ord")
    other = near.select(*group, "_cell", F.col("m").alias("k"))
    k, m = F.col("k"), F.col("m")
    rivalled = near.join(other, [*group, "_cell"]).where((k["_ord"] < m["_ord"]) & related(k, m)).select(*group, "_ord").distinct()
    return todo.join(known, [*group, "_ord"], "left_semi").join(rivalled, [*group, "_ord"], "left_anti")


def _rounds(df: DataFrame, group: list[str], fields: list[str], related: Related, cells: Column,
            same: list[str], mirror: bool, keep_followers: bool, prefix: int, tiered: bool) -> DataFrame:
    """Leaders of groups too large to gather.

    Equal boxes are first reduced to their earliest copy.  Each round then settles rows whose
    fate cannot depend on the rest: the leaders among the first ``prefix`` rows of a group, and rows that no
    earlier row in any grid cell they touch can rule out.  Rows related to those
    leave as followers, and the next round sees what is left.  A round emits no pairs within
    a group beyond (row, newly settled leader) in one cell, reduced before any shuffle.
    """
    key = [*group, *same]
    first = df.groupBy(*key).agg(F.min("_ord").alias("_first"))
    rows = scale.checkpointed(df.join(first, key).withColumn("_cells", F.array_distinct(cells)))
    todo = rows.where(F.col("_ord") == F.col("_first")).select(*group, "_ord", "_cells", *fields)
    todo = scale.checkpointed(todo)
    leaders = None
    while not todo.isEmpty():
        w = Window.partitionBy(*group).orderBy("_ord")
        head = todo.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= prefix).drop("_rn")
        from_prefix = _fold(head, group, fields, related, False).drop("_owner")
        local = _first_tier(todo, group) if tiered else _unrivalled(todo, group, fields, related)
        new = (from_prefix.select(*todo.columns).unionByName(local)
               .dropDuplicates([*group, "_ord"]))
        new = scale.checkpointed(new)
        gone = (_pairs(todo, new, group, fields, related).select(*group, "_ord")
                .unionByName(new.select(*group, "_ord")).distinct())
        todo = scale.checkpointed(todo.join(gone, [*group, "_ord"], "left_anti"))
        leaders = new if leaders is None else leaders.unionByName(new)
    if leaders is None:
        return df.withColumn("_owner", F.col("_ord")).limit(0)
    lead_keys = leaders.select(*group, F.col("_ord").alias("_first"))
    if not keep_followers:
        kept = rows.join(lead_keys, [*group, "_first"], "left_semi")
        kept = kept if mirror else kept.where(F.col("_ord") == F.col("_first"))
        return kept.withColumn("_owner", F.col("_ord")).drop("_first", "_cells")
    heads = rows.where(F.col("_ord") == F.col("_first")).select(*group, "_ord", "_cells", *fields)
    led = (_pairs(heads, leaders, group, fields, related)
           .groupBy(*group, F.col("_ord").alias("_first")).agg(F.min("_lead").alias("_lead")))
    out = rows.join(led, [*group, "_first"], "left")
    alone = F.col("_ord") if mirror else F.col("_first")
    return out.withColumn("_owner", F.coalesce("_lead", alone)).drop("_first", "_lead", "_cells")


def leaders(df: DataFrame, group: list[str], order: list[tuple[str, bool]], fields: list[str],
            related: Related, cells: Column, same: list[str], *, mirror_copies: bool = False,
            keep_followers: bool = False, limit: int = scale.GROUP_LIMIT, prefix: int | None = None,
            hot: bool | None = None, tiered: bool = False) -> DataFrame:
    """Keep the leaders of each group, or all rows with their leader's order key.

    ``order``: (column, descending) pairs that order the rows of a group totally.
    ``fields``: columns ``related(leader, row)`` reads.  ``cells``: array column such that
    related rows share an entry.  ``same``: columns that, when equal, make two rows copies;
    copies follow the earliest one, or share its fate when ``mirror_copies`` (rows of one
    model that cannot absorb each other).  ``tiered``: rows equal in the first order column are never related,
    so a splitting round settles a whole tier of a cell at once.  ``prefix``: rows of a group that a round
    of the splitting plan gathers.  With ``keep_followers`` the result has
    ``_ord`` and ``_owner`` structs; they are equal for leaders.
    """
    prepared = df.withColumn("_ord", _ordered(order))
    if hot is None:
        hot = scale.has_oversized(df, group, limit)
    if not hot:
        out = _fold(prepared, group, fields, related, keep_followers)
    else:
        big = scale.oversized(df, group, limit)
        big = scale.checkpointed(big)
        cold = prepared.join(scale.maybe_broadcast(big), group, "left_anti")
        large = prepared.join(scale.maybe_broadcast(big), group, "left_semi")
        out = (_fold(cold, group, fields, related, keep_followers)
               .unionByName(_rounds(large, group, fields, related, cells, same, mirror_copies,
                                    keep_followers, prefix or min(limit, PREFIX), tiered)))
    columns = [*df.columns, "_ord", "_owner"] if keep_followers else df.columns
    return out.select(*columns)
