"""Shards of equal row counts by balanced label propagation."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywarden.llm.common import drop_staged, ranked, staged, text_of


def _capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), at.cast("int") + 1)


def _ahead(cells: DataFrame, by: list[str]) -> DataFrame:
    """``cells`` with ahead: the rows that stand before a cell in its line of ``by``.

    Lines run by chunks of a hash, so that no task orders a whole line.
    """
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("turn", F.pmod(F.xxhash64("group"), F.lit(1024)))
    chunks = cells.groupBy(*by, "turn").agg(F.sum("n").alias("t")).withColumn(
        "before", F.coalesce(F.sum("t").over(until(Window.partitionBy(*by).orderBy("turn"))), F.lit(0))).drop("t")
    inside = F.sum("n").over(until(Window.partitionBy(*by, "turn").orderBy("group")))
    return cells.join(chunks, [*by, "turn"]).withColumn("ahead", F.col("before") + F.coalesce(inside, F.lit(0))) \
        .drop("before", "turn")


def _cycle(wants: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """Wishes that lead from shard to shard and back to the first; empty if there are none."""
    out: dict[int, set[int]] = {}
    for (a, b), n in wants.items():
        if n:
            out.setdefault(a, set()).add(b)
    while dead := {b for to in out.values() for b in to if b not in out}:
        out = {a: to - dead for a, to in out.items() if to - dead}
    if not out:
        return []
    path = [min(out)]
    while (b := min(out[path[-1]])) not in path:
        path.append(b)
    around = path[path.index(b):]
    return list(zip(around, around[1:] + around[:1]))


def _flows(wants: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many rows may go from shard to shard, of those that ``wants`` to: into room, then around in cycles."""
    left, room, flows = dict(wants), list(room), dict.fromkeys(wants, 0)

    def go(a: int, b: int, n: int) -> None:
        left[a, b] -= n
        flows[a, b] += n
    moved = True
    while moved:
        moved = False
        for a, b in sorted(left):
            n = min(left[a, b], room[b])
            if n > 0:
                go(a, b, n)
                room[a], room[b], moved = room[a] + n, room[b] - n, True
    for a, b in sorted(left):
        both = min(left[a, b], left.get((b, a), 0))
        if both:
            go(a, b, both)
            go(b, a, both)
    while cycle := _cycle(left):
        n = min(left[e] for e in cycle)
        for e in cycle:
            go(*e, n)
    return flows


def propagate(cells: DataFrame, capacities: list[int], rounds: int | None = None) -> DataFrame:
    """Move linked documents to the shards where most of their neighbours are.

    ``cells`` holds (group, shard, n): the members of a group in a shard
    are alike, so a third of all documents in one group is a few rows.
    In each round every cell looks, by a join with its group, for the
    shard with the most members of the group that they do not fill, and
    wants to follow them if they are more than itself.  The numbers of
    rows that want to go from one shard to another, at most one per pair
    of shards, tell how many may: as many as there is room for, and as
    many as come back, directly or around over others, so that no shard
    ever exceeds its capacity.  They are taken in order by running totals;
    a cell that only fits in part is split.  Each move goes to a larger
    cell of the group, which adds to the squares of all cells, so there is
    an end: when nothing moves, or after ``rounds`` if given.
    """
    shards = len(capacities)
    for round_ in itertools.count() if rounds is None else range(rounds):
        loads = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = [capacities[s] - loads.get(s, 0) for s in range(shards)]
        # A cell may only follow a larger one, ties by a hash of the round.
        place = F.struct(F.col("n"), F.xxhash64("group", "shard", F.lit(round_)).alias("tie"), F.col("shard"))
        loose = cells.where(F.col("n") < _pick(capacities, F.col("shard")))
        # Where nobody can follow the largest cell of its group, the largest in a shard with room will do.
        for goals in (loose, loose.where(_pick(room, F.col("shard")) > 0)):
            best = goals.groupBy("group").agg(F.max(place).alias("best"))
            wanting = loose.join(best, "group").where(place < F.col("best")) \
                .select("group", "shard", "n", F.col("best.shard").alias("to"))
            wanting = staged(wanting, "shard-wanting")
            wants = {(r["shard"], r["to"]): r["n"] for r in wanting.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
            flows = _flows(wants, room)
            if any(flows.values()):
                break
            drop_staged(wanting)
        else:
            break
        limit = _pick([flows.get((a, b), 0) for a in range(shards) for b in range(shards)], F.col("shard") * shards + F.col("to"))
        moved = _ahead(wanting, ["shard", "to"]).withColumn("moves", F.least("n", limit - F.col("ahead"))).where("moves > 0") \
            .select("group", "shard", "to", "moves")
        moved = staged(moved, "shard-moved")
        drop_staged(wanting)
        changes = cells.unionByName(moved.select("group", "shard", (-F.col("moves")).alias("n"))) \
            .unionByName(moved.select("group", F.col("to").alias("shard"), F.col("moves").alias("n")))
        done, cells = cells, staged(changes.groupBy("group", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "shard-cells")
        drop_staged(done)
        drop_staged(moved)
    return cells


def shard_documents(docs: DataFrame, shards: int = 16, rounds: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, group_rows.

    The law is ``rows``: the counts of any two shards differ by one at
    most.  Documents with equal texts are linked, and label propagation
    gathers them (:func:`propagate`) from shards drawn by a hash; a group
    larger than a shard ends up in as few as hold it.  Documents without
    neighbours fill what is left, and slot numbers each shard without gaps.

    size is the UTF-8 bytes of the text plus 1; a null text is the empty
    text, and empty texts are equal.  Null or repeated doc_ids are rows
    like any other.  Other columns are not read.  An empty table gives no
    rows.
    """
    text = text_of(docs)
    rows = staged(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text).alias("group")), "shard-rows")
    total = rows.count()
    capacities = _capacities(total, shards)
    groups = rows.groupBy("group").agg(F.count("*").alias("group_rows"))
    linked = staged(groups.where("group_rows > 1"), "shard-groups")
    rows = staged(rows.join(linked, "group", "left"), "shard-linked")

    own = rows.where("group_rows is not null")
    # Draw labels member by member; the draws of one shard beyond its capacity go on to the next with room.
    start = own.groupBy("group", F.pmod(F.xxhash64("group", "doc_id"), F.lit(shards)).cast("int").alias("shard")) \
        .agg(F.count("*").alias("n"))
    cells = staged(_fitted(start, capacities), "shard-cells")
    cells = propagate(cells, capacities, rounds)
    filled = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}

    ends = cells.withColumn("end", F.sum("n").over(Window.partitionBy("group").orderBy("shard")))
    ends = ends.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("ends"))
    member = ranked(staged(own, "shard-own"), ["group"], ["doc_id"], "rank").join(ends, "group")
    member = member.withColumn("shard", F.filter("ends", lambda e: e["end"] > F.col("rank"))[0]["shard"])
    alone = ranked(staged(rows.where("group_rows is null"), "shard-alone"), [], ["doc_id", "group"], "rank")
    free = [capacities[s] - filled.get(s, 0) for s in range(shards)]
    until = [sum(free[:s + 1]) for s in range(shards)]
    shard = F.coalesce(*[F.when(F.col("rank") < u, F.lit(s)) for s, u in enumerate(until)])
    alone = alone.withColumn("shard", shard)
    columns = ["doc_id", "size", "text_crc32", "group_rows", "shard"]
    placed = staged(member.select(*columns).unionByName(alone.select(*columns)), "shard-placed")
    return ranked(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.coalesce("group_rows", F.lit(1)).alias("group_rows"))


def _fitted(cells: DataFrame, capacities: list[int]) -> DataFrame:
    """``cells`` with what a shard cannot hold dealt to shards with room."""
    cells = staged(cells, "shard-start")
    loads = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    over = [max(0, loads.get(s, 0) - c) for s, c in enumerate(capacities)]
    if not any(over):
        return cells
    room = [max(0, c - loads.get(s, 0)) for s, c in enumerate(capacities)]
    # One line of all that is too much, laid against one line of all room; both have at most 16 stretches.
    cells = _ahead(cells, ["shard"]).withColumn("end", F.col("ahead") + F.col("n"))
    base = [sum(over[:s]) for s in range(len(over))]
    much = F.greatest(F.lit(0), F.least(F.col("n"), _pick(over, F.col("shard")) - F.col("end") + F.col("n")))
    cells = cells.withColumn("much", much)
    lo = _pick(base, F.col("shard")) + F.col("end") - F.col("n")
    stays = cells.select("group", "shard", (F.col("n") - F.col("much")).alias("n"))
    parts = []
    for s, r in enumerate(room):
        a = sum(room[:s])
        parts.append(F.struct(F.lit(s).alias("shard"), F.greatest(F.lit(0), (
            F.least(lo + F.col("much"), F.lit(a + r)) - F.greatest(lo, F.lit(a)))).alias("n")))
    goes = cells.where("much > 0").select("group", F.explode(F.array(*parts)).alias("p")).select("group", "p.shard", "p.n")
    return stays.unionByName(goes).where("n > 0").groupBy("group", "shard").agg(F.sum("n").alias("n"))
