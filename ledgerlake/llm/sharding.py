"""Balanced label propagation: linked documents gather in shards whose counts stay equal.

Shards start balanced. In a round every group of linked documents elects a target among the open shards,
the one with most of its members; members elsewhere that would gain want to move there. Wishes from i to j
are granted against wishes from j to i, then along cycles of more shards, and beyond that against free
documents at the end of a path, which take the places left at its start. So counts never change. A shard
is closed when one group fills it, so a group larger than a shard goes on gathering in the next; and for
one round after none of the wishes for it came true, so that its groups try another.

Large groups gather first: in a phase all documents of groups below its least size count as free, and the
phases go down to pairs. A phase ends when its groups have not come to lie in fewer shards for some rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, numbered, stored, text_of, work_folder

#: Rounds of a phase at most, and without gain; the factor between the least sizes of two phases.
ROUNDS, PATIENCE, PHASE_FACTOR = 16, 3, 8
#: Rounds in which groups elect the shard with most members, before lots are drawn.
SURE_ROUNDS = 2


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("_row", F.lit(17)), F.lit(n))


def _best(counts: str, is_open: list[bool], turn: int) -> Column:
    """(votes, shard) of the open shard a group elects; lots by group and round make all members agree.

    First the one with most members. Later a lottery among the shards with members, by the squares of
    their numbers, so that groups that could not gather where most of them are try where others are.
    """
    choices = []
    for s, room in enumerate(is_open):
        if not room:
            continue
        votes, lot = F.col(counts)[s], F.xxhash64("_group", F.lit(s), F.lit(turn))
        weight = votes.cast("double")
        if turn > SURE_ROUNDS:
            weight = F.when(votes > 0, F.log((F.pmod(lot, F.lit(1 << 20)) + 0.5) / (1 << 20)) / (weight * weight)).otherwise(float("-inf"))
        choices.append(F.struct(weight.alias("weight"), lot.alias("lot"), votes.alias("votes"), F.lit(s).alias("shard")))
    return F.greatest(*choices) if len(choices) > 1 else choices[0]


def _path(edges: list[list[int]], start: int, ends: set[int]) -> list[int] | None:
    """The shards of a shortest path of one edge or more from ``start`` to one of ``ends``."""
    ways, seen = [[start]], set()
    for way in ways:
        for j, n in enumerate(edges[way[-1]]):
            if n and j in ends:
                return [*way, j]
            if n and j not in seen:
                seen.add(j)
                ways.append([*way, j])
    return None


def _grants(wishes: list[list[int]], free: list[int]) -> tuple[list[list[int]], list[list[int]]]:
    """How many of the wishes i -> j come true, and how many free documents go j -> i in return."""
    k = len(free)
    granted = [[min(wishes[i][j], wishes[j][i]) for j in range(k)] for i in range(k)]
    returned = [[0] * k for _ in range(k)]
    left = [[wishes[i][j] - granted[i][j] for j in range(k)] for i in range(k)]
    room = list(free)

    def grant(way: list[int], n: int) -> None:
        for i, j in zip(way, way[1:]):
            granted[i][j] += n
            left[i][j] -= n

    for i in range(k):
        while way := _path(left, i, {i}):
            grant(way, min(left[a][b] for a, b in zip(way, way[1:])))
    for j in range(k):
        for i in sorted(range(k), key=lambda i: -left[i][j]):
            more = min(room[j], left[i][j])
            grant([i, j], more)
            returned[j][i] += more
            room[j] -= more
    for i in range(k):
        while way := _path(left, i, {j for j in range(k) if room[j] and j != i}):
            more = min(room[way[-1]], *(left[a][b] for a, b in zip(way, way[1:])))
            grant(way, more)
            returned[way[-1]][i] += more
            room[way[-1]] -= more
    return granted, returned


def propagate(links: DataFrame, shards: int, folder: str, rounds: int = ROUNDS) -> DataFrame:
    """``links`` (_row long, unique; _group string or null) with ``shard``: counts differ by one at most.

    A document with a null group, or alone in its group, has no links and fills up shards. Only counts
    per shard, and per pair of shards, come to the driver. Rounds are stored in ``folder``.
    """
    buckets = buckets_for(links.count(), least=16)
    sizes = links.filter(F.col("_group").isNotNull()).groupBy("_group").agg(F.count("*").alias("_size")).filter("_size > 1")
    # stored first, as are votes: right after an aggregate, adaptive execution could not split the join at a hot group
    sizes = stored(sizes, folder, "sizes")
    linked = links.join(sizes, "_group", "left").withColumn("_group", F.when(F.col("_size").isNotNull(), F.col("_group")))
    first = numbered(linked.select("_row", "_group", "_size"), [], _bucket(buckets), [F.col("_row")], "_n")
    state = stored(first.select("_row", "_group", "_size", F.pmod("_n", F.lit(shards)).cast("int").alias("shard")), folder, "start")
    least = state.agg(F.max("_size")).first()[0] or 0
    phase = 0
    while least >= 2:
        least = max(2, least // PHASE_FACTOR)
        state = _gathered(state, shards, least, buckets, rounds, folder, phase)
        phase, least = phase + 1, least - (least == 2)
    return state


def _gathered(state: DataFrame, shards: int, least: int, buckets: int, rounds: int, folder: str, phase: int) -> DataFrame:
    """One phase: the state (_row, _group, _size, shard) after groups of ``least`` documents and more have moved."""
    names = ["_row", "_group", "_size", "shard"]
    active = F.coalesce(F.col("_size") >= least, F.lit(False))
    free, rows = [0] * shards, [0] * shards
    for r in state.groupBy("shard").agg(F.count("*").alias("rows"), F.count_if(~active).alias("free")).collect():
        free[r["shard"]], rows[r["shard"]] = r["free"], r["rows"]
    stuck = [False] * shards
    fewest, waited = None, 0

    for turn in range(1, rounds + 1):
        members = state.filter(active)
        votes = members.groupBy("_group").agg(
            F.array(*[F.count(F.when(F.col("shard") == s, 1)) for s in range(shards)]).alias("_votes")
        )
        votes = stored(votes, folder, f"votes{phase}_{turn}")
        held = F.size(F.filter("_votes", lambda v: v > 0))
        found = votes.agg(F.sum(held).alias("held"), *[F.max(F.col("_votes")[s]).alias(f"most{s}") for s in range(shards)]).first()
        fewest, waited = (found["held"], 0) if fewest is None or (found["held"] or 0) < fewest else (fewest, waited + 1)
        full = [(found[f"most{s}"] or 0) >= rows[s] for s in range(shards)]
        if all(a or b for a, b in zip(full, stuck)):
            stuck = [False] * shards
        is_open = [not a and not b for a, b in zip(full, stuck)]
        if not any(is_open) or waited > PATIENCE:
            break
        votes = votes.withColumn("_best", _best("_votes", is_open, turn))
        # lots move members to shards with fewer of them, but not out of a closed one, nor to where there are none
        drawn = F.lit(turn > SURE_ROUNDS) & F.array(*map(F.lit, is_open))[F.col("shard")] & (F.col("_best.votes") > 0)
        wishing = members.join(votes, "_group").select(
            *names,
            F.when(
                (F.col("_best.shard") != F.col("shard")) & ((F.col("_best.votes") >= F.element_at("_votes", F.col("shard") + 1)) | drawn),
                F.col("_best.shard"),
            ).alias("_to"),
            F.floor(F.log2(F.col("_best.votes") + 1)).cast("int").alias("_class"),
        )
        rest = state.filter(~active).select(*names, F.lit(None).cast("int").alias("_to"), F.lit(0).alias("_class"))
        wishing = stored(wishing.unionByName(rest), folder, f"wishes{phase}_{turn}")
        wishes = [[0] * shards for _ in range(shards)]
        for r in wishing.filter(F.col("_to").isNotNull()).groupBy("shard", "_to").count().collect():
            wishes[r["shard"]][r["_to"]] = r["count"]
        granted, returned = _grants(wishes, free)
        was_stuck, stuck = stuck, [any(w[j] for w in wishes) and not any(g[j] for g in granted) for j in range(shards)]
        if not any(map(sum, granted)):
            if any(was_stuck) or any(stuck) or turn <= SURE_ROUNDS and any(map(sum, wishes)):
                continue
            break
        # larger groups first: classes count down
        pool = F.struct((-F.col("_class")).alias("class"), _bucket(buckets).alias("bucket"))
        of_pool = wishing.withColumn("_pool", F.when(active, F.col("_to")).otherwise(-1))
        moving = of_pool.filter(F.col("_pool").isNotNull())
        staying = of_pool.filter(F.col("_pool").isNull()).select(*names)
        ranked = numbered(moving, ["shard", "_pool"], pool, [F.col("_row")], "_rank")
        grant = F.lit(0)
        for i in range(shards):
            for j in range(shards):
                if granted[i][j]:
                    grant = F.when((F.col("shard") == i) & (F.col("_pool") == j), granted[i][j]).otherwise(grant)
        dealt = F.col("shard")
        for j in range(shards):
            at = 0
            for i in range(shards):
                if returned[j][i]:
                    here = (F.col("shard") == j) & F.col("_rank").between(at, at + returned[j][i] - 1)
                    dealt = F.when(here, i).otherwise(dealt)
                    at += returned[j][i]
        after = F.when(F.col("_pool") == -1, dealt).when(F.col("_rank") < grant, F.col("_pool")).otherwise(F.col("shard"))
        moved = ranked.select("_row", "_group", "_size", after.cast("int").alias("shard")).unionByName(staying)
        state = stored(moved, folder, f"round{phase}_{turn}")
        free = [free[s] - sum(returned[s]) + sum(returned[j][s] for j in range(shards)) for s in range(shards)]
    return state


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row: counts at most one apart.

    Documents are linked if their texts are equal; a null text equals the empty one and has one byte.
    Copies stay together as far as a shard holds them. ``slot`` counts a shard's rows from 0. Repeated
    and null ids are rows like any others. The law is ``rows``, so ``grown_shard`` is null. Fewer rows
    than shards leave shards empty. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "shards")
    bytes_ = text_of().cast("binary")
    slim = docs.select(
        "doc_id",
        (F.octet_length(bytes_) + 1).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
        F.sha2(bytes_, 256).alias("_group"),
    )
    slim = stored(slim.withColumn("_row", F.monotonically_increasing_id()), folder, "slim")
    state = propagate(slim.select("_row", "_group"), shards, folder, rounds)
    placed = slim.drop("_group").join(state.select("_row", "shard"), "_row")
    buckets = buckets_for(slim.count(), least=16)
    slots = numbered(placed, ["shard"], _bucket(buckets), [F.col("_row")], "slot")
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
