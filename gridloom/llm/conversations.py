"""Conversation structure repair: cost DP over optimal edits, then ranks of audits by prefix doubling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

#: Rows of a conversation that one task repairs together; longer ones are dealt in segments.
SEGMENT = 4096
#: What a row's fault is called by its number.
FAULTS = ("none", "blank", "duplicate", "truncated")
#: What each edit costs, by its initial in the order of their initials; what an undeleted truncated row adds.
LETTERS = np.frombuffer(b"DIKR", np.uint8)
DELETE, INSERT, KEEP, REROLE = range(4)
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
TRUNCATED_COST = 3
#: Where the roles said so far have come to: nothing, a system turn, a user turn, an assistant turn. It may end at the
#: first and the last. After each: where a system, a user, an assistant turn lead.
STATES = 4
START, SYSTEM, USER, ASSISTANT = range(STATES)
AFTER = np.array([[SYSTEM, USER, -1], [-1, USER, -1], [-1, -1, ASSISTANT], [-1, USER, -1]])
FAR = np.int64(1) << 40
ROLES = np.frombuffer(b"-sua", np.uint8)
BLANK = r"[^\x20\x09-\x0D]"


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) as the contract damages them, by crc32 of ``conv_id:turn`` modulo 20."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    plain = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return plain.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``at``, their place in the order of (conv_id, turn, role, text), nulls first; written out.

    Ranges of that order are dealt over tasks, so one conversation of any length is spread over many. Rows equal in all
    four stand beside each other; among them no order matters.
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "turns")


def fault_of(text: str | Column, is_first: Column) -> Column:
    """0 to 3, as in FAULTS: the first fault of a row, given whether its role and text stand here first."""
    last = F.col(text) if isinstance(text, str) else text
    return (
        F.when(~last.rlike(BLANK), 1).when(~is_first, 2).when(~last.rlike(r"[.!?][\x20\x09-\x0D]*\z"), 3).otherwise(0)
    )


def marked(turns: DataFrame) -> DataFrame:
    """``turns`` with is_first (no earlier row of the conversation has its role and text), initial, fault; written out.

    The first places are a table of their own, combined before the shuffle and joined by place, so neither a
    conversation nor a line that stands a million times comes together in one task.
    """
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    firsts = turns.select("conv_id", said.alias("said"), "at").groupBy("conv_id", "said").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("is_first"))
    found = turns.join(firsts, "at", "left").withColumn("is_first", F.col("is_first").isNotNull())
    code = F.when(F.substring("role", 1, 1) == "s", 0).when(F.substring("role", 1, 1) == "u", 1).when(F.substring("role", 1, 1) == "a", 2).otherwise(3)
    slim = found.select("conv_id", "at", "turn", code.cast("byte").alias("initial"), fault_of("text", F.col("is_first")).cast("byte").alias("fault"))
    return stored(slim, "turn-faults")


# One segment: nodes are (rows done, state), arcs the edits


class Segments:
    """Rows of many segments laid out beside each other; node (i, q) of a segment of n rows, 0 <= i <= n, has the number
    4 * (first + i) + q, where ``first`` leaves each segment a row of nodes more than it has rows.

    Inserts before row i are arcs at i; those behind the last row belong to the next segment, or to the end.
    """

    def __init__(self, initials: list[np.ndarray], faults: list[np.ndarray]):
        sizes = np.array([len(x) for x in initials])
        self.sizes = sizes
        self.first = np.cumsum([0, *(sizes[:-1] + 1)]) if len(sizes) else np.zeros(0, np.int64)
        self.rows = int((sizes + 1).sum())
        initial, fault = np.full(self.rows, 3, np.int64), np.zeros(self.rows, np.int64)
        for at, a, b in zip(self.first, initials, faults, strict=True):
            initial[at : at + len(a)], fault[at : at + len(b)] = a, b
        gone, extra = (fault == 1) | (fault == 2), np.where(fault == 3, TRUNCATED_COST, 0)
        wide = np.concatenate([AFTER, np.full((STATES, 1), -1)], axis=1)
        self.to_keep = np.where(gone[:, None], -1, wide[:, initial].T)
        self.next_role = np.array([USER, USER, ASSISTANT, USER])
        self.cost_row = extra
        self.gone = gone

    def inserted(self, cost: np.ndarray) -> np.ndarray:
        """Costs to go by state (last axis), with inserts at this place: at most two, for a third repeats a state."""
        for _ in range(2):
            cost = np.minimum(cost, cost[..., self.next_role] + COST[INSERT])
        return cost

    def costs(self, last: np.ndarray, backwards: bool = True) -> np.ndarray:
        """Costs to go of every node, (rows, ..., 4), from those at each segment's end (segments, ..., 4)."""
        out = np.full((self.rows, *last.shape[1:]), FAR)
        ends = self.first + self.sizes
        out[ends] = last
        longest = int(self.sizes.max(initial=0))
        for k in range(1, longest + 1):  # all segments a row back at once
            live = self.sizes >= k
            at = ends[live] - k
            after = out[at + 1]
            best = after + COST[DELETE]
            shape = (len(at), *([1] * (after.ndim - 2)), STATES)
            rerole = after[..., self.next_role] + (COST[REROLE] + self.cost_row[at]).reshape(-1, *([1] * (after.ndim - 1)))
            best = np.minimum(best, np.where(self.gone[at].reshape(-1, *([1] * (after.ndim - 1))), FAR, rerole))
            keep = self.to_keep[at].reshape(shape)
            kept = np.take_along_axis(after, np.broadcast_to(np.maximum(keep, 0), after.shape), axis=-1) + self.cost_row[at].reshape(-1, *([1] * (after.ndim - 1)))
            best = np.minimum(best, np.where(keep < 0, FAR, kept))
            out[at] = self.inserted(best)
        return out

    def matrices(self) -> np.ndarray:
        """(segments, from, to): the least cost from each state before a segment to each state behind it."""
        eye = np.where(np.eye(STATES, dtype=bool), 0, FAR)  # to, by state
        found = self.costs(np.broadcast_to(eye, (len(self.sizes), STATES, STATES)).copy())
        return np.minimum(found[self.first].transpose(0, 2, 1), FAR)

    def arcs(self, cost: np.ndarray, is_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(from, letter, to) of the arcs on cheapest paths. Behind a segment's last row only the inserts at the end of
        a conversation (``is_end``) are arcs of it."""
        flat = cost.reshape(-1)
        node = np.arange(self.rows * STATES)
        row, state = node // STATES, node % STATES
        behind = np.zeros(self.rows, bool)
        behind[self.first + self.sizes] = True
        inner = ~behind[row]
        may_insert = np.ones(self.rows, bool)
        may_insert[(self.first + self.sizes)[~is_end]] = False
        out = []
        keep = self.to_keep[row, state]
        for letter, ok, to, price in (
            (DELETE, inner, node + STATES, COST[DELETE]),
            (INSERT, may_insert[row], row * STATES + self.next_role[state], COST[INSERT]),
            (KEEP, inner & (keep >= 0), (row + 1) * STATES + np.maximum(keep, 0), self.cost_row[row]),
            (REROLE, inner & ~self.gone[row], (row + 1) * STATES + self.next_role[state], COST[REROLE] + self.cost_row[row]),
        ):
            to = np.minimum(to, len(flat) - 1)
            best = ok & (flat < FAR) & (flat[to] + price == flat)
            out.append((node[best], np.full(int(best.sum()), letter), to[best]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def rank(self, arcs: tuple[np.ndarray, np.ndarray, np.ndarray], longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(the arc of each node's least audit, -1 at ends; by power of two the node that many letters on).

        Ranks order nodes by the first 1, 2, 4, ... letters of their least audit, a path's end before every letter: the
        rank over twice as many letters is that of the pair (own rank, rank of the node to which the first half leads).
        The arcs of a node have different letters, so its least first half leads to one node. The last ranks choose
        among a node's arcs by (letter, rank of where it leads).
        """
        start, letter, to = arcs
        n = self.rows * STATES
        first = np.full(n, -1)
        order = np.lexsort((letter, start))
        lead = np.ones(len(order), bool)
        lead[1:] = start[order][1:] != start[order][:-1]
        first[start[order][lead]] = order[lead]
        on = first >= 0
        rank = np.where(on, letter[np.maximum(first, 0)] + 1, 0) if len(letter) else np.zeros(n, np.int64)
        jump = np.where(on, to[np.maximum(first, 0)], np.arange(n)) if len(to) else np.arange(n)
        jumps, length = [jump], 1
        while length < longest:
            rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + rank[jump], return_inverse=True)[1]
            jump = jump[jump]
            jumps.append(jump)
            length *= 2
        if len(start):
            order = np.lexsort((rank[to], letter, start))
            lead[1:] = start[order][1:] != start[order][:-1]
            first[start[order][lead]] = order[lead]
        return first, jumps

    def paths(self, entry: np.ndarray, jumps: list[np.ndarray], first: np.ndarray) -> list[np.ndarray]:
        """The nodes of the least path from each entry node, its end included: those known are doubled a step."""
        found = entry[:, None]
        for jump in jumps:
            found = np.concatenate([found, jump[found]], axis=1)
        out = []
        for row in found:
            ends = np.flatnonzero(first[row] < 0)
            out.append(row[: int(ends[0]) + 1] if len(ends) else row)
        return out


def end_costs() -> np.ndarray:
    """Costs to go behind the last row of a conversation."""
    cost = np.array([0, FAR, FAR, 0])
    role = np.array([USER, USER, ASSISTANT, USER])
    for _ in range(2):
        cost = np.minimum(cost, cost[role] + COST[INSERT])
    return cost


def segments_of(batches: Iterator[pa.RecordBatch], names: list[str], size: int) -> Iterator[tuple[str, dict[str, np.ndarray]]]:
    """(conversation, its columns) of runs of rows of one conversation with consecutive places, of ``size`` rows at most;
    rows come in order."""
    held: list[tuple[str, dict[str, np.ndarray]]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = np.asarray(batch.column("conv_key").to_pylist(), object)
        columns = {x: batch.column(x).to_numpy(zero_copy_only=False) for x in names}
        new = (conv[1:] != conv[:-1]) | (np.diff(columns["at"]) != 1)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(conv)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = {x: v[a:b] for x, v in columns.items()}
            if not held or held[-1][0] != conv[a] or held[-1][1]["at"][-1] + 1 != own["at"][0]:
                yield from joined(held)
                held = []
            held.append((conv[a], own))
            while held and sum(len(v["at"]) for _, v in held) > size:
                whole = {x: np.concatenate([v[x] for _, v in held]) for x in names}
                yield held[0][0], {x: v[:size] for x, v in whole.items()}
                held = [(held[0][0], {x: v[size:] for x, v in whole.items()})]
    yield from joined(held)


def joined(held: list) -> Iterator:
    if held:
        yield held[0][0], {x: np.concatenate([v[x] for _, v in held]) for x in held[0][1]}


SLIM = "conv_key string, seg long, initials binary, faults binary, costs array<long>, inner long"
#: Node rows that are worked on beside each other.
TOGETHER = 1 << 15
LEGAL = np.zeros((4, 4), bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au


def grouped(found: Iterator, size_of) -> Iterator[list]:
    """Lists of neighbours of which the largest times their number stays below TOGETHER, one at least."""
    group, largest = [], 0
    for one in found:
        largest = max(largest, size_of(one) + 1)
        if group and largest * (len(group) + 1) > TOGETHER:
            yield group
            group, largest = [], size_of(one) + 1
        group.append(one)
    if group:
        yield group


def segmented(slim: DataFrame, size: int) -> DataFrame:
    """(conv_key, seg, initials, faults, costs, inner): runs of rows, the matrix of least costs from each state before to
    each state behind, and how many neighbours are none of su, ua, au; ``seg`` is the first row's place."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = segments_of(batches, ["at", "initial", "fault"], size)
        for group in grouped(found, lambda one: len(one[1]["at"])):
            initials = [v["initial"].astype(np.int8) for _, v in group]
            costs = Segments(initials, [v["fault"] for _, v in group]).matrices().reshape(len(group), -1)
            yield pa.RecordBatch.from_arrays([
                pa.array([c for c, _ in group], pa.string()), pa.array([int(v["at"][0]) for _, v in group], pa.int64()),
                pa.array([x.tobytes() for x in initials], pa.binary()), pa.array([v["fault"].astype(np.int8).tobytes() for _, v in group], pa.binary()),
                pa.array(costs.tolist(), pa.list_(pa.int64())), pa.array([int((~LEGAL[x[:-1], x[1:]]).sum()) for x in initials], pa.int64()),
            ], ["conv_key", "seg", "initials", "faults", "costs", "inner"])

    return slim.mapInArrow(pack, SLIM)


def boundaries(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
    """For each segment of a conversation the costs to go behind it. A row a segment, so a conversation of as many rows as
    an audit can have letters comes to half a million small rows."""
    found = found.sort_values("seg", ignore_index=True)
    cost, out = end_costs(), []
    for m in reversed(found["costs"].tolist()):
        out.append(cost.tolist())
        cost = np.minimum((np.asarray(m, np.int64).reshape(STATES, STATES) + cost).min(axis=1), FAR)
    out.reverse()
    n = len(out)
    return pd.DataFrame({"conv_key": found["conv_key"], "seg": found["seg"], "behind": out, "is_first": [True] + [False] * (n - 1), "is_last": [False] * (n - 1) + [True]})


BEHIND = "conv_key string, seg long, behind array<long>, is_first boolean, is_last boolean"
OPTIONS = "conv_key string, seg long, is_first boolean, option int, exit int, cost long, audit string, targets string"


def explored(segments: DataFrame) -> DataFrame:
    """(conv_key, seg, is_first, option, exit, cost, audit, targets): for each state before a segment (``option``; only the
    start before the first) the state behind it, the cost to go and the edits of the least audit; ``targets`` has a
    role's initial for each edit that leaves a turn, else ``-``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        for group in grouped(rows, lambda r: len(r["initials"])):
            own = Segments(*[[np.frombuffer(r[x], np.int8) for r in group] for x in ("initials", "faults")])
            cost = own.costs(np.array([r["behind"] for r in group], np.int64))
            arcs = own.arcs(cost, np.array([r["is_last"] for r in group]))
            letters = arcs[1]
            first, jumps = own.rank(arcs, 3 * (int(own.sizes.max()) + 1))
            wanted = [(r, q, int(at) * STATES + q) for r, at in zip(group, own.first, strict=True) for q in (range(1) if r["is_first"] else range(STATES))]
            out: list[tuple] = []
            for (r, q, node), path in zip(wanted, own.paths(np.array([x[2] for x in wanted]), jumps, first), strict=True):
                edits = letters[first[path[:-1]]]
                roles = np.where(edits == DELETE, ord("-"), ROLES[path[1:] % STATES]).astype(np.uint8)
                out.append((r["conv_key"], r["seg"], r["is_first"], q, int(path[-1] % STATES), int(cost.reshape(-1)[node]), LETTERS[edits].tobytes().decode(), roles.tobytes().decode()))
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in OPTIONS.split(", ")])

    return segments.mapInArrow(run, OPTIONS)


def entries(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
    """The state in which the least path comes to each segment of a conversation; four small rows a segment."""
    state, out = START, []
    for seg, own in found.groupby("seg", sort=True):
        exits = dict(zip(own["option"], own["exit"], strict=True))
        out.append((found["conv_key"].iloc[0], seg, state))
        state = int(exits[state])
    return pd.DataFrame(out, columns=["conv_key", "seg", "option"])


def conv_key(column: str = "conv_id") -> Column:
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def repair(rows: DataFrame, size: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """(edits, repaired) of conversations (conv_id, turn, role, text), taken by turn, nulls first.

    ``edits`` has a row a conversation: conv_key, gaps, blank, duplicate, truncated, illegal, cost, audit. ``repaired`` has
    the rows that are left: conv_key, (seg, nth), their order, role, text.

    Costs first: rows become a byte each, and segments of ``size`` rows give a matrix of least costs between the four
    states in which the roles said so far can be; matrices of a conversation are chained, so each segment knows the costs
    to go behind it. Then each segment ranks the nodes of its cheapest edits (`Segments.rank`) and finds the least audit
    from each state before it; the states are chained from the start. A conversation of one segment, as nearly all
    are, needs neither chain.
    """
    spark = rows.sparkSession
    turns = ordered(rows)
    keyed = marked(turns).withColumn("conv_key", conv_key())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.select("conv_key", "at", "initial", "fault").repartitionByRange(parts, "at").sortWithinPartitions("at")
    packed = stored(segmented(dealt, size), "segments")
    alone = packed.groupBy("conv_key").agg(F.count("*").alias("segments"))
    many = packed.join(alone.where("segments > 1"), "conv_key")
    chained = many.select("conv_key", "seg", "costs").groupBy("conv_key").applyInPandas(boundaries, BEHIND)
    single = packed.join(alone.where("segments = 1"), "conv_key").select(
        "conv_key", "seg", F.array(*[F.lit(int(x)).cast("long") for x in end_costs()]).alias("behind"), F.lit(True).alias("is_first"), F.lit(True).alias("is_last"))
    behind = chained.unionByName(single)
    options = stored(explored(packed.select("conv_key", "seg", "initials", "faults").join(behind, ["conv_key", "seg"])), "segment-options")
    several = options.join(alone.where("segments > 1"), "conv_key").select("conv_key", "seg", "option", "exit")
    chosen = several.groupBy("conv_key").applyInPandas(entries, "conv_key string, seg long, option int")
    ones = options.join(alone.where("segments = 1"), "conv_key").select("conv_key", "seg", "option")
    least = stored(options.join(chosen.unionByName(ones), ["conv_key", "seg", "option"]), "segment-edits")
    audits = least.groupBy("conv_key").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"), F.max(F.when(F.col("is_first"), F.col("cost"))).alias("cost"))
    faults = keyed.groupBy("conv_key").agg(
        F.count_if(F.col("fault") == 1).alias("blank"), F.count_if(F.col("fault") == 2).alias("duplicate"), F.count_if(F.col("fault") == 3).alias("truncated"),
        (F.max("turn").cast("long") - F.min("turn").cast("long") + 1).alias("span"))
    turns_there = keyed.where("turn is not null").groupBy("conv_key", "turn").agg(F.lit(1).alias("one")).groupBy("conv_key").agg(F.count("*").alias("there"))
    edits = (
        faults.join(turns_there, "conv_key", "left").join(illegal(packed), "conv_key").join(audits, "conv_key")
        .select("conv_key", F.coalesce(F.col("span") - F.col("there"), F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    )
    lines = left_over(least)
    kept = lines.where("at is not null").join(turns.select("at", F.col("role").alias("own_role"), "text"), "at")
    name = F.when(F.col("to") == "u", "user").when(F.col("to") == "a", "assistant")
    repaired = kept.select("conv_key", "seg", "nth", F.when(F.col("letter") == "R", name).otherwise(F.col("own_role")).alias("role"), "text").unionByName(
        lines.where("at is null").select("conv_key", "seg", "nth", name.alias("role"), F.lit("").alias("text")))
    return edits, repaired


def illegal(packed: DataFrame) -> DataFrame:
    """(conv_key, illegal): neighbours whose initials are none of su, ua, au, within segments and between them."""
    in_order = Window.partitionBy("conv_key").orderBy("seg")  # a small row a segment
    code = lambda at: F.hex(F.substring("initials", at, 1))
    ends = packed.select("conv_key", "inner", code(-1).alias("last"), F.lead(code(1)).over(in_order).alias("next"))
    legal = F.concat("last", "next").isin("0001", "0102", "0201")
    return ends.groupBy("conv_key").agg((F.sum("inner") + F.count_if(F.col("next").isNotNull() & ~legal)).alias("illegal"))


def left_over(least: DataFrame) -> DataFrame:
    """(conv_key, seg, nth, at, letter, to): the turns that a segment's edits leave, by their order in the segment; ``at``
    is the place of the row that is kept or gets another role, null where a turn is inserted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        for group in grouped(rows, lambda r: len(r["audit"])):
            audits = [np.frombuffer(r["audit"].encode(), np.uint8) for r in group]
            stays = [np.flatnonzero(x != ord("D")) for x in audits]
            inserts = [x[i] == ord("I") for x, i in zip(audits, stays, strict=True)]
            places = [r["seg"] + (np.cumsum(x != ord("I")) - 1)[i] for r, x, i in zip(group, audits, stays, strict=True)]
            number = np.repeat(np.arange(len(group)), [len(x) for x in stays])
            take = lambda x: np.concatenate([np.zeros(0, np.int64), *x])
            show = lambda x: pa.array([chr(int(c)) for c in take(x)], pa.string())
            targets = [np.frombuffer(r["targets"].encode(), np.uint8)[i] for r, i in zip(group, stays, strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array([r["conv_key"] for r in group], pa.string()).take(pa.array(number)), pa.array([r["seg"] for r in group], pa.int64()).take(pa.array(number)),
                pa.array(take(stays), pa.int64()), pa.array(take(places), pa.int64(), mask=take(inserts).astype(bool)), show([x[i] for x, i in zip(audits, stays, strict=True)]), show(targets),
            ], ["conv_key", "seg", "nth", "at", "letter", "to"])

    return least.select("conv_key", "seg", "audit", "targets").mapInArrow(run, "conv_key string, seg long, nth long, at long, letter string, to string")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_key, repaired_sha256): of the lines ``role:text`` of each conversation in order. A digest is one pass over the
    lines; they stream through a task in order, none is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hashed = None, None
        done: list[tuple[str, str]] = []
        for batch in batches:
            for key, role, text in zip(*[batch.column(x).to_pylist() for x in ("conv_key", "role", "text")], strict=True):
                if hashed is None or key != own:
                    if hashed is not None:
                        done.append((own, hashed.hexdigest()))
                    own, hashed = key, hashlib.sha256()
                else:
                    hashed.update(b"\n")
                hashed.update(role.encode() + b":" + text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.string()) for i in (0, 1)], ["conv_key", "repaired_sha256"])
                done = []
        if hashed is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own]), pa.array([hashed.hexdigest()])], ["conv_key", "repaired_sha256"])

    in_order = repaired.repartition("conv_key").sortWithinPartitions("conv_key", "seg", "nth")
    return in_order.select("conv_key", "role", "text").mapInArrow(run, "conv_key string, repaired_sha256 string")


def repaired_digests(originals: DataFrame, rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """A row for every conv_id of ``originals`` with the findings, edits and digest of its ``rows``; one that has no rows
    left has zeros, an empty audit and the digest of the empty string."""
    edits, repaired = repair(rows, size)
    found = edits.join(digests(repaired), "conv_key", "left")
    every = originals.select("conv_id").distinct().withColumn("conv_key", conv_key())
    nothing = hashlib.sha256(b"").hexdigest()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, "conv_key", "left").select(
        "conv_id", *[F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repaired_digests(rows, damaged(rows))
