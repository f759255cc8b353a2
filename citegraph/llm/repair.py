"""Repairing the structure of conversations at the least cost.

The rows of a conversation, by turn, are to give the roles ``(s?(ua)+)?``: at most one system
turn, then user and assistant in turns. A row is kept (0), given another role (2) or deleted
(3), an empty user or assistant turn is put in anywhere (2), a truncated row that stays costs
1 more, a blank or repeated row must go. Of the cheapest edits those whose initials (Delete,
Insert, Keep, Rerole) read least are taken.

*Path ranking.* A node is a place before a row and one of four states: nothing yet, or the
last role was s, u or a. The cost to go of every node comes from a scan from the end. Arcs that
keep to it are optimal, and every node gets its least initial and a pointer along it. Ranks of the
least audits of 1, 2, 4 ... letters follow by doubling: the rank of a node with that of the
node its pointer leads to gives the rank for twice the length, and pointers are
followed by themselves. Ranks choose the arc, and the doubled pointers give the node at every
place of the audit at once. All conversations of a block are worked on together.

*Blocks.* Rows are sorted over the cluster and numbered; ``BLOCK_ROWS`` consecutive ones are
a block, which may hold many conversations or a part of one, so no conversation is too
long. A part that goes on in the next block needs the costs to go from there: the parts
that continue hand back a matrix (state to state, least cost), and a chain of
blocks is multiplied by doubling. The state a part begins in comes forward in the same way, as maps from
state to state. Such tables have a row per block.

Defined results: nulls in role and text read as one space; a null turn sorts first; rows of
one turn sort by role and text; null ids form a conversation of their own; repeated rows
are duplicates; a long conversation is cut as above, its digest is streamed; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citegraph.llm.common import materialize

BLOCK_ROWS = 8192
#: Initials of the edits, in ASCII order, then their costs.
DELETE, INSERT, KEEP, REROLE = "DIKR"
LETTERS = np.array([DELETE, INSERT, KEEP, REROLE])
D_COST, I_COST, R_COST, TRUNCATED_COST = 3, 2, 2, 1
#: More than any sum of costs of rows that a block can have, and no overflow when added thrice.
NEVER = 1 << 60
#: States: nothing yet, after s, after u, after a. The next role put in is a after u, else u.
NEXT = np.array([2, 2, 3, 2])
ROLES = ("", "system", "user", "assistant")
#: Costs to go at the end of a conversation: nothing and a may end it, u lacks one turn, s two.
AT_END = np.array([0, 2 * I_COST, I_COST, 0], np.int64)
INITIALS = "sua"
#: What a row's code says besides its initial: nothing, must go, truncated.
FINE, GONE, CUT = 0, 1, 2
BLANKS, STOPS = " \t\n\x0b\x0c\r", r"[.!?]"


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with faults by a checksum of id and turn: a row is
    dropped, emptied, loses its full stops, is repeated or becomes the user's."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", STOPS, "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def gaps() -> Column:
    """Turns that are missing between the first and the last of a conversation."""
    return F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint")


def _coded(turns: DataFrame, block_rows: int) -> DataFrame:
    """Rows in order with their number ``g``, block, initial and first fault; written once."""
    text_of = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" ")).alias(c)
    rows = turns.select(turns["conv_id"], turns["turn"], text_of("role"), text_of("text"), F.monotonically_increasing_id().alias("tie"))
    # equal rows may be many, so their order is part of the key that deals them out
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "tie")]
    at = F.monotonically_increasing_id()
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    placed = placed.withColumns({"part": F.shiftright(at, 33), "pos": at.bitwiseAND(F.lit((1 << 33) - 1)), "said": said, "last": last}).drop("tie")
    placed = materialize(placed)
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    rows = placed.join(F.broadcast(starts), "part").withColumn("g", F.col("start") + F.col("pos")).drop("part", "pos", "start")
    seen = rows.groupBy("conv_id", "said").agg(F.min("g").alias("first"), F.count("*").alias("n")).where("n > 1")
    seen = seen.select(F.col("conv_id").alias("c"), F.col("said").alias("s"), "first")
    rows = rows.join(seen, rows["conv_id"].eqNullSafe(F.col("c")) & (rows["said"] == F.col("s")), "left")
    fault = F.when(F.col("last") == "", "blank").when(F.col("g") > F.col("first"), "duplicate")
    fault = fault.when(~F.col("last").rlike(STOPS), "truncated")
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS)).cast("int")
    initial = F.when(F.col("role") == "", 0).otherwise(initial)
    return rows.select("conv_id", "role", "text", "g", F.expr(f"g div {block_rows}").alias("block"), initial.alias("initial"), fault.alias("fault"))


def _with_edges(rows: DataFrame, block_rows: int) -> DataFrame:
    """Every block also sees the row before and the row after it, as rows whose ``g`` is outside."""
    place = F.col("g") % block_rows
    seen_by = F.array_compact(
        F.array(F.col("block"), F.when((place == 0) & (F.col("block") > 0), F.col("block") - 1), F.when(place == block_rows - 1, F.col("block") + 1))
    )
    last = rows.agg(F.max("block")).first()[0]
    return rows.withColumn("block", F.explode(seen_by)).where(F.col("block") <= F.lit(last).cast("bigint"))


def costs_to_go(initial: np.ndarray, fault: np.ndarray, ends: np.ndarray, final: np.ndarray) -> np.ndarray:
    """Least cost from every place and state to the end of its part, by a scan from the ends.

    ``ends`` has the slot behind the last row of every row's part; slots are rows in order with one more
    behind each part, ``final`` the costs there (slots x states x kinds of end).
    """
    v = final.copy()
    rows = np.flatnonzero(ends >= 0)
    distance = ends[rows] - rows
    by_distance = np.argsort(distance, kind="stable")
    cuts = np.searchsorted(distance[by_distance], np.arange(1, distance.max(initial=0) + 2))
    for k in range(len(cuts) - 1):
        at = rows[by_distance[cuts[k] : cuts[k + 1]]]
        after, free = v[at + 1], (fault[at] != GONE)[:, None]
        cut = np.where(fault[at] == CUT, TRUNCATED_COST, 0)[:, None]
        base = D_COST + after
        for state in range(4):
            to = NEXT[state]
            stays = np.where(free, R_COST + cut + after[:, to], NEVER)
            kept = np.where(free & (initial[at] == to)[:, None], cut + after[:, to], NEVER)
            if state == 0:
                kept = np.minimum(kept, np.where(free & (initial[at] == 1)[:, None], cut + after[:, 1], NEVER))
            base[:, state] = np.minimum(base[:, state], np.minimum(stays, kept))
        base = np.minimum(base, NEVER)
        u = np.minimum(base[:, 2], I_COST + base[:, 3])
        v[at] = np.minimum(np.stack([np.minimum(base[:, s], I_COST + (base[:, 3] if s == 2 else u)) for s in range(4)], axis=1), NEVER)
    return v


def least_paths(initial: np.ndarray, fault: np.ndarray, ends: np.ndarray, v: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least of the cheapest audits from each node of ``begin`` (slot * 4 + state): for all their letters in
    order the number of the path, the letter's index and the node it leads to. ``v``: slots x states."""
    slots = len(v)
    nodes = np.arange(4 * slots)
    slot, state = nodes >> 2, nodes & 3
    row = ends[slot] >= 0
    after = np.where(row, slot + 1, slot)
    to, cost = NEXT[state], v.ravel()
    free, cut = row & (fault[slot] != GONE), np.where(fault[slot] == CUT, TRUNCATED_COST, 0)
    first = (state == 0) & (initial[slot] == 1)
    kept = np.where(first, 1, to)
    # at an open end nothing is put in: that is the next part's to do
    lacks = row | (ends[slot] == -1)
    targets = np.stack([4 * after + state, 4 * slot + to, 4 * after + kept, 4 * after + to])
    prices = [D_COST, I_COST, cut, R_COST + cut]
    allowed = [row, lacks, free & (first | (initial[slot] == to)), free]
    optimal = np.stack([ok & (cost == price + cost[t]) for ok, price, t in zip(allowed, prices, targets, strict=True)])
    done = ~optimal.any(axis=0)

    letter = optimal.argmax(axis=0)
    pointer = np.where(done, nodes, targets[letter, nodes])
    rank, pointers = np.where(done, 0, letter + 1), [pointer]
    while not done[pointer[begin]].all():
        _, rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)
        pointer = pointer[pointer]
        pointers.append(pointer)
    # now that the ranks are those of whole audits, an arc is chosen by its letter and what follows it
    n = rank.max() + 1
    order = np.where(optimal, np.arange(4)[:, None] * n + rank[targets], 4 * n)
    chosen = order.argmin(axis=0)

    length = np.zeros(len(begin), np.int64)
    at = begin
    for k in reversed(range(len(pointers))):
        further = pointers[k][at]
        # a pointer of 2^k letters that does not end the path has gone all its letters
        goes = ~done[further]
        length += np.where(goes, 1 << k, 0)
        at = np.where(goes, further, at)
    length += ~done[at]
    path = np.repeat(np.arange(len(begin)), length)
    offset = np.arange(len(path)) - np.repeat(np.cumsum(length) - length, length)
    node = begin[path]
    for k, step in enumerate(pointers):
        node = np.where(offset >> k & 1, step[node], node)
    return path, chosen[node], np.where(done[node], node, targets[chosen[node], node])


class Block:
    """Arrays of one block: rows in order, the parts of conversations in it, and slots for the nodes."""

    def __init__(self, rows: pa.Table, number: int, block_rows: int):
        g = rows["g"].to_numpy()
        order = np.argsort(g)
        rows, g = rows.take(pa.array(order)), g[order]
        own = g // block_rows == number
        ids = rows["conv_id"].combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        codes = ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        fresh = np.concatenate([[True], (codes[1:] != codes[:-1]) | (null[1:] != null[:-1])])
        inside = np.flatnonzero(own)
        self.continued = bool(inside[0] > 0 and not fresh[inside[0]])
        self.open = bool(inside[-1] + 1 < len(g) and not fresh[inside[-1] + 1])
        initials = rows["initial"].to_numpy()
        # a pair of neighbours counts with its second row, if both are of one conversation
        before = np.concatenate([[0], initials[:-1]])
        legal = (initials == NEXT[before]) & (before > 0) | fresh
        self.illegal = ~legal[inside]
        self.rows = rows.take(pa.array(inside))
        self.initial = initials[inside]
        names = np.array(self.rows["fault"].to_pylist(), object)
        self.faults = {name: names == name for name in ("blank", "duplicate", "truncated")}
        gone, cut = self.faults["blank"] | self.faults["duplicate"], self.faults["truncated"]
        self.fault = np.where(gone, GONE, np.where(cut, CUT, FINE))
        starts = np.flatnonzero(fresh[inside] | (np.arange(len(inside)) == 0))
        self.starts, self.stops = starts, np.append(starts[1:], len(inside))


def slots_of(initial: np.ndarray, fault: np.ndarray, starts: np.ndarray, stops: np.ndarray, open_end: bool):
    """Rows of parts spread over slots: initial, fault, slot of each row, and ``ends`` (the part's last slot at rows,
    -1 at the end of a conversation, -2 at an open one)."""
    part = np.repeat(np.arange(len(starts)), stops - starts)
    slot = np.arange(len(initial)) + part
    n = len(initial) + len(starts)
    ends = np.full(n, -1)
    ends[slot] = (stops + np.arange(len(starts)))[part]
    if open_end:
        ends[-1] = -2
    spread = lambda x: np.bincount(slot, x, n).astype(np.int64)
    return spread(initial), spread(fault), slot, ends


def _matrix(initial: np.ndarray, fault: np.ndarray) -> list[int]:
    """Least costs of one part from each state before it to each state behind it."""
    i, f, _, ends = slots_of(initial, fault, np.array([0]), np.array([len(initial)]), True)
    final = np.full((len(ends), 4, 4), NEVER, np.int64)
    final[-1, range(4), range(4)] = 0
    return costs_to_go(i, f, ends, final)[0].ravel().tolist()


def _exits(initial: np.ndarray, fault: np.ndarray, beyond: np.ndarray) -> list[int]:
    """The state behind one open part for each state before it, on the least of the cheapest paths."""
    i, f, _, ends = slots_of(initial, fault, np.array([0]), np.array([len(initial)]), True)
    final = np.full((len(ends), 4, 1), NEVER, np.int64)
    final[-1, :, 0] = beyond
    v = costs_to_go(i, f, ends, final)[:, :, 0]
    path, _, node = least_paths(i, f, ends, v, np.arange(4))
    return [int(node[np.flatnonzero(path == s)[-1]] & 3) for s in range(4)]


_SEAM = "block bigint, continued boolean, closes boolean, matrix array<bigint>, open boolean, whole boolean, tail binary"
_STATE = np.dtype(np.int8)


def _seams(rows: DataFrame, block_rows: int) -> DataFrame:
    """A row per block that a conversation enters or leaves: what its neighbours need to know."""

    def seam(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        block = Block(rows, key[0].as_py(), block_rows)
        whole = len(block.starts) == 1
        first, last = (slice(block.starts[k], block.stops[k]) for k in (0, -1))
        matrix = _matrix(block.initial[first], block.fault[first]) if block.continued else None
        tail = (block.initial[last] * 3 + block.fault[last]).astype(_STATE).tobytes() if block.open else None
        row = {
            "block": key[0].as_py(), "continued": block.continued, "closes": not (whole and block.open), "matrix": matrix,
            "open": block.open, "whole": whole and block.continued, "tail": tail,
        }
        kind = pa.schema([("block", pa.int64()), ("continued", pa.bool_()), ("closes", pa.bool_()), ("matrix", pa.list_(pa.int64())), ("open", pa.bool_()), ("whole", pa.bool_()), ("tail", pa.binary())])
        return pa.Table.from_pylist([row] if block.continued or block.open else [], kind)

    narrow = rows.select("block", "g", "conv_id", "initial", "fault")
    return narrow.groupBy("block").applyInArrow(seam, _SEAM)


def _product(a: Column, b: Column) -> Column:
    """Of two matrices of costs, by the least sum."""
    return F.array(*(F.least(*(a[4 * i + k] + b[4 * k + j] for k in range(4)), F.lit(NEVER)) for i in range(4) for j in range(4)))


def _doubled(chain: DataFrame, value: str, done: str, forward: bool, joined) -> DataFrame:
    """Rows of a chain of blocks joined with those 1, 2, 4 ... blocks on until all are done."""
    step = 1
    chain = materialize(chain)
    while not chain.where(f"NOT {done}").isEmpty():
        key = F.col("block") + F.lit(step if forward else -step)
        other = chain.select(key.alias("block"), F.col(value).alias("_value"), F.col(done).alias("_done"))
        met = chain.where(f"NOT {done}").join(other, "block")
        met = met.select("block", joined(F.col(value), F.col("_value")).alias(value), F.col("_done").alias(done))
        chain = materialize(chain.where(done).unionByName(met))
        step *= 2
    return chain


def _handed_over(rows: DataFrame, block_rows: int) -> DataFrame:
    """(block, beyond, entry): costs to go behind an open block, and the state a continued one begins in."""
    seams = materialize(_seams(rows, block_rows))
    chain = _doubled(seams.where("continued").select("block", "matrix", "closes"), "matrix", "closes", False, _product)
    ending = F.array(*(F.least(*(F.col("matrix")[4 * i + j] + int(AT_END[j]) for j in range(4))) for i in range(4)))
    beyond = materialize(chain.select((F.col("block") - 1).alias("block"), ending.alias("beyond")))

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, tails, costs, whole = (c.to_pylist() for c in batch.columns)
            found = []
            for tail, cost, through in zip(tails, costs, whole, strict=True):
                codes = np.frombuffer(tail, _STATE).astype(np.int64)
                to = _exits(codes // 3, codes % 3, np.array(cost))
                found.append(to if through else [to[0]] * 4)
            fixed = [not w for w in whole]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(fixed, pa.bool_())], ["block", "exits", "fixed"])

    leaving = seams.where("open").join(beyond, "block").select("block", "tail", "beyond", "whole")
    out = leaving.mapInArrow(exits, "block bigint, exits array<int>, fixed boolean")
    out = _doubled(out, "exits", "fixed", True, lambda own, before: F.transform(before, lambda s: own[s]))
    entry = out.select((F.col("block") + 1).alias("block"), F.col("exits")[0].alias("entry"))
    return materialize(beyond.join(entry, "block", "full"))


_PART = (
    "conv_id {id}, block bigint, begins boolean, closes boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, edits array<struct<role:string,text:string>>"
)


def repaired_parts(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired conversations of ``turns`` (conv_id, turn, role, text), in parts: a row per conversation
    and block, nearly always one per conversation (``begins`` and ``closes``).

    ``edits`` has the repaired turns of the part, ``audit`` the initials of its edits, ``cost``
    that of the whole conversation, in its first part.
    """
    rows = _with_edges(materialize(_coded(turns, block_rows)), block_rows)
    over = _handed_over(rows, block_rows)

    def repaired(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        block = Block(rows, key[0].as_py(), block_rows)
        known = {c: rows[c][0].as_py() for c in ("beyond", "entry")}
        initial, fault, slot, ends = slots_of(block.initial, block.fault, block.starts, block.stops, block.open)
        final = np.full((len(ends), 4, 1), NEVER, np.int64)
        final[ends == -1, :, 0] = AT_END
        if block.open:
            final[-1, :, 0] = known["beyond"]
        v = costs_to_go(initial, fault, ends, final)[:, :, 0]
        begin = 4 * slot[block.starts]
        if block.continued:
            begin[0] += known["entry"]
        path, letter, node = least_paths(initial, fault, ends, v, begin)
        row_at = np.full(len(ends) + 1, -1)
        row_at[slot] = np.arange(len(slot))
        # an edit that uses up a row leads to the slot behind it
        used = np.where(letter == 1, -1, row_at[(node >> 2) - 1])
        roles, texts = block.rows["role"].to_pylist(), block.rows["text"].to_pylist()
        n, parts = len(block.starts), np.repeat(np.arange(len(block.starts)), block.stops - block.starts)
        cuts = np.searchsorted(path, np.arange(n + 1))
        edits = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            made = []
            for what, at, state in zip(letter[a:b].tolist(), used[a:b].tolist(), (node[a:b] & 3).tolist(), strict=True):
                if what:
                    made.append({"role": roles[at] if what == 2 else ROLES[state], "text": "" if what == 1 else texts[at]})
            edits.append(made)
        told = lambda x: pa.array(np.bincount(parts, x, n).astype(np.int64))
        letters = LETTERS[letter]
        begins, closes = np.ones(n, bool), np.ones(n, bool)
        begins[0], closes[-1] = not block.continued, not block.open
        columns = {
            "conv_id": block.rows["conv_id"].take(pa.array(block.starts)),
            "block": pa.array([key[0].as_py()] * n, pa.int64()), "begins": pa.array(begins), "closes": pa.array(closes),
            **{name: told(x) for name, x in block.faults.items()}, "illegal": told(block.illegal),
            "cost": pa.array(np.where(begins, v.ravel()[begin], 0)),
            "audit": pa.array(["".join(letters[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.string()),
            "edits": pa.array(edits, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
        }
        return pa.table(columns)

    kind = _PART.format(id=turns.schema["conv_id"].dataType.simpleString())
    return rows.join(over, "block", "left").groupBy("block").applyInArrow(repaired, kind)


def conversation_reports(parts: DataFrame) -> DataFrame:
    """One row per conversation from its parts: counts, cost, ``audit`` and ``repaired_sha256`` of its turns as
    lines ``role:text``. The parts of a conversation over several blocks are read in order, one after the other."""
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    lines = F.array_join(F.transform("edits", lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n").alias("lines")
    parts = materialize(parts.select("conv_id", "block", "begins", "closes", *counts, "audit", F.size("edits").alias("n"), lines))
    whole = parts.where("begins AND closes").select("conv_id", *counts, "audit", F.sha2("lines", 256).alias("repaired_sha256"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, audit, digest, any_line = None, [], hashlib.sha256(), False
        for batch in batches:
            for row in batch.to_pylist():
                if row["begins"]:
                    sums, audit, digest, any_line = dict.fromkeys(counts, 0), [], hashlib.sha256(), False
                for c in counts:
                    sums[c] += row[c]
                audit.append(row["audit"])
                if row["n"]:
                    digest.update((b"\n" if any_line else b"") + row["lines"].encode())
                    any_line = True
                if row["closes"]:
                    made = {"conv_id": row["conv_id"], **sums, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                    yield pa.RecordBatch.from_pylist([made], pa.schema([(c, batch.schema.field("conv_id").type if c == "conv_id" else pa.string() if c in ("audit", "repaired_sha256") else pa.int64()) for c in made]))

    long = parts.where("NOT (begins AND closes)").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return whole.unionByName(long.mapInArrow(joined, whole.schema))
