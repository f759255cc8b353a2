"""Near-duplicates by an LSH forest over MinHash signatures.

A document is the set of its distinct four-word shingles. Documents with equal sets are one
node. A node's signature of ``HASHES`` minima is read in ``ORDERS`` different orders, and in
each the nodes are sorted by it: nodes with a common prefix stand together. A region of an
order is what shares a prefix of ``DEPTHS[0]`` values; a region of more than ``WIDE`` nodes
is cut by the next depth, and so on, so depth follows how crowded a region is.

Candidates are neighbours in these orders, in rounds. In each a node is held against the
centre of its region, at every depth, and against its predecessor in the sorted order, but
only while they are in different components, and of these one partner whose signature is
similar enough is confirmed on the full sets. Regions within one component are done.
The last round is complete: all pairs across the components of each region of the first
depth, in blocks, but for those that cannot be linked because too many shingles of one are
rare, and all pairs that share a rare one. So a group of copies of any size takes a few
linear rounds, no link between components is skipped for size, and only texts of different
components that share a region and most of their shingles with many others are compared
pair by pair.

A pair of similarity 0.8 shares a region at the first depth with probability
1 - (1 - 0.8 ** 4) ** 24 > 0.99999. Pairs whose signatures agree in less than ``LIKELY`` of the
minima are not confirmed; a pair of similarity 0.8 falls below that with probability 1e-6.

Components are found by passing the smallest label along links, with pointer jumping.

Defined results: null, empty and wordless texts are components of their own; a document
with fewer than four words is one shingle, its whole sequence; repeated rows are copies;
rows of one id and different texts are compared alone, and a component is named by its
smallest id; a null id is never the name of a component with other ids; tables may be
empty; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citegraph.llm.common import materialize
from citegraph.plans.materialize import broadcast_if_small

#: Words of a shingle, unless a caller names another number, of at most five.
SHINGLE = 5
HASHES, ORDERS = 96, 24
DEPTHS = (4, 8, 12)
WIDE = 64
#: Of the minima, below the similarity of a link by five standard deviations.
LIKELY = 0.6
#: Of the minima, above the similarity of a link by two standard deviations.
SURE = 0.88
#: A link: 100 * common >= PERCENT * union.
PERCENT = 80
#: At most so many linear rounds before the complete one.
ROUNDS = 2
#: Words whose hashes a task remembers, about 200 bytes each.
REMEMBERED_WORDS = 50_000

_SEEDS = np.random.default_rng(2024)
_MULTIPLY = _SEEDS.integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_ADD = _SEEDS.integers(0, 1 << 32, HASHES, dtype=np.uint32)
#: Each order starts with values that no other order starts with.
_READ = np.stack([np.roll(np.arange(HASHES), -DEPTHS[0] * i)[: DEPTHS[-1]] for i in range(ORDERS)])
_WORD_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _WordHashes(dict):
    """64-bit hashes of the words of a task, the last ``REMEMBERED_WORDS`` of them at most remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = made = xxhash.xxh64_intdigest(word)
        return made


def shingles(text: str | None, words: _WordHashes, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; A-Z count as a-z."""
    hashes = np.fromiter(map(words.__getitem__, (text or "").encode("utf-8", "surrogatepass").lower().split()), np.uint64)
    if not len(hashes):
        return hashes
    k = min(shingle, len(hashes))
    mixed = np.full(len(hashes) - k + 1, k, np.uint64)
    for i in range(k):
        mixed += hashes[i : len(hashes) - k + 1 + i] * _WORD_FACTORS[i]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(hashes: np.ndarray) -> np.ndarray:
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    found = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(found, (short[at : at + 2048, None] * _MULTIPLY + _ADD).min(axis=0), out=found)
    return found


def sketch(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, digest`` (of the set; null if empty) and ``signature`` per document.

    ``text_key`` tells apart the texts of one id.
    """
    names = ["doc_id", "text_key", "n_shingles", "digest", "signature"]

    def make(batches):
        words = _WordHashes()
        for batch in batches:
            rows = []
            for text in batch.column(1):
                s = shingles(text.as_py(), words, shingle)
                rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), signature(s).tobytes()) if len(s) else (0, None, None))
            n, digest, made = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(make, "doc_id bigint, text_key bigint, n_shingles bigint, digest binary, signature binary")


def forest(nodes: DataFrame) -> DataFrame:
    """Per node and order a row: ``node`` and ``prefixes``, a 64-bit key of the order's prefix at each depth."""

    def plant(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            made = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, HASHES)
            read = made[:, _READ].astype(np.uint64)  # node, order, depth
            key = np.broadcast_to(np.arange(1, ORDERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), read.shape[:2]).copy()
            keys = []
            for d in range(DEPTHS[-1]):
                key = (key ^ read[:, :, d]) * np.uint64(0xBF58476D1CE4E5B9)
                key ^= key >> np.uint64(31)
                if d + 1 in DEPTHS:
                    keys.append(key.copy())
            flat = np.stack(keys, axis=2).reshape(-1).astype(np.int64)
            prefixes = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, len(DEPTHS), dtype=np.int32), pa.array(flat))
            node = pa.array(np.repeat(batch.column(0).to_numpy(), ORDERS))
            yield pa.RecordBatch.from_arrays([node, prefixes], names=["node", "prefixes"])

    return nodes.select("node", "signature").mapInArrow(plant, "node bigint, prefixes array<bigint>")


def regions(nodes: DataFrame) -> DataFrame:
    """``region, node, depth, label, size, final`` of every region of two nodes or more.

    Each depth is one combined count of its prefixes; only rows of wide regions go deeper.
    ``final`` marks the deepest region of a node in an order, ``label`` sorts it there.
    """
    first = forest(nodes).select(F.col("prefixes")[0].alias("region"), "node")
    sizes = materialize(first.groupBy("region").agg(F.count("*").alias("size")).where("size > 1"))
    inside = materialize(first.join(sizes, "region", "left_semi").select("node").distinct())
    trees, found = forest(nodes.join(inside, "node")), None
    for i, depth in enumerate(DEPTHS):
        trees = trees.withColumn("region", F.col("prefixes")[i])
        if i:
            sizes = trees.groupBy("region").agg(F.count("*").alias("size")).where("size > 1")
        rows = materialize(trees.join(sizes, "region"))
        last = i == len(DEPTHS) - 1
        wide = F.lit(False) if last else F.col("size") > WIDE
        label = F.col("prefixes")[len(DEPTHS) - 1]
        level = rows.select("region", "node", F.lit(depth).alias("depth"), label.alias("label"), "size", (~wide).alias("final"))
        found = level if found is None else found.unionByName(level)
        if last or rows.where(wide).isEmpty():
            return found
        trees = rows.where(wide).select("node", "prefixes")


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, other, alike`` (equal minima), ``crowd_other`` of the pairs whose set sizes and signatures allow a link."""

    @F.arrow_udf("int")
    def equal(a: pa.Array, b: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.int32())
        left, right = (np.frombuffer(b"".join(x.to_pylist()), np.uint32).reshape(-1, HASHES) for x in (a, b))
        return pa.array((left == right).sum(1), pa.int32())

    taken = {"n": "n_shingles", "s": "signature", "crowd": "crowd"}
    of = lambda side: nodes.select(F.col("node").alias(side), *(F.col(c).alias(f"{k}_{side}") for k, c in taken.items()))
    rows = pairs.join(of("node"), "node").join(of("other"), "other")
    rows = rows.where(100 * F.least("n_node", "n_other") >= PERCENT * F.greatest("n_node", "n_other"))
    # else the filter would have it computed once more
    rows = rows.withColumn("alike", equal.asNondeterministic()("s_node", "s_other"))
    return rows.where(F.col("alike") >= LIKELY * HASHES).select("node", "other", "alike", "crowd_other")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, link``: whether the full sets are similar enough."""

    @F.arrow_udf("boolean")
    def confirm(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b, strict=True):
            left, right = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
            at = np.searchsorted(left, right)
            at[at == len(left)] = 0
            common = int((left[at] == right).sum())
            out.append(100 * common >= PERCENT * (len(left) + len(right) - common))
        return pa.array(out, pa.bool_())

    of = lambda side: sets.select(F.col("node").alias(side), F.col("hashes").alias(f"h_{side}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", confirm("h_a", "h_b").alias("link"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reached) of every node with a link.

    A round takes the smallest label of the neighbours and then follows labels twice, so
    paths shrink by more than half. Labels are broadcast while they are counted to be few.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component"))
    labels = materialize(labels)
    while True:
        known = broadcast_if_small(labels)
        of = lambda key, name: known.select(F.col("node").alias(key), F.col("component").alias(name))
        near = both.join(of("b", "near"), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        moved = near.join(of("node", "old"), "node").select("node", "old", F.least("old", "near").alias("first"))
        moved = moved.join(of("first", "second"), "first").join(of("second", "third"), "second")
        new = materialize(moved.select("node", "old", F.col("third").alias("component")))
        labels = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            return labels


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node, component`` after further links; only components that they join are followed."""
    if labels is None:
        return components(links)
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    alone = ends.join(labels, "node", "left_anti").withColumn("component", F.col("node"))
    every = materialize(labels.unionByName(alone))
    known = broadcast_if_small(every)
    of = lambda side: known.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    between = links.join(of("a"), "a").join(of("b"), "b").where("c_a <> c_b")
    joined = components(materialize(between.select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))))
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("name"))
    named = every.join(broadcast_if_small(joined), "component", "left")
    return materialize(named.select("node", F.coalesce("name", "component").alias("component")))


def _needed_sets(docs: DataFrame, reps: DataFrame, shingle: int) -> DataFrame:
    """``node, hashes`` (the full set) of the nodes in ``reps`` (``node, doc_id, digest``)."""

    def make(batches):
        words = _WordHashes()
        for batch in batches:
            sets = [shingles(t.as_py(), words, shingle).tobytes() for t in batch.column(2)]
            found = [xxhash.xxh3_128_digest(s) == d.as_py() for s, d in zip(sets, batch.column(1), strict=True)]
            made = pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "hashes"])
            yield made.filter(pa.array(found, pa.bool_()))

    wanted = broadcast_if_small(materialize(reps.select("doc_id", "digest", "node")))
    rows = docs.select(F.col("doc_id").alias("_id"), "text").join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")))
    rows = rows.select("node", "digest", "text")
    return rows.mapInArrow(make, "node bigint, hashes binary").dropDuplicates(["node"])


def _turn(number: int, node: str, crowd: str) -> Column:
    """Sorts centres: at first nodes by the crowd around them, since what many texts are copies
    of is alike to most of them; later by a hash that changes with the round."""
    return -F.col(crowd) if number == 0 else F.xxhash64(node, F.lit(number))


def _nearby(rows: DataFrame, number: int) -> DataFrame:
    """``node, other``: partners in other components, centres of regions and predecessors in the order."""
    centre = F.struct(_turn(number, "node", "crowd").alias("turn"), F.col("node"), F.col("component"))
    state = rows.groupBy("region").agg(F.min(centre).alias("centre"), (F.min("component") < F.max("component")).alias("open"))
    opened = rows.join(state.where("open").select("region", "centre"), "region")
    centres = opened.where(F.col("component") != F.col("centre.component")).select("node", F.col("centre.node").alias("other"))
    beside = Window.partitionBy("region").orderBy("label", "node")
    near = opened.where(F.col("final") & (F.col("size") <= WIDE))
    near = near.withColumns({"other": F.lag("node").over(beside), "_c": F.lag("component").over(beside)})
    return centres.union(near.where(F.col("_c") != F.col("component")).select("node", "other"))


def _partners(likely: DataFrame, number: int) -> DataFrame:
    """``node, other``: the candidate that a node is confirmed with in this round.

    Of candidates that are surely alike, the one that others choose too, so that links
    form stars; else the most similar one.
    """
    sure = F.col("alike") >= SURE * HASHES
    turn = F.when(sure, -_turn(number, "other", "crowd_other").cast("decimal(20,0)"))
    best = F.max(F.struct(sure.alias("sure"), turn.alias("turn"), F.col("alike"), F.col("other"))).alias("best")
    return likely.groupBy("node").agg(best).select("node", F.col("best.other").alias("other"))


def _rare_shingles(sets: DataFrame) -> DataFrame:
    """``shingle, node, holders`` of the shingles that at most ``WIDE`` nodes of ``sets`` have."""

    def spread(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [np.frombuffer(v.as_py(), np.int64) for v in part.column(1)]
                node = np.repeat(part.column(0).to_numpy(), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(node)], names=["shingle", "node"])

    every = sets.select("node", "hashes").mapInArrow(spread, "shingle bigint, node bigint")
    held = every.groupBy("shingle").agg(F.count("*").alias("holders")).where(F.col("holders") <= WIDE)
    return materialize(every.join(held, "shingle"))


def _across(rows: DataFrame, sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """``node, other``: the pairs of different components in a region that may be linked.

    Two nodes have a rare shingle in common, one that few nodes of open regions have, or none.
    Pairs of the first kind come from the nodes of each rare shingle. What a pair of the
    second kind shares is at most what either has besides its rare shingles; pairs which that
    keeps from being linked are not made. One of a pair is outside its region's largest
    component, so a region that is nearly one component has few pairs. The members are cut
    into blocks of about ``WIDE``. Of the regions that a pair shares, the smallest one makes it.
    """
    counts = rows.groupBy("region", "component").agg(F.count("*").alias("n"))
    state = counts.groupBy("region").agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("kinds"))
    state = materialize(state.where("kinds > 1").select("region", F.col("most.component").alias("largest")))
    opened = materialize(rows.join(state, "region"))
    inside = materialize(opened.select("node", "component").distinct())
    rare = _rare_shingles(sets.join(inside, "node", "left_semi"))
    per_node = rare.groupBy("node").agg(F.count_if(F.col("holders") == 1).alias("own"), F.count("*").alias("rare"))
    known = sizes.select("node", "n_shingles").join(inside, "node").join(per_node, "node", "left")
    known = known.select(
        "node",
        "component",
        F.col("n_shingles").alias("n"),
        (F.col("n_shingles") - F.coalesce("own", F.lit(0))).alias("shared"),
        (F.col("n_shingles") - F.coalesce("rare", F.lit(0))).alias("common"),
    )
    # a set that shares too little to be linked with a set as large as what it shares
    known = materialize(known.where(100 * F.col("shared") >= PERCENT * F.col("n")))

    def possible(left: str, right: str) -> Column:
        most = F.least(left, right)
        return 100 * most >= PERCENT * (F.col("n") + F.col("_n") - most)

    mine = broadcast_if_small(known)
    holders = rare.where("holders > 1").select("shingle", "node").join(mine.select("node", "component", "n", "shared"), "node")
    others = holders.select(
        "shingle", F.col("node").alias("other"), F.col("component").alias("_c"), F.col("n").alias("_n"), F.col("shared").alias("_s")
    )
    apart = (F.col("component") != F.col("_c")) & (F.col("node") < F.col("other"))
    by_shingle = holders.join(others, "shingle").where(apart & possible("shared", "_s")).select("node", "other")

    large = known.where(100 * F.col("common") >= PERCENT * F.col("n")).select("node", "n", "common")
    members = opened.join(broadcast_if_small(materialize(large)), "node")
    # a node is in one region of each order at most
    lower = Window.partitionBy("node").orderBy("region").rowsBetween(Window.unboundedPreceding, -1)
    members = materialize(members.withColumn("lower", F.collect_list("region").over(lower)))
    blocks = F.ceil(F.col("size") / WIDE).cast("int")
    outside = members.where(F.col("component") != F.col("largest")).select(
        "region", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "node", "component", "n", "common", "lower"
    )
    everyone = members.select(
        "region",
        F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"),
        F.col("node").alias("other"),
        F.col("component").alias("_c"),
        F.col("n").alias("_n"),
        F.col("common").alias("_s"),
        F.col("lower").alias("_lower"),
        (F.col("component") == F.col("largest")).alias("in_largest"),
    )
    apart = (F.col("component") != F.col("_c")) & (F.col("in_largest") | (F.col("node") < F.col("other")))
    first = ~F.arrays_overlap("lower", "_lower")
    by_region = outside.join(everyone, ["region", "block"]).where(apart & possible("common", "_s") & first).select("node", "other")
    return by_shingle.union(by_region)


def _named(documents: DataFrame, nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    of = nodes.select("node", "digest", "doc_id").withColumn("component", F.col("node"))
    if labels is not None:
        of = of.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = of.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = of.join(names, "component").select("digest", "component", "component_id")
    out = documents.join(broadcast_if_small(materialize(named)), "digest", "left")
    name = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.col("doc_id").eqNullSafe(name)
    return out.select("doc_id", "n_shingles", name.alias("component_id"), kept.alias("kept"), "text_key", "component")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_key, component`` per row of ``docs`` (``doc_id, text``).

    ``component`` is a number of the component (null for wordless texts) that also tells apart
    components without an id.
    """
    documents = materialize(sketch(docs, shingle))
    some = documents.where(F.col("digest").isNotNull())
    classes = some.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    # the written number of a node stays the same however often it is read
    nodes = materialize(classes.withColumn("node", F.monotonically_increasing_id()))
    member = regions(nodes)
    # how many nodes share a node's regions, counted once for each
    crowds = materialize(member.where(F.col("depth") == DEPTHS[0]).groupBy("node").agg(F.sum("size").alias("crowd")))
    crowds = broadcast_if_small(crowds)
    member = materialize(member.join(crowds, "node"))
    reps = materialize(nodes.join(crowds, "node").select("node", "doc_id", "digest", "n_shingles", "signature", "crowd"))
    sets = materialize(_needed_sets(docs, reps, shingle))

    labels = None
    tested = reps.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))
    number, whole = 0, False
    while True:
        rows = member.withColumn("component", F.col("node"))
        if labels is not None:
            rows = member.join(broadcast_if_small(labels), "node", "left").withColumn("component", F.coalesce("component", "node"))
        pairs = _across(rows.where(F.col("depth") == DEPTHS[0]), sets, reps) if whole else _nearby(rows, number)
        pairs = pairs.distinct().withColumns({"a": F.least("node", "other"), "b": F.greatest("node", "other")})
        likely = _likely(pairs.join(tested, ["a", "b"], "left_anti").select("node", "other"), reps)
        if not whole:
            likely = _partners(likely, number)
        pairs = likely.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        held = materialize(_linked(pairs, sets))
        new = held.where("link").select("a", "b")
        found = not new.isEmpty()
        if found:
            labels = _merged(labels, new)
        if whole:
            return _named(documents, nodes, labels)
        tested = materialize(tested.union(held.select("a", "b")))
        number += 1
        whole = not found or number == ROUNDS
