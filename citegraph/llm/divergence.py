"""How the sources of a language differ in their words.

Every document is a sparse vector of term counts. The vectors are summed per language and
source, and with them the number of documents a term is in; terms of fewer than
``min_df`` documents of their language go, and the sums are compared in whole numbers.

* Vectors are counted and summed by task, in blocks of about ``BLOCK_ENTRIES`` entries, so
  what moves is one row per block and term. Equal terms meet in sorted runs and are
  added up. No vocabulary is held by the driver or an executor, and none has a size limit.
  (CountVectorizer itself gives the same vectors; README has its figures.)
* The smoothed share of a term is ``p = 1 + floor(10^9 (count + 1) / (N + V))``, and the
  divergence of ``p`` from ``q`` is ``f = floor((p - q)^2 / q)``. For a pair of sources f is summed over
  all V terms, but most are in neither. With the shares p0, q0 of absent terms the sum is
  V f(p0, q0), plus the terms of one side against the other's q0 or p0 (by how many terms
  have a count, which are few numbers), plus for terms of both sides
  f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0). Only the last needs the sources to meet, and
  only in the terms they share; they meet in sorted runs of a term, summed in place.

All numbers are exact while a language has fewer than 9 * 10^15 terms in its texts.

Defined results: nulls in text, language and source read as empty strings; every occurring
pair of language and source is a group, also without terms; a language without kept terms
has value 0 for all its pairs; repeated rows count as documents of their own; ties rank by the
item's UTF-8; an empty table gives an empty result; other columns are ignored. The sources of
a language that share one term must fit a task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citegraph.llm.common import materialize
from citegraph.plans.keys import numbered_rows
from citegraph.plans.materialize import broadcast_if_small

#: Entries of document vectors that are summed at once; bounds the memory of a task.
BLOCK_ENTRIES = 2_000_000
#: Rows and pairs that are worked on at once.
CHUNK_ROWS, CHUNK_PAIRS = 200_000, 2_000_000
SCALE_STEP, SCALE_STEPS = 1000, 3
#: Octets of UTF-8 as parts of terms: ASCII letters in lower case and all beyond ASCII; the rest parts terms.
OCTETS = bytes(c if 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def _summed_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document vectors of (language l, group g, UTF-8 text), summed: (l, term, df, g and n of its groups)."""
    numbers: dict[tuple[int, bytes], int] = {}
    held, groups, counts = [], [], []
    entries = 0

    def block() -> pa.RecordBatch:
        term, n = np.concatenate(held), np.concatenate(counts)
        known, group = np.unique(np.repeat([g for g, _ in groups], [k for _, k in groups]), return_inverse=True)
        key = term * len(known) + group
        order = np.argsort(key, kind="stable")
        key, n, term = key[order], n[order], term[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        by_term = np.searchsorted(term[first], np.arange(len(numbers) + 1))
        lists = [pa.ListArray.from_arrays(pa.array(by_term, pa.int32()), pa.array(x)) for x in (known[key[first] % len(known)], np.add.reduceat(n, first))]
        langs, words = zip(*numbers, strict=True)
        df = np.bincount(term, minlength=len(numbers))
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.int64()), pa.array(words, pa.binary()), pa.array(df), *lists], ["l", "term", "df", "g", "n"])

    for batch in batches:
        for lang, group, text in zip(*(c for c in batch.columns), strict=True):
            vector = Counter(text.as_py().translate(OCTETS).split())
            if not vector:
                continue
            lang = lang.as_py()
            held.append(np.fromiter((numbers.setdefault((lang, t), len(numbers)) for t in vector), np.int64, len(vector)))
            counts.append(np.fromiter(vector.values(), np.int64, len(vector)))
            groups.append((group.as_py(), len(vector)))
            entries += len(vector)
            if entries >= BLOCK_ENTRIES:
                yield block()
                numbers.clear()
                held, groups, counts, entries = [], [], [], 0
    if entries:
        yield block()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole runs of equal (l, term) of sorted rows, many at once, with the places where they start."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK_ROWS:
            table, starts = _begun(held)
            # the last run may go on
            if len(starts) > 1:
                yield table.slice(0, starts[-1]), starts[:-1]
            held = table.slice(starts[-1]).combine_chunks().to_batches()
            rows = sum(b.num_rows for b in held)
    if rows:
        yield _begun(held)


def _begun(batches: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    changed = [pc.not_equal(table[c][1:], table[c][:-1]).to_numpy() for c in ("l", "term")]
    return table, np.flatnonzero(np.concatenate([[True], changed[0] | changed[1]]))


def term_counts(docs: DataFrame, min_df: int) -> DataFrame:
    """(l, term, g, n, n_lang, first) of ``docs`` (l, g, text): occurrences of each term of ``min_df`` documents of
    its language, per group; ``first`` is 1 once per term of a language."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _runs(batches):
            table = table.combine_chunks()
            enough = np.add.reduceat(table["df"].to_numpy(), starts) >= min_df
            of_row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
            table = table.filter(pa.array(enough[of_row]))
            if not table.num_rows:
                continue
            of_row = of_row[enough[of_row]]
            gs, ns = (table[c].combine_chunks() for c in ("g", "n"))
            run = np.repeat(of_row, pc.list_value_length(gs).to_numpy())
            g, n = gs.flatten().to_numpy(), ns.flatten().to_numpy()
            order = np.lexsort([g, run])
            run, g, n = run[order], g[order], n[order]
            fresh = np.concatenate([[True], run[1:] != run[:-1]])
            at = np.flatnonzero(fresh | np.concatenate([[True], g[1:] != g[:-1]]))
            whole = np.add.reduceat(n, np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
            rows = np.searchsorted(of_row, run[at])
            columns = [table["l"].take(pa.array(rows)), table["term"].take(pa.array(rows)), g[at], np.add.reduceat(n, at), whole[at], fresh[at].astype(np.int64)]
            yield from pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in columns], ["l", "term", "g", "n", "n_lang", "first"]).to_batches()

    parts = docs.select("l", "g", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    parts = parts.mapInArrow(_summed_vectors, "l bigint, term binary, df bigint, g array<bigint>, n array<bigint>")
    met = parts.repartition("l", "term").sortWithinPartitions("l", "term")
    return materialize(met.mapInArrow(added, "l bigint, term binary, g bigint, n bigint, n_lang bigint, first bigint"))


def share(n: str | int, below: str) -> Column:
    """p of a count: digits of the quotient, a thousand at a time, so that nothing overflows; null below null."""
    rest = (F.lit(n) if isinstance(n, int) else F.col(n)) + 1
    found = F.lit(0).cast("bigint")
    for _ in range(SCALE_STEPS):
        found = found * SCALE_STEP + F.call_function("div", rest * SCALE_STEP, F.col(below))
        rest = rest * SCALE_STEP % F.col(below)
    return found + 1


def divergence(p: str, q: str) -> Column:
    step = F.col(p) - F.col(q)
    return F.call_function("div", step * step, F.col(q))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the terms that two groups share, both ways, from rows in order of language and term."""

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    def sums(known: np.ndarray, pairs: list[np.ndarray], values: list[np.ndarray]) -> pa.RecordBatch:
        key, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, inverse, np.concatenate(values))
        return pa.RecordBatch.from_arrays([pa.array(known[key // len(known)]), pa.array(known[key % len(known)]), pa.array(total)], ["a", "b", "value"])

    for table, starts in _runs(batches):
        known, g = np.unique(table["g"].to_numpy(), return_inverse=True)
        p, p0 = table["p"].to_numpy(), table["p0"].to_numpy()
        ends = np.repeat(np.append(starts[1:], len(g)), np.diff(np.append(starts, len(g))))
        at, step, pairs, values, n = np.arange(len(g)), 1, [], [], 0
        while len(at := at[at + step < ends[at]]):
            for some in np.array_split(at, 1 + len(at) // CHUNK_PAIRS):
                for x, y in ((some, some + step), (some + step, some)):
                    pairs.append(g[x] * len(known) + g[y])
                    values.append(f(p[x], p[y]) - f(p[x], p0[y]) - f(p0[x], p[y]) + f(p0[x], p0[y]))
                n += len(some)
                if n >= CHUNK_PAIRS:
                    yield sums(known, pairs, values)
                    pairs, values, n = [], [], 0
            step += 1
        if pairs:
            yield sums(known, pairs, values)


def _sums_of_pairs(stated: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b, value) of every ordered pair of groups of a language: f summed over all kept terms."""
    other = groups.select("l", F.col("g").alias("h"), F.col("p0").alias("q0"), F.col("terms_kept").alias("v"))
    every = groups.join(other, "l").where("g <> h")
    absent = every.select(F.col("g").alias("a"), F.col("h").alias("b"), F.coalesce(F.col("v") * divergence("p0", "q0"), F.lit(0)).alias("value"))
    alike = stated.groupBy("l", "g", "p", "p0").agg(F.count("*").alias("m"))
    sides = F.array(
        F.struct(F.col("g").alias("a"), F.col("h").alias("b"), (F.col("m") * (divergence("p", "q0") - divergence("p0", "q0"))).alias("value")),
        F.struct(F.col("h").alias("a"), F.col("g").alias("b"), (F.col("m") * (divergence("q0", "p") - divergence("q0", "p0"))).alias("value")),
    )
    alone = alike.join(other, "l").where("g <> h").select(F.inline(sides))
    met = stated.select("l", "term", "g", "p", "p0").repartition("l", "term").sortWithinPartitions("l", "term")
    both = met.mapInArrow(_met, "a bigint, b bigint, value bigint")
    return absent.unionByName(alone).unionByName(both).groupBy("a", "b").agg(F.sum("value").alias("value"))


def divergence_audit(docs: DataFrame, min_df: int = 3, top_terms: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (text, lang, source): part ``pair`` has
    every other source of the language, part ``term`` the ``top_terms`` terms that a source has more of."""
    read = lambda c: F.coalesce(docs[c], F.lit("")).alias(c)
    docs = docs.select(read("lang"), read("source"), docs["text"].alias("text"))
    groups = numbered_rows(docs.select("lang", "source").distinct(), [F.col("lang"), F.col("source")], "g")
    groups = materialize(groups.withColumn("l", F.min("g").over(Window.partitionBy("lang"))))
    counts = term_counts(docs.join(broadcast_if_small(groups), ["lang", "source"]), min_df)

    of_lang = counts.groupBy("l").agg(F.sum("n").alias("total_lang"), F.sum("first").alias("terms_kept"))
    of_group = counts.groupBy("g").agg(F.sum("n").alias("total"))
    stats = groups.join(of_group, "g", "left").join(of_lang, "l", "left").fillna(0, ["total", "total_lang", "terms_kept"])
    some = F.col("terms_kept") > 0
    stats = stats.withColumns({"below": F.when(some, F.col("total") + F.col("terms_kept")), "below_lang": F.when(some, F.col("total_lang") + F.col("terms_kept"))})
    stats = materialize(stats.withColumn("p0", share(0, "below")))

    stated = counts.join(broadcast_if_small(stats), ["l", "g"]).withColumn("p", share("n", "below"))
    names = stats.select("g", "lang", "source")
    found = _sums_of_pairs(stated, stats).join(names.withColumnRenamed("g", "a"), "a").join(names.select(F.col("g").alias("b"), F.col("source").alias("item")), "b")
    found = found.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    more = stated.withColumn("q", share("n_lang", "below_lang")).where("p > q")
    own = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), divergence("p", "q").alias("value"))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", ranked).unionByName(own.withColumn("rank", ranked).where(F.col("rank") <= top_terms))
