"""Toxicity by class-conditional Kneser-Ney models over characters.

Two models, one of toxic and one of ordinary training texts, give each letter a
probability after the four letters before it. Their highest order counts by class; where
an expression is rare in a class, both back off to the same lower orders, Kneser-Ney
continuation distributions of the counts of both classes together, after three letters,
two, one and none. What a text gains is the difference of its two log-likelihoods,
length-normalised over the whole text and over its two and three most telling words; a
logistic function of the three turns them into a score. It is fitted on one training row
in ``HELD_FOR_FIT`` with a model of the others, since gains are larger on counted rows.

The model that scores counts every labelled training row. Counts are combined per batch,
then summed by a shuffle on the letter sequence, and smoothed by joins and sums on
sequences and contexts, one order after the other.
The model is kept whole. While it is counted to have at most ``BROADCAST_KEYS`` keys, scoring
broadcasts it, sorted; a larger one stays a table: texts are dealt into blocks of
``BLOCK`` rows, the distinct sequences of a block are joined with the model and the gains
come back to their block.

Letters are lower-cased and kept as ``BITS`` bits: the code point of those below 4096, which
take in the alphabets of Europe and most of Asia, and its remainder of the others; all else
separates words.

Defined results: null and empty texts have gains of 0 and get the score of that; rows
without a label or with a null one are not learnt from; several labels of one id count as
their largest; repeated rows are counted and scored alone; without training rows of both
classes every score is 0; tables may be empty; extra columns are left as they are.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from citegraph.llm.common import materialize

ORDER, BITS = 5, 12
DISCOUNT = 0.75
#: Share of the lowest order spread evenly over the letters of an alphabet of about this size.
ALPHABET = 64
#: Most sequences and contexts, counted together, that scoring broadcasts (16 bytes each), and rows of a block otherwise.
BROADCAST_KEYS, BLOCK = 4_000_000, 2048
#: One of this many training rows fits the logistic function, with a model of the other rows.
HELD_FOR_FIT = 5
FIT_ROUNDS, RIDGE = 12, 1e-2
GAINS = ("whole", "two_words", "three_words")


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.bool_, 0x110000)


def sequences(text: str) -> np.ndarray:
    """One packed sequence of ``ORDER`` characters per letter and word end; 0 codes a separator."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kept = np.where(points < 1 << BITS, points, points % ((1 << BITS) - 1) + 1)
    codes = np.where(_letters()[points], kept, 0).astype(np.int64)
    if len(codes):
        once = np.empty(len(codes), np.bool_)
        once[0] = codes[0] != 0
        np.logical_or(codes[1:] != 0, codes[:-1] != 0, out=once[1:])
        codes = codes[once]
    if not codes.any():
        return np.empty(0, np.int64)
    codes = np.concatenate([np.zeros(ORDER - 1, np.int64), codes, np.zeros(int(codes[-1] != 0), np.int64)])
    n = len(codes) - ORDER + 1
    packed = np.zeros(n, np.int64)
    for j in range(ORDER):
        packed <<= BITS
        packed |= codes[j : j + n]
    return packed


def count_sequences(rows: DataFrame, text: str = "text", toxic: str = "toxic") -> DataFrame:
    """``sequence, n_toxic, n_ordinary`` over all rows, combined per batch before the shuffle."""
    schema = pa.schema([("sequence", pa.int64()), ("n_toxic", pa.int64()), ("n_ordinary", pa.int64())])

    def count(batches):
        for batch in batches:
            texts, labels = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            made = [sequences(t.as_py() or "") for t in texts]
            if not made:
                continue
            of = np.repeat(labels == 1, [len(m) for m in made])
            found, at = np.unique(np.concatenate(made), return_inverse=True)
            toxic_n = np.bincount(at, of, len(found)).astype(np.int64)
            columns = [found, toxic_n, np.bincount(at, minlength=len(found)) - toxic_n]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    counted = rows.select(text, F.col(toxic).cast("int")).mapInArrow(count, "sequence bigint, n_toxic bigint, n_ordinary bigint")
    return counted.groupBy("sequence").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary"))


def shared_orders(counts: DataFrame) -> DataFrame:
    """``key, shared``: of every sequence of ``ORDER - 1`` letters in ``counts``, its chance in both classes together.

    A sequence of k letters counts as often as different letters come before it, that is as
    there are sequences of k + 1 letters that end in it. What its discounts leave is spread by
    the chance of its last k - 1 letters, and at last evenly.
    """
    d, orders, longer = DISCOUNT, [], counts.select(F.col("sequence").alias("key"))
    for k in range(ORDER - 1, 0, -1):
        longer = materialize(longer.groupBy(F.col("key").bitwiseAND((1 << (BITS * k)) - 1).alias("key")).agg(F.count("*").alias("starts")))
        orders.append((k, longer))
    chances = None
    for k, starts in reversed(orders):
        rows = starts.withColumn("context", F.shiftright("key", BITS))
        sums = rows.groupBy("context").agg(F.sum("starts").alias("all"), F.count("*").alias("kinds"))
        rows = rows.join(sums, "context")
        if chances is None:
            rows = rows.withColumn("lower", F.lit(1 / ALPHABET))
        else:
            ends = F.col("key").bitwiseAND((1 << (BITS * (k - 1))) - 1)
            rows = rows.withColumn("end", ends).join(chances.select(F.col("key").alias("end"), F.col("shared").alias("lower")), "end")
        chance = (F.col("starts") - d + d * F.col("kinds") * F.col("lower")) / F.col("all")
        chances = materialize(rows.select("key", chance.alias("shared")))
    return chances


def smooth(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per sequence and per context: ``key`` and ``gain`` (log of the ratio of both models).

    The gain of a context is that of any letter never seen after it: its chance in the shared
    orders is the same in both models.
    """
    d, low = DISCOUNT, (1 << (BITS * (ORDER - 1))) - 1
    counts = counts.withColumns({"context": F.shiftright("sequence", BITS), "shorter": F.col("sequence").bitwiseAND(low)})
    shared = shared_orders(counts).withColumnRenamed("key", "shorter")
    sums = [F.sum(f"n_{c}").alias(f"all_{c}") for c in ("toxic", "ordinary")]
    sums += [F.count_if(F.col(f"n_{c}") > 0).alias(f"kinds_{c}") for c in ("toxic", "ordinary")]
    weight = lambda c: F.when(F.col(f"all_{c}") > 0, d * F.col(f"kinds_{c}") / F.col(f"all_{c}")).otherwise(1.0)
    contexts = counts.groupBy("context").agg(*sums)
    contexts = contexts.withColumns({f"back_{c}": weight(c) for c in ("toxic", "ordinary")})

    def chance(c: str) -> Column:
        own = F.greatest(F.col(f"n_{c}") - d, F.lit(0.0)) / F.greatest(F.col(f"all_{c}"), F.lit(1))
        return own + F.col(f"back_{c}") * F.col("shared")

    whole = counts.join(contexts, "context").join(shared, "shorter")
    by_sequence = whole.select(
        F.col("sequence").alias("key"), F.log(chance("toxic") / chance("ordinary")).alias("gain")
    )
    by_context = contexts.select(
        F.col("context").alias("key"), F.log(F.col("back_toxic") / F.col("back_ordinary")).alias("gain")
    )
    return by_sequence, by_context


def sorted_gains(gains: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All keys in order and their gains, of a table that is counted to be small."""
    found = gains.toArrow()
    keys, gain = found.column("key").to_numpy(), found.column("gain").to_numpy()
    order = np.argsort(keys)
    return keys[order], gain[order]


def _look_up(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not len(table[0]):
        return np.zeros(len(keys), np.bool_), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return table[0][at] == keys, table[1][at]


def gains_of(text: str, by_sequence: tuple, by_context: tuple) -> tuple[float, float, float]:
    """Length-normalised gains of a text: per letter, and per word over its two and three best words."""
    keys = sequences(text)
    if not len(keys):
        return 0.0, 0.0, 0.0
    seen, gain = _look_up(keys, by_sequence)
    gain = np.where(seen, gain, 0.0)
    if not seen.all():
        known, back = _look_up(keys[~seen] >> BITS, by_context)
        gain[~seen] = np.where(known, back, 0.0)
    ends = np.flatnonzero((keys & ((1 << BITS) - 1)) == 0)
    sums = np.concatenate([[0.0], np.cumsum(gain)])[np.concatenate([[0], ends + 1])]
    words = np.diff(sums)
    best = np.sort(np.partition(words, -3)[-3:] if len(words) > 3 else words)[::-1]
    return float(gain.mean()), float(best[:2].sum() / 2), float(best.sum() / 3)


def text_gains(text: Column, by_sequence, by_context) -> Column:
    """Struct of ``GAINS`` per text, with the tables as broadcast variables."""
    kind = pa.struct([(g, pa.float64()) for g in GAINS])

    @F.arrow_udf(", ".join(f"{g} double" for g in GAINS))
    def gains(texts: pa.Array) -> pa.Array:
        own = (by_sequence.value, by_context.value)
        rows = [gains_of(t.as_py() or "", *own) for t in texts]
        columns = np.array(rows, np.float64).reshape(len(rows), len(GAINS)).T
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(kind))

    return gains(text)


def joined_gains(docs: DataFrame, text: str, by_sequence: DataFrame, by_context: DataFrame) -> DataFrame:
    """``docs`` with ``GAINS``, by joins with a model of any size.

    A sequence occurs once in a block, so the most frequent one has as many rows as there are blocks.
    """
    place = F.monotonically_increasing_id()
    docs = materialize(docs.withColumn("_block", F.shiftright(place, BLOCK.bit_length() - 1)))
    schema = pa.schema([("_block", pa.int64()), ("key", pa.int64())])

    def distinct(batches):
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for block in np.unique(blocks):
                made = [sequences(t.as_py() or "") for t in batch.column(1).filter(pa.array(blocks == block))]
                found = np.unique(np.concatenate(made))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block)), pa.array(found, pa.int64())], schema=schema)

    wanted = docs.select("_block", text).mapInArrow(distinct, "_block bigint, key bigint").distinct()
    known = wanted.join(by_sequence, "key", "left").withColumn("context", F.shiftright("key", BITS))
    back = by_context.select(F.col("key").alias("context"), F.col("gain").alias("back"))
    known = known.join(back, "context", "left").select("_block", "key", F.coalesce("gain", "back", F.lit(0.0)).alias("gain"))
    kept = [c for c in docs.columns if c not in ("_block", *GAINS)]

    def score(key, own: pa.Table, model: pa.Table) -> pa.Table:
        keys, gain = model.column("key").to_numpy(), model.column("gain").to_numpy()
        order = np.argsort(keys)
        table, none = (keys[order], gain[order]), (np.empty(0, np.int64), np.empty(0))
        rows = [gains_of(t.as_py() or "", table, none) for t in own.column(text)]
        columns = np.array(rows, np.float64).reshape(len(rows), len(GAINS)).T
        return pa.table([own.column(c) for c in kept] + [pa.array(c) for c in columns], names=[*kept, *GAINS])

    kind = StructType([docs.schema[c] for c in kept] + [StructField(g, DoubleType()) for g in GAINS])
    return docs.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(score, kind)


def gains_by(counts: DataFrame, text: str) -> tuple[Callable[[DataFrame], DataFrame], Callable[[], None]]:
    """What adds ``GAINS`` by the model of ``counts`` to rows with texts, and what frees the model's broadcast tables."""
    model = [materialize(g) for g in smooth(counts)]
    if sum(g.count() for g in model) > BROADCAST_KEYS:
        return lambda df: joined_gains(df, text, *model), lambda: None
    tables = [counts.sparkSession.sparkContext.broadcast(sorted_gains(g)) for g in model]

    def gained(df: DataFrame) -> DataFrame:
        kept = (df[c] for c in df.columns if c not in GAINS)
        return df.withColumn("_gains", text_gains(F.col(text), *tables)).select(*kept, "_gains.*")

    def done() -> None:
        for t in tables:
            t.unpersist()

    return gained, done


def logit(weights: np.ndarray) -> Column:
    out = F.lit(float(weights[-1]))
    for g, w in zip(GAINS, weights, strict=False):
        out = out + F.col(g) * float(w)
    return out


def fit_logistic(rows: DataFrame, toxic: str = "toxic") -> np.ndarray:
    """Newton's method; each round is one sum over all rows, of which one row reaches the driver."""
    k = len(GAINS) + 1
    x = [F.col(g) for g in GAINS] + [F.lit(1.0)]
    weights = np.zeros(k)
    for _ in range(FIT_ROUNDS):
        p = 1 / (1 + F.exp(-logit(weights)))
        sums = [F.sum((F.col(toxic) - p) * x[i]) for i in range(k)]
        sums += [F.sum(p * (1 - p) * x[i] * x[j]) for i in range(k) for j in range(i, k)]
        row = [v or 0.0 for v in rows.agg(*(s.alias(f"s{n}") for n, s in enumerate(sums))).first()]
        gradient, curve = np.array(row[:k]) - RIDGE * weights, np.zeros((k, k))
        curve[np.triu_indices(k)] = row[k:]
        curve += np.triu(curve, 1).T + RIDGE * np.eye(k)
        step = np.linalg.solve(curve, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def toxicity_scores(docs: DataFrame, training: DataFrame, text: str = "text", toxic: str = "toxic") -> DataFrame:
    """``docs`` with ``score``; ``training`` has ``text``, ``toxic`` (0, 1 or null) and ``row`` (long, any)."""
    training = training.where(F.col(toxic).isNotNull()).withColumn(toxic, F.col(toxic).cast("int"))
    fitted = F.pmod(F.xxhash64("row"), F.lit(HELD_FOR_FIT)) == 0
    classes = training.agg(F.min(toxic).alias("least"), F.max(toxic).alias("most")).first()
    if (classes.least, classes.most) != (0, 1):
        return docs.withColumn("score", F.lit(0.0))
    others = materialize(count_sequences(training.where(~fitted), text, toxic))
    both = others.unionByName(count_sequences(training.where(fitted), text, toxic))
    every = both.groupBy("sequence").agg(*(F.sum(c).alias(c) for c in ("n_toxic", "n_ordinary")))
    gained, done = gains_by(others, text)
    weights = fit_logistic(materialize(gained(training.where(fitted)).select(toxic, *GAINS)), toxic)
    done()
    gained, _ = gains_by(materialize(every), text)
    return gained(docs).withColumn("score", 1 / (1 + F.exp(-logit(weights)))).drop(*GAINS)
