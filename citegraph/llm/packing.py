"""Lexical retrieval packing.

Every document is encoded and ended by one id. Full windows of ``WINDOW`` ids are cut from
its front and are sequences of their own; what is left, its tail, is packed with tails that
share its vocabulary. Tails are ordered by their two most telling tokens, so that related
ones come together, and dealt out in that order, by range; each task cuts its range into
shards of ``SHARD`` tails. A shard has an inverted BM25 index over its tails, with token ids
as terms and the frequencies of all documents. A tail that is not used yet seeds a window;
its best unused neighbours fill it, the last of them cut to the room that is left, its rest
staying unused. So windows are full; the rest of a shard is cut into sequences whose lengths
are powers of two, which need no padding.

Encodings are written once; full windows, frequencies and tails are read from there. What a
task holds is a shard, whatever the number of tails that are alike.

Defined results: null and empty texts are documents of the end id alone; repeated rows and
ids are packed as documents of their own; tables may be empty; extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citegraph.llm.common import materialize

WINDOW = 1024
SHARD = 2048
END = 0
K1, B = 1.2, 0.75
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def vocabulary_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Byte strings of a byte-level vocabulary, which writes each byte as one letter.

    Printable bytes are written as themselves, the others, in order, as the letters from 256 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
    return {bytes(letters[c] for c in token): rank for token, rank in vocabulary.items()}


class LibraryEncoder:
    """Ids as the tokenizers library gives them.

    Texts are encoded by tiktoken from the same vocabulary, which gives the same ids in a
    tenth of the time; texts that hold an added token are left to the library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.terms = self.library.get_vocab_size()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        ranks = vocabulary_ranks(self.library.get_vocab(with_added_tokens=False))
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(t in text for t in self.added):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.fast.encode_ordinary(text)).tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """A row per document and, per task, one row of token frequencies.

    Documents: ``doc_id, doc_tokens, full`` (checksums of the full windows) and ``tail`` (its
    ids, unsigned 32-bit). Frequencies: ``terms`` and ``documents`` (in how many documents a
    term occurs), with null elsewhere.
    """
    fields = [("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("full", pa.list_(pa.int64())), ("tail", pa.binary())]
    fields += [("terms", pa.list_(pa.int32())), ("documents", pa.list_(pa.int64()))]
    schema = pa.schema(fields)

    def encode(batches):
        own = encoder(path)
        found, seen = np.zeros(own.terms, np.int64), np.zeros(own.terms, np.bool_)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = np.frombuffer(own.encode(text.as_py() or "") + END.to_bytes(4, "little"), np.uint32)
                    seen[ids] = True
                    once = np.flatnonzero(seen)
                    found[once] += 1
                    seen[once] = False
                    cut = len(ids) // WINDOW * WINDOW
                    full = [zlib.crc32(ids[i : i + WINDOW].tobytes()) for i in range(0, cut, WINDOW)]
                    rows.append((doc_id, len(ids), full, ids[cut:].tobytes(), None, None))
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        at = np.flatnonzero(found)
        last = [[None], [None], [None], [None], [at], [found[at]]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(last, schema, strict=True)], schema=schema)

    kinds = "doc_id bigint, doc_tokens bigint, full array<bigint>, tail binary, terms array<int>, documents array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(encode, kinds)


def term_weights(encoded: DataFrame, terms: int) -> tuple[np.ndarray, float]:
    """BM25's inverse document frequency per term (0 for terms of half the documents) and the mean tail length.

    At most one row per term of the vocabulary reaches the driver.
    """
    pairs = encoded.where(F.col("terms").isNotNull()).select(F.explode(F.arrays_zip("terms", "documents")).alias("p"))
    sums = pairs.groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.documents").alias("n")).toArrow()
    found = np.zeros(terms)
    found[sums.column("term").to_numpy()] = sums.column("n").to_numpy()
    tails = encoded.where(F.col("terms").isNull())
    row = tails.agg(F.count("*").alias("n"), F.avg(F.octet_length("tail") / 4).alias("mean")).first()
    weights = np.log(np.maximum((row.n - found + 0.5) / (found + 0.5), 1.0))
    return weights.astype(np.float32), float(row["mean"] or 1.0)


def telling_terms(tail: Column, shared) -> Column:
    """The two terms of a tail with the highest term frequency times inverse document frequency."""
    kind = pa.struct([("first", pa.int32()), ("second", pa.int32())])

    @F.arrow_udf("first int, second int")
    def tell(tails: pa.Array) -> pa.Array:
        weights, _ = shared.value
        rows = []
        for t in tails:
            terms, n = np.unique(np.frombuffer(t.as_py(), np.uint32), return_counts=True)
            best = terms[np.argsort(-(1 + np.log(n)) * weights[terms], kind="stable")[:2]]
            rows.append({"first": int(best[0]), "second": int(best[-1])})
        return pa.array(rows, kind)

    return tell(tail)


class Index:
    """Inverted index of a shard: per term the tails that have it, with their BM25 weights."""

    def __init__(self, tails: list[np.ndarray], weights: np.ndarray, mean: float):
        n = len(tails)
        sizes = np.array([len(t) for t in tails])
        of = np.repeat(np.arange(n), sizes)
        keys, counts = np.unique(np.concatenate(tails).astype(np.int64) * n + of, return_counts=True)
        terms, self.tails = keys // n, keys % n
        norm = K1 * (1 - B + B * sizes / mean)
        self.scores = weights[terms] * counts * (K1 + 1) / (counts + norm[self.tails])
        useful = self.scores > 0
        terms, self.tails, self.scores = terms[useful], self.tails[useful], self.scores[useful]
        self.n, (self.terms, self.starts) = n, np.unique(terms, return_index=True)
        self.sizes = np.diff(np.append(self.starts, len(terms)))

    def search(self, ids: np.ndarray) -> np.ndarray:
        """Score of every tail for a query of ids."""
        terms, counts = np.unique(ids, return_counts=True)
        at = np.searchsorted(self.terms, terms)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == terms[known]
        at, counts = at[known], counts[known]
        sizes = self.sizes[at]
        total = int(sizes.sum())
        if not total:
            return np.zeros(self.n)
        postings = np.arange(total) + np.repeat(self.starts[at] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        return np.bincount(self.tails[postings], self.scores[postings] * np.repeat(counts, sizes), self.n)


def pack_shard(tails: list[np.ndarray], weights: np.ndarray, mean: float):
    """Sequences of a shard, each a list of pieces ``(tail, start, length)``."""
    index = Index(tails, weights, mean)
    used = np.zeros(len(tails), np.int64)  # ids of each tail that are packed, from its front
    left = np.array([len(t) for t in tails])
    closed = left == 0
    for seed in range(len(tails)):
        while not closed[seed]:
            pieces, room = [], WINDOW

            def take(i: int) -> None:
                nonlocal room
                n = int(min(left[i], room))
                pieces.append((i, int(used[i]), n))
                used[i] += n
                left[i] -= n
                room -= n
                closed[i] = left[i] == 0

            first = tails[seed][used[seed] :]
            take(seed)
            if room:
                scores = index.search(first)
                scores[closed] = -1
                few = min(len(tails), 16)
                best = np.argpartition(-scores, few - 1)[:few]
                for i in best[np.argsort(-scores[best], kind="stable")]:
                    if room and scores[i] >= 0:
                        take(int(i))
                while room and not closed.all():  # neighbours beyond the best few, in order
                    scores[closed] = -1
                    take(int(scores.argmax()))
            if not room:
                yield pieces
                continue
            # the last of the shard: sequences of a power of two each
            rest, at = WINDOW - room, 0
            pieces = [(i, s + k, 1) for i, s, n in pieces for k in range(n)]
            while rest:
                n = 1 << (rest.bit_length() - 1)
                yield joined(pieces[at : at + n])
                at, rest = at + n, rest - n


def joined(pieces: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Adjoining pieces of one tail as one."""
    out: list[tuple[int, int, int]] = []
    for i, s, n in pieces:
        if out and out[-1][0] == i and out[-1][1] + out[-1][2] == s:
            out[-1] = (i, out[-1][1], out[-1][2] + n)
        else:
            out.append((i, s, n))
    return out


def pack(docs: DataFrame, path: str) -> DataFrame:
    """Pieces of the sequences of ``docs`` (``doc_id``, ``text``), columns as in ``PIECE``."""
    spark = docs.sparkSession
    encoded = materialize(encode_documents(docs, path))
    shared = spark.sparkContext.broadcast(term_weights(encoded, encoder(path).terms))
    schema = pa.schema([(n.split()[0], pa.int64()) for n in PIECE.split(", ")])

    whole = encoded.where(F.size("full") > 0).select("doc_id", "doc_tokens", F.posexplode("full").alias("n", "ids_crc32"))
    whole = whole.select(
        "doc_id",
        (F.col("n") * WINDOW).cast("bigint").alias("start"),
        F.lit(WINDOW).cast("bigint").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (2 * F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )

    def packed(batches):
        weights, mean = shared.value
        sequence = TaskContext.get().partitionId() << 33

        def shard(rows):
            nonlocal sequence
            tails = [np.frombuffer(r[2], np.uint32) for r in rows]
            out = []
            for pieces in pack_shard(tails, weights, mean):
                offset = 0
                for i, s, n in pieces:
                    before = rows[i][1] - len(tails[i])
                    crc = zlib.crc32(tails[i][s : s + n].tobytes())
                    out.append((rows[i][0], before + s, n, crc, rows[i][1], 2 * sequence + 1, offset))
                    offset += n
                sequence += 1
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

        rows: list[tuple] = []
        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(rows) >= SHARD:
                yield shard(rows[:SHARD])
                rows = rows[SHARD:]
        if rows:
            yield shard(rows)

    tails = encoded.where(F.octet_length("tail") > 0).select("doc_id", "doc_tokens", "tail", telling_terms(F.col("tail"), shared).alias("_key"))
    # written, as the split by range reads its input twice
    tails = materialize(tails)
    order = [F.col("_key.first"), F.col("_key.second"), F.xxhash64("doc_id", "tail"), F.col("doc_id")]
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(tails_count(encoded) / SHARD)))
    dealt = tails.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "doc_tokens", "tail")
    return whole.unionByName(dealt.mapInArrow(packed, PIECE))


def tails_count(encoded: DataFrame) -> int:
    return encoded.where(F.octet_length("tail") > 0).count()
