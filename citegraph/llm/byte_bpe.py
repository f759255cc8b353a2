"""Byte-level BPE encoding and decoding of whole texts.

A text is cut by the public pattern into words; every distinct word of a task is encoded
once, by folding ranked merges over its bytes: the adjacent pair whose concatenation has
the lowest rank, leftmost first, is joined until no pair has a rank. The ranks are a
literal of the plan, shipped once per executor; their number is that of the vocabulary.
Decoding concatenates the byte pieces of the ids.

``fold_words`` is the same fold in Spark's higher-order functions over a table of words,
with the ranks as a literal map. It gives the same ids, but its interpreted lambdas take
about ten times the time per word (README has figures), so texts are encoded by
``encode_texts``, which folds in Arrow batches.

A single space between two other characters always starts a word, so a text is split at
single spaces first, and the ids of each such chunk, and of each word, are remembered, in
at most about ``REMEMBERED`` entries each; a memory starts anew when it is full. Texts in which a
space stands beside other white space are cut by the pattern as a whole.

Defined results: a null text counts as empty, an empty one has no ids; repeated rows and
ids are encoded alone; tables may be empty; extra columns are left as they are.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import json
import zlib
from array import array
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REMEMBERED = 600_000
#: Words of more bytes are folded with a heap instead of a scan for each merge.
LONG_WORD = 64
_NONE = 1 << 30


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, with a bounded memory of chunks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.words = ranks, regex.compile(pattern)
        self.pieces = {rank: token for token, rank in ranks.items()}
        self.by_chunk: dict[str, bytes | None] = {}
        self.by_word: dict[str, bytes] = {}

    def fold(self, word: bytes) -> list[int]:
        """Ids of one word by ranked merges."""
        if word in self.ranks:
            return [self.ranks[word]]
        if len(word) > LONG_WORD:
            return self._fold_long(word)
        get = self.ranks.get
        parts = [word[i : i + 1] for i in range(len(word))]
        found = [get(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
        while found:
            best = min(found)
            if best == _NONE:
                break
            i = found.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i:
                found[i - 1] = get(parts[i - 1] + parts[i], _NONE)
            if i < len(found):
                found[i] = get(parts[i] + parts[i + 1], _NONE)
        return [self.ranks[p] for p in parts]

    def _fold_long(self, word: bytes) -> list[int]:
        """The same merges in the same order, each found on a heap of ranks and positions."""
        get, n = self.ranks.get, len(word)
        end, before = [i + 1 for i in range(n)], [i - 1 for i in range(n)]
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, middle, last = heapq.heappop(heap)
            if not alive[i] or end[i] != middle or middle >= n or end[middle] != last:
                continue  # one of the two has been joined since
            alive[middle] = False
            end[i] = last
            if last < n:
                before[last] = i
                if (r := get(word[i : end[last]])) is not None:
                    heapq.heappush(heap, (r, i, last, end[last]))
            if (p := before[i]) >= 0 and (r := get(word[p:last])) is not None:
                heapq.heappush(heap, (r, p, i, last))
        return [self.ranks[word[i : end[i]]] for i in range(n) if alive[i]]

    def _words(self, text: str) -> bytes:
        memory, ids = self.by_word, []
        if len(memory) > REMEMBERED:
            memory.clear()
        for word in self.words.findall(text):
            try:
                ids.append(memory[word])
            except KeyError:
                memory[word] = made = array("I", self.fold(word.encode())).tobytes()
                ids.append(made)
        return b"".join(ids)

    def _chunk(self, chunk: str, first: bool) -> bytes | None:
        """Ids of a chunk between single spaces; None if white space at its edge reaches beyond it."""
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        return self._words(chunk if first else " " + chunk)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        chunks, memory = text.split(" "), self.by_chunk
        if len(memory) > REMEMBERED:
            memory.clear()
        ids = [self._chunk(chunks[0], True)]
        for chunk in chunks[1:]:
            try:
                ids.append(memory[chunk])
            except KeyError:
                memory[chunk] = made = self._chunk(chunk, False)
                ids.append(made)
        try:
            return b"".join(ids)
        except TypeError:  # a None
            return self._words(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, memoryview(ids).cast("I")))


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(load_ranks(path), pattern)


def encode_texts(text: Column, path: str, pattern: str) -> Column:
    """Ids of each text as little-endian unsigned 32-bit integers in a binary value."""

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        own = encoder(path, pattern)
        return pa.array([own.encode(t.as_py() or "") for t in texts], pa.binary())

    return encode(text)


def decode_ids(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of the ids, as binary: the concatenated pieces."""

    @F.arrow_udf("binary")
    def decode(values: pa.Array) -> pa.Array:
        own = encoder(path, pattern)
        return pa.array([None if (v := x.as_py()) is None else own.decode(v) for x in values], pa.binary())

    return decode(ids)


def rank_literal(ranks: Iterable[tuple[bytes, int]], buckets: int = 8192) -> Column:
    """The ranks as one literal: an array of maps from hexadecimal bytes to rank, by checksum.

    A lookup in a map literal walks its keys, so they are spread over short maps.
    """
    spread: list[dict[str, int]] = [{} for _ in range(buckets)]
    for token, rank in ranks:
        key = token.hex().upper()
        spread[zlib.crc32(key.encode()) % buckets][key] = rank
    return F.from_json(F.lit(json.dumps(spread)), "array<map<string,int>>")


def fold_words(words: DataFrame, ranks: dict[bytes, int], word: str = "word", buckets: int = 8192) -> DataFrame:
    """``words`` with ``ids`` (array of int): ranked merges folded over the word's bytes.

    For words as the pattern cuts them; a null or empty word has no ids.
    """
    let = lambda value, body: F.transform(F.array(value), body)[0]  # noqa: E731  evaluates value once

    def with_table(table: Column) -> Column:
        rank = lambda h: F.get(table, (F.crc32(h.cast("binary")) % buckets).cast("int"))[h]

        def step(pieces: Column, _: Column) -> Column:
            def joined(found: Column, lowest: Column) -> Column:
                at = F.array_position(found, lowest).cast("int")
                one = F.array(F.concat(F.get(pieces, at - 1), F.get(pieces, at)))
                return F.concat(F.slice(pieces, F.lit(1), at - 1), one, F.slice(pieces, at + 2, F.size(pieces)))

            found = F.transform(F.slice(pieces, 2, F.size(pieces)), lambda x, i: rank(F.concat(F.get(pieces, i), x)))
            return let(found, lambda f: let(F.array_min(f), lambda m: F.when(m.isNull(), pieces).otherwise(joined(f, m))))

        def folded(h: Column) -> Column:
            start = F.regexp_extract_all(h, F.lit(".."), F.lit(0))
            return F.aggregate(F.sequence(F.lit(1), F.length(h)), start, step, lambda p: F.transform(p, rank))

        return let(F.hex(F.encode(F.col(word), "utf-8")), folded)

    empty = F.coalesce(F.col(word), F.lit("")) == ""
    ids = F.when(empty, F.array().cast("array<int>")).otherwise(let(rank_literal(ranks.items(), buckets), with_table))
    return words.withColumn("ids", ids)


def text_digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` (of the decoded ids).

    One pass in Arrow, so that neither ids nor decoded bytes travel back.
    """
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digests(texts: pa.Array) -> pa.Array:
        own, rows = encoder(path, pattern), []
        for t in texts:
            ids = own.encode(t.as_py() or "")
            both = (hashlib.sha256(x).hexdigest() for x in (ids, own.decode(ids)))
            rows.append(dict(zip(kind.names, (len(ids) // 4, *both), strict=True)))
        return pa.array(rows, kind)

    return docs.withColumn("_digests", digests(F.col(text))).select(*(docs[c] for c in docs.columns), "_digests.*")
