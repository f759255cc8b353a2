"""Token counts of whole texts without ids.

The pieces of a pre-token are counted once and joined to how often each document holds it:

1. Documents are cut into pre-tokens in blocks of about ``BLOCK_BYTES`` of text. A block
   numbers its distinct pre-tokens; a document keeps its frequencies as (number, count) pairs
   in a binary value. Both are written once, and texts are not read again.
2. The distinct pre-tokens of all blocks meet by pre-token, sorted, and each is encoded once.
   A pre-token has one row per block that holds it, however often documents repeat it, so no
   frequent word makes a hot key.
3. Numbers of pieces return to their block, are multiplied with the frequencies and summed.

The library's own file says how texts are cut. The added tokens of the file count as one
each where their strings stand in a text, and a text is cut there first. For the usual
normaliser (canonical composition, white space to spaces, lower case) text between spaces is
cut by the file's pattern directly where it holds only characters whose classes no version
of Unicode changes; anything else goes through the library's normaliser and cutter.

Defined results: a null text counts as empty and has no tokens; repeated rows and ids are
counted alone; an empty table gives an empty result; a text may be of any length (a block
holds one at least); all other columns are carried along under their names, but for ones
named ``n_bytes`` or ``n_tokens``, which the result's own replace.
"""

from __future__ import annotations

import functools
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citegraph.llm.common import materialize

#: Bytes of text whose pre-tokens are numbered together; bounds the memory of a task.
BLOCK_BYTES = 24 << 20
#: Rows handed on at once.
ROWS = 8192
#: The normaliser for which runs between spaces are cut alone.
SPACED = [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
#: Characters that normaliser leaves alone but for case, with the same class in every version of
#: Unicode; without white space (but for those of ASCII) and the four separators that only
#: Python takes for white space.
PLAIN = re.compile(r"[\x00-\x1B\x20-\x7F\xA1-\xFF\u2010-\u2027]*")


class Cutter:
    """What a tokenizers file says about cutting a text and the pieces of one pre-token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        self.library = Tokenizer.from_file(path)
        added = stated["added_tokens"]
        if any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError("added tokens must match as they are")
        strings = sorted((a["content"] for a in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, strings))) if strings else None
        cutter = stated["pre_tokenizer"] or {}
        steps = cutter.get("pretokenizers", [cutter])
        own = self.library.pre_tokenizer
        whole = cutter.get("type") == "Sequence"
        self.first, self.rest = (own[0], [own[i] for i in range(1, len(steps))]) if whole else (own, [])
        rules = (stated["normalizer"] or {}).get("normalizers", [])
        spaced = [(r["type"], r.get("pattern"), r.get("content")) for r in rules] == SPACED
        split = steps[0]
        if spaced and split.get("type") == "Split" and split.get("invert") and split["behavior"] == "Removed":
            self.pattern = regex.compile(split["pattern"]["Regex"])
        else:
            self.pattern = None

    def _by_library(self, text: str) -> list[str]:
        normalizer = self.library.normalizer
        text = normalizer.normalize_str(text) if normalizer else text
        return [piece for piece, _ in self.first.pre_tokenize_str(text)] if self.first else [text]

    def _cut(self, text: str) -> Iterable[str]:
        if self.pattern is None:
            return self._by_library(text)
        if PLAIN.fullmatch(text):
            return self.pattern.findall(text.lower())
        found: list[str] = []
        for part in text.replace("\n", " ").split(" "):
            found += self.pattern.findall(part.lower()) if PLAIN.fullmatch(part) else self._by_library(part)
        return found

    def cut(self, text: str) -> tuple[Counter[str], int]:
        """The pre-tokens of a text with their frequencies, and the number of added tokens in it."""
        if self.added is None or not self.added.search(text):
            return Counter(self._cut(text)), 0
        parts = self.added.split(text)
        found: Counter[str] = Counter()
        for part in parts:
            found.update(self._cut(part))
        return found, len(parts) - 1

    def pieces(self, word: str) -> int:
        """How many ids the library gives one pre-token."""
        parts = [word]
        for step in self.rest:
            parts = [piece for part in parts for piece, _ in step.pre_tokenize_str(part)]
        return sum(len(self.library.model.tokenize(part)) for part in parts)


@functools.lru_cache(maxsize=1)
def cutter(path: str) -> Cutter:
    return Cutter(path)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in groups of seven bits, low groups first; the top bit marks that more follow."""
    values = values.astype(np.uint64)
    length = np.ones(len(values), np.int64)
    for k in range(1, 10):
        length += values >> np.uint64(7 * k) > 0
    start = np.cumsum(length) - length
    out = np.zeros(int(length.sum()), np.uint8)
    for k in range(int(length.max(initial=0))):
        has = length > k
        group = (values[has] >> np.uint64(7 * k)).astype(np.uint8) & 127
        out[start[has] + k] = group | ((length[has] > k + 1) << 7).astype(np.uint8)
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    octets = np.frombuffer(data, np.uint8)
    if not len(octets):
        return np.zeros(0, np.uint64)
    start = np.flatnonzero(np.concatenate([[True], octets[:-1] < 128]))
    place = np.arange(len(octets)) - np.repeat(start, np.diff(np.append(start, len(octets))))
    return np.bitwise_or.reduceat((octets & 127).astype(np.uint64) << (7 * place).astype(np.uint64), start)


def _frequencies(counts: Counter[str], numbers: dict[str, int]) -> bytes:
    """The frequencies as steps between sorted numbers, followed by the counts."""
    found = np.fromiter((numbers.setdefault(w, len(numbers)) for w in counts), np.int64, len(counts))
    order = np.argsort(found)
    return packed(np.concatenate([np.diff(found[order], prepend=0), np.fromiter(counts.values(), np.int64, len(counts))[order]]))


def _weighed(data: bytes, pieces: np.ndarray) -> int:
    values = unpacked(data).astype(np.int64)
    half = len(values) // 2
    return int(pieces[np.cumsum(values[:half])] @ values[half:])


def coded_blocks(docs: DataFrame, path: str, text: str) -> DataFrame:
    """A row per document (``row``, ``n_bytes``, ``added``, ``counts``) and one per block (``words``)."""
    others = [docs[c] for c in docs.columns if c not in (text, "n_bytes", "n_tokens")]
    docs = docs.select(F.struct(*others).alias("row"), docs[text].alias("text"), F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("bigint").alias("n_bytes"))
    kind = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("row", docs.schema["row"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("added", T.LongType()),
            T.StructField("counts", T.BinaryType()),
            T.StructField("words", T.ArrayType(T.StringType())),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, numbers, held = cutter(path), {}, 0
        first = TaskContext.get().partitionId() << 32
        block = first

        def documents(rows: pa.StructArray, sizes: pa.Array, made: list[tuple[bytes, int]]) -> pa.RecordBatch:
            n, added = len(made), pa.array([a for _, a in made], pa.int64())
            counts, none = pa.array([c for c, _ in made], pa.binary()), pa.nulls(n, pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), rows, sizes, added, counts, none], kind.names)

        def words(row: pa.DataType) -> pa.RecordBatch:
            none = [pa.nulls(1, t) for t in (row, pa.int64(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *none, pa.array([list(numbers)], pa.list_(pa.string()))], kind.names)

        row = None
        for batch in batches:
            rows, texts, sizes = batch.columns
            row, made, at = rows.type, [], 0
            for i in range(batch.num_rows):
                said = texts[i].as_py() or ""
                counts, added = own.cut(said)
                made.append((_frequencies(counts, numbers), added))
                held += sizes[i].as_py()
                full = held >= BLOCK_BYTES
                if full or len(made) >= ROWS or i + 1 == batch.num_rows:
                    yield documents(rows[at : i + 1], sizes[at : i + 1], made)
                    made, at = [], i + 1
                if full:
                    yield words(row)
                    numbers, held, block = {}, 0, block + 1
        if numbers:
            yield words(row)

    return docs.select("row", "text", "n_bytes").mapInArrow(cut, kind)


def _pieces(words: DataFrame, path: str) -> DataFrame:
    """(block, at, pieces) of (block, at, word): equal words meet, sorted, and are encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, n = cutter(path), None, 0
        for batch in batches:
            found = []
            for word in batch.column(2).to_pylist():
                if word != last:
                    last, n = word, own.pieces(word)
                found.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.int32())], ["block", "at", "pieces"])

    met = words.repartition("word").sortWithinPartitions("word")
    return met.select("block", "at", "word").mapInArrow(encode, "block bigint, at int, pieces int")


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_bytes`` (UTF-8) and ``n_tokens`` by the tokenizers file at ``path``."""
    coded = materialize(coded_blocks(docs, path, text))
    rows = coded.where(F.col("words").isNull()).drop("words")
    words = coded.where(F.col("words").isNotNull()).select("block", F.posexplode("words").alias("at", "word"))
    kind = T.StructType([coded.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        pieces = np.zeros(right.num_rows, np.int64)
        pieces[right["at"].to_numpy()] = right["pieces"].to_numpy()
        found = [a.as_py() + _weighed(c.as_py(), pieces) for a, c in zip(left["added"], left["counts"], strict=True)]
        return pa.table([left["row"], left["n_bytes"], pa.array(found, pa.int64())], kind.names)

    counted = rows.groupBy("block").cogroup(_pieces(words, path).groupBy("block")).applyInArrow(summed, kind)
    return counted.select("row.*", "n_bytes", "n_tokens")
