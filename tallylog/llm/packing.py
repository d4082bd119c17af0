"""Best-fit packing of tokenised documents, planned on the histogram of lengths.

A piece is at most ``capacity`` tokens long, so all that a plan needs is how many pieces there are
of each length: at most ``capacity`` numbers, however large the corpus. The plan is made of slots, each
a run of equal sequences that take one piece of a length at one offset. Pieces are then numbered
within their length and look their slot up. So the packing is one of the whole corpus, not of each partition.

Pieces of more than a third of the capacity go at most two to a sequence: from the longest down, each is
matched with the longest other one that still fits. Shorter pieces follow, from the longest down, each into the smallest
gap that holds it, and open a new sequence only where none does.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylog.llm.common import hold, shared_path, small_batches

CAPACITY = 4096
END = 1
# Ids are wide: small row groups bound what a task holds while it writes.
_WRITTEN = {"compression": "zstd", "parquet.block.size": 16 << 20}
# Pieces of one length and number block that are put in order in one task, about.
NUMBERED = 50_000
# Words whose ids a task remembers.
_CACHE = 120_000
_PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_PIECE = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


class Encoder(dict):
    """Ids of words as packed numbers, for a vocabulary that splits at white space and drops it.

    The ids of a text are then those of its words, and most words have been seen before. Case of ASCII letters
    doesn't matter to the vocabulary, except in its special tokens, so only texts that may hold one keep theirs.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        # How the vocabulary spells a letter, for words of plain lower-case letters: such a word is one
        # pre-token, which the model itself takes much faster than the whole chain of steps.
        letters = (chr(c) for c in range(0x180))
        spelled = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters if c.isalpha() and c == c.lower()}
        self.spelling = str.maketrans(spelled)
        self.plain = set(spelled)
        self.packed = [number.to_bytes(4, "little") for number in range(self.tokenizer.get_vocab_size())]

    def __missing__(self, word: bytes) -> bytes:
        ids = self._of(word)
        if len(word) <= 64:
            self[word] = ids
        return ids

    def _of(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():
            return b"".join([self.packed[token.id] for token in self.tokenize(word.decode())])
        if b"<|" not in word:
            stem = word.rstrip(_PUNCTUATION)
            # Letters or digits and the marks after them are separate tokens.
            if len(stem) < len(word) and stem[-1:].isalnum():
                return self[stem] + self[word[len(stem) :]]
        text = word.decode("utf-8", "replace")
        if self.plain.issuperset(text):
            return b"".join([self.packed[token.id] for token in self.tokenize(text.translate(self.spelling))])
        return b"".join([self.packed[k] for k in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def ids(self, text: bytes) -> bytes:
        if len(self) > _CACHE:  # words met early are the frequent ones
            for word in list(islice(self, _CACHE // 2, None)):
                del self[word]
        if b"<|" in text:
            words = text.split()
        elif b"\xcc" in text or b"\xcd" in text:
            # The vocabulary composes letters with the marks U+0300 to U+037F after them before it lower-cases.
            words = [word if b"\xcc" in word or b"\xcd" in word else word.lower() for word in text.split()]
        else:
            words = text.lower().split()
        return b"".join([self[word] for word in words])


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenized(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces ``doc_id, piece, start, length, ids`` of every document, ``ids`` as packed 32-bit numbers.

    Every document ends with the id 1, so a null or empty text is one piece of one token. Only documents longer
    than the capacity are cut, into full pieces and a rest.
    """
    ending = np.array([END], "<u4").tobytes()

    @F.arrow_udf(T.ArrayType(_PIECE))
    def pieces(texts: pa.Array) -> pa.Array:
        hold("packing", _encoder.cache_clear)
        encoder, step = _encoder(path), 4 * capacity
        numbers, parts, ends = [], [], [0]
        for text in texts.cast(pa.binary()):
            ids = encoder.ids(text.as_py() or b"") + ending
            cut = [ids[k : k + step] for k in range(0, len(ids), step)]
            parts += cut
            numbers += range(len(cut))
            ends.append(len(parts))
        number = np.array(numbers, np.int64)
        columns = [
            pa.array(number.astype(np.int32)),
            pa.array(number * capacity),
            pa.array([len(part) // 4 for part in parts], pa.int64()),
            pa.array(parts, pa.binary()),
        ]
        found = pa.StructArray.from_arrays(columns, names=["piece", "start", "length", "ids"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)

    each = small_batches(docs).select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("t"))
    return each.select("doc_id", F.explode(pieces("t")).alias("p")).select("doc_id", "p.*")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Slots ``(length, first number, pieces, first sequence, offset)`` and the number of sequences.

    ``counts`` has the pieces of each length. A slot gives one piece to each of a run of sequences.
    """
    left = dict(counts)
    taken: dict[int, int] = {}
    slots: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, how many)
    sequences = 0

    def fill(length: int, times: int, first: int, run: int, offset: int) -> None:
        for k in range(times):
            number = taken.get(length, 0)
            slots.append((length, number, run, first, offset + k * length))
            taken[length] = number + run
        left[length] -= times * run

    def leave(gap: int, first: int, run: int) -> None:
        if gap and run:
            gaps.setdefault(gap, []).append((first, run))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for length in large:
        for other in (n for n in large if n <= min(length, capacity - length)):
            run = left[length] // 2 if other == length else min(left[length], left[other])
            if run:
                fill(length, 1, sequences, run, 0)
                fill(other, 1, sequences, run, length)
                leave(capacity - length - other, sequences, run)
                sequences += run
            if not left[length]:
                break
        if run := left[length]:
            fill(length, 1, sequences, run, 0)
            leave(capacity - length, sequences, run)
            sequences += run

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for gap in sorted(g for g in gaps if g >= length):
            if not left[length]:
                break
            runs = gaps.pop(gap)
            while runs and left[length]:
                first, run = runs.pop()
                times = min(gap // length, left[length])
                full = min(run, left[length] // times)
                fill(length, times, first, full, capacity - gap)
                leave(gap - times * length, first, full)
                if full < run:
                    runs.append((first + full, run - full))
            if runs:
                gaps.setdefault(gap, []).extend(runs)
        while left[length]:
            times = min(capacity // length, left[length])
            run = left[length] // times
            fill(length, times, sequences, run, 0)
            leave(capacity - times * length, sequences, run)
            sequences += run
    return slots, sequences


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``doc_id, piece, length, ids_crc32``) with ``sequence_id`` and ``offset``.

    Repeated rows take places of their own. An empty table gives no rows.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots, _ = plan(histogram, capacity)
    blocks = max(1, -(-sum(histogram.values()) // NUMBERED))
    table = np.array(sorted(slots) or [(0, 0, 0, 0, 0)], np.int64)
    # A slot by length and first number; a length takes the high bits.
    shift = np.int64(48)
    order, numbers = (table[:, 0] << shift) + table[:, 1], table[:, 1]
    firsts, offsets = table[:, 3], table[:, 4]

    @F.arrow_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        rank = ranks.to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted(order, (lengths.to_numpy(zero_copy_only=False).astype(np.int64) << shift) + rank, "right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(firsts[at] + rank - numbers[at]), pa.array(offsets[at])], names=["sequence_id", "offset"]
        )

    dealt = pieces.withColumn("_block", F.expr(f"CAST(pmod(xxhash64(doc_id, piece), {blocks}) AS INT)"))
    before = dealt.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("n"))
    before = before.select(
        "length",
        "_block",
        # As many rows for a length as there are blocks.
        F.expr("sum(n) OVER (PARTITION BY length ORDER BY _block) - n").alias("_before"),
    )
    ranked = dealt.withColumn(
        "_rank", F.expr("row_number() OVER (PARTITION BY length, _block ORDER BY doc_id, piece, ids_crc32) - 1")
    )
    ranked = ranked.join(before, ["length", "_block"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    return ranked.select(*pieces.columns, place("length", "_rank").alias("_place")).select(*pieces.columns, "_place.*")


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """The pieces with their ids, written once to the shared folder, and the place of each piece."""
    spark = docs.sparkSession
    folder = shared_path(spark, "pieces")
    tokenized(docs, path, key, text, capacity).write.options(**_WRITTEN).parquet(folder)
    pieces = spark.read.parquet(folder)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pieces, placed(narrow, capacity)


def sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of the packed sequences; none is longer than the capacity.

    Keys must be unique, or repeated with equal texts only.
    """
    keys = ["doc_id", "piece"]
    numbered = "row_number() OVER (PARTITION BY doc_id, piece ORDER BY {})"
    ids = pieces.select(*keys, "ids", F.expr(numbered.format("crc32(ids)")).alias("k"))
    joined = places.withColumn("k", F.expr(numbered.format("ids_crc32"))).alias("p").join(
        ids.alias("i"), F.expr("p.doc_id <=> i.doc_id AND p.piece = i.piece AND p.k = i.k")
    )
    parts = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"))
