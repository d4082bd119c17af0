"""Token counts of documents, by counting the pieces of each distinct pre-token once.

A tokeniser cuts a text into pre-tokens, which it encodes one by one; a pre-token always has the same number of pieces. So

1. the documents are dealt into blocks of ``BLOCK_BYTES`` of text, and a block is stored as its distinct pre-tokens and how often each
   of its documents has them (rows of a sparse matrix),
2. the distinct pre-tokens of all blocks together are encoded once each, and only the number of pieces is kept,
3. the numbers go back to the blocks by a join on the pre-token, and a block's documents sum frequency times pieces.

No ids are ever kept. The join has one row for a pre-token and block, so one that is in every document, however often, is as many rows as
there are blocks. A block is a bounded amount of text (or one long document), and so is everything that is gathered by it.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain
from unicodedata import category

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylog.llm.common import hold, shared_path, small_batches

TOKEN_LIMIT = 2048
BLOCK_BYTES = 32 << 20
_WRITTEN = {"compression": "zstd", "parquet.block.size": 16 << 20}
# Code points that the vocabulary's steps change one by one, whatever stands beside them: those below the first combining marks.
_PLAIN = [chr(c) for c in range(0x180)]


def _bytes_as_letters() -> dict[int, str]:
    """How a byte-level vocabulary writes a byte: as itself if it prints in Latin-1, else as the next free code point from 256."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _plain_cut() -> re.Pattern:
    """How the vocabulary cuts lower-case words of plain code points; the library itself cuts all others."""
    letters, numbers = ("".join(c for c in _PLAIN if category(c)[0] == kind) for kind in "LN")
    spaces = "\t\n\x0b\x0c\r \x85\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")


class PreTokens:
    """The pre-tokens of words, for a vocabulary that lower-cases, drops white space and never lets a pre-token cross it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str("it's b2\n")
        if [part for part, _ in cut] != ["it", "'s", "b", "2"] or self.tokenizer.normalizer.normalize_str("A") != "a":
            raise ValueError(f"{path}: the vocabulary cuts words in another way than this operator")
        # Special tokens are found in the text as it came, before anything else.
        self.special = {token.content for token in self.tokenizer.get_added_tokens_decoder().values()}
        self.split = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")").split
        self.cut, self.letters = _plain_cut().findall, _bytes_as_letters()

    def __call__(self, word: bytes) -> list[str]:
        text = word.decode("utf-8", "replace")
        if "<|" in text:
            return [token for part in self.split(text) if part for token in ([part] if part in self.special else self._cut(part))]
        return self._cut(text)

    def _cut(self, text: str) -> list[str]:
        low = text.lower()
        if low.isascii() and low.isprintable() and text.isascii():
            return self.cut(low)
        if max(text) < "\u0180" and max(low) < "\u0180":
            return [token.encode().decode("latin-1").translate(self.letters) for token in self.cut(low)]
        normal = self.tokenizer.normalizer.normalize_str(text)
        return [token for token, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def pieces(self, token: str) -> int:
        return 1 if token in self.special else len(self.tokenizer.model.tokenize(token))


@lru_cache(maxsize=2)
def _pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


class Block(dict):
    """Documents gathered so far, as a sparse matrix of documents by pre-tokens; maps a word to the numbers of its pre-tokens."""

    def __init__(self, words: PreTokens):
        self.words, self.keys, self.sizes, self.held = words, [], [], 0
        self.at: dict[str, int] = {}
        self.lengths, self.steps, self.times = [], [], []

    def __missing__(self, word: bytes) -> list[int]:
        numbers = self[word] = [self.at.setdefault(token, len(self.at)) for token in self.words(word)]
        return numbers

    def add(self, key, text: bytes) -> None:
        # Case is dropped here only where composing letters and marks can't depend on it.
        words = (text.lower() if text.isascii() and b"<|" not in text else text).split()
        numbers, times = np.unique(np.fromiter(chain.from_iterable(map(self.__getitem__, words)), np.uint32), return_counts=True)
        self.lengths.append(len(numbers))
        self.steps.append(np.diff(numbers, prepend=np.uint32(0)))
        self.times.append(times.astype(np.uint32))
        self.keys.append(key)
        self.sizes.append(len(text))
        self.held += len(text)

    def row(self, number: int, key_type: pa.DataType) -> pa.RecordBatch:
        packed = [packed_numbers(part) for part in (self.steps, self.times)]
        values = [number, self.keys, self.sizes, list(self.at), self.lengths, *packed]
        kinds = [pa.int64(), pa.list_(key_type), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds)], names=COLUMNS)


def packed_numbers(parts: list[np.ndarray]) -> bytes:
    """Numbers as their low bytes, then their next ones, and so on, compressed: small numbers take about a byte."""
    whole = np.concatenate(parts).astype("<u4")
    return zstandard.compress(np.ascontiguousarray(whole.view(np.uint8).reshape(-1, 4).T).tobytes(), 6)


def unpacked_numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


COLUMNS = ["block", "doc_id", "n_bytes", "tokens", "lengths", "steps", "times"]


def blocks(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows ``block, doc_id[], n_bytes[], tokens[], lengths[], steps, times``: documents, and how often they have which pre-token.

    A document has ``lengths`` different pre-tokens; ``steps`` are the differences of their places in ``tokens``, and ``times`` their counts.
    Every row of the table is a document of its own, also where keys repeat. Null texts are empty. An empty table has no blocks.
    """
    kinds = ["bigint", f"array<{docs.schema[key].dataType.simpleString()}>", "array<bigint>", "array<string>", "array<int>", "binary", "binary"]

    def gather(batches):
        hold("token_counts", _pre_tokens.cache_clear)
        words, number = _pre_tokens(path), TaskContext.get().partitionId() << 33
        block, key_type = Block(words), None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                block.add(own, text.as_py() or b"")
                if block.held >= block_bytes:
                    yield block.row(number, key_type)
                    block, number = Block(words), number + 1
        if block.keys:
            yield block.row(number, key_type)

    narrow = small_batches(docs).select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("t"))
    return narrow.mapInArrow(gather, ", ".join(map(" ".join, zip(COLUMNS, kinds))))


def token_counts(
    docs: DataFrame, path: str, limit: int = TOKEN_LIMIT, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row: bytes in UTF-8, tokens, and whether they are more than ``limit``.

    Tokens are those that the library gives for the vocabulary at ``path`` (a ``.json`` file that drops case and white space), without
    added ones; special strings in a text are one token each. A null or empty text has none. Repeated rows and null keys
    are rows of the result like all others, an empty table gives none, and other columns play no part.
    """
    spark = docs.sparkSession
    folder = shared_path(spark, "token-blocks")
    blocks(docs, path, key, text, block_bytes).write.options(**_WRITTEN).parquet(folder)
    stored = spark.read.parquet(folder)

    @F.arrow_udf("int")
    def pieces(tokens: pa.Array) -> pa.Array:
        hold("token_counts", _pre_tokens.cache_clear)
        return pa.array([_pre_tokens(path).pieces(token) for token in tokens.to_pylist()], pa.int32())

    @F.arrow_udf("array<bigint>")
    def sums(lengths: pa.Array, steps: pa.Array, times: pa.Array, sizes: pa.Array) -> pa.Array:
        found, bounds = [], [0]
        for length, step, time, size in zip(lengths, steps, times, sizes):
            ends = np.cumsum(np.asarray(length.as_py(), np.int64))
            step, time = unpacked_numbers(step.as_py()), unpacked_numbers(time.as_py())
            # Places begin anew with each document.
            places = np.cumsum(step)
            begins = np.concatenate([[0], ends])[:-1]
            before = np.concatenate([[0], places])[begins]
            places -= np.repeat(before, np.diff(np.concatenate([[0], ends])))
            products = (size.values.to_numpy() & 0xFFFFFFFF)[places] * time if len(places) else places
            found.append(np.diff(np.concatenate([[0], np.cumsum(products)])[np.concatenate([[0], ends])]))
            bounds.append(bounds[-1] + len(ends))
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(found or [[]]), pa.int64()))

    # One shuffle by pre-token serves both sides of the join, which is why the distinct ones keep all columns until then.
    each = stored.select("block", F.posexplode("tokens").alias("place", "token")).repartition("token")
    counted = each.groupBy("token").agg(F.min(F.struct("block", "place")).alias("first")).filter("first IS NOT NULL")
    counted = counted.select("token", pieces("token").alias("pieces"))
    # A row of ``counted`` is one distinct pre-token of the corpus, of ``each`` one of a block.
    place = F.expr("place * 4294967296L + pieces")
    sized = each.join(counted.hint("merge"), "token").groupBy("block").agg(F.sort_array(F.collect_list(place)).alias("sizes"))
    whole = stored.drop("tokens").join(sized.hint("merge"), "block", "left")
    n_tokens = sums("lengths", "steps", "times", "sizes")
    rows = whole.select(F.explode(F.arrays_zip("doc_id", "n_bytes", n_tokens.alias("n_tokens"))).alias("d")).select("d.*")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
