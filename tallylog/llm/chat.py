"""Chat conversations as prefix trees: turns that conversations share from the start are emitted once.

A node of a tree is a turn after certain earlier turns; its name is a digest of the path to it. All
conversations with the same first turn make one tree, which is laid out depth-first as one token sequence. A node
carries its place there, its tokens, the position of its first token (what a conversation
read alone would give it), and the intervals of the sequence that hold its ancestors. A token may attend to those and to
the tokens of its own node before it, so every conversation sees just what it would see alone.

Depth-first order is the order of the conversations by their paths: each adds the nodes that none before it
has, its segment, right where they belong. Conversations are put in order by range, and places
are sums over blocks of conversations, so a tree may hold any number of them.

The template marks turns by control strings. In a text, a backslash is doubled and a control string gets
one after its first character, which can be undone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylog.llm.common import cut_lineage, hold, small_batches

# The control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE=", "[/ROLE]")
FRAMES = {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<s><<SYS>>\n", "\n<</SYS>>\n\n")}
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(\\?)")
# A block of places is this many conversations, as a power of two.
_BLOCK_BITS = 12


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def framed(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the escaped text, and what stands after it."""
    before, after = FRAMES.get(role) or (f"<s>[ROLE={quote(role, safe='')}] ", " [/ROLE]")
    return before, escape(text), after


def parsed(turn: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    for role, (before, after) in FRAMES.items():
        if turn.startswith(before) and turn.endswith(after):
            return role, unescape(turn[len(before) : len(turn) - len(after)])
    head, _, rest = turn.removeprefix("<s>[ROLE=").partition("] ")
    return unquote(head), unescape(rest.removesuffix(" [/ROLE]"))


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


_PATH_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("ck", pa.string()), ("k", pa.int64()), ("tree", pa.binary()), ("parent", pa.binary()),
     ("node", pa.binary()), ("position", pa.int64()), ("n_tokens", pa.int64()), ("loss_from", pa.int64()),
     ("loss_to", pa.int64()), ("ids", pa.binary()), ("path", pa.binary())]
)
_PATHS = (
    "conv_id bigint, ck string, k bigint, tree binary, parent binary, node binary, position bigint, n_tokens bigint, "
    "loss_from bigint, loss_to bigint, ids binary, path binary"
)


def _sorted(df: DataFrame, key: str, *order: str) -> DataFrame:
    return df.repartition(F.col(key)).sortWithinPartitions(key, *order)


def paths(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """A row for every turn in order: its node, parent, tree, tokens and position; the last one has the whole path.

    Conversations stream through a task, sorted; only digests of the one at hand are held.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("chat", _tokenizer.cache_clear)
        tokenizer = _tokenizer(tokenizer_path)
        here, rows, last = None, [], None
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("conv_id", "ck", "role", "text")]
            frames = [framed(role, text) for role, text in zip(columns[2], columns[3])]
            found = tokenizer.encode_batch([part for frame in frames for part in frame], add_special_tokens=False)
            for at, (conv_id, ck, role, text) in enumerate(zip(*columns)):
                parts = [np.array(e.ids, "<u4") for e in found[3 * at : 3 * at + 3]]
                if ck != here:
                    if last is not None:
                        rows.append(last | {"path": bytes(path)})
                    here, last, parent, tree, position, k, path = ck, None, b"", None, 0, 0, bytearray()
                name = f"{len(role)}:{role}{text}".encode()
                node = hashlib.sha256(parent + name).digest()[:16]
                tree = tree or node
                path += node
                if last is not None:
                    rows.append(last)
                ids = np.concatenate(parts)
                loss = (len(parts[0]), len(parts[0]) + len(parts[1])) if role == "assistant" else (0, 0)
                last = {"conv_id": conv_id, "ck": ck, "k": k, "tree": tree, "parent": parent or None, "node": node,
                        "position": position, "n_tokens": len(ids), "loss_from": loss[0], "loss_to": loss[1],
                        "ids": ids.tobytes(), "path": None}
                parent, position, k = node, position + len(ids), k + 1
            yield pa.RecordBatch.from_pylist(rows, _PATH_SCHEMA)
            rows = []
        if last is not None:
            yield pa.RecordBatch.from_pylist([last | {"path": bytes(path)}], _PATH_SCHEMA)

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    conv_id = F.col("conv_id").cast("bigint")
    key = F.coalesce(conv_id.cast("string"), F.lit("null")).alias("ck")
    turns = small_batches(conversations).select(conv_id.alias("conv_id"), key, "turn", *text)
    return _sorted(turns, "ck", "turn", "role", "text").select("conv_id", "ck", "role", "text").mapInArrow(walk, _PATHS)


def prefix_trees(conversations: DataFrame, tokenizer_path: str) -> tuple[DataFrame, DataFrame]:
    """``nodes`` in their trees, and ``paths`` (``conv_id, ck, k, node``) of the conversations.

    ``conversations`` has ``conv_id, turn, role, text``; other columns play no part. Turns are taken by number, equal
    numbers by role and text, null numbers first. Null roles and texts count as empty, rows without a conv_id
    as one conversation. Repeated conversations share all their nodes. An empty table gives no rows.

    A node has ``tree, node, parent, k`` (its depth), ``start`` (its place in the tree's sequence), ``n_tokens``, ``position``,
    ``ids`` (packed 32-bit), ``loss_from, loss_to`` (its tokens under the loss mask) and ``ancestors``, the
    intervals ``(start, end)`` it attends to outside itself.
    """
    every = cut_lineage(paths(conversations, tokenizer_path))
    # A conversation for each different path, in depth-first order; the id grows along that order.
    leaves = every.filter("path IS NOT NULL").groupBy("path").agg(F.min("ck").alias("ck")).orderBy("path")
    leaves = cut_lineage(leaves.select("ck", F.monotonically_increasing_id().alias("rank")))
    walked = every.join(leaves.hint("merge"), "ck")
    carried = ["tree", "parent", "k", "position", "n_tokens", "loss_from", "loss_to", "ids"]
    nodes = walked.groupBy("node").agg(F.min("rank").alias("owner"), F.first(F.struct(*carried)).alias("n"))
    nodes = cut_lineage(nodes.select("node", "owner", "n.*"))

    sizes = nodes.select("node", "tree", "owner", "k", "n_tokens", F.shiftright("owner", _BLOCK_BITS).alias("block"))
    blocks = sizes.groupBy("tree", "block").agg(F.sum("n_tokens").alias("tokens"))
    # A row for each block of conversations, then the nodes of one block.
    blocks = blocks.select(
        "tree", "block", F.expr("sum(tokens) OVER (PARTITION BY tree ORDER BY block) - tokens").alias("before")
    )
    inside = "sum(n_tokens) OVER (PARTITION BY tree, block ORDER BY owner, k) - n_tokens"
    placed = sizes.withColumn("inside", F.expr(inside)).join(blocks, ["tree", "block"])
    placed = cut_lineage(placed.select("node", "owner", "n_tokens", (F.col("before") + F.col("inside")).alias("start")))

    # Along a path owners only grow, and the nodes of one owner lie side by side.
    on_path = walked.select("rank", "node").join(placed.hint("merge"), "node")
    runs = on_path.groupBy("rank", "owner").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("n_tokens")).alias("end")
    )
    # As many runs as the path has branchings.
    runs = runs.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("owner", "start", "end"))).alias("runs"))
    full = nodes.join(placed.select("node", "start"), "node").join(runs, F.col("owner") == F.col("rank"))
    above = F.expr("transform(filter(runs, r -> r.owner < owner), r -> named_struct('start', r.start, 'end', r.end))")
    own = F.expr("transform(filter(runs, r -> r.owner = owner AND r.start < start), r -> named_struct('start', r.start, 'end', start))")
    nodes = full.select("tree", "node", "parent", "k", "start", "n_tokens", "position", "ids", "loss_from", "loss_to",
                        F.concat(above, own).alias("ancestors"))
    return nodes, every.select("conv_id", "ck", "k", "node")


def _stretches(intervals: str) -> str:
    """SQL of intervals in order with touching ones made one."""
    first = f"filter({intervals}, (r, i) -> i = 0 OR {intervals}[i - 1].end != r.start)"
    last = f"filter({intervals}, (r, i) -> i = size({intervals}) - 1 OR {intervals}[i + 1].start != r.end)"
    return f"zip_with({first}, {last}, (a, b) -> named_struct('start', a.start, 'end', b.end))"


def read_back(nodes: DataFrame, walked: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digests of every conversation, read from its tree's sequence.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. Of a conversation only its last node is
    taken from ``walked``. Its turns are what lies in the intervals that node attends to, in order of position, and then the
    node itself; an error says if their tokens leave a gap. Empty tables give no rows.
    """
    own = "named_struct('start', start, 'end', start + n_tokens)"
    seen = nodes.withColumn("seen", F.expr(f"concat(ancestors, array({own}))")).withColumn("seen", F.expr(_stretches("seen")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("chat", _tokenizer.cache_clear)
        tokenizer = _tokenizer(tokenizer_path)
        for batch in batches:
            ids = [np.frombuffer(v, "<u4").tolist() for v in batch["ids"].to_pylist()]
            turns = tokenizer.decode_batch(ids, skip_special_tokens=False)
            spans = zip(ids, batch["loss_from"].to_pylist(), batch["loss_to"].to_pylist())
            losses = tokenizer.decode_batch([v[a:b] for v, a, b in spans], skip_special_tokens=False)
            rows = [(*parsed(turn), unescape(loss), len(turn)) for turn, loss in zip(turns, losses)]
            out = list(zip(*rows)) or [[], [], [], []]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
            kept = [batch[name] for name in ("tree", "stretch", "start", "position", "n_tokens")]
            arrays = [*kept, *(pa.array(c, t) for c, t in zip(out, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names=["tree", "stretch", "start", "position", "n_tokens", "role", "text", "loss", "chars"])

    # All conversations through a node see it in a stretch that begins at the same place.
    texts = seen.select(
        "tree", F.expr("seen[size(seen) - 1].start AS stretch"), "start", "position", "n_tokens", "ids", "loss_from", "loss_to"
    ).mapInArrow(
        decode,
        "tree binary, stretch bigint, start bigint, position bigint, n_tokens bigint, role string, text string, loss string, chars bigint",
    )
    leaves = walked.groupBy("ck").agg(F.max(F.struct("k", "node", "conv_id")).alias("l")).select("ck", "l.node", "l.conv_id")
    leaves = leaves.join(seen.select("node", "tree", "seen").hint("merge"), "node")
    wanted = leaves.select("conv_id", "ck", "tree", F.explode("seen").alias("s"))
    wanted = wanted.select("conv_id", "ck", "tree", F.col("s.start").alias("stretch"), F.col("s.end").alias("end"))
    turns = wanted.join(texts.hint("merge"), ["tree", "stretch"]).filter(F.col("start") < F.col("end"))
    turns = turns.select("conv_id", "ck", "position", "n_tokens", "role", "text", "loss", "chars")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, None

        def closed() -> dict:
            conv_id, n, sha, loss_chars, loss, chars, _ = state
            return {"conv_id": conv_id, "n_turns": n, "turns_sha256": sha.hexdigest(), "loss_chars": loss_chars,
                    "loss_sha256": loss.hexdigest(), "formatted_chars": chars}

        for batch in batches:
            rows = []
            for conv_id, ck, position, n_tokens, role, text, loss, chars in zip(
                *(batch[c].to_pylist() for c in ("conv_id", "ck", "position", "n_tokens", "role", "text", "loss", "chars"))
            ):
                if ck != here:
                    if state:
                        rows.append(closed())
                    here, state = ck, [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                if position != state[6]:
                    raise ValueError(f"conversation {ck} has a token of position {position} where {state[6]} is due")
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += chars
                state[6] += n_tokens
            yield pa.RecordBatch.from_pylist(rows, schema)
        if state:
            yield pa.RecordBatch.from_pylist([closed()], schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    columns = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return _sorted(turns, "ck", "position").mapInArrow(digests, columns)
