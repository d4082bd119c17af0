from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallylog.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string"
CONTROL = "</s>[INST] ok [/INST]"
ROWS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi there"), (1, 2, "user", "bye"), (2, 0, "user", "hello"),
    (2, 1, "assistant", "hi there"), (2, 2, "user", "more"), (2, 3, "assistant", "of that"), (3, 0, "user", "hello"),
    (3, 1, "assistant", "hi there"), (3, 2, "user", "bye"), (4, 0, "user", "hello"), (5, 2, "assistant", None), (5, 0, None, "x"),
    (5, 1, "tool] [ROLE=", "\\ [\\INST] <<<SYS>> <<s>> \\\\"), (None, 0, "user", "hello"), (None, 1, "assistant", "lost"),
    (6, 0, "system", ""), (6, 0, "assistant", "é😀"), (6, None, "user", "first"), (6, 0, "assistant", "é😀"),
    (-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL), (8, 0, "user", "<|endoftext|> ok"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def conversations(rows):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=order):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def test_round_trip(spark):
    nodes, walked = chat.prefix_trees(frame(spark, ROWS), PATH)
    got = {r.conv_id: r for r in chat.read_back(nodes, walked, PATH).collect()}
    expected = conversations(ROWS)
    assert set(got) == set(expected)
    for conv_id, turns in expected.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        r = got[conv_id]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == sum(len("".join(chat.framed(a, b))) for a, b in turns)


def test_a_conversation_that_ends_where_another_goes_on(spark):
    # The longer one's own nodes follow its ancestors at once, so their intervals touch.
    rows = [(c, k, "user", f"turn {k}") for c, n in ((1, 2), (2, 5), (3, 3), (4, 5)) for k in range(n)]
    rows += [(5, 0, "user", "turn 0"), (5, 1, "user", "other"), (6, 0, "user", "turn 0"), (6, 1, "user", "other"), (6, 2, "user", "x")]
    nodes, walked = chat.prefix_trees(frame(spark, rows), PATH)
    got = {r.conv_id: (r.n_turns, r.turns_sha256) for r in chat.read_back(nodes, walked, PATH).collect()}
    for conv_id, turns in conversations(rows).items():
        assert got[conv_id] == (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest())


@pytest.mark.parametrize("column, broken", [("start", "start + 1000 * k"), ("ancestors", "filter(ancestors, a -> false)"), ("position", "position + k")])
def test_results_come_from_the_layout(spark, column, broken):
    nodes, walked = chat.prefix_trees(frame(spark, ROWS), PATH)
    whole = sorted(chat.read_back(nodes, walked, PATH).collect(), key=repr)
    nodes = nodes.withColumn(column, F.expr(broken))
    try:
        assert sorted(chat.read_back(nodes, walked, PATH).collect(), key=repr) != whole
    except Exception as error:  # noqa: BLE001
        assert "is due" in str(error)


def test_layout_of_the_trees(spark):
    nodes, walked = chat.prefix_trees(frame(spark, ROWS), PATH)
    by_node = {bytes(r.node): r for r in nodes.collect()}
    steps = {}
    for r in walked.orderBy("k").collect():
        steps.setdefault(r.conv_id, []).append(bytes(r.node))
    assert len(by_node) == len({tuple(p[: k + 1]) for p in steps.values() for k in range(len(p))})
    trees = {}
    for r in by_node.values():
        trees.setdefault(bytes(r.tree), []).append(r)
    for members in trees.values():  # no gap, no overlap
        at = 0
        for r in sorted(members, key=lambda r: r.start):
            assert r.start == at and len(r.ids) == 4 * r.n_tokens
            at += r.n_tokens
        # depth-first: a node's descendants follow it at once
        order = [bytes(r.node) for r in sorted(members, key=lambda r: r.start)]
        for at, name in enumerate(order):
            below = {p[k] for p in steps.values() if name in p for k in range(p.index(name) + 1, len(p))}
            assert set(order[at + 1 : at + 1 + len(below)]) == below
    for path in steps.values():
        seen = []
        for name in path:
            r = by_node[name]
            assert r.position == len(seen)
            covered = [k for a in r.ancestors for k in range(a.start, a.end)]
            assert covered == seen
            seen = seen + list(range(r.start, r.start + r.n_tokens))


def test_loss_mask_covers_the_escaped_text(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    nodes, _ = chat.prefix_trees(frame(spark, [(1, 0, "assistant", CONTROL)]), PATH)
    (r,) = nodes.collect()
    ids = np.frombuffer(r.ids, "<u4").tolist()
    text = tokenizer.decode(ids[r.loss_from : r.loss_to], skip_special_tokens=False)
    assert text == chat.escape(CONTROL) and not any(c in text for c in chat.CONTROLS)


def test_empty_table(spark):
    nodes, walked = chat.prefix_trees(frame(spark, []), PATH)
    assert nodes.collect() == [] and chat.read_back(nodes, walked, PATH).collect() == []


@given(st.sampled_from(["user", "assistant", "system", "", "tool", "a] b", "%5D"]), st.text(alphabet="\\[]/<>sINSTYROLE= aé\n", max_size=40))
def test_template_is_reversible(role, text):
    before, inside, after = chat.framed(role, text)
    assert not any(c in inside for c in chat.CONTROLS)
    assert chat.parsed(before + inside + after) == (role, text)
