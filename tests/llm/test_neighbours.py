from __future__ import annotations

import math
import pathlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from tallylog.llm import neighbours
from tallylog.llm.queries import QUERIES

QUERY = "vec_id % 20 = 0"
FOLDER = pathlib.Path("/root/testdata/sf0.1")


def brute_force(vectors: dict, k=20):
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in ids[ids % 20 == 0]:
        scores = (matrix * np.array(vectors[q], float)).sum(axis=1)
        scores[ids == q] = -math.inf
        top = np.lexsort((ids, -scores))[: min(k, len(ids) - 1)]
        out[int(q)] = [(int(ids[t]), float(scores[t])) for t in top]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(found, expected):
    hits = sum(len({v for v, _ in found.get(q, [])} & {v for v, _ in best}) for q, best in expected.items())
    return hits / max(1, sum(map(len, expected.values())))


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
def test_recall_on_the_whole_table(spark):
    rows = pq.read_table(FOLDER / "embeddings.parquet").to_pylist()
    found = answers(QUERIES["op9_collision_counting"](spark, str(FOLDER)))
    expected = brute_force({r["vec_id"]: r["embedding"] for r in rows})
    assert set(found) == set(expected) and all(len(found[q]) == 20 for q in found)
    assert recall(found, expected) >= 0.97
    for q, best in found.items():
        assert best == sorted(best, key=lambda p: (-p[1], p[0])) and q not in {v for v, _ in best}


def test_blocks_lengths_and_copies(spark):
    draw = np.random.default_rng(1)
    matrix = draw.standard_normal((900, 12)) * draw.uniform(0.1, 5, (900, 1))
    matrix[300:650] = matrix[40]  # copies of a query
    vectors = {k: row.tolist() for k, row in enumerate(matrix)}
    df = spark.createDataFrame([(k, v, "x") for k, v in vectors.items()], "vec_id bigint, embedding array<double>, block string")
    found = answers(neighbours.neighbours(df, QUERY, block=200, group=16))
    expected = brute_force(vectors)
    assert recall(found, expected) >= 0.95
    assert [v for v, _ in found[40]] == [v for v, _ in expected[40]]


def test_rows_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (6, [None, 1.0]),
        (7, []), (8, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (1, [0.5, 0.5]), (9, [-1.0, 0.0]), (20, [1.0, 0.0]), (40, None), (60, [1.0, 0.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = answers(neighbours.neighbours(df, QUERY))
    assert found == {
        0: [(20, 1.0), (1, 0.5), (9, -1.0)], 20: [(0, 1.0), (1, 0.5), (9, -1.0)], 60: [(8, 1.0)]
    }


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert neighbours.neighbours(df, QUERY).collect() == []
