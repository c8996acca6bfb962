"""Mined negatives against SQL and plain loops; packed products against plain ones."""

import duckdb
import numpy as np
import pytest

from vaultkit.llm import hard_negatives as H

SF = "/root/testdata/sf0.001"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({H.ORACLE_SQL})").fetchall()
    got = rows_of(H.op13_hard_negatives(spark, SF))
    assert got == sorted(want, key=str) and len(got) > 50


@pytest.mark.parametrize("top", [3, 300, 200_000, 40_000_000])
def test_packed_products_are_exact(top):
    """Fields of one wide double, then of Python integers of more bits than a double holds."""
    rng = np.random.default_rng(top)
    a, x = rng.integers(-top, top + 1, (7, 24)), rng.integers(-top, top + 1, (33, 24))
    width = int(24 * (2 * top) ** 2).bit_length()
    wide, fields = H.pack(x, -top, width)
    assert (wide.dtype == object) == (width > H.EXACT) and fields == (H.EXACT // width or H.FIELDS)
    assert (H.scores(a, x, -top, width) == a @ x.T).all()


def brute(rows, every=50, positives=5, negatives=3, least=50, most=95):
    ok = [(i, v, lab) for i, v, lab in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    q = [np.floor(256 * np.array(v, np.float64)).astype(np.int64) for _, v, _ in ok]
    dot = lambda a, b: int((a[:min(len(a), len(b))] * b[:min(len(a), len(b))]).sum())
    out = []
    for i, (a, _, lab) in enumerate(ok):
        if a is None or a % every:
            continue
        scored = sorted((-dot(q[i], q[j]), ok[j][0] is None, ok[j][0] or 0, j) for j in range(len(ok)) if j != i)
        for s, none, p, j in [x for x in scored if ok[x[3]][2] == lab][:positives]:
            found = [x for x in scored if ok[x[3]][2] != lab and least * -s <= 100 * -x[0] <= most * -s][:negatives]
            out += [(a, None if none else p, r + 1, None if x[1] else x[2], -s, -x[0]) for r, x in enumerate(found)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(512, 4096), (2, 16)])
def test_nulls_ties_and_repeated_rows(spark, sizes):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.choice([-0.5, 0.25, 1.0], 4)], int(rng.integers(0, 3))) for i in range(120)]
    rows += [(50, rows[50][1], rows[50][2]), (None, [1.0] * 4, 1), (200, None, 1), (201, [1.0] * 4, None), (202, [1.0, None, 1.0, 1.0], 0),
             (203, [float("nan")] * 4, 0), (204, [float("inf")] * 4, 0), (150, [1.0, 1.0], 2), (250, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' AS at", "1 AS id", "2 AS score", "3 AS rank")
    assert rows_of(H.hard_negatives(df, sizes=sizes)) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert H.hard_negatives(df).count() == 0


@pytest.mark.parametrize("top, dims, labels", [(1.0, 4, 400), (1.0, 96, 2), (1.0, 1, 3), (3e6, 5, 4)])
def test_cells_of_several_blocks(spark, top, dims, labels):
    """Many cells, some without an anchor or a candidate; many labels, few of them, long vectors, fields wider than a double."""
    rng = np.random.default_rng(dims)
    rows = [(i if i % 9 else None, [float(np.float32(x)) for x in top * rng.normal(0, 0.3, dims).round(1)], int(rng.integers(0, labels))) for i in range(1, 420)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = rows_of(H.hard_negatives(df, every=5, sizes=(23, 16)))
    assert got == brute(rows, every=5)
    assert got or labels == 400


def test_rows_found_grow_with_the_table_only(spark, monkeypatch):
    """Cells keep the best rows of all their blocks, so what is shuffled does not grow with blocks of anchors times blocks of candidates."""
    found, tasks = [], H.tasks
    monkeypatch.setattr(H, "tasks", lambda df, run, schema: found.append(tasks(df, run, schema)) or found[-1])
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 4)], int(rng.integers(0, 2))) for i in range(3000)]
    H.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), sizes=(8, 16)).count()
    counts = [df.count() for df in found if "anchor" in df.columns]
    assert len(counts) == 2 and max(counts) <= len(rows)
