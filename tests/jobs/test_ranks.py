"""Exact percentiles and positions against plain versions."""

import random

import numpy as np
import pytest

from tidemark.operators.ranks import RankedTable, exact_percentiles

SHARES = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p100": 1.0}


@pytest.mark.parametrize("most,cuts", [(1_000_000, 32), (4, 4), (1, 3)])
def test_percentiles_at_any_size_of_a_group(spark, most, cuts):
    r = random.Random(most)
    rows = [("a", r.gauss(0, 10)) for _ in range(400)] + [("b", float(r.randrange(3))) for _ in range(301)] + [("c", 5.0)] + [(None, float(i)) for i in range(8)]
    rows += [("d", None), ("a", None)]
    got = exact_percentiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", SHARES, most, cuts)
    found = {x.k: [x[n] for n in SHARES] for x in got.collect()}
    assert set(found) == {"a", "b", "c", None}
    for k, values in found.items():
        assert values == pytest.approx([float(np.quantile([v for g, v in rows if g == k and v is not None], p)) for p in SHARES.values()], abs=1e-9)


def test_percentiles_without_groups_or_rows(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "v int")
    assert exact_percentiles(df, [], "v", {"a": 0.25}, most=2, cuts=3).first().a == 2.5
    assert exact_percentiles(df.where("v > 99"), [], "v", {"a": 0.25}).collect()[0].a is None


def test_a_position_is_found_in_the_partitions_that_hold_it(spark, tmp_path):
    ids = random.Random(1).sample(range(100_000), 5000)
    table = RankedTable.write(spark.createDataFrame([(i, i % 7) for i in ids], "id long, x int"), str(tmp_path), ["id"], 20)
    ids.sort()
    assert table.total == 5000 and len(table.parts) == 20
    for start, n in ((0, 3), (2490, 40), (4990, 30), (4999, 1)):
        rows = table.slice(start, n)
        assert sorted((r.position, r.id) for r in rows.collect()) == list(enumerate(ids))[start : start + n]
    far = RankedTable(spark, str(tmp_path)).slice(2490, 40)  # found again by its path
    assert len(far._jdf.queryExecution().executedPlan().toString().split("part#")) > 1
    files = {p.parent.name for p in tmp_path.rglob("*.parquet")}
    assert len(files) == 20 and len({x.part for x in spark.read.parquet(f"{tmp_path}/rows").where(f"id BETWEEN {ids[2490]} AND {ids[2529]}").select("part").collect()}) <= 2
    assert table.slice(5000, 5).count() == 0 and table.slice(3, 0).count() == 0


def test_round_robin(spark, tmp_path):
    table = RankedTable.write(spark.range(5), str(tmp_path), ["id"], 2)
    batches = []
    cursor = 0
    for _ in range(4):
        rows, cursor = table.round_robin(cursor, 2)
        batches.append((sorted(r.id for r in rows.collect()), cursor))
    assert batches == [([0, 1], 2), ([2, 3], 4), ([4], 0), ([0, 1], 2)]
    rows, cursor = table.round_robin(9, 2)  # an empty slice begins again
    assert sorted(r.id for r in rows.collect()) == [0, 1] and cursor == 2
