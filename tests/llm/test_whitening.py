import math

import numpy as np
import pytest

from gaugeline.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, whitened string, __place int"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, "a", "b", 1) for i, v in rows], SCHEMA).repartition(parts)


def vectors(count, dimension, seed=3):
    chance = np.random.default_rng(seed)
    mixing = chance.normal(size=(dimension, dimension))
    return (chance.normal(size=(count, dimension)) @ mixing).astype("float32").tolist()


def brute(rows):
    """By key: x, deviation; and the spectrum, with Python integers and numpy."""
    xs = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows}
    n = len(xs)
    sums = [sum(column) for column in zip(*xs.values())]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in xs.items()}
    centred = np.array([[a - s / n for a, s in zip(x, sums)] for x in xs.values()])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return dict(zip(xs, centred)), deviation, values[::-1], axes[:, ::-1], n


def check(found, rows, components):
    centred, deviation, values, axes, n = brute(rows)
    assert len(found) == len(rows) * components
    signs = {}
    for r in found:
        k = r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
        expected = centred[r["vec_id"]] @ axes[:, k] / math.sqrt(values[k])
        if abs(expected) > 1e-6:
            sign = signs.setdefault(k, math.copysign(1, expected * r["whitened"]))
            assert r["whitened"] * sign == pytest.approx(expected, rel=1e-6, abs=1e-8)


def test_report_equals_numpy_with_odd_rows_left_out(spark):
    good = list(enumerate(vectors(120, 40)))
    nan, inf = float("nan"), float("inf")
    odd = [(900, None), (901, [nan] * 40), (902, [1.0] * 39 + [inf]), (903, [1.0] * 39 + [None]), (904, []), (905, [1.0]), (906, [-inf] * 40)]
    check(whitening.whitening_report(table(spark, good + odd)).collect(), good, 32)


def test_fewer_dimensions_than_components(spark):
    good = list(enumerate(vectors(50, 5)))
    check(whitening.whitening_report(table(spark, good)).collect(), good, 5)


def test_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 3 * 4)  # four rows of three columns
    monkeypatch.setattr(whitening, "COLUMNS_A_BLOCK", 3)
    monkeypatch.setattr(whitening, "BLOCKS_A_TASK", 5)
    good = list(enumerate(vectors(150, 8)))
    check(whitening.whitening_report(table(spark, good, 7)).collect(), good, 8)


def test_repeated_rows_and_null_keys_count(spark):
    good = list(enumerate(vectors(30, 4)))
    repeated = table(spark, good + [good[0]] * 9 + [(None, good[1][1])])
    found = whitening.whitening_report(repeated, 2).collect()
    assert len(found) == 80 and {r["n"] for r in found} == {40}
    assert len({(r["component"], r["whitened"]) for r in found if r["vec_id"] == 0}) == 2
    assert sum(r["vec_id"] is None for r in found) == 2


def test_components_without_spread_are_null(spark):
    flat = [(i, [*v, 2.0, 3.0]) for i, v in enumerate(vectors(60, 3))]
    found = whitening.whitening_report(table(spark, flat)).collect()
    assert len(found) == 300
    assert all((r["whitened"] is None) == (r["component"] > 3) and r["identity_error"] < 1e-9 for r in found)
    one = whitening.whitening_report(table(spark, flat[:1])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 5


def test_empty_and_unusable_tables(spark):
    assert whitening.whitening_report(table(spark, [(1, [1.0])]).limit(0)).collect() == []
    assert whitening.whitening_report(table(spark, [(1, None), (2, [])])).collect() == []


def test_deviation_beyond_a_long_is_null(spark):
    huge = [(i, [3e38 * (-1) ** i, float(i)]) for i in range(10)]
    found = whitening.whitening_report(table(spark, huge), 1).collect()
    assert len(found) == 10 and all(r["deviation"] is None and abs(abs(r["whitened"]) - 1) < 1e-6 for r in found)
