import math

import numpy as np
import pytest

from tidemark.llm.whitening import OFFSET, deviations, leading, whiten


def brute_force(vectors, scale, k):
    x = np.floor(scale * np.array(vectors, float)).astype(np.int64) + OFFSET
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (n * fit - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, dev, ((n * x - s) / n) @ u / np.sqrt(e), e / np.trace(c.T @ c / n)


def test_whiten_against_brute_force(spark):
    rng = np.random.default_rng(2)
    made = rng.standard_normal((700, 40)) * np.linspace(3, 0.5, 40)
    vectors = [*made.tolist(), *made[:50].tolist()] + [made[0].tolist()] * 200  # copies weigh once
    odd = [(9001, None), (9002, [None] * 40), (9003, [float("nan")] * 40), (9004, [float("inf")] + [0.0] * 39), (9005, []), (9006, [1.0] * 3)]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in [*enumerate(vectors), *odd]], "vec_id long, embedding array<double>, whitened double").repartition(5)
    got = whiten(df, 16).collect()
    n, dev, white, explained = brute_force(vectors, 64, 16)
    assert len(got) == 16 * len(vectors)
    by_place = {(r["vec_id"], r["component"] - 1): r["whitened"] for r in got}
    signs = []
    for c in range(16):
        far = int(np.abs(white[:, c]).argmax())
        signs.append(math.copysign(1, by_place[far, c] * white[far, c]))
    for r in got:
        i, c = r["vec_id"], r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, dev[i])
        assert math.isclose(r["whitened"], signs[c] * white[i, c], rel_tol=1e-8, abs_tol=1e-8)
        assert math.isclose(r["explained"], explained[c], rel_tol=1e-10) and r["identity_error"] < 1e-10


@pytest.mark.parametrize("values", [[1.0] * 30, list(np.linspace(1, 1.001, 80)), [5.0, 3.0, *[0.0] * 20], [1e6, *np.linspace(2, 1, 60)], [0.0] * 20, [4.0, 2.0]])
def test_leading_is_certified_on_hard_spectra(values):
    rng = np.random.default_rng(4)
    turn = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    v = (turn * np.array(values)) @ turn.T
    k = min(16, len(values))
    found, axes = leading(lambda q: v @ q, len(values), k)
    top = max(values) or 1.0
    assert np.allclose(found, sorted(values, reverse=True)[:k], rtol=0, atol=1e-12 * top)
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-12
    assert np.linalg.norm(v @ axes - axes * found, axis=0).max() < 1e-12 * top


def test_no_rank_and_nothing(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whiten(make([])).count() == 0
    assert whiten(make([(1, None)])).count() == 0
    assert whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    got = whiten(make([(1, [0.0, 0.0]), (None, [1.0, 0.0]), (None, [1.0, 0.0])])).collect()  # on one line: one component
    assert sorted((r["vec_id"] or 0, r["component"], r["n"], r["deviation"], abs(round(r["whitened"], 9))) for r in got) == [(0, 1, 2, 4096, 1.0), (0, 1, 2, 4096, 1.0), (1, 1, 2, 4096, 1.0)]


def test_deviations_are_exact_or_an_error():
    x = np.array([[10**6 + 5, 10**6], [10**6, 10**6 - 3]])
    assert deviations(x, 2, x.sum(0)) == [25 + 9, 25 + 9]
    big = np.array([[OFFSET + 5 * 10**8], [OFFSET]])
    assert deviations(big, 3, np.array([3 * OFFSET])) == [(3 * 5 * 10**8) ** 2, 0]
    with pytest.raises(OverflowError):
        deviations(np.array([[OFFSET + 10**12]]), 10, np.array([10 * OFFSET]))
