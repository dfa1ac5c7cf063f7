"""Near vectors where a third of them crowd in one cone, ties at the threshold and odd tables."""

import numpy as np
import pandas as pd
import pytest

from panelforge.llm import embed_dedup

DIM, N = 64, 51_000


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def crowded(cone: float, seed: int) -> np.ndarray:
    """N vectors, a third of them at mutual cosine ``cone``; 900 have a partner at cosine 0.951 to 0.96, two thirds of these in the cone."""
    rng = np.random.default_rng(seed)
    axis = unit(rng.standard_normal(DIM))
    inside = unit(np.sqrt(cone) * axis + np.sqrt(1 - cone) * unit(rng.standard_normal((N // 3, DIM))))
    outside = unit(rng.standard_normal((N - N // 3 - 900, DIM)))
    chosen = np.vstack([inside[:600], outside[:300]])
    away = rng.standard_normal(chosen.shape)
    away = unit(away - (away * chosen).sum(axis=1, keepdims=True) * chosen)
    aim = rng.uniform(0.951, 0.96, (len(chosen), 1))
    return np.vstack([inside, outside, aim * chosen + np.sqrt(1 - aim**2) * away])


def pairs_at(x: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    out = []
    for lo in range(0, len(x), 2000):
        i, j = np.nonzero(x[lo : lo + 2000] @ x.T >= threshold)
        out += [(int(a) + lo, int(b)) for a, b in zip(i, j) if a + lo < b]
    return out


@pytest.mark.parametrize("cone", [0.8, 0.88])
def test_recall_in_a_dense_cone(spark, cone):
    x = crowded(cone, 7)
    pairs = pairs_at(x, 0.95)
    assert len(pairs) >= 900
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x)})).repartition(8)
    got = {r["vec_id"]: r["component_id"] for r in embed_dedup.near_vectors(df, 0.95).select("vec_id", "component_id").collect()}
    found = sum(got[a] == got[b] for a, b in pairs)
    assert found >= 0.99 * len(pairs), found / len(pairs)


def test_ties_null_ids_and_clashing_names(spark):
    schema = "vec_id long, embedding array<double>, node long, root long, dim int, key long, n_links long, block int, links long"
    rest = (1, 2, 3, 4, 5, 6, 7)
    # 19² + 5² + 3² + 2² + 1² = 20²: the cosine is 0.95 to the last bit.
    vectors = [(1, (20, 0, 0, 0, 0)), (2, (19, 5, 3, 2, 1)), (None, (0, 1, 0, 0, 0)), (None, (0, 2, 0, 0, 0)), (9, (0, 0, 0, 7, 0))]
    rows = [(k, [float(c) for c in v], *rest) for k, v in vectors] + [(9, None, *rest)]
    got = sorted(map(tuple, embed_dedup.near_vectors(spark.createDataFrame(rows, schema)).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)
    assert got == sorted([(1, 1, 1, True), (2, 1, 1, False), (None, 1, None, True), (None, 1, None, True), (9, 0, 9, True), (9, 0, 9, True)], key=repr)
    # Just under the threshold there is no link.
    apart = spark.createDataFrame([(1, [20.0, 0.0, 0.0, 0.0, 0.0]), (2, [18.999999, 5.0, 3.0, 2.0, 1.0])], "vec_id long, embedding array<double>")
    assert {r["n_links"] for r in embed_dedup.near_vectors(apart).collect()} == {0}


def test_probes_lie_at_the_threshold(spark):
    x = np.random.default_rng(3).standard_normal((500, 8)) * 10.0 ** np.random.default_rng(4).integers(-150, 150, (500, 1))
    df = spark.createDataFrame(pd.DataFrame({"node": np.arange(500), "dim": np.full(500, 8, np.int32), "embedding": list(x)}))
    rows = embed_dedup.probes(df, 0.95, 100).collect()
    assert 50 <= len(rows) <= 200
    for r in rows:
        v, w = x[-1 - r["node"]] / np.abs(x[-1 - r["node"]]).max(), np.array(r["embedding"])
        assert abs(v @ w / np.linalg.norm(v) / np.linalg.norm(w) - 0.95) < 1e-8
