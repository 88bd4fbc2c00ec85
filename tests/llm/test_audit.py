"""What the audit of an embedding shard must notice."""

import numpy as np
import pytest

from lexmill.llm import embeddings


class Lossy(embeddings.Graph):
    """A graph that finds nothing for queries that are no members (`strangers`) or for every twentieth query, below a beam of 128."""

    strangers = False

    def search(self, queries, width):
        ids, cos = super().search(queries, width)
        lost = (queries @ self.unit.T).max(axis=1) < 0.9999 if self.strangers else np.arange(len(queries)) % 20 == 0
        if width < 128:
            ids[lost], cos[lost] = -1, -np.inf
        return ids, cos


def pairs(n, seed, dims=32):
    """Vectors and a near copy of each."""
    x = np.random.default_rng(seed).normal(size=(n, dims))
    return x, x + np.random.default_rng(seed + 1).normal(size=x.shape) * 0.1


@pytest.mark.parametrize("strangers", [True, False])
def test_beam_widens_for_held_out_vectors_and_without_links(monkeypatch, strangers):
    monkeypatch.setattr(Lossy, "strangers", strangers)
    monkeypatch.setattr(embeddings, "Graph", Lossy)
    x, near = pairs(600, 1)
    args = (np.arange(600), np.ones(600, np.int64), x, 0.93)
    shard = embeddings.build_shard(*args, near) if strangers else embeddings.build_shard(*args)
    assert shard.beam in (0, 128, 256)


def test_beam_with_many_links_scans():
    class Short:
        """Holds one place below the threshold, so that nine of 40 links are missing."""

        unit = embeddings._unit(np.r_[np.ones((40, 4)), [[1.0, -1, 1, -1]]])

        def search(self, queries, width):
            ids = np.r_[np.arange(31), 40].astype(np.int32)[None].repeat(len(queries), 0)
            return ids, np.take_along_axis(queries @ self.unit.T, ids, 1)

    vectors = np.r_[np.ones((40, 4)), [[1.0, -1, 1, -1]]]
    shard = embeddings.Shard(np.arange(41), np.ones(41, np.int64), vectors, Short(), 32)
    assert sum(len(r) for r, _ in embeddings.links_of(shard, np.ones((1, 4)), 0.93)) == 40
