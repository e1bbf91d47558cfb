import numpy as np
from cases import classes

from contrail.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, node string, n string, cell string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "node", "n", "cell") for i, v in rows], SCHEMA)


def brute(vectors, cosine=0.95):
    x = np.array(vectors, np.float32).astype(np.float64)
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    near = x @ x.T >= cosine
    return near & ~np.eye(len(x), dtype=bool)


def clustered(seed, n=600, dimensions=32):
    generator = np.random.default_rng(seed)
    centres = generator.normal(size=(n // 6, dimensions))
    picked = centres[generator.integers(0, len(centres), n)]
    return (picked + generator.normal(size=picked.shape) * 0.2).astype(np.float32)


def test_links_match_brute_force(spark):
    vectors = clustered(1).tolist()
    vectors += [vectors[0]] * 4 + [[2 * x for x in vectors[1]]]
    near = brute(vectors)
    rows = list(enumerate(vectors))
    odd = [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [float("inf")] * 32, [1.0] * 7]
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    found = embeddings.near_vectors(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    got = {r["vec_id"]: r for r in found if r["vec_id"] is not None and r["vec_id"] < 1000}
    want = near.sum(axis=1)
    links = np.array([got[i]["n_links"] for i in range(len(vectors))])
    assert (links <= want).all() and links.sum() >= 0.98 * want.sum() and want.sum() > 1000
    component = classes(range(len(vectors)), [(int(a), int(b)) for a, b in np.argwhere(near) if a < b])
    assert np.mean([got[i]["component_id"] == component[i] for i in component]) > 0.98
    rest = [r for r in found if r["vec_id"] is None or r["vec_id"] >= 1000]
    assert all(r["n_links"] == 0 and r["component_id"] == r["vec_id"] and r["kept"] for r in rest)


def test_crowded_cells_change_nothing(spark, monkeypatch):
    vectors = clustered(2, 300).tolist()
    rows = frame(spark, list(enumerate(vectors)))
    whole = sorted(map(tuple, embeddings.near_vectors(rows).collect()))
    monkeypatch.setattr(embeddings, "MEMBERS", 3)
    monkeypatch.setattr(embeddings, "VISITORS", 5)
    assert sorted(map(tuple, embeddings.near_vectors(rows).collect())) == whole


def test_cells_come_in_multi_sequence_order():
    vectors = embeddings.normed(clustered(3, 400))
    index = embeddings.fit(vectors, 400)
    index.visits = 7
    own, visited = embeddings.cells(index, vectors)
    k, middle = len(index.codes[0]), vectors.shape[1] // 2
    far = [((v[:, None] - c) ** 2).sum(axis=2) for v, c in zip((vectors[:, :middle], vectors[:, middle:]), index.codes)]
    every = (far[0][:, :, None] + far[1][:, None, :]).reshape(len(vectors), -1)
    nearest = np.sort(every, axis=1)[:, :7]
    assert np.allclose(np.take_along_axis(every, visited, axis=1), nearest)
    assert (own == visited[:, 0]).all() and every.shape[1] == k * k


def test_null_ids_and_vectors_of_several_lengths_link(spark):
    many = clustered(4, 120).tolist()
    rows = list(enumerate(many))
    rows += [(200, [1.0, 2.0]), (201, [2.0, 4.01]), (202, [-1.0, 2.0]), (203, [3.0]), (204, [5.0]), (205, [-1.0])]
    rows += [(None, [1.0, 2.0]), (None, [7.0, 1.0, 1.0]), (None, [7.0, 1.0, 1.0]), (None, None), (None, many[5])]
    found = embeddings.near_vectors(frame(spark, rows)).collect()
    got = {r["vec_id"]: tuple(r)[1:] for r in found if r["vec_id"] is not None}
    assert [got[i] for i in range(200, 206)] == [
        (2, 200, True), (2, 200, False), (0, 202, True), (1, 203, True), (1, 203, False), (0, 205, True),
    ]
    nameless = sorted((tuple(r)[1:] for r in found if r["vec_id"] is None), key=repr)
    five = got[5]
    assert nameless == sorted([(2, 200, False), (1, None, True), (1, None, True), (0, None, True), (five[0], five[1], False)], key=repr)
    assert five[0] == brute(many)[5].sum() + 1


def test_empty_table(spark):
    assert embeddings.near_vectors(frame(spark, [])).count() == 0
    alone = embeddings.near_vectors(frame(spark, [(4, [1.0, 2.0]), (3, [2.0, 4.0])])).collect()
    assert sorted(map(tuple, alone)) == [(3, 1, 3, True), (4, 1, 3, False)]
