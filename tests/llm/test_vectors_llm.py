import numpy as np

from footfall.llm.vectors import beam_search, build, linked, unit_rows, vector_duplicates


def brute(rows, least=0.98):
    usable = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = (label, unit_rows(np.array([v], dtype=float))[0])
    links = {i: set() for i, _, _ in rows}
    for i, (label, u) in usable.items():
        for j, (other, w) in usable.items():
            if i != j and label == other and len(u) == len(w) and float(u @ w) >= least:
                links[i].add(j)
    out = {}
    for i in links:
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        out[i] = (len(links[i]), min(reach), min(reach) == i)
    return out


def corpus():
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(25, 16))
    rows = []
    for i in range(700):
        near = centers[i % 25] + draw.normal(size=16) * draw.choice([0.02, 0.1, 0.3, 2])
        rows.append((float(draw.choice([1, 1, 0.5])) * near).astype(np.float32))
    rows += [rows[0]] * 40 + [rows[1] * 2] * 3
    rows = [(i, [float(x) for x in v], int(i % 3)) for i, v in enumerate(rows)]
    n = len(rows)
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15,
           [1.0] * 3, [1.0] * 3]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)]
    return rows + [(n + 20, rows[0][1], None), (n + 21, [1e30] * 16, 1), (n + 22, [1e-30] * 16, 1)]


def test_equals_all_pairs_in_one_shard_and_in_many(spark):
    rows = corpus()
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    want = brute(rows)
    for shard in (8192, 60):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept)
               for r in vector_duplicates(data, shard=shard).collect()}
        assert got == want


def test_graph_finds_neighbours_and_dense_groups():
    draw = np.random.default_rng(1)
    vectors = unit_rows(np.concatenate((
        draw.normal(size=(2500, 24)),
        draw.normal(size=(1, 24)) + 0.01 * draw.normal(size=(500, 24)))))
    graph = build(vectors)
    assert len(graph.near) > 1
    queries = vectors[:300]
    ids, _ = beam_search(graph, queries, 64)
    nearest = np.argsort(-(queries @ vectors.T), axis=1)[:, :10]
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids.tolist(), nearest.tolist(), strict=True)])
    assert recall > 0.9
    assert (linked(graph, vectors, 0.98) == (vectors @ vectors.T >= 0.98)).mean() > 0.99999


def test_null_keys_repeated_rows_clashing_names_and_empty_table(spark):
    data = spark.createDataFrame([(4, [1.0, 0.0], "a", 1), (4, [1.0, 0.0], "a", 2), (None, [1.0, 0.0], "a", 3),
                                  (9, [2.0, 0.1], "a", 4)],
                                 "vec_id int, embedding array<double>, label string, _key int")
    out = vector_duplicates(data)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(
        [(4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False), (None, 0, None, True)], key=repr)
    assert vector_duplicates(data.limit(0)).count() == 0
