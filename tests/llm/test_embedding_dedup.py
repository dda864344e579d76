import numpy as np
import pyarrow as pa

from oreflow.llm.embedding_dedup import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    good = [
        i for i, (v, e, label) in enumerate(rows)
        if v is not None and label is not None and e and None not in e and np.isfinite(e).all() and np.any(e)
    ]
    parent, links = list(range(len(rows))), [0] * len(rows)
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in good:
        for j in good:
            if j < i and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.float32(rows[i][1]).astype(float), np.float32(rows[j][1]).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    low = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            low[root(i)] = min(row[0], low.get(root(i), row[0]))
    return sorted(((r[0], links[i], low.get(root(i)), r[0] is not None and r[0] == low[root(i)]) for i, r in enumerate(rows)), key=str)


def sample_rows():
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for label in range(3):
        for _ in range(60):
            base = rng.standard_normal(16)
            for _ in range(int(rng.choice([1, 1, 2, 5, 40], p=[0.5, 0.2, 0.2, 0.08, 0.02]))):
                e = base + rng.standard_normal(16) * rng.choice([0.01, 0.1, 0.14, 0.2])
                rows.append((int(rng.permutation(10**6)[0]) * 1000 + n, e.astype(np.float32).tolist(), label))
                n += 1
    first = rows[0]
    rows += [(1, first[1], first[2]), (2, first[1], first[2]), (2, first[1], first[2]), (3, first[1], 9), (4, first[1], None), (5, first[1], None)]
    rows += [(6, [0.0] * 16, 0), (7, [0.0] * 16, 0), (8, None, 0), (9, [], 0), (10, [float("nan")] * 16, 0), (11, [float("inf")] + [1.0] * 15, 0)]
    rows += [(12, [None] + [1.0] * 15, 0), (None, first[1], first[2]), (13, first[1][:4], first[2]), (14, first[1][:4], first[2])]
    return rows


def test_matches_brute_force(spark):
    rows = sample_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for tile in (1024, 7):
        got = sorted((tuple(r) for r in near_duplicates(docs, tile=tile).collect()), key=str)
        assert got == brute(rows)


def test_recall_of_the_passes(spark):
    """One pass with a narrow window finds part, the passes together all; nothing false is found."""
    rows = sample_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sum(r[1] for r in brute(rows))
    assert sum(r["n_links"] for r in near_duplicates(docs, passes=1, window=1).collect()) <= want
    assert sum(r["n_links"] for r in near_duplicates(docs, passes=16, window=8).collect()) == want


def test_empty_table_and_other_columns(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, [1.0], 1, 5), (2, [2.0], 1, 6)], SCHEMA + ", node int")
    assert {tuple(r) for r in near_duplicates(odd).collect()} == {(1, 1, 1, True), (2, 1, 1, False)}


def test_recall_in_a_dense_label(spark):
    """20,000 vectors at mutual cosines of 0.95 with 300 pairs at 0.985 among them: every link and component is found."""
    rng = np.random.default_rng(4)
    n, size, planted = 20_000, 64, 300
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    center = unit(rng.standard_normal((1, size)))
    e = unit(center + np.sqrt(1 / 0.95 - 1) * unit(rng.standard_normal((n, size))))
    e[:planted] = unit(e[planted : 2 * planted] + np.sqrt(1 / 0.985**2 - 1) * unit(rng.standard_normal((planted, size))))
    e = e.astype(np.float32)
    exact = unit(e.astype(float))
    pairs = []
    for low in range(0, n, 1000):
        x, y = np.nonzero(exact[low : low + 1000] @ exact.T >= 0.98)
        pairs += [(a, b) for a, b in zip((x + low).tolist(), y.tolist()) if a != b]
    links = np.bincount([a for a, _ in pairs], minlength=n)
    group = np.arange(n)
    while True:
        old = group.copy()
        for a, b in pairs:
            group[a] = min(group[a], group[b])
        if (old == group).all():
            break
    docs = spark.createDataFrame(
        pa.table({"vec_id": np.arange(n), "embedding": pa.array(list(e), pa.list_(pa.float32())), "label": np.ones(n, np.int32)})
    )
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(docs).collect()}
    wrong = [i for i in range(n) if found[i] != (links[i], group[i])]
    assert len(pairs) >= 2 * planted and not wrong, f"{len(wrong)} wrong, {sum(found[i][0] for i in range(n))} of {len(pairs)} links"
