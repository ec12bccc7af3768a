"""Embedding operators against brute force."""
import numpy as np
import pytest

from matchday.llm import ann, e8

SCHEMA = "vec_id long, embedding array<float>, label int"
BAD = [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [None] + [1.0] * 15),
       (9005, [float("inf")] + [1.0] * 15), (9006, [1.0] * 3), (None, [1.0] * 16), (9020, None), (9007, [])]


def vectors(n=400, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for i in range(0, 60, 3):  # near copies, exact copies and a scaled one
        x[i + 1] = x[i] + rng.normal(size=d) * 0.02
        x[i + 2] = x[i] if i % 2 else x[i] * 3
    return x.astype(np.float32)


def table(spark, x, bad=True):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + ([(*b, 1) for b in BAD] if bad else [])
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(1)
    y = rng.normal(size=(200, 8)) * 3
    p = e8.decode(y)
    whole = np.abs(p - np.rint(p)).max(axis=1)
    assert (((whole < 1e-9) | (np.abs(whole - 0.5) < 1e-9)).all())
    assert (np.abs(p.sum(axis=1) % 2) < 1e-9).all()
    d = ((y - p) ** 2).sum(axis=1)
    others = ((y[:, None] - p[:, None] - e8.neighbours()[None]) ** 2).sum(axis=2)
    assert (d <= others.min(axis=1) + 1e-9).all() and len(e8.neighbours()) == 240


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(e8, "BLOCK", 8)
    x = vectors()
    got = {r.vec_id: r for r in e8.near_vectors(table(spark, x)).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    comp = np.arange(len(x))
    for _ in range(20):
        for i, j in np.argwhere(near):
            comp[i] = comp[j] = min(comp[i], comp[j])
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), comp[i], comp[i] == i)
    for k, _ in BAD:
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert len(got) == len(x) + len(BAD)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert e8.near_vectors(empty).count() == 0
    assert ann.nearest(empty, lambda c: c % 20 == 0).count() == 0
    assert ann.nearest(spark.createDataFrame([(*b, 1) for b in BAD], SCHEMA), lambda c: c % 20 == 0).count() == 0


def brute(x, k):
    u = x.astype(np.float64)
    out = {}
    for q in range(0, len(x), 20):
        s = u @ u[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:k]
        out[q] = [(i, s[i]) for i in order]
    return out


@pytest.mark.parametrize("n", [5, 400])
def test_few_vectors_search_exactly(spark, n):
    x = vectors(max(n, 60))[:n]
    got: dict = {}
    for r in ann.nearest(table(spark, x), lambda c: c % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    want = brute(x, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-9 for q in got for a, b in zip(got[q], want[q], strict=True))


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "PER_CELL", 64)
    monkeypatch.setattr(ann, "AT_LEAST", 5)
    x = vectors(4000, 16, 3)
    got: dict = {}
    for r in ann.nearest(table(spark, x), lambda c: c % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(x, 20)
    assert np.mean([len(got[q] & {i for i, _ in v}) / len(v) for q, v in want.items()]) >= 0.9


def test_heap_visits_like_enumeration(monkeypatch):
    rng = np.random.default_rng(0)
    f = (rng.normal(size=(9, 3)), rng.uniform(-0.5, 0.5, size=3))
    q = rng.normal(size=9)
    a, share = ann.visits(q, f, 0.6, 0.8)
    monkeypatch.setattr(ann, "ENUMERATE", 0)
    b, same = ann.visits(q, f, 0.6, 0.8)
    assert [tuple(x) for x in b] == [tuple(x) for x in a] and abs(share - same) < 1e-9


def test_best_of_nothing():
    none = np.zeros(0, np.int64)
    assert len(ann.best_of(20, none, none, np.zeros(0))) == 0
    assert ann.best_of(1, np.array([7, 7]), np.array([2, 1]), np.array([0.5, 0.5])).tolist() == [1]


@pytest.mark.parametrize("noise", [0.0, 0.02])
def test_recall_beside_a_large_group(spark, monkeypatch, noise):
    monkeypatch.setattr(ann, "PER_CELL", 64)
    monkeypatch.setattr(ann, "AT_LEAST", 5)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 64))
    group = rng.random(6000) < 1 / 3
    x[group] = rng.normal(size=64) + noise * rng.normal(size=(int(group.sum()), 64))
    x = x.astype(np.float32)
    u = x.astype(np.float64)
    x = (u / np.linalg.norm(u, axis=1, keepdims=True)).astype(np.float32)
    got: dict = {}
    for r in ann.nearest(table(spark, x, bad=False), lambda c: c % 20 == 0).collect():
        got.setdefault(r.query_id, []).append(r.score)
    want = brute(x, 20)
    recall = {q: np.mean(np.array(sorted(got[q], reverse=True)) >= v[-1][1] - 1e-9) for q, v in want.items()}
    assert np.mean(list(recall.values())) >= 0.9
    assert np.mean([r for q, r in recall.items() if not group[q]]) >= 0.9


def test_second_look_reaches_the_target():
    rng = np.random.default_rng(1)
    maps = ann.functions_of(9, 5)
    q = np.append(rng.normal(size=8), 0.0)
    q /= np.linalg.norm(q)
    for cosine in (0.2, 0.6, 0.9):
        seen, more = ann.first_look(q, maps, 1_000_000, 20), ann.second_look(q, maps, cosine, 1_000_000, 20)
        missed = 1.0
        for f, a, b in zip(maps, seen, more, strict=True):
            assert not {tuple(c) for c in a} & {tuple(c) for c in b}
            near, _ = ann.intervals(q, f, cosine)
            missed *= 1 - min(1.0, sum(near[range(5), np.array(c) + ann.HALF].prod() for c in [*a, *b]))
        assert 1 - missed >= ann.TARGET - 1e-9
    # all cells where there are few rows
    assert [len(c) for c in ann.first_look(q, maps, 300, 20)] == [(2 * ann.HALF) ** 5] * ann.TABLES


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("near", [None, 0.92])
def test_recall_and_pairs_at_shipped_settings(near):
    """The operator's own plan of cells, its scoring replaced by one matrix product."""
    rng = np.random.default_rng(4)
    n, k = 20_000, 20
    x = unit(rng.normal(size=(n, 64)))
    if near:  # groups of 50 about a centre
        x = unit(np.repeat(x[:n // 50], 50, axis=0) + np.sqrt(1 / near - 1) * unit(rng.normal(size=(n, 64))))
    stored = np.column_stack([x, np.zeros(n)])
    m = max(1, round(float(np.log2(n / ann.PER_CELL)) / 1.8))
    maps = ann.functions_of(65, m)
    keys = [ann.cell_key(ann.place(stored, f), t) for t, f in enumerate(maps)]
    recall, pairs = [], []
    for i in range(0, n, 500):
        s = x @ x[i]
        s[i] = -1
        q, seen, scored = stored[i], np.zeros(n, bool), 0

        def look(cells, seen=seen):
            hits = [np.isin(keys[t], ann.cell_key(c.astype(np.int64), t)) for t, c in enumerate(cells) if len(c)]
            for h in hits:
                seen |= h
            return sum(int(h.sum()) for h in hits)

        scored += look(ann.first_look(q, maps, n, k))
        scored += look(ann.second_look(q, maps, float(np.sort(s[seen])[-k]), n, k))
        recall.append(np.mean(np.sort(s[seen])[-k:] >= np.sort(s)[-k]))
        pairs.append(scored / n)
    assert np.mean(recall) >= 0.9 and max(pairs) < 1.3
    assert np.mean(pairs) < (0.5 if near else 1.05)


def test_a_look_is_one_row_for_a_query_and_table(spark, monkeypatch):
    """Vectors aren't copied once for each cell visited."""
    monkeypatch.setattr(ann, "PER_CELL", 64)
    monkeypatch.setattr(ann, "AT_LEAST", 5)
    written, stage = [], ann.staged

    def staged(df, name, *how, **more):
        out = stage(df, name, *how, **more)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(ann, "staged", staged)
    x = vectors(4000, 16, 3)
    ann.nearest(table(spark, x, bad=False), lambda c: c % 20 == 0).count()
    asked = written[[name for name, _ in written].index("blocks") + 1:]
    assert len(asked) > 3 and max(rows for _, rows in asked) <= 200 * 20


def test_plans_visit_the_likeliest_cells():
    rng = np.random.default_rng(6)
    maps = ann.functions_of(17, 5)
    q = np.column_stack([unit(rng.normal(size=(30, 16))), np.zeros(30)])
    cosine = rng.uniform(0.1, 0.9, 30)
    first, none = ann.plans(q, maps, 1_000_000, 20)
    least, seen = ann.plans(q, maps, 1_000_000, 20, cosine)
    assert np.isinf(none).all() and np.allclose(first, seen, rtol=1e-9)
    for i in range(30):
        more = ann.second_look(q[i], maps, cosine[i], 1_000_000, 20)
        for t, f in enumerate(maps):
            before = {tuple(c) for c in ann.visits(q[i], f, ann.NEAR, ann.SHARED, ann.AT_LEAST * 20 / 1_000_000 / ann.TABLES)[0].tolist()}
            assert {tuple(c) for c in ann.first_look(q[i], maps, 1_000_000, 20)[t].tolist()} == before
            got = {tuple(c) for c in more[t].tolist()}
            assert not got & before
            if np.isinf(least[i, t]):
                assert not got
                continue
            wants = [{tuple(c) for c in ann.visits(q[i], f, cosine[i], target)[0].tolist()} - before for target in (ann.SHARED, ann.TARGET)]
            assert got in wants
            here = ann.logs(ann.intervals(q[i][None], f, cosine[i:i + 1])[0])
            regions = ann.regions_met(here, least[i:i + 1, t], 2)
            assert {int(ann.numbers(np.array(c))) // 4 ** 3 for c in got} <= set(regions.tolist())


def test_ids_with_several_vectors_against_brute_force(spark):
    x = vectors(400)
    ids = np.where(np.arange(400) < 300, np.arange(400), np.arange(400) - 300)  # 100 ids have two vectors
    rows = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)], SCHEMA)
    got: dict = {}
    for r in ann.nearest(rows, lambda c: c % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    u = x.astype(np.float64)
    for q in range(0, 300, 20):
        best: dict = {}
        for v in u[ids == q]:
            for i, s in zip(ids.tolist(), u @ v, strict=True):
                best[i] = max(best.get(i, -np.inf), s) if i != q else -np.inf
        del best[q]
        assert got[q] == sorted(best, key=lambda i: (-best[i], i))[:20]


def test_single_precision_only_filters():
    """Scores nearer to each other than single precision tells apart, of very long vectors, many of them equal."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=16) * 1e30
    x = np.repeat(base[None], 3000, axis=0) * (1 + rng.integers(0, 40, 3000)[:, None] * 1e-13)
    ids, f = rng.permutation(3000), ann.functions_of(17, 1)[0]
    longest = float(np.linalg.norm(x, axis=1).max())
    asked = ann.Asked(ids[:200], x[:200], np.tile([ann.NEAR, -np.inf, 0.0, np.inf], (200, 1)), f, longest, 20, False)
    for part in np.array_split(np.arange(3000), 4):
        asked.meet(ids[part], x[part], (x[part] / longest).astype(np.float32), np.zeros(len(part), np.int64))
        assert sum(len(h[0]) for h in asked.held) < 500_000
    query, found, score = asked.best()
    for i in (0, 7, 199):
        exact = np.einsum("ij,j->i", x, x[i])
        order = [j for j in np.lexsort((ids, -exact)) if ids[j] != ids[i]][:20]
        assert found[query == ids[i]].tolist() == ids[order].tolist()


def test_plans_off_the_heap(monkeypatch):
    rng = np.random.default_rng(3)
    maps = ann.functions_of(17, 4)
    q, cosine = np.column_stack([unit(rng.normal(size=(12, 16))), np.zeros(12)]), rng.uniform(0.1, 0.9, 12)
    want = [*ann.plans(q, maps, 100_000, 20), *ann.plans(q, maps, 100_000, 20, cosine)]
    monkeypatch.setattr(ann, "ENUMERATE", 0)
    got = [*ann.plans(q, maps, 100_000, 20), *ann.plans(q, maps, 100_000, 20, cosine)]
    for a, b in zip(got, want, strict=True):
        assert np.allclose(a, b, rtol=1e-9)
