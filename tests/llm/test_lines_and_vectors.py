"""Line dedup, exact k-means and vector codes against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from oracle import connect, same

from waymill.llm import balls, centroids, codes, lines, registry

# lines


def line_key(line: str) -> str:
    return line.encode().strip(lines.SPACE).lower().decode()


def plain_lines(rows: list[tuple], least: int = 20, enough: int = 3) -> list[tuple]:
    holders, rank = defaultdict(set), lambda d: (d is not None, d or 0)
    for d, text in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= least:
                holders[line_key(line)].add(rank(d))
    out = []
    for d, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if len(h := holders.get(line_key(x), ())) < enough or max(h) == rank(d)]
        out.append((d, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def order(row: tuple) -> tuple:
    return (row[0] is None, row[0] or 0, *row[1:])


def some_lines() -> list[tuple]:
    rng = random.Random(1)
    pool = [f"line {k} " + "x" * 20 for k in range(8)] + ["é" * 20, "É" * 20, "é" * 19, "  Padded line of TWENTY chars\v\r", "padded line of twenty chars", "short", "", "\x85" + "y" * 20]
    rows = [(rng.choice([None, *range(60)]), None if rng.random() < 0.05 else "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for _ in range(300)]
    rows += [(5, "a hot line of more than twenty characters")] * 500  # repeated rows
    return [*rows, (70, "\n".join(f"own line {k} of a very long document" for k in range(3000)) + "\nline 1 " + "x" * 20), (71, "")]


@pytest.mark.parametrize("small", [False, True])
def test_lines_equal_brute_force(spark, monkeypatch, small):
    rows = some_lines()
    if small:  # runs go over batches and tasks
        monkeypatch.setattr(lines, "RANGE_ROWS", 100)
        monkeypatch.setattr(lines, "BATCH_ROWS", 50)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
        assert sorted(map(tuple, lines.line_report(df).collect()), key=order) == sorted(plain_lines(rows), key=order)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_line_of_all_documents_is_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(lines, "RANGE_ROWS", 500)
    hot = "one line that every document has"
    rows = [(k, f"{hot}\nanother line, of document {k} alone") for k in range(4000)]
    got = lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_dropped for r in got} == {k: int(k != 3999) for k in range(4000)}
    ends = [r for k in range(6) for r in [type("End", (), {"run": 2 * k, "docs": 3, "h1": 1, "h2": 1, "top": 90 - 10 * k, "last": 81 - 10 * k})]]
    assert lines.decided(ends, 3) == [(2 * k, 90) for k in range(6)]


def test_two_tasks_that_share_a_document_count_it_once(spark):
    end = lambda run, docs, top, last: type("End", (), {"run": run, "docs": docs, "h1": 1, "h2": 1, "top": top, "last": last})
    assert lines.decided([end(1, 2, 9, 8), end(2, 1, 8, 8)], 3) == []
    assert lines.decided([end(1, 2, 9, 8), end(2, 2, 8, 7)], 3) == [(1, 9), (2, 9)]


def test_line_operator_keeps_columns_and_other_ids(spark):
    text = "a line of twenty and more letters\nother"
    rows = [(k, text if k != "d" else None, "clash", 1) for k in "abcd"]
    df = spark.createDataFrame(rows, "name string, body string, mark string, keep int")
    got = {r.name: r for r in lines.without_repeated_lines(df, "name", "body").collect()}
    assert [got[k].body for k in "abcd"] == ["other", "other", text, None]
    assert got["a"].mark == "clash" and got["a"].keep == 1 and [got[k].n_dropped for k in "abcd"] == [1, 1, 0, 0]
    assert lines.without_repeated_lines(df.limit(0), "name", "body").collect() == []
    maps = {r.doc: lines.zlib.decompress(r["keep"]) for r in lines.keep_bitmaps(df, "name", "body").collect()}
    assert maps == {"a": b"\xfe", "b": b"\xfe"}


# vectors


def plain_clusters(rows: list[tuple], count: int, rounds: int, width: int) -> list[tuple]:
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "")
    c = [list(v) for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:count]]
    for t in range(rounds + 1):
        own = [min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(c)) for _, v in kept]
        if t < rounds:
            for k in range(len(c)):
                if members := [v for (_, v), (_, j) in zip(kept, own) if j == k]:
                    c[k] = [sum(x) // len(members) for x in zip(*members)]
    inertia = defaultdict(int)
    for d, k in own:
        inertia[k] += d
    return [(i, k, d, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()) for (i, _), (d, k) in zip(kept, own)]


def odd_vectors(n: int, width: int, seed: int = 3) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = [(int(k), [float(np.float32(x)) for x in rng.integers(-6, 7, width) / 4]) for k in range(n)]
    rows += [(k, rows[0][1]) for k in range(n, n + 40)] + [rows[1]] * 30 + [(None, rows[2][1]), (None, None)]
    return rows + [(900, None), (901, []), (902, [1.0] * (width - 1)), (903, [float("nan")] * width), (904, [None] * width), (905, [float("-inf")] * width), (906, [-0.0] * width)]


def test_clusters_equal_brute_force(spark):
    rows = odd_vectors(150, 8)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, id string, cluster int").repartition(5)
    got = centroids.cluster_report(df, count=6, rounds=4, width=8).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted(map(tuple, got.collect()), key=order) == sorted(plain_clusters(rows, 6, 4, 8), key=order)


def test_few_and_no_vectors(spark):
    few = [(None, [1.0, 2.0]), (3, [1.0, 2.0])]
    df = spark.createDataFrame(few, "vec_id long, embedding array<float>")
    assert sorted((r.vec_id is None, r.cluster, r.distance) for r in centroids.cluster_report(df, width=2).collect()) == [(False, 0, 0), (True, 0, 0)]
    assert centroids.cluster_report(df.limit(0)).count() == 0
    labelled = df.selectExpr("*", "1 AS label")
    assert {(r.code, r.error) for r in codes.code_report(labelled, parts=2, width=2).collect()} == {("0000", 0)}
    assert codes.code_report(labelled.limit(0)).count() == 0
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster_report(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), width=2).collect()


def test_bounds_measure_few_pairs_and_stay_exact():
    rng = np.random.default_rng(5)
    hubs = rng.integers(-400, 400, (16, 64))
    vectors = hubs[rng.integers(0, 16, 3000)] + rng.integers(-9, 10, (3000, 64))
    history, state, measured = vectors[:16][None].astype(np.int64), None, []
    for _ in range(6):
        state, n = centroids.assign(vectors, history, state)
        full = ((vectors[:, None, :] - history[-1][None]) ** 2).sum(axis=2)
        assert (state.cluster == full.argmin(axis=1)).all() and (state.distance == full.min(axis=1)).all()
        measured.append(n)
        moved = np.array([vectors[state.cluster == k].sum(axis=0) // max(1, (state.cluster == k).sum()) if (state.cluster == k).any() else history[-1][k] for k in range(16)])
        history = np.concatenate([history, moved[None]])
    assert measured[0] == 3000 * 16 and measured[-1] < 3000 * 3


def test_bounds_are_loosened_by_total_displacement():
    """A centroid that goes away and comes back to where a bound was measured leaves that bound as it was."""
    vectors = np.array([[0, 0], [100, 0]])
    path = [[[0, 0], [100, 0]], [[0, 40], [100, 40]], [[0, 0], [100, 0]]]
    state, _ = centroids.assign(vectors, np.array(path[:1]))
    _, measured = centroids.assign(vectors, np.array(path), state)
    assert measured == 2


def plain_codes(rows: list[tuple], parts: int, entries: int, rounds: int, width: int) -> list[tuple]:
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], b) for i, v, b in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    fit = [r for r in kept if len(r[1]) == width]
    own, first = width // parts, sorted(fit, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v: [v[p * own : (p + 1) * own] for p in range(parts)]
    books = [[cut(r[1])[p] for r in first] for p in range(parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for t in range(rounds + 1):
        found = [[nearest(x, books[p]) for p, x in enumerate(cut(r[1]))] for r in fit]
        for p in range(parts) if t < rounds else ():
            for k in range(len(books[p])):
                if members := [cut(r[1])[p] for r, f in zip(fit, found) if f[p][1] == k]:
                    books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out = [(r[0], "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), r[2]) for r, f in zip(fit, found)] + [(r[0], None, None, r[2]) for r in kept if len(r[1]) != width]
    total = defaultdict(int)
    for _, _, e, b in out:
        total[b] += e or 0
    return [(i, c, e, total[b], digest) for i, c, e, b in out]


@pytest.mark.parametrize("block", [codes.BLOCK, 37])
def test_codes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    rows = [(i, v, None if k % 7 == 0 else "hot" if k % 3 else str(k % 5)) for k, (i, v) in enumerate(odd_vectors(150, 8)) if v != []]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label string, error int").repartition(3)
    got = codes.code_report(df, parts=4, entries=10, rounds=3, width=8).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2] or 0, r[3] or 0)
    want = plain_codes(rows, 4, 10, 3, 8)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("seed", range(6))
def test_forest_is_exact_and_balls_are_owned(seed):
    rng = np.random.default_rng(seed)
    hubs = rng.integers(-300, 300, (12, 3))
    points = np.concatenate([hubs[rng.integers(0, 12, 700)] + rng.integers(-4, 5, (700, 3)), np.zeros((100, 3), dtype=np.int64), rng.integers(-300, 300, (200, 3))])
    points = np.concatenate([points, points[rng.permutation(1000)] + 1])
    entries = np.stack([points[:24], points[1000:1024]])
    entries[0, 5] = entries[0, 2]  # a tie
    trees = balls.forest(points, 2)
    sizes = trees.nodes[:, 1] - trees.nodes[:, 0]
    assert sorted(trees.order[:1000]) == list(range(1000)) and (sizes[trees.roots] == 1000).all()
    for k in range(len(sizes)):
        own = points[trees.order[trees.nodes[k, 0] : trees.nodes[k, 1]]]
        assert (own.sum(axis=0) == trees.sums[k]).all()
        assert (np.sqrt(((own - own.mean(axis=0)) ** 2).sum(axis=1)) <= trees.radius[k] + 1e-6).all()
    found = balls.nearest_entries(points, trees, entries)
    for t in range(2):
        own = points[t * 1000 : (t + 1) * 1000]
        plain = ((own[:, None, :] - entries[t][None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (found.entry[t * 1000 : (t + 1) * 1000] == plain).all()
        assert (found.count[t] == np.bincount(plain, minlength=24)).all()
        assert all((found.sums[t, k] == own[plain == k].sum(axis=0)).all() for k in range(24))
    assert found.looked_at < 1700


@pytest.mark.parametrize("name", ["op11_centroid_clusters", "op12_line_dedup", "op13_vector_codes"])
def test_query_equals_its_sql(spark, sf_dir, name):
    same(registry.queries()[name](spark, sf_dir), connect(sf_dir), registry.oracle_sql()[name])
