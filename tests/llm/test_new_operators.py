"""URL filters, whitening and clustering against plain versions, and on odd rows."""

import collections
import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from spanloom.llm import centroids, registry, url_filter, whitening


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    registry._importable(spark)


# --- url filters ----------------------------------------------------------------------------------------------------


def plain_address(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    return host, path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]


def plain_verdict(url, rules, default="allow"):
    host, path = plain_address(url)
    fits = [r for r in rules if r[0] and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fits:
        return host, path, None, default
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[1])))
    return host, path, best[0] + best[1], best[2]


def rule_rows(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def test_url_verdicts_brute_force(spark):
    r = random.Random(4)
    labels, parts = ["a", "b", "co", "net", "x-1"], ["", "en", "de", "a", "b.html"]

    def host():
        return ".".join(r.choice(labels) for _ in range(r.randint(1, 5)))

    def path():
        return "".join("/" + r.choice(parts) for _ in range(r.randint(0, 4)))

    urls = [f"{r.choice(['http', 'HTTPS', 'x'])}://{host().upper() if r.random() < 0.2 else host()}{path()}{r.choice(['', '?q=/a', '#/b', '/?a#b'])}" for _ in range(3000)]
    urls += [None, "", "no scheme/at/all", "http://", "http:///en/x", "a://b://c/d", "http://net", "http://net?x", "http://NET/", "http://.net/en/", "http://net./", "http://ü.net/é/"]
    urls.append("http://" + "s." * 3000 + "net/" + "p/" * 3000)
    rules = {}
    while len(rules) < 300:
        rules[host(), path() + r.choice(["", "/", "e"])] = r.choice(url_filter.VERDICTS)
    rules = [(h, p, v) for (h, p), v in rules.items()]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in url_filter.judged(df, rule_rows(spark, rules)).collect()}
    assert got == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}
    kept = {x.page_id for x in url_filter.allowed(df, rule_rows(spark, rules)).collect()}
    assert kept == {i for i, v in got.items() if v[3] == "allow"}


def test_url_rules_as_text(spark):
    rows = {(x.host, x.path, x.verdict) for x in url_filter.rule_frame(spark, url_filter.RULES).collect()}
    assert rows == {("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")}
    assert url_filter.rule_frame(spark, []).count() == 0


def test_url_odd_rows(spark):
    columns = "page_id bigint, url string, host string, Verdict string, suffix string, r_host string, best int, labels int"
    rows = [(1, "http://a.net/", *["mine"] * 4, 7, 8), (1, "http://a.net/", *["mine"] * 4, 7, 8), (None, "http://a.net/x", *["mine"] * 4, 7, 8), (2, None, *["mine"] * 4, 7, 8), (3, "x" * 10**6, *["mine"] * 4, 7, 8)]
    df = spark.createDataFrame(rows, columns)
    odd_rules = rule_rows(spark, [("NET", "/", "block"), ("net", "/", "allow"), (None, "/", "block"), ("", None, "block"), ("a/b", "/", "block"), ("net", "/x", None), ("a.net", "/x", "perhaps")])
    got = url_filter.judged(df, odd_rules)
    assert got.columns == ["page_id", "url", "suffix", "r_host", "best", "labels", "host", "path", "rule", "verdict"]
    assert sorted((x.page_id or 0, x.host, x.rule, x.verdict, x.suffix, x.best) for x in got.collect()) == [
        (0, "a.net", "net/", "block", "mine", 7), (1, "a.net", "net/", "block", "mine", 7), (1, "a.net", "net/", "block", "mine", 7),
        (2, "", None, "allow", "mine", 7), (3, "", None, "allow", "mine", 7),
    ]
    kept = url_filter.allowed(df, odd_rules)
    assert kept.columns == df.columns and sorted(x.page_id for x in kept.collect()) == [2, 3]
    assert url_filter.judged(df.limit(0), odd_rules).count() == 0
    assert {x.verdict for x in url_filter.judged(df, odd_rules.limit(0), default="block").collect()} == {"block"}
    with pytest.raises(ValueError):
        url_filter.judged(df, odd_rules, default="perhaps")


# --- whitening ------------------------------------------------------------------------------------------------------


def triangular(rows):
    return np.linalg.qr(rows, mode="r")


R = np.random.default_rng(5)
MATRICES = {
    "random": np.triu(R.normal(size=(40, 40))),
    "tall": triangular(R.normal(size=(3000, 64))),
    "graded": np.triu(R.normal(size=(48, 48))) @ np.diag(10.0 ** -np.arange(0, 12, 0.25)),
    "close values": triangular(np.diag([1.0] * 10 + [1 + 1e-9] * 10 + [2.0] * 12) @ np.linalg.qr(R.normal(size=(32, 32)))[0]),
    "identity": np.eye(16),
    "zero": np.zeros((6, 6)),
    "rank 5": triangular(R.normal(size=(80, 5)) @ R.normal(size=(5, 30))),
    "empty columns": triangular(np.hstack([R.normal(size=(90, 10)), np.zeros((90, 10)), R.normal(size=(90, 10))])),
    "repeated columns": triangular(np.repeat(R.normal(size=(200, 12)), 2, axis=1)),
    "wilkinson": np.linalg.cholesky(np.diag(np.abs(np.arange(-10.0, 11)) + 2) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T,
    "one": np.array([[-3.0]]),
    "two": np.array([[3.0, 1.0], [0.0, 2.0]]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_singular_values_and_directions(name):
    r = MATRICES[name]
    values, vectors = whitening.directions(r)
    want = np.linalg.svd(r, compute_uv=False)
    top = want[0] or 1.0
    assert np.abs(values - want).max() < 1e-14 * top * len(r)
    assert np.abs(vectors.T @ vectors - np.eye(len(r))).max() < 1e-11
    assert np.abs(r.T @ (r @ vectors) - vectors * values**2).max() < 1e-13 * top**2


def values_below(a, b, square):
    """How many squared singular values are below `square`, by exact rational pivots."""
    below, pivot = 0, None
    for i in range(len(a)):
        pivot = a[i] ** 2 + (b[i - 1] ** 2 - (a[i - 1] * b[i - 1]) ** 2 / pivot if i else 0) - square
        below += pivot < 0
    return below


def test_small_singular_values_keep_their_digits():
    a, b = 10.0 ** -np.arange(0.0, 20), 10.0 ** -np.arange(0.5, 19.5)
    exact_a, exact_b = [Fraction(x) for x in a.tolist()], [Fraction(x) for x in b.tolist()]
    for i, value in enumerate(whitening.singular_values(a, b).tolist()):
        low, high = (Fraction(value) * (1 + Fraction(sign, 10**13)) for sign in (-1, 1))
        assert (values_below(exact_a, exact_b, low**2), values_below(exact_a, exact_b, high**2)) == (i, i + 1)


def plain_whitening(vectors):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    n = len(x)
    deviations = ((n * x - x.sum(0)) ** 2).sum(1)
    centred = (x * n - x.sum(0)).astype(float) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:32]
    return centred, deviations, values[order], directions[:, order], values.sum()


def compare_whitening(df, got):
    rows = [r for r in df.collect() if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)]
    centred, deviations, values, directions, trace = plain_whitening([r.embedding for r in rows])
    want = centred @ directions / np.sqrt(values)
    by = collections.defaultdict(dict)
    for g in got.collect():
        by[g.vec_id][g.component] = g
    assert set(by) == {r.vec_id for r in rows}
    signs = [np.sign(sum(by[r.vec_id][j + 1].whitened * want[i, j] for i, r in enumerate(rows))) for j in range(len(values))]
    for i, r in enumerate(rows):
        assert sorted(by[r.vec_id]) == list(range(1, len(values) + 1))
        for j in range(len(values)):
            g = by[r.vec_id][j + 1]
            assert (g.n, g.deviation) == (len(rows), deviations[i])
            assert abs(g.whitened - signs[j] * want[i, j]) < 1e-7
            assert abs(g.explained * trace / values[j] - 1) < 1e-9 and g.identity_error < 1e-8


def test_whitening_brute_force(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    bad = spark.createDataFrame([(-1, None), (-2, []), (-3, [None] * 64), (-4, [float("nan")] * 64), (-5, [float("inf")] * 64), (-6, [0.5] * 3)], df.schema)
    got = whitening.whitened(df.union(bad).repartition(40))
    compare_whitening(df, got)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_factors_in_several_rounds(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    compare_whitening(df, whitening.whitened(df.repartition(20)))


def test_whitening_odd(spark):
    schema = "vec_id bigint, embedding array<float>, component int, n int, whitened string"

    def rows(vectors):
        return spark.createDataFrame([(i, v, 1, 2, "mine") for i, v in vectors], schema)

    assert whitening.whitened(rows([])).count() == 0
    assert whitening.whitened(rows([(1, None), (2, [])])).count() == 0
    assert whitening.whitened(rows([(1, [1.0, 2.0])])).count() == 0
    assert whitening.whitened(rows([(i, [1.0, 2.0]) for i in range(9)])).count() == 0
    got = whitening.whitened(rows([(None, [0.0, 5.0, 5.0]), (1, [1.0, 5.0, 5.0]), (1, [1.0, 5.0, 5.0])])).collect()
    assert sorted((g.vec_id or 0, g.component, g.n) for g in got) == [(0, 1, 3), (1, 1, 3), (1, 1, 3)]
    assert {round(abs(g.whitened), 9) for g in got} == {round(2**0.5, 9), round(0.5**0.5, 9)}
    far = whitening.whitened(rows([(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 9.0])])).collect()
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in ([1e9, 0.0], [-1e9, 1.0], [0.0, 9.0])], object)
    want = ((3 * x - x.sum(0)) ** 2).sum(1)
    assert {g.vec_id: g.deviation for g in far} == {i + 1: int(w) if w < 1 << 63 else None for i, w in enumerate(want)}


# --- centroids ------------------------------------------------------------------------------------------------------


def plain_lloyd(vectors, k=8, rounds=10, seed=3, scale=1024):
    x = [(i, [math.floor(scale * float(c)) for c in v]) for i, v in vectors]
    first = sorted(x, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in x:
            groups[nearest(v)[1]].append(v)
        c = [[sum(col) // len(groups[j]) for col in zip(*groups[j], strict=True)] if groups[j] else m for j, m in enumerate(c)]
    final = [(i, *nearest(v)) for i, v in x]
    inertia = collections.Counter()
    for _, d, j in final:
        inertia[j] += d
    return sorted((i is None, i or 0, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in final)


def rows_of(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_clustering_brute_force(spark):
    r = random.Random(2)
    middles = [[r.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    vectors = [(i, [float(np.float32(m + r.gauss(0, 0.3))) for m in r.choice(middles)]) for i in range(300)]
    vectors += [(None, vectors[0][1]), (7, vectors[0][1])] + [(1000 + i, vectors[3][1]) for i in range(150)]
    bad = [(-1, None), (-2, []), (-3, [1.0] * 63), (-4, [None] + [1.0] * 63), (-5, [float("nan")] * 64), (-6, [float("-inf")] * 64)]
    df = spark.createDataFrame([(i, v, 1, "mine", [0]) for i, v in vectors + bad], "vec_id bigint, embedding array<float>, cluster int, x string, bounds array<int>")
    assert rows_of(centroids.clustered(df.repartition(7))) == plain_lloyd(vectors)


def test_clustering_ties_and_few(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert centroids.clustered(spark.createDataFrame([], schema)).count() == 0
    assert centroids.clustered(spark.createDataFrame([(1, None)], schema)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    few = [(i, [float(i % 2)] * 64) for i in range(3)]
    assert rows_of(centroids.clustered(spark.createDataFrame(few, schema))) == plain_lloyd(few)
    grid = [(i, [float(i % 5), float(i // 5 % 5)] + [0.0] * 62) for i in range(200)]  # many equal distances
    assert rows_of(centroids.clustered(spark.createDataFrame(grid, schema))) == plain_lloyd(grid)
    with pytest.raises(Exception, match="too large"):
        centroids.clustered(spark.createDataFrame([(1, [1e30] * 64)], schema)).count()


def test_bounds_use_the_total_displacement():
    """A centroid that goes away and comes back loosens nothing; each round's exact distances stay exact."""
    r = np.random.default_rng(8)
    x = r.integers(-1000, 1000, (400, 6))
    start = x[:5].copy()
    model = centroids.Model([start])
    cluster, bounds, rounds = np.full(400, -1, np.int32), np.zeros((400, 5)), np.zeros((400, 5), np.int32)
    assert centroids.assign(x, cluster, bounds, rounds, model) == 400 * 5
    model.history.append(start + 300)
    centroids.assign(x, cluster, bounds, rounds, model)
    assert (cluster == ((x[:, None] - model.centroids) ** 2).sum(2).argmin(1)).all()
    rounds[:], bounds[:] = 0, np.sqrt(((x[:, None] - start) ** 2).sum(2))
    cluster[:] = bounds.argmin(1)
    model.history.append(start.copy())
    open_rows = (np.sort(bounds, 1)[:, 0] == np.sort(bounds, 1)[:, 1]).sum()
    assert centroids.assign(x, cluster, bounds, rounds, model) <= 5 * open_rows
    assert np.allclose(model.moved()[0], 0) and np.allclose(model.moved()[1], 300 * 6**0.5)


def test_new_queries_registered():
    assert {"op11_url_filters", "op12_embedding_whitening", "op13_centroid_clustering"} <= set(registry.QUERIES)
    assert {"op11_url_filters", "op13_centroid_clustering"} <= set(registry.SQL)
