"""URL filters, exact search and embedding near-duplicates against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidefeed.llm import queries as q
from tidefeed.llm.embedding_dedup import Lattices, near_duplicates, nearest_points, shape
from tidefeed.llm.topk_search import top_k, whole_vectors
from tidefeed.llm.url_filters import filter_urls

URLS = [
    (1, "http://WWW.Example.com/en/x?q"), (2, "https://a.example.com/en/"), (3, "http://example.com"),
    (4, "http://example.com/en"), (5, "ftp://x.net/es/1#f"), (6, "net/es/1"), (7, None), (8, ""),
    (9, "http://badexample.com/en/"), (10, "http://x.net/fr/?a"), (11, "http:///en/"), (12, "http://com/"),
    (13, "http://a.b.c.www.example.com/en/1"), (14, "http://É.com/Ü"), (1, "http://WWW.Example.com/en/x?q"),
    (None, "http://x.org/"), (15, "http://e.com/a\nb?c"),
]


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = []
    for rule, verdict in rules:
        at = rule.find("/") if "/" in rule else len(rule)
        h, p = rule[:at], rule[at:]
        if h and (host == h or host.endswith("." + h)) and path.startswith(p) and host:
            fits.append((len(rule), len(h), rule, verdict))
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


RULES = [*q.URL_RULES, ("example.com", "block"), ("com/en/", "block"), ("org/x", "block"), ("", "block")]


@pytest.mark.parametrize("rules", [q.URL_RULES, RULES, []])
def test_urls_equal_brute_force(spark, rules):
    pages = spark.createDataFrame(URLS, "page_id LONG, url STRING").withColumns(
        {c: F.lit("x") for c in ("host", "key", "part", "rule")}
    )
    table = spark.createDataFrame(rules, "rule STRING, verdict STRING")
    got = filter_urls(pages, table).select("page_id", "host", "path", "rule", "verdict").collect()
    want = [(i, *judged(u, rules)) for i, u in URLS]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_urls_of_a_test_table(spark, sf_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = q.op1_url_filters(spark, sf_dir).collect()
    assert len(got) == len(urls)
    assert all(tuple(r)[1:] == judged(urls[r.page_id], q.URL_RULES) for r in got)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id LONG, url STRING")
    rules = spark.createDataFrame(q.URL_RULES, "rule STRING, verdict STRING")
    assert filter_urls(pages, rules).count() == 0


VECTORS = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def vectors():
    draw = np.random.default_rng(1)
    x = draw.standard_normal((200, 16)) / 4
    x[40:60] = x[0] + draw.standard_normal((20, 16)) / 60
    rows = [(i, x[i].tolist(), 0) for i in range(200)]
    rows += [(300 + i, x[0].tolist(), 1) for i in range(30)]
    rows += [(i, x[5].tolist(), 1) for i in (400, 400)]
    odd = [None, [float("nan")] * 16, [float("inf")] * 16, [None] * 16, [0.0] * 16, []]
    return rows + [(500 + 20 * i, v, 0) for i, v in enumerate(odd)]


def test_search_equals_brute_force(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, VECTORS)
    usable = whole_vectors(frame, "embedding")
    ints = usable.select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("long")).alias("vector"),
    )
    got = {}
    for r in top_k(ints, ints.where("id % 20 = 0"), 20).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    good = [(i, np.floor(64 * np.array(v, np.float32).astype(float))) for i, v, _ in rows if v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all()]
    for i, v in good:
        if i % 20 == 0:
            scored = sorted((-int(v @ w), j) for j, w in good if j != i)
            assert got[i] == [(j, -s) for s, j in scored[:20]]
    assert set(got) == {i for i, _ in good if i % 20 == 0}


def test_search_of_few_and_of_none(spark):
    frame = spark.createDataFrame([(20, [1]), (21, [2])], "id LONG, vector ARRAY<LONG>")
    assert [tuple(r) for r in top_k(frame, frame.where("id = 20")).collect()] == [(20, 1, 21, 2)]
    assert top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_lattice_points_are_the_nearest():
    draw = np.random.default_rng(2)
    y = draw.standard_normal((200, 8)) * 2
    near = nearest_points(y)
    twice = np.rint(2 * near)
    assert np.allclose(twice, 2 * near)
    assert ((twice % 2 == twice[:, :1] % 2).all(1)).all() and (near.sum(1) % 2 == 0).all()
    from tidefeed.llm.embedding_dedup import NEIGHBOURS

    assert len(np.unique(NEIGHBOURS, axis=0)) == 240
    moved = near[:, None, :] + NEIGHBOURS[None]
    assert (((y[:, None] - moved) ** 2).sum(2) >= ((y - near) ** 2).sum(1)[:, None] - 1e-9).all()


@pytest.mark.parametrize("blocks", [1, 2])
def test_lattice_cells_find_near_copies(blocks):
    draw = np.random.default_rng(4)
    x = draw.standard_normal((500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + draw.standard_normal((500, 64)) * 0.018
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    a, b = Lattices(64, blocks).cells(x), Lattices(64, blocks).cells(y)
    met = (a == b[:, :, :1]).any((1, 2)) | (b == a[:, :, :1]).any((1, 2))
    assert met.mean() > 0.95


def test_near_duplicates_equal_brute_force(spark):
    rows = vectors()
    got = near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == len(rows)
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if v and None not in v]
    good = [(i, v / np.linalg.norm(v)) for i, v in good if np.isfinite(v).all() and v.any()]
    unit = np.array([v for _, v in good])
    links = (unit @ unit.T >= 0.9).sum(1) - 1
    want = {}
    for (i, _), n in zip(good, links):
        want.setdefault(i, int(n))
    found = sum(r.n_links for r in got if r.vec_id != 400)
    assert found >= 0.9 * sum(n for i, n in want.items() if i != 400)
    assert all(r.n_links <= want.get(r.vec_id, 0) for r in got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    group = {r.component_id for r in got if r.vec_id == 0 or 300 <= r.vec_id < 330}
    assert group == {0}
    assert near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("n", [500, 70_000, 100_000_000])
@pytest.mark.parametrize("cosine", [0.9, 0.92, 0.95])
def test_recall_is_the_same_for_every_size(n, cosine):
    blocks, scale = shape(n)
    draw = np.random.default_rng(7)
    x, z = draw.standard_normal((2, 600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (x * z).sum(1, keepdims=True) * x
    y = cosine * x + np.sqrt(1 - cosine**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    a, b = (Lattices(64, blocks, 0.9, scale).cells(v) for v in (x, y))
    met = (a == b[:, :, :1]).any((1, 2)) | (b == a[:, :, :1]).any((1, 2))
    assert met.mean() > 0.97


@pytest.mark.parametrize("blocks", [1, 2])
def test_links_at_the_threshold_equal_brute_force(spark, monkeypatch, blocks):
    from tidefeed.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "shape", lambda n: (blocks, 0.6 if blocks == 1 else 0.45))
    draw = np.random.default_rng(6)
    x = draw.standard_normal((300, 64))
    y = x + draw.standard_normal((300, 64)) * 0.47
    unit = np.concatenate([x, y]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(unit)]
    unit = unit.astype(float) / np.linalg.norm(unit.astype(float), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    got = {r.vec_id: r.n_links for r in near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    assert all(got[i] <= n for i, n in enumerate(want)) and want.sum() > 200
    assert sum(got.values()) >= 0.97 * want.sum()
