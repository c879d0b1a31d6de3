"""Operators 4, 8 and 9: against brute force, by held-out accuracy, and on odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.llm import embed_dedup, hnsw, language, quality_model
from tabprep.llm.gray import _root, unite
from tests.llm.conftest import ODD, sentence

MIDDLE = "/root/testdata/sf0.01"


# Embeddings -------------------------------------------------------------------------------------------------------------

def clustered(n, dim, groups, noise, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return centres[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, dim))


def plain_links(vectors, threshold=0.93):
    x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    return near


def test_graph_recall():
    vectors = np.concatenate([clustered(2500, 32, 300, 0.1, 1), np.random.default_rng(2).normal(size=(1500, 32))])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = hnsw.Graph(unit)
    ids, _ = graph.nearest(graph.x, 32)
    exact = np.argsort(-(graph.x @ graph.x.T), axis=1)[:, :10]
    found = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids.tolist(), exact.tolist())])
    assert found >= 0.95
    assert hnsw.Graph(unit[:1]).nearest(unit[:1].astype(np.float32), 4)[0][0, 0] == 0


@pytest.mark.parametrize("shard_rows", [50_000, 120])
def test_embedding_links_and_components(make, shard_rows):
    vectors = np.concatenate([clustered(500, 16, 40, 0.08, 3), clustered(120, 16, 1, 0.05, 4)])
    vectors = np.float32(vectors)
    vectors[50:70] = vectors[50]  # copies
    labels = [int(n % 3) if n < 500 else 7 for n in range(len(vectors))]
    labels[50:70] = [1] * 20
    rows = [(1000 - n, [float(v) for v in x], lab, "x") for n, (x, lab) in enumerate(zip(vectors, labels))]
    odd = [(2000, None, 1, "x"), (2001, [], 1, "x"), (2002, [0.0] * 16, 1, "x"), (2003, [float("nan")] + [1.0] * 15, 1, "x"),
           (2004, [float("inf")] + [1.0] * 15, 1, "x"), (2005, [float(v) for v in vectors[50]], None, "x"), (2006, [1.0, 2.0], 1, "x"),
           (2007, [None, 1.0], 1, "x")]
    table = make(rows + odd, "vec_id bigint, embedding array<float>, label int, component_id string").repartition(3)
    found = {r.vec_id: r for r in embed_dedup.near_duplicates(table, search=embed_dedup.Search(shard_rows=shard_rows)).collect()}
    assert len(found) == len(rows) + len(odd)
    wide = vectors.astype(float)
    near = plain_links(wide) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    roots = np.arange(len(vectors))[::-1].copy()  # place 0 is the smallest id
    label = np.arange(len(vectors))
    i, j = np.nonzero(near)
    unite(label, len(vectors) - 1 - i, len(vectors) - 1 - j)
    label = _root(label, np.arange(len(vectors)))
    exact = sum(near.sum(axis=1))
    got = sum(found[1000 - n].n_links for n in range(len(vectors)))
    assert got <= exact and got >= 0.99 * exact
    for n in range(len(vectors)):
        smallest = 1000 - (len(vectors) - 1 - label[roots[n]])
        assert found[1000 - n].component_id == smallest and found[1000 - n].kept == (smallest == 1000 - n)
    for i, *_ in odd:
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)


def test_embeddings_without_ids_or_rows(make):
    kind = "vec_id bigint, embedding array<float>, label int"
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (4, [1.0, 0.01], 1), (None, [0.0, 1.0], 1), (4, [1.0, 0.01], 1)]
    found = sorted(map(tuple, embed_dedup.near_duplicates(make(rows, kind)).collect()), key=repr)
    assert found == sorted([(None, 3, 4, False), (None, 3, 4, False), (4, 3, 4, True), (4, 3, 4, True), (None, 0, None, False)], key=repr)
    assert embed_dedup.near_duplicates(make([], kind)).count() == 0


def test_beams_widen_past_dense_groups():
    vectors = clustered(3000, 24, 3, 0.03, 6)
    shard = embed_dedup.Shard(vectors, embed_dedup.Search(beam=8))
    near = plain_links(vectors)
    found = np.zeros(len(vectors), int)
    for i, j in shard.links(vectors[:40]):
        np.add.at(found, i, (i != j).astype(int))
    assert (found[:40] == near[:40].sum(axis=1)).all()


def paired(n, dim, pairs, seed):
    """Scattered vectors, few of which have one partner."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, dim))
    vectors[n - pairs:] = vectors[:pairs] + 0.05 * rng.normal(size=(pairs, dim))
    return vectors


def short_sighted(monkeypatch):
    """Searches that find a vector itself at any beam, and others only from 64 on."""
    nearest = hnsw.Graph.nearest

    def search(self, queries, beam):
        ids, sims = nearest(self, queries, beam)
        return (ids, sims) if beam >= 64 else (ids, np.where(sims > 1 - 1e-6, sims, np.float32(-2)))

    monkeypatch.setattr(hnsw.Graph, "nearest", search)


def test_audit_leaves_links_to_itself_out(monkeypatch):
    short_sighted(monkeypatch)
    vectors = paired(3000, 24, 3, 7)
    shard = embed_dedup.Shard(vectors, embed_dedup.Search(beam=16))
    near = plain_links(vectors)
    assert near.sum() == 6 and shard.beam == 64
    found = np.zeros_like(near)
    for i, j in shard.links(vectors):
        found[i, j] = True
    np.fill_diagonal(found, False)
    assert (found == near).all()


def test_audit_weighs_vectors_not_links(monkeypatch):
    nearest = hnsw.Graph.nearest
    dense = clustered(200, 24, 1, 0.03, 8)
    vectors = np.concatenate([dense, paired(3800, 24, 60, 9)])

    def search(self, queries, beam):
        ids, sims = nearest(self, queries, beam)
        blind = (queries @ dense[0] / np.linalg.norm(dense[0]) < 0.9) & (beam < 64)
        return ids, np.where(blind[:, None] & (sims < 1 - 1e-6), np.float32(-2), sims)

    monkeypatch.setattr(hnsw.Graph, "nearest", search)
    assert embed_dedup.Shard(vectors, embed_dedup.Search(beam=16)).beam >= 64


def test_searches_of_other_shards_are_audited(monkeypatch):
    short_sighted(monkeypatch)
    vectors = paired(4000, 24, 20, 10)
    here, there = vectors[:3900], vectors[3900:]  # no two here are near
    shard = embed_dedup.Shard(here, embed_dedup.Search(beam=16))
    assert shard.beam == 16
    place = np.arange(len(here))
    answers = embed_dedup._answers(shard, place, np.ones(len(here), np.int64), 5000 + np.arange(100), there, False, place.copy())
    assert sum(answers.column(1).to_pylist()) == 20


def test_graph_survives_its_rows():
    vectors = clustered(1500, 24, 200, 0.1, 11)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = hnsw.Graph(unit)
    size, links = graph.rows()
    again = hnsw.Graph.restored(unit, graph.height, links)
    assert size.sum() == len(links) and len(again.layers) == len(graph.layers) > 1
    assert all((a == b).all() for a, b in zip(again.layers, graph.layers)) and (again.order == graph.order).all()
    assert (again.nearest(graph.x[:50], 16)[0] == graph.nearest(graph.x[:50], 16)[0]).all()


def test_slices_of_searches_find_the_same(make):
    vectors = np.float32(np.concatenate([clustered(900, 16, 150, 0.08, 12), clustered(300, 16, 1, 0.05, 13)]))
    rows = [(n, [float(v) for v in x], 1) for n, x in enumerate(vectors)]
    table = make(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    near = plain_links(vectors.astype(float))
    label = np.arange(len(vectors))
    unite(label, *np.nonzero(near))
    label = _root(label, np.arange(len(vectors)))
    for shard_rows, slice_rows in ((10_000, 10_000), (10_000, 170), (400, 250)):
        found = {r.vec_id: r for r in embed_dedup.near_duplicates(
            table, search=embed_dedup.Search(shard_rows=shard_rows, slice_rows=slice_rows)).collect()}
        got = np.array([found[n].n_links for n in range(len(vectors))])
        assert (got <= near.sum(axis=1)).all() and got.sum() >= 0.995 * near.sum()
        assert [found[n].component_id for n in range(len(vectors))] == label.tolist()


def test_vectors_of_any_finite_size(make):
    rows = [(1, [1e300, 1e300], 1), (2, [1e300, 1.01e300], 1), (3, [3e-200, 3e-200], 1), (4, [1.0, -1.0], 1), (5, [1e300, 1e300], 1)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(
        make(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    assert found == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (0, 4), 5: (3, 1)}


# Quality ----------------------------------------------------------------------------------------------------------------

def test_quality_held_out(spark):
    from tabprep.llm.queries import QUERIES

    found = QUERIES["op8_quality_classifier"](spark, MIDDLE)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id").toPandas()
    assert found.count() == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    for part in (rows[rows.held_out], rows[~rows.held_out]):
        good, bad = part[part.quality == 1], part[part.quality == 0]
        assert (good.score.to_numpy()[:, None] > bad.score.to_numpy()[None, :]).mean() > 0.97
        assert good.predicted.mean() > 0.97 and bad.predicted.mean() < 0.2


def test_quality_odd_input(docs, make):
    rows = [(i, t, "en", "a") for i, t in enumerate(ODD)] + [(100 + i, sentence(60, i) + " !!" * (60 * (i % 2)), "en", "a") for i in range(40)]
    table = docs(rows + [rows[-1], (None, "text", None, None)])
    labels = make([(100 + i, 1 - i % 2, 5) for i in range(40)] + [(100, 1, 5), (None, 1, 5), (2, None, 5), (3, 9, 5)],
                  "doc_id bigint, quality int, score int")
    model = quality_model.fit(table, labels)
    out = model.transform(table)
    found = out.collect()
    assert len(found) == len(rows) + 2 and out.columns.count("score") == 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert {r.predicted for r in found if (r.doc_id or 0) >= 100 and r.doc_id % 2} == {0}
    again = {r.doc_id: r.score for r in quality_model.fit(table.repartition(4), labels).transform(table).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in found)
    untrained = quality_model.fit(table, labels.limit(0)).transform(table)
    assert {r.score for r in untrained.collect()} == {0.5}
    assert model.transform(docs([])).count() == 0


def test_quality_sample_is_bounded(docs, make):
    table = docs([(i, sentence(30, i) + " ##" * (20 * (i % 2)), "en", "a") for i in range(300)])
    labels = make([(i, 1 - i % 2) for i in range(300)], "doc_id bigint, quality int")
    settings = quality_model.Settings(max_rows=100, rows_per_task=30)
    found = quality_model.fit(table, labels, settings=settings).transform(table).collect()
    assert np.mean([r.predicted == 1 - r.doc_id % 2 for r in found]) > 0.95


# Languages --------------------------------------------------------------------------------------------------------------

def test_language_held_out(spark):
    from tabprep.llm.queries import QUERIES

    found = QUERIES["op9_language_id"](spark, MIDDLE)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score", "ambiguous"]
    rows = found.join(spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    for part in (rows[rows.held_out], rows[~rows.held_out]):
        assert (part.lang_pred == part.lang).mean() > 0.98


def test_language_odd_input(docs):
    rows = [(i, t, None, "a") for i, t in enumerate(ODD)] + [(50, "12 !! 34", "xx", "a")]
    rows += [(100 + i, " ".join(["thing with this", "schen auch nicht", "çon été leaux"][i % 3].split() * (1 + i % 4)), "abc"[i % 3], "s") for i in range(60)]
    table = docs(rows + [rows[-1]])
    model = language.fit(table)
    assert set(model.languages) == {"a", "b", "c"}  # nothing to learn of the fourth
    found = model.transform(table).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        if r.doc_id >= 100:
            assert r.lang_pred == "abc"[(r.doc_id - 100) % 3] and 0 <= r.score <= 1
    odd = {r.doc_id: r for r in found if r.doc_id < 100}
    assert {i for i, r in odd.items() if r.lang_pred == "und"} == {0, 1, 2, 4, 50}
    assert all(odd[i].score == 0 and odd[i].ambiguous for i in (0, 1, 2, 4, 50))
    nothing = language.fit(table.where(F.lit(False))).transform(table)
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert model.transform(docs([])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 4, 7, 8, 30])
def test_codewords_differ(n):
    code = language.code_matrix(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1, 1}
    for a in range(n):
        for b in range(a):
            assert (code[a] != code[b]).sum() >= (4 if n == 4 else 1)
    assert (np.abs(code.sum(axis=0)) < max(n, 2)).all()


def test_one_language(docs):
    model = language.fit(docs([(1, "some words", "en", "a")]))
    assert model.predict("other words")[:2] == ("en", 1.0)


def plain_language_model(rows, smoothing=0.5):
    """Weights of every bit from the counts of all languages side by side."""
    names = sorted({lang for lang, text in rows if lang is not None and len(language.gram_places(text or ""))})
    counts = np.zeros((len(names), language.GRAMS))
    for lang, text in rows:
        if lang in names:
            counts[names.index(lang)] += np.bincount(language.gram_places(text or ""), minlength=language.GRAMS)
    share = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
    code = language.code_matrix(len(names))
    one = np.stack([share[code[:, k] > 0].mean(axis=0) for k in range(code.shape[1])], axis=1)
    zero = np.stack([share[code[:, k] < 0].mean(axis=0) for k in range(code.shape[1])], axis=1)
    return names, code, np.log(one) - np.log(zero)


@pytest.mark.parametrize("n", [2, 4, 9])
def test_language_model_equals_the_plain_one(docs, n):
    rows = [(f"l{k % n}", sentence(30, k % n, 7) + f" word{k}") for k in range(60)] + [(None, "not learned"), ("l0", None), ("none", "1 2 3")]
    model = language.fit(docs([(k, t, lang, "s") for k, (lang, t) in enumerate(rows)]).repartition(4))
    names, code, weights = plain_language_model(rows)
    assert list(model.languages) == names and (model.code == code).all() and model.weights == pytest.approx(weights, abs=1e-9)
    for _, text in rows[:20]:
        margins = np.bincount(language.gram_places(text), minlength=language.GRAMS) @ weights / np.sqrt(len(language.gram_places(text)))
        loss = [sum(w * np.log1p(np.exp(-c * m)) for w, c, m in zip(model.bit_weights, word, margins)) for word in code]
        assert model.predict(text)[0] == names[int(np.argmin(loss))]


def test_thousands_of_languages(docs):
    rows = [(k, sentence(6, k, 6), f"lang {k % 2500}", "s") for k in range(5000)]
    model = language.fit(docs(rows, extra=False))
    assert len(model.languages) == 2500 and model.weights.shape == (language.GRAMS, model.code.shape[1]) and model.code.shape[1] < 130
    assert np.isfinite(model.weights).all()
    again = language.fit(docs(rows, extra=False).repartition(7))
    assert (again.weights == model.weights).all()


@pytest.mark.parametrize("root", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_embedding_query_equals_brute_force(spark, root):
    from tabprep.llm.queries import QUERIES

    rows = spark.read.parquet(f"{root}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors, labels = np.array([r.embedding for r in rows], float), np.array([r.label for r in rows])
    near = plain_links(vectors) & (labels[:, None] == labels[None, :])
    order = np.argsort(ids)
    place = np.argsort(order)
    label = np.arange(len(ids))
    i, j = np.nonzero(near)
    unite(label, place[i], place[j])
    smallest = ids[order][_root(label, np.arange(len(ids)))]
    want = {int(ids[n]): (int(near[n].sum()), int(smallest[place[n]])) for n in range(len(ids))}
    found = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op4_embedding_dedup"](spark, root).collect()}
    assert found == want


def plain_ftrl(rows, s):
    """Follow the regularised leader, one coordinate after the other."""
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= s.l1:
            return 0.0
        return -(zi - (s.l1 if zi > 0 else -s.l1)) / ((s.beta + n.get(i, 0.0) ** 0.5) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for places, values, label in rows:
            x = dict(zip(places.tolist(), values.tolist())) | {"bias": 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-max(-35.0, min(35.0, sum(w[i] * v for i, v in x.items())))))
            for i, v in x.items():
                g = (p - label) * v
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / s.alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_quality_model_equals_the_plain_one(docs, make):
    s = quality_model.Settings(bits=10)
    texts = {k: sentence(8, k % 5, 7) + (" fine words here" if k % 3 else " ### spam !!!") for k in range(90)}
    rows = [(*quality_model.features(t, s.bits), float(k % 3 > 0)) for k, t in texts.items()]
    plain = plain_ftrl(rows, s)
    weights = quality_model.train_rows(rows, s)
    want = np.zeros(len(weights))
    for i, w in plain.items():
        want[-1 if i == "bias" else i] = w
    assert weights == pytest.approx(want, abs=1e-9) and (weights != 0).sum() > 20
    # The fitted model sees the rows in the order of its draw; its scores are the plain weights' logistic sums.
    model = quality_model.fit(docs([(k, t, "en", "s") for k, t in texts.items()]), make([(k, int(k % 3 > 0)) for k in texts], "doc_id bigint, quality int"), settings=s)
    draw = {r.doc_id: r.d for r in make([(k,) for k in texts], "doc_id bigint").select("doc_id", F.xxhash64(F.lit("quality"), "doc_id").alias("d")).collect()}
    plain = plain_ftrl([rows[k] for k in sorted(texts, key=draw.get)], s)
    scored = model.transform(docs([(k, t, "en", "s") for k, t in texts.items()], extra=False)).collect()
    for r in scored:
        places, values, _ = rows[r.doc_id]
        margin = plain["bias"] + sum(plain.get(i, 0.0) * v for i, v in zip(places.tolist(), values.tolist()))
        assert r.score == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)
