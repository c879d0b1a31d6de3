"""Operators 11, 12 and 13 against plain versions, on odd input and on whole small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.llm import alignment, hamming_index, infill
from tabprep.llm.queries import QUERIES
from tests.llm.conftest import ODD, sentence

SMALL = "/root/testdata/sf0.001"
ALL = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")


# Alignment --------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain_bytes(a, b):
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte, spare = {}, 256
    for x in range(256):
        if x in prints:
            byte[chr(x)] = x
        else:
            byte[chr(spare)] = x
            spare += 1
    piece = re.compile(r"<0x([0-9A-F]{2})>$")

    def of_b(i):
        text = b.id_to_piece(i)
        met = piece.match(text)
        return bytes([int(met.group(1), 16)]) if met else text.replace("▁", " ").encode()

    return lambda i: bytes(byte[c] for c in a.id_to_token(i)), of_b


def plain_alignment(texts, libraries):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups), by walking both token lists."""
    a, b = libraries
    bytes_a, bytes_b = plain_bytes(a, b)
    rows, holding = [], Counter()
    for text in texts:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        parts_a, parts_b = [bytes_a(i) for i in ids_a], [bytes_b(i) for i in ids_b]
        if not text or not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            rows.append((0, 0, [], Counter()))
            continue
        groups, links, i, j, at_a, at_b, one, two = [], Counter(), 0, 0, 0, 0, [], []
        while i < len(ids_a):
            links[ids_a[i], ids_b[j]] += 1
            end_a, end_b = at_a + len(parts_a[i]), at_b + len(parts_b[j])
            if end_a <= end_b:
                one.append(ids_a[i])
            if end_b <= end_a:
                two.append(ids_b[j])
            if end_a == end_b:
                groups.append((one, two))
                one, two = [], []
            if end_a <= end_b:
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                j, at_b = j + 1, end_b
        holding.update(set(links))
        rows.append((len(ids_a), len(ids_b), groups, links))
    most = defaultdict(int)
    for (x, _), n in holding.items():
        most[x] = max(most[x], n)
    return [(n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if holding[p] == most[p[0]]),
             sum(n * holding[p] for p, n in links.items()),
             ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)) for n_a, n_b, groups, links in rows]


def hold_alignment(df, texts, libraries):
    got = {r.doc_id: tuple(r[c] for c in ALL if c != "groups_sha256") for r in df.collect()}
    want = dict(zip(texts, plain_alignment(texts.values(), libraries)))
    assert got == want
    return want


def test_alignment_of_odd_texts(docs, libraries, monkeypatch):
    odd = ODD + [" ", "  a", "a  b   c", "<|endoftext|> <s></s>", "▁a▁", "日本語のテキスト。漢字", "é ﬁ ½   　", "퟿\U0001f468‍\U0001f469",
                 "don't WE'LL 12345 3.14", "\r\n\t\v\f\x1c", "a" * 1000 + " " * 1000 + "9" * 1000, " " * 130_000, "w" * 110_000, "Ωmega Ж"] + [sentence(30, 3)] * 3
    texts = dict(enumerate(odd))
    monkeypatch.setattr(alignment, "BUNDLE", 500)
    df = docs([(k, t, "en", "s") for k, t in texts.items()]).repartition(3)
    found = alignment.align(df, out=ALL)
    want = hold_alignment(found, texts, libraries)
    assert sum(w[0] == 0 for w in want.values()) >= 3  # null, empty, and what B cannot give back
    for r in found.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
    assert set(df.columns) <= set(found.columns)
    assert sorted(alignment.align(df, out=("n_a", "groups")).columns) == sorted([*df.columns, "n_a", "groups"])
    empty = alignment.align(docs([]), out=ALL)
    assert empty.count() == 0 and empty.dtypes == found.dtypes


def test_alignment_of_the_table(spark, libraries):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = dict(zip(texts, plain_alignment(texts.values(), libraries)))
    got = QUERIES["op11_token_alignment"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        *counts, groups = want[r.doc_id]
        assert list(r)[1:7] == counts and r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


@pytest.mark.parametrize("seed", range(40))
def test_split_finds_every_common_end(seed):
    rng = np.random.default_rng(seed)
    ends_a, ends_b, bounds, at = [], [], [(0, 0)], 0
    for _ in range(rng.integers(1, 6)):
        size = int(rng.integers(1, 300))
        for ends, share in ((ends_a, rng.random()), (ends_b, rng.random())):
            ends += [at + 1 + int(x) for x in np.flatnonzero(rng.random(size - 1) < share)] + [at + size]
        at += size
        bounds.append((len(ends_a), len(ends_b)))
    ends_a, ends_b = np.array(ends_a), np.array(ends_b)
    a, b = np.array(bounds).T
    group_a, group_b = alignment.split(ends_a, ends_b, a[:-1], a[1:], b[:-1], b[1:])
    common = np.intersect1d(ends_a, ends_b)
    assert group_a.tolist() == [0, *(np.searchsorted(ends_a, common)[:-1] + 1)]
    assert group_b.tolist() == [0, *(np.searchsorted(ends_b, common)[:-1] + 1)]
    left, right = alignment.links(ends_a, ends_b, group_a, group_b)
    union = np.union1d(ends_a, ends_b)
    assert left.tolist() == np.searchsorted(ends_a, union).tolist() and right.tolist() == np.searchsorted(ends_b, union).tolist()


# Fill in the middle ------------------------------------------------------------------------------------------------------

def plain_infill(text, doc_id, plan):
    text = text or ""
    digest = hashlib.sha256(f"{plan.seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if plan.unit == "lines" else list(text)
    n = len(units)
    if not text or any(m in text for m in plan.marks) or h[2] % 100 >= plan.fim_rate:
        return n, "plain", None, None, text
    x, y = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
    P, S, M = plan.marks
    if h[3] % 100 < plan.spm_rate:
        return n, "spm", len(p), len(m), S + s + P + p + M + m
    return n, "psm", len(p), len(m), P + p + S + s + M + m


@pytest.mark.parametrize("plan", [
    infill.Plan(), infill.Plan(unit="chars"), infill.Plan(seed="1:", fim_rate=50, spm_rate=0), infill.Plan(prefix="[pre]", suffix="ſuf", middle="🙂mid")])
def test_fill_in_middle(docs, plan):
    random.seed(3)
    texts = ODD + ["\n", "\n\n\n", "a\nb", "a\n", "é\n😀\n\nß", "has <P> inside\nit", "x<S>", "<M>", "\r\n \x85\n", "<P", "ſuf"]
    texts += ["\n".join("".join(random.choice("aé漢😀 <PSM>") for _ in range(random.randint(0, 9))) for _ in range(random.randint(1, 9))) for _ in range(150)]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)] + [(None, "a\nb\nc", None, None), (5, "repeated\nid", None, None)]
    df = docs(rows).repartition(4)
    out = ("n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored", "restored_sha256")
    found = infill.fill_in_middle(df, plan=plan, out=out)
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found.collect()), key=repr)
    assert got == sorted(((i, *plain_infill(t, i, plan)) for i, t, *_ in rows), key=repr)
    for r in found.collect():
        assert r.restored == (r.text or "") and r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
    assert set(df.columns) <= set(found.columns)
    assert infill.fill_in_middle(docs([]), plan=plan).count() == 0


def test_places_are_sparse_and_agree():
    text = "plain " * 50 + "é漢😀" + "tail" * 9
    places = infill.Places(np.frombuffer(text.encode(), np.uint8))
    assert len(places.chars) == 3
    chars = np.arange(len(text) + 1)
    want = np.array([len(text[:c].encode()) for c in chars])
    assert (places.to_bytes(chars) == want).all() and (places.to_chars(want) == chars).all() and places.n_chars == len(text)


@pytest.mark.parametrize("marks", [{"prefix": ""}, {"prefix": "<S>x"}, {"middle": "<P>"}, {"suffix": "aba"}])
def test_marks_that_cannot_be_read_back(marks):
    with pytest.raises(ValueError):
        infill.Plan(**marks)


# Nearest neighbours ------------------------------------------------------------------------------------------------------

def plain_nearest(rows, ask, k):
    """{place of the query: [(score, id)]} by comparing everything."""
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for n, (i, v) in enumerate(good):
        if i is None or not ask(i):
            continue
        near = [(-hamming_index.exact(w, v), float("inf") if j is None else j) for m, (j, w) in enumerate(good) if m != n and len(w) == len(v)]
        out[n] = (i, [(-s, j) for s, j in sorted(near)[:k]])
    return out


def hold_nearest(found, rows, ask, k, least):
    want = plain_nearest(rows, ask, k)
    lists = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        lists[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(lists) == {i for i, near in want.values() if near}
    by_id = {i: np.array(v, float) for i, v in rows if i is not None and v}
    hits = total = 0
    for i, near in want.values():
        got = lists[i]
        assert len(got) == len(near) and [r for r, *_ in got] == list(range(1, len(got) + 1))
        assert sorted(got, key=lambda g: (-g[2], g[1] if g[1] is not None else float("inf"))) == got
        for _, j, score in got:
            assert j is None or score == hamming_index.exact(by_id[j], by_id[i])
        bar = near[-1][0] if near else 0
        hits += sum(s >= bar for *_, s in got)
        total += len(near)
    assert hits >= least * total
    return hits / total


def mixed_vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[: n // 3] = x[rng.integers(0, 12, n // 3)] + 0.1 * rng.normal(size=(n // 3, dim))
    x[n // 3: n // 2] = x[0]  # copies
    return np.float32(x * rng.choice([0.5, 1.0, 1.0, 1.1, 40.0], size=(n, 1)))


@pytest.mark.parametrize("search", [
    hamming_index.Search(), hamming_index.Search(k=5, bits=64, chunk=8, slice_rows=90, block_rows=7),
    hamming_index.Search(k=7, bits=128, slice_rows=200, block_rows=10)])
def test_nearest_neighbours(make, search):
    x = mixed_vectors(700, 16, 5)
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000, None), (1020, []), (1040, [0.0] * 16), (1060, [float("nan")] + [1.0] * 15), (1080, [float("inf")] + [1.0] * 15), (1100, [None, 1.0]),
             (1120, [1.0, 2.0]), (None, [float(v) for v in x[3]]), (1140, [1.0] * 40)]
    df = make([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<float>, ask string, rank int").repartition(5)
    found = hamming_index.nearest(df, F.col("id") % 20 == 0, search=search)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    share = hold_nearest(found, rows, lambda i: i % 20 == 0, search.k, 0.95)
    measured = hamming_index.recall(df, found, 1000, k=search.k)
    assert abs(measured - share) < 0.02


def test_nearest_with_repeated_and_few_rows(make):
    kind = "vec_id bigint, embedding array<double>"
    rows = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (7, [1.0, 0.0]), (40, [0.0, -2.0]), (None, [0.5, 0.5])]
    found = hamming_index.nearest(make(rows, kind), F.col("id") % 20 == 0)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.where("query_id = 20").collect())
    one = [(20, 1, 7, 1.0), (20, 2, 20, 1.0), (20, 3, None, 0.5), (20, 4, 40, 0.0)]
    assert got == sorted(one * 2)
    assert [(r.rank, r.vec_id, r.score) for r in found.where("query_id = 40").orderBy("rank").collect()] == [
        (1, 7, 0.0), (2, 20, 0.0), (3, 20, 0.0), (4, None, -1.0)]
    assert hamming_index.nearest(make([(20, [1.0])], kind), F.col("id") % 20 == 0).count() == 0
    empty = hamming_index.nearest(make([], kind), F.col("id") % 20 == 0)
    assert empty.count() == 0 and hamming_index.recall(make([], kind), empty) == 1.0


def test_nearest_of_the_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    hold_nearest(QUERIES["op13_nearest_neighbours"](spark, SMALL), rows, lambda i: i % 20 == 0, 20, 0.98)


def test_every_code_within_the_radius_is_met():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(800, 32))
    search = hamming_index.Search(k=3, bits=64, chunk=8)
    code = hamming_index.codes(hamming_index.unit(x), hamming_index.learn(hamming_index.unit(x), 64))
    tables = hamming_index.Tables(x, code, np.ones(800, int), search, 3.0)
    for n in range(20):
        for cosine in (0.95, 0.5, 0.0):
            floor = cosine * np.linalg.norm(x[n]) * tables.most
            radius = tables.radius(floor, np.linalg.norm(x[n]))
            inside = hamming_index.apart(code, code[n]) <= radius
            met, _ = tables.search_one(x[n], code[n], floor, 10_000)
            assert set(met) == set(np.flatnonzero(inside & (x @ x[n] >= floor - 1e-9)))
