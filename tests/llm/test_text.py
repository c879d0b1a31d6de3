"""Operators 1, 2 and 3 against plain versions, on odd texts and on a whole small table."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabprep.llm import bpe, graph, gray, simhash, suffix, suffix_dedup
from tests.llm.brute import kept_bytes
from tests.llm.conftest import ODD, sentence

SMALL = "/root/testdata/sf0.001"


# Suffix arrays ---------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(60))
def test_suffix_array_order(seed):
    random.seed(seed)
    alphabet = random.choice([b"a", b"ab", b"abc", bytes(range(256))])
    t = np.array([0 if random.random() < 0.03 else random.choice(alphabet) + 1 for _ in range(random.randint(1, 400))] + [0], np.uint16)
    order = suffix.suffix_array(t)
    assert sorted(order.tolist()) == list(range(len(t)))
    padded = t.tolist() + [0] * 200
    keys = [padded[i:i + 100] for i in order]
    assert all(a <= b for a, b in zip(keys, keys[1:]))


@pytest.mark.parametrize("length", [100, 106, 150, 300])
def test_repeats_of_any_length(length):
    # Strings that differ only in their last characters, in turns.
    start = sentence(80, 7).encode()[:length - 3]
    texts = [start + end for end in (b"abc", b"abd", b"xbc") * 10]
    starts = np.arange(len(texts)) * (length + 1)
    classes = suffix.repeats(texts, starts, length)
    assert len(set(classes)) == 3 and len(set(zip(texts, classes))) == 3


@pytest.mark.parametrize("length", [31, 1, 0])
def test_strings_shorter_than_an_anchor_are_refused(docs, length):
    with pytest.raises(ValueError):
        suffix_dedup.dedup(docs([(1, "text", "en", "s")]), length=length)


def test_shortest_strings(docs):
    texts = dict(enumerate([sentence(12, 3), "x" + sentence(12, 3)[5:60] + "y", "z" * 40, sentence(12, 4)]))
    found = suffix_dedup.dedup(docs([(k, t, "en", "s") for k, t in texts.items()]), length=32)
    want = kept_bytes({k: t.encode() for k, t in texts.items()}, 32)
    assert {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans) for r in found.collect()} == want


def test_every_group_is_searched_by_the_index(spark, monkeypatch):
    rng = np.random.default_rng(12)
    codes = rng.integers(-2**63, 2**63, 4000)
    codes[:900] = codes[:300].repeat(3) ^ (np.int64(1) << rng.integers(0, 62, 900))
    index = gray.GrayIndex(np.sort(codes.view(np.uint64)))
    table = spark.createDataFrame([(int(c),) for c in np.unique(codes)], "code bigint")
    ordered = np.unique(codes).view(np.uint64)
    ordered = ordered[np.argsort(gray.gray_rank(ordered))]
    index = gray.GrayIndex(ordered)
    root = index.link(3)
    assert index.compared < len(ordered) * (len(ordered) - 1) // 2
    least = {}
    for c, r in zip(ordered.view(np.int64).tolist(), root.tolist()):
        least[r] = min(c, least.get(r, c))
    want = {c: least[r] for c, r in zip(ordered.view(np.int64).tolist(), root.tolist())}
    for aimed in (64, 100_000):
        monkeypatch.setattr(simhash, "AIMED", aimed)
        found = {r.node: r.root for r in graph.components(simhash.near_links(table)).collect()}
        assert {c: found.get(c, c) for c in want} == want


def hostile_documents():
    """Passages shared at edges and inside, repeats within a document, periods, binary-like and multi-byte text."""
    random.seed(5)
    shared = [sentence(40, s) for s in range(6)]
    out = list(ODD) + ["ab" * 300, "ab" * 301, "z" * 99, "z" * 100, "z" * 101, "é" * 80, "aé" * 70, shared[0][:100], shared[0][1:101]]
    for n in range(120):
        parts = [sentence(random.randint(0, 12), 100 + n), random.choice(shared), sentence(random.randint(0, 9), 300 + n)]
        if n % 3 == 0:
            parts += [random.choice(shared)[random.randint(0, 30):], random.choice(shared)[: random.randint(50, 200)]]
        out.append(" ".join(parts))
    return out + out[20:40]


def hold_dedup(rows, texts, order):
    want = kept_bytes({order[k]: (t or "").encode() for k, t in texts.items()})
    for r in rows:
        left, removed, spans = want[order[r.doc_id, r.text_]] if isinstance(next(iter(order)), tuple) else want[order[r.doc_id]]
        assert bytes(r.kept) == left and (r.n_removed, r.n_spans) == (removed, spans)


def test_suffix_dedup(docs, monkeypatch):
    texts = dict(enumerate(hostile_documents()))
    table = docs([(i, t, "en", "a") for i, t in texts.items()])
    rows = suffix_dedup.dedup(table.repartition(4)).collect()
    assert len(rows) == len(texts)
    hold_dedup(rows, texts, {i: i for i in texts})
    # The same with every shared edge sent string by string, with tiny suffix arrays, and with texts over a tile.
    monkeypatch.setattr(suffix_dedup, "_hot_anchors", lambda d, n: np.sort(np.array(
        [r.key for r in d.mapInArrow(suffix_dedup._runs_task(n, np.empty(0, np.uint64)), suffix_dedup.RUNS).where("number > 0").collect()],
        np.int64).view(np.uint64))[::2])
    hold_dedup(suffix_dedup.dedup(table).collect(), texts, {i: i for i in texts})


def test_no_anchor_outgrows_a_chunk(docs, monkeypatch):
    # One passage between different edges, in too few documents to count as hot.
    passage = sentence(40, 900)[:160]
    texts = {i: sentence(12, i) + passage + sentence(12, 500 + i) for i in range(40)}
    table = docs([(i, t, "en", "a") for i, t in texts.items()])
    plain = table.select(F.col("doc_id").alias("doc"), "text")
    assert len(suffix_dedup._hot_anchors(plain, 100)) == 0
    monkeypatch.setattr(suffix_dedup, "CHUNK", 2_000)
    assert len(suffix_dedup._large_anchors(suffix_dedup._met(plain, 100, np.empty(0, np.uint64)), 100))
    assert len(suffix_dedup._large_anchors(suffix_dedup._gathered(plain, 100), 100)) == 0
    hold_dedup(suffix_dedup.dedup(table).collect(), texts, {i: i for i in texts})


def test_suffix_dedup_small_chunks():
    from pyarrow import RecordBatch, array, binary

    random.seed(1)
    shared = [sentence(30, s).encode() for s in range(5)]
    pieces, key = [], np.sort(np.random.default_rng(1).integers(0, 5, 200))
    for k in key:
        # Equal strings have equal keys.
        pieces.append(shared[k][random.randint(0, 20):] + sentence(3, 1000 * int(k) + random.randint(0, 9)).encode())
    doc = np.arange(200)
    batch = RecordBatch.from_arrays([array(key), array(doc), array(np.zeros(200, np.int64)), array(pieces, binary())],
                                    names=["key", "doc", "start", "piece"])
    results = []
    for chunk in (10, 3_000, 10**9):
        suffix_dedup.CHUNK, old = chunk, suffix_dedup.CHUNK
        found = [b.to_pydict() for b in suffix_dedup._array_task(100)(iter([batch.slice(0, 90), batch.slice(90, 60), batch.slice(150)]))]
        suffix_dedup.CHUNK = old
        results.append(sorted(x for f in found for x in zip(f["doc"], f["start"], f["end"])))
    assert results[0] == results[1] == results[2] and results[0]


def test_suffix_dedup_repeated_and_null_ids(make):
    texts = [sentence(60, 1), sentence(60, 1) + sentence(30, 2), sentence(30, 2), None, sentence(25, 1)]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (None, texts[2]), (None, texts[3]), (3, texts[4])]
    table = make([(i, t, t, 1) for i, t in rows], "doc_id bigint, text string, text_ string, spans int")
    found = suffix_dedup.dedup(table).collect()
    assert len(found) == len(rows)
    digest = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    listed = sorted({(i, t) for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1])))
    want = kept_bytes({n: (t or "").encode() for n, (_, t) in enumerate(listed)})
    for r in found:
        left, removed, spans = want[listed.index((r.doc_id, r.text_))]
        assert bytes(r.kept) == left and (r.n_removed, r.n_spans) == (removed, spans)
    assert suffix_dedup.dedup(table.limit(0)).count() == 0


def test_long_text_in_tiles():
    text = (sentence(4_000, 1) * 70).encode()
    data = np.frombuffer(text, np.uint8)
    found = np.zeros(len(data) - 99, bool)
    for first, last, begin, end in suffix_dedup._tiles(np.array([0, len(data)]), 100):
        tile = suffix_dedup.Tile(data[first:last], begin, end, 100)
        for at, n in zip(tile.at + first, tile.number):
            assert not found[at:at + n].any()
            found[at:at + n] = True
    assert len(data) > suffix_dedup.TILE and found.all()


# BPE --------------------------------------------------------------------------------------------------------------------

BPE_TEXTS = ODD + [
    "Hello, world's don't WE'LL 12345 abc<|endoftext|>def <|startoftext|>", "a\x1cb \x85c\xa0d e", "ΣΑΣ ΌΔΟΣ σς", "İstanbul DŽ ǅ",
    "é ́a ﬁ 한국어 각", "👩‍👩‍👧 ❤️ ½ ² ₂ Ⅷ", "<|endoftext|><|endoftext|>", "<|endoftext", "'s't 'RE 's",
    "a​b᠎c d﻿", "ß ẞ ŉ ΐ և", "ⅷ Ⓐ ⓐ 𝒜 𐐀",
]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_equals_the_library(docs, library):
    rows = [(i, t, "en", "a") for i, t in enumerate(BPE_TEXTS)] + [(None, "same", None, None)] * 2
    out = bpe.encode(docs(rows), out=("ids", "n_tokens", "decoded", "ids_sha256", "decoded_sha256"))
    for r in out.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == text
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    again = bpe.decode(out.drop("decoded"), "ids").select("ids", "decoded").collect()
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in again)
    assert bpe.encode(docs([])).count() == 0


def test_bpe_random_characters(library):
    random.seed(1)
    spans = ((32, 127), (0, 32), (0x80, 0x250), (0x300, 0x345), (0x370, 0x400), (0x900, 0x950), (0x1100, 0x1120), (0x1F00, 0x1FFF),
             (0x2000, 0x2070), (0x3040, 0x30A0), (0xAC00, 0xAC20), (0x1F600, 0x1F610))
    pool = [chr(c) for a, b in spans for c in range(a, b)]
    tokenizer = bpe.Tokenizer(bpe.read_definition())
    for _ in range(4000):
        text = "".join(random.choices(pool, k=random.randint(1, 12)))
        ids = list(bpe.unpacked(tokenizer.encode(text)))
        assert ids == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_bpe_memo_may_be_small(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 2)
    tokenizer = bpe.Tokenizer(bpe.read_definition())
    for text in [sentence(50, 1) + " 12, x!", "é, Ée É! 's"]:
        assert list(bpe.unpacked(tokenizer.encode(text))) == library.encode(text, add_special_tokens=False).ids


# SimHash ----------------------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(codes):
    """codes: list of (id, code). Component of each entry as the smallest id reachable."""
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(codes)):
        for b in range(a):
            if (codes[a][1] ^ codes[b][1]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    named = {}
    for k, (i, _) in enumerate(codes):
        named[find(k)] = min(x for x in (named.get(find(k)), i) if x is not None) if (i, named.get(find(k))) != (None, None) else None
    return [named[find(k)] for k in range(len(codes))]


def near_texts():
    out = list(ODD) + ["", "one", "ONE", "one two", "É one two three"]
    for n in range(30):
        base = sentence(200, n % 5)
        words = base.split()
        words[n] = "changed"
        out += [base, " ".join(words), base.upper() if n % 7 == 0 else base + "\n"]
    return out


def test_simhash_components(docs):
    texts = near_texts()
    rows = [(1000 - i, t, "en", "a") for i, t in enumerate(texts)] + [(None, texts[-1], None, None), (None, "alone again here now", None, None)]
    found = simhash.near_duplicates(docs(rows).repartition(3)).collect()
    assert len(found) == len(rows)
    codes = [(i, plain_fingerprint(t)) for i, t, _, _ in rows]
    want = sorted(map(repr, zip([i for i, _ in codes], [c for _, c in codes], plain_components(codes))))
    assert sorted(repr((r.doc_id, r.fingerprint % 2**64, r.component_id)) for r in found) == want
    assert simhash.near_duplicates(docs([])).count() == 0


def test_simhash_keeps_one(docs):
    texts = near_texts()
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)] + [(3, texts[3], "en", "a")] * 2
    table = docs(rows)
    out = simhash.keep_one(table)
    assert out.columns == table.columns
    component = plain_components([(i, plain_fingerprint(t)) for i, t, _, _ in rows])
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(component))
    assert simhash.keep_one(docs([])).count() == 0


def dense_codes(n, seed, spread=4):
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 2**63, size=max(1, n // 40), dtype=np.uint64)[rng.integers(0, max(1, n // 40), n)]
    for _ in range(spread):
        codes = codes ^ np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
    return np.unique(codes)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257, 1500])
def test_gray_index(n):
    codes = dense_codes(n, n)
    codes = codes[np.argsort(gray.gray_rank(codes))]
    got = gray.GrayIndex(codes).link(3)
    want = plain_components(list(enumerate(int(c) for c in codes))) if n < 300 else None
    if want is None:
        label = np.arange(len(codes))
        gray.unite(label, *np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3))
        want = gray._root(label, np.arange(len(codes)))
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_gray_rank_is_the_reflected_sequence():
    n = np.arange(256, dtype=np.uint64)
    assert (gray.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_large_groups_are_routed_again(spark):
    codes = dense_codes(600, 3).view(np.int64)
    table = spark.createDataFrame([(int(c),) for c in codes], "code bigint")
    results = []
    for group in (4, 10**6):
        roots = {r.node: r.root for r in graph.components(simhash.near_links(table, group=group)).collect()}
        results.append([roots.get(int(c), int(c)) for c in codes])
    assert results[0] == results[1]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 199), (199, 200), (300, 300)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 160)}, 199: 199, 200: 199}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Whole tables -----------------------------------------------------------------------------------------------------------

def test_whole_table(spark, library):
    from tabprep.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = kept_bytes({i: t.encode() for i, t in texts.items()})
    for r in QUERIES["op1_suffix_dedup"](spark, SMALL).collect():
        left, removed, spans = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(texts[r.doc_id].encode()), removed, spans)
        assert r.kept_sha256 == hashlib.sha256(left).hexdigest()
    for r in QUERIES["op2_bpe"](spark, SMALL).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.n_tokens == len(ids)
    codes = [(i, plain_fingerprint(texts[i])) for i in sorted(texts)]
    component = dict(zip(sorted(texts), plain_components(codes)))
    for r in QUERIES["op3_simhash"](spark, SMALL).collect():
        assert int(r.fingerprint, 16) == dict(codes)[r.doc_id] and r.component_id == component[r.doc_id] and len(r.fingerprint) == 16
