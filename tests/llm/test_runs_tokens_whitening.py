"""Periodic runs, byte-level BPE and whitening against brute force, the tokenizers library and numpy."""

import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest

from panelkit.llm import bpe, periodic
from panelkit.llm.bpe import decode_bpe, encode_bpe, encode_decode_bpe, load_byte_pairs
from panelkit.llm.periodic import find_runs, periodic_runs
from panelkit.llm.queries import BYTE_PAIRS_FILE, QUERIES
from panelkit.llm.whitening import fit_whitening, identity_error, leading_eigenvectors, whiten, whole_vectors

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")
needs_tokenizer = pytest.mark.skipif(not Path(BYTE_PAIRS_FILE).exists(), reason="tokenizer not present")
CLASHING = "doc_id long, text string, id long, runs int, n_words string, collapsed int, tokens string, decoded long"


def table(spark, data):
    return spark.createDataFrame([(i, t, 1, 2, "n", 3, "t", 4) for i, t in data], CLASHING).repartition(3)


def every_run(words, repeats=4):
    """All runs by trying every period: (begin, end, period)."""
    out, seen = [], set()
    for q in range(1, len(words) // repeats + 1):
        at = 0
        while at + q < len(words):
            if words[at] != words[at + q]:
                at += 1
                continue
            begin = at
            while at + q < len(words) and words[at] == words[at + q]:
                at += 1
            if at + q - begin >= repeats * q and (begin, at + q) not in seen:
                seen.add((begin, at + q))
                out.append((begin, at + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rnd):
    """Words with runs: nested, cut off, Fibonacci, of one word with marks, of two words at random, or hardly any."""
    kind = rnd.randrange(6)
    if kind == 0:
        return [rnd.randrange(2) for _ in range(rnd.randrange(80))]
    if kind == 1:
        return ([rnd.randrange(3) for _ in range(rnd.randrange(1, 40))] * rnd.randrange(1, 9))[rnd.randrange(5):] + [7]
    if kind == 2:
        a, b = [0], [0, 1]
        for _ in range(rnd.randrange(1, 11)):
            a, b = b, b + a
        return b
    if kind == 3:
        return ([0] * rnd.randrange(1, 30) + [1]) * rnd.randrange(1, 12)
    if kind == 4:
        parts = [[rnd.randrange(2) for _ in range(rnd.randrange(1, 12))] * rnd.randrange(1, 9) for _ in range(rnd.randrange(1, 6))]
        return sum(parts, []) * rnd.choice([1, 1, 4, 5])
    return [rnd.randrange(1000) for _ in range(rnd.randrange(60))]


def test_find_runs_against_every_period():
    rnd, total = random.Random(5), 0
    for _ in range(500):
        texts = [some_words(rnd) for _ in range(rnd.randrange(1, 6))]
        first = np.cumsum([0] + [len(t) for t in texts])
        expected = [(a + int(first[k]), b + int(first[k]), q) for k, t in enumerate(texts) for a, b, q in every_run(t)]
        got = [tuple(r) for r in find_runs(np.array(sum(texts, []), dtype=np.int64), first).tolist()]
        assert got == sorted(expected, key=lambda r: (r[0], r[2])), texts
        total += len(got)
    assert total > 3000


def test_words_with_equal_first_hash_stay_apart(monkeypatch):
    data = np.frombuffer(b"a b a c", dtype=np.uint8)
    starts = np.array([0, 2, 4, 6])
    real = periodic.hash_words
    monkeypatch.setattr(periodic, "hash_words", lambda d, a, b, seed: real(d, a, b, seed) if seed else np.zeros(len(a), np.uint64))
    one, two, again, three = periodic.number_words(data, starts, starts + 1).tolist()
    assert one == again and len({one, two, three}) == 3


def test_selection_depends_on_the_context_alone():
    rnd, scale = random.Random(8), 4
    words = [rnd.randrange(3) for _ in range(600)]
    hashes = np.array([hash(tuple(words[k:k + scale])) % (1 << 62) for k in range(len(words) - scale + 1)], dtype=np.uint64)
    chosen = set(periodic.synchronising(hashes, scale).tolist())
    by_context = {}
    for k in range(len(words) - 2 * scale + 1):
        by_context.setdefault(tuple(words[k:k + 2 * scale]), set()).add(k in chosen)
    assert all(len(v) == 1 for v in by_context.values())
    assert all(chosen & set(range(k, k + scale)) for k in range(len(hashes) - 2 * scale))


def collapsed(words, runs):
    gone = {k for a, b, q in runs for k in range(a + q, b)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def test_periodic_runs(spark):
    rnd = random.Random(6)
    data = [(None, "a a a a a a"), (None, None), (1, ""), (1, " \t\n"), (2, "x " * 5000), (2, "x " * 5000), (3, "é\n漢  é 漢 é 漢 é 漢 b"),
            (4, "a b " * 3 + "a b"), (5, "a a a a a"), (6, "a b a b " * 4)]
    data += [(10 + k, rnd.choice([" ", "  ", "\n"]).join(f"w{x}" for x in some_words(rnd))) for k in range(80)]
    expected = []
    for i, text in data:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = [r for r in every_run(words) if r[1] - r[0] >= 6] if len(words) < 4000 else [(0, 5000, 1)]
        expected.append((i, len(words), tuple((a, b - a, q) for a, b, q in runs), collapsed(words, runs)))
    got = [(r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in periodic_runs(table(spark, data)).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert periodic_runs(table(spark, data).limit(0)).collect() == []


@needs_tables
def test_periodic_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    found = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:  # too long to try every period
            continue
        runs = [r for r in every_run(words) if r[1] - r[0] >= 6]
        best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
        told = got[doc_id]
        assert told.n_runs == len(runs)
        assert (told.start, told.length, told.period) == ((best[0], best[1] - best[0], best[2]) if best else (None, None, None))
        assert told.exponent_milli == (1000 * (best[1] - best[0]) // best[2] if best else None)
        assert told.runs_sha256 == hashlib.sha256("".join(f"{a},{b - a},{q}\n" for a, b, q in runs).encode()).hexdigest()
        assert told.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        found += len(runs)
    assert found > 5


@pytest.fixture(scope="module")
def vocabulary():
    return load_byte_pairs(BYTE_PAIRS_FILE)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BYTE_PAIRS_FILE)


def odd_texts(n):
    rnd = random.Random(2)
    parts = ["a", "b", "s", "t", "re", "ve", "ll", "d", "m", "'", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "1", "2", "½", "é", "漢", "字",
             "!", "?", "<", "<|endoftext|>", "<|endof", "text|>", "\U0001c89a", "ᲊ", "😀", "the", " the", "'s", "​", "﻿", "\x00"]
    out = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(40))) for _ in range(n)]
    point = lambda: rnd.choice([rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000)])
    return out + ["".join(chr(point()) for _ in range(30)) for _ in range(n // 5)]


@needs_tokenizer
def test_bpe_equals_the_library(spark, vocabulary, library):
    data = list(enumerate(odd_texts(1500))) + [(None, "no id"), (None, None), (3, ""), (3, ""), (4, "word " * 30000), (5, "ab" * 20000), (6, " " * 5000)]
    rows = table(spark, data)
    expected = [(i, None, None) if t is None else (i, tuple(library.encode(t, add_special_tokens=False).ids), t) for i, t in data]
    got = [(r.doc_id, None if r.tokens is None else tuple(r.tokens), r.decoded) for r in encode_decode_bpe(rows, vocabulary).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ())
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert encode_decode_bpe(rows.limit(0), vocabulary).collect() == []
    there_and_back = decode_bpe(encode_bpe(rows, vocabulary, out_col="ids"), vocabulary, "ids", "again")
    assert there_and_back.filter("not (again <=> text)").count() == 0 and there_and_back.columns == [*rows.columns, "ids", "again"]
    with pytest.raises(ValueError):
        encode_bpe(rows, vocabulary)


@needs_tokenizer
def test_decoding_any_ids(spark, vocabulary, library):
    rnd = random.Random(3)
    data = [(k, [rnd.randrange(50257) for _ in range(rnd.randrange(12))]) for k in range(300)] + [(1000, None), (1001, [])]
    got = {r.id: r.decoded for r in decode_bpe(spark.createDataFrame(data, "id long, tokens array<int>"), vocabulary).collect()}
    assert got == {k: None if ids is None else library.decode(ids, skip_special_tokens=False) for k, ids in data}


@needs_tokenizer
def test_classes_of_all_code_points_are_the_library_s(vocabulary):
    from tokenizers import pre_tokenizers
    splitter = pre_tokenizers.ByteLevel(add_prefix_space=False)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 1 << 15):
        part = points[k:k + (1 << 15)]
        told = np.full(len(part), bpe.SPACE)
        for before, kind in (("a", bpe.LETTER), ("1", bpe.NUMBER), ("!", bpe.OTHER)):
            starts = {span[0] for _, span in splitter.pre_tokenize_str("".join(f"{before}{chr(c)}\n" for c in part))}
            told[[3 * j + 1 not in starts for j in range(len(part))]] = kind
        assert (vocabulary.kinds[part] == told).all()


@needs_tokenizer
def test_cuts_are_certain(vocabulary):
    """No token holds a cut pair, and merging a text with its cuts or without gives the same ids."""
    rnd = random.Random(9)
    for token in vocabulary.spelling:
        assert token in vocabulary.added or all(vocabulary.inside[a, b] for a, b in zip(token, token[1:]))
    for _ in range(300):
        text = b"".join(rnd.choice(vocabulary.spelling[:50256]) for _ in range(rnd.randrange(1, 20)))
        cuts = [0] + [k for k in range(1, len(text)) if not vocabulary.inside[text[k - 1], text[k]]] + [len(text)]
        parts = [bpe.merged(text[a:b], vocabulary.merges, vocabulary.byte_ids) for a, b in zip(cuts[:-1], cuts[1:])]
        assert sum(parts, []) == bpe.merged(text, vocabulary.merges, vocabulary.byte_ids)


@needs_tokenizer
@pytest.mark.parametrize("longest", [0, 5, 48, 10 ** 6])
def test_merging_many_at_once(vocabulary, longest):
    rnd = random.Random(longest)
    parts = [b"".join(rnd.choice([b"ab", b"the", b" ", b"zq", bytes([rnd.randrange(256)])]) for _ in range(rnd.randrange(1, 40))) for _ in range(400)]
    parts += [b"a" * 60, b"ab" * 40, b"x", b"\xff", b" the"]
    merger = bpe.Merger(*vocabulary.arrays())
    merger.LONGEST = longest
    sizes = np.array([len(p) for p in parts])
    ids, counts = merger(np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes)
    expected = [bpe.merged(p, vocabulary.merges, vocabulary.byte_ids) for p in parts]
    assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == sum(expected, [])


@needs_tokenizer
def test_a_full_memory_starts_anew(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 500)
    encoder = bpe.Encoder(*vocabulary.arrays(), vocabulary.added, vocabulary.inside, vocabulary.kinds)
    for text in odd_texts(60):
        ids, first = encoder.encode(np.frombuffer(text.encode(), dtype=np.uint8), np.array([0, len(text.encode())]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and first.tolist() == [0, len(ids)]


@needs_tables
@needs_tokenizer
def test_bpe_query(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op12_bpe"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


class Matrix:
    def __init__(self, entries):
        self.entries, self.size, self.passes = (entries + entries.T) / 2, len(entries), 0

    def __matmul__(self, block):
        self.passes += 1
        return self.entries @ block


def matrices():
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.normal(size=(128, 128)))[0]
    q = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    b, r, wide = rng.normal(size=(300, 64)), rng.normal(size=(5, 64)), rng.normal(size=(900, 400)) * np.linspace(1, 30, 400)
    return {"random": b.T @ b, "rank 5": r.T @ r, "all equal": np.eye(64) * 7, "zero": np.zeros((16, 16)), "one": np.array([[3.0]]), "wide": wide.T @ wide / 900,
            "close": turn @ np.diag(np.r_[[10, 10, 10, 9.9999, 9.9999, 5, 5, 5, 5 - 1e-9], np.linspace(4.9, 0, 119)]) @ turn.T,
            "steep": q @ np.diag(4.0 ** -np.arange(64)) @ q.T}


@pytest.mark.parametrize("name", sorted(matrices()))
def test_leading_eigenvectors(name):
    matrix = Matrix(matrices()[name])
    values, found = leading_eigenvectors(matrix, 8)
    expected = np.linalg.eigvalsh(matrix.entries)[::-1][:8]
    rank = {"rank 5": 5, "zero": 0, "one": 1}.get(name)
    top = max(float(expected[0]), 1e-300)
    assert len(values) == (8 if rank is None else rank)
    assert np.abs(values - expected[:len(values)]).max(initial=0) < 1e-13 * top
    assert np.linalg.norm(matrix.entries @ found - found * values, axis=0).max(initial=0) < 1e-13 * top
    assert np.abs(found.T @ found - np.eye(len(values))).max(initial=0) < 1e-13
    assert matrix.passes < 150


VECTORS = "vec_id long, embedding array<float>, label int, id int, x string, component string"


def vector_rows(n, width, seed=1):
    rng = np.random.default_rng(seed)
    return [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(rng.normal(size=(n, width)) * np.linspace(0.05, 0.4, width) + 0.1)]


def vector_table(spark, data):
    return spark.createDataFrame([(i, v, 1, 2, "x", "c") for i, v in data], VECTORS).repartition(3)


def test_whitening(spark):
    good = vector_rows(400, 24) + [(7, [0.25] * 24), (7, [0.25] * 24), (None, [0.0] * 24)]
    bad = [(900, None), (901, []), (902, [None] + [0.1] * 23), (903, [float("nan")] + [0.1] * 23), (904, [float("-inf")] + [0.1] * 23), (905, [0.1] * 23)]
    vectors = whole_vectors(vector_table(spark, good + bad))
    model = fit_whitening(vectors, 8)
    x = np.floor(np.array([v for _, v in good]) * 1024).astype(np.int64) + 100000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    assert model.n == n and model.sums == sums.tolist() and abs(model.trace - np.trace(cov)) < 1e-9 * model.trace
    assert np.abs(model.values / e - 1).max() < 1e-12 and np.abs(np.abs((u * model.vectors).sum(axis=0)) - 1).max() < 1e-12
    assert identity_error(vectors, model) < 1e-11
    rows = whiten(vectors, model).collect()
    assert len(rows) == 8 * n
    signs = np.sign((u * model.vectors).sum(axis=0))
    expected = {}
    for (i, _), v, c in zip(good, x, centred):
        told = sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums))
        for k in range(8):
            expected.setdefault((i, k + 1), []).append((told, c @ u[:, k] / math.sqrt(e[k]) * signs[k]))
    for r in rows:
        assert any(int(r.deviation) == d and abs(r.whitened - w) < 1e-10 for d, w in expected[r.id, r.component])


@pytest.mark.parametrize("data, rank", [([], 0), ([(1, None), (2, [])], 0), ([(1, [0.5, 0.25])], 0), ([(1, [0.5, 0.25])] * 4, 0),
                                        ([(1, [0.5, 0.25]), (2, [0.5, 0.75])], 1), ([(1, [0.1]), (2, [0.9]), (3, [0.4])], 1),
                                        ([(k, [k / 8, 1.0, (k % 3) / 4]) for k in range(9)], 2)])
def test_whitening_of_few_or_equal_vectors(spark, data, rank):
    vectors = whole_vectors(vector_table(spark, data) if data else vector_table(spark, [(1, [1.0])]).limit(0))
    model = fit_whitening(vectors, 8)
    rows = whiten(vectors, model).collect()
    assert len(model.values) == rank and len(rows) == rank * sum(bool(v) for _, v in data)
    assert identity_error(vectors, model) < 1e-12


def test_deviations_beyond_64_bits(spark):
    data = [(1, [1e8, 0.0]), (2, [-1e8, 0.0]), (3, [3e8, 1.0])]
    vectors = whole_vectors(vector_table(spark, data))
    model = fit_whitening(vectors, 2)
    x = [[math.floor(float(np.float32(c)) * 1024) + 100000 for c in v] for _, v in data]
    sums = [sum(c) for c in zip(*x)]
    expected = {i: sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for (i, _), v in zip(data, x)}
    assert {r.id: int(r.deviation) for r in whiten(vectors, model).collect()} == expected


@needs_tables
def test_whitening_query(spark):
    rows = QUERIES["op13_whitening"](spark, SF_DIR).collect()
    read = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    fits = {r.vec_id: r.embedding for r in read if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)}
    assert len(rows) == 8 * len(fits) and {r.n for r in rows} == {len(fits)}
    ids = sorted(fits)
    x = np.floor(np.array([fits[i] for i in ids]) * 1024).astype(np.int64) + 100000
    centred = (len(ids) * x - x.sum(axis=0)) / len(ids)
    e, u = np.linalg.eigh(centred.T @ centred / len(ids))
    expected = centred @ u[:, ::-1][:, :8] / np.sqrt(e[::-1][:8])
    got = np.zeros_like(expected)
    for r in rows:
        got[ids.index(r.vec_id), r.component - 1] = r.whitened
        assert abs(r.explained / (e[::-1][r.component - 1] / e.sum()) - 1) < 1e-9 and r.identity_error < 1e-9
    assert np.abs(got * np.sign((got * expected).sum(axis=0)) - expected).max() < 1e-8
