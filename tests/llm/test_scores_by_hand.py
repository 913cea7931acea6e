"""Scores, evidence, bins and likeness recomputed in plain Python for some fifty texts."""

import collections
import math
import random

import numpy as np
import pytest
import xxhash

from panelkit.llm import fingerprints as prints
from panelkit.llm.fingerprints import fingerprints
from panelkit.llm.langid import ADDED, predict_language, train_language_model
from panelkit.llm.subwords import Grams
from panelkit.llm.toxicity import score_toxicity, train_toxicity_model
from panelkit.llm.words import hash_words, mix

WORDS = {"aa": ["der", "und", "nicht", "Straße", "über", "Wort"], "bb": ["the", "and", "not", "street", "OVER", "word"], "cc": ["el", "niño", "y", "calle", "sobre", "palabra"]}


def texts(seed=3, n=48):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        lang = "abc"[k % 3] * 2
        words = [rnd.choice(WORDS[lang]) for _ in range(rnd.randrange(1, 40))]
        out.append((k, rnd.choice([" ", ", ", " 12 ", "\n"]).join(words), lang))
    return out + [(100, "", "aa"), (101, None, "aa"), (102, "漢字 かな", "bb"), (103, "42 — !", "bb"), (104, "der der der the", "aa"), (104, "der der der the", "aa")]


def letter_words(text):
    """Runs of ASCII letters and non-ASCII bytes of the lower-cased text."""
    out, now = [], b""
    for byte in (text or "").lower().encode():
        if 0x61 <= byte <= 0x7A or byte >= 0x80:
            now += bytes([byte])
        elif now:
            out.append(now)
            now = b""
    return out + ([now] if now else [])


def one_hash(word, seed):
    data = np.frombuffer(word, dtype=np.uint8)
    return int(hash_words(data, np.array([0]), np.array([len(word)]), seed)[0])


def buckets_of(word, grams):
    """Buckets of the n-grams of a marked word, and of the whole word; the hash functions are the library's."""
    marked, out = b"<" + word + b">", [one_hash(word, 7) >> (64 - grams.bits)]
    for size in grams.sizes:
        for k in range(len(marked) - size + 1):
            value = int.from_bytes(marked[k:k + size], "little") + (size << 56)
            out.append(int(mix(np.array([value], dtype=np.uint64))[0]) >> (64 - grams.bits))
    return out


def test_language_scores(spark):
    data = texts()
    docs = spark.createDataFrame([(i, t, lang, 9) for i, t, lang in data], "doc_id long, text string, lang string, score int").repartition(3)
    grams = Grams(sizes=(2, 3), bits=12)
    model = train_language_model(docs, per_language=50, grams=grams, epochs=3)
    got = collections.defaultdict(list)
    for r in predict_language(docs, model).collect():
        got[r.doc_id].append((r.lang_pred, r.score, r.accepted))
    for i, text, _ in data:
        sums, known, n = [0.0] * len(model.languages), 0.0, 0
        for word in letter_words(text):
            for b in buckets_of(word, grams):
                sums = [s + float(w) for s, w in zip(sums, model.weights[b])]
                known += float(model.known[b])
                n += 1
        margins = [(s / max(n, 1) + float(c)) / model.temperature for s, c in zip(sums, model.bias)]
        top = max(margins)
        shares = [math.exp(m - top) for m in margins]
        score = max(shares) / sum(shares)
        evidence = (known + ADDED * model.usual) / (n + ADDED)
        expected = (model.languages[shares.index(max(shares))], score, score >= model.threshold and evidence >= model.floor)
        if not any(c.isalpha() for c in text or ""):
            expected = ("und", 0.0, False)
        for told in got[i]:
            assert told[0] == expected[0] and told[1] == pytest.approx(expected[1], abs=1e-5) and told[2] == expected[2], (i, text)
    assert len(got[104]) == 2


def test_language_evidence_of_the_sample(spark):
    """Shares of documents by language and n-gram, the best of them, and the sample's own evidence without each document."""
    from panelkit.llm.langid import DOUBT, RARE, _shares
    rnd = np.random.default_rng(4)
    label = np.array([0, 0, 1, 1, 1, 2])
    rows = [np.sort(rnd.choice(20, size=rnd.integers(1, 12), replace=False)).astype(np.int32) for _ in label]
    counts = [rnd.integers(1, 5, len(r)).astype(np.float32) for r in rows]
    first = np.cumsum([0] + [len(r) for r in rows])
    known, total, mean = _shares(np.concatenate(rows), np.concatenate(counts), first, label, 3, 20)
    sizes = [sum(label == k) + DOUBT for k in range(3)]
    seen = [[sum(b in set(r.tolist()) for r, k in zip(rows, label) if k == lang) for b in range(20)] for lang in range(3)]
    for b in range(20):
        assert known[b] == pytest.approx(math.log2(max(seen[k][b] / sizes[k] for k in range(3)) + RARE))
    for i, (r, c) in enumerate(zip(rows, counts)):
        own = [math.log2(max((seen[k][b] - (k == label[i])) / (sizes[k] - (k == label[i])) for k in range(3)) + RARE) for b in r.tolist()]
        assert total[i] == c.sum() and mean[i] == pytest.approx(float((np.array(own) * c).sum() / c.sum()))


def test_toxicity_scores(spark):
    data = texts(5)
    docs = spark.createDataFrame([(i, t, 7) for i, t, _ in data], "doc_id long, text string, predicted int").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _, _ in data], "doc_id long, toxic int")
    grams = Grams(sizes=(3, 4), bits=13, once=True)
    model = train_toxicity_model(docs, labels, per_class=40, grams=grams, epochs=3)
    got = collections.defaultdict(list)
    for r in score_toxicity(docs, model).collect():
        got[r.doc_id].append((r.score, r.predicted))
    for i, text, _ in data:
        held = {b for word in set(letter_words(text)) for b in buckets_of(word, grams)}
        margin = model.bias + sum(float(model.weights[b]) for b in held)
        score = 1 / (1 + math.exp(-max(min(margin, 30), -30)))
        for told, predicted in got[i]:
            assert told == pytest.approx(score, abs=1e-6) and predicted == int(told >= 0.5)


# ---- fingerprints ----
MASK = (1 << 64) - 1


def long_hash(value, seed):
    return xxhash.xxh64_intdigest((value & MASK).to_bytes(8, "little"), seed)


def shingle_hashes(text):
    """Chained XXH64 of words as the built-in function makes them: of a text's bytes, and of several numbers one after the other."""
    words = [w for w in "".join(" " if c in prints.SPACES else c for c in (text or "").strip(prints.SPACES)).split(" ") if w] or [""]
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    pairs = lambda a, b: [long_hash(y, long_hash(x, 42)) for x, y in zip(a, b)]
    if len(hashes) >= prints.SHINGLE:
        two = pairs(hashes[:-1], hashes[1:])
        four = pairs(two[:-2], two[2:])
        return pairs(four, hashes[4:])
    chained = 42
    for h in hashes:
        chained = long_hash(h, chained)
    return [chained]


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def bins_of(text):
    width = prints.BINS.bit_length() - 1
    least = {}
    for h in shingle_hashes(text):
        b = h >> (64 - width)
        least[b] = min(least.get(b, signed(h)), signed(h))
    out = []
    for b in range(prints.BINS):
        if b in least:
            low = least[b]
        else:
            drawn = next((prints.draw(b, n) for n in range(prints.DRAWS) if prints.draw(b, n) in least), None)
            # the built-in hash of an int and a long
            order = lambda t: signed(long_hash(t, xxhash.xxh64_intdigest(b.to_bytes(4, "little"), 42)))
            low = least[drawn] if drawn is not None else least[min(least, key=order)]
        out.append(low & 0xFF)
    return out


def alike(a, b):
    same = sum(x == y for x, y in zip(a, b)) / prints.BINS
    return max((same - 2.0 ** -prints.BITS) / (1 - 2.0 ** -prints.BITS), 0.0)


def test_fingerprint_bins_and_likeness(spark):
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(400)]
    data = ["", " \t\n", "one", "one two three four", "one  two\tthree four five", None, " ".join(base), " ".join(base[:200] + ["x"] + base[200:])]
    data += [" ".join(rnd.choice(base) for _ in range(rnd.randrange(1, 300))) for _ in range(42)]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(data)], "doc_id long, text string, bins int").repartition(4)
    got = {r.doc_id: r for r in fingerprints(docs).collect()}
    for k, text in enumerate(data):
        text, after = text or "", data[(k + 1) % len(data)] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, other = bins_of(text), bins_of(edited)
        r = got[k]
        assert r.edited == edited and r.fingerprint == "".join(f"{b:02x}" for b in own) and r.edited_fingerprint == "".join(f"{b:02x}" for b in other), k
        assert r.near_edited == pytest.approx(alike(own, other)) and r.near_next == pytest.approx(alike(own, bins_of(after)))
