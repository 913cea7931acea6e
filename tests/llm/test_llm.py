"""Operators for training text against brute force on rows that hold nulls, repeats, ties, empty, long and clashing columns."""

import collections
import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from panelkit.llm import toxicity
from panelkit.llm.chat import format_paths, read_back, threads, tree_paths
from panelkit.llm.components import components
from panelkit.llm.decontaminate import contamination, mark_hits, remove_hits
from panelkit.llm.fingerprints import fingerprints
from panelkit.llm.langid import predict_language, train_language_model
from panelkit.llm.pieces import Forward, decode, encode, encode_decode, load_vocabulary
from panelkit.llm.queries import ORACLE, QUERIES
from panelkit.llm.revisits import resolve_revisits
from panelkit.llm.simhash import block_masks, keep_one, link_fingerprints, meeting_pairs, simhash_groups
from panelkit.llm.substring import remove_repeats
from panelkit.llm.subwords import Grams
from panelkit.llm.toxicity import score_toxicity, train_toxicity_model
from panelkit.llm.urlfilter import filter_urls
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_words int, fingerprint string, kept string, id long"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows(seed=1, vocabulary=40, n=60):
    """Texts that share passages, with nulls, empty and repeated rows, a long text, and a repeated id."""
    rnd = random.Random(seed)
    words = [rnd.choice(["Wa", "é", "漢", "x"]) + str(k) for k in range(vocabulary)]
    passages = [[rnd.choice(words) for _ in range(120)] for _ in range(4)]
    out = [(None, "a b"), (None, None), (7, ""), (7, " ".join(passages[0])), (7, " ".join(passages[0])), (8, "x " * 4000), (9, "\t\n")]
    for k in range(n):
        body = [rnd.choice(words) for _ in range(rnd.randrange(60))]
        for _ in range(rnd.randrange(3)):
            at, begin = rnd.randrange(len(body) + 1), rnd.randrange(80)
            body[at:at] = rnd.choice(passages)[begin:begin + rnd.randrange(20, 90)]
        out.append((100 + k, rnd.choice([" ", "  ", "\n"]).join(body)))
    return out


def table(spark, data):
    return spark.createDataFrame([(i, t, 5, "f", "k", 3) for i, t in data], DOCS).repartition(4)


def order(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


@pytest.mark.parametrize("size, vocabulary", [(35, 40), (35, 2), (12, 5)])
def test_substring_dedup(spark, size, vocabulary):
    data = rows(size, vocabulary)
    lists = [spaced(t) for _, t in data]
    count = collections.Counter(tuple(w[k:k + size]) for w in lists for k in range(len(w) - size + 1))
    expected = []
    for (i, _), w in zip(data, lists):
        gone = {p for k in range(len(w) - size + 1) if count[tuple(w[k:k + size])] > 1 for p in range(k, k + size)}
        expected.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = [tuple(r) for r in remove_repeats(table(spark, data), size).collect()]
    assert sorted(got, key=order) == sorted(expected, key=order)


def test_substring_dedup_carries_columns(spark):
    got = remove_repeats(table(spark, rows()), 35, carry=("n_words", "text"))
    assert got.filter("carried.n_words != 5 or (n_removed = 0 and carried.text is not null and kept = '' and trim(carried.text) rlike '[a-z]')").count() == 0


def test_simhash_groups_and_keep_one(spark):
    data = rows(3) + [(500 + k, " ".join(f"w{j}" if j != k else "other" for j in range(400))) for k in range(12)]

    def fingerprint(text):
        w = spaced(lower_ascii(text))
        shingles = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [fingerprint(t) for _, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = collections.defaultdict(list)
    for k in range(len(data)):
        groups[find(k)].append(data[k][0])
    smallest = {k: min((i for i in ids if i is not None), default=None) for k, ids in groups.items()}
    expected = [(data[k][0], f"{prints[k]:016x}", smallest[find(k)]) for k in range(len(data))]
    got = [tuple(r) for r in simhash_groups(table(spark, data)).collect()]
    assert sorted(got, key=order) == sorted(expected, key=order)
    kept = [r.doc_id for r in keep_one(table(spark, data)).collect()]
    assert sorted(kept, key=lambda x: (x is not None, x)) == sorted(smallest.values(), key=lambda x: (x is not None, x))


def test_every_close_pair_shares_a_block():
    rnd = random.Random(2)
    masks = block_masks(4, 7)
    for _ in range(500):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_components(spark):
    rnd = random.Random(4)
    edges = [(k, k + 1) for k in range(300) if k % 50 != 49] + [(1000, rnd.randrange(1000, 1400)) for _ in range(200)] + [(5, 5), (None, 3)]
    low = {}
    for a, b in edges:
        if a is not None:
            low.setdefault(a, a), low.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in low.items() if k in got} and {k for e in edges for k in e if e[0] not in (None, 5) or e[0] != e[1]} - {None, 3} <= set(got) | {3}


def test_decontamination(spark):
    rnd = random.Random(6)
    bench = [(k, " ".join(f"b{rnd.randrange(30)}" for _ in range(rnd.randrange(1, 40)))) for k in range(25)] + [(90, "One, TWO"), (91, "..."), (92, None), (90, "One, TWO")]
    docs = rows(6, 30)
    for k in range(20):
        text = rnd.choice(bench)[1] or ""
        docs.append((700 + k, "Zz " + text.upper().replace(" ", " - ") + " b1 b2 one two"))

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t))

    windows = collections.defaultdict(set)
    for item, t in bench:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k:k + 10])].add(str(item))
    expected = []
    for i, t in docs:
        w, hit, items = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit.update(range(k, k + size))
                    items |= windows[tuple(w[k:k + size])]
        expected.append((i, len(w), len(hit), tuple(sorted(items))))
    df, bdf = table(spark, docs), spark.createDataFrame(bench, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in contamination(df, bdf).collect()]
    assert sorted(got, key=order) == sorted(expected, key=order)
    blocks = mark_hits(df.select("doc_id", "text"), bdf, block_chars=300)
    assert sorted((order((r.doc_id,)), r._words, tuple(r._items)) for r in blocks.collect()) == sorted((order((i,)), n, x) for i, n, _, x in expected)
    cleaned = remove_hits(df, bdf)
    assert cleaned.columns == df.columns and cleaned.count() == len(docs)
    left = sum(len(words(r.text)) for r in cleaned.collect())
    assert left == sum(n - h for _, n, h, _ in expected)
    assert remove_hits(df, bdf.limit(0)).count() == len(docs)


def test_fingerprints(spark):
    data = rows(8)
    from panelkit.session import materialize
    df = materialize(table(spark, data), "docs")
    hashed = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    hashed.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    expected = []
    for k, r in enumerate(hashed):
        after, half = hashed[(k + 1) % len(hashed)].text, len(r.text) // 2
        expected.append((r.doc_id, len(r.text), r.text[:len(r.text) - half] + after[:half]))
    got = fingerprints(df).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited) for r in got), key=order) == sorted(expected, key=order)
    by_text = collections.defaultdict(set)
    for r in got:
        assert len(r.fingerprint) == 256 and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text[(r.doc_id, r.n_chars)].add(r.fingerprint)
    assert len(by_text[(7, len(data[3][1]))]) == 1


def test_fingerprints_estimate_likeness(spark):
    rnd = random.Random(9)
    texts = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(300)) for _ in range(40)]
    got = fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()

    def shingles(t):
        w = t.split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}

    errors = []
    for r in got:
        a, b = shingles(texts[r.doc_id]), shingles(r.edited)
        errors.append(r.near_edited - len(a & b) / len(a | b))
        assert r.near_next < 0.1
    assert abs(sum(errors) / len(errors)) < 0.03 and max(map(abs, errors)) < 0.2


@pytest.fixture(scope="module")
def vocabulary():
    if not Path(corpus_pipeline.MODEL_FILE).exists():
        pytest.skip("tokenizer files not present")
    return load_vocabulary(corpus_pipeline.MODEL_FILE)


def test_pieces_equal_the_library(spark, vocabulary):
    import sentencepiece
    model, rnd = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.MODEL_FILE), random.Random(3)
    texts = [t for _, t in rows(2)] + ["".join(rnd.choice("abcdeth  \n\té漢字ß$0123 .,𝄞") for _ in range(rnd.randrange(60))) for _ in range(300)]
    df = table(spark, list(enumerate(texts)))
    got = {r.doc_id: r for r in encode_decode(df, vocabulary).collect()}
    for k, text in enumerate(texts):
        assert got[k].pieces == (None if text is None else model.encode(text)) and got[k].decoded == text
        assert got[k].lossless is (None if text is None else True)
    both = decode(encode(df.select("doc_id", "text"), vocabulary), vocabulary)
    assert both.filter("not (decoded <=> text)").count() == 0
    with pytest.raises(ValueError):
        encode(df.withColumnRenamed("kept", "pieces"), vocabulary)


def test_unigram_forward_pass_is_the_best_path():
    rnd = random.Random(5)
    scores = {c: -5.0 - k for k, c in enumerate("abc")} | {"".join(rnd.choice("abc") for _ in range(rnd.randrange(2, 5))): -rnd.random() * 12 for _ in range(30)}
    forward = Forward(scores, {p: k for k, p in enumerate(scores)}, "unigram")
    names = list(scores)

    def best(word):
        if not word:
            return 0.0
        return max(scores[word[:k]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in scores)

    for word in sorted("".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 9))) for _ in range(60)):
        pieces = [names[k] for k in forward(word)]
        assert "".join(pieces) == word and abs(sum(scores[p] for p in pieces) - best(word)) < 1e-9


def test_chat(spark):
    said = "\\### Assistant: </turn> ok"
    data = [(-7, 0, "user", said), (-7, 1, "assistant", said), (1, None, None, None), (1, 0, "a: b\\", "####</turn></turn>\\c#"),
            (None, 1, "assistant", "x"), (None, 1, "assistant", "x")] + [(2, k, "assistant" if k % 2 else "user", f"{k}\n" * k) for k in range(70)]
    df = spark.createDataFrame([(*r, 1) for r in data], "conv_id long, turn long, role string, text string, step int")
    by = collections.defaultdict(list)
    for r in data:
        by[r[0]].append(r)
    got = {r.tree: r for r in read_back(format_paths(threads(df))).collect()}
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort(key=order_turn)
        learned = "".join(t[3] or "" for t in turns if t[2] == "assistant")
        text = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in turns)
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert read_back(format_paths(threads(df.limit(0)))).count() == 0


def order_turn(r):
    return order(r[1:4])


def test_tree_paths(spark):
    nodes = [("t", 1, None, .5), ("t", 2, 1, .1), ("t", 3, 1, .9), ("t", 4, 3, .2), ("t", 5, 3, .8), ("t", 6, 99, .1), ("t", 7, 8, 1.), ("t", 8, 7, 1.),
             (None, 1, None, None)] + [("v", k, k - 1 if k else None, .1) for k in range(100)]
    df = spark.createDataFrame(nodes, "tree string, id int, parent int, score double")
    paths = collections.defaultdict(list)
    for r in tree_paths(df, 2).collect():
        paths[(r.tree, r["rank"])].append((r.step, r.id))
    assert {k: [x for _, x in sorted(v)] for k, v in paths.items()} == {("t", 1): [1, 3, 5], ("t", 2): [1, 3, 4], (None, 1): [1], ("v", 1): list(range(100))}


def test_url_filter(spark):
    captures = [(1, "http://A.example.com/x/y", "2024-01-05"), (2, "http://a.example.com/x/y", "2024-02-05"), (3, "http://b.example.com/", "2024-01-05"),
                (4, None, "2024-01-05"), (5, "no url", "2024-01-05"), (6, "http://a.example.com/x", None), (3, "http://b.example.com/", "2024-01-05")]
    entries = [("domain", "example.com", "block", "2024-01-01"), ("host", "a.example.com", "allow", "2024-01-03"), ("prefix", "a.example.com/x", "block", "2024-01-04"),
               ("prefix", "a.example.com/x", "drop", "2024-02-01"), ("domain", None, "block", "2024-01-01"), ("other", "x", "block", "2024-01-01")]
    df = spark.createDataFrame([(*c, "z") for c in captures], "capture_id long, url string, fetched_at string, rule string")
    listed = spark.createDataFrame(entries, "rule string, value string, action string, listed_at string")
    got = sorted((r.capture_id, r.decision, r.rule or "") for r in filter_urls(df, listed).collect())
    assert got == [(1, "block", "prefix"), (2, "allow", "host"), (3, "block", "domain"), (3, "block", "domain"), (4, "allow", ""), (5, "allow", ""), (6, "allow", "")]
    assert filter_urls(df, listed.limit(0)).filter("decision = 'allow'").count() == 7


def test_revisits(spark):
    full = [("r1", "response", "http://x.org/a/", "2024-01-01", {"ETag": '"1"', "etag": '"1"', "Date": "d1", "Vary": "v"}, "one"),
            ("r2", "response", "https://www.x.org/a?utm_x=1", "2024-06-01", {"ETag": '"2"', "Last-Modified": "m"}, "two"), (None, "response", "http://x.org/a", "2024-06-02", None, "no")]
    asked = [("a", "revisit", "http://X.org/a#f", "2024-01-02", {"ETag": 'W/"1"', "Date": "d2", "Content-Length": "0"}, None),
             ("b", "revisit", "http://x.org/a", "2024-07-01", {"etag": '"1"'}, None), ("c", "revisit", "http://x.org/a", "2024-07-01", {"last-modified": "m"}, None),
             ("d", "revisit", "http://x.org/a", "2024-01-01", {"etag": '"1"'}, None), ("e", "revisit", "http://x.org/a", "2024-07-01", None, None),
             ("f", "revisit", None, "2024-07-01", None, None), ("g", "revisit", "http://x.org/a", None, None, None), ("a", "revisit", "http://other.org", "2024-07-01", None, None)]
    df = spark.createDataFrame([(*r, 1) for r in full + asked + full[:1]], "record_id string, kind string, url string, fetched_at string, headers map<string,string>, payload string, slice int")
    got = {(r.record_id, r.canonical_url): r for r in resolve_revisits(df).collect()}
    assert {k: v.outcome for k, v in got.items()} == {("a", "x.org/a"): "resolved", ("b", "x.org/a"): "changed", ("c", "x.org/a"): "resolved", ("d", "x.org/a"): "missing",
                                                     ("e", "x.org/a"): "unproven", ("f", None): "missing", ("g", "x.org/a"): "missing", ("a", "other.org"): "missing"}
    first = got[("a", "x.org/a")]
    assert (first.source_id, first.payload) == ("r1", "one") and first.headers == {"etag": 'W/"1"', "date": "d2", "vary": "v"}


@needs_tables
def test_classifiers_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    left_out = F.crc32(F.col("doc_id").cast("string"))
    found = predict_language(docs, train_language_model(docs.filter(left_out % 4 != 2))).join(docs.select("doc_id", "lang"), "doc_id").filter(left_out % 4 == 2)
    assert found.filter("lang = lang_pred").count() >= 0.97 * found.count() and found.filter("not accepted").count() <= 0.01 * found.count()
    odd = spark.createDataFrame([(1, None), (2, "123 — !"), (3, ""), (4, "漢")], "doc_id long, text string")
    model = train_language_model(docs)
    assert {r.doc_id: r.lang_pred == "und" for r in predict_language(odd, model).collect()} == {1: True, 2: True, 3: True, 4: False}
    judged = score_toxicity(docs, train_toxicity_model(docs, labels.filter(left_out % 5 != 0))).join(labels, "doc_id").filter(left_out % 5 == 0)
    assert judged.filter("predicted = toxic").count() >= 0.95 * judged.count()
    with pytest.raises(ValueError):
        train_language_model(docs.limit(0))


@pytest.mark.parametrize("free", [64, 36, 24])
def test_dense_blocks_are_split(spark, free):
    rnd = random.Random(free)
    prints = {0x5A5A5A5A5A5A5A5A & ~((1 << free) - 1) | rnd.getrandbits(free) for _ in range(1500)}
    for p in rnd.sample(sorted(prints), 200):
        for k in range(3):
            prints.add(p := p ^ sum(1 << b for b in rnd.sample(range(free), rnd.randrange(1, 6))))
    prints = sorted(prints)
    close = [(a, b) for k, a in enumerate(prints) for b in prints[:k] if (a ^ b).bit_count() <= 4]
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in close:
        root[find(a)] = find(b)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    rows = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    found = {r.fingerprint: r.root for r in link_fingerprints(rows, dense=20).collect()}
    groups = collections.defaultdict(set)
    for p in prints:
        groups[find(p)].add(signed(p))
    got = collections.defaultdict(set)
    for p in prints:
        got[found.get(signed(p), signed(p))].add(signed(p))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))
    # all fingerprints single and in one block: a small part of its pairs is formed, with every close one among them
    block = rows.selectExpr("1 as choice", "0L as bits", "fingerprint", "fingerprint as root", "0L as main", f"{len(prints)}L as outside")
    pairs = meeting_pairs(block, 4, 7)
    assert pairs.count() < len(prints) ** 2 * (0.05 if free > 24 else 0.6)
    formed = {(r.fingerprint, r.other) for r in pairs.filter("bit_count(fingerprint ^ other) <= 4").collect()}
    assert {(signed(a), signed(b)) for a, b in close} <= formed


@needs_tables
def test_nothing_to_learn_from(spark, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    unnamed = docs.limit(20).withColumn("lang", F.lit(None).cast("string"))
    for name, rows, judged in (("none", docs.limit(0), labels.limit(0)), ("unnamed", unnamed, labels.withColumn("toxic", F.lit(None).cast("int")))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        judged.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        told, scored = (QUERIES[q](spark, f"{tmp_path}/{name}").collect() for q in ("op9_language_id", "op3_toxicity"))
        assert len(told) == len(scored) == rows.count()
        assert {(r.lang_pred, r.score) for r in told} <= {("und", 0.0)} and {r.predicted for r in scored} <= {0}
        assert corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect() == []
    one = [train_toxicity_model(docs, labels.filter(F.col("toxic") == side), required=False) for side in (0, 1)]
    assert [{r.predicted for r in score_toxicity(docs, m).collect()} for m in one] == [{0}, {1}]


def test_toxicity_counts_all_labelled_documents(spark, monkeypatch):
    rnd = random.Random(6)
    data = [(k, None if k % 50 == 7 else " ".join(rnd.choice(["bad", "good", "day", "Day", "is"]) for _ in range(k % 5))) for k in range(600)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, int(k % 3 == 0) if k % 7 else None) for k, _ in data], "doc_id long, toxic int")
    used, ratios = [], toxicity._ratios
    monkeypatch.setattr(toxicity, "_ratios", lambda counts, documents: used.append((counts, documents)) or ratios(counts, documents))
    grams = Grams(sizes=(3,), bits=18, once=True)
    train_toxicity_model(docs, labels, per_class=20, grams=grams)
    expected = [collections.Counter(), collections.Counter()]
    for k, text in data:
        if k % 7:
            words = {w.lower() for w in (text or "").split()}
            expected[k % 3 == 0].update({f"<{w}>"[i:i + 3] for w in words for i in range(len(w))} | {("word", w) for w in words})
    (counts, documents), = used
    assert documents.tolist() == [sum(k % 7 > 0 and k % 3 > 0 for k, _ in data), sum(k % 7 > 0 and k % 3 == 0 for k, _ in data)]
    assert [sorted(c[c > 0]) for c in counts] == [sorted(e.values()) for e in expected]


@needs_tables
@pytest.mark.parametrize("left_out", ["de", "en", "es", "fr"])
def test_language_rejection(spark, left_out):
    rnd = random.Random(4)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    apart = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    held = [(r.lang, r.text) for r in docs.filter(apart & F.col("lang").isNotNull()).collect()]
    model = train_language_model(docs.filter(~apart & (F.col("lang") != left_out)))
    texts = [("left out" if lang == left_out else "clean", text) for lang, text in held]
    long = [(lang, text) for lang, text in held if lang != left_out and len(text or "") > 60]
    while len(texts) < len(held) + 200:
        (a, one), (b, other) = rnd.choice(long), rnd.choice(long)
        size = min(len(one), len(other))
        texts += [("two", one[:size] + "\n" + other[:size])] if a != b else []
    texts += [("noise", " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randrange(2, 10))) for _ in range(20))) for _ in range(100)]
    rows = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts)], "doc_id long, text string")
    groups = collections.defaultdict(list)
    for r in predict_language(rows, model).collect():
        groups[texts[r.doc_id][0]].append(r.accepted)
    share = {k: sum(v) / len(v) for k, v in groups.items()}
    assert share["clean"] >= 0.99 and share["two"] >= 0.98 and share["left out"] <= 0.05 and share["noise"] <= 0.05, share


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES, key=lambda n: (len(n.split("_")[0]), n)))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        assert not [d for d in compare(connect(SF_DIR), df, ORACLE[name], 1e-6) if d != "no rows"]
    else:
        assert df.collect()


@needs_tables
def test_pipeline_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == corpus_pipeline.DOCUMENTS, name
        assert 0 < docs.count() <= before
        before = docs.count()
    assert docs.filter("n_chars != length(text)").count() == 0


def test_pipeline_stages_against_plain_python(spark, tmp_path):
    rnd = random.Random(12)
    some = lambda n: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    bench, passage = [some(25) for _ in range(6)], some(50)
    texts = [some(rnd.randrange(1, 120)) for _ in range(30)] + ["", None, "A  line\nkept\tas it is"]
    texts += [f"{some(60)} {passage} {some(60)}" for _ in range(4)] + [f"{some(30)}. {b.upper().replace(' ', ', ')}! {some(30)}" for b in bench]
    texts += [f"{some(20)}\n{bench[0]} {bench[1]}  {some(5)}", texts[0], texts[1] + " \n"]
    long = some(400)
    texts += [long, long.replace(" ", "  ").upper(), f"{long} end"]
    docs = {k: t for k, t in enumerate(rnd.sample(texts, len(texts)))}
    spark.createDataFrame(enumerate(bench), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = spark.createDataFrame([(k, t, "en", f"s{k}", -1) for k, t in docs.items()], "doc_id long, text string, lang string, source string, n_chars long")

    def fingerprint(text):
        w = spaced(lower_ascii(text))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[k:k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints, group = {k: fingerprint(t) for k, t in docs.items()}, {k: k for k in docs}
    for _ in docs:
        for a in docs:
            group[a] = min(group[b] for b in docs if (prints[a] ^ prints[b]).bit_count() <= 4)
    near = {k: t for k, t in docs.items() if group[k] == k}

    lists = {k: spaced(t) for k, t in near.items()}
    count = collections.Counter(tuple(w[k:k + 35]) for w in lists.values() for k in range(len(w) - 34))
    once = {}
    for i, w in lists.items():
        gone = {p for k in range(len(w) - 34) if count[tuple(w[k:k + 35])] > 1 for p in range(k, k + 35)}
        once[i] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else near[i]

    windows = {tuple(b.split()[k:k + 10]) for b in bench for k in range(16)}
    clean = {}
    for i, t in once.items():
        found = list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t)))
        hit = {p for k in range(len(found) - 9) if tuple(m[0] for m in found[k:k + 10]) in windows for p in range(k, k + 10)}
        kept, at = "", 0
        for p in sorted(hit):
            if p - 1 not in hit:
                kept += t[at:found[p].start()]
            at = found[p].end()
        clean[i] = kept + t[at:] if hit else t

    assert len(near) < len(docs) and once != near and clean != once
    for (name, stage), expected in zip(corpus_pipeline.STAGES[1:4], (near, once, clean)):
        got = stage(spark, got, str(tmp_path))
        rows_ = got.collect()
        assert len(rows_) == len(expected) and {r.doc_id: r.text for r in rows_} == expected, name
        assert all((r.lang, r.source, r.n_chars) == ("en", f"s{r.doc_id}", len(r.text or "")) for r in rows_) or name == "SimHash near-dedup"
    if Path(corpus_pipeline.MODEL_FILE).exists():
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.MODEL_FILE)
        told = {r.doc_id: r for r in corpus_pipeline.tokens(spark, got, str(tmp_path)).collect()}
        assert set(told) == set(clean)
        for i, t in clean.items():
            assert told[i].pieces == (None if t is None else model.encode(t)) and told[i].lossless is (None if t is None else True)
            assert told[i].decoded_sha256 == (None if t is None else hashlib.sha256(t.encode()).hexdigest())


def test_rows_without_or_with_shared_ids_stay_apart(spark, monkeypatch):
    """Two texts whose upper hash halves agree, without ids and with one id: only repeated words go."""
    rnd, seen, pair = random.Random(21), {}, None
    passage = " ".join(f"p{k}" for k in range(40))
    n = 0
    while pair is None:  # texts of one repeated passage and a different number of other words
        texts = [f"{passage} " + " ".join(f"q{rnd.randrange(10 ** 9)}" for _ in range(14 + k % 3)) for k in range(20000)]
        hashed = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string").selectExpr("k", "shiftright(xxhash64(t), 32) AS h").collect()
        for k, h in hashed:
            if h in seen and seen[h] != texts[k]:
                pair = (seen[h], texts[k])
            seen[h] = texts[k]
        n += 1
        assert n < 20
    for i in (None, 5):
        data = [(i, t) for t in pair]
        lists = [spaced(t) for t in pair]
        got = sorted((r.n_words, r.n_removed) for r in remove_repeats(table(spark, data), 35).collect())
        assert got == sorted((len(w), 40) for w in lists)


def test_window_table_of_blocks_and_clashing_names(spark):
    rnd = random.Random(31)
    bench = spark.createDataFrame([(k, " ".join(f"b{rnd.randrange(20)}" for _ in range(rnd.randrange(1, 30)))) for k in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join(f"b{rnd.randrange(22)}" for _ in range(200)), k, "s", "i") for k in range(40)],
                                 "doc_id long, text string, _words long, _spans string, __items string").repartition(3)
    one, many = (mark_hits(docs, bench, 3, block_chars=c) for c in (1 << 30, 500))
    assert one.columns == [*docs.columns, "___words", "___spans", "___items"]
    key = lambda r: r.doc_id
    assert sorted(one.collect(), key=key) == sorted(many.collect(), key=key)
    assert remove_hits(docs, bench, 3, ).columns == docs.columns and sorted(remove_hits(docs, bench, 3).collect(), key=key) != sorted(docs.collect(), key=key)
    for name in ("_text_hash", "key", "best"):
        named = docs.withColumnRenamed("_spans", name)
        assert keep_one(named).columns == named.columns


def test_empty_and_single_rows(spark):
    docs = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    assert simhash_groups(docs.limit(0)).collect() == [] and fingerprints(docs.limit(0)).collect() == [] and keep_one(docs.limit(0)).collect() == []
    alone = fingerprints(docs).first()
    assert (alone.edited, alone.near_next) == (docs.first().text[:14] + docs.first().text[:13], 1.0)
    records = spark.createDataFrame([], "record_id string, kind string, url string, fetched_at string, headers map<string,string>, payload string")
    assert resolve_revisits(records).collect() == []
    captures = spark.createDataFrame([], "capture_id long, url string, fetched_at string")
    entries = spark.createDataFrame([("host", "x.org", "block", "2024-01-01")], "rule string, value string, action string, listed_at string")
    assert filter_urls(captures, entries).collect() == []


def test_repeated_and_null_nodes(spark):
    nodes = [("t", 1, None, .5), ("t", 2, 1, .1), ("t", 2, 1, .1), ("t", 2, None, .9), ("t", None, 1, 1.0), (None, None, None, .2)]
    df = spark.createDataFrame([(*n, "x", "y") for n in nodes], "tree string, id int, parent int, score double, key string, up string")
    got = sorted((order((r.tree, r.leaf, r.id)), r["rank"], r.step) for r in tree_paths(df, None).collect())
    # node 2 has no parent, as its best row has none; the null id is a leaf below node 1
    assert got == sorted([(order(("t", 2, 2)), 1, 1), (order(("t", None, 1)), 2, 1), (order(("t", None, None)), 2, 2), (order((None, None, None)), 1, 1)])
    best = {(r.tree, r.leaf) for r in tree_paths(df, 1).collect()}
    assert best == {(r.tree, r.leaf) for r in tree_paths(df, None).filter("rank = 1").collect()}


@pytest.mark.parametrize("slices", [1, 5, 40])
def test_a_busy_conversation_and_a_busy_url(spark, slices):
    rnd = random.Random(slices)
    turns = [(0, rnd.randrange(400) if rnd.random() < 0.9 else None, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", None, "c" * 50])) for _ in range(900)]
    turns += [(1 + k % 600, k // 600, "user", f"{k}") for k in range(1800)]
    made = threads(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4), slices=slices).collect()
    assert len(made) == len(turns)
    busy = sorted((r for r in made if r.tree == 0), key=lambda r: r.id)
    assert [r.id for r in busy] == list(range(1, 901)) and all(r.parent == (r.id - 1 or None) for r in busy)
    told = sorted((t for t in turns if t[0] == 0), key=lambda t: order(t[1:3]))
    rank = {}
    for k, t in enumerate(told):
        rank.setdefault(t[1:3], []).append(k + 1)
    at = collections.defaultdict(list)
    for r in busy:
        at[r.role, r.text].append(r.id)
    wanted = collections.defaultdict(list)
    for (turn, role), places in rank.items():
        assert sorted(x for x in places) == list(range(places[0], places[-1] + 1))
        inside = [r for r in busy if places[0] <= r.id <= places[-1]]
        assert {r.role for r in inside} == {role}
        assert collections.Counter(r.text for r in inside) == collections.Counter(t[3] for t in told if t[1:3] == (turn, role))
    records = [(f"r{k}", "response", "http://x.org/a", f"2024-01-01 00:{k // 60:02d}:{k % 60:02d}", {"etag": str(k)}, f"body {k}") for k in range(0, 600, 7)]
    records += [(f"v{k}", "revisit", "http://x.org/a", f"2024-01-01 00:{k // 60:02d}:{k % 60:02d}", {"etag": str((k - 1) // 7 * 7)}, None) for k in range(600)]
    records += [(f"n{k}", "revisit", None, "2024-01-01", None, None) for k in range(300)]
    df = spark.createDataFrame(records, "record_id string, kind string, url string, fetched_at string, headers map<string,string>, payload string").repartition(4)
    got = {r.record_id: r for r in resolve_revisits(df, slices).collect()}
    assert len(got) == 900 and all(got[f"n{k}"].outcome == "missing" for k in range(300)) and got["v0"].outcome == "missing"
    assert all((got[f"v{k}"].source_id, got[f"v{k}"].payload) == (f"r{(k - 1) // 7 * 7}", f"body {(k - 1) // 7 * 7}") for k in range(1, 600))


def test_repeats_are_hashed_in_small_parts(monkeypatch):
    """A task has the words of about a part of a slice at hand, and hashes are those of the whole slice."""
    from panelkit.llm import substring
    rng = np.random.default_rng(3)
    common = [f"w{k}" for k in rng.integers(0, 500, 60)]
    texts = [" ".join([*(f"w{k}" for k in rng.integers(0, 500, 900)), *common]) for _ in range(40)] + ["", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(42)), pa.array(range(42)), pa.array(texts, pa.string())], names=["id", "hash", "text"])
    sizes, hash_words = [], substring.hash_words

    def measured(data, *rest):
        sizes.append(len(data))
        return hash_words(data, *rest)

    monkeypatch.setattr(substring, "hash_words", measured)
    run, found = substring._anchors(substring.layout(35)), []
    for part in (1 << 30, 20_000):
        monkeypatch.setattr(substring, "PART_BYTES", part)
        sizes.clear()
        found.append(pa.Table.from_batches(run([batch])).to_pylist())
    assert found[0] == found[1] and any(row["more"] for row in found[0])
    assert max(sizes) <= 20_000
