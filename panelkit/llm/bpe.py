"""BPE encoding and decoding: byte pairs that occur inside no token are certain cuts; the fragments between are encoded on their own."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.words import ranges, slices

LETTER, NUMBER, SPACE, OTHER = range(4)
#: Endings that stay with the apostrophe before them when it begins a token.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: The bytes that stand for themselves in the file's spelling of tokens; the others follow from 256 on, in order.
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Bytes of fragments that a task remembers, each with about 200 more; beyond it starts anew.
REMEMBERED = 32 << 20
#: Bytes of text that are cut at once.
PART_BYTES = 1 << 20


@dataclass(frozen=True)
class BytePairs:
    """A byte-level vocabulary: what each pair of ids merges to (rank, id), the id of each byte, the bytes of each id, added tokens that are
    cut out of a text first, whether a byte pair occurs inside any token (256 x 256), and the class of each code point."""

    merges: dict[tuple[int, int], tuple[int, int]]
    byte_ids: list[int]
    spelling: list[bytes]
    added: dict[bytes, int]
    inside: np.ndarray
    kinds: np.ndarray

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pairs in order, as first id << 32 | second id, the rank of each, what each rank makes, and the ids of bytes."""
        pairs = np.array([a << 32 | b for a, b in self.merges], dtype=np.int64)
        ranks = np.array([r for r, _ in self.merges.values()], dtype=np.int64)
        made = np.zeros(int(ranks.max(initial=-1)) + 1, dtype=np.int64)
        made[ranks] = [k for _, k in self.merges.values()]
        order = np.argsort(pairs)
        return pairs[order], ranks[order], made, np.array(self.byte_ids, dtype=np.int64)


def letters_and_spaces() -> np.ndarray:
    """The class of every code point as the library's splitter sees it: where two sources of Unicode agree, theirs; the library itself
    is asked about the others, which came in with some version of Unicode."""
    import regex
    from tokenizers import pre_tokenizers

    splitter = pre_tokenizers.ByteLevel(add_prefix_space=False)
    classes = [(LETTER, regex.compile(r"\p{L}")), (NUMBER, regex.compile(r"\p{N}")), (SPACE, regex.compile(r"\p{White_Space}"))]
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in classes:
        for found in pattern.finditer(every):
            out[ord(found[0])] = kind
    for point, known in enumerate(out.tolist()):
        category = unicodedata.category(chr(point))
        told = LETTER if category[0] == "L" else NUMBER if category[0] == "N" else known if known == SPACE else OTHER
        if told != known:
            joins = [kind for kind, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(splitter.pre_tokenize_str(before + chr(point))) == 1]
            out[point] = joins[0] if joins else SPACE
    return out


def load_byte_pairs(path: str) -> BytePairs:
    """Read a byte-level BPE file of the tokenizers library on the driver. Raises if it asks for more than splitting by the usual pattern and
    merging: a normalizer, a leading space, markers on words, dropout, or added tokens with conditions."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, splitter, decoder = told["model"], told["pre_tokenizer"] or {}, told["decoder"] or {}
    odd = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
    odd += [told["normalizer"], splitter.get("type") != "ByteLevel", splitter.get("add_prefix_space"), not splitter.get("use_regex", True),
            decoder.get("type") != "ByteLevel", *[t.get(k) for t in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")]]
    if model["type"] != "BPE" or any(odd):
        raise ValueError("not a plain byte-level BPE")
    rest = [b for b in range(256) if b not in set(PLAIN)]
    byte_of = {chr(b): b for b in PLAIN} | {chr(256 + k): b for k, b in enumerate(rest)}
    ids, added = model["vocab"], {t["content"].encode(): t["id"] for t in told["added_tokens"]}
    spelling = [b""] * (1 + max([*ids.values(), *added.values()]))
    for token, k in ids.items():
        spelling[k] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    for token, k in added.items():
        spelling[k] = token
    pairs = [tuple(m) if isinstance(m, (list, tuple)) else tuple(m.split(" ")) for m in model["merges"]]
    merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in reversed(list(enumerate(pairs)))}
    inside = np.zeros((256, 256), dtype=bool)
    for token in ids:
        run = np.frombuffer(spelling[ids[token]], dtype=np.uint8)
        inside[run[:-1], run[1:]] = True
    char_of = {b: c for c, b in byte_of.items()}
    return BytePairs(merges, [ids[char_of[b]] for b in range(256)], spelling, added, inside, letters_and_spaces())


def merged(fragment: bytes, merges: dict, byte_ids: list[int]) -> list[int]:
    """Ids of one fragment: the pair of lowest rank merges first, of equal ranks the leftmost, until no pair can. Entries of the heap whose
    pair has changed since are passed over, so a fragment of n bytes takes about n log n steps."""
    ids = [byte_ids[b] for b in fragment]
    size = len(ids)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(merges[pair][0], k, pair) for k, pair in enumerate(zip(ids, ids[1:])) if pair in merges]
    heapify(heap)
    while heap:
        _, k, pair = heappop(heap)
        j = after[k]
        if j >= size or (ids[k], ids[j]) != pair:
            continue
        ids[k], ids[j], after[k] = merges[pair][1], -1, after[j]
        if after[j] < size:
            before[after[j]] = k
        for left in (before[k], k):
            if left >= 0 and after[left] < size:
                pair = (ids[left], ids[after[left]])
                if pair in merges:
                    heappush(heap, (merges[pair][0], left, pair))
    return [x for x in ids if x >= 0]


class Merger:
    """Ids of many short fragments at once: in each round every fragment merges its pair of lowest rank, of equal ranks the leftmost."""

    #: Rank of a pair that doesn't merge, and the longest fragment in bytes that takes part; longer ones take more rounds than the heap costs.
    NONE, LONGEST = np.int64(1) << 30, 48

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray, made: np.ndarray, byte_ids: np.ndarray):
        self.pairs, self.ranks, self.made, self.byte_ids, self.merges = pairs, ranks, made, byte_ids, None

    def _look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], self.NONE)

    def __call__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, fragment after fragment, and how many each has."""
        counts, kept = np.zeros(len(starts), dtype=np.int64), []
        long = np.flatnonzero(sizes > self.LONGEST)
        for k in long.tolist():
            if self.merges is None:
                by_rank = dict(zip(self.ranks.tolist(), zip(self.pairs.tolist(), self.made[self.ranks].tolist())))
                self.merges = {(pair >> 32, pair & 0xFFFFFFFF): (rank, made) for rank, (pair, made) in by_rank.items()}
            ids = merged(data[starts[k]:starts[k] + sizes[k]].tobytes(), self.merges, self.byte_ids.tolist())
            counts[k] = len(ids)
            kept.append((np.full(len(ids), k), np.array(ids, dtype=np.int64)))
        short = np.flatnonzero(sizes <= self.LONGEST)
        ids, owner = self.byte_ids[data[ranges(starts[short], sizes[short])]], np.repeat(short, sizes[short])
        last = np.r_[owner[1:] != owner[:-1], True][:len(owner)]
        rank = np.full(len(ids), self.NONE)
        inner = np.flatnonzero(~last)
        rank[inner] = self._look(ids[inner], ids[inner + 1])
        while len(ids):
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), begins)
            open_ = best >> 32 < self.NONE
            if not open_.all():  # fragments without a pair that merges are finished
                width = np.diff(np.r_[begins, len(ids)])
                stays = np.repeat(open_, width)
                counts[owner[begins[~open_]]] = width[~open_]
                kept.append((owner[~stays], ids[~stays]))
                shift = np.cumsum(~stays)
                at = best[open_] & 0xFFFFFFFF
                at -= shift[at]
                merging = best[open_] >> 32
                ids, owner, rank = ids[stays], owner[stays], rank[stays]
            else:
                at, merging = best & 0xFFFFFFFF, best >> 32
            if not len(ids):
                break
            ids[at] = self.made[merging]
            stays = np.ones(len(ids), dtype=bool)
            stays[at + 1] = False
            rank[at] = self.NONE
            ids, owner, rank, at = ids[stays], owner[stays], rank[stays], at - np.arange(len(at))
            right = at[(at + 1 < len(ids))]
            right = right[owner[right] == owner[right + 1]]
            left = at[at > 0]
            left = left[owner[left] == owner[left - 1]] - 1
            for where in (right, left):
                rank[where] = self._look(ids[where], ids[where + 1])
        if not kept:
            return np.zeros(0, np.int64), counts
        owner, ids = (np.concatenate(x) for x in zip(*kept))
        return ids[np.argsort(owner, kind="stable")], counts


def _tokens_begin(points: np.ndarray, kind: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Whether the splitter begins a token at each character. ``edge``: a text, or the part after an added token, begins there."""
    begins = edge.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # the last space of a run goes with what follows it if it is U+0020, and is a token of its own if not
    word = 1 + np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:])
    begins[word - 1] = True
    begins[word] = points[word - 1] != 0x20
    mark = np.flatnonzero((points[:-1] == 0x27) & begins[:-1] & ~edge[1:] & (kind[1:] == LETTER))
    if len(mark):
        room = np.r_[points, [0, 0]]
        inner = np.r_[~edge, False, False]
        for ending in ENDINGS:
            one = mark[room[mark + 1] == ord(ending[0])]
            if len(ending) > 1:
                one = one[(room[one + 2] == ord(ending[1])) & inner[one + 2]]
            begins[one + 1] = False
            stop = one + 1 + len(ending)
            begins[stop[stop < len(begins)]] = True
    return begins


class Encoder:
    """Ids of the fragments that a task has met: short ones by their exact value as a number, longer ones by their bytes."""

    def __init__(self, pairs, ranks, made, byte_ids, added, inside, kinds):
        self.merger, self.added, self.kinds = Merger(pairs, ranks, made, byte_ids), added, kinds
        self.outside = ~inside.reshape(-1)
        self.pattern = re.compile(b"|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        self._forget()

    def _forget(self):
        self.slot, self.ids, self.sizes, self.held = {}, array("i"), array("i"), 0

    def _keep(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids.frombytes(ids.astype(np.int32).tobytes())
        self.sizes.frombytes(sizes.astype(np.int32).tobytes())

    def _spans(self, raw: bytes, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """Begin, end and id of added tokens, none across two rows."""
        if self.pattern is None or not self.pattern.search(raw):
            return []
        edges = offsets.tolist()
        return [(m.start(), m.end(), self.added[m[0]]) for a, b in zip(edges[:-1], edges[1:]) for m in self.pattern.finditer(raw, a, b)]

    def cuts(self, data: np.ndarray, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
        """Where fragments begin, and the ids of added tokens by where they begin."""
        spans = self._spans(raw, offsets)
        points = np.frombuffer(raw.decode().encode("utf-32-le"), dtype="<u4")
        at = np.flatnonzero((data & 0xC0) != 0x80)  # where characters begin
        edge = np.zeros(len(points), dtype=bool)
        edges = np.r_[offsets, [x for a, b, _ in spans for x in (a, b)]].astype(np.int64)
        edge[np.searchsorted(at, edges[edges < len(data)])] = True
        begins = np.zeros(len(data), dtype=bool)
        begins[1:] = self.outside[data[:-1].astype(np.uint16) << np.uint16(8) | data[1:]]
        begins[at[_tokens_begin(points, self.kinds[points], edge)]] = True
        for a, b, _ in spans:
            begins[a + 1:b] = False
        return np.flatnonzero(begins), {a: k for a, _, k in spans}

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, one after the other, and where those of each row begin (one more at the end)."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        if self.held > REMEMBERED:
            self._forget()
        raw = data.tobytes()
        starts, added = self.cuts(data, raw, offsets)
        sizes = np.diff(np.r_[starts, len(data)])
        slot, short = np.empty(len(starts), dtype=np.int64), sizes <= 7
        padded = np.zeros((len(data) + 23) // 8 * 8, dtype=np.uint8)
        padded[:len(data)] = data
        lanes, begin, size = padded.view("<u8"), starts[short], sizes[short].astype(np.uint64)
        shift = ((begin & 7) << 3).astype(np.uint64)
        value = (lanes[begin >> 3] >> shift) | ((lanes[(begin >> 3) + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        value = value & ((np.uint64(1) << (size << np.uint64(3))) - np.uint64(1)) | size << np.uint64(56)
        distinct, place, which = np.unique(value, return_index=True, return_inverse=True)
        begins, wide, found, number = [], [], [], len(self.sizes)
        for key, a in zip(distinct.tolist(), begin[place].tolist()):
            k = self.slot.setdefault(key, number)
            if k == number:
                begins.append(a)
                wide.append(key >> 56)
                number += 1
            found.append(k)
        slot[short] = np.array(found, dtype=np.int64)[which]
        long, found = np.flatnonzero(~short), []
        for a, n in zip(starts[long].tolist(), sizes[long].tolist()):
            k = self.slot.setdefault(raw[a:a + n], number)
            if k == number:
                begins.append(a)
                wide.append(n)
                number += 1
            found.append(k)
        slot[long] = found
        self._keep(*self.merger(data, np.array(begins, dtype=np.int64), np.array(wide, dtype=np.int64)))
        self.held += sum(wide) + 200 * len(wide)
        for k in np.searchsorted(starts, sorted(added)).tolist():
            token = added[int(starts[k])]
            slot[k] = self.slot.setdefault(("added", token), number)
            if slot[k] == number:
                self._keep(np.array([token]), np.array([1]))
                number += 1
        count, known = np.array(self.sizes, dtype=np.int64), np.array(self.ids, dtype=np.int32)
        ids = known[ranges((np.cumsum(count) - count)[slot], count[slot])]
        return ids, np.r_[0, np.cumsum(count[slot])][np.searchsorted(starts, offsets)]


def _encoding(spark, vocabulary: BytePairs, at: int, out_col: str):
    """A function over Arrow batches that appends the ids of text column number ``at``."""
    shared = spark.sparkContext.broadcast((*vocabulary.arrays(), vocabulary.added, vocabulary.inside, vocabulary.kinds))

    def run(batches):
        encoder = Encoder(*shared.value)
        for part, data, offsets in slices(batches, at, PART_BYTES):
            ids, first = encoder.encode(data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids), mask=pc.is_null(part.column(at)))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, out_col])
    return run


def _decoding(spark, vocabulary: BytePairs, at: int, out_col: str):
    """A function over Arrow batches that appends the texts that the ids of column number ``at`` spell."""
    sizes = np.array([len(x) for x in vocabulary.spelling], dtype=np.int64)
    shared = spark.sparkContext.broadcast((np.frombuffer(b"".join(vocabulary.spelling), dtype=np.uint8), sizes))

    def run(batches):
        flat, sizes = shared.value
        first = np.cumsum(sizes) - sizes
        for batch in batches:
            lists, texts = batch.column(at), []
            edges, every = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for a, b, valid in zip(edges[:-1].tolist(), edges[1:].tolist(), lists.is_valid().to_pylist()):
                ids = every[a:b]
                texts.append(flat[ranges(first[ids], sizes[ids])].tobytes().decode(errors="replace") if valid else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out_col])
    return run


def _with(docs: DataFrame, run, name: str, kind: T.DataType) -> DataFrame:
    if name in docs.columns:
        raise ValueError(f"column {name} is there already")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def encode_bpe(docs: DataFrame, vocabulary: BytePairs, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    """``docs`` with a column of token ids, those of the tokenizers library without special tokens around. A null text has null ids, an empty
    one none; repeated rows and long texts are rows like any other. Raises if ``docs`` has ``out_col``.

    Merging can only make tokens, so where two neighbouring bytes occur side by side in no token, every tokenization has a
    boundary: a table of 256 x 256 pairs marks these cuts over a whole slice of texts at once. The splitter's own boundaries
    and added tokens cut further. What lies between is encoded on its own, each distinct fragment once, and the ids are
    concatenated. Fragments met are remembered from slice to slice up to a fixed size. The vocabulary has a fixed size and is broadcast.
    """
    return _with(docs, _encoding(docs.sparkSession, vocabulary, docs.columns.index(text_col), out_col), out_col, T.ArrayType(T.IntegerType()))


def decode_bpe(docs: DataFrame, vocabulary: BytePairs, tokens_col: str = "tokens", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the texts that the ids spell, added tokens included; null ids give null, no ids the empty text. Bytes that are no UTF-8
    become U+FFFD. Raises if ``docs`` has ``out_col``."""
    return _with(docs, _decoding(docs.sparkSession, vocabulary, docs.columns.index(tokens_col), out_col), out_col, T.StringType())


def encode_decode_bpe(docs: DataFrame, vocabulary: BytePairs, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``tokens`` and ``decoded``, the text that they spell; both null for a null text. Both ways in one
    pass; other columns are ignored, whatever their names; an empty table gives no rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    forth, back = _encoding(docs.sparkSession, vocabulary, 1, "tokens"), _decoding(docs.sparkSession, vocabulary, 2, "decoded")

    def run(batches):
        for batch in back(forth(batches)):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3)], names=["id", "tokens", "decoded"])

    schema = T.StructType([rows.schema["id"], T.StructField("tokens", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
