"""SentencePiece encoding and decoding: forward pass over a trie of distinct marked words, shared along common prefixes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.words import hash_words, ranges, returning, slices

MARK = "▁"
#: Words whose pieces a task remembers, about 50 bytes each; beyond it starts anew.
REMEMBERED = 600_000
NEVER = float("-inf")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of a model: ordinary pieces with scores, one id for each byte, and whether the model merges pairs (bpe) or not (unigram)."""

    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    unknown: int
    spelling: list[bytes]  # what each id stands for
    kind: str


def load_vocabulary(path: str, kind: str = "bpe") -> Vocabulary:
    """Read a model file on the driver. ``kind`` is the model's type; its normalizer must change nothing but spaces."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, ids, spelling, byte_ids = {}, {}, [], [-1] * 256
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            byte_ids[int(piece[3:5], 16)] = k
            spelling.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            spelling.append(b"")
        else:
            scores[piece], ids[piece] = model.get_score(k), k
            spelling.append(piece.replace(MARK, " ").encode())
    return Vocabulary(scores, ids, byte_ids, model.unk_id(), spelling, kind)


class Forward:
    """Best piece that ends at each place of a word, kept for the longest common prefix with the word before.

    For a unigram model it is the last piece of the best-scored segmentation of the prefix (Viterbi). A merging model has no sum
    to maximise: there the last piece of a prefix is the one piece that merging leaves there, known from the shorter
    prefix, since a segmentation is what merging yields if and only if merging leaves each two neighbours apart.
    """

    def __init__(self, scores: dict[str, float], ids: dict[str, int], kind: str):
        self.scores, self.ids, self.merging = scores, ids, kind == "bpe"
        self.longest, self.span = max(map(len, scores), default=1), max(ids.values(), default=0) + 1
        self.apart: dict[int, bool] = {}
        self.steps: dict[str, tuple] = {}
        self.word, self.begin, self.last, self.total = "", [0], [-1], [0.0]

    def _steps(self, piece: str) -> tuple[list[float], list[str], list[str]]:
        """How a piece merges by itself: the score of each step, and its first and last part before the steps and after each. All are
        empty for a piece that merging does not make whole."""
        known = self.steps.get(piece)
        if known is None:
            parts, scores, firsts, lasts = list(piece), [], [piece[0]], [piece[-1]]
            while len(parts) > 1:
                found = [(-self.scores[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores]
                if not found:
                    break
                score, k = min(found)
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
                scores.append(-score)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            known = self.steps[piece] = (scores, firsts, lasts) if len(parts) == 1 else ([], [], [])
        return known

    def _stays(self, word: str, begin: int, end: int) -> bool:
        """Whether merging leaves the piece apart from the last piece before it (or whole, at the start of a word). Both merge step by
        step, the better step first; a merge across their border that comes before the next step of either joins them."""
        after, firsts, _ = self._steps(word[begin:end])
        if not firsts or not begin:
            return bool(firsts)
        before, _, lasts = self._steps(word[self.begin[begin]:begin])
        i = j = 0
        while True:
            left = before[i] if i < len(before) else NEVER
            right = after[j] if j < len(after) else NEVER
            across = self.scores.get(lasts[i] + firsts[j], NEVER)
            if across > left and across >= right:  # of equal merges the leftmost goes first
                return False
            if left == right == NEVER:
                return True
            if left >= right:
                i += 1
            else:
                j += 1

    def _merging(self, word: str, shared: int) -> None:
        begins, last, ids, apart, span, longest = self.begin, self.last, self.ids, self.apart, self.span, self.longest
        for end in range(shared + 1, len(word) + 1):
            for begin in range(end - longest if end > longest else 0, end):
                piece = ids.get(word[begin:end])
                if piece is not None:
                    pair = (last[begin] + 1) * span + piece
                    stays = apart.get(pair)
                    if stays is None:
                        stays = apart[pair] = self._stays(word, begin, end)
                    if stays:
                        begins.append(begin)
                        last.append(piece)
                        break
            else:
                raise ValueError(f"no piece ends at {end} in {word!r}")

    def _best(self, word: str, shared: int) -> None:
        for end in range(shared + 1, len(word) + 1):
            score, begin = max((self.total[b] + self.scores[word[b:end]], -b) for b in range(max(0, end - self.longest), end)
                               if word[b:end] in self.scores)
            self.begin.append(-begin)
            self.last.append(self.ids[word[-begin:end]])
            self.total.append(score)

    def __call__(self, word: str) -> list[int]:
        """Ids of a word of known characters; quickest when words come in order."""
        shared = 0
        for a, b in zip(word, self.word):
            if a != b:
                break
            shared += 1
        del self.begin[shared + 1:], self.last[shared + 1:], self.total[shared + 1:]
        (self._merging if self.merging else self._best)(word, shared)
        self.word = word
        out, at = [], len(word)
        while at:
            out.append(self.last[at])
            at = self.begin[at]
        return out[::-1]


class Encoder:
    """Ids of marked words. Characters outside the vocabulary stand alone as their bytes (or as the unknown piece)."""

    def __init__(self, scores, ids, byte_ids, unknown, kind):
        self.forward, self.byte_ids, self.unknown = Forward(scores, ids, kind), byte_ids, unknown
        self.known = {piece for piece in scores if len(piece) == 1}
        rare = np.zeros(256, dtype=bool)
        rare[[c for c in range(128) if chr(c) not in self.known and c != 0x20]] = True
        self.rare = rare
        self._forget()

    def _forget(self) -> None:
        self.forward.apart.clear()
        self.hashes, self.first, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _ids(self, word: str) -> list[int]:
        if self.known.issuperset(word):
            return self.forward(word)
        out, run = [], ""
        for char in [*word, ""]:
            if char and char in self.known:
                run += char
                continue
            out += self.forward(run) if run else []
            found = [self.byte_ids[b] for b in char.encode()]
            out += found if -1 not in found else [self.unknown]
            run = ""
        return out

    def words(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where marked words begin in texts that each begin with a space: at the first of several spaces, at and after a character
        of ASCII that has no piece. No piece reaches from one such word into the next, so each is encoded for itself."""
        rare, space = self.rare[data], data == 0x20
        begins = rare.copy()
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        begins[1:] |= (space[1:] & ~space[:-1]) | rare[:-1]
        return np.flatnonzero(begins)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Encode words not met yet in sorted order, which is the depth-first order of their trie, and remember them."""
        texts = [word.decode().replace(" ", MARK) for word in words]
        order = sorted(range(len(texts)), key=texts.__getitem__)
        found = [self._ids(texts[k]) for k in order]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        first = np.cumsum(sizes) - sizes + len(self.flat)
        self.flat = np.concatenate([self.flat, np.fromiter((k for ids in found for k in ids), dtype=np.int32, count=int(sizes.sum()))])
        hashes = np.concatenate([self.hashes, hashes[order]])
        place = np.argsort(hashes, kind="stable")
        self.hashes, self.first, self.sizes = (x[place] for x in (hashes, np.concatenate([self.first, first]), np.concatenate([self.sizes, sizes])))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, one after the other, and where those of each row begin (one more at the end)."""
        starts = self.words(data, offsets)
        hashes, place, word = np.unique(hash_words(data, starts, np.append(starts[1:], len(data))), return_index=True, return_inverse=True)
        known = np.isin(hashes, self.hashes, assume_unique=True)
        if len(self.hashes) + int((~known).sum()) > REMEMBERED:
            self._forget()
            known[:] = False
        if len(self.forward.apart) > REMEMBERED // 2:
            self.forward.apart.clear()
        raw, ends = data.tobytes(), np.append(starts[1:], len(data))
        new = place[~known]
        if len(new):
            self._learn(hashes[~known], [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
        at = np.searchsorted(self.hashes, hashes)[word]
        sizes = self.sizes[at]
        return self.flat[ranges(self.first[at], sizes)], np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, offsets)]


def _encoding(spark, vocabulary: Vocabulary, at: int, out_col: str):
    """A function over Arrow batches that appends the ids of text column number ``at``."""
    shared = spark.sparkContext.broadcast((vocabulary.scores, vocabulary.ids, vocabulary.byte_ids, vocabulary.unknown, vocabulary.kind))

    def run(batches):
        encoder = Encoder(*shared.value)
        for part, _, _ in slices(batches, at):
            texts = pc.replace_substring(part.column(at), MARK, " ")
            marked = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(" ", texts, ""))
            for _, data, offsets in slices([pa.RecordBatch.from_arrays([marked], names=["text"])], 0, 1 << 62):
                values, first = encoder.encode(data, offsets)
            ids = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values), mask=pc.is_null(texts))
            yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, out_col])
    return run


def _decoding(spark, vocabulary: Vocabulary, at: int, out_col: str):
    """A function over Arrow batches that appends the texts that the ids of column number ``at`` spell."""
    sizes = np.array([len(x) for x in vocabulary.spelling], dtype=np.int64)
    shared = spark.sparkContext.broadcast((np.frombuffer(b"".join(vocabulary.spelling), dtype=np.uint8), sizes))

    def run(batches):
        flat, sizes = shared.value
        first = np.cumsum(sizes) - sizes
        for batch in batches:
            texts = []
            for row in range(batch.num_rows):
                ids = batch.column(at)[row].values
                if ids is None:
                    texts.append(None)
                    continue
                ids = ids.to_numpy()
                texts.append(flat[ranges(first[ids], sizes[ids])].tobytes().decode(errors="replace")[1:])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out_col])
    return run


def _with(docs: DataFrame, run, name: str, kind: T.DataType) -> DataFrame:
    if name in docs.columns:
        raise ValueError(f"column {name} is there already")
    return docs.mapInArrow(returning(run), T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", out_col: str = "pieces") -> DataFrame:
    """``docs`` with a column of piece ids. A null text has null ids, an empty one none; long texts are one row like any other.

    Spaces become the mark and each text begins with one. Each task collects the distinct marked words of a slice of text,
    sorts them and makes one forward pass over their trie; words met are remembered from slice to slice, up to a
    fixed number (by a 64-bit hash). The vocabulary has a fixed size and is broadcast. Raises if ``docs`` has ``out_col``.
    """
    return _with(docs, _encoding(docs.sparkSession, vocabulary, docs.columns.index(text_col), out_col), out_col, T.ArrayType(T.IntegerType()))


def decode(docs: DataFrame, vocabulary: Vocabulary, pieces_col: str = "pieces", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the texts that the ids spell; null ids give null, no ids the empty text. Bytes that are no UTF-8 become U+FFFD.
    The mark itself, if a text holds it, comes back as a space: the only loss of a round trip."""
    return _with(docs, _decoding(docs.sparkSession, vocabulary, docs.columns.index(pieces_col), out_col), out_col, T.StringType())


def encode_decode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``pieces``, ``n_pieces``, ``decoded`` and ``lossless`` (it equals the text). All but the id are null for a
    null text. Both ways in one pass; other columns are ignored; an empty table gives no rows."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    forth, back = _encoding(docs.sparkSession, vocabulary, 1, "pieces"), _decoding(docs.sparkSession, vocabulary, 2, "decoded")

    def run(batches):
        for batch in back(forth(batches)):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pc.equal(batch.column(1), batch.column(3))],
                                             names=["_id", "pieces", "decoded", "lossless"])

    schema = T.StructType([rows.schema["_id"], T.StructField("pieces", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()),
                           T.StructField("lossless", T.BooleanType())])
    done = rows.mapInArrow(returning(run), schema)
    return done.select(F.col("_id").alias(id_col), "pieces", F.when(F.col("pieces").isNotNull(), F.size("pieces").cast("long")).alias("n_pieces"),
                       "decoded", "lossless")
