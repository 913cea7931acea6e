"""SimHash near-duplicates: fingerprints of word shingles, blocks that close pairs must share, exact Hamming check, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from panelkit.llm.components import components
from panelkit.llm.words import LOWER, UNSPACED, find_words, single_spaced, slices
from panelkit.session import materialize

SEED = 42
#: Fingerprints of a block outside its largest component above which the block is split again before pairs are formed.
DENSE = 500


def shingle_fingerprints(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """64-bit fingerprint of every row: bit i is set if it is set in over half the shingle hashes. No word: 0."""
    data = LOWER[data]
    starts, ends, first = find_words(data, offsets, UNSPACED)
    out = np.zeros(len(offsets) - 1, dtype=np.uint64)
    if not len(starts):
        return out
    text, starts, ends = single_spaced(data, starts, ends)
    digest = xxhash.xxh64_intdigest
    for row in range(len(out)):
        low, high = int(first[row]), int(first[row + 1])
        if low == high:
            continue
        n = max(1, high - low - size + 1)
        begin, end = starts[low:low + n].tolist(), ends[high - n:high].tolist()
        hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(begin, end)), dtype="<u8", count=n)
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, n, 65536):
            ones += np.unpackbits(hashes[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[row] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
    return out


def simhash(docs: DataFrame, size: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``fingerprint`` (64 bits as a signed number). Null text counts as empty: 0."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fingerprint", T.LongType())])

    def fingerprints(batches):
        for part, data, offsets in slices(batches, 1):
            found = shingle_fingerprints(data, offsets, size)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], names=["id", "fingerprint"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(fingerprints, schema)


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks of every choice of ``blocks - distance`` of ``blocks`` near-equal blocks of the 64 bits. Of two fingerprints that
    differ in at most ``distance`` bits, at least that many blocks agree, so they agree under one of the masks."""
    if not 0 <= distance < blocks <= 64:
        raise ValueError("need 0 <= distance < blocks <= 64")
    edge = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(1 << edge[k + 1]) - (1 << edge[k]) for k in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _differ(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def split_blocks(meeting: DataFrame, distance: int, blocks: int) -> DataFrame:
    """Rows of blocks (``choice``, ``bits``, ``fingerprint``) with the blocks inside the block: ``part`` and ``within``. The 64 bits
    are dealt to ``blocks`` sets, those that are set in nearly half the block's fingerprints first, so each set tells about as much
    apart, and keys are all choices of ``blocks - distance`` sets: close pairs share one (see ``block_masks``)."""
    bit = lambda i: F.shiftright("fingerprint", i).bitwiseAND(F.lit(1).cast("long"))
    ones = meeting.groupBy("choice", "bits").agg(F.count("*").alias("n"), *[F.sum(bit(i)).alias(f"bit{i}") for i in range(64)])
    even = F.sort_array(F.array(*[F.struct(F.abs(2 * F.col(f"bit{i}") - F.col("n")).alias("odds"), F.lit(_signed(1 << i)).cast("long").alias("mask"))
                                  for i in range(64)]))
    sets = ones.select("choice", "bits", even.alias("even")).select("choice", "bits", *[
        F.aggregate(F.transform(F.array(*[F.lit(k) for k in range(s, 64, blocks)]), lambda k: F.element_at("even", k + 1)["mask"]),
                    F.lit(0).cast("long"), lambda all_, mask: all_.bitwiseOR(mask)).alias(f"set{s}") for s in range(blocks)])
    keys = []
    for part, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = F.col(f"set{chosen[0]}")
        for s in chosen[1:]:
            mask = mask.bitwiseOR(F.col(f"set{s}"))
        keys.append(F.struct(F.lit(part).cast("short").alias("part"), F.col("fingerprint").bitwiseAND(mask).alias("within")))
    return meeting.join(materialize(sets, "sets"), ["choice", "bits"]).select(*meeting.columns, F.explode(F.array(*keys)).alias("key")).select(*meeting.columns, "key.*")


def meeting_pairs(meeting: DataFrame, distance: int, blocks: int, dense: int = DENSE) -> DataFrame:
    """Pairs (``fingerprint``, ``root``, ``other``, ``other_root``) of a block's members and its members outside its largest
    component ``main``, of different components; in blocks with over ``dense`` members outside (``outside``) only pairs that share
    a block inside the block too. No pair within the distance is lost; a pair may come several times."""
    def pairs(rows, key):
        others = rows.filter("root != main").select(*key, F.col("fingerprint").alias("other"), F.col("root").alias("other_root"))
        return rows.join(others, key).filter(F.col("root") != F.col("other_root")).select("fingerprint", "root", "other", "other_root")

    thick = meeting.filter(F.col("outside") > dense)
    thin = pairs(meeting.filter(F.col("outside") <= dense), ["choice", "bits"])
    if not thick.limit(1).count():
        return thin
    return thin.unionByName(pairs(split_blocks(thick, distance, blocks), ["choice", "bits", "part", "within"]))


def link_fingerprints(prints: DataFrame, distance: int = 4, blocks: int = 7, dense: int = DENSE) -> DataFrame:
    """Components of distinct fingerprints (column ``fingerprint``), linked where they differ in at most ``distance`` bits:
    ``fingerprint``, ``root`` (a fingerprint of the component). Exact: no pair within the distance is lost.

    Close pairs share a block (see ``block_masks``). Pairs inside a block are not all formed. First each fingerprint is
    compared with the one before it and with the smallest of its block, which joins most of a dense block, and components are
    taken. Then only blocks in which several components meet are joined again: members outside the block's largest component
    against its members of other components. Two members of the same component need no further link. Where over ``dense`` members
    are outside (documents of one template, each far from the next), the block is first split by the bits that vary in it.
    """
    masks = block_masks(distance, blocks)
    keys = F.explode(F.array(*[F.struct(F.lit(i).cast("short").alias("choice"),
                                        F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("bits")) for i, m in enumerate(masks)]))
    block = Window.partitionBy("choice", "bits")
    ordered = block.orderBy("fingerprint")
    members = (prints.select("fingerprint", keys.alias("key")).select("fingerprint", "key.choice", "key.bits")
               .withColumn("before", F.lag("fingerprint").over(ordered))
               .withColumn("after", F.lead("fingerprint").over(ordered))
               .withColumn("lowest", F.first("fingerprint").over(ordered))
               .filter("before is not null or after is not null").drop("after"))
    members = materialize(members, "blocks")
    near = [members.filter(F.col(other).isNotNull() & (_differ("fingerprint", other) <= distance))
            .select(F.col("fingerprint").alias("a"), F.col(other).alias("b")) for other in ("before", "lowest")]
    first = materialize(components(near[0].unionByName(near[1])), "roots")

    members = materialize(members.join(first, F.col("fingerprint") == F.col("node"), "left")
                          .select("choice", "bits", "fingerprint", F.coalesce("root", "fingerprint").alias("root")), "blocks")
    mixed = (members.groupBy("choice", "bits", "root").agg(F.count("*").alias("n")).groupBy("choice", "bits")
             .agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"), F.count("*").alias("roots"))
             .filter("roots > 1").select("choice", "bits", F.col("main.root").alias("main"), (F.col("n") - F.col("main.n")).alias("outside")))
    mixed = materialize(mixed, "mixed")
    meeting = materialize(members.join(mixed, ["choice", "bits"]), "meeting")
    links = (meeting_pairs(meeting, distance, blocks, dense).filter(_differ("fingerprint", "other") <= distance)
             .select(F.col("root").alias("a"), F.col("other_root").alias("b")).distinct())
    second = materialize(components(links), "roots")
    merged = first.join(second.withColumnRenamed("root", "top").withColumnRenamed("node", "root"), "root", "left")
    tops = merged.select(F.col("node").alias("fingerprint"), F.coalesce("top", "root").alias("root"))
    # fingerprints that no cheap link joined are their own roots and may have been joined by the second step
    alone = second.join(first.select("node"), "node", "left_anti").select(F.col("node").alias("fingerprint"), "root")
    return tops.unionByName(alone)


def simhash_groups(docs: DataFrame, size: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 lowercase hex digits) and ``component_id``, the smallest id that
    is reachable over fingerprints that differ in at most ``distance`` bits, the row's own included.

    Texts are lower-cased (A-Z only), cut at white space into words and hashed as ``size``-word shingles with XXH64, repeats
    included; shorter texts are one shingle; texts without words, empty and null ones have fingerprint zero and are linked
    like any other. Equal fingerprints are one row in all that follows, so copies, however many, cost no more than one document.
    Rows without an id get their component's smallest id, null if it has none; rows that share an id are separate rows.
    Other columns are ignored; an empty table gives no rows.
    """
    prints = materialize(simhash(docs, size, id_col, text_col), "prints")
    lowest = materialize(prints.groupBy("fingerprint").agg(F.min("id").alias("low")), "lowest")
    roots = link_fingerprints(lowest.select("fingerprint"), distance)
    labelled = lowest.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    labelled = materialize(labelled, "labelled")
    smallest = labelled.groupBy("root").agg(F.min("low").alias("component_id"))
    found = materialize(labelled.join(smallest, "root").select("fingerprint", "component_id"), "components")
    return prints.join(found, "fingerprint").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each group of near copies: the one with the smallest id; rows without an id stay only
    in groups without any id. Of rows that share that id, the one with the smallest text hash stays, and of equal rows one."""
    text_hash = F.xxhash64(F.col(text_col).cast("string"))
    narrow = docs.select(F.struct(F.col(id_col).alias("id"), text_hash.alias("hash")).alias("row"), F.col(text_col).alias("text"))
    prints = materialize(simhash(narrow, size, "row", "text"), "prints")
    order = F.struct(F.col("id.id").isNull().alias("none"), F.col("id").alias("row"))
    lowest = materialize(prints.groupBy("fingerprint").agg(F.min(order).alias("low")), "lowest")
    roots = link_fingerprints(lowest.select("fingerprint"), distance)
    best = (lowest.join(roots, "fingerprint", "left").groupBy(F.coalesce("root", "fingerprint").alias("root"))
            .agg(F.min("low").alias("low")).select("low.row.*"))
    best = materialize(best.select(F.struct("id", "hash").alias("best")), "kept")
    # the input's columns stay inside a struct, so none can clash; equal keys, null ids too, are equal as structs
    whole = docs.select(F.struct(F.col(id_col).alias("id"), text_hash.alias("hash")).alias("key"), F.struct(*docs.columns).alias("row"))
    return whole.join(best, F.col("key") == F.col("best"), "left_semi").dropDuplicates(["key"]).select("row.*")
