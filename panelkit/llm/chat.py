"""Chat formatting: root-to-leaf paths of reply trees by self-joins, branches ranked by score, a template that can be read back."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from panelkit.operators.ranking import running_totals, slice_count, with_slices
from panelkit.session import materialize

HEAD, COLON, END = "### ", ": ", "</turn>\n"
TURN = re.compile(r"### ((?:[^:\\]|\\.)*): (.*)", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
#: What a code after a backslash stands for.
CODES = {"\\": "\\", "h": "#", "l": "<", "c": ":"}


def tree_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """Nodes on the best root-to-leaf paths of each tree: ``tree``, ``leaf``, ``rank``, ``id`` and ``step`` (1 at the root).

    ``nodes`` has ``tree``, ``id``, ``parent`` and ``score``. Branches rank by the mean score of their
    nodes (null: 0), ties by the smaller leaf id; ``branches`` of each tree are kept, all if None. A node whose parent is null
    or doesn't exist is a root; nodes that only lead into a cycle are on no path. A null tree is a tree like any other, and a null
    id an id; of nodes that share tree and id the one with the greatest score counts, of these the smallest parent, nulls last.

    Paths are found by self-joins that double their reach: each node knows its ancestor 1, 2, 4, ... replies up, with the scores
    between, until it has come to a root; chosen leaves then unfold along the same tables. So a thread of n replies takes
    log2(n) rounds, only nodes still on their way take part, and every join is on single nodes, however many a tree has. The one
    best leaf of a tree is a minimum, which combines before the shuffle. Each round is written to the shared folder.
    """
    key = F.struct("tree", "id")
    best = F.struct((-F.coalesce("score", F.lit(0.0)).cast("double")).alias("less"), F.col("parent").isNull().alias("none"), "parent")
    known = nodes.groupBy(key.alias("key")).agg(F.min(best).alias("best")).select(
        "key", F.struct(F.col("key.tree").alias("tree"), F.col("best.parent").alias("id")).alias("up"), (-F.col("best.less")).alias("weight"))
    parents = known.select(F.col("key").alias("anc"))
    first = known.join(parents, (F.col("up") == F.col("anc")) & F.col("up.id").isNotNull(), "left")
    first = materialize(first.select("key", "anc", "weight", F.lit(1).cast("long").alias("hops")), "jumps")
    jumps, count, whole = [first.filter("anc is not null")], first.count(), first.filter("anc is null")
    while (1 << (len(jumps) - 1)) <= count and jumps[-1].limit(1).count():
        there = jumps[-1].unionByName(whole).select(F.col("key").alias("mid"), F.col("anc").alias("far"), F.col("weight").alias("more"),
                                                    F.col("hops").alias("further"))
        next_ = materialize(jumps[-1].join(there, F.col("anc") == F.col("mid")).select(
            "key", F.col("far").alias("anc"), (F.col("weight") + F.col("more")).alias("weight"), (F.col("hops") + F.col("further")).alias("hops")), "jumps")
        whole = whole.unionByName(next_.filter("anc is null"))
        jumps.append(next_.filter("anc is not null"))
    whole = materialize(whole, "depths")
    inner = jumps[0].select(F.col("anc").alias("key")).distinct()
    leaves = whole.join(inner, "key", "left_anti").withColumn("tree", F.col("key.tree"))
    if branches == 1:
        first_leaf = F.min(F.struct((-F.col("weight") / F.col("hops")).alias("less"), F.col("key.id").alias("id"), F.col("hops"))).alias("best")
        chosen = leaves.groupBy("tree").agg(first_leaf).select(F.struct("tree", "best.id").alias("key"), F.col("best.hops").alias("hops"), F.lit(1).alias("rank"))
    else:
        order = Window.partitionBy("tree").orderBy(F.desc(F.col("weight") / F.col("hops")), F.col("key.id"))
        ranked = leaves.withColumn("rank", F.row_number().over(order))
        chosen = ranked if branches is None else ranked.filter(F.col("rank") <= branches)
    parts = materialize(chosen.select(F.col("key").alias("leaf"), "rank", F.col("key").alias("node"), F.col("hops").alias("left")), "paths")
    for k in range(len(jumps) - 1, -1, -1):
        reach = 1 << k
        halves = F.array(F.struct("node", F.lit(reach).cast("long").alias("left")), F.struct(F.col("anc").alias("node"), (F.col("left") - reach).alias("left")))
        split = (parts.filter(F.col("left") > reach).join(jumps[k].select("key", "anc"), F.col("node") == F.col("key"))
                 .select("leaf", "rank", F.explode(halves).alias("p")).select("leaf", "rank", "p.*"))
        parts = materialize(parts.filter(F.col("left") <= reach).unionByName(split), "paths")
    depth = whole.select("key", F.col("hops").alias("step"))
    return parts.join(depth, F.col("node") == F.col("key")).select(F.col("leaf.tree").alias("tree"), F.col("leaf.id").alias("leaf"), "rank",
                                                                   F.col("node.id").alias("id"), "step")


def escaped(text, role: bool = False):
    """Text in which no control string is left: backslashes double, # before ## and < before /turn> become codes; : in roles too."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    out = F.regexp_replace(F.regexp_replace(out, "#(?=##)", "\\\\h"), "<(?=/turn>)", "\\\\l")
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: CODES[m[1]], text)


def format_paths(nodes: DataFrame, branches: int | None = 1, learned: str = "assistant") -> DataFrame:
    """Chosen paths (see ``tree_paths``) as conversations, a piece of text for each turn: ``tree``, ``leaf``, ``rank``, ``step``, ``piece``,
    and where the loss applies in the piece (``loss_begin``, ``loss_end``; null outside turns of role ``learned``).

    The conversation is the pieces in order of ``step``, nothing between, so one of any length is never held whole. ``nodes`` also has
    ``role`` and ``text``; null ones count as empty. Escapes keep control strings out of texts, and ``read_back`` undoes them.
    """
    paths = tree_paths(nodes, branches)
    said = nodes.select(F.struct("tree", "id").alias("key"), "role", "text")
    turns = paths.withColumn("node", F.struct("tree", "id")).join(said, F.col("node") == F.col("key"))
    body, head = escaped(F.col("text")), F.concat(F.lit(HEAD), escaped(F.col("role"), role=True), F.lit(COLON))
    turns = turns.select("tree", "leaf", "rank", "step", "role", body.alias("body"), head.alias("head"))
    learns = F.coalesce(F.col("role") == learned, F.lit(False))
    return turns.select("tree", "leaf", "rank", "step", F.concat("head", "body", F.lit(END)).alias("piece"),
                        F.when(learns, F.length("head")).cast("long").alias("loss_begin"),
                        F.when(learns, F.length("head") + F.length("body")).cast("long").alias("loss_end"))


class _Reader:
    """What one formatted conversation says, read from its pieces as one stream of text."""

    def __init__(self):
        self.rest, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, begin: int | None, end: int | None) -> None:
        self.chars += len(piece)
        *done, self.rest = (self.rest + piece).split(END)
        for turn in done:
            found = TURN.fullmatch(turn)
            if not found:
                raise ValueError(f"not a turn: {turn[:80]!r}")
            self.turns += 1
            self.said.update(f"{unescape(found[1])}\n{unescape(found[2])}\n".encode())
        if begin is not None:
            learned = unescape(piece[begin:end])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())


def read_back(pieces: DataFrame) -> DataFrame:
    """One row for each formatted conversation: ``tree``, ``leaf``, ``n_turns``, ``turns_sha256`` (of role, newline, text, newline per
    turn), ``loss_chars`` and ``loss_sha256`` (of the unescaped text under the loss mask) and ``formatted_chars``.

    Pieces are dealt by conversation and sorted; a task reads them as a stream and holds one turn and the running digests.
    """
    schema = T.StructType([pieces.schema["tree"], pieces.schema["leaf"], T.StructField("n_turns", T.LongType()),
                           T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                           T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def read(batches):
        key, reader = None, None

        def row():
            return {"tree": [key[0]], "leaf": [key[1]], "n_turns": [reader.turns], "turns_sha256": [reader.said.hexdigest()],
                    "loss_chars": [reader.loss_chars], "loss_sha256": [reader.loss.hexdigest()], "formatted_chars": [reader.chars]}

        def batch(rows, kinds):
            return pa.RecordBatch.from_arrays([pa.array([r[name][0] for r in rows], type=kinds.get(name, pa.string() if "sha" in name else pa.int64()))
                                               for name in schema.names], names=schema.names)

        done, kinds = [], {}
        for part in batches:
            kinds = {"tree": part.schema.field(0).type, "leaf": part.schema.field(1).type}
            columns = [part.column(i).to_pylist() for i in (0, 1, 3, 4, 5)]
            for tree, leaf, piece, begin, end in zip(*columns):
                if reader is None or (tree, leaf) != key:
                    if reader is not None:
                        done.append(row())
                    key, reader = (tree, leaf), _Reader()
                reader.add(piece, begin, end)
            if done:
                yield batch(done, kinds)
                done = []
        if reader is not None:
            yield batch([row()], kinds)

    ordered = pieces.select("tree", "leaf", "step", "piece", "loss_begin", "loss_end").repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "step")
    return ordered.mapInArrow(read, schema)


def threads(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", slices: int | None = None) -> DataFrame:
    """Conversations without branches as trees: each row answers the one before it (by turn, nulls first, then role and a hash of the text).

    Rows of each conversation and turn are counted, turns are cut into slices at their quantiles, each slice of a
    conversation is added up on its own, and slices before it come from a table with a row for each. So a conversation with a
    third of all rows is divided by its turns, and texts are only sorted among rows of one turn. Rows that are equal in all are one
    row with a count until they are numbered.
    """
    at = F.coalesce(F.col(turn_col).cast("double"), F.lit(float("-inf")))
    said = turns.select(F.struct(F.col(conv_col).alias("conv"), at.alias("at")).alias("place"), "role", F.xxhash64("text").alias("hash"), "text")
    equal = materialize(said.groupBy("place", "role", "hash").agg(F.count("*").alias("n"), F.first("text").alias("text")), "turns")  # equal rows have equal texts
    by_turn = equal.groupBy("place").agg(F.sum("n").alias("n")).select("place.conv", "place.at", "n")
    count = slices or slice_count(turns)
    cuts = by_turn.agg(F.percentile_approx("at", F.array(*[F.lit(i / count) for i in range(1, count)]), 4 * count)).first()[0] if count > 1 else []
    sliced = with_slices(by_turn, {"at": sorted({c for c in cuts or [] if c > float("-inf")})}).withColumnRenamed("at__slice", "slice")
    before = running_totals(sliced, ["conv"], "at", ["n"], "slice").select(F.struct("conv", "at").alias("place"), "n_before")
    tied = Window.partitionBy("place").orderBy(F.asc_nulls_first("role"), "hash").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("n_before") + F.coalesce(F.col("ahead"), F.lit(0))
    return (equal.withColumn("ahead", F.sum("n").over(tied)).join(before, "place")
            .select(F.col("place.conv").alias("tree"), F.explode(F.sequence(ahead + 1, ahead + F.col("n"))).alias("id"), "role", "text")
            .withColumn("parent", F.when(F.col("id") > 1, F.col("id") - 1)).withColumn("score", F.lit(0.0)))
