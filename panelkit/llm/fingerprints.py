"""Document fingerprints: one-permutation MinHash with optimal densification, packed low-order bits, bias-corrected likeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHINGLE = 5
BINS, BITS = 128, 8
#: Bins that an empty bin draws one by one.
DRAWS = 12
#: Sampled ids for each slice of the id range.
SAMPLE = 20
SPACES = " \t\n\x0b\f\r"


def _pairs(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def _tail(items: Column, skip: int) -> Column:
    return F.slice(items, F.lit(skip + 1), F.greatest(F.size(items) - skip, F.lit(0)))


def _head(items: Column, drop: int) -> Column:
    return F.slice(items, F.lit(1), F.greatest(F.size(items) - drop, F.lit(0)))


def draw(b: int, n: int) -> int:
    """The n-th bin that bin b draws: a multiplicative hash of both."""
    x = ((b * DRAWS + n + 1) * 0x9E3779B97F4A7C15) % (1 << 64)
    return (((x ^ (x >> 31)) * 0xD6E8FEB86659FD93) % (1 << 64)) >> (65 - BINS.bit_length())


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: for each of ``BINS`` bins the low ``BITS`` bits of its smallest shingle hash.

    Words are separated by ASCII white space; shingles are ``SHINGLE`` words, a shorter text is one shingle, and texts without
    words, null ones too, share the shingle of no words. Each shingle hash falls into the bin of its top bits. A bin without
    hash draws bins, in the same order in all documents, and takes the hash of the first occupied one, so that every empty bin
    chooses for itself, evenly among the occupied ones (Shrivastava, "Optimal densification for fast and accurate minwise
    hashing"). If ``DRAWS`` bins were empty, it takes the occupied bin that a hash of the pair of bins orders first. Built-in
    functions only; nothing is shuffled.
    """
    width = BINS.bit_length() - 1
    bin_of = lambda h: F.shiftrightunsigned(h, 64 - width)
    hashes, two, sorted_, lows, taken, given = (f"_{out}_{x}" for x in ("words", "two", "sorted", "lows", "taken", "given"))
    df = df.withColumn(hashes, F.transform(F.split(F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES)), "[\\x20\\x09-\\x0D]+"), lambda w: F.xxhash64(w)))
    df = df.withColumn(two, _pairs(_head(F.col(hashes), 1), _tail(F.col(hashes), 1)))
    four = _pairs(_head(F.col(two), 2), _tail(F.col(two), 2))
    df = df.withColumn(sorted_, F.sort_array(F.when(F.size(hashes) >= SHINGLE, _pairs(_head(four, 1), _tail(F.col(hashes), SHINGLE - 1)))
                                             .otherwise(F.array(F.xxhash64(hashes)))))
    before = F.concat(F.array(F.lit(None).cast("long")), _head(F.col(sorted_), 1))
    df = df.withColumn(lows, F.filter(F.zip_with(sorted_, before, lambda h, b: F.when(b.isNull() | (bin_of(h) != bin_of(b)), h)), lambda h: h.isNotNull()))
    df = df.withColumn(taken, F.transform(lows, bin_of))
    bins = F.array(*[F.lit(b) for b in range(BINS)])
    df = df.withColumn(given, F.transform(bins, lambda b: F.get(F.col(lows), F.array_position(taken, b.cast("long")).cast("int") - 1)))
    drawn = lambda b: [F.get(F.col(given), F.get(F.array(*[F.lit(draw(k, n)) for k in range(BINS)]), b)) for n in range(DRAWS)]
    last = lambda b: F.array_min(F.zip_with(lows, taken, lambda h, t: F.struct(F.xxhash64(b, t).alias("order"), h.alias("low"))))["low"]
    low = lambda b: F.coalesce(F.get(F.col(given), b), *drawn(b), last(b))
    df = df.withColumn(out, F.transform(bins, lambda b: low(b).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")))
    return df.drop(hashes, two, sorted_, lows, taken, given)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles: bins of unlike texts agree by chance in 2^-BITS of cases, which is taken out."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x) / F.lit(float(BINS))
    chance = 2.0 ** -BITS
    return F.greatest((same - F.lit(chance)) / F.lit(1 - chance), F.lit(0.0))


def packed(bins: Column) -> Column:
    """The bins as lowercase hex digits, ``BITS`` / 4 a bin."""
    return F.lower(F.array_join(F.transform(bins, lambda v: F.lpad(F.hex(v), BITS // 4, "0")), ""))


def _slice_bounds(rows: DataFrame, slices: int) -> list:
    """Ids that cut the id range into about even slices, from a bounded sample by hash."""
    ids = sorted(r[0] for r in rows.filter(F.col("id").isNotNull()).select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE * slices).collect())
    return sorted({ids[k * len(ids) // slices] for k in range(1, slices)}) if ids else []


def _slice_of(bounds: list) -> Column:
    """How many bounds are at most the id, by binary search; 0 without id."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= F.col("id"), at + step).otherwise(at))


def in_slices(rows: DataFrame):
    """``rows`` (``id``, ``hash`` and others) cut into slices of the id range, each with a copy of the row that follows its last one
    (marked ``guest``), and the window that orders a slice by id and hash. After the last row comes the first.

    The bounds of slices come from a bounded sample; as many rows as there are slices pass through the driver; a window over
    all of it shuffles the table once. Rows without id come first; of equal rows one follows the other.
    """
    spark = rows.sparkSession
    sliced = rows.withColumn("slice", _slice_of(_slice_bounds(rows, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    order = [F.col("id").isNotNull(), F.col("id"), F.col("hash")]
    firsts = sorted(((r["slice"], r["first"]) for r in sliced.groupBy("slice").agg(
        F.min(F.struct(order[0].alias("known"), "id", "hash")).alias("first")).collect()), key=lambda x: x[0])
    heads = spark.createDataFrame([(s, f["id"], f["hash"]) for (s, _), (_, f) in zip(firsts, firsts[1:] + firsts[:1])],
                                  f"to_slice int, of_id {rows.schema['id'].dataType.simpleString()}, of_hash bigint")
    heads = heads.select(F.struct("of_id", "of_hash").alias("head"), "to_slice")
    places = F.array(F.struct(F.col("slice"), F.lit(False).alias("guest")), F.struct(F.col("to_slice").alias("slice"), F.lit(True).alias("guest")))
    everyone = (sliced.join(F.broadcast(heads), F.struct("id", "hash").eqNullSafe(F.col("head")), "left")
                .withColumn("place", F.explode(F.filter(places, lambda p: p["slice"].isNotNull())))
                .select(*rows.columns, "place.slice", "place.guest"))
    return everyone, Window.partitionBy("slice").orderBy("guest", *order)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_chars``, ``edited`` (the text whose last floor(n_chars / 2) code points are replaced by
    the first as many, or all, of the next document by ascending id; after the last comes the first), ``fingerprint`` and
    ``edited_fingerprint`` (hex of packed bins), ``near_edited`` and ``near_next``.

    Null texts count as empty. Rows without id come first; rows that share an id follow by a hash of their text; a single row is
    its own next. Other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    everyone, follows = in_slices(rows)
    done = with_fingerprint(everyone, "text", "bins")
    done = (done.withColumn("next_text", F.lead("text").over(follows)).withColumn("next_bins", F.lead("bins").over(follows))
            .filter("not guest").withColumn("n_chars", F.length("text").cast("long")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    done = done.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half)))
    done = with_fingerprint(done, "edited", "edited_bins")
    return done.select(F.col("id").alias(id_col), "n_chars", "edited", packed(F.col("bins")).alias("fingerprint"),
                       packed(F.col("edited_bins")).alias("edited_fingerprint"),
                       likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
                       likeness(F.col("bins"), F.col("next_bins")).alias("near_next"))
