"""Document fingerprints: SimHash over weighted word pairs, and search by
permuted block tables. DataFrame expressions only.

Every pair of neighbouring words votes with its weight (its letters, up to 24:
long words are rarer) for or against each of the 64 bits of its hash. Two bit
votes are added in one number, so 32 sums carry all 64 votes.

For the search, the 64 bits are cut into ``radius + 3`` blocks, and each choice
of three blocks is one permuted table with those bits in front as the key. Values
within ``radius`` bits share at least one key, so probing all tables finds them all.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import ordered_positions
from .common import doc_key, stored

_LANES = 0x0000000100000001
_BLANK = " \t\n\x0b\f\r"
RADIUS = 3


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``fp`` (long) for each distinct ``keys``. Text is split at white
    space, case kept; a text without words has the hash of the empty word."""
    pairs = texts.select(*keys, F.split(F.coalesce(F.btrim(F.col(text), F.lit(_BLANK)), F.lit("")), r"\s+").alias("_words")) \
        .select(*keys, F.zip_with("_words", F.slice("_words", 2, F.size("_words")), lambda a, b: F.struct(
            F.xxhash64(a, b).alias("h"),
            F.least(F.length(a) + F.coalesce(F.length(b), F.lit(0)) + 1, F.lit(24)).cast("long").alias("w")
        )).alias("_pairs")) \
        .select(*keys, F.explode("_pairs").alias("_p")).select(*keys, "_p.h", "_p.w")
    votes = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(_LANES)) * F.col("w")).alias(f"_v{j}")
             for j in range(32)]
    summed = pairs.groupBy(*keys).agg(F.sum("w").alias("_all"), *votes)
    bits = []
    for j in range(32):
        low = F.col(f"_v{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"_v{j}"), 32)
        for place, vote in ((j, low), (j + 32, high)):
            value = (1 << place) - ((1 << 64) if place == 63 else 0)
            bits.append(F.when(2 * vote > F.col("_all"), F.lit(value)).otherwise(F.lit(0)).cast("long"))
    return summed.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal bits, 0 to 1."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def block_masks(radius: int) -> list[int]:
    n = radius + 3
    edges = [64 * k // n for k in range(n + 1)]
    blocks = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(n)]
    return [sum(c) for c in combinations(blocks, 3)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``query, fp, distance``: for each distinct ``query`` all distinct ``fp`` at
    most ``radius`` bits away, itself included if it is there."""
    masks = [F.lit(_signed(m)) for m in block_masks(radius)]

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = [F.struct(F.lit(i).alias("t"), F.col(name).bitwiseAND(m).alias("key"))
                for i, m in enumerate(masks)]
        return df.select(name, F.explode(F.array(*keys)).alias("k")).select(name, "k.t", "k.key")

    diff = F.col("query").bitwiseXOR(F.col("fp"))
    # a pair is reported by the first table that holds it
    first = F.coalesce(*[F.when(diff.bitwiseAND(m) == 0, F.lit(i)) for i, m in enumerate(masks)])
    return tables(queries.select("query").distinct(), "query") \
        .join(tables(fps.select("fp").distinct(), "fp"), ["t", "key"]) \
        .where((F.bit_count(diff) <= radius) & (F.col("t") == first)) \
        .select("query", "fp", F.bit_count(diff).alias("distance"))


def _order(rows: DataFrame) -> DataFrame:
    """Each document with its next one, by descending doc_id (then text hash);
    the last is followed by the first."""
    keys = rows.groupBy("key_id", "key_hash").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.char_length("text")).alias("n_chars"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(ordered_positions(keys, [F.col("doc_id").desc_nulls_last(), F.col("key_hash")],
                                      num_partitions=n), "fingerprint-order")
    after = placed.select(F.when(F.col("rank") == 1, F.col("group_count")).otherwise(F.col("rank") - 1)
                          .alias("rank"), F.col("key_id").alias("next_id"), F.col("key_hash").alias("next_hash"))
    return stored(placed.join(after, "rank").select(
        "key_id", "key_hash", "n_chars", F.floor(F.col("n_chars") / 3).cast("int").alias("cut"),
        "next_id", "next_hash"), "fingerprint-next")


def edited_fingerprints(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_near`` for every row.

    The edited text has the last third of the code points replaced by the
    beginning of the next document's text. ``n_near`` counts the document rows
    within ``radius`` bits, itself included, for the query set (ids divisible by
    100), and is null for the rest. Null texts count as empty. Rows equal in id
    and text are one document in the order and get equal results; rows that
    share an id only are ordered by text hash; rows without id come last. A lone
    document is its own next. An empty table gives no rows; columns besides
    ``doc_id`` and ``text`` are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *doc_key(),
                       F.coalesce("text", F.lit("")).alias("text"))
    order = _order(rows)
    wanted = order.select(F.col("key_id").alias("to_id"), F.col("key_hash").alias("to_hash"), "cut",
                          F.col("next_id").alias("key_id"), F.col("next_hash").alias("key_hash"))
    heads = rows.join(wanted, ["key_id", "key_hash"]) \
        .select(F.col("to_id").alias("key_id"), F.col("to_hash").alias("key_hash"),
                F.expr("substring(text, 1, cut)").alias("head")).groupBy("key_id", "key_hash") \
        .agg(F.min("head").alias("head"))
    both = rows.select("key_id", "key_hash", "text").join(heads, ["key_id", "key_hash"]) \
        .withColumn("n", F.char_length("text")) \
        .withColumn("edited", F.expr("concat(substring(text, 1, n - cast(floor(n / 3) AS int)), head)"))
    texts = both.select("key_id", "key_hash", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("v")) \
        .select("key_id", "key_hash", "v.kind", "v.text").withColumn("sha", F.sha2("text", 256))
    marks = stored(fingerprints(texts, ["key_id", "key_hash", "kind", "sha"]), "fingerprint-marks")
    own = marks.where("kind = 0").select("key_id", "key_hash", "fp")
    edited = marks.where("kind = 1").select("key_id", "key_hash", F.col("fp").alias("edited_fp"),
                                            F.col("sha").alias("edited_sha256"))
    following = own.select(F.col("key_id").alias("next_id"), F.col("key_hash").alias("next_hash"),
                           F.col("fp").alias("next_fp"))
    result = stored(order.join(own, ["key_id", "key_hash"]).join(edited, ["key_id", "key_hash"])
                    .join(following, ["next_id", "next_hash"])
                    .select("key_id", "key_hash", "n_chars", "fp", "edited_fp", "edited_sha256", "next_fp"),
                    "fingerprint-result")
    ids = rows.select("doc_id", "key_id", "key_hash")
    full = stored(ids.join(result, ["key_id", "key_hash"]), "fingerprint-rows")
    counts = full.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    asked = full.where("doc_id % 100 = 0").select(F.col("fp").alias("query"))
    near = stored(within_radius(asked, counts, radius).join(counts, "fp")
                  .groupBy("query").agg(F.sum("n").alias("n_near")), "fingerprint-near")
    return full.join(near.withColumnRenamed("query", "fp"), "fp", "left").select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.lpad(F.lower(F.hex("edited_fp")), 16, "0").alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"),
        F.when(F.col("doc_id") % 100 == 0, F.col("n_near")).alias("n_near"))
