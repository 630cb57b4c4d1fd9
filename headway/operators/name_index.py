"""An index of names by their three-letter pieces, and names that resemble many texts at once.

At load, names become posting lists: for every piece the spellings that hold it, each with the
number of its pieces and the place of this one among them in order of frequency, rarest first. A
text and a name that share a fraction ``t`` of all their pieces, and two or more, share two of the
first ``n - ceil(t n) + 2`` of either. They meet by these two, and whole sets are compared only where
lengths and a few bits of both sets leave room for ``t``. Sets of which one piece may be enough are so
small that they meet by every piece, over their postings.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.functions.texts import overlap_share, trigrams

ROUNDING = 1e-9  # taken off before a product with a decimal fraction is rounded up
WORDS = 2  # of 64 bits each, which stand for a set of pieces where pairs meet


@dataclass
class NameIndex:
    """``names``: all columns of the rows with their ``spelling``; ``spellings``: spelling, pieces,
    size; ``postings``: piece, size, place, spelling; ``often``: piece, names."""

    names: DataFrame
    spellings: DataFrame
    postings: DataFrame
    often: DataFrame


PARTS = ["names", "spellings", "postings", "often"]


def _rarest_first(pieces: DataFrame, often: DataFrame) -> DataFrame:
    """``spelling, pieces, size`` of rows (spelling, piece); pieces that no name holds come first."""
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "piece")))
    return (pieces.join(often, "piece", "left").groupBy("spelling").agg(order.alias("o"))
            .select("spelling", F.transform("o", lambda x: x["piece"]).alias("pieces"),
                    F.size("o").alias("size")))


def _pieces(rows: DataFrame) -> DataFrame:
    return rows.select("spelling").distinct().select("spelling", F.explode(trigrams(F.col("spelling"))).alias("piece"))


def index_names(names: DataFrame, column: str) -> NameIndex:
    """Index of ``names`` by ``column``; equal spellings, whatever their case, are one entry."""
    held = names.withColumn("spelling", F.lower(F.col(column)))
    pieces = _pieces(held)
    often = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("names"))
    spellings = _rarest_first(pieces, often)
    postings = spellings.select("spelling", "size", F.posexplode("pieces").alias("place", "piece"))
    return NameIndex(held, spellings, postings.select("piece", "size", "place", "spelling"), often)


def write_name_index(index: NameIndex, root: str) -> None:
    """Store an index; postings are spread and sorted by piece and size, so a search skips most."""
    root = root.rstrip("/")
    index.names.write.mode("overwrite").parquet(f"{root}/names")
    index.often.write.mode("overwrite").parquet(f"{root}/often")
    index.spellings.write.mode("overwrite").parquet(f"{root}/spellings")
    stored = index.names.sparkSession.read.parquet(f"{root}/spellings")
    postings = stored.select("spelling", "size", F.posexplode("pieces").alias("place", "piece"))
    (postings.select("piece", "size", "place", "spelling").hint("rebalance", "piece")
     .sortWithinPartitions("piece", "size").write.mode("overwrite")
     .option("parquet.bloom.filter.enabled#piece", "true").parquet(f"{root}/postings"))


def load_name_index(spark: SparkSession, root: str) -> NameIndex:
    return NameIndex(*[spark.read.parquet(f"{root.rstrip('/')}/{part}") for part in PARTS])


def _at_least(size: Column, share: float) -> Column:
    """The fewest pieces that are ``share`` of ``size``."""
    return F.ceil(size * share - F.lit(ROUNDING))


def _fewest(size: Column, share: float) -> Column:
    """How many pieces a set of ``size`` has in common, at least, with one it shares two pieces and
    ``share`` with."""
    return F.greatest(_at_least(size, share), F.lit(2))


def _bits(pieces: Column, word: int) -> Column:
    """64 bits of a set: every piece sets one bit, chosen by hash, of one word."""
    place = lambda p: F.pmod(F.xxhash64(p), F.lit(64 * WORDS)).cast("int")
    bit = lambda p: F.when(F.floor(place(p) / 64) == word, F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.pmod(place(p), F.lit(64)))).otherwise(F.lit(0).cast("bigint"))
    return F.aggregate(pieces, F.lit(0).cast("bigint"), lambda held, p: held.bitwiseOR(bit(p)))


def _rare_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """``id, size, bits..., key`` for every two rare pieces of each spelling, by hashes."""
    size = F.col("size")
    rare = F.slice("pieces", F.lit(1), F.least(size, size - _fewest(size, threshold) + 2).cast("int"))
    hashes = F.transform(rare, lambda p: F.xxhash64(p))
    pairs = F.flatten(F.transform(hashes, lambda p, i: F.transform(
        F.slice(hashes, i + 2, F.size(hashes)), lambda q: F.xxhash64(p, q))))
    words = [_bits(F.col("pieces"), w).alias(f"bits{w}") for w in range(WORDS)]
    return (rows.where(size > 1).select(F.xxhash64("spelling").alias("id"), "size", *words, pairs.alias("keys"))
            .select("*", F.explode("keys").alias("key")).drop("keys"))


def _by_pairs(texts: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """``text, name``, as hashes: sets that meet in two rare pieces and whose bits leave room for
    ``threshold``. A bit that only one set has is a piece that the other lacks."""
    side = lambda rows, prefix: rows.select("key", *[F.col(c).alias(prefix + c) for c in rows.columns if c != "key"])
    asked = side(_rare_pairs(texts, threshold), "a_")
    held = side(_rare_pairs(names, threshold), "b_")
    n, m = F.col("a_size"), F.col("b_size")

    def only(one: str, other: str) -> Column:
        return reduce(Column.__add__, [F.bit_count(F.col(f"{one}_bits{w}").bitwiseAND(F.bitwise_not(f"{other}_bits{w}")))
                                       for w in range(WORDS)])

    wanted = _at_least(n + m, threshold / (1 + threshold))
    # Neither side is broadcast: each holds far more rows than the spellings it is built from.
    return (asked.join(held.hint("merge"), "key")
            .where((m >= _at_least(n, threshold)) & (n >= _at_least(m, threshold))
                   & (n - only("a", "b") >= wanted) & (m - only("b", "a") >= wanted))
            .select(F.col("a_id").alias("text"), F.col("b_id").alias("name")).distinct())


def _by_pieces(texts: DataFrame, postings: DataFrame, threshold: float) -> DataFrame:
    """``text, name``, as hashes, of sets so small that a single shared piece may be enough."""
    small = _at_least(F.col("size"), threshold) < 2
    asked = texts.where(small).select(F.xxhash64("spelling").alias("text"), F.col("size").alias("n"),
                                      F.explode("pieces").alias("piece"))
    held = postings.where(small).select("piece", F.xxhash64("spelling").alias("name"), F.col("size").alias("m"))
    wanted = _at_least(F.col("n") + F.col("m"), threshold / (1 + threshold))
    return (asked.join(held, "piece").groupBy("text", "name", "n", "m").agg(F.count(F.lit(1)).alias("common"))
            .where(F.col("common") >= wanted).select("text", "name"))


def candidates(index: NameIndex, texts: DataFrame, threshold: float) -> DataFrame:
    """``text, name``, hashes of spellings: the pairs whose whole sets are compared. ``texts`` are
    spellings with their pieces.

    Only hashes, sizes and bits meet here, one row per spelling and two of its rare pieces, so
    what is moved grows with the spellings; pairs without room for ``threshold`` are dropped where
    they meet. Equal hashes of different spellings only lead to another comparison.
    """
    return (_by_pairs(texts, index.spellings, threshold)
            .union(_by_pieces(texts, index.postings, threshold)).distinct())


def similar_names(index: NameIndex, texts: DataFrame, column: str, threshold: float = 0.3) -> DataFrame:
    """Each row of ``texts`` with every indexed name that shares at least ``threshold`` (above 0) of the
    pieces of both: columns of ``texts``, columns of the names, ``similarity``.

    Equal spellings are compared once; the answer is then joined to all rows that have them.
    Texts without letters or digits resemble nothing.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a fraction above 0")
    asked = texts.withColumn("_text", F.lower(F.col(column)))
    spelled = _rarest_first(_pieces(asked.select(F.col("_text").alias("spelling"))), index.often)
    pairs = candidates(index, spelled, threshold)
    share = overlap_share(F.col("own"), F.col("pieces"))
    scored = (pairs.join(spelled.select(F.xxhash64("spelling").alias("text"), F.col("spelling").alias("_text"),
                                        F.col("pieces").alias("own")), "text")
              .join(index.spellings.select(F.xxhash64("spelling").alias("name"), "spelling", "pieces"), "name")
              .select("_text", "spelling", share.alias("similarity"))
              .where(F.col("similarity") >= threshold))
    return asked.join(scored, "_text").join(index.names, "spelling").drop("_text", "spelling")
