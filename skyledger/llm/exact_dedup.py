"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then a hash of the whole.

Texts are equal when they are identical without white space. Everything is SQL functions; texts are
read in two scans and never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.tables import stored
from skyledger.operators.joins import join_unique, own_shuffle

# The characters that do not count.
WHITE = (" ", "\t", "\n", "\x0b", "\f", "\r")
# Characters of the beginning that is hashed before whole texts are.
PREFIX = 64
# Bits of the filter that tells which texts are hashed whole: 16 MB at any size of the corpus.
FILTER_BITS = 1 << 27


def normalised(text: str) -> Column:
    """The text without white space; null is empty."""
    value = F.coalesce(F.col(text), F.lit(""))
    for character in WHITE:
        value = F.replace(value, F.lit(character), F.lit(""))
    return value


def _levels(normal: str) -> list[Column]:
    """The first two levels of refinement: bytes, and a hash of the beginning."""
    return [
        F.octet_length(normal).alias("_bytes"),
        F.xxhash64(F.substring(normal, 1, PREFIX)).alias("_prefix"),
    ]


def _place() -> Column:
    """The bit that stands for a (length, prefix hash) pair."""
    return F.pmod(F.xxhash64("_bytes", "_prefix"), F.lit(FILTER_BITS))


def _suspects(docs: DataFrame, text: str) -> DataFrame:
    """Bitmaps of the (length, prefix hash) pairs that several texts share, by number of the bitmap.

    Lengths that occur once leave before prefixes are compared. At most ``FILTER_BITS`` / 32,768 rows of
    4 KB each come out, however many documents there are.
    """
    rows = stored(docs.select(normalised(text).alias("_normal")).select(*_levels("_normal")), "lengths")
    lengths = rows.groupBy("_bytes").agg(F.count("*").alias("_rows")).where("_rows > 1").select("_bytes")
    alike = rows.join(own_shuffle(lengths, ["_bytes"]), "_bytes", "left_semi")
    pairs = alike.groupBy("_bytes", "_prefix").agg(F.count("*").alias("_rows")).where("_rows > 1")
    bits = pairs.select(F.bitmap_bucket_number(_place()).alias("_map"), F.bitmap_bit_position(_place()).alias("_bit"))
    return bits.groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def exact_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", carry: Sequence[str] = (), digests: bool = False
) -> DataFrame:
    """(id, keep_id, group_size, kept), one row per row of ``docs``, and the columns of ``carry``.

    Of equal texts, the row with the most characters before white space went stays, then the one of
    least id; rows without an id come last. Of rows alike in both, any one is marked ``kept``. A null
    text is empty, and empty texts are equal. ``carry`` names other columns of ``docs`` than the
    result's own; further columns are ignored, whatever their names.

    A length is compared first, then the hash of the first ``PREFIX`` characters of those texts whose
    length others have; SHA-256 is taken of the texts alike in both. Which these are, a filter of
    bits tells inside the second scan; a text that it lets through by chance is only hashed in vain.
    What is grouped are digests, so a group of any size is counted before it is shuffled. With
    ``digests`` the column ``text_sha256`` gives the digest of every text, which then reads all of
    them whole.
    """
    digest = F.sha2("_normal", 256)
    suspect = F.when(
        F.col("_bits").isNotNull(),
        # One byte of the bitmap as a number, shifted to the bit asked for.
        F.conv(F.hex(F.expr("substring(_bits, int(_bit div 8) + 1, 1)")), 16, 10).cast("long").bitwiseAND(F.expr("shiftleft(1L, int(_bit % 8))")) != 0,
    ).otherwise(False)
    read = docs.select(F.col(id).alias("_id"), F.struct(*carry, F.lit(0)).alias("_carried"), F.col(text).alias("_text"))
    read = read.withColumn("_normal", normalised("_text")).select(
        "_id", "_carried", "_normal", F.char_length(F.coalesce("_text", F.lit(""))).alias("_chars"), *_levels("_normal")
    )
    read = read.withColumns({"_map": F.bitmap_bucket_number(_place()), "_bit": F.bitmap_bit_position(_place())})
    # The filter has a fixed size.
    tested = read.join(F.broadcast(_suspects(docs, text)), "_map", "left").withColumn("_suspect", suspect)
    hashed = tested.select(
        "_id", "_carried", "_chars", "_suspect",
        (digest if digests else F.when(F.col("_suspect"), digest)).alias("_digest"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = stored(hashed, "digests")
    order = F.struct(-F.col("_chars"), F.col("_id").isNull(), "_id", "_row")
    groups = rows.where("_suspect").groupBy("_digest").agg(
        F.count("*").alias("_size"), F.min_by(F.struct("_id", "_row"), order).alias("_keep")
    )
    grouped = join_unique(rows.where("_suspect"), groups, ["_digest"])
    alone = rows.where("NOT _suspect").select("*", F.lit(1).cast("long").alias("_size"), F.struct("_id", "_row").alias("_keep"))
    return grouped.unionByName(alone).select(
        F.col("_id").alias(id),
        F.col("_keep._id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_keep._row")).alias("kept"),
        *[F.col(f"_carried.`{name}`").alias(name) for name in carry],
        *([F.col("_digest").alias("text_sha256")] if digests else []),
    )
