"""Documents to elements, and elements to section-aware chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.once import with_once
from ..functions.text import strip_space, words
from ..schemas import CONTENT_TYPES, FIRST_SECTION, HEADING_TYPES, MAX_CHUNK_WORDS
from ..session import work_dir

# Blocks of elements without an id come after those with one.
_AFTER_IDS = 2**40


def keep_content_types(elements: DataFrame) -> DataFrame:
    """Drop page headers, footers, page numbers and elements without a type."""
    return elements.filter(F.col("element_type").isin(*CONTENT_TYPES))


def flatten_elements(parsed: DataFrame) -> DataFrame:
    """(path, parsed) to one row per content element, with its place in the document.

    A document without elements has no row; ``rejected_documents`` names those.
    """
    elements = F.try_variant_get("parsed", "$.document.elements", "array<variant>")
    rows = parsed.select(F.col("path").alias("source_document"), F.posexplode(elements).alias("element_position", "_element"))

    def part(name: str, kind: str) -> Column:
        return F.try_variant_get("_element", f"$.{name}", kind)

    return keep_content_types(
        rows.select(
            "source_document",
            "element_position",
            part("id", "int").alias("element_id"),
            part("type", "string").alias("element_type"),
            part("content", "string").alias("content"),
        )
    )


def _pieces(length: Column, max_words: int) -> Column:
    """Number of chunks that a section of ``length`` words is cut into."""
    return F.ceil(length / F.lit(max_words))


def chunk_by_section(
    elements: DataFrame, max_words: int = MAX_CHUNK_WORDS, block_elements: int = 4096
) -> DataFrame:
    """Chunks of each document, cut at its headings and every ``max_words`` words of a section.

    A heading starts a section and names it; a blank heading starts one under the old name. The
    heading is not part of the chunk text, and a section without words gives no chunk. Elements are
    read by ``element_id``, those with equal ids by ``element_position``, and those without an id
    after the others by ``element_position``. Without that column ids must be present and distinct.
    ``chunk_position`` counts through the document from 0.

    A document may be of any length, so none is sorted or collected as a whole. It is cut into
    blocks of ``block_elements`` element ids, or positions where ids are missing. Running counts are taken inside each block; the last
    row of a block carries its totals, and these (one row per block, at most 2**31 /
    ``block_elements`` for a document) are added up along the document and joined back. An
    element's words are then cut at chunk borders before they are grouped, so that a group holds
    ``max_words`` words at most.
    """
    if "element_position" not in elements.columns:
        elements = elements.withColumn("element_position", F.lit(0))
    is_heading = F.coalesce(F.col("element_type").isin(*HEADING_TYPES), F.lit(False))
    worded = with_once(
        elements, heading=is_heading, words=F.when(is_heading, F.array()).otherwise(words(F.col("content")))
    )
    blocked = worded.select(
        "source_document",
        F.coalesce(
            F.floor(F.col("element_id") / block_elements), F.floor(F.col("element_position") / block_elements) + _AFTER_IDS
        ).alias("block"),
        "element_id",
        "element_position",
        "heading",
        F.when(F.col("heading"), F.nullif(strip_space(F.col("content")), F.lit(""))).alias("name"),
        F.array_join("words", " ").alias("text"),
        F.size("words").cast("long").alias("length"),
    )

    # Inside a block.
    order = W.partitionBy("source_document", "block").orderBy("element_id", "element_position")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    at_heading = F.when(F.col("heading"), F.col("words_before"))
    inside = (
        blocked.withColumns(
            {
                "headings": F.count_if("heading").over(so_far),
                "words_before": F.sum("length").over(so_far) - F.col("length"),
                "own_name": F.last("name", ignorenulls=True).over(so_far),
                "block_end": F.lead(F.lit(True)).over(order).isNull(),
            }
        )
        .withColumns(
            {
                "first_heading_at": F.min(at_heading).over(so_far),
                "section_at": F.max(at_heading).over(so_far),
                "previous_section_at": F.max(at_heading).over(earlier),
            }
        )
        .withColumn(
            "closed_pieces",
            F.coalesce(
                F.sum(
                    F.when(
                        F.col("heading"), _pieces(F.col("words_before") - F.col("previous_section_at"), max_words)
                    )
                ).over(so_far),
                F.lit(0),
            ),
        )
    )

    # Written once, as the totals and the elements would each parse, shuffle and sort all of it.
    spark, folder = inside.sparkSession, work_dir(inside.sparkSession, "blocks")
    inside = inside.drop("element_id", "element_position", "heading", "name", "previous_section_at")
    inside.write.parquet(folder)
    inside = spark.read.schema(inside.schema).parquet(folder)

    # Along the document, one row per block. words_0, section_0, name_0 and pieces_0 are the words
    # before the block, the word at which the open section began, its name, and the chunks of all
    # sections closed before the block. first_pieces belongs to the section that the first heading
    # of the block closes.
    along = W.partitionBy("source_document").orderBy("block")
    before = along.rowsBetween(W.unboundedPreceding, -1)
    carried = (
        inside.filter("block_end")
        .select(
            "source_document",
            "block",
            "own_name",
            "section_at",
            "first_heading_at",
            "closed_pieces",
            (F.col("words_before") + F.col("length")).alias("block_words"),
        )
        .withColumns(
            {
                "words_0": F.coalesce(F.sum("block_words").over(before), F.lit(0)),
                "name_0": F.last("own_name", ignorenulls=True).over(before),
            }
        )
        .withColumn(
            "section_0", F.coalesce(F.max(F.col("words_0") + F.col("section_at")).over(before), F.lit(0))
        )
        .withColumn(
            "first_pieces",
            F.coalesce(
                _pieces(F.col("words_0") + F.col("first_heading_at") - F.col("section_0"), max_words), F.lit(0)
            ),
        )
        .withColumn(
            "pieces_0",
            F.coalesce(F.sum(F.col("first_pieces") + F.col("closed_pieces")).over(before), F.lit(0)),
        )
        .select("source_document", "block", "words_0", "name_0", "section_0", "first_pieces", "pieces_0")
    )

    # Each element: where its words lie in the section, and the first chunk of the section.
    own_section = F.col("headings") > 0
    section_start = F.when(own_section, F.col("words_0") + F.col("section_at")).otherwise(F.col("section_0"))
    placed = (
        inside.filter("length > 0")
        .join(carried, ["source_document", "block"])
        .select(
            "source_document",
            F.coalesce("own_name", "name_0", F.lit(FIRST_SECTION)).alias("section"),
            (
                F.col("pieces_0")
                + F.when(own_section, F.col("first_pieces") + F.col("closed_pieces")).otherwise(0)
            ).alias("section_chunk"),
            (F.col("words_0") + F.col("words_before") - section_start).alias("offset"),
            "length",
            "text",
        )
    )

    # Cut at chunk borders, then put the chunks together. Most elements lie within one chunk.
    end = F.col("offset") + F.col("length")
    piece_start = F.greatest(F.col("offset"), F.col("piece") * max_words)
    piece_end = F.least(end, (F.col("piece") + 1) * max_words)
    pieces = placed.withColumn(
        "piece",
        F.explode(
            F.sequence(F.floor(F.col("offset") / max_words), F.floor((end - 1) / max_words))
        ),
    ).select(
        "source_document",
        "section",
        (F.col("section_chunk") + F.col("piece")).cast("int").alias("chunk_position"),
        piece_start.alias("at"),
        F.when(piece_end - piece_start == F.col("length"), F.col("text"))
        .otherwise(
            F.array_join(
                F.slice(
                    F.split("text", " "),
                    (piece_start - F.col("offset") + 1).cast("int"),
                    (piece_end - piece_start).cast("int"),
                ),
                " ",
            )
        )
        .alias("part"),
    )
    return (
        pieces.groupBy("source_document", "chunk_position")
        .agg(
            F.first("section").alias("section"),
            F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts"),
        )
        .select(
            F.concat("source_document", F.lit("::chunk_"), "chunk_position").alias("chunk_id"),
            "source_document",
            "chunk_position",
            "section",
            F.array_join("parts.part", " ").alias("chunk_text"),
        )
    )
