"""How far the vocabularies of the sources of a language lie apart, by exact one-hot level products.

What a term adds to the divergence of two sources depends on its two counts only. So each term becomes
a row of indicators, one column per (source, count), and the product of the transposed indicators with
themselves counts the terms for every pair of columns: all joint tables of counts at once. These, not
the terms, are priced.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.tables import stored
from skyledger.operators.joins import join_unique, own_shuffle

# Entries and bytes of text after which a task hands on its counts so far.
HELD_TERMS = 300_000
HELD_BYTES = 256 << 20
# Bytes of text split at a time, up to the next end of a term.
PIECE = 1 << 20
# Columns of a tile of the product, and cells of a block of indicators.
COLUMNS = 1024
CELLS = 1 << 23
SCALE = 1_000_000_000

_COUNTS = "lang string, source string, term binary, count long, docs long"
_JOINT = "lang string, a string, a_count long, b string, b_count long, terms long"
# Letters and bytes of other characters stay, A-Z in lower case; the rest parts terms.
_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, for the documents of a task."""
    held: dict = defaultdict(lambda: (Counter(), Counter()))
    terms = size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (total, docs) in held.items():
            names = list(total)
            for first in range(0, len(names), 50_000):
                some = names[first : first + 50_000]
                yield pa.record_batch(
                    [
                        pa.array([lang] * len(some), pa.string()),
                        pa.array([source] * len(some), pa.string()),
                        pa.array(some, pa.binary()),
                        pa.array([total[name] for name in some], pa.int64()),
                        pa.array([docs[name] for name in some], pa.int64()),
                    ],
                    names=["lang", "source", "term", "count", "docs"],
                )
        held.clear()

    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            data = text.as_py().translate(_KEPT)
            total, docs = held[lang, source]
            before, seen = len(total), set()
            for words in _pieces(data):
                total.update(words)
                seen.update(words)
            docs.update(seen)
            terms += len(total) - before
            size += len(data)
            if terms > HELD_TERMS or size > HELD_BYTES:
                yield from flush()
                terms = size = 0
    yield from flush()


def term_counts(docs: DataFrame, least_docs: int = 3) -> DataFrame:
    """(lang, term, total, counts) of the terms in at least ``least_docs`` documents of a language.

    ``counts`` holds (source, count) of the sources that have the term. A row of ``docs`` is a
    document, repeated or not; null text, lang and source are empty.
    """
    rows = docs.select(*[F.coalesce(name, F.lit("")).alias(name) for name in ("lang", "source", "text")])
    partial = rows.mapInArrow(_count, _COUNTS).withColumn("term", F.col("term").cast("string"))
    # Tasks have counted, so a frequent term brings few rows; both groupings use one shuffle.
    placed = partial.repartition("lang", "term")
    by_source = placed.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("total"), F.collect_list(F.struct("source", "count")).alias("counts")
    )
    return by_term.where(F.col("docs") >= least_docs).drop("docs")


def _tiles(rows: int, at: np.ndarray, column: np.ndarray, columns: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries above the diagonal, and on it, of the product of one block of indicators with itself."""
    # Sums of ones below 2**24 are exact in single precision.
    ones = np.zeros((rows, columns), dtype=np.float32)
    ones[at, column] = 1
    for i in range(0, columns, COLUMNS):
        for j in range(i, columns, COLUMNS):
            product = ones[:, i : i + COLUMNS].T @ ones[:, j : j + COLUMNS]
            a, b = np.nonzero(product)
            above = i + a <= j + b
            a, b = a[above], b[above]
            yield i + a, j + b, product[a, b].astype(np.int64)


def _blocks(starts: np.ndarray, keys: np.ndarray, first: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Joint counts (key, key, terms) of rows ``first`` to ``end``, halved until a block fits."""
    part = keys[starts[first] : starts[end]]
    used, column = np.unique(part, return_inverse=True)
    rows = end - first
    if rows > 1 and (len(used) > COLUMNS or rows * len(used) > CELLS):
        middle = (first + end) // 2
        yield from _blocks(starts, keys, first, middle)
        yield from _blocks(starts, keys, middle, end)
        return
    at = np.repeat(np.arange(rows), np.diff(starts[first : end + 1]))
    for a, b, terms in _tiles(rows, at, column, len(used)):
        yield used[a], used[b], terms


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang")
        lists = batch.column("counts")
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        values = lists.flatten()
        names = np.array(values.field("source").to_pylist(), dtype=object)
        sources, source = np.unique(names, return_inverse=True)
        levels, level = np.unique(values.field("count").to_numpy(), return_inverse=True)
        keys = source.astype(np.int64) * len(levels) + level
        starts = np.concatenate(([0], np.cumsum(lengths)))
        spoken = np.array(langs.to_pylist(), dtype=object)
        # Rows come in order of language.
        cuts = [0, *(np.flatnonzero(spoken[1:] != spoken[:-1]) + 1).tolist(), len(spoken)]
        for first, end in zip(cuts[:-1], cuts[1:]):
            for a, b, terms in _blocks(starts, keys, first, end):
                yield pa.record_batch(
                    [
                        pa.array([spoken[first]] * len(a), pa.string()),
                        pa.array(sources[a // len(levels)], pa.string()),
                        pa.array(levels[a % len(levels)], pa.int64()),
                        pa.array(sources[b // len(levels)], pa.string()),
                        pa.array(levels[b % len(levels)], pa.int64()),
                        pa.array(terms),
                    ],
                    names=["lang", "a", "a_count", "b", "b_count", "terms"],
                )


def joint_tables(terms: DataFrame) -> DataFrame:
    """(lang, a, a_count, b, b_count, terms): how many terms have these two counts in sources a and b.

    Counts above 0 only, for a before b, and a with itself, which is how often each count occurs. What
    is missing to the number of terms has count 0. ``terms`` is the result of ``term_counts``. Terms of
    alike frequency are multiplied together, as they share columns.
    """
    rows = terms.select("lang", "total", "counts").sortWithinPartitions("lang", "total").select("lang", "counts")
    return rows.mapInArrow(_products, _JOINT).groupBy("lang", "a", "a_count", "b", "b_count").agg(F.sum("terms").alias("terms"))


def _share(count: str, size: str, terms: str) -> Column:
    """A count's smoothed share of the group's occurrences, in units of 1 / ``SCALE``, rounded down."""
    return F.expr(f"1 + (cast({SCALE} as decimal(20, 0)) * (cast({count} as decimal(17, 0)) + 1)) div ({size} + {terms})")


def _price(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def groups_of(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, size, kept_terms, lang_size) of every group of documents, with terms or without."""
    names = docs.select(*[F.coalesce(name, F.lit("")).alias(name) for name in ("lang", "source")]).distinct()
    sizes = terms.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("count").alias("size"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept_terms"), F.sum("total").alias("lang_size"))
    return names.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)


def _pair_values(joint: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language.

    With J the joint table, m the number of terms by count and V that of all terms, the sum of f over
    all terms is V f(0,0) + sum of m (f(a,0) - f(0,0)) + sum of m (f(0,b) - f(0,0))
    + sum of J (f(a,b) - f(a,0) - f(0,b) + f(0,0)) over counts above 0: an exact rearrangement.
    """
    # p0: the share of a term that the source does not have.
    shares = groups.where("kept_terms > 0").withColumn("p0", _share("0", "size", "kept_terms"))
    side = shares.select("lang", "source", "size", "kept_terms", "p0")

    def other(name: str) -> DataFrame:
        renamed = side.select("lang", F.col("source").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("size", "kept_terms", "p0")])
        return own_shuffle(renamed, ["lang", name])

    def priced(weight: str, p: str, q: str) -> Column:
        return F.col(weight).cast("decimal(20,0)") * _price(p, q).cast("decimal(18,0)")

    def both_ways(rows: DataFrame, value) -> DataFrame:
        """Values of a against b and of b against a."""
        found = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), value("a", "b").alias("value")),
                        F.struct(F.col("b").alias("source"), F.col("a").alias("item"), value("b", "a").alias("value")))
        return rows.select("lang", F.inline(found)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    cells = joint.where("a <> b").join(other("a"), ["lang", "a"]).join(other("b"), ["lang", "b"])
    cells = cells.withColumns({f"{x}_p": _share(f"{x}_count", f"{x}_size", f"{x}_kept_terms") for x in "ab"})
    inner = both_ways(cells, lambda g, h: (
        priced("terms", f"{g}_p", f"{h}_p") - priced("terms", f"{g}_p", f"{h}_p0") - priced("terms", f"{g}_p0", f"{h}_p") + priced("terms", f"{g}_p0", f"{h}_p0")
    ))
    # How often each count occurs in source a, against the sources b that lack the term.
    margins = joint.where("a = b").select("lang", "a", "a_count", "terms").join(other("a"), ["lang", "a"])
    margins = margins.withColumn("a_p", _share("a_count", "a_size", "a_kept_terms"))
    margins = margins.groupBy("lang", "a", "a_p", "a_p0").agg(F.sum("terms").alias("terms"))
    lone = margins.join(own_shuffle(side.select("lang", F.col("source").alias("b"), F.col("p0").alias("b_p0")), ["lang"]), "lang").where("a <> b")
    found = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item"), (priced("terms", "a_p", "b_p0") - priced("terms", "a_p0", "b_p0")).alias("value")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"), (priced("terms", "b_p0", "a_p") - priced("terms", "b_p0", "a_p0")).alias("value")),
    )
    outer = lone.select("lang", F.inline(found)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    first = groups.select("lang", "source", F.when(F.col("kept_terms") > 0, _share("0", "size", "kept_terms")).alias("p"), "kept_terms")
    second = groups.select("lang", F.col("source").alias("item"), F.when(F.col("kept_terms") > 0, _share("0", "size", "kept_terms")).alias("q"))
    absent = first.join(second, "lang").where("source <> item").select(
        "lang", "source", "item", F.coalesce(priced("kept_terms", "p", "q"), F.lit(0)).alias("value")
    )
    every = absent.unionByName(outer).unionByName(inner)
    return every.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def _term_values(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms that a source has more often than its language."""
    shares = groups.select("lang", "source", "size", "kept_terms", "lang_size")
    rows = join_unique(terms.select("lang", "term", "total", F.inline("counts")), shares, ["lang", "source"])
    rows = rows.select("lang", "source", F.col("term").alias("item"), _share("count", "size", "kept_terms").alias("p"), _share("total", "lang_size", "kept_terms").alias("q"))
    return rows.where("p > q").select("lang", "source", "item", _price("p", "q").alias("value"))


def divergence(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets each source of a language apart.

    Part ``pair``: every other source of the language as item, with the summed divergence of all kept
    terms, 0 where the language has none. Part ``term``: the ``top`` terms that the source has more
    often, by share, than the whole language. Ranks go by value downwards, then by item in order of
    UTF-8. All arithmetic is on integers. Null lang, source and text are empty, an empty table gives
    no rows, repeated rows count each time, other columns are ignored.
    """
    terms = stored(term_counts(docs, least_docs), "terms")
    groups = stored(groups_of(docs, terms), "groups")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pair_values(stored(joint_tables(terms), "joint"), groups).withColumn("rank", F.row_number().over(best))
    leading = _term_values(terms, groups).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(leading.withColumn("part", F.lit("term")).select(*columns))
