"""N-gram Jaccard join with a prefix tree.

A text is the set of its word n-grams. All sets are sorted in one global order, frequent n-grams last;
two sets that are alike enough share n-grams of their first few, and meet (see ``meetings``). Where they meet, the sets are stored in a trie; each set traverses it,
counting its overlap along shared paths once, and leaves a subtree when the n-grams that remain on
either side cannot make up the overlap needed. Equal sets are one set throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.components import components, local_roots
from skyledger.llm.id_filter import key_bits, maybe_asked, with_mark
from skyledger.llm.tables import stored
from skyledger.llm.textscan import U64, Names, flat_ranges, lower_ascii, mix, packed_texts, slices, text_column, thrifty, unpacked, word_bounds, word_names
from skyledger.operators.joins import own_shuffle

# Sets of one block; larger meetings are cut into pairs of blocks.
BLOCK = 256
# Sets that may share an n-gram for its pairs to be counted: 31 / 2 pairs of two numbers per set are
# far less than its prefix, which travels to each meeting of more.
FEW = 32
# Most frequent n-grams that are known to be so; all others are ordered by their names.
FREQUENT = 1 << 19
# N-grams among which a task looks for frequent ones, and how often it must see one.
SEEN_TOGETHER, SEEN_TIMES = 2_000_000, 2
SLICE_BYTES = 1 << 20


def ngram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Names (63 bits) of the distinct n-grams of each text, flat and sorted by name, and offsets.

    A text of fewer words has its whole sequence as the only one, a text without words none.
    """
    data = lower_ascii(data)
    starts, ends, words = word_bounds(data, offsets)
    names = Names(word_names(data, starts, ends), 1)
    sizes = np.diff(words)
    grams = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    owner = np.repeat(np.arange(len(sizes)), grams)
    first = flat_ranges(words[:-1], grams)
    found = names.of(first, first + np.minimum(sizes, n)[owner]) >> U64(1)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    fresh = np.ones(len(found), dtype=bool)
    fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[fresh], owner[fresh]
    return found, np.searchsorted(owner, np.arange(len(sizes) + 1))


def frequent_ngrams(texts: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the most frequent n-grams, sorted, and their ranks, 0 being the least frequent.

    They are ``FREQUENT`` at most.

    Any order of n-grams gives the right links; this one keeps frequent n-grams out of prefixes.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            names, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= SEEN_TIMES
            return pa.RecordBatch.from_arrays([pa.array(names[often].view(np.int64)), pa.array(times[often])], names=["name", "times"])

        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                held.append(ngram_sets(*text_column(part.column("text")), n)[0])
                size += len(held[-1])
                if size >= SEEN_TOGETHER:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    seen = texts.select("text").mapInArrow(thrifty(scan), "name long, times long")
    top = seen.groupBy("name").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "name").limit(FREQUENT)
    names = top.toArrow().column("name").to_numpy()[::-1]
    by_name = np.argsort(names)
    return names[by_name], by_name.astype(np.int32)


def in_global_order(names: np.ndarray, offsets: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Each set sorted in the global order; a frequent n-gram is renamed to 2**63 plus its rank."""
    known, ranks = frequent
    if len(known):
        at = np.minimum(np.searchsorted(known, names.view(np.int64)), len(known) - 1)
        names = np.where(known[at] == names.view(np.int64), ranks[at].astype(U64) + (U64(1) << U64(63)), names)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return names[np.lexsort((names, owner))]


def prefix_length(size, percent: int):
    """How many n-grams of a set come first: two sets alike enough share one of these."""
    return size - -(-size * percent // 100) + 1


def set_rows(texts: DataFrame, n: int, percent: int, sent) -> DataFrame:
    """(id, size, sum_a, sum_b, prefix): the size of each set, two sums that name it, its prefix."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                names, offsets = ngram_sets(*text_column(part.column("text")), n)
                size = np.diff(offsets)
                names = in_global_order(names, offsets, sent.value)
                sums = [np.concatenate((np.zeros(1, U64), np.cumsum(mix(names + U64(salt)))))[offsets] for salt in (1, 1 << 40)]
                taken = np.where(size > 0, prefix_length(size, percent), 0)
                prefix = names[flat_ranges(offsets[:-1], taken)].view(np.int64)
                ends = np.concatenate(([0], np.cumsum(taken))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(size),
                        *(pa.array(np.diff(one).view(np.int64)) for one in sums),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(prefix)),
                    ],
                    names=["id", "size", "sum_a", "sum_b", "prefix"],
                )

    return texts.mapInArrow(thrifty(scan), "id long, size long, sum_a long, sum_b long, prefix array<long>")


def sizes_alike(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be alike enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def meetings(classes: DataFrame, percent: int) -> DataFrame:
    """Which sets meet under which host: (class, host), for sets (class, size, prefix).

    An n-gram that more than ``FEW`` sets have in their prefixes brings them together under the least
    of them. N-grams of fewer sets are counted for each of their pairs, and a pair meets under its
    lesser set if the count allows the similarity: all n-grams that the set with the earlier prefix end
    shares there with the other one are in the other's prefix, too, so they are all counted, unless one
    of them brought the two together already. Sets too different in size make no pair. Where many meet,
    their prefixes are compared in a trie first, and only sets that may have a partner there stay.
    """
    rows = classes.select("class", "size", F.explode("prefix").alias("name"))
    by_name = Window.partitionBy("name").orderBy("class")
    met = rows.withColumn("host", F.first("class").over(by_name)).withColumn("number", F.count("*").over(Window.partitionBy("name")))
    earlier = F.collect_list(F.struct("class", "size")).over(by_name.rowsBetween(-(FEW - 1), -1))
    met = met.withColumn("earlier", F.when(F.col("number") <= FEW, earlier)).where("number > 1")
    met = met.withColumn("earlier", F.filter("earlier", lambda other: sizes_alike(other["size"], F.col("size"), percent))["class"])
    met = stored(met.select("class", "host", "number", "earlier"), "met")
    many = met.where(F.col("number") > FEW).select("class", "host").distinct()
    asked = stored(units(many).withColumnRenamed("id", "class"), "prefix-units")
    # One row per class on both sides, so no key is frequent; only classes that meet are moved.
    prefixes = maybe_asked(classes, asked, "class").select("class", "size", "prefix")
    sent = asked.join(prefixes, "class").select("class", "size", packed_prefix("prefix").alias("names"), F.explode("units").alias("unit"))
    sent = sent.select("unit.*", F.col("class").alias("id"), "names", "size")
    many = at_units(sent).mapInArrow(thrifty(by_unit(with_partner(percent), ["class", "host"])), "class long, host long")
    many = stored(many.distinct(), "met-by-prefix")
    counted = met.where(F.col("number") <= FEW).select(F.explode("earlier").alias("a"), F.col("class").alias("b"))
    counted = counted.groupBy("a", "b").agg(F.count("*").alias("shared"))
    # The last n-gram of the prefix, as a number whose signed order is the global one.
    last = F.element_at("prefix", -1).bitwiseXOR(F.lit(-(2**63)))
    known = classes.select("class", F.struct("size", F.size("prefix").alias("taken"), last.alias("last")).alias("set"))
    for side in ("a", "b"):
        named = known.select(F.col("class").alias(side), F.col("set").alias(f"set_{side}"))
        counted = counted.join(own_shuffle(named, [side]), side)
    size_a, size_b = F.col("set_a.size"), F.col("set_b.size")
    first = F.when(F.col("set_a.last") <= F.col("set_b.last"), F.col("set_a")).otherwise(F.col("set_b"))
    needed = F.ceil((size_a + size_b) * percent / (100 + percent) - F.lit(1e-6))
    possible = F.col("shared") >= first["taken"] - (first["size"] - needed)
    pairs = not_together(stored(counted.where(possible).select("a", "b"), "pairs"), many)
    few = pairs.select(F.col("b").alias("class"), F.col("a").alias("host")).unionByName(pairs.select(F.col("a").alias("class"), F.col("a").alias("host")))
    return many.unionByName(few).distinct()


def not_together(pairs: DataFrame, many: DataFrame) -> DataFrame:
    """The pairs (a, b), a being less, without those whose sets meet under another host anyway.

    ``many`` has the meetings (class, host) besides the pairs. If the least host of both is the same,
    and neither of them, each meets the other there: a group of copies then meets once, not pair by pair.
    """
    hosts = pairs.select(F.col("b").alias("class"), F.col("a").alias("host")).unionByName(pairs.select(F.col("a").alias("class"), F.col("a").alias("host")))
    least = stored(hosts.unionByName(many).groupBy("class").agg(F.min("host").alias("host")), "least-hosts")
    for side in ("a", "b"):
        pairs = pairs.join(own_shuffle(least.select(F.col("class").alias(side), F.col("host").alias(f"host_{side}")), [side]), side)
    return pairs.where("a = host_b OR host_a <> host_b").select("a", "b")


def units(met: DataFrame) -> DataFrame:
    """Where each set goes: (id, units), a unit being a host and a pair of its blocks."""
    sizes = met.groupBy("host").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = met.join(own_shuffle(sizes, ["host"]), "host")
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.col("host"), F.least("own", other).alias("i"), F.greatest("own", other).alias("j"), F.col("own")),
    )
    return (
        dealt.withColumn("own", own)
        .groupBy(F.col("class").alias("id"))
        .agg(F.flatten(F.collect_list(others)).alias("units"))
    )


UNIT_SCHEMA = "host long, i int, j int, own int, id long, names binary, size long"


def unit_rows(n: int, sent):
    """Sends the whole set of a text to each of its units."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in unpacked(batch, SLICE_BYTES):
                names, offsets = ngram_sets(data, offsets, n)
                names = in_global_order(names, offsets, sent.value).astype(">u8")
                lists = part.column("units")
                owner = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                flat = lists.flatten()
                sets = pa.array([names[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())
                at = pa.array(owner)
                columns = [flat.field(name) for name in ("host", "i", "j", "own")]
                for first in range(0, len(owner), 4096):  # bounds the copies of sets held at a time
                    some = at.slice(first, 4096)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(one.slice(first, 4096) for one in columns),
                            part.column("id").take(some),
                            sets.take(some),
                            pa.array(np.diff(offsets)).take(some),
                        ],
                        names=["host", "i", "j", "own", "id", "names", "size"],
                    )

    return scan


class Trie:
    """Sorted rows of n-grams in the global order; a node is a range of rows with a common start.

    ``sizes`` are those of the sets that the rows stand for: their own lengths, or, if the rows are
    prefixes, greater ones.
    """

    def __init__(self, rows: list[np.ndarray], sizes: np.ndarray):
        self.order = np.array(sorted(range(len(rows)), key=lambda at: rows[at].tobytes()))
        self.rows = [rows[at] for at in self.order]
        self.lengths = np.array([len(row) for row in self.rows])
        self.sizes = sizes[self.order]
        self.shared = np.zeros(len(rows) + 1, dtype=np.int64)  # common start of a row and the one before
        for row in range(1, len(rows)):
            above, below = self.rows[row - 1], self.rows[row]
            short = min(len(above), len(below))
            differs = np.flatnonzero(above[:short] != below[:short])
            self.shared[row] = differs[0] if len(differs) else short

    def alike(self, queries: list[np.ndarray], sizes: np.ndarray, needed) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, stored row) that share as many n-grams as ``needed``.

        ``needed(sizes, low, high)`` gives, for queries of these sizes, the least overlap that any set
        of size ``low`` to ``high`` asks for.
        """
        length = np.array([len(one) for one in queries])
        flat = np.concatenate(queries).astype(U64)
        owner = np.repeat(np.arange(len(queries)), length)
        place = flat_ranges(np.zeros(len(length), dtype=np.int64), length)
        order = np.argsort(flat, kind="stable")
        flat, owner, place = flat[order], owner[order], place[order]
        found: list[tuple[np.ndarray, int]] = []
        none = np.zeros(len(queries), dtype=np.int64)
        stack = [(0, len(self.rows), 0, none, none, np.ones(len(queries), dtype=bool))]
        while stack:
            low, high, depth, overlap, used, active = stack.pop()
            end = int(self.shared[low + 1 : high].min()) if high - low > 1 else int(self.lengths[low])
            if end > depth:
                path = self.rows[low][depth:end].astype(U64)
                left, right = np.searchsorted(flat, path, "left"), np.searchsorted(flat, path, "right")
                hits = flat_ranges(left, right - left)
                overlap = overlap + np.bincount(owner[hits], minlength=len(queries))
                used = used.copy()
                used[owner[hits]] = place[hits] + 1  # later n-grams of the path come last and win
            most = overlap + np.minimum(length - used, self.lengths[low:high].max() - end)
            least = needed(sizes, self.sizes[low:high].min(), self.sizes[low:high].max())
            active = active & (most >= least)
            if not active.any():
                continue
            if high - low == 1:
                found.append((np.flatnonzero(active & (overlap >= least)), int(self.order[low])))
                continue
            edges = [low, *(low + 1 + np.flatnonzero(self.shared[low + 1 : high] == end)), high]
            stack += [(a, b, end, overlap, used, active) for a, b in zip(edges[:-1], edges[1:])]
        if not found:
            return none[:0], none[:0]
        return np.concatenate([one for one, _ in found]), np.repeat([at for _, at in found], [len(one) for one, _ in found])


def overlap_needed(percent: int):
    """The overlap of whole sets that makes them alike."""
    return lambda sizes, low, high: -(-percent * (sizes + low) // (100 + percent))


def prefix_overlap_needed(percent: int):
    """The overlap of prefixes without which sets cannot be alike.

    N-grams that the set whose prefix ends earlier has in its prefix are in the other's prefix if they
    are in the other set at all; those behind the prefix are too few to make up for more.
    """

    def one(sizes, other):
        larger = np.maximum(sizes, other)
        least = -(-percent * (sizes + other) // (100 + percent)) + 1 + (-percent * larger // 100)
        return np.where(100 * np.minimum(sizes, other) >= percent * larger, np.maximum(least, 1), np.iinfo(np.int64).max)

    def needed(sizes, low, high):
        # The least need is that of the size furthest from the query's that may be alike.
        smallest = np.maximum(low, -(-percent * sizes // 100))
        largest = np.minimum(high, 100 * sizes // percent)
        # Between both ends rounding may ask for one less.
        least = np.minimum(one(sizes, smallest), one(sizes, largest)) - (smallest < largest)
        return np.where(smallest <= largest, least, np.iinfo(np.int64).max)

    return needed


def by_unit(handle, names: list[str]):
    """Hands the rows (own, id, n-grams, size) of each unit to ``handle``; they come sorted by unit.

    ``handle(host, sides)`` gets one list of rows, or two if the unit is a pair of blocks, and returns
    two columns of ids.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def close():
            if len(rows) < 2:
                return
            sides = [[row for row in rows if row[0] == own] for own in ([unit[1]] if unit[1] == unit[2] else unit[1:])]
            if all(sides):
                out.append(handle(unit[0], sides))

        def flush():
            columns = [pa.array(np.concatenate([pair[at] for pair in out])) for at in (0, 1)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("host", "i", "j", "own", "id", "names", "size")]
            for host, i, j, own, id, grams, size in zip(*columns):
                if unit != (host, i, j):
                    close()
                    unit, rows = (host, i, j), []
                rows.append((own, id, np.frombuffer(grams, dtype=">u8"), size))
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    return scan


def alike_rows(sides, needed) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pairs of a unit that share as many n-grams as needed."""
    (ids_a, grams_a, sizes_a), (ids_b, grams_b, sizes_b) = (
        (np.array([row[1] for row in side]), [row[2] for row in side], np.array([row[3] for row in side])) for side in (sides[0], sides[-1])
    )
    x, y = Trie(grams_b, sizes_b).alike(grams_a, sizes_a, needed)
    a, b = ids_a[x], ids_b[y]
    return a[a != b], b[a != b]


def linked(percent: int):
    """Links within a unit, as links to the least set reached."""

    def handle(host, sides):
        a, b = alike_rows(sides, overlap_needed(percent))
        if not len(a):
            return a, b
        nodes, roots = local_roots(a, b)
        return nodes[nodes != roots], roots[nodes != roots]

    return handle


def with_partner(percent: int):
    """The sets of a unit whose prefixes leave a partner possible: (class, host)."""

    def handle(host, sides):
        a, b = alike_rows(sides, prefix_overlap_needed(percent))
        classes = np.unique(np.concatenate((a, b)))
        return classes, np.full(len(classes), host)

    return handle


def at_units(rows: DataFrame) -> DataFrame:
    return rows.repartition("host", "i", "j").sortWithinPartitions("host", "i", "j", "own", "id")


def packed_prefix(names: str):
    """An array of n-grams as the bytes of unsigned numbers, greatest byte first."""
    return F.unhex(F.array_join(F.transform(names, lambda name: F.lpad(F.hex(name), 16, "0")), ""))


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Links texts whose sets of word n-grams have a Jaccard similarity of ``percent`` of 100 or more.

    Words part at white space; A to Z count as a to z. Returns (id, n_shingles, component_id) per row
    of ``docs``: the size of its set and the least id reachable by links. A text of fewer than ``n``
    words has its whole sequence as the only n-gram; a null or blank one has no set and links with
    nothing. Ids are unique; if one has several texts, their links are its own. A null id links with
    nothing and has a null component. Other columns of ``docs`` play no part.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent lies between 0 and 100")
    spark = docs.sparkSession
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sent = spark.sparkContext.broadcast(frequent_ngrams(texts, n))
    sets = stored(set_rows(texts, n, percent, sent), "ngram-sets")
    known = sets.where("size > 0 AND id IS NOT NULL")
    identity = ["size", "sum_a", "sum_b"]
    classes = known.groupBy(*identity).agg(F.min("id").alias("class"))
    same = known.select("id", *identity).join(own_shuffle(classes, identity), identity).select("id", "class")
    same = stored(same.distinct(), "equal-sets")
    # One row of each set speaks for it; only rows that may be copies are moved to tell.
    marked = with_mark(known, key_bits(same.where("id <> class"), "id"), "id").select("id", "size", "prefix", "_asked")
    # Ids are unique there; a semi join would be pushed below the filter and move all rows.
    named = marked.where("_asked").join(own_shuffle(same.where("id = class").select("id"), ["id"]), "id")
    speakers = marked.where("NOT _asked").unionByName(named)
    speakers = stored(speakers.select(F.col("id").alias("class"), "size", "prefix"), "classes")
    goes = stored(units(stored(meetings(speakers, percent), "meetings")), "units")
    asked = packed_texts(maybe_asked(texts, goes, "id")).join(goes, "id").select("id", "packed", "n_bytes", "units")
    rows = asked.mapInArrow(thrifty(unit_rows(n, sent)), UNIT_SCHEMA)
    links = stored(at_units(rows).mapInArrow(thrifty(by_unit(linked(percent), ["a", "b"])), "a long, b long"), "links")
    groups = components(links).withColumnRenamed("id", "class")
    found = same.join(own_shuffle(groups, ["class"]), "class", "left")
    # The least id of a component may belong to an equal set: classes are named by their least id.
    found = found.groupBy("id").agg(F.min(F.coalesce("component_id", "class")).alias("component_id"))
    return sets.select("id", "size").join(own_shuffle(found, ["id"]), "id", "left").select(
        F.col("id").alias(id), F.col("size").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
