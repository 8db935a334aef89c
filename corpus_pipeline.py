"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.id_filter import key_bits, with_mark
from skyledger.llm.jaccard_join import jaccard_components
from skyledger.llm.mixing import mix_sources
from skyledger.llm.packing import pack
from skyledger.llm.quality import THRESHOLD, score, train
from skyledger.llm.substring_dedup import remove_repeats
from skyledger.llm.tables import stored
from skyledger.llm.tokens import default_path
from skyledger.llm.words import words_between
from skyledger.operators.joins import own_shuffle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects; it learns from the labels of ``sf_dir``."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select(*COLUMNS), model, carry=True).where(F.col("score") >= THRESHOLD).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five words, similarity of 0.8 or more.

    It is the one of least id; of rows of that id with one text, the first in order of the other
    columns. Where ids are repeated, each of their texts is a document: of near copies of the least
    id, the one of least hash stays. Rows without an id stay.
    """
    found = stored(jaccard_components(docs, n=5, percent=80), "groups").where("doc_id IS NOT NULL")
    repeated = stored(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        dropped = found.where("doc_id <> component_id").select("doc_id", F.lit(True).alias("_dropped"))
        # Only rows that may go are moved; an anti join would be pushed below the filter and move all.
        marked = with_mark(docs.select(*COLUMNS), key_bits(dropped, "doc_id"), "doc_id")
        asked = marked.where("_asked").join(own_shuffle(dropped, ["doc_id"]), "doc_id", "left").where("_dropped IS NULL")
        return marked.where("NOT _asked").select(*COLUMNS).unionByName(asked.select(*COLUMNS))
    named = docs.where("doc_id IS NOT NULL").select(*COLUMNS, F.xxhash64("doc_id", F.col("text").isNull(), "text").alias("name"))
    found = stored(jaccard_components(named, n=5, percent=80, id="name"), "groups").select("name", "component_id").distinct()
    ids = named.select("name", "doc_id").distinct()
    least = ids.join(found, "name").groupBy("component_id").agg(F.min(F.struct("doc_id", "name")).alias("least"))
    stay = own_shuffle(least.select("least.name"), ["name"])
    one = named.join(stay, "name", "left_semi").groupBy("name").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return one.unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words that a document of smaller id has, too; other white space stays.

    A document with nothing to cut stays as it is, but a null text becomes empty; one all of whose
    words are cut goes.
    """
    rows = docs.select(*COLUMNS)
    cut = remove_repeats(rows, width=50, carry=["lang", "source", "n_chars"], spaces=True).where("n_removed < n_words OR n_words = 0")
    size = F.when((F.col("n_removed") > 0) | F.col("n_chars").isNull(), F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", size.alias("n_chars"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes from each source what its target grants: a document once for each whole pass, and a part
    of it as a document of its own. Sources weigh 3, 1, 2 in turn and share 150 % of all words."""
    mix = mix_sources(docs.select(*COLUMNS), weights=(3, 1, 2), share=1.5, most=2, carry=["text", "lang"])
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("end")), F.col("passes"))
    taken = mix.where("taken > 0").withColumn("piece", F.explode(F.concat(whole, "parts")))
    text = words_between("text", F.col("piece.start"), F.col("piece.end"), F.col("size"))
    return taken.select("doc_id", text.alias("text"), "lang", "source").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of all documents into sequences of 4096."""
    return pack(docs, default_path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("substring dedup", cut_repeated_passages),
    ("mixing sources", mix_to_targets),
    ("best-fit packing", pack_sequences),
]
# The stages learn, search and encode; SQL has no form for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each result written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
