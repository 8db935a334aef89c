"""The registered queries: each applies one operator to its whole table and returns the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.conversation_repair import damage, repair_conversations
from skyledger.llm.cover_tree import near_duplicates
from skyledger.llm.divergence import divergence
from skyledger.llm.exact_dedup import exact_copies
from skyledger.llm.jaccard_join import jaccard_components
from skyledger.llm.mixing import mix_sources
from skyledger.llm.nearest import nearest
from skyledger.llm.packing import pack
from skyledger.llm.quality import THRESHOLD, held_out, score, train
from skyledger.llm.sharding import shard_documents
from skyledger.llm.substring_dedup import remove_repeats
from skyledger.llm.suffix_dedup import remove_repeated_bytes
from skyledger.llm.token_counts import count_tokens
from skyledger.llm.tokens import default_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), width=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_bytes(table(spark, sf_dir, "documents"), width=400)
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 100 = 0"), k=10)


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_path("word_bpe_49k.json"), capacity=4096, end_id=1)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"), least_docs=3, top=200)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(table(spark, sf_dir, "documents"), digests=True)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = repair_conversations(damage(table(spark, sf_dir, "conversations")), lost="lost", digests=True)
    return found


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_source_mix": op2_source_mix,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_shards": op8_shards,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_quality": op10_quality,
    "op11_source_divergence": op11_source_divergence,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\f\r]+')"

VECTORS = """vectors AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        )"""

ORACLES = {
    "op1_substring_dedup": f"""
        WITH texts AS (SELECT doc_id, {WORDS} AS w FROM documents),
        windows AS (
            SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts WHERE len(w) >= 50)
        ),
        firsts AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j
            FROM windows JOIN firsts USING (h) WHERE least < doc_id
        ),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM texts),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n_kept
            FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
        )
        SELECT t.doc_id, len(t.w) AS n_words, len(t.w) - coalesce(k.n_kept, 0) AS n_removed,
               sha256(coalesce(k.kept, '')) AS kept_sha256
        FROM texts t LEFT JOIN kept k USING (doc_id)
    """,
    "op3_jaccard_join": f"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, {WORDS.replace("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
            FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 2], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM texts WHERE len(w) > 0)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c >= 90 * (x.n + y.n - c)
        ),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (
            SELECT doc_id, doc_id AS other FROM texts
            UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other
        )
        SELECT t.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id
        FROM texts t LEFT JOIN sizes s USING (doc_id) JOIN reach r USING (doc_id) GROUP BY t.doc_id
    """,
    "op5_embedding_dedup": f"""
        WITH RECURSIVE {VECTORS},
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95
        ),
        reach AS (
            SELECT vec_id, vec_id AS other FROM embeddings
            UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
        ),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(other) AS component_id, min(other) = vec_id AS kept
        FROM reach LEFT JOIN counts USING (vec_id) GROUP BY vec_id
    """,
    "op7_nearest_neighbours": f"""
        WITH {VECTORS},
        scored AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   sqrt(list_reduce(list_transform(list_zip(q.e, v.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b))
                       AS score
            FROM vectors q JOIN vectors v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 10
    """,
    "op11_source_divergence": r"""
        WITH texts AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ),
        kept AS (
            SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM texts) GROUP BY ALL HAVING count(*) >= 3
        ),
        occurring AS (
            SELECT lang, source, term, count(*) AS c FROM (SELECT lang, source, unnest(w) AS term FROM texts)
            JOIN kept USING (lang, term) GROUP BY ALL
        ),
        sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        grid AS (
            SELECT g.lang, g.source, k.term, coalesce(o.c, 0) AS c, sum(coalesce(o.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n
            FROM (SELECT DISTINCT lang, source FROM texts) g JOIN kept k ON k.lang = g.lang
            LEFT JOIN occurring o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
        ),
        shares AS (
            SELECT lang, source, term, c, 1 + (CAST(1000000000 AS HUGEINT) * (c + 1)) // (n + v) AS p FROM grid JOIN sizes USING (lang)
        ),
        whole AS (
            SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (c + 1)) // (sum(c) OVER (PARTITION BY lang) + v) AS q
            FROM (SELECT lang, term, sum(c) AS c FROM grid GROUP BY ALL) JOIN sizes USING (lang)
        ),
        summed AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
            FROM (SELECT DISTINCT lang, source FROM texts) a
            JOIN (SELECT DISTINCT lang, source FROM texts) b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ),
        above AS (
            SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
            FROM shares JOIN whole USING (lang, term) WHERE c > 0 AND p > q
        )
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM above) QUALIFY part = 'pair' OR rank <= 200
    """,
    "op12_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256(regexp_replace(coalesce(text, ''), '[ \t\n\x0b\f\r]', '', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER best = 1 AS kept, text_sha256
        FROM texts WINDOW best AS (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id)
    """,
    # The checksum is taken bit by bit; moves are up to two insertions and one edit of a turn.
    "op13_conversation_repair": r"""
        WITH RECURSIVE places AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place
            FROM conversations
        ),
        drawn AS (
            SELECT *, xor(CAST(4294967295 AS BIGINT), list_reduce(
                list_transform(range(1, length(place) + 1), lambda i: CAST(ascii(place[i]) AS BIGINT)),
                lambda crc, byte: list_reduce(range(0, 8), lambda c, bit: xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)), xor(crc, byte)),
                CAST(4294967295 AS BIGINT))) % 20 AS kind
            FROM places
        ),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM drawn WHERE kind <> 0
        ),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   CASE role[1] WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS class,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
            FROM damaged
        ),
        turns AS (
            SELECT *, CASE WHEN solid = '' THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 3
                           WHEN right(solid, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault,
                   lead(class) OVER (PARTITION BY conv_id ORDER BY i) AS following
            FROM numbered
        ),
        counts AS (
            SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
                   count(*) FILTER (following IS NOT NULL AND 10 * class + following NOT IN (1, 12, 21)) AS illegal
            FROM turns GROUP BY conv_id
        ),
        insertions(state, to_state, cost, edits, made) AS (
            VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
                   (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (3, 2, 2, 'I', ['user:']),
                   (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])
        ),
        edits(state, class, edit, to_state, cost, role) AS (
            VALUES (0, 0, 'K', 1, 0, NULL), (0, 1, 'K', 2, 0, NULL), (1, 1, 'K', 2, 0, NULL), (2, 2, 'K', 3, 0, NULL), (3, 1, 'K', 2, 0, NULL),
                   (0, -1, 'R', 2, 2, 'user'), (1, -1, 'R', 2, 2, 'user'), (2, -1, 'R', 3, 2, 'assistant'), (3, -1, 'R', 2, 2, 'user'),
                   (0, -1, 'D', 0, 3, NULL), (1, -1, 'D', 1, 3, NULL), (2, -1, 'D', 2, 3, NULL), (3, -1, 'D', 3, 3, NULL)
        ),
        walk AS (
            SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS made FROM conversations
            UNION ALL
            SELECT conv_id, i, state, cost, audit, made FROM (
                SELECT w.conv_id, t.i, e.to_state AS state, w.cost + n.cost + e.cost + CASE WHEN t.fault = 1 AND e.edit <> 'D' THEN 1 ELSE 0 END AS cost,
                       w.audit || n.edits || e.edit AS audit,
                       w.made || n.made || CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [t.role || ':' || t.text] ELSE [e.role || ':' || t.text] END AS made
                FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
                JOIN insertions n ON n.state = w.state
                JOIN edits e ON e.state = n.to_state AND (e.class = -1 OR e.class = t.class) AND (e.edit = 'D' OR t.fault < 2)
            ) QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
        ),
        ended AS (
            SELECT w.conv_id, w.cost + n.cost AS cost, w.audit || n.edits AS audit, w.made || n.made AS made
            FROM walk w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
            JOIN insertions n ON n.state = w.state AND n.to_state IN (0, 3)
            WHERE w.i = coalesce(c.n, 0)
            QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + n.cost, w.audit || n.edits) = 1
        )
        SELECT e.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
               coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(e.cost AS BIGINT) AS cost, e.audit,
               sha256(array_to_string(e.made, chr(10))) AS repaired_sha256
        FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
}
