"""One query per text operator over the test tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.llm import centroids, chat, decontam, html, langid, mixing, ngram_join, packing, periodic, secrets, sharding, suffix_dedup, topk
from stockledger.llm.common import GAP, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"), words=4, percent=85)


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), clusters=40, rounds=5, dim=64).drop("n_scans")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text`; every tenth document by the hash of its id repeats some of its words from one of them on."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(F.pmod(hashed, F.lit(10)) == 0, F.lit(False))
    words = F.filter(F.split("text", GAP), lambda w: w != "")
    docs = docs.select("doc_id", "text", F.floor(hashed / 10).cast("long").alias("g"), F.when(chosen, words).alias("words"))
    a = F.pmod("g", F.size("words")).cast("long")
    docs = docs.select("doc_id", "text", "g", "words", F.when(F.size("words") > 0, a).alias("a"))
    p = 1 + F.floor((F.size("words") - F.col("a")) / (3 + F.pmod("g", F.lit(8))))
    docs = docs.select("doc_id", "text", "words", "a", p.alias("p"))

    def chosen_word(w, i):
        return F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int")))

    planted = F.concat_ws(" ", F.transform("words", chosen_word))
    return docs.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(planted).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")), least_length=24, least_exponent=3)
    line = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    # runs are in order of start and period, so a later one is better only by a larger exponent
    better = F.reduce(
        "runs",
        F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda best, r: F.when(best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best),
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        better.alias("best"),
        F.sha2(line, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def all_queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_ngram_join,
            op2_exact_top_k,
            op3_language_id,
            op4_decontamination,
            op5_sharding,
            op6_suffix_dedup,
            op7_html_extraction,
            op8_mixing,
            op9_chat_formatting,
            op10_secret_scan,
            op11_centroid_clustering,
            op12_packing,
            op13_periodic_runs,
        )
    }


SHINGLES = r"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w FROM documents),
    words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM texts),
    grams AS (
        SELECT doc_id, i, lead(x, 3) OVER o AS fourth,
               x || COALESCE(' ' || lead(x, 1) OVER o, '') || COALESCE(' ' || lead(x, 2) OVER o, '')
                 || COALESCE(' ' || lead(x, 3) OVER o, '') AS s
        FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    sets AS (SELECT DISTINCT doc_id, s FROM grams WHERE fourth IS NOT NULL OR i = 1),
    sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS n
        FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
        SELECT c.a, c.b FROM common c JOIN sizes x ON c.a = x.doc_id JOIN sizes y ON c.b = y.doc_id
        WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT d.doc_id, COALESCE(ANY_VALUE(x.n), 0) AS n_shingles, MIN(r.b) AS component_id
    FROM documents d JOIN reach r ON d.doc_id = r.a LEFT JOIN sizes x ON d.doc_id = x.doc_id GROUP BY d.doc_id"""

WHOLE_VECTORS = """
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"""

TOP = f"""
    WITH vectors AS ({WHOLE_VECTORS}),
    scores AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores)
    SELECT query_id, CAST(place AS INT) AS rank, vec_id, score FROM ranked WHERE place <= 5"""


def _clusters_sql(clusters: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Plain rounds over all distances, one block of SQL for each."""

    def nearest(nth: int) -> str:
        return f"""near{nth} AS (
        SELECT vec_id, d AS distance, cluster FROM (
            SELECT vec_id, cluster, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS place FROM (
                SELECT x.vec_id, c.cluster, SUM((x.v - c.v) * (x.v - c.v)) AS d
                FROM x JOIN c{nth} c ON x.i = c.i GROUP BY ALL)) WHERE place = 1)"""

    def moved(nth: int) -> str:
        return f"""c{nth + 1} AS (
        SELECT c.cluster, c.i, COALESCE(m.v, c.v) AS v FROM c{nth} c LEFT JOIN (
            SELECT n.cluster, x.i, CAST(floor(CAST(SUM(x.v) AS DOUBLE) / COUNT(*)) AS BIGINT) AS v
            FROM near{nth} n JOIN x ON n.vec_id = x.vec_id GROUP BY ALL) m ON c.cluster = m.cluster AND c.i = m.i)"""

    blocks = [
        f"kept AS (SELECT * FROM ({WHOLE_VECTORS}) WHERE len(v) = {dim})",
        f"x AS (SELECT vec_id, i, CAST(v[i] AS BIGINT) AS v FROM kept, range(1, {dim + 1}) AS r(i))",
        f"""starts AS (
        SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) - 1 AS cluster FROM kept)""",
        f"c0 AS (SELECT cluster, i, v FROM starts JOIN x ON starts.vec_id = x.vec_id WHERE cluster < {clusters})",
    ]
    for nth in range(rounds):
        blocks += [nearest(nth), moved(nth)]
    blocks.append(nearest(rounds))
    blocks.append(
        f"named AS (SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS digest FROM c{rounds} GROUP BY cluster)"
    )
    return "WITH " + ",\n    ".join(blocks) + f"""
    SELECT vec_id, CAST(n.cluster AS INT) AS cluster, CAST(distance AS BIGINT) AS distance,
           CAST(SUM(distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
           CAST(SUM(distance) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
    FROM near{rounds} n JOIN named ON n.cluster = named.cluster"""


def _matches_sql(order: int, kind: secrets.Kind, pattern: str) -> str:
    """The matches of one kind with the text before each since the last one."""
    quoted = pattern.replace("'", "''")
    return f"""
        SELECT r, source, {order} AS k, '{kind.name}' AS kind, unnest(m) AS m, unnest(v) AS v, unnest(p[1:len(m)]) AS gap,
               generate_subscripts(m, 1) AS nth
        FROM (SELECT r, source, regexp_extract_all(t, '{quoted}', 0) AS m, regexp_extract_all(t, '{quoted}', {kind.group}) AS v,
                     string_split_regex(t, '{quoted}') AS p FROM docs) WHERE len(m) > 0"""


# fixed values, written anew: the kinds' patterns by name
SECRET_PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "key_block": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "web_token": r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "prefixed": r"\b(?:gh[pousr]_[A-Za-z0-9]{20,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9-]{20,})",
}


def secrets_sql() -> str:
    """Spans from the lengths of gaps and matches; kinds beyond the first three only for values of one owner."""
    matches = " UNION ALL ".join(_matches_sql(i, k, SECRET_PATTERNS[k.name]) for i, k in enumerate(secrets.BASE + secrets.MORE))
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
        matches AS ({matches}),
        placed AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY r, k ORDER BY nth) AS e FROM matches),
        spans AS (SELECT *, e - length(m) AS s FROM placed
                  WHERE length(v) >= CASE kind WHEN 'assign' THEN 12 WHEN 'access' THEN 18 WHEN 'hex' THEN 16 ELSE 1 END),
        owned AS (SELECT kind, v, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) <= 1 AS live
                  FROM spans GROUP BY kind, v),
        reported AS (SELECT r, k, kind, s, concat(kind, ':', s, ':', e) AS x, live FROM spans JOIN owned USING (kind, v) WHERE k < 3 OR live),
        found AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                         count(*) FILTER (kind = 'hex') AS n_hex, string_agg(x, ',' ORDER BY s, k) FILTER (k < 3) AS base,
                         string_agg(x, ',' ORDER BY s, k) AS spans, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
                  FROM reported GROUP BY r)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
               coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
        FROM docs LEFT JOIN found USING (r)"""


def all_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": SHINGLES, "op2_exact_top_k": TOP, "op10_secret_scan": secrets_sql(), "op11_centroid_clustering": _clusters_sql()
    }
