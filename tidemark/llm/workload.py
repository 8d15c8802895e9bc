"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    decontaminate,
    html_extraction,
    jaccard_join,
    language_id,
    license_scan,
    merkle,
    packing,
    quality_rules,
    resharding,
    substring_dedup,
    url_filters,
    whitening,
)

#: The rules of op1_url_filter.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    listed = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {listed} AS rules(verdict, rule)")
    return url_filters.judged(table(spark, folder, "pages"), rules)


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_rules.scored(table(spark, folder, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("quality") >= 0.5)).alias("kept"),
    )


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.removal_digest(table(spark, folder, "documents"))


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.linked(table(spark, folder, "documents"))


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.train(docs.where(~held_out()), tokenizer_path("piece_bpe_32k.model"))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontaminate.contamination_digest(found)


def op7_resharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = resharding.resharded(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scanned(table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extracted(table(spark, folder, "pages"))


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audited(table(spark, folder, "documents"))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.encoded(table(spark, folder, "documents").select("doc_id", "text"), ranks), ranks)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_quality_rules,
        op3_substring_dedup,
        op4_ngram_jaccard,
        op5_language_id,
        op6_decontamination,
        op7_resharding,
        op8_license_scan,
        op9_packing,
        op10_html_extraction,
        op11_embedding_whitening,
        op12_merkle_manifest,
        op13_byte_bpe,
    )
}
ORACLES: dict[str, str] = {
    "op1_url_filter": """
        WITH urls AS (
            SELECT page_id, strpos(url, '://') AS spot, url FROM pages
        ), parts AS (
            SELECT page_id,
                CASE WHEN spot > 0 THEN translate(regexp_extract(substr(url, spot + 3), '^([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
                CASE WHEN spot > 0 THEN regexp_extract(substr(url, spot + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
            FROM urls
        ), rules(verdict, host, path) AS (
            VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                ('block', 'net', '/es/'), ('block', 'net', '/fr/')
        ), judged AS (
            SELECT p.page_id, p.host, p.path, (
                SELECT max_by(r.verdict || ' ' || r.host || r.path, length(r.host || r.path)) FROM rules r
                WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
            ) AS found
            FROM parts p
        )
        SELECT page_id, host, path, CASE WHEN found IS NOT NULL THEN split_part(found, ' ', 2) END AS rule,
            COALESCE(split_part(found, ' ', 1), 'allow') AS verdict
        FROM judged
    """,
    "op12_merkle_manifest": """
        WITH RECURSIVE fields AS (
            SELECT row_number() OVER () AS id, doc_id, lang, text,
                COALESCE(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || COALESCE(strlen(source) || ':' || source, '-')
                    || COALESCE(strlen(lang) || ':' || lang, '-') || COALESCE(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
                list_reduce(
                    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                    lambda crc, byte: list_reduce(
                        list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                        lambda x, z: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END) + z
                    )
                ) AS crc
            FROM documents
        ), hashed AS (
            SELECT id, doc_id, lang, sha256(head || COALESCE(strlen(text) || ':' || text, '-')) AS leaf,
                CASE WHEN xor(crc, 4294967295) % 3 = 0
                    THEN sha256(head || COALESCE(strlen(lowered) || ':' || lowered, '-')) END AS altered
            FROM fields
        ), leaves AS (
            SELECT *, COALESCE('=' || lang, '-') AS tree,
                row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
            FROM hashed
        ), nodes(tree, level, spot, digest, n) AS (
            SELECT tree, 0, rank, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
            UNION ALL
            SELECT tree, level + 1, spot // 8, sha256(string_agg(digest, '' ORDER BY spot)), (n + 7) // 8
            FROM nodes WHERE n > 1 GROUP BY tree, level, spot // 8, n
        ), subroots AS (
            SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1
        ), top(level, spot, digest, n) AS (
            SELECT 0, rank, digest, n FROM subroots
            UNION ALL
            SELECT level + 1, spot // 8, sha256(string_agg(digest, '' ORDER BY spot)), (n + 7) // 8
            FROM top WHERE n > 1 GROUP BY level, spot // 8, n
        ), steps AS (
            SELECT l.id, 0 AS part, a.level, COALESCE(string_agg(s.digest, '' ORDER BY s.spot) FILTER (s.spot < a.spot), '') AS before,
                COALESCE(string_agg(s.digest, '' ORDER BY s.spot) FILTER (s.spot > a.spot), '') AS after
            FROM leaves l JOIN nodes a ON a.tree = l.tree AND a.n > 1 AND a.spot = l.rank // (8 ** a.level)::BIGINT
            JOIN nodes s ON s.tree = a.tree AND s.level = a.level AND s.spot // 8 = a.spot // 8
            GROUP BY l.id, a.level
            UNION ALL
            SELECT l.id, 1, a.level, COALESCE(string_agg(s.digest, '' ORDER BY s.spot) FILTER (s.spot < a.spot), ''),
                COALESCE(string_agg(s.digest, '' ORDER BY s.spot) FILTER (s.spot > a.spot), '')
            FROM leaves l JOIN subroots r ON r.tree = l.tree
            JOIN top a ON a.n > 1 AND a.spot = r.rank // (8 ** a.level)::BIGINT
            JOIN top s ON s.level = a.level AND s.spot // 8 = a.spot // 8
            GROUP BY l.id, a.level
        ), paths AS (
            SELECT id, list({'before': before, 'after': after} ORDER BY part, level) AS path,
                string_agg(before || after, '' ORDER BY part, level) AS joined
            FROM steps GROUP BY id
        ), folded(id, done, digest) AS (
            SELECT id, 0, COALESCE(altered, leaf) FROM leaves
            UNION ALL
            SELECT f.id, f.done + 1, sha256(p.path[f.done + 1].before || f.digest || p.path[f.done + 1].after)
            FROM folded f JOIN paths p USING (id) WHERE f.done < len(p.path)
        )
        SELECT l.doc_id, l.leaf, r.digest AS subroot, t.digest AS root, sha256(COALESCE(p.joined, '')) AS proof_sha256,
            f.digest AS folded_root, f.digest = t.digest AS verified
        FROM leaves l JOIN subroots r USING (tree) LEFT JOIN paths p USING (id)
        JOIN folded f ON f.id = l.id AND f.done = COALESCE(len(p.path), 0)
        CROSS JOIN (SELECT digest FROM top WHERE n = 1) t
    """,
}
