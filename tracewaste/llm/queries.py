"""One query for each operator, over its whole table, and comparison SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewaste.llm.best_fit import best_fit_documents
from tracewaste.llm.bpe_table import encoded_digests
from tracewaste.llm.crf import predict_languages
from tracewaste.llm.hmm import hmm_scores
from tracewaste.llm.packing import packed_documents
from tracewaste.llm.piece_table import fim_digests
from tracewaste.llm.rules import rule_verdicts
from tracewaste.llm.separators import byte_bpe, document_token_counts
from tracewaste.llm.sharding import sharded_documents
from tracewaste.llm.simhash import near_duplicate_digests
from tracewaste.llm.spelling import spelling_variants
from tracewaste.llm.tables import id_crc, read_table
from tracewaste.llm.topk import nearest
from tracewaste.llm.url_lists import address_of, domains_of, host_of, temporal_list_join

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The id after the byte ranks, free in that file.
BYTE_END = 50_256


def op1_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scores(read_table(spark, sf_dir, "documents"))


def op2_nra_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_documents(read_table(spark, sf_dir, "documents"))


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures, spread over a year by their ids."""
    return pages.select(
        "page_id", "url", F.expr("date_add(DATE'2024-01-01', CAST(page_id * 37 % 366 AS INT))").alias("fetched_on")
    )


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries derived from the pages: hosts, parent domains and addresses come, go and come back."""

    def firsts(kind: str, value) -> DataFrame:
        return (
            pages.select("page_id", value.alias("value"))
            .filter("value IS NOT NULL")
            .groupBy("value")
            .agg(F.min("page_id").alias("n"))
            .select(F.lit(kind).alias("kind"), "value", "n")
        )

    def dated(rows: DataFrame, name: str, listed: bool, day: str) -> DataFrame:
        return rows.select(
            F.lit(name).alias("list"),
            "kind",
            "value",
            F.lit(listed).alias("listed"),
            F.expr(f"date_add(DATE'2024-01-01', CAST({day} AS INT))").alias("since"),
        )

    host = host_of(F.col("url"))
    hosts = firsts("host", host).filter("n % 3 = 0")
    domains = firsts("domain", F.element_at(domains_of(host), -1)).filter("n % 2 = 0")
    addresses = firsts("url", address_of(F.col("url"))).filter("n % 11 = 0")
    parts = [
        dated(hosts, "spam", True, "n % 180"),
        dated(hosts, "spam", False, "n % 180 + 90"),
        dated(hosts.filter("n % 2 = 0"), "spam", True, "n % 180 + 150"),
        dated(domains, "parked", True, "60 + n % 30"),
        dated(domains, "parked", False, "90 + n % 30"),
        dated(addresses, "malware", True, "n % 300"),
    ]
    entries = parts[0]
    for part in parts[1:]:
        entries = entries.unionByName(part)
    return entries


def op4_temporal_list_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return temporal_list_join(dated_captures(pages), dated_entries(pages))


def op5_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(read_table(spark, sf_dir, "documents"), id_crc(F.col("doc_id")) % 4 == 2)


def op6_prefix_table_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(read_table(spark, sf_dir, "documents"), PIECE_MODEL)


def op7_separator_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = byte_bpe(BYTE_RANKS, public_tokenizers.PATTERN)
    return document_token_counts(read_table(spark, sf_dir, "documents"), tokenizer, BYTE_END)


def op8_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_digests(read_table(spark, sf_dir, "documents"))


def op9_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_verdicts(read_table(spark, sf_dir, "documents"))


def op10_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read_table(spark, sf_dir, "documents"), WORD_MODEL)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_fim_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(read_table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_documents(read_table(spark, sf_dir, "documents"), WORD_MODEL)


QUERIES = {
    f.__name__: f
    for f in (
        op1_hmm_scores,
        op2_nra_top_k,
        op3_hypergeometric_shards,
        op4_temporal_list_join,
        op5_crf_language,
        op6_prefix_table_pieces,
        op7_separator_counts,
        op8_simhash_components,
        op9_rule_ledger,
        op10_first_fit_packing,
        op11_spelling_variants,
        op12_fim_piece_table,
        op13_best_fit_packing,
    )
}

ORACLES: dict[str, str] = {
    "op2_nra_top_k": """
        WITH v AS MATERIALIZED (
            SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, q.r, c.vec_id,
                   coalesce(list_sum(list_transform(list_zip(q.v, c.v),
                       lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0)::BIGINT AS score
            FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, rank::INT AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored
        ) WHERE rank <= 20
    """,
    "op4_temporal_list_join": r"""
        WITH p AS (
            SELECT page_id, url, DATE '2024-01-01' + (page_id * 37 % 366)::INT AS fetched_on,
                   nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
                   regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS rest
            FROM pages
        ), hosts AS (SELECT host AS value, min(page_id) AS n FROM p WHERE host IS NOT NULL GROUP BY 1),
        domains AS (
            SELECT regexp_extract(host, '([^.]*\.)?[^.]*$') AS value, min(page_id) AS n
            FROM p WHERE host IS NOT NULL GROUP BY 1
        ), addresses AS (SELECT host || rest AS value, min(page_id) AS n FROM p WHERE host IS NOT NULL GROUP BY 1),
        entry AS (
            SELECT 'spam' AS list, 'host' AS kind, value, (n % 180) AS starts, (n % 180 + 90) AS ends FROM hosts WHERE n % 3 = 0
            UNION ALL SELECT 'spam', 'host', value, n % 180 + 150, 100000 FROM hosts WHERE n % 6 = 0
            UNION ALL SELECT 'parked', 'domain', value, 60 + n % 30, 90 + n % 30 FROM domains WHERE n % 2 = 0
            UNION ALL SELECT 'malware', 'url', value, n % 300, 100000 FROM addresses WHERE n % 11 = 0
        ), hit AS (
            SELECT DISTINCT p.page_id, p.url, e.list FROM p JOIN entry e
              ON e.value = CASE e.kind WHEN 'host' THEN p.host WHEN 'url' THEN p.host || p.rest
                 ELSE regexp_extract(p.host, '([^.]*\.)?[^.]*$') END
             AND p.page_id * 37 % 366 >= e.starts AND p.page_id * 37 % 366 < e.ends
        )
        SELECT p.page_id, p.url, p.fetched_on, p.host, coalesce(h.lists, '') AS lists, h.lists IS NOT NULL AS blocked
        FROM p LEFT JOIN (SELECT page_id, url, string_agg(list, ',' ORDER BY list) AS lists FROM hit GROUP BY 1, 2) h
          ON p.page_id = h.page_id AND p.url = h.url
    """,
    "op9_rule_ledger": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ), starts AS (
            SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2
        ), grams AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM starts
        ), covered AS (
            SELECT doc_id, count(DISTINCT i + o) AS n
            FROM grams, (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY 1
        ), m AS (
            SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(c.n, 0) AS n_repeat_words,
                   len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letter_words,
                   len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines
            FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id
        ), f AS (
            SELECT *, (n_words < 50)::INT * 1 + (100 * n_repeat_words > 50 * n_words)::INT * 2
                 + (n_symbols > n_words)::INT * 4 + (word_chars < 2 * n_words)::INT * 8
                 + (word_chars > 20 * n_words)::INT * 16 + (n_lines >= 4 AND 2 * n_dup_lines > n_lines)::INT * 32
                 + (10 * n_letter_words < 8 * n_words)::INT * 64
                 + (n_lines >= 4 AND 10 * n_ellipsis_lines > 9 * n_lines)::INT * 128 AS failed
            FROM m
        )
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
               n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
               failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed::BIGINT AS failed, 3 AS policy,
               CASE failed WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_words' WHEN 4 THEN 'many_symbols'
                   WHEN 8 THEN 'short_words' WHEN 16 THEN 'long_words' WHEN 32 THEN 'repeated_lines'
                   WHEN 64 THEN 'few_letters' WHEN 128 THEN 'cut_lines' END AS sole_failure
        FROM f
    """,
    "op12_fim_piece_table": r"""
        WITH h AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                   sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
        ), draws AS (
            SELECT doc_id, t, n, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
                   ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS d FROM h
        ), cuts AS (
            SELECT doc_id, t, n, least(a, b) AS p, greatest(a, b) - least(a, b) AS m,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90
                        THEN 'plain' WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM draws
        ), made AS (
            SELECT *, CASE form WHEN 'plain' THEN t
                WHEN 'psm' THEN '<P>' || t[1:p] || '<S>' || t[p + m + 1:] || '<M>' || t[p + 1:p + m]
                ELSE '<S>' || t[p + m + 1:] || '<P>' || t[1:p] || '<M>' || t[p + 1:p + m] END AS output FROM cuts
        ), found AS (
            SELECT *, instr(output, '<P>') AS ip, instr(output, '<S>') AS i_s, instr(output, '<M>') AS im FROM made
        )
        SELECT doc_id, n::BIGINT AS n, form,
               CASE WHEN form <> 'plain' THEN p::BIGINT END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN m::BIGINT END AS middle_chars,
               sha256(output) AS output_sha256,
               sha256(CASE form WHEN 'plain' THEN output
                   WHEN 'psm' THEN output[ip + 3:i_s - 1] || output[im + 3:] || output[i_s + 3:im - 1]
                   ELSE output[ip + 3:im - 1] || output[im + 3:] || output[i_s + 3:ip - 1] END) AS restored_sha256
        FROM found
    """,
}
