"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicforge.llm import byte_bpe, cover_tree, exact_dedup, kmeans_tree, langid, licenses, order_minhash, packing, sharding, token_align, toxicity, url_rules, whitening
from topicforge.llm.common import crc_mod, read, scratch_table


def op1_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(read(spark, sf_dir, "documents"))


def packed_digests(docs: DataFrame) -> DataFrame:
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op2_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(read(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read(spark, sf_dir, "pages"))


def op4_best_bin_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_subword_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs, langid.learnable())
    return langid.predict(docs, model).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op6_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.link_near(read(spark, sf_dir, "embeddings"))


def op7_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = byte_bpe.encode_documents(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_fair_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), toxicity.learnable())
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_shard_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records: id, size, checksum and a hash of the text, which puts equal
    texts next to each other."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"))
    return sharding.shard_records(docs, ["text_hash", "doc_id"], "size").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_groups(read(spark, sf_dir, "documents"))


def op11_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op12_pointer_jumping(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_align.align_documents(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))
    written = scratch_table(aligned.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"), "pairs", "times"), "aligned")
    return token_align.link_statistics(written).drop("row")


def op13_contour_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("bigint"))


#: Known sentences as they stand after normalising, written out by hand for
#: the notices that the documents carry.
_OP2_SQL = r"""
WITH known(norm, code, license) AS (VALUES
    ('licensed under the apache license version 2 0', 'a01', 'Apache-2.0'),
    ('licensed under cc by nc 4 0', 'c01', 'CC-BY-NC-4.0'),
    ('this work is licensed under the gnu general public license version 3', 'g01', 'GPL-3.0-only'),
    ('released under the mit license', 'm01', 'MIT'),
    ('all rights reserved', 'r02', 'all-rights-reserved')),
pieces AS (
    SELECT doc_id, unnest(p) AS piece, unnest(range(len(p))) AS place
    FROM (SELECT doc_id, list_filter(
              string_split_regex(regexp_replace(text, '([.!?;:])[ \t\r\n]+', '\1' || chr(10), 'g'), '[\r\n]+'),
              lambda x: regexp_matches(x, '[A-Za-z0-9]')) AS p
          FROM documents))
SELECT doc_id, license, place::INT AS first_sentence, place::INT AS last_sentence, code AS sentence_codes
FROM pieces JOIN known ON norm = trim(lower(regexp_replace(piece, '[^A-Za-z0-9]+', ' ', 'g')))
"""

_OP3_SQL = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id, rest,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut),
rules(rule, rule_host, rule_path, verdict) AS (VALUES
    ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
    ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
    ('com/de/', 'com', '/de/', 'block')),
patterns(pattern, expression) AS (VALUES
    ('||ads-track.', '^([^/?#]*[.])?ads-track[.]'), ('||adult-x.', '^([^/?#]*[.])?adult-x[.]'),
    ('||casino-win.', '^([^/?#]*[.])?casino-win[.]'), ('||cheap-pills.', '^([^/?#]*[.])?cheap-pills[.]'),
    ('||free-bets.', '^([^/?#]*[.])?free-bets[.]'), ('||spam-farm.', '^([^/?#]*[.])?spam-farm[.]'),
    ('||doubleclick.net/', '^([^/?#]*[.])?doubleclick[.]net/'), ('/wp-login.php', '/wp-login[.]php'),
    ('/cgi-bin/', '/cgi-bin/'), ('?sessionid=', '[?]sessionid='), ('/affiliate/*/click', '(?s)/affiliate/.*/click')),
by_rule AS (
    SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS rule_verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id),
by_pattern AS (
    SELECT page_id, max_by(pattern, (length(pattern), pattern)) AS pattern
    FROM parts JOIN patterns ON regexp_matches(host || translate(substr(rest, length(host) + 1),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), expression)
    GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       pattern
FROM parts LEFT JOIN by_rule USING (page_id) LEFT JOIN by_pattern USING (page_id)
"""


_OP11_SQL = r"""
WITH rows AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
groups AS (
    SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM rows JOIN groups USING (norm)
"""


def registry() -> dict:
    return {"op1_cost_packing": op1_cost_packing,
            "op2_license_sentences": op2_license_sentences,
            "op3_url_rules": op3_url_rules,
            "op4_best_bin_first": op4_best_bin_first,
            "op5_subword_language": op5_subword_language,
            "op6_cover_tree": op6_cover_tree,
            "op7_bpe_replay": op7_bpe_replay,
            "op8_fair_toxicity": op8_fair_toxicity,
            "op9_shard_ranges": op9_shard_ranges,
            "op10_order_minhash": op10_order_minhash,
            "op11_content_hash": op11_content_hash,
            "op12_pointer_jumping": op12_pointer_jumping,
            "op13_contour_whitening": op13_contour_whitening}


def oracles() -> dict[str, str]:
    return {"op2_license_sentences": _OP2_SQL, "op3_url_rules": _OP3_SQL, "op11_content_hash": _OP11_SQL}
