"""Queries of the corpus operators for ``__spark_entry__``: thin bindings to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (ann, bpe, e8, minhash, mixing, quality, repeats, secrets, sharding, spelling, surrogates, url_rules,
               whitening)
from ._util import read_table


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(read_table(spark, sf_dir, "documents"))


def op2_bpe_rank_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"))


def op3_lcp_interval_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"))


def op4_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_multiprobe_pstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op6_e8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e8.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op7_url_rarest_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"))


def op8_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(read_table(spark, sf_dir, "documents"))


def op9_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), width=4)


def op10_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(read_table(spark, sf_dir, "documents"))


def op11_sturm_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read_table(spark, sf_dir, "documents"))


def op13_sorted_list_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_surrogates, op2_bpe_rank_array, op3_lcp_interval_repeats, op4_attention_quality, op5_multiprobe_pstable,
                            op6_e8_lattice, op7_url_rarest_literal, op8_pfair_mix, op9_bbit_minhash,
                            op10_trigram_secrets, op11_sturm_whitening, op12_sampled_splitters,
                            op13_sorted_list_spelling)}

ORACLES: dict[str, str] = {
    "op7_url_rarest_literal": url_rules.oracle_sql(),
    "op8_pfair_mix": mixing.oracle_sql(),
    "op10_trigram_secrets": secrets.oracle_sql(),
}
