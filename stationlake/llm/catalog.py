"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers

from stationlake.llm import (
    bpe_automaton,
    fingerprints,
    line_dedup,
    merkle,
    minhash,
    mixing,
    packing,
    quality_ledger,
    repeats,
    secrets_scan,
    token_alignment,
    toxicity,
    url_lists,
)
from stationlake.llm.common import documents, table


def op2_url_filters(spark, sf_dir):
    return url_lists.url_filters(spark, sf_dir)


def vocabulary() -> str:
    """The public vocabulary file that sequences are packed for."""
    return public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scan(spark, sf_dir):
    return secrets_scan.secret_scan(documents(spark, sf_dir))


def op3_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), vocabulary())


def op4_fingerprints(spark, sf_dir):
    return fingerprints.edited(documents(spark, sf_dir))


def op5_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(documents(spark, sf_dir))


def op6_repeats(spark, sf_dir):
    return repeats.repeats(documents(spark, sf_dir))


def op7_quality_rules(spark, sf_dir):
    return quality_ledger.quality_rules(documents(spark, sf_dir))


def op8_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


def op9_near_duplicates(spark, sf_dir):
    found = minhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_toxicity(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op11_bpe_coding(spark, sf_dir):
    return bpe_automaton.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest(documents(spark, sf_dir))


def op13_token_alignment(spark, sf_dir):
    return token_alignment.alignment(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_url_filters": op2_url_filters,
    "op3_packing": op3_packing,
    "op4_fingerprints": op4_fingerprints,
    "op5_line_dedup": op5_line_dedup,
    "op6_repeats": op6_repeats,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_toxicity": op10_toxicity,
    "op11_bpe_coding": op11_bpe_coding,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE = {
    "op2_url_filters": url_lists.ORACLE,
    "op5_line_dedup": line_dedup.ORACLE,
    "op7_quality_rules": quality_ledger.ORACLE,
    "op8_mixing": mixing.ORACLE,
}
