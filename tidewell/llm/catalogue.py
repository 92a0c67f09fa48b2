"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, bpe, chat, exact_dedup, hnsw, licenses, mixing, pii, quality, secrets, sharding, simhash, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_rendezvous_sharding": sharding.op1,
        "op2_fair_queue_mixing": mixing.op2,
        "op3_cuckoo_dedup": exact_dedup.op3,
        "op4_crf_quality": quality.op4,
        "op5_simhash_vantage": simhash.op5,
        "op6_hnsw_vectors": hnsw.op6,
        "op7_bootstrapped_pii": pii.op7,
        "op8_forced_boundary_bpe": bpe.op8,
        "op9_incremental_chat": chat.op9,
        "op10_license_scan": licenses.op10,
        "op11_zstd_secrets": secrets.op11,
        "op12_pointer_jumping": alignment.op12,
        "op13_polarised_whitening": whitening.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_fair_queue_mixing": mixing.OP2_SQL, "op3_cuckoo_dedup": exact_dedup.OP3_SQL, "op9_incremental_chat": chat.OP9_SQL}
