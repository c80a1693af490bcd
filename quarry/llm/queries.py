"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from quarry.llm import (decontaminate, gracehash, licenses, linededup, manifest, minhash, mixing, ngramlm, quality,
                        resampling, suffixes, toxicity, warc)


def queries() -> dict:
    return {
        "op1_quality_divergence": quality.op1_quality_divergence,
        "op2_line_dedup": linededup.op2_line_dedup,
        "op3_minhash_near_dup": minhash.op3_minhash_near_dup,
        "op4_license_patience": licenses.op4_license_patience,
        "op5_mix_sources": mixing.op5_mix_sources,
        "op6_warc_zip_archives": warc.op6_warc_zip_archives,
        "op7_spaced_seed_decontamination": decontaminate.op7_spaced_seed_decontamination,
        "op8_stupid_backoff": ngramlm.op8_stupid_backoff,
        "op9_toxicity_ftrl": toxicity.op9_toxicity_ftrl,
        "op10_suffix_array_dedup": suffixes.op10_suffix_array_dedup,
        "op11_merkle_multiproof": manifest.op11_merkle_multiproof,
        "op12_exact_grace_dedup": gracehash.op12_exact_grace_dedup,
        "op13_importance_resample": resampling.op13_importance_resample,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_divergence": quality.OP1_SQL,
        "op2_line_dedup": linededup.OP2_SQL,
        "op3_minhash_near_dup": minhash.OP3_SQL,
        "op5_mix_sources": mixing.OP5_SQL,
        "op6_warc_zip_archives": warc.OP6_SQL,
        "op8_stupid_backoff": ngramlm.OP8_SQL,
        "op11_merkle_multiproof": manifest.OP11_SQL,
        "op12_exact_grace_dedup": gracehash.OP12_SQL,
        "op13_importance_resample": resampling.OP13_SQL,
    }
