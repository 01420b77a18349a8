"""The queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from . import ann, decontam, langid, lines, minhash, mixing, oracles, pii, substrings, suffixes, tokens


def pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_mix": mixing.op1_mix,
        "op2_language": langid.op2_language,
        "op3_tokens": tokens.op3_tokens,
        "op4_suffixes": suffixes.op4_suffixes,
        "op5_neighbours": ann.op5_neighbours,
        "op6_minhash": minhash.op6_minhash,
        "op7_decontaminate": decontam.op7_decontaminate,
        "op8_substrings": substrings.op8_substrings,
        "op9_pii": pii.op9_pii,
        "op10_lines": lines.op10_lines,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix": mixing.mix_sql(),
        "op4_suffixes": oracles.suffixes_sql(),
        "op6_minhash": oracles.minhash_sql(),
        "op7_decontaminate": oracles.decontam_sql(),
        "op8_substrings": oracles.substrings_sql(),
        "op9_pii": oracles.pii_sql(),
        "op10_lines": lines.lines_sql(),
    }
