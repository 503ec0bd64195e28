"""The operators of this package over the given tables, and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from strandline.llm import (
    ball_codes,
    bpe,
    chat,
    chunk_bpe,
    exact_dedup,
    fertility,
    line_dedup,
    lm_score,
    merkle,
    mixing,
    quality_model,
    simhash,
    token_counts,
)

QUERIES = {
    "op1_source_mixing": mixing.op1,
    "op2_lm_score": lm_score.op2,
    "op3_quality_model": quality_model.op3,
    "op4_line_dedup": line_dedup.op4,
    "op5_bpe_round_trip": bpe.op5,
    "op6_token_counts": token_counts.op6,
    "op7_simhash": simhash.op7,
    "op8_chat_format": chat.op8,
    "op9_fertility_rules": fertility.op9,
    "op10_exact_dedup": exact_dedup.op10,
    "op11_chunk_reuse_bpe": chunk_bpe.op11,
    "op12_ball_codes": ball_codes.op12,
    "op13_merkle_manifest": merkle.op13,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_source_mixing": mixing.OP1_SQL,
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op8_chat_format": chat.OP8_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op12_ball_codes": ball_codes.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
