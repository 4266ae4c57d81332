"""The corpus queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from vocabloom.llm import (
    curve_packing,
    exact_dedup,
    kd_shards,
    language_id,
    licences,
    line_dedup,
    phrase_tiles,
    piece_codec,
    simhash_native,
    simhash_neardup,
    toxicity,
    warc,
    whitening,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        licences.op1_license_scan, warc.op2_warc_archive, toxicity.op3_toxicity, simhash_neardup.op4_simhash_neardup,
        simhash_native.op5_document_fingerprints, language_id.op6_language_id, kd_shards.op7_kd_shards,
        curve_packing.op8_curve_packing, piece_codec.op9_piece_codec, exact_dedup.op10_exact_dedup, whitening.op11_embedding_whitening, phrase_tiles.op12_phrase_collocations, line_dedup.op13_line_dedup,
    )
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_archive": warc.OP2_SQL, "op10_exact_dedup": exact_dedup.OP10_SQL, "op12_phrase_collocations": phrase_tiles.OP12_SQL, "op13_line_dedup": line_dedup.OP13_SQL}
