"""The llm queries and their SQL; ``__spark_entry__`` adds them when this
package is there."""

from __future__ import annotations

from refinery.llm import (
    chat,
    codes,
    decontaminate,
    hmm,
    infill,
    language,
    line_dedup,
    near_dups,
    neighbours,
    packing,
    pieces,
    sharding,
    substrings,
)

QUERIES = {
    "op1_extendible_shards": sharding.op1_extendible_shards,
    "op2_repeated_spans": substrings.op2_repeated_spans,
    "op3_chat_windows": chat.op3_chat_windows,
    "op4_neighbours": neighbours.op4_neighbours,
    "op5_hmm_scores": hmm.op5_hmm_scores,
    "op6_near_duplicates": near_dups.op6_near_duplicates,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_best_fit": packing.op8_best_fit,
    "op9_languages": language.op9_languages,
    "op10_site_lines": line_dedup.op10_site_lines,
    "op11_infill": infill.op11_infill,
    "op12_codes": codes.op12_codes,
    "op13_pieces": pieces.op13_pieces,
}

SQL = {
    "op1_extendible_shards": sharding.OP1_SQL,
    "op2_repeated_spans": substrings.OP2_SQL,
    "op6_near_duplicates": near_dups.OP6_SQL,
    "op7_decontaminate": decontaminate.OP7_SQL,
    "op10_site_lines": line_dedup.OP10_SQL,
    "op11_infill": infill.OP11_SQL,
    "op12_codes": codes.OP12_SQL,
}
