"""The operators' queries over the driver's tables, and the SQL where it can express them."""

import corpus_pipeline

from paperloom.llm import (
    decontaminate,
    hamming_search,
    html_extract,
    kneser_ney,
    line_dedup,
    pii,
    quality,
    sentencepiece_viterbi,
    simhash,
    tool_calls,
)

QUERIES = {
    "op1_html": html_extract.op1_html,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_hamming_search": hamming_search.op3_hamming_search,
    "op4_tool_calls": tool_calls.op4_tool_calls,
    "op5_quality": quality.op5_quality,
    "op6_sentencepiece": sentencepiece_viterbi.op6_sentencepiece,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_kneser_ney": kneser_ney.op8_kneser_ney,
    "op9_simhash": simhash.op9_simhash,
    "op10_pii": pii.op10_pii,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {"op4_tool_calls": tool_calls.OP4_SQL}
