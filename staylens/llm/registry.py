"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from staylens.llm.attention_lm import op8_attention_lm
from staylens.llm.bitpack import op10_bitpack
from staylens.llm.cotraining import op9_cotraining
from staylens.llm.decontamination import op7_decontamination
from staylens.llm.jaccard import op5_jaccard
from staylens.llm.lines import op3_lines
from staylens.llm.mixing import op2_mixing
from staylens.llm.periodic_runs import op12_periodic_runs
from staylens.llm.segment_bpe import op13_segment_bpe
from staylens.llm.sharding import op4_sharding
from staylens.llm.style_tree import op6_style_tree
from staylens.llm.warc import op1_warc
from staylens.llm.whitening import op11_whitening

QUERIES = {
    "op1_warc": op1_warc,
    "op2_mixing": op2_mixing,
    "op3_lines": op3_lines,
    "op4_sharding": op4_sharding,
    "op5_jaccard": op5_jaccard,
    "op6_style_tree": op6_style_tree,
    "op7_decontamination": op7_decontamination,
    "op8_attention_lm": op8_attention_lm,
    "op9_cotraining": op9_cotraining,
    "op10_bitpack": op10_bitpack,
    "op11_whitening": op11_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_segment_bpe": op13_segment_bpe,
}

SQL: dict[str, str] = {}
