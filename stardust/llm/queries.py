"""Registry of the subpackage's queries and their DuckDB oracle texts (None
where SQL cannot express the operator; its tests hold a brute-force version)."""

from __future__ import annotations

from . import (
    op1_divergence, op2_chat, op3_lines, op4_langid, op5_mix, op6_kdtree, op7_jaccard, op8_passages, op9_rans, op10_pack,
    op11_prefix_counts, op12_collocations, op13_merkle,
)

QUERIES = {
    "op1_divergence": op1_divergence.op1_divergence,
    "op2_chat": op2_chat.op2_chat,
    "op3_lines": op3_lines.op3_lines,
    "op4_langid": op4_langid.op4_langid,
    "op5_mix": op5_mix.op5_mix,
    "op6_kdtree": op6_kdtree.op6_kdtree,
    "op7_jaccard": op7_jaccard.op7_jaccard,
    "op8_passages": op8_passages.op8_passages,
    "op9_rans": op9_rans.op9_rans,
    "op10_pack": op10_pack.op10_pack,
    "op11_prefix_counts": op11_prefix_counts.op11_prefix_counts,
    "op12_collocations": op12_collocations.op12_collocations,
    "op13_merkle": op13_merkle.op13_merkle,
}

ORACLE = {"op5_mix": op5_mix.SQL, "op6_kdtree": op6_kdtree.SQL, "op7_jaccard": op7_jaccard.SQL, "op12_collocations": op12_collocations.SQL,
          "op13_merkle": op13_merkle.SQL}
