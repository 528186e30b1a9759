"""The queries of the corpus operators, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from genomill.llm.collocations import OP11_SQL, op11_collocations
from genomill.llm.decontaminate import op4_decontaminate
from genomill.llm.html_text import op3_html
from genomill.llm.langid import op6_langid
from genomill.llm.line_dedup import OP10_SQL, op10_lines
from genomill.llm.mixing import OP7_BUDGET_SQL, OP7_ENTROPY_SQL, OP7_SQL, op7_mix, op7_mix_budget, op7_mix_entropy
from genomill.llm.near_dedup import op9_minhash
from genomill.llm.neighbours import op2_neighbours
from genomill.llm.passages import op1_passages
from genomill.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from genomill.llm.quality import op13_quality
from genomill.llm.sharding import OP5_SMALL_SQL, OP5_SQL, op5_shards, op5_small_shards
from genomill.llm.token_ids import op8_token_ids

QUERIES = {
    "op1_passages": op1_passages,
    "op2_neighbours": op2_neighbours,
    "op3_html": op3_html,
    "op4_decontaminate": op4_decontaminate,
    "op5_shards": op5_shards,
    "op6_langid": op6_langid,
    "op7_mix": op7_mix,
    "op8_token_ids": op8_token_ids,
    "op9_minhash": op9_minhash,
    "op10_lines": op10_lines,
    "op11_collocations": op11_collocations,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_quality": op13_quality,
    "op5_small_shards": op5_small_shards,
    "op7_mix_budget": op7_mix_budget,
    "op7_mix_entropy": op7_mix_entropy,
}

ORACLE_SQL = {"op5_shards": OP5_SQL, "op7_mix": OP7_SQL, "op5_small_shards": OP5_SMALL_SQL, "op7_mix_budget": OP7_BUDGET_SQL, "op7_mix_entropy": OP7_ENTROPY_SQL, "op10_lines": OP10_SQL, "op11_collocations": OP11_SQL, "op12_prefix_trie": OP12_SQL}
