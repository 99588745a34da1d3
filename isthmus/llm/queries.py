"""The queries of this subpackage by name, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from isthmus.llm.html import op10_html_main_text
from isthmus.llm.langid import op8_language_id
from isthmus.llm.mixing import op4_source_mix
from isthmus.llm.ngram_join import OP6_SQL, op6_ngram_jaccard
from isthmus.llm.packing import op1_best_fit_packing
from isthmus.llm.quality import OP5_SQL, op5_quality_rules
from isthmus.llm.substring import OP7_SQL, op7_substring_dedup
from isthmus.llm.tokens import op3_token_store
from isthmus.llm.toxicity import op2_toxicity_crf
from isthmus.llm.vectors import OP9_SQL, op9_embedding_near_dedup

QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_toxicity_crf, op3_token_store, op4_source_mix, op5_quality_rules, op6_ngram_jaccard, op7_substring_dedup, op8_language_id, op9_embedding_near_dedup, op10_html_main_text)}
ORACLE = {"op5_quality_rules": OP5_SQL, "op6_ngram_jaccard": OP6_SQL, "op7_substring_dedup": OP7_SQL, "op9_embedding_near_dedup": OP9_SQL}
