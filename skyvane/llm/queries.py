"""Queries of the training-data operators: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

from skyvane.llm.centroids import OP11_SQL, op11_centroids
from skyvane.llm.decontaminate import op7_decontaminate
from skyvane.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from skyvane.llm.fill_in_middle import OP12_SQL, op12_fill_in_middle
from skyvane.llm.html_extract import op1_html_extract
from skyvane.llm.near_dedup import op5_near_dedup
from skyvane.llm.packing import op9_packing
from skyvane.llm.quality import op2_quality
from skyvane.llm.sharding import op8_sharding
from skyvane.llm.substring_dedup import OP10_SQL, op10_substring_dedup
from skyvane.llm.token_codes import op6_token_codes
from skyvane.llm.token_counts import op13_token_counts
from skyvane.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_html_extract": (op1_html_extract, None),
    "op2_quality": (op2_quality, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_exact_dedup": (op4_exact_dedup, OP4_SQL),
    "op5_near_dedup": (op5_near_dedup, None),
    "op6_token_codes": (op6_token_codes, None),
    "op7_decontaminate": (op7_decontaminate, None),
    "op8_sharding": (op8_sharding, None),
    "op9_packing": (op9_packing, None),
    "op10_substring_dedup": (op10_substring_dedup, OP10_SQL),
    "op11_centroids": (op11_centroids, OP11_SQL),
    "op12_fill_in_middle": (op12_fill_in_middle, OP12_SQL),
    "op13_token_counts": (op13_token_counts, None),
}
