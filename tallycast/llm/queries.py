"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from .centroids import OP11_SQL, op11_centroids
from .decontamination import op1_decontamination
from .language import op4_language
from .near_dedup import op5_near_dedup
from .packing import op2_packing
from .quality_qda import op3_quality
from .quality_rules import op7_quality_rules
from .sharding import OP12_SQL, op12_sharding
from .substrings import op8_substrings
from .token_counts import op9_token_counts
from .token_links import op13_token_links
from .toxicity import op6_toxicity
from .warc import OP10_SQL, op10_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_packing, op3_quality, op4_language, op5_near_dedup,
        op6_toxicity, op7_quality_rules, op8_substrings, op9_token_counts, op10_warc, op11_centroids, op12_sharding, op13_token_links,
    )
}
ORACLES: dict[str, str] = {"op10_warc": OP10_SQL, "op11_centroids": OP11_SQL, "op12_sharding": OP12_SQL}
