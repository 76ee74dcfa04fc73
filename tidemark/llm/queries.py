"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from .decontam import op8_decontamination
from .licenses import op9_license_scan
from .near_dedup import op1_near_dedup
from .packing import op6_packing
from .periodic_runs import op11_periodic_runs
from .pieces import op13_sentencepiece
from .quality_model import op4_quality_classifier
from .quality_rules import op10_quality_rules
from .sharding import op2_sharding
from .suffix_dedup import op5_suffix_dedup
from .toxicity import op7_toxicity
from .url_filter import op3_url_filter
from .whitening import op12_embedding_whitening

QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_sharding, op3_url_filter, op4_quality_classifier, op5_suffix_dedup,
    op6_packing, op7_toxicity, op8_decontamination, op9_license_scan, op10_quality_rules,
    op11_periodic_runs, op12_embedding_whitening, op13_sentencepiece)}
# None of these has an equivalent in SQL: each learns, iterates or schedules.
ORACLE_SQL: dict[str, str] = {}
