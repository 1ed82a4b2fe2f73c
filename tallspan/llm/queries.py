"""Queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from .bpe import op5
from .decontamination import OP3_SQL, op3
from .line_dedup import op4
from .near_dedup import op1
from .pii import op9
from .quality_model import op2
from .quality_rules import op7
from .sharding import op6
from .token_counts import op8
from .toxicity import op10

QUERIES = {
    "op1_near_dedup": op1,
    "op2_quality_classifier": op2,
    "op3_decontamination": op3,
    "op4_line_dedup": op4,
    "op5_byte_bpe": op5,
    "op6_sharding": op6,
    "op7_quality_rules": op7,
    "op8_token_counts": op8,
    "op9_pii": op9,
    "op10_toxicity": op10,
}

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": OP3_SQL,
}
