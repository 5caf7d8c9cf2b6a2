"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .backoff_lm import op9_backoff_lm
from .centroids import OP11_SQL, op11_centroids
from .decontaminate import op2_decontaminate
from .distinct_bpe import op13_distinct_bpe
from .jaccard_join import OP8_SQL, op8_jaccard_join
from .media import op5_media
from .mil_quality import op10_mil_quality
from .packing import op3_packing
from .pii import op6_pii
from .repair_ids import op1_repair_ids
from .revisit import OP7_SQL, op7_revisits
from .token_fst import op4_token_fst
from .turn_repair import OP12_SQL, op12_turn_repair

QUERIES = {f.__name__: f for f in (op1_repair_ids, op2_decontaminate, op3_packing, op4_token_fst, op5_media, op6_pii, op7_revisits, op8_jaccard_join, op9_backoff_lm, op10_mil_quality, op11_centroids, op12_turn_repair, op13_distinct_bpe)}
ORACLE_SQL: dict[str, str] = {"op7_revisits": OP7_SQL, "op8_jaccard_join": OP8_SQL, "op11_centroids": OP11_SQL, "op12_turn_repair": OP12_SQL}
