"""The registered queries of this package and their SQL."""

from __future__ import annotations

from .bottomk import op7_query
from .chat_format import OP8_SQL, op8_query
from .cross_polytope import op5_query
from .curriculum import OP9_SQL, op9_query
from .ecoc_langid import op4_query
from .hilbert import op2_query
from .jaccard_join import op1_query
from .mil_quality import op3_query
from .recompression import op12_query
from .sos_packing import op6_query
from .shared import shipped
from .token_align import op13_query
from .warc_zstd import OP10_SQL, op10_query
from .wu_manber import OP11_SQL, op11_query

QUERIES = {
    "op1_ngram_jaccard_join": shipped(op1_query),
    "op2_hilbert_sharding": shipped(op2_query),
    "op3_attention_quality": shipped(op3_query),
    "op4_ecoc_language_id": shipped(op4_query),
    "op5_cross_polytope": shipped(op5_query),
    "op6_sum_of_squares_packing": shipped(op6_query),
    "op7_bottomk_fingerprints": shipped(op7_query),
    "op8_chat_format": shipped(op8_query),
    "op9_curriculum_mix": shipped(op9_query),
    "op10_warc_seekable": shipped(op10_query),
    "op11_wu_manber_decontamination": shipped(op11_query),
    "op12_recompression_runs": shipped(op12_query),
    "op13_token_alignment": shipped(op13_query),
}

SQL = {
    "op8_chat_format": OP8_SQL,
    "op9_curriculum_mix": OP9_SQL,
    "op10_warc_seekable": OP10_SQL,
    "op11_wu_manber_decontamination": OP11_SQL,
}
