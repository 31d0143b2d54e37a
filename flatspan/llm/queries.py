"""The registered queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from flatspan.llm.chat import OP3_SQL, op3_chat
from flatspan.llm.decontaminate import OP7_SQL, op7_decontaminate
from flatspan.llm.knn_join import OP13_SQL, op13_knn_join
from flatspan.llm.neighbours import op5_neighbours
from flatspan.llm.packing import op10_packing
from flatspan.llm.pii import op9_pii
from flatspan.llm.quality import op6_quality
from flatspan.llm.repair import op12_repair
from flatspan.llm.simhash import op1_simhash
from flatspan.llm.suffix_dedup import op8_suffix_dedup
from flatspan.llm.token_counts import op4_token_counts
from flatspan.llm.warc import op2_warc
from flatspan.llm.whitening import op11_whitening

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_warc": op2_warc,
    "op3_chat": op3_chat,
    "op4_token_counts": op4_token_counts,
    "op5_neighbours": op5_neighbours,
    "op6_quality": op6_quality,
    "op7_decontaminate": op7_decontaminate,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_pii": op9_pii,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_repair": op12_repair,
    "op13_knn_join": op13_knn_join,
}

ORACLES: dict[str, str] = {"op3_chat": OP3_SQL, "op7_decontaminate": OP7_SQL, "op13_knn_join": OP13_SQL}
