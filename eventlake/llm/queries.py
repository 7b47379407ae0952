"""The registered query of each operator.  Only op12 has DuckDB SQL: DuckDB has no counterpart of the
models, archives, trees and tokenizers, and the rest is held against brute force in tests/llm."""

from eventlake.llm.conversation_repair import op11_conversation_repair
from eventlake.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from eventlake.llm.html_text import op13_html_extraction
from eventlake.llm.mixing import op4_mixing
from eventlake.llm.near_dedup import op9_near_dedup
from eventlake.llm.packing import op7_packing
from eventlake.llm.passages import op5_passages
from eventlake.llm.pii import op1_pii
from eventlake.llm.quality_classifier import op6_quality_classifier
from eventlake.llm.quality_rules import op2_quality_rules
from eventlake.llm.secrets import op8_secrets
from eventlake.llm.vector_search import op10_vector_search
from eventlake.llm.warc import op3_warc

QUERIES = {f.__name__: f for f in (
    op1_pii, op2_quality_rules, op3_warc, op4_mixing, op5_passages, op6_quality_classifier, op7_packing, op8_secrets,
    op9_near_dedup, op10_vector_search, op11_conversation_repair, op12_hard_negatives, op13_html_extraction)}
ORACLE: dict[str, str] = {"op12_hard_negatives": OP12_SQL}
