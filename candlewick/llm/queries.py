"""The registered queries of this folder and their SQL."""

from __future__ import annotations

import corpus_pipeline
from candlewick.llm.bpe import op1_bpe
from candlewick.llm.decontaminate import OP5_SQL, op5_decontaminate
from candlewick.llm.html_extract import op7_html
from candlewick.llm.lexical_search import OP12_SQL, op12_lexical_search
from candlewick.llm.line_dedup import OP3_SQL, op3_line_dedup
from candlewick.llm.secrets_scan import op9_secrets
from candlewick.llm.simhash import op6_simhash
from candlewick.llm.token_counts import op10_token_counts
from candlewick.llm.token_files import op13_token_files
from candlewick.llm.toxicity import op2_toxicity
from candlewick.llm.url_filter import op8_url_filter
from candlewick.llm.weighted_sampling import op4_fingerprints
from candlewick.llm.whitening import op11_whitening

QUERIES = {f.__name__: f for f in (op1_bpe, op2_toxicity, op3_line_dedup, op4_fingerprints, op5_decontaminate, op6_simhash,
                                   op7_html, op8_url_filter, op9_secrets, op10_token_counts, op11_whitening, op12_lexical_search,
                                   op13_token_files)} | {"pipeline": corpus_pipeline.run}
ORACLES = {"op3_line_dedup": OP3_SQL, "op5_decontaminate": OP5_SQL, "op12_lexical_search": OP12_SQL}
