"""The registered queries of this subpackage and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from adherence.llm import (
    collocations,
    decontaminate,
    html_text,
    licenses,
    line_dedup,
    metric_search,
    mixing,
    near_dup,
    quality,
    spelling,
    token_counts,
    url_filters,
    warc,
)

QUERIES = {
    "op1_licenses": licenses.op1_licenses,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_url_filters": url_filters.op3_url_filters,
    "op4_html_text": html_text.op4_html_text,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_quality": quality.op6_quality,
    "op7_mixing": mixing.op7_mixing,
    "op8_top_k": metric_search.op8_top_k,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_near_dup": near_dup.op10_near_dup,
    "op11_spelling": spelling.op11_spelling,
    "op12_collocations": collocations.op12_collocations,
    "op13_warc": warc.op13_warc,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op7_mixing": mixing.ORACLE,
    "op8_top_k": metric_search.ORACLE,
    "op10_near_dup": near_dup.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_warc": warc.ORACLE,
    **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
}
