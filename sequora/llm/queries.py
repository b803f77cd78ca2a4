"""Registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from functools import wraps

from sequora.llm.alignment import op13_alignment
from sequora.llm.bpe import op4_bpe
from sequora.llm.collocations import OP12_SQL, op12_collocations
from sequora.llm.common import prepare
from sequora.llm.html_text import op10_html_text
from sequora.llm.jaccard_join import op3_jaccard_join
from sequora.llm.language_model import op5_language_model
from sequora.llm.line_dedup import OP7_SQL, op7_line_dedup
from sequora.llm.packing import op6_packing
from sequora.llm.token_files import op2_token_files
from sequora.llm.toxicity import op8_toxicity
from sequora.llm.vectors import OP1_SQL, OP9_SQL, op1_near_duplicates, op9_top_k
from sequora.llm.warc import OP11_SQL, op11_warc


def _query(f):
    @wraps(f)
    def run(spark, sf_dir):
        prepare(spark)
        return f(spark, sf_dir)

    return run


QUERIES = {f.__name__: _query(f) for f in (op1_near_duplicates, op2_token_files, op3_jaccard_join, op4_bpe, op5_language_model, op6_packing, op7_line_dedup, op8_toxicity, op9_top_k, op10_html_text, op11_warc, op12_collocations, op13_alignment)}

ORACLE_SQL: dict[str, str] = {"op1_near_duplicates": OP1_SQL, "op7_line_dedup": OP7_SQL, "op9_top_k": OP9_SQL, "op11_warc": OP11_SQL, "op12_collocations": OP12_SQL}
