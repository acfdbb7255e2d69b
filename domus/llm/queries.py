"""The registered queries of this package, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from domus.llm.op1_mixing import op1_mixing
from domus.llm.op2_substrings import op2_substrings
from domus.llm.op3_secrets import op3_secrets
from domus.llm.op4_toxicity import op4_toxicity
from domus.llm.op5_minhash import op5_minhash
from domus.llm.op6_html import op6_html
from domus.llm.op7_chat import OP7_SQL, op7_chat
from domus.llm.op8_embeddings import op8_embeddings
from domus.llm.op9_decontamination import OP9_SQL, op9_decontamination
from domus.llm.op10_warc import OP10_SQL, op10_warc
from domus.llm.op11_urls import OP11_SQL, op11_urls
from domus.llm.op12_ranked import OP12_SQL, op12_ranked
from domus.llm.op13_fim import OP13_SQL, op13_fim

QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_substrings, op3_secrets, op4_toxicity, op5_minhash, op6_html, op7_chat, op8_embeddings,
    op9_decontamination, op10_warc, op11_urls, op12_ranked, op13_fim)}
ORACLE = {"op7_chat": OP7_SQL, "op9_decontamination": OP9_SQL, "op10_warc": OP10_SQL, "op11_urls": OP11_SQL,
          "op12_ranked": OP12_SQL, "op13_fim": OP13_SQL}
