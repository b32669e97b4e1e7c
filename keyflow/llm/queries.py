"""Registered queries of the training-data operators and their SQL (None where SQL cannot express one)."""

from __future__ import annotations

from keyflow.llm.bpe import op1_bpe
from keyflow.llm.idfiles import op11_idfiles
from keyflow.llm.importance import OP12_SQL, op12_importance
from keyflow.llm.jaccard import op2_jaccard
from keyflow.llm.jump import op9_shards
from keyflow.llm.mixing import op6_mixing
from keyflow.llm.pii import op7_pii
from keyflow.llm.phrases import OP13_SQL, op13_phrases
from keyflow.llm.secrets import op3_secrets
from keyflow.llm.simhash import op8_simhash
from keyflow.llm.topk import OP5_SQL, op5_topk
from keyflow.llm.toxicity import op10_toxicity
from keyflow.llm.warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_jaccard": op2_jaccard,
    "op3_secrets": op3_secrets,
    "op4_warc": op4_warc,
    "op5_topk": op5_topk,
    "op6_mixing": op6_mixing,
    "op7_pii": op7_pii,
    "op8_simhash": op8_simhash,
    "op9_shards": op9_shards,
    "op10_toxicity": op10_toxicity,
    "op11_idfiles": op11_idfiles,
    "op12_importance": op12_importance,
    "op13_phrases": op13_phrases,
}

ORACLES: dict[str, str] = {"op4_warc": OP4_SQL, "op5_topk": OP5_SQL, "op12_importance": OP12_SQL, "op13_phrases": OP13_SQL}
