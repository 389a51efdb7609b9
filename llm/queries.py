"""The operators' queries over the given tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import collocations, decontam, embeddings, hard_negatives
from llm.bpe import op10_bpe
from llm.collocations import op12_collocations
from llm.decontam import op1_decontamination
from llm.embeddings import op3_embeddings
from llm.fingerprints import op11_fingerprints
from llm.hard_negatives import op13_hard_negatives
from llm.jaccard import op5_jaccard_join
from llm.passages import op6_passages
from llm.pii import op4_pii
from llm.records import op9_token_records
from llm.secret_scan import op7_secrets
from llm.toxicity import op2_toxicity
from llm.wrappers import op8_article_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_embeddings": op3_embeddings,
    "op4_pii": op4_pii,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_passages": op6_passages,
    "op7_secrets": op7_secrets,
    "op8_article_text": op8_article_text,
    "op9_token_records": op9_token_records,
    "op10_bpe": op10_bpe,
    "op11_fingerprints": op11_fingerprints,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": decontam.ORACLE,
    "op3_embeddings": embeddings.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
