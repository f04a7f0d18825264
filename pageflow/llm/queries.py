"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from pageflow.llm import oracles
from pageflow.llm.centroids import op12_centroids
from pageflow.llm.decontamination import op1_decontamination
from pageflow.llm.fuzzy_lines import op9_fuzzy_lines
from pageflow.llm.language import op4_language
from pageflow.llm.licences import op10_licences
from pageflow.llm.mixing import op8_mixing
from pageflow.llm.quality import op6_quality
from pageflow.llm.sharding import op3_sharding
from pageflow.llm.similarity import op5_jaccard
from pageflow.llm.spelling import op11_spelling
from pageflow.llm.substrings import op7_substrings
from pageflow.llm.token_files import op13_token_files
from pageflow.llm.toxicity import op2_toxicity

QUERIES = {q.__name__: q for q in (op1_decontamination, op2_toxicity, op3_sharding, op4_language, op5_jaccard, op6_quality,
                                   op7_substrings, op8_mixing, op9_fuzzy_lines, op10_licences, op11_spelling,
                                   op12_centroids, op13_token_files)}
#: The others depend on a hash, a sample or a trained model; they are tested against brute force or held-out rows.
ORACLE_SQL = {"op5_jaccard": oracles.JACCARD, "op6_quality": oracles.QUALITY, "op7_substrings": oracles.SUBSTRINGS,
              "op11_spelling": oracles.SPELLING, "op12_centroids": oracles.CENTROIDS}
