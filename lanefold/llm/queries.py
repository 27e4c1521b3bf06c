"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from lanefold.llm.audio import op6_audio
from lanefold.llm.chat import OP3_SQL, op3_chat_format
from lanefold.llm.collocations import OP13_SQL, op13_collocations
from lanefold.llm.decontaminate import op9_decontaminate
from lanefold.llm.language import op10_language
from lanefold.llm.language_model import op12_language_model
from lanefold.llm.mixing import op5_mix
from lanefold.llm.periodicity import op11_periodic_runs
from lanefold.llm.simhash import op7_simhash
from lanefold.llm.sstable import op1_token_shards
from lanefold.llm.suffix_dedup import op2_suffix_dedup
from lanefold.llm.token_fst import op4_token_counts
from lanefold.llm.toxicity import op8_toxicity

QUERIES = {
    f.__name__: f
    for f in (op1_token_shards, op2_suffix_dedup, op3_chat_format, op4_token_counts, op5_mix, op6_audio, op7_simhash, op8_toxicity, op9_decontaminate, op10_language, op11_periodic_runs, op12_language_model, op13_collocations)
}
ORACLE_SQL = {"op3_chat_format": OP3_SQL, "op13_collocations": OP13_SQL}
