"""The queries of the training-data operators, by name, and the SQL of those that SQL can express."""

from lattica.llm.chat import OP3_SQL, op3_chat_rotation
from lattica.llm.decontaminate import op2_decontamination
from lattica.llm.langid import op4_language_id
from lattica.llm.linededup import op5_line_dedup
from lattica.llm.packing import op7_packing
from lattica.llm.sharding import op8_sharding
from lattica.llm.simhash import op1_simhash
from lattica.llm.spotsigs import op6_spotsigs
from lattica.llm.substrings import OP10_SQL, op10_substring_dedup
from lattica.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_decontamination": op2_decontamination,
    "op3_chat_rotation": op3_chat_rotation,
    "op4_language_id": op4_language_id,
    "op5_line_dedup": op5_line_dedup,
    "op6_spotsigs": op6_spotsigs,
    "op7_packing": op7_packing,
    "op8_sharding": op8_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
}
ORACLE_SQL: dict[str, str] = {
    "op3_chat_rotation": OP3_SQL,
    "op10_substring_dedup": OP10_SQL,
}
