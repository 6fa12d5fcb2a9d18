"""The queries of this folder, one for each operator, and their SQL twins."""

from __future__ import annotations

from modlake.llm.alignment import op13_token_alignment
from modlake.llm.bpe import op7_bpe_round_trip
from modlake.llm.chat import SQL as CHAT_SQL
from modlake.llm.chat import op4_chat_format
from modlake.llm.decontaminate import op10_decontamination
from modlake.llm.language import op5_language_id
from modlake.llm.near_duplicates import op1_near_duplicates
from modlake.llm.packing import op12_packing
from modlake.llm.pii import op9_personal_data
from modlake.llm.repair import op11_conversation_repair
from modlake.llm.repeats import op2_repeated_passages
from modlake.llm.secrets import op3_secret_scan
from modlake.llm.sketch import op8_fingerprints
from modlake.llm.token_files import op6_token_files

QUERIES = {
    fn.__name__: fn
    for fn in (
        op1_near_duplicates, op2_repeated_passages, op3_secret_scan, op4_chat_format, op5_language_id, op6_token_files,
        op7_bpe_round_trip, op8_fingerprints, op9_personal_data, op10_decontamination,
        op11_conversation_repair, op12_packing, op13_token_alignment,
    )
}
SQL = {"op4_chat_format": CHAT_SQL.strip()}
