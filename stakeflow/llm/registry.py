"""The queries of the training-data operators, by name, and SQL for those that SQL can express."""

from stakeflow.llm import byte_bpe, chat_format, chat_repair, decontaminate, embedding_dedup, html_extract, language_id, near_dedup, phrases, quality_crf, quality_rules, substring_dedup, token_counts

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_html_extract": html_extract.op2_html_extract,
    "op3_quality_crf": quality_crf.op3_quality_crf,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_chat_format": chat_format.op7_chat_format,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_language_id": language_id.op9_language_id,
    "op10_embedding_dedup": embedding_dedup.op10_embedding_dedup,
    "op11_quality_rules": quality_rules.op11_quality_rules,
    "op12_chat_repair": chat_repair.op12_chat_repair,
    "op13_phrases": phrases.op13_phrases,
}
ORACLES: dict = {
    "op4_near_dedup": near_dedup.OP4_SQL,
    "op5_substring_dedup": substring_dedup.OP5_SQL,
    "op7_chat_format": chat_format.OP7_SQL,
    "op10_embedding_dedup": embedding_dedup.OP10_SQL,
    "op12_chat_repair": chat_repair.OP12_SQL,
    "op13_phrases": phrases.OP13_SQL,
}
