"""The queries of this subpackage, and the SQL that gives the same rows."""

from __future__ import annotations

from vacantia.llm import bpe, chat_format, collocations, conversation_trie, decontamination, line_dedup, ngram_join, quality_model, quality_rules, secret_scan, source_mix, token_files, warc

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_warc": warc.op2_warc,
    "op3_quality_model": quality_model.op3_quality_model,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_token_files": token_files.op5_token_files,
    "op6_bpe": bpe.op6_bpe,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_ngram_join": ngram_join.op8_ngram_join,
    "op9_chat_format": chat_format.op9_chat_format,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_conversation_trie": conversation_trie.op11_conversation_trie,
    "op12_collocations": collocations.op12_collocations,
    "op13_source_mix": source_mix.op13_source_mix,
}
ORACLES = {
    "op1_secret_scan": secret_scan.ORACLE_SQL,
    "op2_warc": warc.ORACLE_SQL,
    "op4_line_dedup": line_dedup.ORACLE_SQL,
    "op7_decontamination": decontamination.ORACLE_SQL,
    "op8_ngram_join": ngram_join.ORACLE_SQL,
    "op9_chat_format": chat_format.ORACLE_SQL,
    "op10_quality_rules": quality_rules.ORACLE_SQL,
    "op11_conversation_trie": conversation_trie.ORACLE_SQL,
    "op12_collocations": collocations.ORACLE_SQL,
}
