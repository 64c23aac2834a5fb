"""Registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from . import (chat, decontaminate, filter_audit, licenses, lines, merkle, mixing, quality, secrets, simhash, token_counts, token_files,
               warc)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_simhash": simhash.op2_simhash,
    "op3_chat": chat.op3_chat,
    "op4_lines": lines.op4_lines,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_token_files": token_files.op6_token_files,
    "op7_quality": quality.op7_quality,
    "op8_licenses": licenses.op8_licenses,
    "op9_warc": warc.op9_warc,
    "op10_secrets": secrets.op10_secrets,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_token_counts": token_counts.op12_token_counts,
    "op13_merkle": merkle.op13_merkle,
}

#: The others have no SQL form (a hash-drawn mix, SimHash, a tokenizer, a trained model): tests compare with brute force.
ORACLE = {
    "op3_chat": chat.ORACLE,
    "op4_lines": lines.ORACLE,
    "op5_decontaminate": decontaminate.ORACLE,
    "op7_quality": quality.ORACLE,
    "op8_licenses": licenses.ORACLE,
    "op9_warc": warc.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op13_merkle": merkle.ORACLE,
}
