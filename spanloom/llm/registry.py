"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import bpe, chat, decontaminate, edits, html, langid, lines, minhash, quality, secrets

QUERIES = {
    "op1_langid": langid.op1_langid,
    "op2_edits": edits.op2_edits,
    "op3_bpe": bpe.op3_bpe,
    "op4_secrets": secrets.op4_secrets,
    "op5_minhash": minhash.op5_minhash,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_chat": chat.op7_chat,
    "op8_lines": lines.op8_lines,
    "op9_html": html.op9_html,
    "op10_quality": quality.op10_quality,
}

ORACLES = {"op7_chat": chat.ORACLE, "op8_lines": lines.ORACLE}
