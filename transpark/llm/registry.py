"""Queries and SQL of the corpus operators; the pipeline is a script of its own."""

from __future__ import annotations

from . import decontaminate, htmltext, langid, lmscore, mixing, neardup, pii, quality, secretscan, spelling, tokenalign, urlfilter, warc


def queries() -> dict:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_mixing": mixing.op2_mixing,
        "op3_lmscore": lmscore.op3_lmscore,
        "op4_langid": langid.op4_langid,
        "op5_warc": warc.op5_warc,
        "op6_neardup": neardup.op6_neardup,
        "op7_urlfilter": urlfilter.op7_urlfilter,
        "op8_pii": pii.op8_pii,
        "op9_quality": quality.op9_quality,
        "op10_htmltext": htmltext.op10_htmltext,
        "op11_tokenalign": tokenalign.op11_tokenalign,
        "op12_spelling": spelling.op12_spelling,
        "op13_secrets": secretscan.op13_secrets,
    }


def oracle_sql() -> dict:
    return {
        "op1_decontaminate": decontaminate.SQL,
        "op2_mixing": mixing.SQL,
        "op3_lmscore": lmscore.SQL,
        "op5_warc": warc.SQL,
        "op6_neardup": neardup.SQL,
        "op7_urlfilter": urlfilter.SQL,
        "op8_pii": pii.SQL,
        "op9_quality": quality.SQL,
        "op10_htmltext": htmltext.SQL,
        "op12_spelling": spelling.SQL,
    }
