"""Queries of the text operators."""
from siteforge.llm import contamination, katz, langid, pieces, pii, quality, repeats, sharding, simhash, urls
from siteforge.llm.oracles import ORACLES


def queries():
    return {
        "op1_sharding": sharding.op1_sharding,
        "op2_pii": pii.op2_pii,
        "op3_line_quality": quality.op3_line_quality,
        "op4_sentencepiece": pieces.op4_sentencepiece,
        "op5_language_model": katz.op5_language_model,
        "op6_simhash": simhash.op6_simhash,
        "op7_decontamination": contamination.op7_decontamination,
        "op8_language_id": langid.op8_language_id,
        "op9_repeats": repeats.op9_repeats,
        "op10_url_filter": urls.op10_url_filter,
    }


def oracle_sql():
    return ORACLES
