"""Queries of this subpackage for the driver: name -> f(spark, sf_dir), and
the SQL of those that SQL can express."""

from __future__ import annotations

from wordform.llm.ann import op5_nearest
from wordform.llm.bpe import op6_encode
from wordform.llm.decontam import OP1_SQL, op1_decontaminate
from wordform.llm.filter_audit import OP11_SQL, op11_filter_audit
from wordform.llm.langid import op10_language
from wordform.llm.licenses import op7_licenses
from wordform.llm.mixing import OP13_SQL, op13_mixing
from wordform.llm.ngram_join import LINKS_SQL, OP3_SQL, ngram_links, op3_near_duplicates
from wordform.llm.pii import op9_pii
from wordform.llm.quality import op4_quality
from wordform.llm.resampling import OP12_SQL, op12_resampling
from wordform.llm.toxicity import op8_toxicity
from wordform.llm.warc import OP2_SQL, op2_archives

QUERIES = {
    "op1_decontamination": op1_decontaminate,
    "op2_warc": op2_archives,
    "op3_ngram_join": op3_near_duplicates,
    "op4_quality": op4_quality,
    "op5_nearest": op5_nearest,
    "op6_bpe": op6_encode,
    "op7_licenses": op7_licenses,
    "op8_toxicity": op8_toxicity,
    "op9_pii": op9_pii,
    "op10_language": op10_language,
    "op11_filter_audit": op11_filter_audit,
    "op12_resampling": op12_resampling,
    "op13_mixing": op13_mixing,
    "ngram_links": ngram_links,
}

ORACLE = {
    "op1_decontamination": OP1_SQL,
    "op2_warc": OP2_SQL,
    "op3_ngram_join": OP3_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_resampling": OP12_SQL,
    "op13_mixing": OP13_SQL,
    "ngram_links": LINKS_SQL,
}
