"""One query per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripgauge.llm.embedding_dedup import op10_embedding_dedup
from tripgauge.llm.fim import op11_fim
from tripgauge.llm.html_text import op4_html_text
from tripgauge.llm.langid import op9_langid
from tripgauge.llm.line_dedup import op12_line_dedup
from tripgauge.llm.mixing import op1_mixing
from tripgauge.llm.pieces import op3_pieces
from tripgauge.llm.quality import op7_quality
from tripgauge.llm.resampling import op13_resampling
from tripgauge.llm.simhash import op2_simhash
from tripgauge.llm.token_files import op6_token_files
from tripgauge.llm.topk import op8_exact_topk
from tripgauge.llm.warc import op5_warc


def build() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_simhash": op2_simhash,
        "op3_pieces": op3_pieces,
        "op4_html_text": op4_html_text,
        "op5_warc": op5_warc,
        "op6_token_files": op6_token_files,
        "op7_quality": op7_quality,
        "op8_exact_topk": op8_exact_topk,
        "op9_langid": op9_langid,
        "op10_embedding_dedup": op10_embedding_dedup,
        "op11_fim": op11_fim,
        "op12_line_dedup": op12_line_dedup,
        "op13_resampling": op13_resampling,
    }
