"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .queries import conversations as q13
from .queries import decontaminate as q8
from .queries import host_rules as q4
from .queries import htmltext as q9
from .queries import licenses as q10
from .queries import linededup as q3
from .queries import mixing as q2
from .queries import packing as q11
from .queries import quality as q1
from .queries import simhash as q7
from .queries import toxicity as q6
from .queries import vectorcodes as q12
from .queries import warc as q5

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_quality": q1.query,
    "op2_mixing": q2.query,
    "op3_line_dedup": q3.query,
    "op4_host_rules": q4.query,
    "op5_warc": q5.query,
    "op6_toxicity": q6.query,
    "op7_simhash": q7.query,
    "op8_decontaminate": q8.query,
    "op9_html_text": q9.query,
    "op10_licenses": q10.query,
    "op11_packing": q11.query,
    "op12_vector_codes": q12.query,
    "op13_prefix_trie": q13.query,
}

ORACLES: dict[str, str] = {
    "op4_host_rules": q4.SQL,
    "op5_warc": q5.SQL,
    "op10_licenses": q10.SQL,
    "op12_vector_codes": q12.SQL,
    "op13_prefix_trie": q13.SQL,
}
