"""The registered queries of the corpus operators, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import sql
from ledgerlens.llm.archives import op10_archives
from ledgerlens.llm.byte_pairs import op12_byte_pairs
from ledgerlens.llm.extraction import op4_extraction
from ledgerlens.llm.fingerprints import op9_fingerprints
from ledgerlens.llm.language import op2_language
from ledgerlens.llm.licences import op6_licences
from ledgerlens.llm.mixing import op5_mixing
from ledgerlens.llm.near_duplicates import op8_near_duplicates
from ledgerlens.llm.negatives import op11_negatives
from ledgerlens.llm.packing import op3_packing
from ledgerlens.llm.resampling import op13_resampling
from ledgerlens.llm.secrets import op7_secrets
from ledgerlens.llm.vectors import op1_vectors

QUERIES = [op1_vectors, op2_language, op3_packing, op4_extraction, op5_mixing, op6_licences, op7_secrets, op8_near_duplicates, op9_fingerprints, op10_archives,
           op11_negatives, op12_byte_pairs, op13_resampling]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {q.__name__: sql.ORACLES[q.__name__] for q in QUERIES if q.__name__ in sql.ORACLES}
