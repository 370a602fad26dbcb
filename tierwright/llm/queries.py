"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import OP8_SQL, op8_chat_windows
from .exact_dedup import OP13_SQL, op13_stream_dedup
from .language import op2_cross_parse
from .mixing import OP10_SQL, op10_source_mix
from .ngram_join import OP7_SQL, op7_ngram_join
from .packing import op6_pack
from .periodic_runs import op12_period_tiles
from .quality import op3_compression_bands
from .secret_scan import op4_ownership
from .sharding import op5_byte_shards
from .spherical import OP1_SQL, op1_spherical_caps
from .toxicity import op9_lexicon
from .turn_repair import OP11_SQL, op11_turn_repair

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spherical_caps": op1_spherical_caps,
    "op2_cross_parse": op2_cross_parse,
    "op3_compression_bands": op3_compression_bands,
    "op4_ownership": op4_ownership,
    "op5_byte_shards": op5_byte_shards,
    "op6_pack": op6_pack,
    "op7_ngram_join": op7_ngram_join,
    "op8_chat_windows": op8_chat_windows,
    "op9_lexicon": op9_lexicon,
    "op10_source_mix": op10_source_mix,
    "op11_turn_repair": op11_turn_repair,
    "op12_period_tiles": op12_period_tiles,
    "op13_stream_dedup": op13_stream_dedup,
}

SQL: dict[str, str] = {
    "op1_spherical_caps": OP1_SQL,
    "op7_ngram_join": OP7_SQL,
    "op8_chat_windows": OP8_SQL,
    "op10_source_mix": OP10_SQL,
    "op11_turn_repair": OP11_SQL,
    "op13_stream_dedup": OP13_SQL,
}
