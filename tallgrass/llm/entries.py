"""The subpackage's queries and the SQL that some of them equal."""

from __future__ import annotations

from .bpe import op5_bpe
from .chat import op10_chat_formatting
from .decontam import OP3_SQL, op3_decontamination
from .divergence import OP11_SQL, op11_divergence
from .jaccard import op6_jaccard_join
from .katz import op7_lm_scoring
from .langid import op4_language_id
from .lexical import OP13_SQL, op13_lexical_search
from .quality import op2_quality
from .sharding import op1_sharding
from .substrings import op8_substring_dedup
from .topk import OP9_SQL, op9_topk
from .warc import OP12_SQL, op12_warc


def queries() -> dict:
    """Query name -> callable(spark, sf_dir)."""
    of = (op1_sharding, op2_quality, op3_decontamination, op4_language_id, op5_bpe, op6_jaccard_join, op7_lm_scoring, op8_substring_dedup, op9_topk, op10_chat_formatting)
    return {f.__name__: f for f in (*of, op11_divergence, op12_warc, op13_lexical_search)}


def oracle_sql() -> dict[str, str]:
    """Query name -> DuckDB SQL."""
    return {"op3_decontamination": OP3_SQL, "op9_topk": OP9_SQL, "op11_divergence": OP11_SQL, "op12_warc": OP12_SQL, "op13_lexical_search": OP13_SQL}
