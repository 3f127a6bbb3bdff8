"""Text clean-up as Column expressions (JVM-side, inside whole-stage codegen).

Java regex and Python ``re`` disagree on ``\\s``/``\\S``/``strip``; the ``WS``
class below matches exactly what Python treats as white space, and also runs
unchanged in DuckDB's RE2, so the oracle SQL can share the patterns.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Fixed patterns (must stay equal to the rules they reproduce).
WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NOT_WS = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
STRIP_RE = rf"^{WS}+|{WS}+\z"
# comment-level clean-up: bracketed or bare links
BODY_LINK_RE = r"\(?http[^ ]+\)?"
# sentence-level clean-up, applied in this order
URL_RE = rf"https?:\/\/{NOT_WS}*"
YT_PARAM_RE = rf"v={NOT_WS}*t={NOT_WS}*"
SUB_USER_RE = r"\/(r|u)\/"
PATHLIKE_RE = rf"{NOT_WS}*\/{NOT_WS}*\.{NOT_WS}*"

# Entities handled by the built-in (JVM) unescape path, ``&amp;`` last so that
# ``&amp;lt;`` becomes ``&lt;`` exactly as a single left-to-right pass would.
BUILTIN_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&#x27;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: Unicode white space off both ends."""
    return F.regexp_replace(_col(c), STRIP_RE, "")


def unescape_builtin(c) -> Column:
    out = _col(c)
    for ent, ch in BUILTIN_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


@pandas_udf(StringType())
def _html_unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda v: html.unescape(v) if isinstance(v, str) else v)


def unescape_html(c, full: bool = True) -> Column:
    """HTML unescape. ``full`` uses the complete HTML5 entity table through an
    Arrow-batched pandas UDF, but only on values that contain ``&``; otherwise
    the built-in replace chain runs."""
    c = _col(c)
    amp = c.contains("&")
    if not full:
        return F.when(amp, unescape_builtin(c)).otherwise(c)
    # Spark evaluates a Python UDF for every row of its projection; feeding it
    # null unless the value holds "&" keeps the Arrow batches nearly empty.
    return F.when(amp, _html_unescape(F.when(amp, c))).otherwise(c)


def sanitize_body(c) -> Column:
    """Comment-level clean-up used before the length and language filters."""
    c = F.replace(_col(c), F.lit("\r"), F.lit(""))
    c = F.replace(c, F.lit("\n"), F.lit(" "))
    return F.regexp_replace(c, BODY_LINK_RE, "")


def sanitize_text(c, full_unescape: bool = True) -> Column:
    """Sentence-level clean-up of a context sentence.

    The two patterns that can backtrack quadratically on long words are only
    evaluated on values that contain their literal anchor.
    """
    c = unescape_html(c, full=full_unescape)
    c = F.replace(c, F.lit("\r"), F.lit(""))
    c = F.replace(c, F.lit("\n"), F.lit(" "))
    c = F.regexp_replace(c, URL_RE, "")
    c = F.when(c.contains("v="), F.regexp_replace(c, YT_PARAM_RE, "")).otherwise(c)
    c = F.regexp_replace(c, SUB_USER_RE, "")
    c = F.when(c.contains("/"), F.regexp_replace(c, PATHLIKE_RE, "")).otherwise(c)
    return c


def parse_context_list(c) -> Column:
    """Importer for tables whose context lists were stored as printed Python
    lists (``"['a', 'b']"``): strip the outer brackets and quotes and split
    on the item separator (also across concatenated lists ``'][``)."""
    c = _col(c)
    inner = c.substr(F.lit(3), F.greatest(F.length(c) - 4, F.lit(0)))
    return F.split(inner, r"', '|'\]\['")
