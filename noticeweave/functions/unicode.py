"""Folding of any script: compatibility decomposition, which Spark has no function for."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeweave.functions.text import FOLDED_LETTERS, fold, text

#: What the letter table of fold() covers: ASCII and its letters in both cases.
_SIMPLE = "^[\\t-\\r\\x20-\\x7e" + "".join(sorted({c for letter in FOLDED_LETTERS for c in (letter, letter.upper()) if len(c) == 1})) + "]*\\z"


def folded(value: str) -> str:
    """Trimmed, lower-cased, decomposed for compatibility, without marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", value.strip().lower()) if not unicodedata.combining(c))


def _decomposed(values: pa.Array) -> pa.Array:
    return pa.array((None if v is None else folded(v) for v in values.to_pylist()), pa.string())


def fold_all(c: Column | str) -> Column:
    """folded() of a column; null is empty. Texts that the letter table covers stay in the JVM, only others are sent to Python, whose null
    tells them apart."""
    own = F.btrim(text(c), F.lit("\t\n\x0b\x0c\r "))
    return F.coalesce(F.arrow_udf(_decomposed, "string")(F.when(~own.rlike(_SIMPLE), own)), fold(own))
