"""Stock-keeping-unit expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What survives normalisation, and which runs fold into one dash.
_DROPPED = r"[^\p{L}\p{N} _/\-]"
_SEPARATORS = r"[ _/\-]+"


def normalize_sku(raw: Column) -> Column:
    """Upper case, separators folded to single dashes, everything else dropped. NULL gives ''."""
    kept = F.regexp_replace(F.upper(F.coalesce(raw, F.lit(""))), _DROPPED, "")
    return F.btrim(F.regexp_replace(kept, _SEPARATORS, "-"), F.lit("-"))


def sku_candidates(raw: Column) -> Column:
    """Keys a raw code may match: the whole code, then its '/' parts, no repeats, no empties."""
    whole = F.array(normalize_sku(raw))
    parts = F.transform(F.split(F.coalesce(raw, F.lit("")), "/"), normalize_sku)
    return F.array_remove(F.array_distinct(F.concat(whole, parts)), "")


def stable_id(key: Column) -> Column:
    """A 31-bit id that is the same in every run: CRC-32 of the UTF-8 bytes."""
    return F.crc32(F.encode(key, "UTF-8")).bitwiseAND(F.lit(0x7FFFFFFF))
