"""Standard audit names for layers and models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw layer name (lower case) -> audit layer name. Unlisted names are upper-cased.
LAYER_NAMES = {
    "stg": "STAGE",
    "dq": "DQ",
    "delta": "DELTA",
    "dm": "DM",
    "hub": "HUB",
    "sat": "SAT",
    "hist": "HIST",
}

# Model-name suffix rules, applied in this order.
MODEL_SUFFIX_DROPS = ("_VEEVA_CRM", "_VEEVA")
MODEL_SUFFIX_RENAME = ("_PRODUCT_FILE", "_PRODUCT")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standard_layer(c: str | Column) -> Column:
    raw = F.lower(F.trim(F.coalesce(_c(c), F.lit("UNKNOWN"))))
    out = F.upper(raw)
    for key, value in reversed(list(LAYER_NAMES.items())):
        out = F.when(raw == key, F.lit(value)).otherwise(out)
    return out


def _drop_suffix(n: Column, suffix: str) -> Column:
    return F.when(n.endswith(suffix), n.substr(F.lit(1), F.length(n) - F.lit(len(suffix)))).otherwise(n)


def standard_model(c: str | Column) -> Column:
    n = F.upper(F.trim(F.coalesce(_c(c), F.lit("UNKNOWN"))))
    for suffix in MODEL_SUFFIX_DROPS:
        n = _drop_suffix(n, suffix)
    old, new = MODEL_SUFFIX_RENAME
    return F.when(n.endswith(old), F.concat(n.substr(F.lit(1), F.length(n) - F.lit(len(old))), F.lit(new))).otherwise(n)


def layer_name(name: str | None) -> str:
    """``standard_layer`` of a name known on the driver."""
    raw = (name if name is not None else "UNKNOWN").strip().lower()
    return LAYER_NAMES.get(raw, raw.upper())


def model_name(name: str | None) -> str:
    """``standard_model`` of a name known on the driver."""
    n = (name if name is not None else "UNKNOWN").strip().upper()
    for suffix in MODEL_SUFFIX_DROPS:
        n = n.removesuffix(suffix)
    old, new = MODEL_SUFFIX_RENAME
    return n.removesuffix(old) + new if n.endswith(old) else n
