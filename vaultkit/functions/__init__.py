"""Column expressions: hashing, text cleansing, predicates, dates, audit names."""

from vaultkit.functions.hashing import hash_of, with_hashes
from vaultkit.functions.text import (
    clean_name, market_name, drop_last_chars, last_token, without_last_token,
    collapse_blanks, collapse_whitespace, strip_leading_dots, upper_trim,
)
from vaultkit.functions.predicates import (
    present, blank, all_present, not_placeholder, like_none, like_escaped, is_empty_or_null,
)
from vaultkit.functions.dates import try_date, latest_of, minutes_before, seconds_between, floor_ts
from vaultkit.functions.audit_names import standard_layer, standard_model

__all__ = [
    "hash_of", "with_hashes", "clean_name", "market_name", "drop_last_chars", "last_token",
    "without_last_token", "collapse_blanks", "collapse_whitespace", "strip_leading_dots",
    "upper_trim", "present", "blank", "all_present", "not_placeholder", "like_none",
    "like_escaped", "is_empty_or_null", "try_date", "latest_of", "minutes_before",
    "seconds_between", "floor_ts", "standard_layer", "standard_model",
]
