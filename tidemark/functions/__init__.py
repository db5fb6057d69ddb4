"""Column-expression helpers (text cleaning, safe casts, exact sums, keys)."""

from tidemark.functions.exprs import (  # noqa: F401
    OPEN_END,
    as_date,
    days_between,
    exact_avg,
    exact_sum,
    hash_key,
    null_safe_differs,
    safe_cast,
)
from tidemark.functions.text import (  # noqa: F401
    clean_injury_text,
    clean_string_whitespace,
    clean_whitespace,
    decode_entities,
    html_text,
    strip_html_tags,
)
