"""Whole-word, case-insensitive literal matching as Java/RE2-compatible regexes."""

from __future__ import annotations

import re

# A word edge is the start/end of the text or any character outside ASCII letters
# and digits. Unlike ``\b`` this treats '_' and accented letters as edges, and it
# means the same thing in Java and RE2.
LEFT_EDGE = "(?:^|[^A-Za-z0-9])"
RIGHT_EDGE = "(?:[^A-Za-z0-9]|$)"


def word_regex(literals: list[str] | tuple[str, ...]) -> str:
    """One regex matching any of ``literals`` as a whole word, ignoring case."""
    alts = "|".join(re.escape(s).replace("\\ ", " ") for s in sorted(set(literals)))
    return f"(?i){LEFT_EDGE}(?:{alts}){RIGHT_EDGE}"
