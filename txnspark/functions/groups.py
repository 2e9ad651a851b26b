"""Column groups of the wide raw table, by name."""

from __future__ import annotations

import re
from collections.abc import Iterable

# Group name and the pattern of its columns; the first match decides.
GROUP_PATTERNS = (
    ("core", r"^(TransactionID|isFraud|TransactionDT|TransactionAmt|ProductCD)$"),
    ("card", r"^card"),
    ("addr", r"^addr"),
    ("email", r"(?i)emaildomain"),
    ("C", r"^C\d+$"),
    ("D", r"^D\d+$"),
    ("M", r"^M\d+$"),
    ("V", r"^V\d+$"),
    ("id", r"^id_"),
    ("device", r"^Device"),
    ("other", r""),
)


def group_of(name: str) -> str:
    """Group of one column."""
    return next(group for group, pattern in GROUP_PATTERNS if re.search(pattern, name))


def column_groups(names: Iterable[str]) -> dict[str, list[str]]:
    """Columns per group in the fixed group order; empty groups are left out."""
    found: dict[str, list[str]] = {group: [] for group, _ in GROUP_PATTERNS}
    for name in names:
        found[group_of(name)].append(name)
    return {group: members for group, members in found.items() if members}
