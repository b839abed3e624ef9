"""Address validity as a column predicate (the INET type's input rule)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(\.{_OCTET}){{3}}"
_H = r"[0-9A-Fa-f]{1,4}"


def _ipv6() -> str:
    """All forms of 8 groups: whole, or with one '::' for the missing ones;
    an IPv4 address may stand for the last two groups."""
    forms = [rf"({_H}:){{7}}{_H}", rf"({_H}:){{6}}{_IPV4}"]
    for before in range(8):  # groups in front of '::'
        head = rf"({_H}:){{{before - 1}}}{_H}" if before else ""
        after = 7 - before
        forms.append(rf"{head}::({_H}(:{_H}){{0,{after - 1}}})?" if after else f"{head}::")
        if after >= 2:
            forms.append(rf"{head}::({_H}:){{0,{after - 2}}}{_IPV4}")
    return "(" + "|".join(forms) + ")"


# Whole-string anchors: a line end after the address is no part of it.
_IPV4_MASK = rf"\A{_IPV4}(/(3[0-2]|[12]?[0-9]))?\z"
_IPV6_MASK = rf"\A{_ipv6()}(/(12[0-8]|1[01][0-9]|[1-9]?[0-9]))?\z"


def is_inet(col: Column | str) -> Column:
    """True for a valid IPv4 / IPv6 address (optionally with a prefix
    length), False for anything else, NULL for NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(_IPV4_MASK) | c.rlike(_IPV6_MASK)
