"""Pattern catalogue for detector D1.

Pattern detection is part of the contract, but no pattern is specified, so
these are our own.  A match takes the whole run of its characters: a longer number or
hash is hidden as a whole, never cut to the length of a known kind.  Every pattern stays inside the common subset of Java regex, RE2 and
Python ``re``: ASCII classes only, no look-around, no back-references, no
``\\b`` / ``\\d`` / ``\\w`` (their meaning differs between the engines beside
accented letters), and none may match the empty string.

That portable form says what a pattern matches.  Java's engine needs its own form to find
the same matches in linear time and constant stack (``scan``):

* a match begins where a run of its first characters begins, or where the last match
  ended: the other places of a long run are refused by one look back instead of a new walk over the run;
* runs and repeated groups are possessive: the engine loops over them and keeps nothing to come
  back to (a repeated group is otherwise one stack frame per repetition).

A ``gate`` is a cheap condition that every text with a match meets; most texts have no
digit, and one test for it spares them three scans.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Pattern:
    entity: str
    regex: str
    # a literal every match contains: texts without it skip the regex pass
    # (a byte search is far cheaper than a regex scan; most texts have no finding)
    required: str | None = None
    # the form that Spark scans with; the same matches as ``regex``
    scan: str | None = None
    # a regex that stands in every text with a match; patterns with an equal gate share its test
    gate: str | None = None
    # ``luhn`` or ``octets``: matches that fail the check are no findings
    check: str | None = None

    @property
    def scanned(self) -> str:
        return self.scan or self.regex



def _from_run(chars: str) -> str:
    """A match starts where a run of ``chars`` starts, or where the last match ended."""
    return rf"(?:(?<![{chars}])|\G)"


_DIGIT = "[0-9]"
_LOCAL = "A-Za-z0-9._%+-"

# ---- fixed values: default pattern set (entity, regex, required literal), in priority order ----
EMAIL = Pattern("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "@",
                scan=_from_run(_LOCAL) + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}+")
PHONE = Pattern("phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,}){2,}"
                         r"|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4,}", gate=_DIGIT,
                scan=r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,}){2}(?:[ .-]?[0-9]{2,}+)*+"
                     r"|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4,}+")
IPV4 = Pattern("ipv4", r"[0-9]+(?:\.[0-9]+){3,}", ".", gate=_DIGIT, scan=_from_run("0-9") + r"[0-9]++(?:\.[0-9]++){3,}+")
IPV6 = Pattern("ipv6", r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}", ":")
CARD = Pattern("card", r"[0-9]{13,}|[0-9]{4}(?:[ -][0-9]{4}){3}[0-9]*|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5,}", gate=_DIGIT,
               scan=r"[0-9]{13,}+|[0-9]{4}(?:[ -][0-9]{4}){3}[0-9]*+|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5,}+")
HEX_TOKEN = Pattern("hex_token", r"[0-9A-Fa-f]{32,}", scan=r"[0-9A-Fa-f]{32,}+")
SECRET = Pattern("secret", r"(?:token|secret|password|api_key) ?= ?\"[0-9A-Za-z]{16,}\"", "=",
                 scan=r"(?:token|secret|password|api_key) ?= ?\"[0-9A-Za-z]{16,}+\"")
# ---- end of fixed values ----

PLAIN = (EMAIL, PHONE, IPV4, IPV6, CARD, HEX_TOKEN)
DEFAULT = PLAIN + (SECRET,)
#: Only what can be a card number or an address: for reports, not for redaction (a mistyped number is still private).
VERIFIED = (replace(CARD, check="luhn"), replace(IPV4, check="octets"))


def validate(patterns) -> tuple[Pattern, ...]:
    """Driver-side check of a pattern list (tiny, never data)."""
    out = []
    seen = set()
    for p in patterns:
        if not isinstance(p, Pattern):
            p = Pattern(*p)
        if p.entity in seen:
            raise ValueError(f"duplicate entity {p.entity!r}")
        seen.add(p.entity)
        compiled = re.compile(p.regex)
        if compiled.fullmatch("") is not None or compiled.search("") is not None:
            raise ValueError(f"pattern for {p.entity!r} matches the empty string")
        if "(?<" in p.regex.replace("(?<name>", "") or "(?=" in p.regex or "(?!" in p.regex:
            raise ValueError(f"pattern for {p.entity!r} uses look-around")
        if p.check not in (None, "luhn", "octets"):
            raise ValueError(f"pattern for {p.entity!r} has an unknown check")
        if p.required is not None and p.required == "":
            raise ValueError(f"pattern for {p.entity!r} has an empty required literal")
        out.append(p)
    return tuple(out)
