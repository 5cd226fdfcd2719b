"""Secret patterns and the Boolean trigram queries that follow from them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

# Larger sets of possible literals are not followed further.
MAX_LITERALS = 32


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``keep`` names the group (0: whole match) whose length is at least
    ``least``; shorter matches are dropped after matching."""

    kind: str
    pattern: str
    least: int = 0
    keep: int = 0
    flags: int = re.ASCII


RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
        re.ASCII | re.IGNORECASE,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    # Runs of at least 24: the shorter maximal runs, which would be dropped, never match.
    Rule("hex", r"[0-9a-f]{24,}", 24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
BASE = ("assign", "access", "hex")

# A query is True (everything), or ("and" | "or", parts) over trigrams (strings).
Query = bool | str | tuple


def _and(parts) -> Query:
    kept = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not kept else kept[0] if len(kept) == 1 else ("and", *kept)


def _or(parts) -> Query:
    kept = list(dict.fromkeys(parts))
    return True if True in kept else kept[0] if len(kept) == 1 else ("or", *kept)


def _grams(text: str) -> Query:
    return _and(text[i : i + 3] for i in range(len(text) - 2))


def _literals(nodes) -> list[set[str] | None]:
    """For each node of a sequence the lower-cased texts it can match, or None if too many."""
    out: list[set[str] | None] = []
    for kind, value in nodes:
        if kind is op.LITERAL:
            out.append({chr(value).lower()})
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            out.append({chr(v).lower() for _, v in value})
        elif kind is op.SUBPATTERN:
            out.append(_joined(_literals(value[3])))
        elif kind is op.BRANCH:
            sets = [_joined(_literals(branch)) for branch in value[1]]
            out.append(None if None in sets else set().union(*sets))
        elif kind is op.MAX_REPEAT and value[1] <= 4 and (one := _joined(_literals(value[2]))):
            sizes = range(value[0], value[1] + 1)
            out.append({"".join(t) for n in sizes for t in product(sorted(one), repeat=n)})
        else:
            out.append(None)
        if out[-1] is not None and len(out[-1]) > MAX_LITERALS:
            out[-1] = None
    return out


def _joined(sets) -> set[str] | None:
    texts = {""}
    for one in sets:
        if one is None or len(texts) * len(one) > MAX_LITERALS:
            return None
        texts = {a + b for a in texts for b in one}
    return texts


def _query(nodes) -> Query:
    """What any match of the sequence must contain."""
    parts: list[Query] = []
    run = {""}
    for (kind, value), texts in zip(nodes, _literals(nodes), strict=True):
        if texts is not None and len(run) * len(texts) <= MAX_LITERALS:
            run = {a + b for a in run for b in texts}
            continue
        parts.append(_or(_grams(t) for t in sorted(run)))
        run = texts if texts is not None else {""}
        if texts is None and kind is op.SUBPATTERN:
            parts.append(_query(list(value[3])))
        elif texts is None and kind is op.BRANCH:
            parts.append(_or(_query(list(branch)) for branch in value[1]))
        elif texts is None and kind is op.MAX_REPEAT and value[0] > 0:
            parts.append(_query(list(value[2])))
    parts.append(_or(_grams(t) for t in sorted(run)))
    return _and(parts)


def trigram_query(rule: Rule) -> Query:
    """Trigrams (lower case) that a text has to hold for the rule to match; True if there are none."""
    return _query(list(parser.parse(rule.pattern, rule.flags)))


def trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1:]))
