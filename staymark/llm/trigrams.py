"""Boolean trigram queries that every match of a regular expression satisfies."""

from __future__ import annotations

from re import _constants as kinds
from re import _parser

# More alternatives than this for one stretch of a pattern say too little.
_MOST = 24

Clause = tuple[str, ...]


def required(pattern: str) -> list[Clause]:
    """Clauses of strings; a text with a match holds one string of each clause.

    Strings are in lower case, as the index holds lower-cased text. Strings of less than
    three characters ask for no trigram, so their clauses are left out; an empty list
    means that the pattern must be searched for in all texts.
    """
    clauses: list[Clause] = []
    _flush(_walk(_parser.parse(pattern), {""}, clauses), clauses)
    return clauses


def trigrams(string: str) -> list[str]:
    return sorted({string[i : i + 3] for i in range(len(string) - 2)})


def _flush(strings: set[str], clauses: list[Clause]) -> None:
    clause = tuple(sorted(strings))
    if min(map(len, strings)) >= 3 and clause not in clauses:
        clauses.append(clause)


def _walk(tree, so_far: set[str], clauses: list[Clause]) -> set[str]:
    """Strings that the run of fixed text up to here can be; a clause for each run ended."""
    for kind, value in tree:
        if kind is kinds.AT:
            continue
        choices = _choices(kind, value)
        if choices is None:
            if kind is kinds.MAX_REPEAT and value[0] > 0:  # at least once, then anything
                so_far = _walk(value[2], so_far, clauses)
            elif kind is kinds.SUBPATTERN:
                so_far = _walk(value[3], so_far, clauses)
                continue
            _flush(so_far, clauses)
            so_far = {""}
            continue
        longer = {a + b for a in so_far for b in choices}
        if len(longer) > _MOST:
            _flush(so_far, clauses)
            longer = choices if len(choices) <= _MOST else {""}
        so_far = longer
    return so_far


def _choices(kind, value) -> set[str] | None:
    """All strings that a part of a pattern can be, None if they are not few."""
    if kind is kinds.LITERAL:
        return {chr(value).lower()}
    if kind is kinds.IN and all(k is kinds.LITERAL for k, _ in value) and len(value) <= _MOST:
        return {chr(v).lower() for _, v in value}
    if kind is kinds.SUBPATTERN:
        return _fixed(value[3])
    if kind is kinds.BRANCH:
        parts = [_fixed(part) for part in value[1]]
        return None if None in parts else set().union(*parts)
    if kind is kinds.MAX_REPEAT and value[1] is not kinds.MAXREPEAT and value[1] <= 8:
        once = _fixed(value[2])
        if once is None:
            return None
        made, power = set(), {""}
        for times in range(value[1] + 1):
            if times >= value[0]:
                made |= power
            power = {a + b for a in power for b in once}
            if len(power) > _MOST:
                return None
        return made
    return None


def _fixed(tree) -> set[str] | None:
    strings = {""}
    for kind, value in tree:
        choices = _choices(kind, value)
        if choices is None or len(strings) * len(choices) > _MOST:
            return None
        strings = {a + b for a in strings for b in choices}
    return strings
