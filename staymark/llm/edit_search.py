"""Cheapest edits that give a conversation legal roles, by iterative-deepening A*.

A conversation is a string with one symbol for each row: ``s``, ``u`` or ``a`` for a row of
that role initial, ``o`` for one of any other, the same in upper case for a row whose text is
cut off, and ``x`` for a row that has to go. Edits are letters: Delete, Insert, Keep, Rerole.
Legal roles are ``(s?(ua)+)?``; a state is what came last: nothing, s, u or a.

The search goes depth first through the edits in ASCII order under a cost bound that grows by
one, so the first path that is accepted is the cheapest and, among those, the ASCII-least.
Its heuristic adds up what windows of rows cost at least, each by itself. A table remembers
how much cost each failed state had left, for all later bounds.
"""

from __future__ import annotations

from functools import lru_cache

# States, and which of them end a legal sequence.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTING = (START, ASSISTANT)
# What an inserted or reroled row becomes after each state, and the state it leads to.
NEXT_ROLE = ("u", "u", "a", "u")
AFTER_NEXT = (USER, USER, ASSISTANT, USER)
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
# Inserts that make each state an accepting one.
CLOSING = ("", "II", "I", "")
# Rows of one window of the heuristic.
WINDOW = 4
# Any state will do at the end.
ANYWHERE = -1

AFTER_KEEP = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}


def _steps(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after it) of the edits that use up one row, in ASCII order."""
    steps = [("D", DELETE, state)]
    if symbol != "x":
        extra = CUT_OFF if symbol.isupper() else 0
        kept = AFTER_KEEP.get((state, symbol.lower()))
        if kept is not None:
            steps.append(("K", extra, kept))
        steps.append(("R", REROLE + extra, AFTER_NEXT[state]))
    return steps


# A pure function of two small sets, 9 symbols by 4 states.
_STEPS = {(symbol, state): _steps(symbol, state) for symbol in "suaoSUAOx" for state in STATES}


@lru_cache(maxsize=1 << 14)
def _least(window: str) -> int:
    """What the rows of a short window cost at least, from any state to any state."""
    costs = dict.fromkeys(STATES, 0)
    for symbol in window:
        for state in STATES:  # an insert leads on; two in a row settle it for all states
            after = costs[state] + INSERT
            if after < costs[AFTER_NEXT[state]]:
                costs[AFTER_NEXT[state]] = after
        following: dict[int, int] = {}
        for state, cost in costs.items():
            for _, more, to in _STEPS[symbol, state]:
                following[to] = min(following.get(to, cost + more), cost + more)
        costs = {state: following.get(state, 1 << 30) for state in STATES}
    return min(costs.values())


def _bounds(symbols: str, target: int | None) -> list[int]:
    """For each row, what it and all after it cost at least; 0 behind the last.

    A state before the first user row is never come back to: a part that ends there deletes
    all its rows, but for one system row at most.
    """
    n = len(symbols)
    if target in (START, SYSTEM):
        return [DELETE * max(0, n - at - target) for at in range(n + 1)]
    least = [0] * (n + 1)
    for end in range(n, 0, -WINDOW):
        for at in range(end - 1, max(end - WINDOW, 0) - 1, -1):
            least[at] = _least(symbols[at:end]) + least[end]
    return least


def search(symbols: str, entry: int = START, target: int | None = None) -> tuple[int, str] | None:
    """(cost, edits) from state ``entry`` over all rows, None where there is no way.

    Without ``target`` the rows end a conversation: rows may be inserted behind the last, and
    the last state must be accepting. With it they are a part that ends in that state; what is
    inserted behind its last row belongs to the next part.
    """
    if target is not None and target not in _reachable(symbols, entry):
        return None
    least, n = _bounds(symbols, target), len(symbols)
    failed: dict[tuple[int, int], int] = {}
    bound = least[0]
    while True:
        found = _within(symbols, entry, target, bound, least, failed, n)
        if found is not None:
            return bound, found
        bound += 1


def _reachable(symbols: str, entry: int) -> set[int]:
    """States that a part can end in: inserts come only before a row."""
    states = {entry}
    for symbol in symbols:
        inserted = set(states)
        for _ in STATES:
            inserted |= {AFTER_NEXT[s] for s in inserted}
        states = {to for s in inserted for _, _, to in _STEPS[symbol, s]}
    return states


def _within(
    symbols: str,
    entry: int,
    target: int | None,
    bound: int,
    least: list[int],
    failed: dict[tuple[int, int], int],
    n: int,
) -> str | None:
    """The first accepted path that costs ``bound`` at most; ``failed`` learns from failures."""

    def children(at: int, state: int) -> list[tuple[str, int, int, int]]:
        """(edit, cost, row, state) in ASCII order."""
        found = [(e, c, at + 1, to) for e, c, to in _STEPS[symbols[at], state]] if at < n else []
        if at < n or target is None:
            found.insert(1 if at < n else 0, ("I", INSERT, at, AFTER_NEXT[state]))
        return found

    def done(at: int, state: int) -> bool:
        return at == n and (state in ACCEPTING if target is None else state == target)

    if done(0, entry):
        return ""
    path: list[str] = []
    # Each frame: row, state, cost left there, its children not yet tried (last one first).
    stack = [(0, entry, bound, children(0, entry)[::-1])]
    while stack:
        at, state, left, untried = stack[-1]
        if not untried:
            failed[at, state] = max(failed.get((at, state), -1), left)
            stack.pop()
            if path:
                path.pop()
            continue
        edit, cost, row, to = untried.pop()
        rest = left - cost
        if rest < least[row] or failed.get((row, to), -1) >= rest:
            continue
        if target in (START, SYSTEM) and to > target:
            continue
        path.append(edit)
        if done(row, to):
            return "".join(path)
        stack.append((row, to, rest, children(row, to)[::-1]))
    return None


@lru_cache(maxsize=1 << 15)
def cheapest(symbols: str) -> tuple[int, str]:
    """``search`` over a whole conversation; short ones are alike, so they are remembered."""
    return search(symbols)


def crossings(symbols: str) -> list[tuple[int, int, int, str]]:
    """(entry, target, cost, edits) for all ways through a part of a conversation."""
    found = []
    for entry in STATES:
        for target in STATES:
            way = search(symbols, entry, target)
            if way is not None:
                found.append((entry, target, *way))
    return found
