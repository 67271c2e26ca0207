"""Edit distance of two strings up to a bound, a column of bits at a time."""

from __future__ import annotations


def within(a: str, b: str, most: int) -> bool:
    """Whether at most ``most`` insertions, deletions and replacements make b of a.

    What the strings share at their ends is taken off first. Of the table of distances
    only the band of diagonals up to ``most`` from the main one can hold values up to the
    bound, so matches outside the band are masked. A column's differences from row to row
    are two words of bits, one for +1 and one for -1, so a column costs a few operations.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return False
    start = 0
    while start < len(a) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(a) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not most:
        return len(b) <= most
    rows, columns = len(a), len(b)
    places: dict[str, int] = {}
    for row, char in enumerate(a):
        places[char] = places.get(char, 0) | 1 << row
    full, last = (1 << rows) - 1, 1 << (rows - 1)
    band = (1 << (2 * most + 1)) - 1
    up, down, distance = full, 0, rows
    for column, char in enumerate(b):
        low = column - most
        inside = band << low if low >= 0 else band >> -low
        match = places.get(char, 0) & inside
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        right = down | (full & ~(diagonal | up))
        left = up & diagonal
        distance += bool(right & last) - bool(left & last)
        # Each column to come can lower the distance by one at most.
        if distance - (columns - column - 1) > most:
            return False
        right = (right << 1 | 1) & full
        left = (left << 1) & full
        up = left | (full & ~(diagonal | right))
        down = right & diagonal
    return distance <= most
