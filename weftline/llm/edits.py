"""Edit distances and a BK-tree over them."""

from __future__ import annotations


def levenshtein(a: str, b: str) -> int:
    """Insertions, deletions and substitutions between two strings; a true metric. Bit-parallel over the longer one."""
    if a == b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    get = where.get
    m = len(a)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    up, down, d = mask, 0, m
    for c in b:
        eq = get(c, 0)
        x = eq | down
        h = ((eq & up) + up) ^ up | eq
        add, sub = down | ~(h | up) & mask, up & h
        if add & top:
            d += 1
        elif sub & top:
            d -= 1
        add = add << 1 | 1
        sub <<= 1
        up, down = (sub | ~(x | add)) & mask, add & x & mask
    return d


def swaps(a: str, b: str) -> int:
    """Edits where exchanging two neighbouring characters counts as one, each part edited once."""
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before2, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before2[j - 2] + 1)
            row.append(d)
    return row[-1]


class BKTree:
    """Words by their distance to the word above them; the triangle inequality rules out branches of a search."""

    def __init__(self, words=(), distance=levenshtein):
        self.distance = distance
        self.root: tuple[str, dict] | None = None
        for w in words:
            self.add(w)

    def add(self, word: str) -> None:
        if self.root is None:
            self.root = (word, {})
            return
        node = self.root
        while True:
            d = self.distance(word, node[0])
            if d == 0:
                return
            if d not in node[1]:
                node[1][d] = (word, {})
                return
            node = node[1][d]

    def within(self, word: str, radius: int) -> list[tuple[int, str]]:
        """(distance, entry) of every entry within the radius."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            entry, below = todo.pop()
            d = self.distance(word, entry)
            if d <= radius:
                found.append((d, entry))
            for k, node in below.items():
                if d - radius <= k <= d + radius:
                    todo.append(node)
        return found
