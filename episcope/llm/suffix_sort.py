"""Deep-shallow sorting of short byte strings, with the common prefixes of neighbours.

Multikey quicksort orders the strings by their characters up to a shallow depth.  Groups that
are still equal there have long common prefixes; each is ordered by a blind trie, which holds
only branching characters: a string walks down by those alone to some leaf, one comparison
with that leaf gives the common prefix, and the string branches off at that depth.
"""

from __future__ import annotations


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    diff = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (diff.bit_length() + 7) // 8


class _Node:
    __slots__ = ("depth", "children", "strings")

    def __init__(self, depth: int, children: dict | None, strings: list | None):
        self.depth, self.children, self.strings = depth, children, strings


def _char(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1           # an ended string comes first


def blind_trie(strings: list[bytes], members: list[int]) -> tuple[list[int], list[int]]:
    """(members in order, common prefix of each with the one before; 0 for the first)."""
    root = _Node(len(strings[members[0]]), None, [members[0]])
    for m in members[1:]:
        s = strings[m]
        node = root
        while node.children is not None:                # blind: only branching characters are read
            node = node.children.get(_char(s, node.depth)) or next(iter(node.children.values()))
        other = strings[node.strings[0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node.strings.append(m)
            continue
        parent, node = None, root
        while node.children is not None and node.depth < depth:
            parent, node = node, node.children[_char(s, node.depth)]
        leaf = _Node(len(s), None, [m])
        if node.children is not None and node.depth == depth:
            node.children[_char(s, depth)] = leaf
            continue
        fork = _Node(depth, {_char(other, depth): node, _char(s, depth): leaf}, None)
        if parent is None:
            root = fork
        else:
            parent.children[_char(s, parent.depth)] = fork
    order, lcp, stack, low = [], [], [(root, 0)], 0
    while stack:
        node, shared = stack.pop()
        if node.children is None:
            for i, m in enumerate(node.strings):
                order.append(m)
                lcp.append(shared if i == 0 else len(strings[m]))
            continue
        kids = sorted(node.children)
        for i in range(len(kids) - 1, -1, -1):
            stack.append((node.children[kids[i]], shared if i == 0 else node.depth))
    lcp[0] = low
    return order, lcp


def deep_shallow(strings: list[bytes], shallow: int = 12) -> tuple[list[int], list[int]]:
    """Indexes of the strings in order, and each one's common prefix with the one before it."""
    order: list[int] = []
    lcp: list[int] = []
    stack = [(list(range(len(strings))), 0, 0)]          # members, depth, common prefix with what went before
    while stack:
        members, depth, before = stack.pop()
        if not members:
            continue
        if len(members) == 1:
            order += members
            lcp.append(before)
            continue
        if depth >= shallow:
            o, c = blind_trie(strings, members)
            order += o
            lcp += [before, *c[1:]]
            continue
        pivot = _char(strings[members[len(members) // 2]], depth)
        less, same, more = [], [], []
        for m in members:
            c = _char(strings[m], depth)
            (less if c < pivot else more if c > pivot else same).append(m)
        # parts after the first share exactly `depth` characters with their predecessor
        parts = [(less, depth), (same, depth + 1 if pivot >= 0 else None), (more, depth)]
        first = True
        todo = []
        for part, next_depth in parts:
            if not part:
                continue
            shared = before if first else depth
            first = False
            if next_depth is None:                        # equal strings that end here
                todo.append((part, shallow, shared))
            else:
                todo.append((part, next_depth, shared))
        stack += reversed(todo)
    return order, lcp
