"""Greedy string tiling of two texts, and whether one only says the other again.

Tiles are common pieces, longest first, no letter of either text in two tiles. A suffix automaton
of the one text gives the longest piece that ends at each place of the other, in time
proportional to both; pieces that meet letters already taken are cut to what is free, and the
rest of both texts is tiled again until no piece is left. One algorithm serves texts of any
length.
"""

from __future__ import annotations

import heapq

#: The share of the question a copy may lack, in one run; short questions may lack a word.
MISSING_SHARE, MISSING_WORD = 0.25, 16
#: Letters of a lead-in, or this share of the question; whole questions may have longer ones.
LEAD_LETTERS, LEAD_SHARE = 16, 0.2
#: Letters of the question for each tile beyond the first two (ideographs count double).
LETTERS_PER_TILE = 12


class Automaton:
    """The suffix automaton of a text."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for c in text:
            now = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = now
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                if self.length[p] + 1 == self.length[q]:
                    self.link[now] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = self.link[p]
                    self.link[q] = self.link[now] = clone
            last = now

    def longest(self, text: str) -> list[int]:
        """For each place of ``text`` the length of the longest piece of both that ends there."""
        out, state, n = [], 0, 0
        for c in text:
            while state and c not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if c in self.next[state]:
                state, n = self.next[state][c], n + 1
            out.append(n)
        return out


def tiles(a: str, b: str, least: int) -> list[tuple[int, int, int]]:
    """(at in a, at in b, length) of pieces of at least ``least`` letters, longest first."""
    out: list[tuple[int, int, int]] = []
    taken_a, taken_b = bytearray(len(a)), bytearray(len(b))
    # letters that are taken become marks that the other text does not hold
    free_a, free_b = a, b
    while True:
        found = Automaton(free_a).longest(free_b)
        heap = [(-n, j + 1 - n) for j, n in enumerate(found) if n >= least and (j + 1 == len(found) or found[j + 1] != n + 1)]
        heapq.heapify(heap)
        before = len(out)
        while heap:
            n, j = heapq.heappop(heap)
            n = -n
            hit = taken_b.find(1, j, j + n)
            if hit >= 0:
                last = taken_b.rfind(1, j, j + n)
                for lo, hi in ((j, hit), (last + 1, j + n)):
                    if hi - lo >= least:
                        heapq.heappush(heap, (lo - hi, lo))
                continue
            piece, i = b[j : j + n], a.find(b[j : j + n])
            while i >= 0 and (hit := taken_a.rfind(1, i, i + n)) >= 0:
                i = a.find(piece, hit + 1)
            if i >= 0:
                taken_a[i : i + n] = taken_b[j : j + n] = b"\x01" * n
                out.append((i, j, n))
        if len(out) == before:
            return out
        if taken_a.find(0) < 0 or taken_b.find(0) < 0:
            return out
        free_a = "".join("\x00" if t else c for c, t in zip(a, taken_a))
        free_b = "".join("\x01" if t else c for c, t in zip(b, taken_b))


def _runs(taken: bytearray) -> list[tuple[int, int]]:
    """The runs of letters in no tile."""
    out, lo = [], 0
    while (lo := taken.find(0, lo)) >= 0:
        hi = taken.find(1, lo)
        hi = len(taken) if hi < 0 else hi
        out.append((lo, hi))
        lo = hi
    return out


def _one_saying(question: str, reply: str, least: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
    """Runs of the question and of the reply that no tile covers, and the number of tiles.

    A run of the reply too short for a tile counts as covered if the question goes on with it
    beside the same tile.
    """
    found = sorted(tiles(question, reply, least), key=lambda t: t[1])
    in_q, in_r = bytearray(len(question)), bytearray(len(reply))
    for i, j, n in found:
        in_q[i : i + n] = in_r[j : j + n] = b"\x01" * n
    if found:
        for lo, hi in _runs(in_r):
            left = max((t for t in found if t[1] + t[2] == lo), default=None)
            right = min((t for t in found if t[1] == hi), default=None)
            start = left[0] + left[2] if left else 0
            stop = right[0] if right else len(question)
            piece = reply[lo:hi]
            if hi - lo < least and stop - start >= hi - lo:
                at = start if question.startswith(piece, start) else stop - (hi - lo) if left and question.endswith(piece, start, stop) else -1
                if at >= 0 and in_q.find(1, at, at + hi - lo) < 0:
                    in_q[at : at + hi - lo] = in_r[lo:hi] = b"\x01" * (hi - lo)
    return _runs(in_q), _runs(in_r), len(found)


def _share_pieces(a: str, b: str, least: int, need: float) -> bool:
    """Whether at least ``need`` of the pieces of ``least`` letters of ``a`` stand in ``b``."""
    if need <= 0:
        return True
    grams = {b[i : i + least] for i in range(len(b) - least + 1)} if len(b) > 200 else b
    left = len(a) - least + 1 - need  # so many may be missing
    for i in range(len(a) - least + 1):
        if a[i : i + least] not in grams:
            left -= 1
            if left < 0:
                return False
    return True


def may_be_copy(question: str, reply: str, least: int, most: float, missing: float, lead: float) -> bool:
    """A necessary condition: letters, and pieces of ``least`` letters, that a copy must share.

    The reply has all letters of the question but for those missing, and beyond the lead-in none
    that the question has not. A tile of n letters has n + 1 - least of them, and at each of its ends up to least - 1 letters
    may be covered beside the tiles; so both texts must share what they cover less twice that for
    each tile.
    """
    own = set(question)
    if sum(max(0, question.count(c) - reply.count(c)) for c in own) > missing or sum(map(reply.count, set(reply) - own)) > lead:
        return False
    lost = 2 * (least - 1) * most
    said = max(1, -(-len(reply) // len(question)))
    return _share_pieces(question, reply, least, len(question) - missing - lost) and _share_pieces(reply, question, least, len(reply) - lead - said * lost)


def is_copy(question: str, reply: str) -> bool:
    """Letters of the question and of the reply: does the reply only say the question again?

    It does if tiles cover the whole reply behind a lead-in, and the question but for one run of
    at most ``MISSING_SHARE`` of it (of ``MISSING_WORD`` letters, and half of it, if that is
    more). The tiles may stand in another order, if they are not many for the length of the
    question. What is left of the reply then must cover the question again, but for the share alone,
    so a question said twice is a copy and a question followed by an answer from its words is none.
    """
    q, rest = len(question), reply
    if q < 4 or len(reply) < 4:
        return question == reply and q >= 2
    if question == reply:
        return True
    least = 3 if question.isascii() else 2
    missing, lead = min(0.5 * q, max(MISSING_WORD, MISSING_SHARE * q)), max(LEAD_LETTERS, LEAD_SHARE * q)
    most = 2 + q / (LETTERS_PER_TILE if question.isascii() else LETTERS_PER_TILE // 2)
    if len(reply) < q - missing or not may_be_copy(question, reply, least, most, missing, lead):
        return False
    if question in reply:
        # the longest tile possible: what is around it is a lead-in or must be the question again
        before, _, after = reply.partition(question)
        while after.startswith(question):
            after = after[q:]
        if len(before) > lead:
            return False
        if not after:
            return True
        rest = after
    while True:
        if rest is not reply:
            missing = MISSING_SHARE * q  # said again, so nearly whole
        if len(rest) < q - missing:
            return False
        not_q, not_r, count = _one_saying(question, rest, least)
        if len(not_q) > 1 or sum(b - a for a, b in not_q) > missing or count > most:
            return False
        if rest is reply and not_r and not_r[0][0] == 0 and not_r[0][1] <= lead:
            if not_q and not_q[0][0] == 0:
                return False  # other words in place of the beginning
            not_r = not_r[1:]
        if not not_r:
            return True
        if len(not_r) > 1:
            return False
        rest = rest[not_r[0][0] : not_r[0][1]]
