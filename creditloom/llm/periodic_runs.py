"""Periodic runs of words: stretches that repeat a block of words back to back, and texts without the repeats.

A *run* is a stretch of consecutive words with smallest period q (words q apart are the same) whose length is at least ``exponent`` times q
and at least ``least`` words, and which no neighbouring word extends while the period stays q.

Method. The words of a stretch go through a suffix automaton; its suffix links form a tree, in which the path from the root to a prefix's
state holds all suffixes of that prefix. Appending the word at position i *accesses* that path in a link-cut tree: the path falls into
segments of one colour, the position where the segment's suffixes ended last, and is then recoloured to i. A segment of colour c whose
longest suffix has L words says that the same L words end at c and at i and nowhere between. With d = i - c, and L >= d, that is a square of
period d; it starts at i - L - d + 1, no word before it fits, and d is its smallest period. Comparing words d apart to the right
gives the run; later positions within a run known for d are skipped.

Screen. From a run's (q+1)-th word on, every word stood at most q words before. So for every power of two only stretches of
(exponent - 1) * 2^k words that all stood less than 2^(k+1) before can hold the rest of a run of period 2^k .. 2^(k+1) - 1; the union of these
stretches, lengthened by one period at the left, holds every run whole, and only it goes through the automaton. The screen drops no run.

Everything happens inside the task that scans a text; nothing is shuffled. Memory is linear in the longest text: about 30 bytes a
word, and 500 more for words inside the screened stretches.

Odd input: a null, empty or blank text has no words, no runs and an empty collapsed text. Rows are judged one by one, so repeated rows and null
ids give repeated rows and null ids. Only the two named columns are read; other columns, whatever their names, are not touched. An empty
table gives an empty table. Texts are never cut, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.tasks import map_rows

#: Runs between ASCII blanks.
WORD = re.compile(r"[^ \x09-\x0D]+")
EXPONENT, LEAST = 4, 6
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def screened(ids: list[int], exponent: int = EXPONENT) -> list[tuple[int, int]]:
    """Stretches [from, to) outside which no run of at least ``exponent`` periods can be, apart from each other and in order."""
    n = len(ids)
    if n < exponent:
        return []
    words = np.array(ids)
    order = np.argsort(words, kind="stable")
    again = words[order[1:]] == words[order[:-1]]
    gaps = np.full(n, n + 1)
    gaps[order[1:][again]] = np.diff(order)[again]
    found = []
    scale = 1
    while exponent * scale <= n:
        far_ones = np.flatnonzero(gaps >= 2 * scale)
        edges = np.concatenate(([-1], far_ones, [n]))
        long = np.flatnonzero(np.diff(edges) - 1 >= (exponent - 1) * scale)
        for at in long.tolist():
            found.append((max(0, int(edges[at]) + 1 - (2 * scale - 1)), int(edges[at + 1])))
        scale *= 2
    found.sort()
    merged: list[tuple[int, int]] = []
    for start, end in found:
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


class Automaton:
    """The suffix automaton of a list of words. State 1 is the empty text; 0 stands for none."""

    def __init__(self, words: list[int]) -> None:
        self.longest, self.link, self.prefix = [0, 0], [0, 0], []
        longest, link, steps = self.longest, self.link, [{}, {}]
        last = 1
        for word in words:
            state = len(longest)
            longest.append(longest[last] + 1)
            link.append(1)
            steps.append({})
            at = last
            while at and word not in steps[at]:
                steps[at][word] = state
                at = link[at]
            if at:
                old = steps[at][word]
                if longest[old] == longest[at] + 1:
                    link[state] = old
                else:
                    clone = len(longest)
                    longest.append(longest[at] + 1)
                    link.append(link[old])
                    steps.append(steps[old].copy())
                    while at and steps[at].get(word) == old:
                        steps[at][word] = clone
                        at = link[at]
                    link[old] = link[state] = clone
            self.prefix.append(state)
            last = state


class ColouredPaths:
    """A link-cut tree over a fixed tree whose preferred paths each have one colour, kept at the root of the path's splay tree."""

    def __init__(self, parent: list[int]) -> None:
        self.up = parent.copy()  # within a splay tree, and from its root to the path above
        self.left, self.right, self.colour = [0] * len(parent), [0] * len(parent), [-1] * len(parent)

    def splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        top = x
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                break
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                top = g
                self.rotate(p if (left[g] == p) == (left[p] == x) else x)
            else:
                top = p
            self.rotate(x)
        if top != x:
            self.colour[x] = self.colour[top]

    def rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            child = left[p] = right[x]
            right[x] = p
        else:
            child = right[p] = left[x]
            left[x] = p
        if child:
            up[child] = p
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        up[x], up[p] = g, x

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Recolours the path from the root to ``node``; gives (deepest node, colour so far) of every segment that it met."""
        met, below, x = [], 0, node
        while x:
            self.splay(x)
            met.append((x, self.colour[x]))
            rest = self.right[x]
            if rest:
                self.colour[rest] = self.colour[x]
            self.right[x] = below
            below, x = x, self.up[x]
        self.colour[below] = colour
        return met


def runs_of(words: list[int], exponent: int = EXPONENT, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a list of words, by start and then period."""
    found = []
    for begin, end in screened(words, exponent):
        stretch = words[begin:end]
        automaton = Automaton(stretch)
        paths, longest = ColouredPaths(automaton.link), automaton.longest
        known: dict[int, int] = {}  # period: end of its last run
        for i, state in enumerate(automaton.prefix):
            for node, colour in paths.access(state, i):
                period = i - colour
                if colour < 0 or longest[node] < period or known.get(period, 0) > i:
                    continue
                stop = i + 1
                while stop < len(stretch) and stretch[stop] == stretch[stop - period]:
                    stop += 1
                known[period] = stop
                start = i - longest[node] - period + 1
                if stop - start >= max(least, exponent * period):
                    found.append((begin + start, stop - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run contains after its first period, joined by one blank."""
    if not runs:
        return " ".join(words)
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    keep = np.cumsum(dropped[:-1]) == 0
    return " ".join([word for word, kept in zip(words, keep.tolist()) if kept])


def find(df: DataFrame, doc_id: str = "doc_id", text: str | Column = "text", exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``runs`` by start and then period, and ``collapsed``, the text without the repeats.

    ``exponent`` must be 2 or more: the squares are what the automaton finds.
    """
    if exponent < 2:
        raise ValueError("a run has at least two periods")
    body = F.col(f"`{text}`") if isinstance(text, str) else text

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, value in rows:
            words = WORD.findall(value or "")
            numbers: dict[str, int] = {}
            runs = runs_of([numbers.setdefault(word, len(numbers)) for word in words], exponent, least)
            yield key, runs, collapse(words, runs)

    kind = df.select(F.col(f"`{doc_id}`")).schema[0].dataType.simpleString()
    return map_rows(df.select(F.col(f"`{doc_id}`"), body.alias("_body")), f"`{doc_id}` {kind}, runs {RUNS}, collapsed string", work)
