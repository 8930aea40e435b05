"""Substring dedup with suffix automata of reference shards.

The reference shards are the segments that `repeats` routes by their anchors. Each shard
gets one suffix automaton over its segments, whose states know the smallest doc_id in which
their words occur; the shard's segments are then streamed through it, and the matching
statistic at each word, cut back to the window length, names the state of the window that
ends there. A span of words is removed where such a state has a smaller doc_id.

Shards are not broadcast to every document: with all documents as reference that would
compare each with each. A window's words decide the shard, so every window meets all its
equals in one place.
"""

from __future__ import annotations

from collections import defaultdict
from functools import partial
from itertools import groupby

from pyspark.sql import DataFrame

from noticemill.llm.blocks import LAST
from noticemill.llm.repeats import Place, Run, without_repeats

WINDOW = 13
GRAM = 5


class SuffixAutomaton:
    """All substrings of the texts added, with the smallest label of a text that has them."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.label = [-1], [0], [LAST]

    def _state(self, length: int, link: int, follow: dict) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.label.append(LAST)
        return len(self.next) - 1

    def _cloned(self, state: int, word, target: int) -> int:
        """The part of `target` that `state` reaches with `word`, as a state of its own."""
        link, length, follow = self.link, self.length, self.next
        clone = self._state(length[state] + 1, link[target], follow[target].copy())
        link[target] = clone
        while state >= 0 and follow[state].get(word) == target:
            follow[state][word] = clone
            state = link[state]
        return clone

    def add(self, words: list, label: int) -> None:
        link, length, follow, labels = self.link, self.length, self.next, self.label
        last = 0
        for word in words:
            target = follow[last].get(word)
            if target is not None:
                last = target if length[target] == length[last] + 1 else self._cloned(last, word, target)
            else:
                state = self._state(length[last] + 1, 0, {})
                at = last
                while at >= 0 and word not in follow[at]:
                    follow[at][word] = state
                    at = link[at]
                if at >= 0:
                    target = follow[at][word]
                    link[state] = target if length[target] == length[at] + 1 else self._cloned(at, word, target)
                last = state
            if label < labels[last]:
                labels[last] = label

    def finish(self) -> None:
        """Hand labels on to the suffixes: a text that has a string has its suffixes."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.label[state] < self.label[up]:
                self.label[up] = self.label[state]

    def matches(self, words: list, longest: int):
        """At each word the length (at most `longest`) and state of the longest match that ends there."""
        link, length, follow = self.link, self.length, self.next
        state = size = 0
        for word in words:
            while state and word not in follow[state]:
                state = link[state]
                size = length[state]
            target = follow[state].get(word)
            if target is None:
                yield 0, 0
                continue
            state, size = target, size + 1
            while length[link[state]] >= longest:
                state = link[state]
            size = min(size, longest)
            yield size, state


def smallest_documents(texts: list[list[bytes]], at: list[int], places: list[Place], length: int, gram: int) -> list[list[Run]]:
    """For the windows of each segment, in runs, the smallest doc_id that has them; rows and words are left 0.

    `texts` are different segments; all windows of one have the words at its anchor in common.
    One whose anchor no other has shares no window, so only its own document has them.
    """
    by_anchor: dict[tuple, list[int]] = defaultdict(list)
    for k, (words, anchor) in enumerate(zip(texts, at)):
        by_anchor[tuple(words[anchor : anchor + gram])].append(k)
    shared = sorted(k for group in by_anchor.values() if len(group) > 1 for k in group)
    out: list[list[Run]] = [[(len(words) + 1 - length, doc, 0, 0)] for words, (doc, _, _) in zip(texts, places)]
    automaton = SuffixAutomaton()
    for k in shared:
        automaton.add(texts[k], places[k][0])
    automaton.finish()
    label = automaton.label
    for k in shared:
        labels = [label[state] for size, state in automaton.matches(texts[k], length) if size >= length]
        out[k] = [(sum(1 for _ in same), doc, 0, 0) for doc, same in groupby(labels)]
    return out


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Take out of each document the words of windows that a document with a smaller doc_id has.

    Words are runs of characters other than white space, unchanged. Result: `row` (the
    other columns, in a struct, so that names can't clash), `text`, n_words, n_removed, kept
    (remaining words joined by one space) and spans. All windows are judged on the input.
    A null or empty text has no words; a text shorter than a window loses nothing. A null
    doc_id counts as larger than all others: its rows lose what others have, and never take
    anything from others. Rows with the same doc_id do not take from each other.
    """
    return without_repeats(docs, window, min(gram, window), partial(smallest_documents, gram=min(gram, window)), within=False).drop("spans")
