"""Repeated passages with a sparse suffix array.

Only suffixes that begin at anchors (content-selected minimiser positions, about one word
in twenty) are kept. Those of a shard are sorted by the words that follow; a suffix that
shares its anchor with neither neighbour is done. For the others the common prefix with the
next suffix says how far a match extends to the right of the anchor, and the same for the
words before the anchor, read backwards, how far to the left. Both orders split the windows
that begin the same number of words before their anchors into classes; windows of the same
class on both sides are equal.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from noticemill.llm.repeats import Place, Run, runs_of, without_repeats

# A passage is repeated from this many words on.
LENGTH = 50
GRAM = 10


def sorted_with_common(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of arrays of words, and how many words each shares with the one before it."""
    sizes = np.array([len(p) for p in parts], np.int64)
    raw = [p.tobytes() for p in parts]
    order = np.array(sorted(range(len(parts)), key=raw.__getitem__), np.int64)
    table = np.zeros((len(parts), int(sizes.max(initial=0)) + 1), np.uint32)
    table[np.arange(table.shape[1]) < sizes[:, None]] = np.concatenate(parts) if len(parts) else 0
    table = table[order]
    common = np.zeros(len(parts), np.int64)
    # the last column always differs, so that equal rows count as far as they reach
    differ = table[1:] != table[:-1]
    differ[:, -1] = True
    common[1:] = np.minimum(differ.argmax(axis=1), np.minimum(sizes[order][1:], sizes[order][:-1]))
    return order, common


def _classes(order: np.ndarray, common: np.ndarray, n: int) -> np.ndarray:
    """For each array a number that those share which agree in their first n words."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < n)
    return out


def first_equal_windows(gram: int):
    """The engine of the sparse suffix array for anchors of `gram` words.

    With 0 there are no anchors: the suffixes of all windows are sorted, and extended to the
    right alone.
    """

    def solve(texts: list[list[bytes]], at: list[int], places: list[Place], length: int) -> list[list[Run]]:
        numbers: dict[bytes, int] = {}
        for words in texts:
            for word in words:
                numbers.setdefault(word, len(numbers))
        # big-endian numbers sort as bytes in the order of words
        coded = [np.array([numbers[w] for w in words], ">u4") for words in texts]
        if gram:
            anchors = list(enumerate(at))
        else:
            anchors = [(k, j) for k, words in enumerate(texts) for j in range(len(words) - length + 1)]
        # unless an earlier one is found, a window's first place is its own
        out: list[list[Run]] = [[(len(t) - length + 1, *p)] if len(t) >= length else [] for t, p in zip(texts, places)]
        first: dict[int, list[Place]] = {}
        order, common = sorted_with_common([coded[k][a : a + length] for k, a in anchors])
        shared = np.append(common, 0) >= max(gram, 1)
        # in the order of the anchors' places, so that the first of a class is its first place
        place = lambda i: (*places[anchors[i][0]][:2], places[anchors[i][0]][2] + anchors[i][1])
        left_over = sorted(order[shared[:-1] | shared[1:]].tolist(), key=place)
        kept = [anchors[i] for i in left_over]
        after = sorted_with_common([coded[k][a : a + length] for k, a in kept])
        before = sorted_with_common([coded[k][:a][::-1] for k, a in kept])
        left, right = (np.array(x, np.int64) for x in ([a for _, a in kept], [len(texts[k]) - a for k, a in kept]))
        for n in range(length - gram + 1 if gram else 1):
            fit = np.flatnonzero((left >= n) & (right >= length - n))
            if not len(fit):
                continue
            both = _classes(*after, length - n) * (len(kept) + 1) + _classes(*before, n)
            _, least, of = np.unique(both[fit], return_index=True, return_inverse=True)
            other = fit[least[of]]
            changed = np.flatnonzero(other != fit)
            for i, o in zip(fit[changed].tolist(), other[changed].tolist()):
                (k, a), (k_first, a_first) = kept[i], kept[o]
                if k not in first:
                    doc, row, word = places[k]
                    first[k] = [(doc, row, word + j) for j in range(len(texts[k]) - length + 1)]
                first[k][a - n] = (*places[k_first][:2], places[k_first][2] + a_first - n)
        for k, found in first.items():
            out[k] = runs_of(found)
        return out

    return solve


def repeated_passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Find passages of at least `length` words that also occur at an earlier place.

    Words are runs of characters other than white space, unchanged. Places are ordered by
    doc_id (null last), rows of one doc_id as they are read, then words. Result per row:
    `row` (the other columns, in a struct), `text`, n_words, n_removed (words in repeated
    windows), kept (the other words joined by one space) and spans (first, n, of_doc_id,
    of_first): maximal runs of such words, and the earliest place of the window each begins
    with. The first place of a passage is never reported. Null, empty and shorter texts have no passages; a second row with
    the same text repeats the first.
    """
    gram = min(gram, length)
    return without_repeats(docs, length, gram, first_equal_windows(gram), within=True)
