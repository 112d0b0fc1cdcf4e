"""Merging Burrows-Wheeler transforms by iterative interleave refinement.

The merged transform of several collections is an interleave of theirs: each
collection's rows keep their order.  Starting from "all of the first, all of
the second, ...", which is right for suffixes compared on no symbol, one
round reads the transforms' symbols in the current interleave and deals each
row's collection to its symbol's bucket, in order; the interleave is then
right for one symbol more.  A border between two rows that appears in round k
means that their suffixes share k - 1 symbols.  No suffix is compared or
sorted again.
"""

from __future__ import annotations

import numpy as np

from pulse.llm.common import ship
from pulse.llm.fm_index import suffix_order

ship(__name__)


def transform(text: np.ndarray, before: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """One collection: (rows' suffixes, rows' preceding symbols) in order of the first ``depth`` symbols.

    ``text`` holds sequences that each end in a 0; ``before`` is the symbol
    before each place within its sequence, taken round the end.
    """
    order = suffix_order(text, depth)
    return order, before[order]


def merge(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(interleave, common): the collection of every merged row, and the number
    of symbols that a row's suffix shares with the row's above, up to ``depth``."""
    source = np.repeat(np.arange(len(transforms), dtype=np.int32), [len(t) for t in transforms])
    common = np.full(len(source), -1, np.int64)  # -1: no border yet
    block = np.zeros(len(source), np.int64)
    for done in range(depth):
        symbol = np.empty(len(source), np.int64)
        for number, rows in enumerate(transforms):
            symbol[source == number] = rows
        order = np.argsort(symbol, kind="stable")
        source, symbol, inside = source[order], symbol[order], block[order]
        border = np.zeros(len(source), bool)
        border[1:] = (symbol[1:] != symbol[:-1]) | (inside[1:] != inside[:-1])
        # borders only become more: a row apart after k symbols stays apart
        fresh = border & (common < 0)
        common[fresh] = done
        block = np.cumsum(border)
    common[common < 0] = depth
    if len(common):
        common[0] = 0
    return source, common
