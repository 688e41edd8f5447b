"""Words of letters and digits, with A-Z lower-cased, of Arrow text columns; long texts come in pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from emberlog.llm.text import STEP_BYTES, characters, word_spans

_CODES = np.arange(256)

#: Bytes between words: ASCII other than digits and letters. All bytes of characters beyond ASCII belong to words.
BETWEEN = (_CODES < 128) & ~((_CODES >= 48) & (_CODES <= 57) | (_CODES >= 65) & (_CODES <= 90) | (_CODES >= 97) & (_CODES <= 122))

#: Every byte, with A-Z lower-cased.
FOLD = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)


def _cuts(data: np.ndarray, limit: int) -> list[int]:
    """Where a text is cut into pieces of about ``limit`` bytes, between words only."""
    at, cuts = 0, [0]
    while len(data) - at > limit:
        back = np.flatnonzero(BETWEEN[data[at + limit // 2:at + limit]])
        if len(back):
            at += limit // 2 + int(back[-1]) + 1
        else:
            step = at + limit  # within a word longer than half the limit: on to its end
            while step < len(data) and not (ends := np.flatnonzero(BETWEEN[data[step:step + limit]])).size:
                step += limit
            if step >= len(data):
                break
            at = step + int(ends[0]) + 1
        cuts.append(at)
    return [*cuts, len(data)]


def word_pieces(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(row of each text, lower-cased bytes, starts, ends, bounds of each text's words, whether it goes on) of a column.

    All rows come at once if their bytes are within ``limit``. A single longer text comes in several pieces cut between words,
    so that memory follows the limit (or one word longer than that), not the text. Null has no words.
    """
    data, offsets = characters(texts)
    if len(offsets) != 2 or len(data) <= limit:
        data = FOLD[data]
        yield np.arange(len(offsets) - 1), data, *word_spans(data, offsets, BETWEEN), False
        return
    cuts = _cuts(data, limit)
    for low, high in zip(cuts[:-1], cuts[1:]):
        part = FOLD[data[low:high]]
        yield np.zeros(1, np.int64), part, *word_spans(part, np.array([0, high - low]), BETWEEN), low > 0
