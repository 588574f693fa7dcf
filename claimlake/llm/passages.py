"""Dense features of passages of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from claimlake.llm import shingles as S
from claimlake.llm.common import slices

#: Words of a passage.
PASSAGE = 100

_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"!", b"?",
            b"|", b".", b",;:", b"#$%&*@^~+=<>\\_", b"\"'()[]{}-/", b"\n"]
NAMES = ["upper", "lower", "digit", "bang", "question", "bar", "stop", "comma", "symbol", "quote",
         "newline", "high", "words", "length", "spread", "long", "single", "all_upper", "symbol_end",
         "distinct", "repeated", "most", "empty"]


def _table() -> np.ndarray:
    table = np.full(256, len(_CLASSES) + 1, np.uint8)
    for k, members in enumerate(_CLASSES):
        table[list(members)] = k
    table[128:] = len(_CLASSES)
    return table


_CLASS = _table()
_N = len(_CLASSES) + 1  # the last counts bytes of non-ASCII letters


def _features(flat: np.ndarray, offsets: np.ndarray, known: tuple | None = None, after: np.uint64 | None = None,
              seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the passages of some rows, the row of each passage, and the pairs of words.

    For a part of one long row: its words as already ``known``, the word ``after`` them, and the
    pairs of words ``seen`` before.
    """
    rows = len(offsets) - 1
    found, starts, ends = known or S.word_bounds(flat, offsets)
    pair = np.zeros(0, np.uint64)
    begins = np.searchsorted(starts, offsets)
    counts = np.diff(begins)
    per_row = np.maximum(1, -(-counts // PASSAGE))
    row = np.repeat(np.arange(rows), per_row)
    first = np.concatenate([[0], np.cumsum(per_row)])
    k = np.arange(first[-1]) - first[row]
    low = begins[row] + k * PASSAGE
    high = np.minimum(low + PASSAGE, begins[row + 1])
    n = (high - low).astype(float)
    some = n > 0
    out = np.zeros((len(row), len(NAMES)))
    if len(found):
        at = np.where(some, starts[np.minimum(low, len(starts) - 1)], 0)
        to = np.where(some, ends[np.maximum(high, 1) - 1], 0)
        size = np.maximum(1, to - at)
        kinds = _CLASS[flat]
        for c in range(_N):
            run = np.concatenate([[0], np.cumsum(kinds == c)])
            out[:, c] = (run[to] - run[at]) / size
        lengths = (ends - starts).astype(float)
        upper = np.concatenate([[0], np.cumsum(kinds == 0)])
        lower = np.concatenate([[0], np.cumsum(kinds == 1)])
        shout = (upper[ends] - upper[starts] > 1) & (lower[ends] == lower[starts])
        tail = np.isin(kinds[ends - 1], (3, 5, 8))
        passage = np.repeat(np.arange(len(row)), (high - low))

        def mean(x):
            return np.bincount(passage, x, len(row)) / np.maximum(1, n)

        length = mean(lengths)
        spread = np.sqrt(np.maximum(0, mean(lengths**2) - length**2))
        order = np.lexsort((found, passage))
        word, owner = found[order], passage[order]
        new = np.append(True, (np.diff(owner) != 0) | (word[1:] != word[:-1]))
        runs = np.diff(np.append(np.flatnonzero(new), len(new)))
        most = np.zeros(len(row))
        np.maximum.at(most, owner[new], runs)
        # pairs of words seen before in the same row
        of = row[passage]
        follow = np.append(found[1:], np.uint64(0) if after is None else after)
        first = np.flatnonzero(np.append(of[:-1] == of[1:], after is not None))
        pair = S.mix(found[first] * np.uint64(3) + follow[first])
        order = np.lexsort((pair, of[first]))
        again = np.zeros(len(found))
        again[first[order[1:]]] = (np.diff(of[first][order]) == 0) & (np.diff(pair[order]) == 0)
        if seen is not None:
            again[first] = np.maximum(again[first], np.isin(pair, seen))
        out[:, _N:] = np.stack([
            np.log1p(n), length, spread, mean(lengths >= 16), mean(lengths == 1), mean(shout), mean(tail),
            np.bincount(owner[new], minlength=len(row)) / np.maximum(1, n), mean(again),
            most / np.maximum(1, n), np.zeros(len(row))], axis=1)
    out[~some, -1] = 1
    return out, row, pair


def _long_features(flat: np.ndarray) -> np.ndarray:
    """Features of the passages of one long text, in pieces cut between two passages.

    A piece ends a word short of what was read, so the word after it is known; pairs of words are
    remembered. The result is that of the text as a whole.
    """
    out, seen, held = [], np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    cuts = list(S.pieces(flat))
    for k, piece in enumerate(cuts):
        held = np.concatenate([held, piece])
        found, starts, ends = S.word_bounds(held, np.zeros(0, np.int64))
        last = k == len(cuts) - 1
        take = len(found) if last else max(0, len(found) - 1) // PASSAGE * PASSAGE
        if take or (last and not out):
            part, _, pair = _features(held, np.array([0, len(held)]), (found[:take], starts[:take], ends[:take]),
                                      None if last else found[take], seen)
            out.append(part)
            seen = np.union1d(seen, pair)
        if not last:
            held = held[starts[take] if take < len(found) else len(held):]
    return np.concatenate(out)


def passage_features(flat: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, features, row of each passage less the first).

    Every row has a passage at least; one without words has only ``empty`` set. A text longer
    than some megabytes is read in pieces, with the features of the whole.
    """
    for low, high in slices(offsets):
        part = flat[offsets[low]:offsets[high]]
        if high == low + 1 and len(part) > S.CHUNK:
            found = _long_features(part)
            yield low, found, np.zeros(len(found), np.int64)
        else:
            yield low, *_features(part, offsets[low:high + 1] - offsets[low])[:2]
