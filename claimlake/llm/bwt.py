"""Burrows-Wheeler transforms of sets of strings, merged by iterative interleave refinement.

The transform of a shard is the byte before each of its suffixes, in sorted order, with an end
mark below all bytes for each string. Shards are merged without comparing or sorting suffixes:
an interleave says from which shard each row of the merged transform comes. It starts as shard
after shard; in round h it is dealt by the bytes of the shards' transforms, stably, and is then
right for the first h bytes. Where a round first tells two neighbours apart, their common
prefix is known; rows never told apart in L rounds share L bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Rounds after which strings without a shared prefix left are taken out of the merge.
_PRUNE = 8


@dataclass
class Shard:
    """Transform of some strings: for each row its string, offset and the symbol before it
    (0: the row is a whole string)."""

    string: np.ndarray
    offset: np.ndarray
    symbol: np.ndarray


def transform(flat: np.ndarray, offsets: np.ndarray, string: np.ndarray) -> Shard:
    """Sort the suffixes of one shard by doubling, each refined only while it has equals.

    ``string`` names the strings and orders end marks.
    """
    sizes = np.diff(offsets)
    n = int(sizes.sum() + len(sizes))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    at = np.arange(n) - begins[owner]
    text = np.zeros(n + 256, np.uint16)
    body = at < sizes[owner]
    text[:n][body] = flat.astype(np.uint16) + 1
    # behind the end mark every position counts as the mark: equal suffixes then tie in full
    left = sizes[owner] - at
    rank = text[:n].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    rank = _dense(rank[order], order, n)
    h = 1
    longest = int(sizes.max(initial=0)) + 1
    while h < longest:
        beyond = np.where(left > h, np.append(rank, np.zeros(1, np.int64))[np.minimum(np.arange(n) + h, n)], -1)
        count = np.bincount(rank, minlength=n)
        live = np.flatnonzero(count[rank] > 1)
        if not len(live):
            break
        key = rank[live] * np.int64(n + 1) + (beyond[live] + 1)
        by = np.argsort(key, kind="stable")
        sorted_key, who = key[by], live[by]
        base = rank[who]  # ranks are first places of their blocks
        new = np.append(True, sorted_key[1:] != sorted_key[:-1])
        block = np.append(True, base[1:] != base[:-1])
        place = np.arange(len(who)) - np.maximum.accumulate(np.where(block, np.arange(len(who)), 0)) + base
        rank[who] = place[np.maximum.accumulate(np.where(new, np.arange(len(who)), 0))]
        h *= 2
    order = np.lexsort((owner, rank))  # equal to the end: by string, as their end marks
    symbol = np.where(at[order] > 0, text[order - 1], 0)
    return Shard(string[owner[order]], at[order], symbol.astype(np.uint16))


def _dense(sorted_key: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """Rank of each position as the first place of its block."""
    new = np.append(True, sorted_key[1:] != sorted_key[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    return rank


def merge(shards: list[Shard], sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge at most eight shards: (string, offset, common) of the rows of the merged transform in sorted order, for strings
    that still share ``depth`` bytes with others or among themselves; ``common`` is the length
    of the prefix a row shares with the row above it, at most ``depth``.

    ``sizes`` has the length of each string. Suffixes of fewer than ``depth`` bytes guide the
    merge but are of no interest; strings of which every other suffix stands alone are dropped.
    """
    shards = [s for s in shards if len(s.string)]
    if not shards:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int16)
    marks = [int((s.offset == sizes[s.string]).sum()) for s in shards]
    total = sum(len(s.string) for s in shards)
    weave = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s.string) for s in shards])
    wide = any((s.symbol > 255).any() for s in shards)
    shards = [Shard(s.string, s.offset, s.symbol.astype(np.uint16 if wide else np.uint8)) for s in shards]
    common = np.full(total, depth, np.int16)  # unless a round tells a row from the one above
    common[:1] = 0
    for h in range(1, depth + 1):
        symbol = np.empty(len(weave), shards[0].symbol.dtype)
        for k, s in enumerate(shards):
            symbol[weave == k] = s.symbol
        order = np.argsort(symbol, kind="stable")
        dealt = symbol[order]
        # neighbours differ in h bytes if their first bytes do, or if the rows they come from did in h - 1
        # one gather brings a row's shard and the block of h - 1 bytes that it comes from
        rows = ((np.cumsum(common < h - 1, dtype=np.int32) << 3) | weave)[order]
        behind = rows >> 3
        split = np.empty(len(weave), bool)
        split[:1] = True
        np.not_equal(dealt[1:], dealt[:-1], out=split[1:])
        split[1:] |= behind[1:] != behind[:-1]
        weave = (rows & 7).astype(np.uint8)
        ends = sum(marks)
        weave[:ends] = np.repeat(np.arange(len(shards), dtype=np.uint8), marks)
        split[:ends] = True
        common[split & (common >= h)] = h - 1
        if h % _PRUNE == 0 or h == depth:
            string, offset = _rows(shards, weave)
            told = common < h
            block = np.cumsum(told)
            many = np.bincount(block)[block] > 1
            live = np.zeros(len(sizes), bool)
            live[string[many & (offset + depth <= sizes[string])]] = True
            keep = live[string]
            if not keep.all():
                # of the rows dropped in between, the least prefix holds for the next row kept
                group = np.cumsum(keep) - keep
                least = np.full(int(keep.sum()) + 1, depth, np.int16)
                np.minimum.at(least, group, common)
                common, weave = least[:-1], weave[keep]
                shards = [Shard(s.string[k], s.offset[k], s.symbol[k]) for s in shards for k in [live[s.string]]]
                marks = [int((s.offset == sizes[s.string]).sum()) for s in shards]
                if not len(weave):
                    break
    return *_rows(shards, weave), common


def _rows(shards: list[Shard], weave: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    string, offset = np.empty(len(weave), np.int64), np.empty(len(weave), np.int64)
    for k, s in enumerate(shards):
        at = weave == k
        string[at], offset[at] = s.string, s.offset
    return string, offset


def repeated(texts: list[bytes], depth: int, shards: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(interval, string, offset) of every suffix that shares ``depth`` bytes with another one:
    the repeated intervals of the merged transform of the strings, dealt over ``shards``."""
    sizes = np.array([len(t) for t in texts], np.int64)
    parts = []
    for k in range(shards):
        own = np.arange(k, len(texts), shards)
        if len(own):
            flat = np.frombuffer(b"".join(texts[i] for i in own), np.uint8)
            parts.append(transform(flat, np.concatenate([[0], np.cumsum(sizes[own])]), own))
    string, offset, common = merge(parts, sizes, depth)
    interval = np.cumsum(common < depth)
    full = offset + depth <= sizes[string]
    string, offset, interval = string[full], offset[full], interval[full]
    if not len(interval):
        return interval, string, offset
    many = np.bincount(interval)[interval] > 1
    return interval[many], string[many], offset[many]
