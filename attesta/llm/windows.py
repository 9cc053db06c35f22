"""Exact repeated windows of a tokenised corpus, without a row for every position.

Every window of W tokens owns one anchor: the k-gram of smallest hash inside it (leftmost of equals). Equal windows
have equal anchors at equal offsets, so windows need only be compared with windows of the same anchor k-gram.
Consecutive windows with one anchor position form a stretch; a stretch travels as (gram, content, doc, start, count,
offset), a few bytes for about (W-k)/2 windows.

1. ``stretches`` reads whole texts, makes stretches, and settles copies that meet in one batch before any exchange,
   so that thousands of copies of a passage leave a task as one row.
2. ``settle`` gets all stretches of a gram. Equal contents are settled by hash; a gram with several different contents
   is contested, and only those stretches are compared token by token (``contest``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from attesta.llm.common import BYTE_HASH, U64, mix, pack, powers, runs, unpack

CHUNK = 1 << 18  # tokens handled at once; bounds memory for texts of any length
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
KINDS = (np.uint64, np.uint64, np.int64, np.int64, np.int32, np.int32)  # gram, content, doc, start, count, offset


def _grams(tok: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k tokens at each position, by doubling."""
    have, width, out, done, step = tok, 1, None, 0, U64(0xC2B2AE3D27D4EB4F)
    power = int(step)
    with np.errstate(over="ignore"):
        while True:
            if k & width:
                piece = have[done:]
                out = piece if out is None else out[: len(piece)] * U64(power) + piece[: len(out)]
                done += width
            if 2 * width > k:
                break
            have = have[:-width] * U64(power) + have[width:] if len(have) > width else have[:0]
            power, width = (power * power) & ((1 << 64) - 1), 2 * width
    return mix(out[: max(0, len(tok) - k + 1)])


def _least(key: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w consecutive keys."""
    have, width = key, 1
    while 2 * width <= w:
        have, width = np.minimum(have[:-width], have[width:]), 2 * width
    return have if width == w else np.minimum(have[: len(have) - (w - width)], have[w - width :])


def _chunk(tok: np.ndarray, edge: np.ndarray, w: int, k: int):
    """Stretches in tok, whose documents begin at edge[:-1]: gram, content, start in tok, windows, anchor's offset."""
    n = len(tok) - w + 1
    if n <= 0:
        return None
    raw = tok
    if tok.dtype == np.uint8:
        tok = BYTE_HASH[raw]
    gram = _grams(tok, k)
    at = np.arange(len(gram), dtype=U64)
    low = U64((1 << 20) - 1)
    anchor = (_least((gram & ~low) | at, w - k + 1) & low).astype(np.int64)[:n]
    fits = np.zeros(n + 1, np.int8)
    lo, hi = edge[:-1], edge[1:] - w + 1
    ok = hi > lo
    np.add.at(fits, lo[ok], 1)
    np.add.at(fits, hi[ok], -1)
    fits = np.cumsum(fits[:n]) > 0
    new = fits.copy()
    new[1:] &= ~fits[:-1] | (anchor[1:] != anchor[:-1])
    start = np.flatnonzero(new)
    if not len(start):
        return None
    stop = np.zeros(n + 1, bool)
    stop[:n] = new | ~fits
    stop[n] = True
    stops = np.flatnonzero(stop)
    count = stops[np.searchsorted(stops, start, "right")] - start
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(tok * powers(BASE, len(tok)))])
        content = (sums[start + count + w - 1] - sums[start]) * powers(BASE_INVERSE, len(tok))[start]
        offset = anchor[start] - start
        content = mix(content + mix(offset.astype(U64) * U64(1 << 32) + count.astype(U64)))
    # the leading tokens come first in the key, so that keys sort and range-partition as suffixes do
    at = anchor[start]
    lead = sum(raw[at + j].astype(U64) << U64(24 - 8 * j) for j in range(4)) if raw.dtype == np.uint8 else tok[at] >> U64(32)
    return (lead << U64(32)) | (gram[at] >> U64(32)), content, start, count.astype(np.int32), offset.astype(np.int32)


def stretches(docs: Iterator[tuple[int, np.ndarray]], w: int, k: int):
    """All stretches of (doc_id, tokens) pairs as six columns."""
    parts: list[tuple] = []
    held, ids, firsts, size = [], [], [], 0

    def flush():
        nonlocal held, ids, firsts, size
        if held:
            edge = np.concatenate([[0], np.cumsum([len(t) for t in held])])
            got = _chunk(np.concatenate(held), edge, w, k)
            if got:
                gram, content, start, count, offset = got
                d = np.searchsorted(edge, start, "right") - 1
                parts.append((gram, content, np.asarray(ids, np.int64)[d], start - edge[d] + np.asarray(firsts, np.int64)[d], count, offset))
        held, ids, firsts, size = [], [], [], 0

    for doc, tok in docs:
        for first in range(0, max(1, len(tok) - w + 1), CHUNK - w):
            piece = tok[first : first + CHUNK - 1]
            if len(piece) >= w:
                if size + len(piece) > CHUNK:
                    flush()
                held.append(piece)
                ids.append(doc)
                firsts.append(first)
                size += len(piece)
    flush()
    if not parts:
        return tuple(np.empty(0, kind) for kind in KINDS)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def settle(cols, same_doc: bool):
    """Sorts stretches by gram, content, document and start and splits them: (kept columns in that order, intervals
    of windows that a copy precedes). same_doc: a copy earlier in the same document precedes too."""
    gram, content, doc, start, count, offset = cols
    o = np.lexsort((start, doc, content, gram))
    gram, content, doc, start, count, offset = (c[o] for c in (gram, content, doc, start, count, offset))
    if not len(gram):
        return (gram, content, doc, start, count, offset), (doc, start, count.astype(np.int64))
    head = np.concatenate([[True], (gram[1:] != gram[:-1]) | (content[1:] != content[:-1])])
    first = np.maximum.accumulate(np.where(head, np.arange(len(gram)), 0))
    gone = (doc != doc[first]) | ((start != start[first]) & same_doc)
    again = np.concatenate([[False], ~head[1:] & (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])])
    keep = ~gone & ~again
    return tuple(c[keep] for c in (gram, content, doc, start, count, offset)), runs(doc[gone], start[gone], count[gone].astype(np.int64))


def several(gram: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Of sorted stretches, a mask of those whose gram has several contents."""
    if not len(gram):
        return np.empty(0, bool)
    part = np.cumsum(np.concatenate([[0], gram[1:] != gram[:-1]]))
    out = np.zeros(int(part[-1]) + 1, bool)
    out[part[1:][(gram[1:] == gram[:-1]) & (content[1:] != content[:-1])]] = True
    return out[part]


def merge_join(run, fresh) -> tuple[np.ndarray, np.ndarray]:
    """Masks over fresh stretches: those whose content a run holds, and those of which it holds the gram. Both sides are
    sorted by gram and content; one pass finds the slice of each gram, and a bisection inside all slices the content."""
    gram, content = run[0], run[1]
    low, end = np.searchsorted(gram, fresh[0], "left"), np.searchsorted(gram, fresh[0], "right")
    near, high = end > low, end.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        middle = (low[open_] + high[open_]) >> 1
        less = content[middle] < fresh[1][open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
    same = np.zeros(len(near), bool)
    inside = np.flatnonzero(low < end)
    same[inside] = content[low[inside]] == fresh[1][inside]
    return same, near


def compacted(parts: list[tuple]) -> tuple:
    """One sorted run of several. No two hold one content, so nothing is lost or joined."""
    cols = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    o = np.lexsort((cols[1], cols[0]))  # a merge sort, so runs that are in order already are only merged
    return tuple(c[o] for c in cols)


def multikey(keys: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Multikey quicksort of rows of 64-bit words inside groups, as classes of equal rows: word by word, only rows
    still tied are partitioned further, and groups found equal to their head over the whole rest leave at once."""
    n, width = keys.shape
    final = np.arange(n)
    idx = np.argsort(group, kind="stable")
    grp = group[idx]
    for level in range(width + 1):
        if not len(idx):
            break
        head = np.concatenate([[True], grp[1:] != grp[:-1]])
        at = np.maximum.accumulate(np.where(head, np.arange(len(idx)), 0))
        same = (keys[idx, level:] == keys[idx[at], level:]).all(axis=1) if level < width else np.ones(len(idx), bool)
        part = np.cumsum(head) - 1
        whole = np.ones(part[-1] + 1, bool)
        whole[part[~same]] = False
        done = whole[part]
        final[idx[done]] = idx[at[done]]
        idx, grp = idx[~done], part[~done]
        if len(idx):
            o = np.lexsort((keys[idx, level], grp))
            idx, grp = idx[o], grp[o]
            word = keys[idx, level]
            grp = np.cumsum(np.concatenate([[0], (grp[1:] != grp[:-1]) | (word[1:] != word[:-1])]))
    return final


def contest(gram, doc, start, count, offset, text: list[np.ndarray], w: int, same_doc: bool, new: np.ndarray, limit: int = 1 << 15):
    """Compares contested stretches window by window. text: the tokens of each; bytes, or 64-bit words.
    Returns intervals of windows that an equal one precedes."""
    found = []
    o = np.argsort(gram, kind="stable")
    sizes = count[o].astype(np.int64)
    g = gram[o]
    last = np.flatnonzero(np.concatenate([g[1:] != g[:-1], [True]])) + 1
    lo = 0
    while lo < len(o):
        total = np.cumsum(sizes[lo:])
        fits = last[(last > lo) & (last <= lo + np.searchsorted(total, limit, "right"))]
        hi = int(fits[-1]) if len(fits) else int(last[last > lo][0])
        part = o[lo:hi]
        spread = int(offset[part].max()) + 1
        step = max(1, spread * limit // max(1, int(count[part].sum())))
        for a in range(0, spread, step):  # a very common gram is taken a few offsets at a time
            found.append(_contest(part, gram, doc, start, count, offset, text, w, same_doc, new, a, a + step))
        lo = hi
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return runs(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _contest(part, gram, doc, start, count, offset, text, w, same_doc, new, low, high):
    width = w if text[part[0]].dtype == np.uint64 else -(-w // 8)
    rows, owner, begin = [], [], []
    for i in part:
        # the window that starts j later has its anchor at offset - j
        a, b = max(0, int(offset[i]) - high + 1), min(int(count[i]), int(offset[i]) - low + 1)
        if a < b:
            view = np.lib.stride_tricks.sliding_window_view(text[i], w)[a:b]
            rows.append(view)
            owner.append(np.full(b - a, i))
            begin.append(np.arange(a, b))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    keys = np.concatenate(rows)
    if keys.dtype == np.uint8:
        wide = np.zeros((len(keys), 8 * width), np.uint8)
        wide[:, :w] = keys
        keys = wide.view(">u8").astype(np.uint64)
    owner, begin = np.concatenate(owner), np.concatenate(begin)
    group = mix(gram[owner] + (offset[owner] - begin).astype(U64))
    final = multikey(keys, np.unique(group, return_inverse=True)[1])
    d, s = doc[owner], start[owner] + begin
    o = np.lexsort((s, d, final))
    f, d, s, fresh = final[o], d[o], s[o], new[owner[o]]
    head = np.concatenate([[True], f[1:] != f[:-1]])
    first = np.maximum.accumulate(np.where(head, np.arange(len(f)), 0))
    gone = fresh & ((d != d[first]) | ((s != s[first]) & same_doc))
    return runs(d[gone], s[gone], np.ones(int(gone.sum()), np.int64))


def packed(cols) -> bytes:
    return pack(*(np.asarray(c, kind) for c, kind in zip(cols, KINDS, strict=True)))


def unpacked(blobs: list[bytes]):
    parts = [unpack(b, *KINDS) for b in blobs]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else tuple(np.empty(0, kind) for kind in KINDS)
