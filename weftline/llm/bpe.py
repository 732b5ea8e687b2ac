"""Byte-pair encoding by a rank queue over a hierarchical bitmap.

The pieces that the split pattern yields are encoded by merging the lowest-ranked pair of neighbours, again and again.
The queue of pairs has a bucket for each merge rank, which holds positions of a linked list of symbols, and a bitmap in
two levels that tells which buckets are in use: the lowest set bit gives the next rank. A position whose pair has
changed since it was queued is stale and is skipped. All new pieces of a batch of texts share one queue, as merges of
different pieces never meet; a merge costs the same however long a piece is.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import regex

#: White space as the vocabulary's split pattern means it (Unicode White_Space).
SPACE = "\t\n\x0b\x0c\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Fixed value: the split pattern published with the vocabulary, with white space spelled out; then the same for ASCII.
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
SPLIT_ASCII = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^{SPACE}A-Za-z0-9]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Cuts a text where the split pattern always cuts, whatever stands around: before a space with text after it and
#: around other white space. The encoding of such a chunk does not depend on its neighbours.
CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
WORD_BITS = 8
#: What is kept between batches: chunks and pieces up to so many characters, at most so many of each.
KEEP_CHARS, KEEP = 32, 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a line has a token in base64 and its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(i) for t, i in (line.split() for line in f if line.strip())}


def pair_table(ranks: dict[bytes, int]) -> np.ndarray:
    """The rank of each pair of bytes, -1 where the vocabulary doesn't have it."""
    table = np.full(65536, -1, np.int32)
    for token, r in ranks.items():
        if len(token) == 2:
            table[token[0] * 256 + token[1]] = r
    return table


def merge_pieces(pieces: list[bytes], ranks: dict[bytes, int], pair_ranks: np.ndarray) -> list[bytes]:
    """The ids of each piece (none empty) as int32 in a row, by one rank queue."""
    if not pieces:
        return []
    text = b"".join(pieces)
    n = len(text)
    nxt = list(range(1, n + 1))
    prv = list(range(-1, n - 1))
    edge = bytearray(n + 1)  # 1 where a piece begins
    at = 0
    for piece in pieces:
        edge[at] = 1
        prv[at] = -1
        at += len(piece)
    edge[n] = 1
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}
    top = 0
    mask = (1 << WORD_BITS) - 1
    find, bucket_of = ranks.get, buckets.get

    raw = np.frombuffer(text, np.uint8).astype(np.int32)
    first = np.full(n, -1, np.int32)
    first[:-1] = np.where(np.frombuffer(edge, np.uint8)[1:n] == 0, pair_ranks[raw[:-1] * 256 + raw[1:]], -1)
    rank_at = first.tolist()
    order = np.argsort(first, kind="stable")
    order = order[np.searchsorted(first[order], 0) :]
    used, starts = np.unique(first[order], return_index=True)
    bounds, order = [*starts.tolist(), len(order)], order.tolist()
    for b, r in enumerate(used.tolist()):
        buckets[r] = order[bounds[b] : bounds[b + 1]]
        w = r >> WORD_BITS
        words[w] = words.get(w, 0) | 1 << (r & mask)
        top |= 1 << w
    while top:
        w = (top & -top).bit_length() - 1
        bits = words[w]
        low = bits & -bits
        r = (w << WORD_BITS) + low.bit_length() - 1
        bits ^= low
        if bits:
            words[w] = bits
        else:
            del words[w]
            top ^= 1 << w
        queue = buckets.pop(r)
        if len(queue) > 1:
            queue.sort()
        for done, i in enumerate(queue, 1):
            if rank_at[i] != r:
                continue  # stale: one of its two symbols has been merged
            j = nxt[i]
            k = nxt[j]
            nxt[i] = k
            rank_at[j] = -1
            lowest = r
            if edge[k]:
                rank_at[i] = -1
            else:
                prv[k] = i
                x = rank_at[i] = find(text[i : nxt[k]])
                if x is not None:
                    if x < lowest:
                        lowest = x
                    bucket = bucket_of(x)
                    if bucket is None:
                        buckets[x] = [i]
                        w = x >> WORD_BITS
                        words[w] = words.get(w, 0) | 1 << (x & mask)
                        top |= 1 << w
                    else:
                        bucket.append(i)
            p = prv[i]
            if p >= 0:
                x = rank_at[p] = find(text[p:k])
                if x is not None:
                    if x < lowest:
                        lowest = x
                    bucket = bucket_of(x)
                    if bucket is None:
                        buckets[x] = [p]
                        w = x >> WORD_BITS
                        words[w] = words.get(w, 0) | 1 << (x & mask)
                        top |= 1 << w
                    else:
                        bucket.append(p)
            if lowest < r and done < len(queue):  # a lower rank has come up: the rest of this bucket waits
                buckets[r] = queue[done:] + buckets.get(r, [])
                w = r >> WORD_BITS
                words[w] = words.get(w, 0) | 1 << (r & mask)
                top |= 1 << w
                break
    out, at = [], 0
    for piece in pieces:
        ids, i, at = [], at, at + len(piece)
        while i < at:
            k = nxt[i]
            ids.append(ranks[text[i:k]])
            i = k
        out.append(array("i", ids).tobytes())
    return out


class Encoder:
    """Encodes texts; keeps the ids of short chunks and pieces that it has met, as int32 in a row."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pair_ranks = pair_table(ranks)
        self.split = regex.compile(SPLIT).findall
        self.split_ascii = re.compile(SPLIT_ASCII).findall
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def learn(self, chunks: set[str]) -> None:
        """Puts the ids of new chunks into self.chunks."""
        pieces, ranks = self.pieces, self.ranks
        parts = {c: self.split_ascii(c) if c.isascii() else self.split(c) for c in chunks}
        names, todo, long = [], [], []
        for piece in set(chain.from_iterable(parts.values())).difference(pieces):
            raw = piece.encode("utf-8", "replace")
            if len(piece) > KEEP_CHARS:
                long.append(piece)
            whole = ranks.get(raw)
            if whole is None:
                names.append(piece)
                todo.append(raw)
            else:
                pieces[piece] = array("i", (whole,)).tobytes()
        pieces.update(zip(names, merge_pieces(todo, ranks, self.pair_ranks)))
        get = pieces.__getitem__
        for c, p in parts.items():
            self.chunks[c] = get(p[0]) if len(p) == 1 else b"".join(map(get, p))
        for piece in long:
            del pieces[piece]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as int32 in a row; a null and an empty text have none."""
        cut = [CHUNK.findall(t) if t else () for t in texts]
        new = set(chain.from_iterable(cut)).difference(self.chunks)
        if new:
            self.learn(new)
        get = self.chunks.__getitem__
        out = [b"".join(map(get, chunks)) for chunks in cut]
        for c in new:
            if len(c) > KEEP_CHARS:
                del self.chunks[c]
        if len(self.chunks) > KEEP:
            self.chunks.clear()
        if len(self.pieces) > KEEP:
            self.pieces.clear()
        return out

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], np.int32).tolist()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, one for each Python worker."""
    return Encoder(read_ranks(path))
