"""Byte-level BPE by the batch: pre-tokens found with array operations and looked up in a bounded memo.

The pattern is the public one of byte-level BPE (PATTERN). Its matches are
determined by each character's class (letter, number, white space, other) and
its neighbours', so a batch's token starts come from comparisons of whole
arrays. A pre-token is looked up by a 64-bit hash of its bytes and compared with
the text found there; what the memo doesn't hold yet is worked out once, by the
tokenizers library or by rank-synchronous merging.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache
from hashlib import blake2b

import numpy as np

#: Fixed value: the pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
MULTIPLIER = 0x9E3779B97F4A7C15
CHUNK = 1 << 20
MEMO = 3 << 18
LINES = 4096
#: Bytes of a span up to which it is hashed and compared by array operations.
LONG = 1024
MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


@lru_cache(4)
def character_classes(path: str) -> list[tuple[int, int, int]]:
    """(first, beyond last, class) of the code points that aren't OTHER, as the file's own pre-tokenizer has them.

    Unicode versions differ between libraries, so the pre-tokenizer is asked
    itself: a character is of a class if it merges with two of that class.
    """
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    kinds = np.full(0x110000, SPACE, np.uint8)
    kinds[0xD800:0xE000] = OTHER
    for block in range(0, 0x110000, 1 << 14):
        left = np.array([i for i in range(block, block + (1 << 14)) if not 0xD800 <= i < 0xE000])
        for mate, kind in (("!", OTHER), ("a", LETTER), ("1", NUMBER)):
            if not len(left):
                break
            spans = [x[1] for x in cut("".join(f"\n{mate}{chr(i)}{mate}" for i in left))]
            whole = np.array([a // 4 for a, b in spans if b - a == 3 and a % 4 == 1], np.int64)
            kinds[left[whole]] = kind
            left = np.delete(left, whole)
    edge = np.append(np.flatnonzero(np.diff(kinds, prepend=255)), 0x110000)
    return [(int(a), int(b), int(kinds[a])) for a, b in zip(edge[:-1], edge[1:], strict=True) if kinds[a] != OTHER]


def token_starts(code: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which characters start a pre-token. ``first`` marks characters that start a text."""
    n = len(code)
    space = kind == SPACE
    blank = code == 0x20
    before = np.empty(n, np.uint8)
    before[0], before[1:] = OTHER, kind[:-1]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~first
    last = np.ones(n, bool)
    last[:-1] = first[1:]
    run = first | (kind != before)
    next_solid = np.zeros(n, bool)
    next_solid[:-1] = ~space[1:]
    next_solid &= ~last
    start = np.where(space, run | next_solid, run & ~after_blank)
    quotes = np.flatnonzero((code == 0x27) & start)
    if len(quotes):
        end = np.append(np.flatnonzero(first), n)
        end = end[np.searchsorted(end, quotes, "right")]
        ahead = lambda k: np.where(quotes + k < end, code[np.minimum(quotes + k, n - 1)], 0)
        one, two = ahead(1), ahead(2)
        short = np.isin(one, [ord(x) for x in "stmd"])
        long = ~short & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        for some, length in ((short, 2), (long, 3)):
            at = quotes[some]
            start[at + 1] = False
            rest = (at + length)[at + length < end[some]]
            start[rest] = True
    return start


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _octets(data: np.ndarray) -> np.ndarray:
    """The 8 bytes that start at each byte, as one number; bytes beyond the end are 0."""
    padded = np.append(data, np.zeros(8, np.uint8))
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def _rounds(start: np.ndarray, end: np.ndarray):
    """(spans, position, mask) of the spans' 8-byte pieces, one piece a round; spans over LONG bytes are left out."""
    live = np.flatnonzero(end - start <= LONG)
    at, left = start[live], (end - start)[live]
    while len(live):
        yield live, at, MASKS[np.minimum(left, 8)]
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes data[start:end] for many spans at once.

    A hash runs through a span's 8-byte pieces by bijections, so spans of up to
    8 bytes never collide with others of their length, and no algebra of the
    letters makes longer ones collide. Spans over LONG bytes take a digest.
    """
    octets = _octets(data)
    out = mixed((end - start).astype(np.uint64) + np.uint64(MULTIPLIER))
    for live, at, mask in _rounds(start, end):
        out[live] = mixed((out[live] ^ (octets[at] & mask)) + np.uint64(MULTIPLIER))
    for i in np.flatnonzero(end - start > LONG):
        out[i] = int.from_bytes(blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def same_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, start2: np.ndarray, end2: np.ndarray) -> np.ndarray:
    """Whether data[start:end] and data[start2:end2] are the same bytes, for many pairs at once."""
    octets = _octets(data)
    out = end - start == end2 - start2
    offset = start2 - start
    for live, at, mask in _rounds(start, np.where(out, end, start)):
        out[live] &= (octets[at] & mask) == (octets[at + offset[live]] & mask)
    for i in np.flatnonzero(out & (end - start > LONG)):
        out[i] = np.array_equal(data[start[i] : end[i]], data[start2[i] : end2[i]])
    return out


class Splitter:
    """Finds the pre-tokens of many texts; texts that hold a special token are left to ``whole``."""

    def __init__(self, classes: list[tuple[int, int, int]]):
        self.classes = np.zeros(0x110000, np.uint8)
        for a, b, kind in classes:
            self.classes[a:b] = kind

    def split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All texts as the bytes of one string; starts and ends of its pre-tokens; number of pre-tokens by text."""
        joined = "".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(x) for x in texts])
        if not len(code):
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint8), none, none, np.zeros(len(texts), np.int64)
        first = np.zeros(len(code), bool)
        begins = np.append(0, ends[:-1])
        first[begins[begins < len(code)]] = True
        start = np.flatnonzero(token_starts(code, self.classes[code], first))
        end = np.append(start[1:], len(code))
        counts = np.diff(np.searchsorted(start, np.append(0, ends)))
        data = np.frombuffer(joined.encode(), np.uint8)
        if len(data) > len(code):
            place = np.append(0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)))
            start, end = place[start], place[end]
        return data, start, end, counts


class Memo:
    """Pre-token -> its ids (or only their number), for up to MEMO pre-tokens; emptied when full.

    Found by hash and compared by text, so that colliding hashes only cost time.
    """

    def __init__(self, solve: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = MEMO):
        self.solve, self.most = solve, most
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.texts = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        self.counts, self.begin, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _solved(self, texts: list[bytes]) -> np.ndarray:
        """New slots with the answers for these texts."""
        counts, ids = self.solve([x.decode() for x in texts])
        slot = len(self.counts) + np.arange(len(texts))
        self.begin = np.append(self.begin, len(self.ids) + np.cumsum(counts) - counts)
        self.counts, self.ids = np.append(self.counts, counts), np.append(self.ids, ids)
        self.texts += texts
        return slot

    def look_up(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The memo's slot of each span of the bytes."""
        unique, where, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.counts) + len(unique) > self.most:
            self.clear()
        text = data.tobytes()
        spans = [text[a:b] for a, b in zip(start[where].tolist(), end[where].tolist(), strict=True)]
        place = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == unique[inside]
        slot = np.empty(len(unique), np.int64)
        slot[known] = self.at[place[known]]
        other = [i for i in np.flatnonzero(known).tolist() if self.texts[slot[i]] != spans[i]]
        new = np.flatnonzero(~known)
        if len(new):
            slot[new] = self._solved([spans[i] for i in new.tolist()])
            self.keys, self.at = np.insert(self.keys, place[new], unique[new]), np.insert(self.at, place[new], slot[new])
        if other:
            slot[other] = self._solved([spans[i] for i in other])
        found = slot[back]
        differ = np.flatnonzero(~same_spans(data, start, end, start[where][back], end[where][back]))
        if len(differ):
            found[differ] = self._solved([text[a:b] for a, b in zip(start[differ].tolist(), end[differ].tolist(), strict=True)])
        return found


class Merges:
    """The merge table of a byte-level BPE file, for rank-synchronous merging."""

    NEVER = np.int64(1) << 40

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = [x["content"] for x in spec["added_tokens"]]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(plain))}
        self.of_byte = np.array([vocabulary[letters[b]] for b in range(256)], np.int64)
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self.pairs = (left << 20) | right
        order = np.argsort(self.pairs, kind="stable")
        self.pairs = self.pairs[order]
        self.ranks = order
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)

    def _rank(self, symbols: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each symbol."""
        key = np.empty(len(symbols), np.int64)
        key[:-1], key[-1:] = (symbols[:-1] << 20) | symbols[1:], -1
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], self.NEVER)

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that survive in each pre-token; no ids.

        The batch is one ragged array. In each step every sequence merges all
        places of its own lowest-rank pair at once (of overlapping places every
        second one, from the left); finished sequences leave the batch.
        """
        raw = [x.encode() for x in texts]
        lengths = np.array([len(x) for x in raw], np.int64)
        counts = lengths.copy()
        live = np.flatnonzero(lengths > 1)
        symbols = self.of_byte[np.frombuffer(b"".join(x for x in raw if len(x) > 1), np.uint8)]
        lengths = lengths[live]
        while len(live):
            start = np.cumsum(lengths) - lengths
            rank = self._rank(symbols)
            rank[start + lengths - 1] = self.NEVER
            least = np.minimum.reduceat(rank, start)
            going = least < self.NEVER
            if not going.all():
                counts[live[~going]] = lengths[~going]
                keep = np.repeat(going, lengths)
                symbols, rank = symbols[keep], rank[keep]
                live, lengths, least = live[going], lengths[going], least[going]
                if not len(live):
                    break
            hit = rank == np.repeat(least, lengths)
            place = np.flatnonzero(hit)
            chained = np.append(False, place[1:] == place[:-1] + 1)
            if chained.any():
                begin = np.maximum.accumulate(np.where(chained, 0, np.arange(len(place))))
                place = place[(np.arange(len(place)) - begin) % 2 == 0]
            symbols[place] = self.made[rank[place]]
            stay = np.ones(len(symbols), bool)
            stay[place + 1] = False
            start = np.cumsum(lengths) - lengths
            lengths = np.add.reduceat(stay, start, dtype=np.int64)
            symbols = symbols[stay]
        return counts, np.zeros(0, np.uint32)


class Encoder:
    """Ids or counts of whole texts as the tokenizers library gives them for a byte-level BPE file."""

    def __init__(self, path: str, classes: list[tuple[int, int, int]], ids: bool):
        from tokenizers import Tokenizer

        self.splitter, self.library = Splitter(classes), Tokenizer.from_file(path)
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.memo = Memo(self._library_ids if ids else Merges(path).count)
        self.want_ids = ids

    def _library_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pre-tokens. Those without white space go as lines of one text: a line's end is a pre-token of its own."""
        counts, found = np.zeros(len(texts), np.int64), [None] * len(texts)
        blank = [i for i, t in enumerate(texts) if t.isspace() or "\n" in t]
        lines = np.setdiff1d(np.arange(len(texts)), np.array(blank, np.int64))
        for i, x in zip(blank, self.library.encode_batch_fast([texts[i] for i in blank], add_special_tokens=False), strict=True):
            found[i] = np.array(x.ids, np.uint32)
        end = self.library.encode("\n", add_special_tokens=False).ids
        for some in np.array_split(lines, max(1, len(lines) // LINES)) if len(lines) else []:
            ids = np.array(self.library.encode_batch_fast(["\n".join([texts[i] for i in some])], add_special_tokens=False)[0].ids, np.uint32)
            cut = np.flatnonzero(ids == end[0])
            if len(end) != 1 or len(cut) != len(some) - 1:
                raise ValueError("a line's end isn't a token of its own in this vocabulary")
            for i, a, b in zip(some.tolist(), np.append(0, cut + 1).tolist(), np.append(cut, len(ids)).tolist(), strict=True):
                found[i] = ids[a:b]
        counts[:] = [len(x) for x in found]
        return counts, np.concatenate(found) if found else np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids by text, all ids in a row or none if only counts are wanted)."""
        if len(self.special) > 1 and any(s in t for t in texts for s in self.special):
            found = [np.array(x.ids, np.uint32) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([len(x) for x in found], np.int64), np.concatenate(found) if self.want_ids else np.zeros(0, np.uint32)
        parts = self._sections(texts)
        flat = [t for section in parts for t in section if t is not None]
        data, start, end, per = self.splitter.split(flat)
        slot = self.memo.look_up(data, start, end, span_hashes(data, start, end)) if len(start) else np.zeros(0, np.int64)
        each = self.memo.counts[slot] if len(slot) else np.zeros(0, np.int64)
        running = np.append(0, np.cumsum(each))
        bounds = np.append(0, np.cumsum(per))
        by_section = running[bounds[1:]] - running[bounds[:-1]]
        plain = len(flat) == len(texts) and all(len(s) == 1 for s in parts)
        if self.want_ids:
            total = int(running[-1])
            at = np.repeat(self.memo.begin[slot] - running[:-1], each) + np.arange(total) if total else np.zeros(0, np.int64)
            ids = self.memo.ids[at]
        else:
            ids = np.zeros(0, np.uint32)
        if plain:
            return by_section, ids
        return self._with_special(parts, by_section, ids)

    def _sections(self, texts: list[str]) -> list[list]:
        """Texts cut at special tokens, which stand as None between the sections."""
        if not any(s in t for t in texts for s in self.special):
            return [[t] for t in texts]
        out = []
        for t in texts:
            pieces = t.split(self.special[0])
            out.append([x for p in pieces for x in (p, None)][:-1])
        return out

    def _with_special(self, parts: list[list], by_section: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = self.library.token_to_id(self.special[0])
        counts, pieces, i, at = [], [], 0, 0
        for section in parts:
            n = 0
            for piece in section:
                if piece is None:
                    n += 1
                    pieces.append(np.array([mark], np.uint32))
                    continue
                m, i = int(by_section[i]), i + 1
                if self.want_ids:
                    pieces.append(ids[at : at + m])
                n, at = n + m, at + m
            counts.append(n)
        return np.array(counts, np.int64), np.concatenate(pieces) if self.want_ids and pieces else np.zeros(0, np.uint32)


def text_groups(texts: list[str], most: int = CHUNK):
    """(first, beyond last) of runs of texts with about ``most`` characters; a longer text is a run of its own."""
    a = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder_of(path: str, classes: list[tuple[int, int, int]], ids: bool) -> Encoder:
    """This worker's encoder of a file; its bounded memo serves all tasks that the worker runs."""
    if (path, ids) not in _encoders:
        _encoders[path, ids] = Encoder(path, classes, ids)
    return _encoders[path, ids]
