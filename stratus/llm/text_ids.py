"""Token ids of whole Arrow batches of texts, as the tokenizers library gives them.

A byte-level tokenizer cuts a text before every run of white space that
follows another character, and after every run of ASCII letters that another
ASCII character follows, whatever stands on either side. So a text's ids are
those of its chunks, and chunks repeat. The places to cut are found on the
bytes of a batch at once, Arrow numbers the distinct chunks, and only chunks
that the worker has not met lately go to the library; the ids of others come
from a table in numpy arrays, which takes a fifth of the memory of a dict. Texts that hold an added
token, and all texts of other kinds of tokenizers, go to the library whole.
"""

from __future__ import annotations

import functools
import json
from array import array
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Places for chunks whose ids a Python worker keeps, each for a chunk of fewer
#: than KEY_BYTES bytes and at most KEPT_IDS ids: 33 bytes with ids of two bytes.
PLACES, KEY_BYTES, KEPT_IDS = 1 << 20, 16, 8
#: Places where a chunk can stand, one after another.
PROBES = 4
#: Other chunks whose ids a Python worker keeps (two generations of as many).
CACHED_CHUNKS = 50_000
#: Bytes of text that are cut at once.
WINDOW_BYTES = 2 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


class Kept:
    """Ids of short chunks by a key that holds the chunk's bytes and their number;
    where all of a chunk's places are taken, it replaces another one."""

    def __init__(self, dtype: np.dtype):
        self.keys = np.zeros((PLACES, 2), np.uint64)
        self.ids, self.sizes = np.zeros((PLACES, KEPT_IDS), dtype), np.zeros(PLACES, np.uint8)

    @staticmethod
    def keys_of(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(one key for each chunk, numbers of the chunks that are short enough for one)."""
        sizes, column = np.diff(offsets), np.arange(KEY_BYTES)
        padded = np.concatenate([values[:offsets[-1]], np.zeros(KEY_BYTES, np.uint8)])
        key = padded[offsets[:-1, None] + column]
        key[column >= sizes[:, None]] = 0
        key[:, -1] = np.minimum(sizes, 255)
        return key.view("<u8"), np.flatnonzero(sizes < KEY_BYTES)

    @staticmethod
    def _home(key: np.ndarray) -> np.ndarray:
        h = (key[:, 0] ^ (key[:, 1] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
        return ((h ^ (h >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(32)).astype(np.int64)

    def find(self, key: np.ndarray, short: np.ndarray) -> np.ndarray:
        """The place of each chunk, or -1."""
        found, todo, home = np.full(len(key), -1, np.int64), short, self._home(key)
        for r in range(PROBES):
            at = (home[todo] + r) % PLACES
            same = (self.keys[at] == key[todo]).all(axis=1)
            found[todo[same]] = at[same]
            todo = todo[~same]
        return found

    def put(self, key: np.ndarray, ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Chunk i has ids[start[i]:start[i] + size[i]], at most KEPT_IDS."""
        home = self._home(key)
        at = (home + (home >> 24) % PROBES) % PLACES
        for r in reversed(range(PROBES)):
            place = (home + r) % PLACES
            at = np.where(self.keys[place, 1] == 0, place, at)
        at, first = np.unique(at, return_index=True)  # of two for one place, one
        padded = np.concatenate([ids, np.zeros(KEPT_IDS, ids.dtype)])
        self.keys[at], self.sizes[at] = key[first], size[first]
        self.ids[at] = padded[start[first, None] + np.arange(KEPT_IDS)]


class TokenIds(dict):
    """Ids of chunks by chunk, of those that Kept does not hold; when it is full it
    becomes the older generation, from which chunks that are met again come back."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[str, bytes] = {}
        config = json.loads(spec)
        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype, self.code = (np.dtype("<u2"), "H") if self.vocabulary <= 1 << 16 else (np.dtype("<u4"), "I")
        self.kept = Kept(self.dtype)
        added, split = config.get("added_tokens", []), config.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in added]
        self.chunked = (config.get("normalizer") is None and split.get("type") == "ByteLevel"
                        and not split.get("add_prefix_space") and split.get("use_regex", True)
                        and config["model"].get("type") == "BPE" and not config["model"].get("dropout")
                        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added))
        if self.chunked:
            letters = [" ", *filter(str.isalpha, map(chr, range(256)))]
            self.mapped = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}
            self.blank, self.plain = self.mapped[0x20], all(self.mapped[ord(c)] == c for c in ascii_letters)

    def _ids(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _new(self, chunk: str) -> bytes:
        first = chunk[0]
        word = chunk[1:] if first in " \n" else chunk
        if not (word.isalpha() and (word.isascii() or max(word) <= "ÿ")):
            return self._whole(chunk)
        if first == "\n":  # the break is a piece of its own
            return self._whole("\n") + self[word]
        # one piece for the model
        if self.plain and word.isascii():
            piece = self.blank + word if first == " " else word
        else:
            piece = chunk.translate(self.mapped)
        return self._ids([t.id for t in self.model.tokenize(piece)])

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHED_CHUNKS:
            self.older = {}  # freed before the copy is made
            self.older = dict(self)
            self.clear()
        ids = self.older.get(chunk)
        if ids is None:
            ids = self._new(chunk)
        if len(chunk) <= 64 and (len(ids) > KEPT_IDS * self.dtype.itemsize or len(chunk.encode()) >= KEY_BYTES):
            self[chunk] = ids
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text's begin and end);
        a null has none."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = np.zeros(len(texts), dtype=bool) if self.chunked else np.ones(len(texts), dtype=bool)
        if self.chunked and len(texts):
            for t in self.added:
                odd |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._cut(texts)
        held = [np.frombuffer(self._whole(t), self.dtype) if own else None for t, own in zip(texts.to_pylist(), odd)]
        ids, offsets = self._cut(texts.filter(pa.array(~odd)))
        rest = iter(range(len(offsets) - 1))
        for i, own in enumerate(held):
            if own is None:
                j = next(rest)
                held[i] = ids[offsets[j]:offsets[j + 1]]
        return (np.concatenate([*held, np.zeros(0, self.dtype)]).astype(self.dtype),
                np.cumsum([0, *map(len, held)], dtype=np.int64))

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(1, np.int64)
        _, raw, values = texts.buffers()
        begin = np.frombuffer(raw, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(values, np.uint8)[begin[0]:begin[-1]] if values is not None else np.zeros(0, np.uint8)
        begin = begin - begin[0]
        out, where, found, low, width = [], np.zeros(len(begin), np.int64), 0, 0, WINDOW_BYTES
        while low < len(data):
            high = min(low + width, len(data))
            at = self._places(data, begin, low, high)
            if high < len(data):
                if len(at) < 2:  # one chunk longer than the window
                    width *= 2
                    continue
                high = low + int(at[-1])
            else:
                at = np.append(at, high - low)
            ids, ends = self._window(data[low:high], at.astype(np.int32))
            first, last = np.searchsorted(begin, [low, high])
            where[first:last] = found + ends[np.searchsorted(at, begin[first:last] - low)]
            found += len(ids)
            out.append(ids)
            low, width = high, WINDOW_BYTES
        where[np.searchsorted(begin, len(data)):] = found
        return np.concatenate(out) if out else np.zeros(0, self.dtype), where

    @staticmethod
    def _places(data: np.ndarray, begin: np.ndarray, low: int, high: int) -> np.ndarray:
        """Where chunks begin in data[low:high], from low on; low itself is such a place."""
        part = data[low:high]
        white, letter, ascii_ = _WHITE[part], _LETTER[part], part < 128
        cut = np.zeros(len(part), dtype=bool)
        before = ascii_[:-1] & ~white[:-1]
        before[1:] |= part[:-2] == 0xC3  # a letter from U+00C0 to U+00FF
        cut[1:] = (white[1:] & before) | (letter[:-1] & ascii_[1:] & ~letter[1:])
        first, last = np.searchsorted(begin, [low, high])
        cut[begin[first:last] - low] = True
        cut[0] = True
        return np.flatnonzero(cut)

    def _window(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the chunks that at bounds, how many stand before each bound)."""
        chunks = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)).dictionary_encode()
        words = chunks.dictionary
        _, raw, values = words.buffers()
        offsets = np.frombuffer(raw, np.int32)[words.offset:words.offset + len(words) + 1]
        key, short = self.kept.keys_of(np.frombuffer(values, np.uint8), offsets)
        place = self.kept.find(key, short)
        met, new = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        size, start = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        size[met] = self.kept.sizes[place[met]]
        known = self.kept.ids[place[met]][np.arange(KEPT_IDS) < size[met, None]]
        own = [self[c] for c in words.take(pa.array(new)).to_numpy(zero_copy_only=False)]
        size[new] = np.fromiter(map(len, own), np.int64, len(own)) // self.dtype.itemsize
        start[met], start[new] = np.cumsum(size[met]) - size[met], len(known) + np.cumsum(size[new]) - size[new]
        fresh = np.frombuffer(b"".join(own), self.dtype)
        fit = (np.diff(offsets)[new] < KEY_BYTES) & (size[new] <= KEPT_IDS)
        self.kept.put(key[new[fit]], fresh, (np.cumsum(size[new]) - size[new])[fit], size[new][fit])
        ids = np.concatenate([known, fresh])
        number = chunks.indices.to_numpy()
        n = size[number]
        ends = np.concatenate([[0], np.cumsum(n)])
        place = np.repeat(start[number] - ends[:-1], n) + np.arange(ends[-1])
        return ids[place], ends


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text's ids."""
    n = len(offsets) - 1
    end = offsets[1:] + np.arange(n)
    out, mine = np.empty(len(ids) + n, ids.dtype), np.ones(len(ids) + n, dtype=bool)
    mine[end] = False
    out[mine], out[end] = ids, end_id
    return out, offsets + np.arange(n + 1)


def binary_column(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value for each text's ids."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer((offsets * ids.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])


@functools.lru_cache(maxsize=2)
def token_ids(spec: str) -> TokenIds:
    """The worker's encoder; it outlives a task."""
    return TokenIds(spec)


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
