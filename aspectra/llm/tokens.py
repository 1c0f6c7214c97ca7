"""Token ids of whole texts with a public tokenizer file, many texts at a time.

The vocabulary's pre-tokeniser drops blanks and line ends, joins nothing across them, ignores
case, and keeps letters apart from marks; so a text's ids are its words' ids in order. A batch
of texts is cut into words and reduced to its distinct words by Arrow, only those not met
before are given to the tokenizer, and the ids of the texts are gathered from one flat array.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a worker remembers between batches.
CACHE_WORDS = 400_000
#: UTF-8 bytes of text that are encoded together (one text may be longer).
BATCH_BYTES = 8 << 20
#: ASCII marks that may close a word; the pre-tokeniser never joins them to letters.
CLOSING = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices flat[start:start + size], one after the other."""
    if not len(size):
        return flat[:0]
    ends = np.cumsum(size)
    kind = np.int32 if max(len(flat), ends[-1]) < 1 << 31 else np.int64
    at = np.repeat((start - (ends - size)).astype(kind), size)
    at += np.arange(ends[-1], dtype=kind)
    return flat[at]


class Encoder:
    """Equal to `Tokenizer.encode(text, add_special_tokens=False).ids` for every text."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # for lower-case ASCII letters normalising and splitting at marks change nothing: only the merges are left
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.mark = "<|endoftext|>"
        self.stop = vocabulary.get(self.mark, -1)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a run of letters or of marks
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.cache_words = cache_words
        # the words met, and for each the slice flat[start:start + size]
        self.known = pa.array([""], pa.large_string())
        self.start, self.size = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where each word stands in `known`; -1 for the others."""
        return pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy().astype(np.int64)

    def _add(self, words: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, words])
        self.start = np.append(self.start, len(self.flat) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.flat = np.append(self.flat, ids)

    def _by_closing(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.flatnonzero(self.closes[ids]) + 1
        return np.append(0, ends[:-1])[:len(ends)], ends

    def _by_mark(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(ids == self.stop)
        return np.append(0, at + 1), np.append(at, len(ids))

    def _together(self, tokenizer, parts: list[str], glue: str, cuts, place: dict[str, int]) -> list[str]:
        """Encode many words in one call; `cuts(ids)` gives where each begins and ends. The words of
        a call in which they do not come out as one stretch a word are given back."""
        found, left = [], []
        for at in range(0, len(parts), 2000):
            some = parts[at:at + 2000]
            ids = np.array(tokenizer.encode_batch_fast([glue.join(some)], add_special_tokens=False)[0].ids, np.uint32)
            begin, end = cuts(ids)
            if len(begin) == len(some):
                found.append((some, gather(ids, begin, end - begin), end - begin))
            else:
                left += some
        if found:
            words = [p for f in found for p in f[0]]
            place.update(zip(words, range(len(self.size), len(self.size) + len(words))))
            self._add(pa.array(words, pa.large_string()), np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found]))
        return left

    def _learn_parts(self, parts: list[str], letters: list[bool]) -> np.ndarray:
        """Encode the words; their places."""
        place: dict[str, int] = {}
        # every run of letters gives one closing id at least, so equal counts mean one each
        left = self._together(self.bare, [p for p, a in zip(parts, letters) if a and p.isascii()], " ", self._by_closing, place)
        left += self._together(self.tokenizer, [p for p, a in zip(parts, letters) if a and not p.isascii()], " ", self._by_closing, place)
        left += [p for p, a in zip(parts, letters) if not a]
        if self.stop >= 0:
            safe = [p for p in left if self.mark[:2] not in p]
            left = [p for p in left if self.mark[:2] in p] + self._together(self.tokenizer, safe, f" {self.mark} ", self._by_mark, place)
        for p in left:
            ids = np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, np.uint32)
            place[p] = len(self.size)
            self._add(pa.array([p], pa.large_string()), ids, np.array([len(ids)], np.int64))
        return np.array([place[p] for p in parts], np.int64)

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Places for words not met before: letters without their closing marks are encoded
        once, in lower case, and joined with the ids of the marks."""
        core = pc.utf8_rtrim(words, characters=CLOSING)
        letters = pc.utf8_is_alpha(core)
        core = pc.if_else(letters, pc.if_else(pc.string_is_ascii(core), pc.ascii_lower(core), core), words)
        ends = np.cumsum(pc.binary_length(words).to_numpy())
        tail = ends - np.append(0, ends[:-1]) - pc.binary_length(core).to_numpy()
        text = np.frombuffer(words.buffers()[2] or b"", np.uint8)  # a fresh array: its bytes begin with the first word's
        tails = pa.LargeStringArray.from_buffers(
            len(words), pa.py_buffer(np.append(0, np.cumsum(tail)).astype(np.int64)),
            pa.py_buffer(np.ascontiguousarray(gather(text, ends - tail, tail))))
        both = pa.concat_arrays([core, tails]).dictionary_encode()
        place = self._places(both.dictionary)
        unmet = np.flatnonzero(place < 0)
        if len(unmet):
            parts = both.dictionary.take(pa.array(unmet))
            place[unmet] = self._learn_parts(parts.to_pylist(), pc.utf8_is_alpha(parts).to_pylist())
        pairs = place[np.asarray(both.indices)].reshape(2, -1).T
        out = pairs[:, 0].copy()
        other = np.flatnonzero((tail > 0) | pc.not_equal(core, words).to_numpy(zero_copy_only=False))
        if len(other):
            pairs = pairs[other]
            ids = gather(self.flat, self.start[pairs].ravel(), self.size[pairs].ravel())
            out[other] = np.arange(len(self.size), len(self.size) + len(other))
            self._add(words.take(pa.array(other)), ids, self.size[pairs].sum(axis=1))
        return out

    def _stretch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        bounds = np.asarray(words.offsets).astype(np.int64)
        coded = words.flatten().dictionary_encode()
        place = self._places(coded.dictionary)
        unmet = np.flatnonzero(place < 0)
        if len(unmet):
            place[unmet] = self._learn(coded.dictionary.take(pa.array(unmet)))
        place = place[np.asarray(coded.indices)]
        size = self.size[place]
        ids = gather(self.flat, self.start[place], size)
        ends = np.append(0, np.cumsum(size))[bounds - bounds[0]]
        keep = self.cache_words
        if len(self.known) > keep:  # the words that came first are the most frequent and stay
            self.known, self.size = self.known.slice(0, keep), self.size[:keep]
            self.start, self.flat = self.start[:keep], self.flat[:self.start[keep]]
        return ids, np.diff(ends)

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, ids, how many ids each text has) for stretches of the texts; a null text is empty."""
        before = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(before, before[at] + BATCH_BYTES, side="right")) - 1)
            ids, size = self._stretch(pc.fill_null(texts.slice(at, end - at).cast(pa.large_string()), ""))
            pa.default_memory_pool().release_unused()
            yield at, ids, size
            at = end


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder, with its bounded memory of words, serves all tasks of a worker."""
    return Encoder(path)


def closed(ids: np.ndarray, size: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids with `end_id` behind each text's, as little-endian uint32; each text's first place and size."""
    ends = np.cumsum(size + 1)
    out = np.full(len(ids) + len(size), end_id, "<u4")
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = ids
    return out, ends - size - 1, size + 1


def checksums(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[int]:
    """crc32 of the bytes of each slice ids[start:start + size]."""
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    return [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(start.tolist(), size.tolist(), strict=True)]
