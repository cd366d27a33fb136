"""Token ids of whole texts by a byte-level tokenizer, word segment by word segment.

Byte-level pre-tokenisation starts a new piece at every single space between two
non-space characters, at a line feed between two such and between a word and the punctuation
behind it, so a text may be cut there and equal parts need encoding once. Texts repeat most
of their words, which saves most of the encoder's work. Ids travel as binary values of Arrow
arrays, so those of a text are put on end by one ``take``. Ids are the same as for the whole
text (tests/llm/test_packing.py).
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from tokenizers import Tokenizer

from .common import strings

TOKENIZER_FILE = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Words that a worker remembers between batches, and as many kinds of punctuation behind words.
REMEMBERED = 200_000
# A space beside other white space: there a cut could change the ids.
_BESIDE_SPACE = r" [\t-\r\x1c-\x20\x85\p{Z}]|[\t-\r\x1c-\x1f\x85\p{Z}] "
# The same for line feeds.
_BESIDE_FEED = r"\n[\t-\r\x1c-\x20\x85\p{Z}]|[\t-\r\x1c-\x20\x85\p{Z}]\n"
_CUT = re.compile(r"(?<=\S) (?=\S)")

# What begins one piece of the pre-tokenisation after another, the first one with its space or line feed.
_INK = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
_WORD = rf"^\n?{_INK}([^ \n]*{_INK})?$"
# Between a letter or digit and punctuation behind it a piece of the pre-tokenisation always ends.
_PUNCTUATION = string.punctuation
_WORD_END = "[0-9A-Za-zÀ-ÖØ-öø-ÿ]$"
_ID = np.dtype("<u4")


def _on_end(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Ids on end as one binary value between every two bounds."""
    offsets = pa.py_buffer(bounds.astype(np.int64) * _ID.itemsize)
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(flat)])


def _binary(parts: list[np.ndarray]) -> pa.Array:
    return _on_end(np.concatenate([np.zeros(0, _ID), *parts]), np.cumsum([0, *map(len, parts)]))


def _ids(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all values on end, and the bounds of each."""
    bounds = np.frombuffer(values.buffers()[1], np.int64)[values.offset :][: len(values) + 1] // _ID.itemsize
    return np.frombuffer(values.buffers()[2] or b"", _ID)[bounds[0] : bounds[-1]], bounds - bounds[0]


def _named(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


class Segments:
    """Encoder with the ids of frequent segments at hand."""

    _instances: dict[str, Segments] = {}

    @classmethod
    def shared(cls, file: str) -> Segments:
        """One per worker process and file."""
        if file not in cls._instances:
            cls._instances[file] = cls(file)
        return cls._instances[file]

    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_file(file)
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)  # tokens that begin with a space or line feed
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith(("Ġ", "Ċ"))
        self.known, self.values = {}, _binary([])
        self.known_tails, self.tail_values = {}, _binary([])

    def _one_by_one(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, _ID) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _alone(self, texts: pa.Array) -> pa.Array:
        return _binary(self._one_by_one(_named(texts)))

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of words that follow a space, or the line feed that they begin with."""
        texts = [w if w[:1] == "\n" else " " + w for w in _named(words)]
        odd = np.flatnonzero(pc.invert(pc.match_substring_regex(words, _WORD)).to_numpy(zero_copy_only=False))
        if len(odd):
            at = np.ones(len(texts), bool)
            at[odd] = False
            found = pa.concat_arrays([self._words(words.filter(pa.array(at))), _binary(self._one_by_one([texts[i] for i in odd]))])
            return found.take(pa.array(np.argsort(np.append(np.flatnonzero(at), odd))))
        ids = [np.zeros(0, _ID)]
        for i in range(0, len(texts), 20_000):
            ids += self._one_by_one(["".join(texts[i : i + 20_000])])
        flat = np.concatenate(ids)
        begin = np.flatnonzero(self.opens[flat])
        if len(begin) != len(texts):  # a vocabulary with spaces inside tokens
            return _binary(self._one_by_one(texts))
        return _on_end(flat, np.append(begin, len(flat)))

    def _remembered(self, texts: pa.Array, known: dict[str, int], values: pa.Array, encode) -> tuple[pa.Array, pa.Array]:
        """Ids of distinct texts, and the values that are remembered from now on."""
        named = _named(texts)
        at = np.fromiter(map(known.get, named, repeat(-1)), np.int64, len(named))
        new = np.flatnonzero(at < 0)
        fresh = encode(texts.take(pa.array(new)))
        at[new] = len(values) + np.arange(len(new))
        found = pa.concat_arrays([values, fresh]).take(pa.array(at))
        some = new[: max(0, REMEMBERED - len(known))]
        if len(some):
            known.update(zip([named[i] for i in some], range(len(values), len(values) + len(some))))
            values = pa.concat_arrays([values, fresh[: len(some)]])
        return found, values

    def _lookup(self, segments: pa.Array) -> pa.Array:
        """Ids of distinct segments; the punctuation behind a word is looked up by itself."""
        words = pc.utf8_rtrim(segments, _PUNCTUATION)
        words = pc.if_else(pc.match_substring_regex(words, _WORD_END), words, segments).dictionary_encode()
        ends = np.frombuffer(segments.buffers()[1], np.int64)[segments.offset :][1 : len(segments) + 1]
        size = pc.binary_length(segments).to_numpy() - pc.binary_length(words.dictionary).to_numpy()[words.indices.to_numpy()]
        tail_ends = np.cumsum(size)
        at = np.repeat(ends - tail_ends, size) + np.arange(size.sum())
        tails = np.frombuffer(segments.buffers()[2] or b"", np.uint8)[at]
        tail_bounds = pa.py_buffer(np.append(0, tail_ends))
        tails = pa.LargeStringArray.from_buffers(len(size), tail_bounds, pa.py_buffer(tails)).dictionary_encode()
        ids, self.values = self._remembered(words.dictionary, self.known, self.values, self._words)
        behind, self.tail_values = self._remembered(tails.dictionary, self.known_tails, self.tail_values, self._alone)
        return pc.binary_join_element_wise(ids.take(words.indices), behind.take(tails.indices), pa.scalar(b"", pa.large_binary()))

    def _cut_texts(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
        """Rows and their segments; texts with runs of white space are cut more carefully.

        A segment follows a space, or begins with the line feed that it follows. Texts that hold
        the text of a special token are not cut.
        """
        careful = pc.match_substring_regex(texts, _BESIDE_SPACE).to_numpy(zero_copy_only=False)
        feeds = pc.match_substring_regex(texts, _BESIDE_FEED).to_numpy(zero_copy_only=False)
        whole = np.zeros(len(texts), bool)
        for mark in self.marks:
            whole |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~careful & ~feeds & ~whole)
        yield plain, pc.split_pattern(pc.replace_substring(texts.take(pa.array(plain)), "\n", " \n"), " ")
        plain = np.flatnonzero(~careful & feeds & ~whole)
        yield plain, pc.split_pattern(texts.take(pa.array(plain)), " ")
        rows = np.flatnonzero(careful | whole)
        cut = [[t] if w else _CUT.split(t) for t, w in zip(texts.take(pa.array(rows)).to_pylist(), whole[rows])]
        yield rows, pa.array(cut, pa.large_list(pa.large_string()))

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Groups of row numbers, how many ids each has, and the ids of the group on end; null as empty."""
        for rows, lists in self._cut_texts(strings(column)):
            if not len(rows):
                continue
            bounds = np.asarray(lists.offsets)
            bounds = bounds - bounds[0]
            segments = lists.flatten()
            coded = segments.dictionary_encode()
            # The first segment of a text follows no space; its ids stand behind the others.
            heads = bounds[:-1]
            head_ids = _binary(self._one_by_one(segments.take(pa.array(heads)).to_pylist()))
            values = self._lookup(coded.dictionary)
            at = coded.indices.to_numpy().astype(np.int64)
            at[heads] = len(values) + np.arange(len(heads))
            ids, ends = _ids(pa.concat_arrays([values, head_ids]).take(pa.array(at)))
            yield rows, np.diff(ends[bounds]), ids
