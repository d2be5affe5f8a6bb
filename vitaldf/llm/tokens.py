"""Token ids of whole texts, a batch at a time, with a bounded cache of word parts.

A byte-level BPE tokenizer cuts a text at each space before it looks at
words, so a text's ids are those of its space-led words, one after the other.
Arrow splits a batch of texts and finds its distinct words; the library is
asked once for the letters of each that the cache lacks, and the texts' ids
are put together by position.  A text where a space stands inside a run of white
space or that holds an added token (``<|endoftext|>``), and any text of a
tokenizer that doesn't work this way, is encoded in one go.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

#: word parts kept; a full cache starts anew, which changes no result
CACHE_WORDS = 1 << 18
#: bytes of text that are split together (a longer text is so alone)
SLICE_BYTES = 4 << 20
END_ID = 0
#: a space between other white space (or at its end) belongs to a longer token
_INNER_SPACE = r"[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}] (?:[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]|$)"
#: ASCII marks that, after letters, are one part by themselves (an apostrophe may not be)
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: the byte-level alphabet: a space, and the upper bytes that have another character there
_SPACE = "Ġ"
_UPPER = {b: 256 + 34 + b - 128 for b in range(128, 161)} | {173: 256 + 67}


def packed(ids) -> bytes:
    """``ids`` as little-endian unsigned 32-bit integers."""
    return array("I", ids).tobytes()


class TextEncoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        #: tokens that the library cuts out of a text before all else
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        pre = self.tokenizer.pre_tokenizer
        self.by_word = (
            self.tokenizer.normalizer is None and isinstance(pre, pre_tokenizers.ByteLevel)
            and not pre.add_prefix_space and pre.use_regex
            and all(t.special for t in self.tokenizer.get_added_tokens_decoder().values()))
        self.model = self.tokenizer.model
        self.line_end = self.whole("\n")
        self.parts: dict[str, bytes] = {}  # ids of " letters", of letters and of marks

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _plain(self, word: str, space: str, mapped_space: str) -> bytes | None:
        """Ids of ``space + word`` if that is letters and then marks or nothing, which needs no cutting."""
        letters = word.rstrip(_MARKS)
        if not letters.isalpha():
            return None
        if (ids := self.parts.get(space + letters)) is None:
            ids = self._letters(space + letters, letters, mapped_space)
        if len(letters) < len(word):
            marks = word[len(letters):]
            ids += self.parts.get(marks) or self._letters(marks, marks, "")
        return ids

    def _letters(self, key: str, part: str, mapped_space: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(_UPPER)
        ids = self.parts[key] = packed([t.id for t in self.model.tokenize(mapped_space + part)])
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of " " + word."""
        if "\n" not in word:
            ids = self._plain(word, " ", _SPACE)
            return self.whole(" " + word) if ids is None else ids
        lines = word.split("\n")
        if len(word.split()) == len(lines):  # no other white space: a line end is a part by itself
            found = [self._plain(lines[0], " ", _SPACE), *[self._plain(x, "", "") for x in lines[1:]]]
            if None not in found:
                return self.line_end.join(found)
        return self.whole(" " + word)

    def _by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts``, an end id after each, and where each text ends."""
        lists = pc.split_pattern(texts, " ")
        first = lists.offsets.to_numpy()[:-1]
        ends = lists.offsets.to_numpy()[1:]
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.parts) > CACHE_WORDS:
            self.parts.clear()
        table = [*map(self._word, distinct), packed([END_ID])]
        # a text's first word has no space before it
        table += [self.whole(w) for w in lists.flatten().take(pa.array(first)).to_pylist()]
        at = coded.indices.to_numpy().copy()
        at[first] = len(distinct) + 1 + np.arange(len(first))
        at = np.insert(at, ends, len(distinct))
        # positions fit 32 bits: a slice is small, and Arrow's strings end at 2 GB
        sizes = np.fromiter(map(len, table), np.int32, len(table)) // 4
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        lengths = sizes[at]
        until = np.cumsum(lengths, dtype=np.int32)
        place = np.arange(until[-1], dtype=np.int32)
        place += np.repeat(starts[at] - until + lengths, lengths)
        ids = np.frombuffer(b"".join(table), "<u4")[place]
        return ids, until[ends + np.arange(len(ends))]

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts can't be put together from their words."""
        if not self.by_word:
            return np.ones(len(texts), bool)
        found = pc.match_substring_regex(texts, _INNER_SPACE)
        for content in self.added:
            found = pc.or_(found, pc.match_substring(texts, content))
        return found.to_numpy(zero_copy_only=False)

    def documents(self, texts: pa.Array) -> Iterator[bytes]:
        """For each text (null: empty) its ids and the end id, little-endian unsigned 32-bit."""
        end = packed([END_ID])
        texts = pc.fill_null(texts, "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
            part = texts.slice(at, to - at)
            at = to
            odd = self._odd(part)
            ids, ends = self._by_word(part.filter(pa.array(~odd))) if not odd.all() else (None, [])
            start, ends = 0, iter(ends)
            for i, alone in enumerate(odd.tolist()):
                if alone:
                    yield self.whole(part[i].as_py()) + end
                else:
                    to_id = int(next(ends))
                    yield ids[start:to_id].tobytes()
                    start = to_id
            del ids, part
            pa.default_memory_pool().release_unused()

    def document(self, text: str | None) -> bytes:
        return next(self.documents(pa.array([text], pa.string())))


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    """One encoder in each Python worker."""
    return TextEncoder(path)
