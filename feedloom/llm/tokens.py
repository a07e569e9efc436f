"""Token ids of whole texts, through a cache of words in each Python worker."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words that a worker keeps at most, in each of two generations.
CACHE_WORDS = 250_000
#: Texts that are cut into words at a time; one longer text is a piece of its own.
PIECE_BYTES = 8 << 20


#: Words of Latin letters with at most a run of marks behind, for which every
#: tokenizer here has the same two pre-tokens: the letters and the marks.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{}~]*)")
_LETTERS = "".join(c for c in map(chr, range(256)) if _PLAIN.fullmatch(c))
_MARKS = "".join(c for c in map(chr, range(128)) if _PLAIN.fullmatch("a" + c) and c not in _LETTERS)


_ID = attrgetter("id")


def packed(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


class _Cache(dict):
    """Word to token ids (little-endian unsigned 32-bit). When it is full, its
    words become the old generation, from which those still in use come back, so
    memory is bounded and frequent words stay."""

    def __init__(self, tokenizer, prefix: str, limit: int, line_end: bytes) -> None:
        super().__init__()
        self.tokenizer, self.prefix, self.limit, self.line_end, self.old = tokenizer, prefix, limit, line_end, {}
        self.merge = tokenizer.model.tokenize
        # How the tokenizer's own normalizer and pre-tokenizer write each letter.
        self.letters = str.maketrans({c: self._written(c) for c in _LETTERS})
        self.lower = all(self._written(c) == self._written(c.lower()) for c in _LETTERS)
        self.start = self._written(prefix + "a")[:-1]
        self.marks: dict[str, bytes] = {"": b""}

    def _written(self, text: str) -> str:
        norm = self.tokenizer.normalizer
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(norm.normalize_str(text) if norm else text)[0][0]

    def _library(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _encode(self, word: str) -> bytes:
        if word[0] == "\n":  # the first word of a line: a line end before it, no blank
            return self.line_end + self._word(word[1:], "", "")
        return self._word(word, self.prefix, self.start)

    def _word(self, word: str, prefix: str, start: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._library(prefix + word)
        return packed([*map(_ID, self.merge(start + plain[1].translate(self.letters)))]) + self.behind(plain[2])

    def behind(self, marks: str) -> bytes:
        """The ids of marks behind letters."""
        if marks not in self.marks and len(self.marks) < 10_000:
            self.marks[marks] = self._library(marks)
        return self.marks[marks] if marks in self.marks else self._library(marks)

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._encode(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


class WordTokenizer:
    """``encode`` gives what the tokenizers library gives for the whole text.

    A text is cut only where the tokenizer itself always cuts and where the parts
    do not influence each other: at single blanks and single line ends between
    other characters. Each part is encoded by the library once and then taken from
    the cache. A text with any other white space next to a blank or a line end, or
    at either end, goes to the library whole.

    ``blanks``: whether the tokenizer keeps white space as (part of) tokens, as
    byte-level vocabularies do; else white space only separates.
    """

    def __init__(self, path: str, blanks: bool, limit: int = CACHE_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.blanks = blanks
        self.line_end = self._whole("\n") if blanks else b""
        self.cache = _Cache(self.tokenizer, " " if blanks else "", limit, self.line_end)

    def _whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        words = text.split()
        if not self.blanks:
            if not text.isascii() and _COMBINING.search(text) or _SEPARATORS.search(text):
                return self._whole(text)
            return b"".join(map(self.cache.__getitem__, words))
        if " ".join(words) != text.replace("\n", " "):
            return self._whole(text)
        words = ("\n" + text).replace("\n", " \n")[1:].split(" ")
        return b"".join(map(self.cache.__getitem__, words))[len(self.line_end):]


    def encode_many(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of every text, in order. The words of many texts are cut and numbered
        by Arrow, the letters of each distinct one and the marks behind them are looked up
        once, and ids are put together by number."""
        size = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
        piece = np.cumsum(size) // PIECE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(texts)]
        for first, last in zip(edges, edges[1:]):
            yield from self._piece(texts.slice(first, last - first))
            pa.default_memory_pool().release_unused()

    def _piece(self, texts: pa.Array) -> Iterator[bytes]:
        texts = pc.fill_null(texts, "")
        if self.blanks:
            whole = pc.match_substring_regex(texts, _UNEVEN)
        else:
            whole = pc.or_(pc.match_substring_regex(texts, _SEPARATORS.pattern), pc.match_substring_regex(texts, _COMBINING.pattern))
        whole = np.asarray(pc.or_(whole, pc.equal(texts, "")))
        cut = texts.filter(pa.array(~whole))
        if self.blanks:
            # Every line, the first too, begins with a line end, of which the first is none.
            words = pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(cut, "\n", " \n"), ""), " ")
        else:
            words = pc.ascii_split_whitespace(cut)
        numbered = pc.list_flatten(words).dictionary_encode()
        all_ids, ends = _taken(*self._distinct(numbered.dictionary), np.asarray(numbered.indices))
        of_text = ends[np.append(0, np.cumsum(np.asarray(pc.list_value_length(words), dtype=np.int64)))]
        skip, at = len(self.line_end) // 4, 0
        for i, alone in enumerate(whole.tolist()):
            if alone:
                yield self.encode(texts[i].as_py())
            else:
                yield all_ids[of_text[at] + skip:of_text[at + 1]].tobytes()
                at += 1

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, joined, and how many each one has."""
        stems = pc.ascii_rtrim(words, characters=_MARKS)
        marks = pc.utf8_ltrim(words, characters="\n" + _LETTERS)
        n, stem, mark = (np.asarray(pc.binary_length(x)) for x in (words, stems, marks))
        # Letters (a line end before them) and marks, and nothing else or between.
        plain = pa.array((stem + mark == n) & (stem > 0))
        stems = pc.if_else(plain, pc.utf8_lower(stems) if self.cache.lower else stems, words).dictionary_encode()
        marks = pc.if_else(plain, marks, "").dictionary_encode()
        ids = [self.cache[w] if w else b"" for w in stems.dictionary.to_pylist()]
        first = len(ids)
        ids += map(self.cache.behind, marks.dictionary.to_pylist())
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        number = np.column_stack([np.asarray(stems.indices), np.asarray(marks.indices) + first]).reshape(-1)
        taken, ends = _taken(np.frombuffer(b"".join(ids), "<u4"), length, number)
        return taken, np.diff(ends[::2])


def _taken(flat: np.ndarray, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``number`` of those of ``length`` that stand in ``flat``, joined, and
    where each one ends, with a 0 before the first."""
    each = length[number]
    ends = np.append(0, np.cumsum(each))
    kind = np.int32 if max(len(flat), ends[-1]) < 1 << 31 else np.int64
    at = np.repeat((np.cumsum(length) - length)[number].astype(kind) - ends[:-1].astype(kind), each)
    at += np.arange(ends[-1], dtype=kind)
    return flat[at], ends


#: White space for Python other than blank, tab and line ends; tokenizers differ in it.
_SEPARATORS = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Combining marks after white space would compose across a cut under NFC.
_COMBINING = re.compile(r"\s[̀-ͯ҃-֑҇-ًؚ-ٰٟ᪰-᫿᷀-᷿⃐-⃿゙゚︠-︯]")


#: Anything but single blanks and line ends between words.
_UNEVEN = r"^[ \n]|[ \n]$|[ \n][ \n]|[\t\r]|" + _SEPARATORS.pattern


@lru_cache(maxsize=2)
def word_tokenizer(path: str, blanks: bool) -> WordTokenizer:
    """One per Python worker and vocabulary file, so that its cache outlives a task."""
    return WordTokenizer(path, blanks)


def byte_bpe(path: str | None = None) -> tuple[str, bool]:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return path, True


def word_bpe(path: str | None = None) -> tuple[str, bool]:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return path, False
