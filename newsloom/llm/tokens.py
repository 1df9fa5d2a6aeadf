"""Token ids of whole texts by a public tokenizer, fast enough for a pass over a corpus.

Tokenizers of one known kind (``NORMALIZER``, ``SPLITTER``, ``SUFFIX``) cut a text at white space and between a letter and a
sign before anything else, so the ids of a text are those of its chunks between these cuts, one after the other. A
worker encodes each chunk once and looks it up afterwards; the library itself does every encoding. Texts in which that
does not hold (special tokens written out, the separator used below), and all texts where the tokenizer is of any
other kind, are given to the library as they are.
"""

import gc
import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = "\x01"  # a chunk of its own: no white space, letter or digit, and one id
TOGETHER = 256  # chunks that one call of the library encodes, with separators between them
REMEMBERED = 400_000  # chunks a worker keeps; beyond that its memory starts afresh, which changes no result
SLICE = 1 << 21  # bytes of text encoded at once
ID = np.dtype("<u4")
# What a tokenizer file must say for its texts to be cut here.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
SUFFIX = "</w>"
# Letters that have one small form and no decomposed spelling of their own, and ASCII signs but the apostrophe: the
# tokenizer cuts between the two and takes a run of such letters as one word.
LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 signs stand for themselves, other bytes for the signs from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    return {**{b: chr(b) for b in kept}, **{b: chr(256 + i) for i, b in enumerate(others)}}


BYTE_LETTERS = byte_letters()


def settings(part) -> dict | None:
    """What the file says of one part, without a copy of its vocabulary."""
    return None if part is None else json.loads(part.__getstate__())


class Encoder:
    """``encode(texts)`` gives the ids of each text, as arrays of unsigned 32-bit numbers; None counts as empty."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        known = settings(self.library.normalizer) == NORMALIZER and settings(self.library.pre_tokenizer) == SPLITTER
        known = known and getattr(self.model, "end_of_word_suffix", None) == SUFFIX
        mark = self.whole(SEPARATOR) if known else ()
        self.mark = int(mark[0]) if len(mark) == 1 else None  # no mark: every text goes to the library
        self._forget()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, ID)

    def _forget(self):
        self.place: dict[str, int] = {}
        self.first, self.count, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, ID)

    def _store(self, chunks: list[str], ids: list[list[int]]) -> None:
        self.place.update(zip(chunks, range(len(self.place), len(self.place) + len(chunks))))
        count = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), ID, int(count.sum()))
        self.first = np.concatenate([self.first, (len(self.ids) + np.cumsum(count) - count).astype(np.int32)])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, flat])

    def _words(self, words: list[str]) -> list[list[int]]:
        tokenize = self.model.tokenize
        small = [w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_LETTERS) for w in map(str.lower, words)]
        return [[t.id for t in tokenize(w)] for w in small]

    def _by_library(self, chunks: list[str]) -> dict[str, list[int]]:
        groups = [chunks[i : i + TOGETHER] for i in range(0, len(chunks), TOGETHER)]
        glued = [f" {SEPARATOR} ".join(group) for group in groups]
        found = {}
        for group, encoding in zip(groups, self.library.encode_batch_fast(glued, add_special_tokens=False)):
            ids = encoding.ids
            start = 0
            for chunk in group[:-1]:
                end = ids.index(self.mark, start)
                found[chunk] = ids[start:end]
                start = end + 1
            found[group[-1]] = ids[start:]
        return found

    def _remember(self, chunks: list[str]) -> None:
        if len(self.place) > REMEMBERED:
            self._forget()
        new = [c for c in chunks if c not in self.place]
        is_word = pc.match_substring_regex(pa.array(new, pa.string()), f"^[{LETTERS}]+$").to_pylist()
        words = [c for c, word in zip(new, is_word) if word]
        others = [c for c, word in zip(new, is_word) if not word]
        self._store(words, self._words(words))
        found = self._by_library(others)
        self._store(others, [found[c] for c in others])

    def _slice(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring(texts, SEPARATOR)
        for special in self.specials:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        odd = np.ones(len(texts), bool) if self.mark is None else odd.to_numpy(zero_copy_only=False)
        small = pc.if_else(pc.string_is_ascii(texts), pc.ascii_lower(texts), texts)
        plain = pc.if_else(pa.array(odd), "", small)
        plain = pc.replace_substring_regex(plain, f"([{LETTERS}])([{SIGNS}])", r"\1 \2")
        words = pc.ascii_split_whitespace(plain)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        collects = gc.isenabled()
        gc.disable()  # many small lists, no cycles
        self._remember(distinct)
        if collects:
            gc.enable()
        at = np.fromiter(map(self.place.__getitem__, distinct), np.int32, len(distinct))
        at = at[coded.indices.to_numpy(zero_copy_only=False)]
        count = self.count[at]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        from_place = np.repeat((self.first[at] - (ends - count)).astype(np.int32), count)
        from_place += np.arange(total, dtype=np.int32)
        ids = self.ids[from_place]
        bounds = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        found = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for i in np.flatnonzero(odd):
            found[i] = self.whole(texts[int(i)].as_py())
        return found

    def encode(self, texts: pa.Array):
        """One array of ids for each text, in order, some megabytes of text at a time."""
        for start, end in slices(texts, SLICE):
            yield from self._slice(texts.slice(start, end - start))
            pa.default_memory_pool().release_unused()


def slices(texts: pa.Array, size: int):
    """(start, end) of successive rows with about ``size`` bytes of text together, at least one row each."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + size, side="right")))
        yield start, end
        start = end


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's own encoder, kept from task to task."""
    return Encoder(path)
