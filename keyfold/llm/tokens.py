"""Token ids of whole texts, by public tokenizers that are never trained here."""

from __future__ import annotations

import base64
import os
import re
import sys
import types
from collections.abc import Callable, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of words that a worker keeps with their ids, about: those of late, and as many of
# the time before, from which words in use come back.
TABLE_BYTES = 80 << 20
# What an entry takes beside its letters and ids.
_ENTRY_BYTES = 190
# Longer words are encoded, but not kept.
KEPT_CHARS = 48
# Bytes of texts whose words are looked up together, about.
BLOCK_BYTES = 1 << 22
# Longer texts are cut at safe places before the byte-level encoder sees them.
PIECE_CHARS = 1 << 16

_TAIL = ".,;:!?"


def _worker() -> dict:
    """Objects that live as long as the worker process, not only for one task."""
    module = sys.modules.setdefault("_document_encoders", types.ModuleType("_document_encoders"))
    return module.__dict__.setdefault("held", {})


class WordTokens:
    """Ids of a word-level vocabulary file, as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and never merges across it, so a text's ids are the
    ids of its words one after the other. Each different word of a block of texts is looked
    at once. A word of letters with a punctuation mark behind it is the word and the mark,
    if it is still of letters once normalised. Words are encoded once and remembered.
    Strings of special tokens in a text are these tokens, as when the library encodes it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        normal = self._tokenizer.normalizer
        self._normal = normal.normalize_str if normal else str
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.wide = len(self._ends) > 1 << 16
        self._marks = pa.array([*self._each(list(_TAIL)), b""], pa.large_binary())
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}
        self._known_bytes = 0
        # letters whose normal form is of letters
        self._plain: set[str] = set()

    @staticmethod
    def shared(path: str) -> WordTokens:
        held = _worker()
        if ("word", path) not in held:
            held["word", path] = WordTokens(path)
        return held["word", path]

    def _each(self, words: list[str]) -> list[bytes]:
        found: list[bytes] = []
        for at in range(0, len(words), 4096):
            block = words[at : at + 4096]
            encoded = self._tokenizer.encode_batch_fast(block, add_special_tokens=False)
            found += [np.array(e.ids, "<u4").tobytes() for e in encoded]
        return found

    def _together(self, words: list[str]) -> list[bytes]:
        """Words of letters only, many in one call, told apart by their end marks."""
        found: list[bytes] = []
        for at in range(0, len(words), 4096):
            block = words[at : at + 4096]
            joined = [" ".join(block)]
            [encoded] = self._tokenizer.encode_batch_fast(joined, add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) != len(block) or ends[-1] != len(ids):
                found += self._each(block)
                continue
            raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            found += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        return found

    def _learnt(
        self, words: list[str], encode: Callable[[list[str]], list[bytes]]
    ) -> list[bytes]:
        """The ids of different words; those not known yet are encoded and, if short, kept."""
        found = list(map(self._known.get, words))
        missing = [word for word, ids in zip(words, found) if ids is None]
        fresh = {word: self._before[word] for word in missing if word in self._before}
        unknown = [word for word in missing if word not in fresh]
        fresh.update(zip(unknown, encode(unknown)))
        for word, ids in fresh.items():
            if len(word) <= KEPT_CHARS:
                self._known[word] = ids
                self._known_bytes += _ENTRY_BYTES + len(word) + len(ids)
        return [fresh[word] if ids is None else ids for word, ids in zip(words, found)]

    def _stays_letters(self, core: str) -> bool:
        """Whether a word's normal form, too, is of letters only; some letters gain a mark,
        which the tokenizer joins to punctuation behind it."""
        if not core.isalpha():
            return False
        if not self._plain.issuperset(core):
            self._plain.update(c for c in set(core) if self._normal(c).isalpha())
        return self._plain.issuperset(core)

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of different words, one binary value for each."""
        mark = pc.index_in(
            pc.utf8_slice_codeunits(words, -1), value_set=pa.array(list(_TAIL), words.type)
        )
        mark = mark.fill_null(len(_TAIL)).to_numpy()
        marked = pa.array(mark < len(_TAIL))
        cores = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words)
        cores = pc.ascii_lower(cores).dictionary_encode()
        names, index = cores.dictionary.to_pylist(), cores.indices.to_numpy()
        letters = pc.ascii_is_alpha(cores.dictionary).to_numpy(zero_copy_only=False).copy()
        for k in np.flatnonzero(~letters).tolist():
            letters[k] = self._stays_letters(names[k])
        split = letters[index]
        whole = words.filter(pa.array(~split)).to_pylist()
        ids = self._learnt(list(compress(names, letters)), self._together)
        ids += self._learnt(whole, self._each)
        # letters come first, then the words that are not split
        place = (np.cumsum(letters) - 1)[index]
        place = np.where(split, place, letters.sum() - 1 + np.cumsum(~split))
        return pc.binary_join_element_wise(
            pa.array(ids, pa.large_binary()).take(pa.array(place)),
            self._marks.take(pa.array(np.where(split, mark, len(_TAIL)))),
            pa.scalar(b"", pa.large_binary()),
        )

    def _block(self, texts: pa.Array) -> list[bytes]:
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        ids = self._words(words.dictionary).take(words.indices)
        _, ends, data = ids.buffers()
        cuts = np.frombuffer(ends, "<i8", len(ids) + 1)[split.offsets.to_numpy()].tolist()
        raw = memoryview(data if data is not None else b"")
        return [raw[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def ids(
        self, texts: pa.Array | Sequence[str | None], block: int = BLOCK_BYTES
    ) -> list[bytes]:
        """The ids of each text; none for null and empty texts.

        Texts are taken together up to ``block`` bytes, a longer one by itself.
        """
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        texts = texts.fill_null("")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        found: list[bytes] = []
        while len(found) < len(texts):
            if self._known_bytes > TABLE_BYTES:
                self._before, self._known, self._known_bytes = self._known, {}, 0
            at = len(found)
            most = (sizes[at - 1] if at else 0) + block
            n = max(1, int(np.searchsorted(sizes, most, "right")) - at)
            found += self._block(texts.slice(at, n))
        return found


class ByteTokens:
    """Byte-level ids of a rank file, by the tiktoken library, without special tokens.

    Long texts are cut before white space that follows anything else. Every match of the
    splitting pattern ends there, whatever comes before or after, so the ids are those of
    the whole text. A long run of white space, less the last character if more text
    follows, is one match by itself and is encoded as such: the pattern would go back over
    it character by character. Texts without such places are encoded uncut.
    """

    # White space as the pattern sees it.
    _WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    _SAFE = re.compile(rf"[^{_WHITE}](?=[{_WHITE}])")
    _RUN = re.compile(rf"[{_WHITE}]{{1000,}}")

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self._whole = tiktoken.Encoding(
            "whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}
        )
        self._bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token

    @staticmethod
    def shared(path: str, pattern: str) -> ByteTokens:
        held = _worker()
        if ("byte", path, pattern) not in held:
            held["byte", path, pattern] = ByteTokens(path, pattern)
        return held["byte", path, pattern]

    def pieces(self, text: str, most: int = PIECE_CHARS) -> list[str]:
        """The text, cut at the first safe place after every ``most`` characters."""
        found, start = [], 0
        while len(text) - start > most:
            cut = self._SAFE.search(text, start + most - 1)
            if cut is None:
                break
            found.append(text[start : cut.end()])
            start = cut.end()
        return [*found, text[start:]]

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) <= PIECE_CHARS:
            return self._encoding.encode_ordinary(text)
        found, start = [], 0
        for run in self._RUN.finditer(text):
            end = run.end() - (run.end() < len(text))
            found += self._cut(text[start : run.start()])
            found += self._whole.encode_ordinary(text[run.start() : end])
            start = end
        return found + self._cut(text[start:])

    def _cut(self, text: str) -> list[int]:
        return [i for piece in self.pieces(text) for i in self._encoding.encode_ordinary(piece)]

    def decode(self, ids: Sequence[int]) -> bytes:
        """The raw bytes of ids, which need not be whole characters."""
        return b"".join(map(self._bytes.__getitem__, ids))
