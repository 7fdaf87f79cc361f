"""Token ids of whole texts by a public tokenizer file, with a cache of encoded words."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

# Characters with the Unicode property White_Space, as in the tokenizers' own patterns.
_SPACE = "\t-\r \x85\xa0  -     　"
# Byte-level splitting gives one space to the word behind it; the other family drops white space.
_SPACED = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BARE = re.compile(f"[^{_SPACE}]+")
_BEGUN = re.compile(f" [^{_SPACE}]")
# Python's split() takes these for white space, the tokenizers do not.
_SEPARATORS = re.compile("[\x1c-\x1f]")

# Marks that often end a word; none begins a contraction.
_MARKS = ".,;:!?"
# How byte-level vocabularies write bytes that are no visible Latin-1 character.
_BYTES = dict(zip([*range(33), *range(127, 161), 173], range(256, 324)))

CACHED_CHARS = 64
CACHED_WORDS = 800_000


class Known(dict):
    """Packed ids of chunks; those asked for in vain are noted."""

    def __init__(self):
        self.missed: list[str] = []

    def __missing__(self, chunk: str) -> None:
        self.missed.append(chunk)


class Encoder:
    """Ids of texts, equal to the library's ids of the whole text.

    Neither tokenizer family forms a token across the boundary of the chunks cut here,
    so a chunk is encoded once and its ids are joined from then on. A text that holds the
    string of a special token is encoded in one piece, because that cuts differently.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.chunks = _SPACED if self.library.encode(" a", add_special_tokens=False).offsets[0][0] == 0 else _BARE
        self.known = Known()
        # Ids that begin with a space, which byte-level tokens have nowhere else.
        vocabulary = self.library.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        # Whether the model can be given words of letters, as its library would cut them.
        self.direct = self.chunks is _SPACED and self.library.normalizer is None and type(self.library.pre_tokenizer).__name__ == "ByteLevel"

    def __call__(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """uint32 ids of each text; a null is an empty text."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        whole = [any(s in (t or "") for s in self.special) for t in texts]
        words = [[] if odd else self._cut(t or "") for t, odd in zip(texts, whole)]
        self.known.missed, get = [], self.known.__getitem__
        found = [[*map(get, ws)] for ws in words]
        new, out = set(self.known.missed), []
        rare = self._learn(new)
        for text, odd, ws, packed in zip(texts, whole, words, found):
            if odd:
                out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            if new:
                packed = [(rare.get(w) or get(w)) if x is None else x for w, x in zip(ws, packed)]
            out.append(np.frombuffer(b"".join(packed), np.uint32))
        return out

    def _cut(self, text: str) -> list[str]:
        if self.chunks is _BARE and not _SEPARATORS.search(text):
            return text.split()
        return self.chunks.findall(text)

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """Encode new words; very long ones are returned, not kept.

        Plain letters, and marks behind them, are one piece each to the byte-level family: the model takes them as they are.
        """
        rare, rest, pieces, known = {}, [], self.library.model.tokenize, self.known
        for w in new:
            stem = w.rstrip(_MARKS)
            letters = stem[1:] if stem[:1] == " " else stem
            if not (self.direct and letters.isalpha() and (letters.isascii() or max(letters) <= "ÿ")):
                rest.append(w)
                continue
            ids = known.get(stem)
            if ids is None:
                piece = stem.replace(" ", "Ġ") if letters.isascii() else stem.encode().decode("latin-1").translate(_BYTES)
                ids = array("I", [t.id for t in pieces(piece)]).tobytes()
                if len(stem) <= CACHED_CHARS:
                    known[stem] = ids
            if len(stem) < len(w):
                marks = w[len(stem) :]
                behind = known.get(marks) or array("I", [t.id for t in pieces(marks)]).tobytes()
                if len(marks) <= CACHED_CHARS:
                    known[marks] = behind
                ids += behind
            (known if len(w) <= CACHED_CHARS else rare)[w] = ids
        for w, ids in self._encoded(rest):
            (known if len(w) <= CACHED_CHARS else rare)[w] = ids
        return rare

    def _encoded(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """The packed ids of words, many of them encoded as one text: those with a space as they are, others parted by the special token."""
        if not self.special:
            for w in words:
                yield w, np.array(self.library.encode(w, add_special_tokens=False).ids, np.uint32).tobytes()
            return
        mark, parted = self.library.token_to_id(self.special[0]), [[], []]
        for w in words:
            parted[self.chunks is _SPACED and _BEGUN.match(w) is not None].append(w)
        for joined, some in enumerate(parted):
            runs = [some[i : i + 200] for i in range(0, len(some), 200)]
            for i in range(0, len(runs), 20):
                texts = [("" if joined else self.special[0]).join(run) for run in runs[i : i + 20]]
                for run, encoded in zip(runs[i : i + 20], self.library.encode_batch_fast(texts, add_special_tokens=False)):
                    ids = np.array(encoded.ids, np.uint32)
                    starts = np.flatnonzero(self.spaced[ids]).tolist() if joined else [0, *(np.flatnonzero(ids == mark) + 1).tolist()]
                    packed, ends = ids.tobytes(), [x - (not joined) for x in starts[1:]] + [len(ids)]
                    for w, start, end in zip(run, starts, ends, strict=True):
                        yield w, packed[4 * start : 4 * end]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder and cache for all tasks of a Python worker."""
    return Encoder(path)


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(ids.astype("<u4").tobytes())
