"""Token ids of whole texts from the tokenizers library, each distinct word encoded once per worker.

The pre-tokenizer never joins text across a blank or a line feed, so the ids of a text are the ids of its stretches, one
after another. Arrow cuts a batch into its distinct stretches. One of Latin-1 letters, or such letters followed by ASCII
marks, is one or two pre-tokens; the normalizer lower-cases the letters, so a word is known in lower case and without its
marks. The library encodes many such words in one call, told apart by the end-of-word tokens, with its model alone if the
file's normalizer and pre-tokenizer are the ones below, whose work on such words is already done. Anything else is given
to the whole library by itself."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from paymart.llm.common import WORKER_CACHES

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")
_WORD_MARKS = f"^[{_LETTERS}]+[!-&(-/:-@\\[-`{{-~]*$"
_NORMALIZER = [("type", "NFC"), ("type", "Replace"), ("type", "Lowercase")]
_BATCH = 500


def _byte_names() -> dict[int, str]:
    """The pre-tokenizer's printable stand-ins of byte values: themselves where printable, else characters from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of `flat` that begin at `start`, one after another."""
    end = np.cumsum(size)
    return flat[np.repeat(start - end + size, size) + np.arange(end[-1] if len(end) else 0)]


class LibraryEncoder:
    def __init__(self, path: str, max_entries: int = 400_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.names = _byte_names()
        self.plain = None
        if self._known():
            self.plain = Tokenizer(self.tok.model)
            self.plain.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        self.max_entries = max_entries
        self._clear()

    def _known(self) -> bool:
        """The file lower-cases, cuts words of letters and writes bytes as characters."""
        steps, parts = (json.loads(p.__getstate__()) if p else {} for p in (self.tok.normalizer, self.tok.pre_tokenizer))
        cuts = parts.get("pretokenizers", [])
        return (
            [("type", s["type"]) for s in steps.get("normalizers", [])] == _NORMALIZER
            and steps["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and r"|[\p{L}]+|" in cuts[0]["pattern"].get("Regex", "")
            and not cuts[1]["add_prefix_space"]
            and not cuts[1]["use_regex"]
        )

    def _clear(self) -> None:
        """`cache`: the number of each known stretch; its ids are `size` of `ids` from `start` on."""
        self.cache: dict[str, int] = {"": 0}
        self.ids, self.n_ids = np.zeros(1 << 16, np.uint32), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _put(self, items: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.cache), len(self.cache) + len(items)
        while m > len(self.start):
            self.start, self.size = np.append(self.start, np.zeros_like(self.start)), np.append(self.size, np.zeros_like(self.size))
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.cache.update(zip(items, range(n, m)))
        self.size[n:m], self.start[n:m] = sizes, self.n_ids + np.cumsum(sizes) - sizes
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)

    def _library(self, items: list[str]) -> None:
        for k in range(0, len(items), _BATCH):
            part = items[k : k + _BATCH]
            ids = [enc.ids for enc in self.tok.encode_batch_fast(part, add_special_tokens=False)]
            self._put(part, np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids]))

    def _words(self, words: list[str]) -> None:
        """Stretches of letters only, in lower case: one pre-token each, so one end-of-word token each."""
        for k in range(0, len(words), _BATCH):
            part = words[k : k + _BATCH]
            given = part
            if self.plain:
                given = [w if w.isascii() else w.encode().decode("latin-1").translate(self.names) for w in part]
            ids = np.array((self.plain or self.tok).encode_batch_fast([" ".join(given)], add_special_tokens=False)[0].ids, np.uint32)
            at = np.flatnonzero(self.ends[ids]) + 1
            if len(at) != len(part) or at[-1] != len(ids):
                self._library(part)
                continue
            self._put(part, ids, np.diff(at, prepend=0))

    def _numbers(self, items: pa.Array, fill) -> np.ndarray:
        """Number of each of these distinct stretches; `fill` makes the missing ones known."""
        names = items.to_numpy(zero_copy_only=False).tolist()
        numbers = list(map(self.cache.get, names))
        if missing := [name for name, k in zip(names, numbers) if k is None]:
            fill(missing)
            numbers = list(map(self.cache.__getitem__, names))
        return np.array(numbers, np.int64)

    def _stretches(self, items: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct stretches: all of them, and where each one's begin and how many they are."""
        if len(self.cache) > self.max_entries:
            self._clear()
        both = np.zeros((len(items), 2), np.int64)
        cut = pc.match_substring_regex(items, _WORD_MARKS)
        is_cut = cut.to_numpy(zero_copy_only=False)
        words = pc.utf8_rtrim(items.filter(cut), characters=_MARKS)
        letters = pc.utf8_lower(words) if self.plain else words
        marks = pc.utf8_ltrim(items.filter(cut), characters=_LETTERS_LISTED)
        for column, part, fill in ((0, letters, self._words), (1, marks, self._library)):
            part = part.dictionary_encode()
            both[is_cut, column] = self._numbers(part.dictionary, fill)[part.indices.to_numpy()]
        both[~is_cut, 0] = self._numbers(items.filter(pc.invert(cut)), self._library)
        sizes = self.size[both]
        ids = gather(self.ids, self.start[both].ravel(), sizes.ravel())
        sizes = sizes.sum(1)
        return ids, np.cumsum(sizes) - sizes, sizes

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null: none."""
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        rows = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        found = rows.values.dictionary_encode()
        ids, start, size = self._stretches(found.dictionary)
        at = found.indices.to_numpy()
        sizes = size[at]
        raw = gather(ids, start[at], sizes).astype("<u4", copy=False).tobytes()
        ends = (np.append(0, np.cumsum(sizes))[rows.offsets.to_numpy()] * 4).tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


_LETTERS_LISTED = "".join(c for c in map(chr, range(0x41, 0x100)) if c.isalpha() and c not in "ªµº")
_ENCODERS: dict[tuple[str, int], LibraryEncoder] = {}
WORKER_CACHES["tokens"] = _ENCODERS.clear


def library_encoder(path: str, max_entries: int = 400_000) -> LibraryEncoder:
    """One encoder per Python worker, file and bound."""
    if (path, max_entries) not in _ENCODERS:
        _ENCODERS[path, max_entries] = LibraryEncoder(path, max_entries)
    return _ENCODERS[path, max_entries]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
