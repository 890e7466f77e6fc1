"""Operator 7, BPE encoding and decoding: a priority queue of merge ranks over a doubly linked list of symbols.

Text goes through the steps that the tokenizer file names (special tokens cut out, NFC, blanks, lower case, word pattern,
bytes as printable characters, end-of-word suffix). Each word's symbols form a doubly linked list; a heap holds the rank
of every adjacent pair that can merge. An entry whose symbols have since changed is stale and skipped. Decoding joins the
vocabulary strings, with a blank between them as the library does where the file has no decoder.

Nulls count as empty text, which has no ids and decodes to an empty string. Repeated rows give repeated results, texts of
any length are encoded whole, an empty table gives an empty one. Other columns, whatever their names, aren't read. A row
costs memory in proportion to its own text; the word cache of a worker has a fixed bound."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import runs, workers_can_import

SCHEMA = "doc_id long, token_ids binary, decoded string"


def byte_symbols() -> list[str]:
    """Printable stand-ins of the 256 byte values: themselves where printable, else characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBPE:
    """Encoder and decoder made from a tokenizer file; refuses files with parts that it doesn't know."""

    def __init__(self, path: str, max_entries: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["normalizer"]["normalizers"]
        known = (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"}
            and [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]] == ["Split", "ByteLevel"]
            and spec["decoder"] is None
            and model["type"] == "BPE"
            and not any(model[k] for k in ("unk_token", "continuing_subword_prefix", "dropout", "byte_fallback", "ignore_merges"))
        )
        if not known:
            raise ValueError(f"{path}: not a lower-case word BPE file")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if not t["normalized"]}
        self.strings = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for s, i in [*self.vocab.items(), *self.special.items()]:
            self.strings[i] = s
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        names = byte_symbols()
        self.first = [self.vocab[c] for c in names]
        self.last = [self.vocab[c + self.suffix] for c in names]
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {"": b""}
        self.max_entries = max_entries

    def merge(self, word: str) -> list[int]:
        """Ids of one word."""
        raw = word.encode("utf-8", "surrogatepass")
        first, merges = self.first, self.merges
        ids = [first[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        n = len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapify(heap)
        while heap:
            _, i, a, b, joined = heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # stale: one of its symbols has merged meanwhile
            ids[i], ids[j] = joined, -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if found := merges.get((joined, ids[k])):
                    heappush(heap, (found[0], i, joined, ids[k], found[1]))
            h = left[i]
            if h >= 0 and (found := merges.get((ids[h], joined))):
                heappush(heap, (found[0], h, ids[h], joined, found[1]))
        return [i for i in ids if i >= 0]

    def _word(self, word: str) -> bytes:
        if (got := self.words.get(word)) is None:
            got = self.words[word] = np.array(self.merge(word), "<u4").tobytes()
        return got

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a stretch without blanks or line feeds."""
        out = []
        for part in self.cut.split(chunk) if self.cut else [chunk]:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
                continue
            part = regex.sub(r"\s+", " ", unicodedata.normalize("NFC", part))
            part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
            out += [self._word(w) for w in self.pattern.findall(part)]
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.chunks) > self.max_entries:
            self.chunks, self.words = {"": b""}, {}
        split = [t.replace("\n", " ").split(" ") for t in texts]
        for chunk in set().union(*split):
            if chunk not in self.chunks:
                self.chunks[chunk] = self._chunk(chunk)
        get = self.chunks.__getitem__
        return [b"".join(map(get, chunks)) for chunks in split]

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODERS: dict[str, WordBPE] = {}


def coder(path: str) -> WordBPE:
    """One coder per Python worker and file."""
    if path not in _CODERS:
        _CODERS[path] = WordBPE(path)
    return _CODERS[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, token_ids, decoded) of every row: token_ids little-endian unsigned 32-bit, decoded the text of those ids."""
    workers_can_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for batch in runs(batches, "t", 1 << 20):
            ids = bpe.encode([t or "" for t in batch.column("t").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())],
                ["doc_id", "token_ids", "decoded"],
            )

    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).mapInArrow(run, SCHEMA)


def op7_bpe(docs: DataFrame, path: str) -> DataFrame:
    return encode_decode(docs, path).select(
        "doc_id",
        (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
