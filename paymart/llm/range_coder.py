"""Operator 4, token-ID output: files of blocks coded by an adaptive context-mixing range coder.

A block holds up to BLOCK ids, its own sorted alphabet and a checksum, and starts from a fresh model, so that it can be
decoded by itself. Each id's probability is a mixture: an order-2 prediction (the id that last followed the last two), an
order-1 prediction (the id that last followed the last one) and order-0 counts over the block's alphabet. The two
predictions weigh as much as they have lately been right at their present run length; the counts get the rest, never less
than 1/8, so that every id can be coded. An id that has a share by a prediction and one by the counts is coded by the larger.
The mixture drives a 48-bit arithmetic coder that puts out 16-bit words. Carries stay in the words and are settled at the end.

Blocks are coded side by side: a step codes one id in each of up to LANES blocks with array operations. What the contexts
predict is found for all steps at once by the encoder, which knows the ids, and step by step by the decoder.

A file is its blocks, then the documents' ids and lengths, then a fixed-size end part. Rows go to files by range of
doc_id, in ascending order inside and across files, nulls first, repeated doc_ids by the hash of their text. Files are
written under a name of their own by each task attempt to the shared folder; the manifest, kept there too, names those of
the attempts that succeeded. Null texts are empty and have just the end id. Texts are encoded whole. An empty table gives
no files. Other columns, whatever their names, aren't read. A task holds LANES blocks at a time beyond one document."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm.common import cut, runs, shared_folder, workers_can_import
from paymart.llm.token_cache import library_encoder
from paymart.llm.warc_zip import open_store

BLOCK, LANES = 2048, 4096
SLOTS = 2048  # order-2 contexts of a block, hashed
SHARE_BITS = 14  # every id has at least 1 of 2 * BLOCK counts, so 4 of these shares, and 2 of 65536 in the least mixture
SHARES = 1 << SHARE_BITS
WORDS = 1_000_000  # words that a worker knows at most
MAGIC = b"TIDRC1\0\0"
HEAD = struct.Struct("<IIIII")  # ids, alphabet size, alphabet bytes, words, crc32
TAIL = struct.Struct("<QQQ8s")  # blocks, documents, bytes of the document part
MANIFEST = "file string, first_id long, first_hash long, n_docs long, n_tokens long, n_bytes long"
DOCS = "doc_id long, in_file long, n_tokens long, ids_crc32 long, base long"


class Mixer:
    """The model of many blocks at once; encoder and decoder keep equal copies. `decodes`: also keep what followed each
    context, and the way back from a cumulative count to its symbol.

    Symbols count from 1 here, 0 is none. Rows of two are the order-2 and the order-1 context. What a context predicts is
    one number: 8 * (the symbol that last followed) + (1 + the length of its run), or 0."""

    def __init__(self, sizes: np.ndarray, decodes: bool = False):
        n, lane = len(sizes), np.arange(len(sizes))
        self.sizes, self.first, self.decodes = sizes, np.cumsum(sizes) - sizes - 1, decodes
        self.counts = np.ones(int(sizes.sum()), np.int32)
        self.hit = np.tile(np.array([0, 4000, 12000, 18000, 24000, 0, 2000, 8000, 14000, 20000], np.int32), n)  # of 32768
        self.hits = np.stack([lane * 10, lane * 10 + 5])
        if decodes:
            self.table = np.zeros(n * SLOTS + n + len(self.counts), np.int16)
            self.rows = np.stack([lane * SLOTS, n * SLOTS + self.first + 1 + lane])
            self.s1, self.s2 = np.zeros(n, np.int16), np.zeros(n, np.int16)
        self.steps, self.summed, self.next_sum = 0, 0, 16
        self._sum()

    def _sum(self) -> None:
        """Shares of SHARES by the counts: start and size in one number."""
        end = np.cumsum(self.counts, dtype=np.int32)
        last = self.first + self.sizes
        self.total = np.diff(end[last], prepend=np.int32(0))
        before = end - self.counts - np.repeat(end[last] - self.total, self.sizes)
        start = (before * float(SHARES) / np.repeat(self.total.astype(float), self.sizes)).astype(np.int32)
        size = np.diff(start, append=np.int32(0))
        size[last] = SHARES - start[last]
        self.share = (start << 16) | size
        if self.decodes:
            begins = np.zeros(int(end[-1]), np.int8)
            begins[end - self.counts] = 1
            self.back = np.cumsum(begins, dtype=np.int16)  # numbers all blocks' symbols, in 16 bits
            self.back_at, self.back_first = end[last] - self.total.astype(np.int64), (self.first + 1).astype(np.int16)

    def shrink(self, n: int) -> None:
        """Only the first n blocks go on."""
        self.counts = self.counts[: self.first[n] + 1]
        for name in ("sizes", "first", "hits", "total", *(("rows", "s1", "s2", "back_at", "back_first") if self.decodes else ())):
            setattr(self, name, getattr(self, name)[..., :n])

    def recall(self) -> np.ndarray:
        """What the contexts predict."""
        self.at = np.empty_like(self.rows)
        np.add(self.rows[0], slots(self.s1, self.s2), out=self.at[0])
        np.add(self.rows[1], self.s1, out=self.at[1])
        return self.table[self.at]

    def weigh(self, found: np.ndarray) -> None:
        """The parts of 65536 that the order-2, the order-1 prediction and the counts get."""
        self.q, self.run = found >> 3, found & 7
        self.k = self.hits + self.run
        self.p = self.hit[self.k]  # 0 where nothing is predicted
        self.m2 = self.p[0] * 57344 >> 15
        self.m1 = (self.p[1] * (57344 - self.m2) >> 15) * (self.q[1] != self.q[0])
        self.m = self.m1 + self.m2
        self.rest = 65536 - self.m

    def counted(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the symbols' shares in the part of the counts."""
        share = self.share[self.first + s]
        start = share >> 16
        low = self.rest * start >> SHARE_BITS
        return low + self.m, (self.rest * (start + (share & 0xFFFF)) >> SHARE_BITS) - low

    def span(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the largest of the symbols' shares of 65536."""
        start, size = self.counted(s)
        by1 = self.m1 * (self.q[1] == s)
        by = self.m2 * (self.q[0] == s) + by1  # equal predictions have no m1
        larger = by > size
        start += (self.m2 * (by1 > 0) - start) * larger
        return start, np.maximum(size, by)

    def find(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbols whose shares hold t, and the shares."""
        share = ((np.maximum(t - self.m, 0) << SHARE_BITS) + (SHARES - 1)) / self.rest
        count = np.minimum(((share.astype(np.int32) + 1) * self.total - 1) >> SHARE_BITS, self.total - 1)
        s = self.back[self.back_at + count] - self.back_first
        start, size = self.counted(s)
        is1, is2 = t < self.m, t < self.m2
        by1 = is1 > is2
        s += (self.q[1] - s) * by1 + (self.q[0] - s) * is2
        start += self.m2 * by1 - start * is1
        size += (self.m1 - size) * by1 + (self.m2 - size) * is2
        return s, start, size

    def learn(self, s: np.ndarray, coded: np.ndarray) -> None:
        """`coded`: the symbols of all steps up to this one, a row a step."""
        right = self.q == s
        self.hit[self.k] = self.p + (right * np.int32(32767) - self.p >> 5)
        if self.decodes:
            self.table[self.at] = s * np.int16(8) + np.int16(1) + np.minimum(self.run, 3) * right
            self.s2, self.s1 = self.s1, s
        self.steps += 1
        if self.steps == self.next_sum < len(coded):
            self.counts += np.bincount((coded[self.summed : self.steps, : len(s)] + self.first).ravel(), minlength=len(self.counts)).astype(np.int32)
            self._sum()
            self.summed, self.next_sum = self.steps, self.steps + min(self.steps, 512)


def slots(s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
    """The order-2 contexts' places: s2 is the symbol before s1."""
    return ((s1 * np.int32(0x9E37) + s2 * np.int32(0x85EB)) >> 3) & (SLOTS - 1)


def predictions(symbols: np.ndarray) -> np.ndarray:
    """What the contexts of all steps predict, as `Mixer.recall` gives it: (step, 2, block). `symbols`: a row a block.

    The encoder knows all symbols, so it sorts the steps by context: what a context last saw stands just before."""
    out = np.zeros((BLOCK, 2, len(symbols)), np.int16)
    for k in range(0, len(symbols), 64):
        s = symbols[k : k + 64]
        s1, s2 = np.zeros_like(s), np.zeros_like(s)
        s1[:, 1:], s2[:, 2:] = s[:, :-1], s[:, :-2]
        rows = np.arange(0, s.size, BLOCK)[:, None]
        for order, context in enumerate((slots(s1, s2).astype(np.int16), s1)):
            at = np.argsort(context, axis=1, kind="stable") + rows
            seen, known = s.ravel()[at], context.ravel()[at]
            same = known[:, 1:] == known[:, :-1]
            right = np.zeros((len(s), BLOCK + 2), np.int16)  # two columns before the first
            right[:, 3:] = same & (seen[:, 1:] == seen[:, :-1])
            entry = seen * np.int16(8) + np.int16(1) + right[:, 2:] * (1 + right[:, 1:-1] * (1 + right[:, :-2]))
            found = np.zeros_like(s)
            found.ravel()[at[:, 1:]] = entry[:, :-1] * same
            out[:, order, k : k + 64] = found.T
    return out


def alphabets_of(parts: list[np.ndarray], most: int, out: np.ndarray) -> list[np.ndarray]:
    """Each part's sorted distinct ids, `most` at most; `out` gets the ids' places there, counted from 1, a row a part."""
    alphabets = []
    place, new = np.zeros(most + 1, np.int16) if most < 1 << 20 else None, np.ones(BLOCK, bool)
    for i, part in enumerate(parts):
        ids = np.sort(part)
        new[1 : len(ids)] = ids[1:] != ids[:-1]
        alphabet = ids[new[: len(ids)]]
        if place is None:
            out[i, : len(part)] = np.searchsorted(alphabet, part) + 1
        else:
            place[alphabet] = np.arange(1, len(alphabet) + 1)
            out[i, : len(part)] = place[part]
        alphabets.append(alphabet)
    return alphabets


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of up to BLOCK ids (below 2**31), the last may be shorter."""
    if not len(ids):
        return []
    parts = [ids[k : k + BLOCK] for k in range(0, len(ids), BLOCK)]
    symbols = np.zeros((len(parts), BLOCK), np.int16)
    alphabets = alphabets_of(parts, int(ids.max()), symbols)
    found = predictions(symbols)
    symbols = np.ascontiguousarray(symbols.T)
    mixer = Mixer(np.array([len(a) for a in alphabets]))
    n = every = len(parts)
    words = np.zeros((every, BLOCK + 4), np.int32)
    flat, begins = words.ravel(), np.arange(every) * (BLOCK + 4)
    at = begins
    low, width = np.zeros(n, np.int64), np.full(n, 1 << 48, np.int64)
    end_low, end_at, tail = low, at, len(parts[-1])
    for step in range(len(parts[0])):
        if step == tail and n == every and n > 1:  # the last block has ended
            end_low, end_at, n = low, at, n - 1
            low, width, at = low[:n], width[:n], at[:n]
            mixer.shrink(n)
        s = symbols[step, :n]
        mixer.weigh(found[step, :, :n])
        start, size = mixer.span(s)
        unit = width >> 16
        low, width = low + unit * start, unit * size
        top = low >> 32
        flat[at] = top  # written over by the next unless it is out
        out = (width < 1 << 32).astype(np.int64)
        bits = out << 4
        at = at + out
        low = low - (top * out << 32) << bits
        width = width << bits
        mixer.learn(s, symbols)
    final, at = (low, at) if n == every else (np.append(low, end_low[-1]), np.append(at, end_at[-1]))
    for shift in (32, 16, 0):
        flat[at] = final >> shift if shift == 32 else (final >> shift) & 0xFFFF
        at = at + 1
    used = at - begins
    while len(over := np.flatnonzero(flat >> 16)):  # settle the carries; a block's first word has none
        flat[over - 1] += flat[over] >> 16
        flat[over] &= 0xFFFF
    del found, symbols
    words = words.astype("<u2")
    blocks = []
    for i, (part, alphabet) in enumerate(zip(parts, alphabets)):
        names = pack_alphabet(alphabet)
        head = HEAD.pack(len(part), len(alphabet), len(names), int(used[i]), zlib.crc32(part.astype("<u4", copy=False)))
        blocks.append(head + names + words[i, : used[i]].tobytes())
    return blocks


def pack_alphabet(alphabet: np.ndarray) -> bytes:
    """Gaps between sorted ids: one byte each, or 255 and two bytes in a list after them, four if two don't hold them all."""
    gaps = alphabet.astype("<u4")
    gaps[1:] -= alphabet[:-1] + 1
    wide = gaps[gaps >= 255]
    return np.minimum(gaps, 255).astype(np.uint8).tobytes() + wide.astype("<u2" if len(wide) and wide.max() < 1 << 16 else "<u4").tobytes()


def unpack_alphabet(raw: bytes, size: int) -> np.ndarray:
    gaps = np.frombuffer(raw, np.uint8, size).astype(np.int64)
    wide = gaps == 255
    gaps[wide] = np.frombuffer(raw, "<u4" if len(raw) - size == 4 * np.count_nonzero(wide) else "<u2", offset=size)
    return (np.cumsum(gaps + 1) - 1).astype(np.uint32)


def decode_blocks(blocks: list[bytes]) -> np.ndarray:
    """Ids of consecutive blocks; only the last may be shorter than the first."""
    if not blocks:
        return np.zeros(0, np.uint32)
    heads = [HEAD.unpack_from(b) for b in blocks]
    alphabets = [unpack_alphabet(b[HEAD.size : HEAD.size + h[2]], h[1]) for b, h in zip(blocks, heads)]
    most, n = max(h[3] for h in heads) + 1, len(blocks)
    words = np.zeros((n, most), np.uint16)
    for i, (b, h) in enumerate(zip(blocks, heads)):
        words[i, : h[3]] = np.frombuffer(b, "<u2", h[3], HEAD.size + h[2])
    flat, at = words.ravel(), np.arange(n) * most + 3
    code = (words[:, 0].astype(np.int64) << 32) + (words[:, 1].astype(np.int64) << 16) + words[:, 2]
    width = np.full(n, 1 << 48, np.int64)
    mixer = Mixer(np.array([len(a) for a in alphabets]), decodes=True)
    symbols, left = np.zeros((heads[0][0], n), np.int16), code[:0]
    for step in range(heads[0][0]):
        if step == heads[-1][0] and n > 1 and n == len(blocks):
            n -= 1
            left, code, width, at = code[n:], code[:n], width[:n], at[:n]
            mixer.shrink(n)
        mixer.weigh(mixer.recall())
        unit = width >> 16
        s, start, size = mixer.find(np.minimum(code / unit, 65535).astype(np.int32))  # both below 2**53: exact
        code, width = code - unit * start, unit * size
        more = (width < 1 << 32).astype(np.int64)
        bits = more << 4
        code = (code << bits) + flat[at] * more
        width = width << bits
        at = at + more
        symbols[step, :n] = s
        mixer.learn(s, symbols)
    if code.any() or left.any():  # the encoder ends on the start of the last share
        raise ValueError("a block's words differ")
    symbols = np.ascontiguousarray(symbols.T) - 1
    out = [alphabet[symbols[i, : h[0]]] for i, (alphabet, h) in enumerate(zip(alphabets, heads))]
    for i, h in enumerate(heads):
        if zlib.crc32(out[i].astype("<u4", copy=False)) != h[4]:
            raise ValueError("a block's checksum differs")
    return np.concatenate(out)


class FileWriter:
    def __init__(self, folder: str, first_id: int | None, first_hash: int):
        self.uri = f"{folder}/{uuid.uuid4().hex}.tid"
        store, path = open_store(self.uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.first = store.open_output_stream(path), (first_id, first_hash)
        self.out.write(MAGIC)
        self.bytes, self.blocks, self.tokens, self.docs, self.held, self.waiting = len(MAGIC), 0, 0, [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4))
        self.held.append(ids)
        self.waiting += len(ids)
        self.tokens += len(ids) // 4
        if self.waiting >= 4 * BLOCK * LANES:
            self._flush(False)

    def _flush(self, whole: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        full = len(ids) if whole else len(ids) // (BLOCK * LANES) * BLOCK * LANES
        for k in range(0, full, BLOCK * LANES):
            data = encode_blocks(ids[k : min(full, k + BLOCK * LANES)])
            self.blocks += len(data)
            self.bytes += self.out.write(b"".join(data))
        self.held, self.waiting = [ids[full:].tobytes()], 4 * (len(ids) - full)

    def close(self) -> tuple:
        self._flush(True)
        null = np.array([i is None for i, _ in self.docs], np.uint8).tobytes()
        part = zlib.compress(np.array([(i or 0, n) for i, n in self.docs], "<i8").tobytes() + null, 1)
        self.bytes += self.out.write(part + TAIL.pack(self.blocks, len(self.docs), len(part), MAGIC))
        self.out.close()
        return self.uri, *self.first, len(self.docs), self.tokens, self.bytes


def read_file(uri: str) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    """(doc_id, parts of its ids) of each document in order."""
    store, path = open_store(uri)
    with store.open_input_file(path) as f:
        size = f.size()
        f.seek(size - TAIL.size)
        n_blocks, n_docs, length, mark = TAIL.unpack(f.read(TAIL.size))
        if mark != MAGIC:
            raise ValueError("not a token file")
        f.seek(size - TAIL.size - length)
        part = zlib.decompress(f.read(length))
        docs, null = np.frombuffer(part, "<i8", 2 * n_docs).reshape(-1, 2).tolist(), part[16 * n_docs :]
        f.seek(len(MAGIC))
        ids, at = np.zeros(0, np.uint32), 0
        for (doc_id, n), no_id in zip(docs, null):
            parts = []
            while n:
                if at == len(ids):
                    blocks = []
                    while n_blocks and len(blocks) < LANES:
                        head = f.read(HEAD.size)
                        _, _, names, words, _ = HEAD.unpack(head)
                        blocks.append(head + f.read(names + 2 * words))
                        n_blocks -= 1
                    ids, at = decode_blocks(blocks), 0
                parts.append(ids[at : at + n])
                at += len(parts[-1])
                n -= len(parts[-1])
            yield (None if no_id else doc_id), parts


def write_files(docs: DataFrame, path: str, folder: str, end_id: int = 1) -> DataFrame:
    """Runs the writers; the manifest of files that count, one row a file."""
    workers_can_import(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").alias("t")).withColumn("h", F.xxhash64("t"))
    rows = rows.repartitionByRange("i", "h").sortWithinPartitions("i", "h")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = library_encoder(path, WORDS), None
        for batch in runs(batches, "t", 1 << 22, "tokens"):
            ids = encoder.encode(batch.column("t"))
            for doc_id, h, raw in zip(batch.column("i").to_pylist(), batch.column("h").to_pylist(), ids):
                out = out or FileWriter(folder, doc_id, h)
                out.add(doc_id, raw + end)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(out.close(), [pa.string()] + [pa.int64()] * 5)], [f.split()[0] for f in MANIFEST.split(", ")])

    return cut(rows.mapInArrow(run, MANIFEST))


def read_files(manifest: DataFrame) -> DataFrame:
    """DOCS: each document's place in its file, number of ids, their checksum, and the ids of all files before."""
    workers_can_import(manifest.sparkSession)
    order = Window.orderBy(F.asc_nulls_first("first_id"), "first_hash").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(order), F.lit(0))).select("file", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(*(c.to_pylist() for c in batch.columns)):
                rows, start = [], 0
                for doc_id, parts in read_file(uri):
                    crc = 0
                    for part in parts:
                        crc = zlib.crc32(part.astype("<u4", copy=False), crc)
                    n = sum(map(len, parts))
                    rows.append((doc_id, start, n, crc, base))
                    start += n
                for k in range(0, len(rows), 10_000):
                    cols = zip(*rows[k : k + 10_000])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], [f.split()[0] for f in DOCS.split(", ")])

    # a number given is kept as it is; left to itself, Spark joins these few short rows in one task, which would read every file
    return files.repartitionByRange(max(1, manifest.count()), "file").mapInArrow(run, DOCS)


def op4_range_coder(docs: DataFrame, path: str) -> DataFrame:
    docs_read = read_files(write_files(docs, path, shared_folder(docs.sparkSession, "token-ids")))
    return docs_read.select("doc_id", (F.col("base") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32")
