"""BPE encoding and decoding by contiguous rank arrays.

A word (a piece of the byte-level pattern) is held as a row of part ids and a row of the ranks of
adjacent parts, both contiguous. The smallest rank is found by scanning, the boundary it stands
for is deleted, and the two neighbouring ranks are looked up again, until no adjacent pair has a
rank. Words of like length are worked off side by side, a row each. Scanning is quadratic in a word,
so one of more than LONG bytes, a text without blanks, is merged by a heap over linked parts instead.

Defined results: a null or empty text has no ids and decodes to the empty text; rows are judged
one by one, so repeated rows and ids give repeated results; further columns are left out of the
result. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.rows import batch_of, ranges, slices
from shiplens.llm.segments import PIECE, Segments, Vocabulary, vocabulary

#: Rank of a pair that never merges.
NEVER = 1 << 40
#: Bytes of words (rows times width) merged side by side.
BLOCK = 1 << 18
#: Bytes of a word that the rank arrays take at most.
LONG = 512


def merge_words(vocab: Vocabulary, parts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words given as rows of byte ids; counts: how many of a row's entries are its word."""
    parts, counts = parts.copy(), counts.copy()
    rows, width = parts.shape
    if width < 2:
        return parts, counts

    def ranked(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs = left << 20 | right
        at = np.minimum(np.searchsorted(vocab.pairs, pairs), len(vocab.pairs) - 1)
        return np.where(vocab.pairs[at] == pairs, vocab.rank[at], NEVER), vocab.made[at]

    ranks, made = ranked(parts[:, :-1], parts[:, 1:])
    ranks[np.arange(1, width)[None, :] >= counts[:, None]] = NEVER
    live = np.arange(rows)
    columns = np.arange(width)
    while len(live):
        lowest = ranks[live].argmin(1)
        worth = ranks[live, lowest] < NEVER
        live, lowest = live[worth], lowest[worth]
        if not len(live):
            break
        new = made[live, lowest]
        # delete the boundary after `lowest`: what stands to its right moves one place left
        moved = np.minimum(columns[None, :] + (columns[None, :] > lowest[:, None]), width - 1)
        row = live[:, None]
        parts[live] = parts[row, moved]
        parts[live, lowest] = new
        kept = np.minimum(columns[None, : width - 1] + (columns[None, : width - 1] > lowest[:, None]), width - 2)
        ranks[live], made[live] = ranks[row, kept], made[row, kept]
        counts[live] -= 1
        ranks[live, np.minimum(counts[live] - 1, width - 2)] = NEVER
        for at, there in ((lowest - 1, lowest > 0), (lowest, lowest + 1 < counts[live])):
            r, c = live[there], at[there]
            ranks[r, c], made[r, c] = ranked(parts[r, c], parts[r, c + 1])
    return parts, counts


def merge_long(vocab: Vocabulary, parts: np.ndarray) -> list[int]:
    """Ids of one long word given as byte ids: the pair of least rank, leftmost first, is merged until
    none has a rank. An entry of the heap is a rank and a place; those whose place has another rank
    by now are passed over."""
    merges = vocab.merges.get
    ids, n = parts.tolist(), len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs = (parts[:-1] << 20 | parts[1:]).tolist()
    rank, made = [-1] * n, [-1] * n
    for i, found in enumerate(map(merges, pairs)):
        if found:
            rank[i], made[i] = found
    heap = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        i = entry & 0xFFFFFFFF
        if rank[i] != entry >> 32:
            continue
        j = after[i]
        new = ids[i] = made[i]
        k = after[i] = after[j]
        ids[j] = rank[j] = rank[i] = -1
        if k < n:
            before[k] = i
            if found := merges(new << 20 | ids[k]):
                rank[i], made[i] = found
                heappush(heap, found[0] << 32 | i)
        h = before[i]
        if h >= 0:
            if found := merges(ids[h] << 20 | new):
                rank[h], made[h] = found
                heappush(heap, found[0] << 32 | h)
            else:
                rank[h] = -1
    return [x for x in ids if x >= 0]


def encode_words(vocab: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all words in one array, with each word's start and count; words of like length are
    worked off side by side."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = vocab.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(sizes, kind="stable")
    starts, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    flat, filled, at = [], 0, 0
    for i in order[np.searchsorted(sizes[order], LONG, "right") :].tolist():
        own = np.array(merge_long(vocab, data[begins[i] : begins[i] + sizes[i]]), np.int64)
        flat.append(own)
        starts[i], counts[i], filled = filled, len(own), filled + len(own)
    order = order[sizes[order] <= LONG]
    while at < len(order):
        n = max(1, int(BLOCK // max(1, sizes[order[at]])))
        while n > 1 and at + n <= len(order) and n * sizes[order[min(at + n, len(order)) - 1]] > 2 * BLOCK:
            n //= 2
        block = order[at : at + n]
        width = max(int(sizes[block].max()), 1)
        inside = np.arange(width)[None, :] < sizes[block, None]
        parts = np.zeros((len(block), width), np.int64)
        parts[inside] = data[ranges(begins[block], sizes[block])]
        parts, own = merge_words(vocab, parts, sizes[block])
        flat.append(parts[np.arange(width)[None, :] < own[:, None]])
        counts[block], starts[block] = own, filled + np.cumsum(own) - own
        filled += int(own.sum())
        at += n
    return np.concatenate([np.zeros(0, np.int64), *flat]), starts, counts


class Encoder(Segments):
    """Segments whose ids come from the rank arrays of their pieces."""

    def __init__(self, vocab: Vocabulary):
        super().__init__(vocab, self.of_text)

    def clear(self) -> None:
        super().clear()
        self.decimals: list[str] = []

    def of_text(self, text: str) -> np.ndarray:
        pieces = PIECE.findall(text)
        distinct = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
        ids, starts, counts = encode_words(self.vocab, [p.encode() for p in distinct])
        used = np.fromiter(map(distinct.__getitem__, pieces), np.int64, len(pieces))
        return ids[ranges(starts[used], counts[used])]

    def add(self, texts: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        super().add(texts, ids, counts)
        spelled = list(map(self.vocab.decimal.__getitem__, ids.tolist()))
        ends = np.cumsum(counts).tolist()
        self.decimals += [",".join(spelled[e - n : e]) for e, n in zip(ends, counts.tolist())]

    def spelled_ids(self, numbers: np.ndarray, parts: np.ndarray) -> list[str]:
        """Each text's ids in decimal, joined by commas."""
        spelled, out, at = list(map(self.decimals.__getitem__, numbers.tolist())), [], 0
        for n in parts.tolist():
            out.append(",".join(spelled[at : at + n]))
            at += n
        return out


@lru_cache(2)
def encoder(spec: bytes) -> Encoder:
    return Encoder(vocabulary(spec))


def decode(vocab: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of id lists that stand end to end."""
    lengths = vocab.lengths[ids]
    data = vocab.spelled[ranges(vocab.starts[ids], lengths)].tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def encode(docs: DataFrame, spec: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): every row's ids as an array."""
    key = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        own = encoder(spec)
        for part in slices(batches, "text"):
            ids, counts = own.ids([t or "" for t in part.column("text").to_pylist()])
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            yield pa.record_batch(
                [part.column("key"), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))],
                names=[id_col, "ids"],
            )

    return rows.mapInArrow(run, f"`{id_col}` {key.simpleString()}, ids array<int>")


def round_trip(docs: DataFrame, spec: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of every row's ids and of the text they
    decode to. Nothing is shuffled; a task holds one slice of texts at a time."""
    key = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        own = encoder(spec)
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            numbers, parts = own.numbers(texts)
            ids, counts = own.of_numbers(numbers, parts)
            schema = pa.schema([
                pa.field(id_col, batch.column("key").type), pa.field("n_tokens", pa.int64()),
                pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string()),
            ])
            yield batch_of(schema, **{
                id_col: batch.column("key"), "n_tokens": counts,
                "ids_sha256": [hashlib.sha256(s.encode()).hexdigest() for s in own.spelled_ids(numbers, parts)],
                "decoded_sha256": [
                    hashlib.sha256(s.encode()).hexdigest() for s in decode(own.vocab, ids, counts)
                ],
            })

    return rows.mapInArrow(
        run, f"`{id_col}` {key.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
