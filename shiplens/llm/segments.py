"""Byte-level BPE pieces of whole texts, by way of their distinct segments.

A text is cut before each blank, between a letter or digit and the mark or line end behind it, and
around a line end that stands alone. The piece pattern never joins what stands on both sides of such
a cut, unless white space stands on both sides of the blank; those texts, and texts with a special
token, are cut by the pattern itself. Cuts are found on the bytes of a batch and Arrow numbers its
distinct segments, so only those are looked up one by one. Each is encoded once and kept while batches
go on using it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from shiplens.llm.rows import ranges, text_bytes

#: Fixed value: the byte-level piece pattern of the tokenizer files.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = regex.compile(PIECES)
UNSAFE = re.compile(r"\s \s|\s \Z")
ONE_WORD, BLANKS = re.compile(r"\S+"), re.compile(r" ?[^ ]+| ")
#: Distinct segments one worker keeps, and bytes of them with their ids; beyond either the store sheds
#: what few batches used. Results don't depend on it.
KEPT, KEPT_BYTES = 1_000_000, 128 << 20


@lru_cache(1)
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, bytes, merge ranks and special tokens of a byte-level BPE tokenizer file."""

    def __init__(self, spec: bytes):
        parsed = json.loads(spec)
        model, letters = parsed["model"], byte_letters()
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        size = max([*ids.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for token, i in ids.items():
            spelled[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            spelled[i] = token.encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.byte_id = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.byte_id[b] = ids[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([ids[a] << 20 | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.rank, self.made = pairs[order], order, made[order]
        self._merges = None
        self.decimal = [str(i) for i in range(size)]
        self.split = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special else None
        )


    @property
    def merges(self) -> dict[int, tuple[int, int]]:
        """(rank, made id) by pair, for one pair at a time; made when first asked for."""
        if self._merges is None:
            self._merges = dict(zip(self.pairs.tolist(), zip(self.rank.tolist(), self.made.tolist())))
        return self._merges


@lru_cache(4)
def vocabulary(spec: bytes) -> Vocabulary:
    return Vocabulary(spec)


#: Kinds of bytes a cut may stand by: letters and digits, marks, line ends; others join.
JOINED, WORD, MARK, LINE = range(4)
KIND = np.zeros(256, np.uint8)
KIND[33:127] = MARK
KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = WORD
KIND[10] = LINE
#: First bytes of white space beyond ASCII.
WIDE_SPACE = (0xC2, 0xE1, 0xE2, 0xE3)


def _cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where segments begin in texts that are not empty and stand end to end."""
    kind = KIND[data]
    # Latin letters of two bytes, U+00C0 to U+023F but for the signs of times and division
    lead = (data[:-1] >= 0xC3) & (data[:-1] <= 0xC8)
    lead &= ~((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    kind[:-1][lead] = kind[1:][lead] = WORD
    line = kind == LINE
    begins = data == 32
    begins[1:] |= (kind[:-1] == WORD) & ((kind[1:] == MARK) | line[1:]) | (kind[:-1] == MARK) & line[1:]
    solid = (kind == WORD) | (kind == MARK)
    begins[2:] |= solid[:-2] & line[1:-1] & solid[2:]
    # a line end that opens a text has nothing before it
    second = starts[:-1] + 1
    second = second[second < len(data)]
    begins[second] &= ~line[second - 1] | (data[second] == 32)
    begins[starts[:-1]] = True
    return np.flatnonzero(begins)


def _spaced(keys: pa.Array) -> np.ndarray:
    """Which segments are a lone blank, or may have white space behind an opening one."""
    data, starts = text_bytes(keys)
    data = np.append(data, np.uint8(32))
    second = data[starts[:-1] + 1]
    return (data[starts[:-1]] == 32) & ((np.diff(starts) == 1) | (second <= 32) | np.isin(second, WIDE_SPACE))


class Segments:
    """Numbers distinct segments and holds their ids. `encode` gives the ids of a text, end to end,
    with the number of ids of each of its segments; it is called with texts of unseen segments."""

    def __init__(self, vocab: Vocabulary, encode: Callable[[str], np.ndarray]):
        self.vocab, self.encode = vocab, encode
        first = np.concatenate([vocab.spelled, [0]])[np.minimum(vocab.starts, len(vocab.spelled))]
        self.opens = (first == 32) & (vocab.lengths > 0)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.counts = np.zeros(1 << 16, np.int64)
        self.starts = np.zeros(1 << 16, np.int64)
        self.uses = np.zeros(1 << 16, np.int32)
        self.pool, self.filled = np.zeros(1 << 20, np.int32), 0
        self.bytes = 0

    def add(self, texts: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        at = len(self.number)
        # a text as Python holds it at most, its ids here and spelled out
        self.bytes += 4 * sum(map(len, texts)) + 12 * len(ids)
        self.number.update(zip(texts, range(at, at + len(texts))))
        while at + len(texts) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        while self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.counts[at : at + len(texts)] = counts
        self.starts[at : at + len(texts)] = self.filled + np.cumsum(counts) - counts
        self.pool[self.filled : self.filled + len(ids)] = ids
        self.filled += len(ids)

    def shed(self) -> None:
        """Keep the segments that several batches used, the more used ones if those are more than half
        of what may be held; half of a segment's uses count on."""
        names = list(self.number)
        uses, counts, starts = (x[: len(names)] for x in (self.uses, self.counts, self.starts))
        sizes, least = 4 * np.fromiter(map(len, names), np.int64, len(names)) + 12 * counts, 2
        while 2 * (uses >= least).sum() > KEPT or 2 * sizes[uses >= least].sum() > KEPT_BYTES:
            least *= 2
        keep = uses >= least
        ids = self.pool[ranges(starts[keep], counts[keep])]
        self.clear()
        self.add(list(compress(names, keep.tolist())), ids, counts[keep])
        self.uses[: len(self.number)] = uses[keep] // 2

    def learn(self, unseen: list[str]) -> None:
        """What opens with a blank opens with a piece of its own wherever it stands, unless white space
        follows, so many segments are encoded as one text and told apart by the blanks. Likewise those
        without white space, told apart by line ends between them."""
        joined, lines, alone = [], [], []
        for s in unseen:
            if s in self.vocab.special:
                alone.append(s)
            elif s[0] == " " and len(s) > 1 and not s[1].isspace():
                joined.append(s)
            else:
                (lines if ONE_WORD.fullmatch(s) else alone).append(s)
        if joined:
            ids = self.encode("".join(joined))
            opens = np.flatnonzero(self.opens[ids])
            self.add(joined, ids, np.diff(opens, append=len(ids)))
        if lines:
            ids = np.append(self.encode("\n".join(lines)), self.vocab.byte_id[10])
            inside = ids != self.vocab.byte_id[10]
            self.add(lines, ids[inside], np.diff(np.flatnonzero(~inside), prepend=-1) - 1)
        for s in alone:
            ids = [self.vocab.special[s]] if s in self.vocab.special else self.encode(s)
            self.add([s], np.asarray(ids, np.int32), np.array([len(ids)]))

    def cut(self, text: str) -> list[str]:
        """The segments of one text of any kind, in order."""
        if self.vocab.split and any(s in text for s in self.vocab.special):
            out: list[str] = []
            for i, part in enumerate(self.vocab.split.split(text)):
                out += [part] if i % 2 else self.cut(part)
            return out
        if UNSAFE.search(text):
            return PIECE.findall(text)
        return BLANKS.findall(text)

    def _numbered(self, keys: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.number.get, keys, repeat(-1)), np.int64, len(keys))
        missing = found < 0
        if missing.any():
            unseen = list(compress(keys, missing.tolist()))
            self.learn(list(dict.fromkeys(unseen)))
            found[missing] = list(map(self.number.__getitem__, unseen))
        self.uses[found] += 1
        return found

    def numbers(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The segments' numbers of all texts end to end, and how many each text has."""
        if len(self.number) > KEPT or self.bytes > KEPT_BYTES:
            self.shed()
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.fill_null("")
        counts = np.zeros(len(column), np.int64)
        data, starts = text_bytes(column)
        if not len(data):
            return counts[:0], counts
        filled = np.flatnonzero(np.diff(starts))
        begins = _cuts(data, np.append(starts[filled], starts[-1]))
        coded = pa.LargeStringArray.from_buffers(
            len(begins), pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(data)
        ).dictionary_encode()
        place, keys = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        text = filled[np.searchsorted(starts[filled], begins, "right") - 1]
        # only these may be unsafe
        odd = np.zeros(len(column), bool)
        odd[text[_spaced(coded.dictionary)[place]]] = True
        for special in self.vocab.special:
            odd |= pc.match_substring(column, special).to_numpy(zero_copy_only=False)
        other = [self.cut(t) for t in column.filter(pa.array(odd)).to_pylist()]
        plain = ~odd[text]
        counts += np.bincount(text[plain], minlength=len(counts))
        counts[odd] = list(map(len, other))
        asked = np.zeros(len(keys), bool)
        asked[place[plain]] = True
        n = int(asked.sum())
        found = self._numbered(list(compress(keys, asked.tolist())) + [k for o in other for k in o])
        of_key = np.zeros(len(keys), np.int64)
        of_key[asked] = found[:n]
        numbers = np.empty(int(counts.sum()), np.int64)
        mine = np.repeat(odd, counts)
        numbers[~mine], numbers[mine] = of_key[place[plain]], found[n:]
        return numbers, counts

    def ids(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        return self.of_numbers(*self.numbers(texts))

    def of_numbers(self, numbers: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        each = self.counts[numbers]
        ids = self.pool[ranges(self.starts[numbers], each)]
        ends = np.concatenate([[0], np.cumsum(each)])[np.cumsum(parts)]
        return ids, np.diff(ends, prepend=0)
