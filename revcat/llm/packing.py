"""Documents packed into token sequences of equal attention cost.

A piece costs ``linear`` per token and ``quadratic`` per squared token, as
attention within it does. A map task collects documents into blocks of bounded
tokens. Of a block with T tokens, T div capacity sequences are full and the rest
is dealt to sequences as long as its powers of two, so nothing is padded. Within a
block, documents go in descending order to the sequence of lowest cost that has
room for them whole; only where none has, the one of lowest cost is filled and the
remainder takes its place in the order. Documents longer than a sequence fill
whole ones first.

No text is shuffled, and a block is packed in one task, from its own rows alone.
Null text counts as empty; a document without tokens still has its end token. Rows
that repeat an identifier are packed each on its own. Other columns are not read,
so they may have any name. An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.llm.common import small_batches, whole_text
from revcat.llm.term_matrix import pieces as text_pieces

CAPACITY, END = 2048, 1
#: A block is closed beyond so many sequences' worth of tokens.
BLOCK_SEQUENCES = 1024
#: Cost of a token, and of a pair of tokens that see each other, relative to it (a model 4,096 wide).
LINEAR, QUADRATIC = 1.0, 1 / (6 * 4096)
#: Bytes of words whose ids a worker remembers.
REMEMBERED = 16 << 20

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


# Words of ASCII and of Latin letters that have one code point: their normal form is themselves in lower case.
_PLAIN = re.compile("[\\x00-\\x7F\\u00C0-\\u00D6\\u00D8-\\u00F6\\u00F8-\\u012F\\u0131-\\u017E]+")
# Fixed value: how the tokenizer splits a word, for such words.
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\\u00DF-\\u00F6\\u00F8-\\u017E]+|[0-9]|[^a-z0-9\\u00DF-\\u00F6\\u00F8-\\u017E]+")
# Byte-level models spell bytes as characters: printable ones as they are, the others from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = {b: b for b in _SHOWN} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}


class _Parts(dict):
    """Ids of the parts into which words are split; many words differ only in their case and punctuation."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, part: str) -> list[int]:
        spelled = part if part.isascii() and part.isalnum() else part.encode().decode("latin-1").translate(_SPELLED)
        ids = self[part] = [token.id for token in self.model.tokenize(spelled)]
        return ids


class WordEncoder(dict):
    """Ids of texts, each distinct word encoded once.

    The tokenizer never joins across white space, and treats all of it alike, so
    words are encoded one by one: plain ones part by part, others by the tokenizer
    as they are. ``self`` maps a word to its number in the store.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.parts = _Parts(self.tokenizer.model)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.parts.clear()
        self.store, self.starts, self.lengths, self.held = array("I"), array("q"), array("q"), 0

    def __missing__(self, word: bytes) -> int:
        text = word.decode()
        if _PLAIN.fullmatch(text):
            ids = [i for part in _SPLIT.findall(text.lower()) for i in self.parts[part]]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        number = self[word] = len(self.starts)
        self.starts.append(len(self.store))
        self.lengths.append(len(ids))
        self.store.extend(ids)
        self.held += len(word)
        return number

    def _piece(self, words: list[bytes]) -> np.ndarray:
        if self.held > REMEMBERED:
            self.forget()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        starts, lengths = (np.frombuffer(a, np.int64)[numbers] if len(words) else numbers for a in (self.starts, self.lengths))
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
        return np.frombuffer(self.store, np.uint32)[at] if total else np.zeros(0, np.uint32)

    def ids(self, text: str) -> np.ndarray:
        return np.concatenate([self._piece(part.split()) for part in text_pieces(text.encode())])


_encoders: dict[str, WordEncoder] = {}


def encoder(tokenizer: str) -> WordEncoder:
    """The encoder of this worker process, made once."""
    if tokenizer not in _encoders:
        _encoders[tokenizer] = WordEncoder(tokenizer)
    return _encoders[tokenizer]


def room(tokens: int, capacity: int) -> np.ndarray:
    """Lengths of the sequences that hold exactly so many tokens: full ones, then powers of two."""
    rest = tokens % capacity
    powers = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    return np.array([capacity] * (tokens // capacity) + powers, np.int64)


def pack(lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(sequence, offset, document, start, length) of every piece, by sequence and offset."""
    left = room(sum(lengths), capacity)
    used, cost = np.zeros(len(left), np.int64), np.zeros(len(left))
    placed, order = [], []

    def put(sequence: int, document: int, start: int, length: int) -> None:
        placed.append((sequence, int(used[sequence]), document, start, length))
        used[sequence] += length
        left[sequence] -= length
        cost[sequence] += linear * length + quadratic * length * length

    full = 0
    for document, length in enumerate(lengths):
        for start in range(0, length - capacity + 1, capacity):
            put(full, document, start, capacity)
            full += 1
        if length % capacity:
            order.append((-(length % capacity), document, length - length % capacity))
    heapq.heapify(order)
    open_ = np.arange(full, len(left))
    while order:
        length, document, start = heapq.heappop(order)
        length = -length
        fits = left[open_] >= length
        if fits.any():
            sequence, taken = open_[np.argmin(np.where(fits, cost[open_], np.inf))], length
        else:
            sequence = open_[np.argmin(cost[open_])]
            taken = int(left[sequence])
            heapq.heappush(order, (taken - length, document, start + taken))
        put(int(sequence), document, start, taken)
        if not left[sequence]:
            open_ = open_[open_ != sequence]
    return sorted(placed)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end: int = END, linear: float = LINEAR, quadratic: float = QUADRATIC,
) -> DataFrame:
    """Pieces: doc_id, start, length, ids (unsigned, 32 bits, little-endian), doc_tokens, sequence_id, offset.

    ``start`` counts the document's tokens before the piece, ``offset`` the
    sequence's. The document's last token is ``end``. Sequence numbers follow from
    partition and block; they are unique, with gaps.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    tokenizer = Path(tokenizer_path).read_text()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first = encoder(tokenizer).ids, TaskContext.get().partitionId() << 36
        names, tokens, held = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal first
            found = pack([len(t) for t in tokens], capacity, linear, quadratic)
            for a in range(0, len(found), 4096):
                rows = found[a : a + 4096]
                sequence, offset, document, start, length = (np.array(c, np.int64) for c in zip(*rows))
                ids = [tokens[d][s : s + n].astype("<u4").tobytes() for _, _, d, s, n in rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[d] for d in document], pa.int64()), pa.array(start), pa.array(length), pa.array(ids, pa.binary()),
                    pa.array([len(tokens[d]) for d in document], pa.int64()), pa.array(sequence + first), pa.array(offset),
                ], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            first += found[-1][0] + 1

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(end))
                names.append(name)
                tokens.append(ids)
                held += len(ids)
                if held >= BLOCK_SEQUENCES * capacity:
                    yield from out()
                    names, tokens, held = [], [], 0
        if tokens:
            yield from out()

    small_batches(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(f"`{text_col}`").alias("text"))
    return plain.mapInArrow(packed, PIECES)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, its documents with the lengths of their pieces, and all ids in order.

    A sequence holds at most ``capacity`` tokens, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda all_, part: F.concat(all_, part["ids"]))
    return grouped.select("sequence_id", "parts.doc_id", "parts.length", joined.alias("ids"))
