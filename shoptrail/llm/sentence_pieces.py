"""SentencePiece encoding and decoding for merge-type vocabularies.

A text's characters are symbols; an agenda holds the pairs of neighbours that are a piece of the vocabulary, best score
first, of equal scores the leftmost. The pair on top is merged and its new neighbours are offered, until the agenda is
empty. Symbols that are no piece become the pieces of their bytes.

Where no piece has a blank after another character, no merge crosses the start of a run of blanks. Texts are cut
there, and each distinct part of an Arrow batch goes through its own agenda once: merges in one part neither allow nor
prevent merges in another. The agendas of short parts are rows of one array, each of which gives its best pair in every
round; a long part has a heap. Ids and decoded bytes are gathered from tables. Every batch can be compared
with the sentencepiece library.

Blanks are kept as spaces here; in the vocabulary's file they are U+2581, which in a text means a blank too.
"""

import struct
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

# Fixed values of the file format: the blank's sign, kinds of pieces, the model type of merges.
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2

# Parts of more characters have a heap as their agenda.
LONGEST = 64

# A character that is no piece is a symbol with its code point, raised by this, as its number.
CHARACTERS = 1 << 24
NO_RANK = np.iinfo(np.int32).max


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        if key & 7 == 0:
            value, at = _number(data, at)
        else:
            size, at = (8, at) if key & 7 == 1 else (4, at) if key & 7 == 5 else _number(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class Vocabulary:
    """What encoding and decoding need of a model file."""

    ids: dict[str, int]
    ranks: dict[str, int]  # order of score, best first; equal scores share one
    pairs: "Pairs"
    byte_ids: list[int]
    data: list[bytes]  # what each id stands for
    opens: list[bool]  # whether a piece begins with a blank
    end_id: int
    dummy_prefix: bool
    cuttable: bool
    proto: bytes


@dataclass
class Pairs:
    """The pairs of symbols that are a piece together, in order of ``keys``: their rank and the piece's id."""

    keys: np.ndarray
    ranks: np.ndarray
    ids: np.ndarray
    characters: np.ndarray  # the symbols of code points

    @classmethod
    def of(cls, ids: dict[str, int], ranks: dict[str, int]) -> "Pairs":
        symbol = lambda text: ids.get(text, CHARACTERS + ord(text) if len(text) == 1 else None)
        found = {}
        for text, number in ids.items():
            for i in range(1, len(text)):
                left, right = symbol(text[:i]), symbol(text[i:])
                if left is not None and right is not None:
                    found[left << 32 | right] = ranks[text], number
        keys = np.array(sorted(found), np.int64)
        values = np.array([found[key] for key in keys.tolist()], np.int32).reshape(-1, 2)
        characters = np.arange(0x110000, dtype=np.int32) + CHARACTERS
        for text, number in ids.items():
            if len(text) == 1:
                characters[ord(text)] = number
        return cls(keys, values[:, 0], values[:, 1], characters)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of each pair; ``NO_RANK`` for those that are no piece."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        if not len(self.keys):
            return np.full(left.shape, NO_RANK, np.int32), np.zeros(left.shape, np.int32)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK), self.ids[at]


def read_model(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a model file. Refused are models that are not of the merge type, that change characters
    before encoding, drop repeated blanks, or have no pieces for bytes."""
    with open(path, "rb") as file:
        proto = file.read()
    pieces, trainer, normaliser = [], {}, {}
    for number, value in _fields(proto):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    kinds = {kind for _, _, kind in pieces}
    if trainer.get(3) != MERGES or not trainer.get(35) or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} or trainer.get(24):
        raise ValueError("only merge-type vocabularies of plain pieces, with bytes for unknown characters, are read")
    if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1):
        raise ValueError("only vocabularies that take the text as it is are read")
    plain = {text.replace(BLANK, " "): i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL and " " not in text}
    order = {score: rank for rank, score in enumerate(sorted({pieces[i][1] for i in plain.values()}, reverse=True))}
    data = [_stands_for(text, kind, trainer.get(44, b" \xe2\x81\x87 ")) for text, _, kind in pieces]
    ranks = {text: order[pieces[i][1]] for text, i in plain.items()}
    return Vocabulary(
        plain,
        ranks,
        Pairs.of(plain, ranks),
        [i for i, (_, _, kind) in enumerate(pieces) if kind == BYTE],
        data,
        [kind == NORMAL and text.startswith(BLANK) for text, _, kind in pieces],
        trainer.get(42, 2),
        bool(normaliser.get(3, 1)),
        not any(text[i] != " " and text[i + 1] == " " for text in plain for i in range(len(text) - 1)),
        proto,
    )


def _stands_for(text: str, kind: int, unknown: bytes) -> bytes:
    if kind == BYTE:
        return bytes([int(text[1:-1], 16)])
    return {UNKNOWN: unknown, CONTROL: b""}.get(kind, text.replace(BLANK, " ").encode())


def merged_together(symbols: np.ndarray, pairs: Pairs) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The symbols of many parts, rows of equally many characters, when no two neighbours are a piece any more.

    In each round every part merges its best pair, the leftmost of equals; parts that have none are done and come out,
    as the numbers of their rows and their symbols.
    """
    rows = np.arange(len(symbols))
    agenda, merges = pairs.look_up(symbols[:, :-1], symbols[:, 1:])
    while len(rows):
        width = symbols.shape[1]
        best = agenda.argmin(1) if width > 1 else np.zeros(len(rows), np.int64)
        own = np.arange(len(rows))
        going = agenda[own, best] != NO_RANK if width > 1 else np.zeros(len(rows), bool)
        if not going.all():
            yield rows[~going], symbols[~going]
            rows, symbols, agenda, merges, best = rows[going], symbols[going], agenda[going], merges[going], best[going]
            own = np.arange(len(rows))
        if not len(rows):
            return
        symbols[own, best] = merges[own, best]
        later = np.arange(width - 1)[None, :] > best[:, None]
        symbols = np.where(later, symbols[:, 1:], symbols[:, :-1])
        # The merged pair leaves the agenda, and those at its sides are new.
        later = later[:, :-1] | (np.arange(width - 2)[None, :] == best[:, None])
        agenda, merges = (np.where(later, x[:, 1:], x[:, :-1]) for x in (agenda, merges))
        for side in (best - 1, best):
            with_one = np.flatnonzero((side >= 0) & (side < width - 2))
            at = side[with_one]
            agenda[with_one, at], merges[with_one, at] = pairs.look_up(symbols[with_one, at], symbols[with_one, at + 1])


def merged_by_heap(part: str, ranks: dict[str, int]) -> list[str]:
    """The symbols of one part of any length, as texts, with the agenda as a heap.

    A symbol goes by the place of its first character; ``after`` holds where it ends, 0 once it is part of another,
    ``before`` where its left neighbour starts. An entry of the agenda is rank, start and end in one number, so that the
    least comes first; it is stale if the symbol at its start and that one's neighbour no longer reach from start to end.
    """
    n = len(part)
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    agenda = []
    for start in range(n - 1):
        rank = ranks.get(part[start : start + 2])
        if rank is not None:
            agenda.append(rank << 64 | start << 32 | start + 2)
    heapify(agenda)
    low = (1 << 32) - 1
    while agenda:
        entry = heappop(agenda)
        start, end = entry >> 32 & low, entry & low
        middle = after[start]
        if not middle or middle >= n or after[middle] != end:
            continue
        after[start], after[middle] = end, 0
        if end < n:
            before[end] = start
            rank = ranks.get(part[start : after[end]])
            if rank is not None:
                heappush(agenda, rank << 64 | start << 32 | after[end])
        left = before[start]
        if left >= 0:
            rank = ranks.get(part[left:end])
            if rank is not None:
                heappush(agenda, rank << 64 | left << 32 | end)
    symbols, start = [], 0
    while start < n:
        symbols.append(part[start : after[start]])
        start = after[start]
    return symbols


def _with_bytes(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """Symbols as ids; a character that is no piece as the pieces of its bytes."""
    return [i for x in symbols for i in ([x] if x < CHARACTERS else map(vocabulary.byte_ids.__getitem__, chr(x - CHARACTERS).encode()))]


def ids_of(parts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of distinct parts one after the other, and how many each has."""
    texts = parts.to_pylist()
    sizes = pc.utf8_length(parts).to_numpy()
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    firsts = np.cumsum(sizes) - sizes
    counts, blocks, single = np.zeros(len(texts), np.int64), [], {}
    for size in np.unique(sizes[sizes <= LONGEST]).tolist():
        places = np.flatnonzero(sizes == size)
        rows = vocabulary.pairs.characters[points[firsts[places][:, None] + np.arange(size)]]
        for done, symbols in merged_together(rows, vocabulary.pairs):
            plain = (symbols < CHARACTERS).all(1)
            blocks.append((places[done[plain]], symbols[plain]))
            counts[places[done]] = symbols.shape[1]
            for place, row in zip(places[done[~plain]].tolist(), symbols[~plain].tolist()):
                single[place] = _with_bytes(row, vocabulary)
    for place in np.flatnonzero(sizes > LONGEST).tolist():
        symbols = merged_by_heap(texts[place], vocabulary.ranks)
        single[place] = _with_bytes([vocabulary.ids.get(x, CHARACTERS + ord(x[0])) for x in symbols], vocabulary)
    for place, ids in single.items():
        counts[place] = len(ids)
    starts = np.cumsum(counts) - counts
    flat = np.empty(int(counts.sum()), np.int32)
    for places, symbols in blocks:
        flat[starts[places][:, None] + np.arange(symbols.shape[1])] = symbols
    for place, ids in single.items():
        flat[starts[place] : starts[place] + len(ids)] = ids
    return flat, counts


def parts_of(texts: pa.Array, vocabulary: Vocabulary) -> tuple[pa.Array, np.ndarray]:
    """All parts of some texts (null: empty), and where each text's start and end."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), BLANK, " ")
    if vocabulary.dummy_prefix:
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
    offsets = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)))).astype(np.int64)
    data = np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8)
    blank = data == 32
    begins = np.zeros(len(data), bool)
    if vocabulary.cuttable:
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
    begins[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    starts = np.flatnonzero(begins)
    edges = np.append(starts, len(data)).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges.tobytes()), pa.py_buffer(data.tobytes()))
    return parts, np.searchsorted(starts, offsets)


def encode(texts: pa.Array, vocabulary: Vocabulary, end: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some texts one after the other, each text's with the end id, and where they start and end."""
    parts, at = parts_of(texts, vocabulary)
    coded = parts.dictionary_encode()
    flat, lengths = ids_of(coded.dictionary, vocabulary)
    flat, lengths = np.append(flat, np.int32(vocabulary.end_id)), np.append(lengths, 1)
    firsts = np.cumsum(lengths) - lengths
    order = coded.indices.to_numpy().astype(np.int64)
    if end:
        order = np.insert(order, at[1:], len(lengths) - 1)
        at = at + np.arange(len(at))
    sizes = lengths[order]
    ends = np.cumsum(sizes)
    places = np.repeat(firsts[order] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
    return flat[places], np.concatenate(([0], ends))[at]


def _one_replacement(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


def decode(ids: np.ndarray, at: np.ndarray, vocabulary: Vocabulary) -> list[str]:
    """The texts of some lists of ids. The blank that encoding puts first is left out; bytes that are no character
    become U+FFFD, one each."""
    import codecs

    codecs.register_error("one-replacement", _one_replacement)
    sizes = np.array([len(x) for x in vocabulary.data], np.int64)[ids]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    pieces = pa.array(vocabulary.data, pa.large_binary()).take(pa.array(ids))
    data = pieces.buffers()[2].to_pybytes() if len(ids) else b""
    texts = []
    for start, stop in zip(at[:-1].tolist(), at[1:].tolist()):
        text = data[ends[start] : ends[stop]].decode("utf-8", "one-replacement")
        seen = next((i for i in range(start, stop) if sizes[i]), None)
        if vocabulary.dummy_prefix and seen is not None and vocabulary.opens[ids[seen]]:
            text = text[1:]
        texts.append(text)
    return texts


def _library(vocabulary: Vocabulary):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=vocabulary.proto)


def _agrees(library, texts: Sequence[str | None], ids: np.ndarray, at: np.ndarray, decoded: Sequence[str]) -> list[bool]:
    """Whether the library gives the same ids and texts."""
    theirs = library.encode([text or "" for text in texts], num_threads=1, add_eos=True)
    same = np.diff(at) == np.fromiter(map(len, theirs), np.int64, len(theirs))
    flat = np.fromiter(chain.from_iterable(theirs), np.int32)
    if not same.all() or not np.array_equal(flat, ids):
        same = [np.array_equal(ids[a:b], own) for a, b, own in zip(at[:-1], at[1:], theirs)]
    return [bool(one) and text == other for one, text, other in zip(same, decoded, library.decode(theirs, num_threads=1))]


def round_trip(docs: DataFrame, vocabulary: Vocabulary, check: bool = True) -> DataFrame:
    """``doc_id``, ``ids`` (with the end id), ``decoded`` and ``agrees`` for each row of ``docs`` (``doc_id``, ``text``).

    ``agrees`` says that the library gives the same ids and the same decoded text; null without ``check``. A null text
    is empty, and an empty one has the end id only; a null id stays null, repeated rows each have their own row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _library(vocabulary) if check else None
        for batch in slices(batches):
            texts = batch.column("text")
            ids, at = encode(texts, vocabulary)
            decoded = decode(ids, at, vocabulary)
            agrees = _agrees(library, texts.to_pylist(), ids, at, decoded) if check else [None] * len(decoded)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
            columns = [batch.column("doc_id"), lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded", "agrees"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, decoded string, agrees boolean")


def decoded(table: DataFrame, vocabulary: Vocabulary, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``table`` with the text of the array column ``ids`` as column ``name``; an older one is replaced. A null list
    gives null, null ids in a list are left out."""
    kept = table.drop(name).withColumn(ids, F.filter(F.col(ids).cast("array<int>"), lambda i: i.isNotNull()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
            texts = decode(lists.flatten().to_numpy(), at, vocabulary)
            column = pc.if_else(pc.is_valid(lists), pa.array(texts, pa.string()), None)
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, name])

    return kept.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in [*kept.dtypes, (name, "string")]))
