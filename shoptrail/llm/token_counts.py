"""Token counts by offset-mapped attribution.

A document is encoded once as a whole. The tokens of a byte-level vocabulary, one after the other, are the text's bytes, so
running sums of their lengths give every token's span, in bytes and then in characters. Spans are joined with the
document's sections by sorted search. A token that crosses sections goes by a rule to one of them or to each in part.

Rules: ``start`` (the section of its first character), ``end`` (of its last character), ``most`` (the section
that holds most of its characters, the earlier of equals), ``share`` (to each section by its part of the token's characters).
A character cut between tokens counts as begun by the first of them: a token that has only the rest of a
character stands in that character's section.
"""

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the pattern that splits text before merges, which belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

RULES = ("start", "end", "most", "share")


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: a token in base 64 and its id on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def encoder(ranks: dict[bytes, int]):
    """The encoder of a vocabulary, and the byte length of each token id."""
    import tiktoken

    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


# The splitter of the library gives up on runs of some million blanks; longer runs than this are cut out before.
LONG_RUN = 100_000


def _ids(text: str, encoding) -> list[int]:
    """The ids of a text. Of a long run of blanks all but the last one are a piece by themselves (or all, at the
    text's end), whatever stands around them, so that piece is encoded alone."""
    import regex

    out, done = [], 0
    for run in regex.finditer(rf"\p{{White_Space}}{{{LONG_RUN},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += encoding.encode_ordinary(text[done : run.start()])
        out += encoding._encode_single_piece(text[run.start() : end])
        done = end
    return out + encoding.encode_ordinary(text[done:])


def token_spans(text: str, encoding, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token of a text, and the one after its last."""
    ids = np.array(_ids(text, encoding), np.int64)
    ends = np.cumsum(sizes[ids])
    data = text.encode()
    if len(data) == len(text):
        return ends - sizes[ids], ends
    begun = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    # Characters begun before a place; a token that starts inside a character starts at that character.
    inside = np.append((np.frombuffer(data, np.uint8) & 0xC0) == 0x80, False)
    starts = ends - sizes[ids]
    return begun[starts] - inside[starts], begun[ends]


def attributed(first: np.ndarray, after: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section from the spans of both. Sections are in order and don't overlap; what stands between
    them belongs to none, and a token outside all sections isn't counted."""
    n = len(starts)
    count = np.zeros(n)
    if not n or not len(first):
        return count
    after = np.maximum(after, first + 1)
    low = np.searchsorted(ends, first, side="right")  # the first section that ends after the token's start
    high = np.searchsorted(starts, after, side="left") - 1  # the last one that starts before its end
    if rule in ("start", "end"):
        at = first if rule == "start" else after - 1
        section = low if rule == "start" else high
        section_ok = (section >= 0) & (section < n)
        section = np.clip(section, 0, n - 1)
        good = section_ok & (starts[section] <= at) & (at < ends[section])
        return np.bincount(section[good], minlength=n).astype(float)
    one = low == high
    count += np.bincount(low[one], minlength=n) if rule == "most" else 0
    if rule == "share":
        part = np.minimum(after[one], ends[low[one]]) - np.maximum(first[one], starts[low[one]])
        count += np.bincount(low[one], part / (after - first)[one], minlength=n)
    for token in np.flatnonzero(low < high):  # crosses sections
        own = slice(low[token], high[token] + 1)
        part = np.minimum(after[token], ends[own]) - np.maximum(first[token], starts[own])
        if rule == "share":
            count[own] += part / (after[token] - first[token])
        else:
            count[low[token] + int(np.argmax(part))] += 1
    return count


def token_counts(docs: DataFrame, sections: str | None = None, rule: str = "start", vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``section``, ``start``, ``end``, ``n_tokens``, ``doc_tokens``: a row per document and section.

    ``sections`` names an array column of structs ``start``, ``end`` (characters, end not included, in order, without
    overlap); by default the lines of the text are its sections. ``n_tokens`` is whole unless the rule is ``share``.
    ``doc_tokens`` are those of the whole text. A null text is empty; an empty one has one empty line with no tokens; rows of
    equal id each have their own sections; a row without sections gives no row.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ranks = read_ranks(vocabulary)  # read here; tasks get it with their code

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = encoder(ranks)
        for batch in slices(batches):
            out = []
            spans = _spans(batch, sections)
            for doc_id, text, (starts, ends) in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), spans):
                first, after = token_spans(text or "", encoding, sizes)
                counts = attributed(first, after, starts, ends, rule)
                out.append((doc_id, starts, ends, counts, len(first)))
            lengths = [len(x[1]) for x in out]
            join = lambda i, kind: np.concatenate([x[i] for x in out]).astype(kind) if out else np.zeros(0, kind)
            ids = pa.array([x[0] for x in out], pa.int64()).take(pa.array(np.repeat(np.arange(len(out)), lengths)))
            numbers = np.concatenate([np.arange(k) for k in lengths]).astype(np.int64) if out else np.zeros(0, np.int64)
            whole = np.repeat([x[4] for x in out], lengths).astype(np.int64)
            arrays = [ids, pa.array(numbers), *(pa.array(join(i, np.int64)) for i in (1, 2)), pa.array(join(3, np.float64)), pa.array(whole)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "section", "start", "end", "n_tokens", "doc_tokens"])

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), "text", *([sections] if sections else [])]
    schema = "doc_id bigint, section bigint, start bigint, end bigint, n_tokens double, doc_tokens bigint"
    return docs.select(*columns).mapInArrow(run, schema)


def _spans(batch: pa.RecordBatch, sections: str | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of the sections of each row: as given, else its lines, each with its line feed."""
    if sections:
        for found in batch.column(sections).to_pylist():
            found = found or []
            yield np.array([s["start"] for s in found], np.int64), np.array([s["end"] for s in found], np.int64)
        return
    for text in batch.column("text").to_pylist():
        ends = np.cumsum([len(line) + 1 for line in (text or "").split("\n")])
        starts = np.concatenate(([0], ends[:-1]))
        ends[-1] -= 1
        yield starts, ends
