"""Token counts with overlap resynchronisation (operator 8).

Every text is encoded in chunks of CHUNK_CHARS that overlap, each with token
offsets, so memory stays bounded by the chunk; a text of no more is its single
chunk.  Two neighbouring chunks are spliced at a boundary that both have and
that is proven stable:

* The first chunk is right up to a few characters before its end (GUARD, more
  than any special string or the pre-tokenizer's look-ahead), because
  pre-tokens are matched from left to right and a match depends only on the
  text from its start to the character behind it.
* A place where both chunks begin a pre-token therefore begins one in the
  whole text, and from there the second chunk reads the same text.

When no such place lies in the overlap (one pre-token longer than it), the
overlap is doubled, at last back to the last sure splice, which is the whole
remainder.

Edge cases: a null text is empty and has 0 tokens; special strings inside a
text count as the library counts them; equal texts get equal counts; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .textarrays import Texts, lean, slices
from .tokenizer_files import tokenizer, vocabulary

#: Characters of a chunk and of the first overlap; characters before a chunk's end that are not trusted.
CHUNK_CHARS, OVERLAP_CHARS, GUARD_CHARS = 1 << 13, 1 << 8, 64
#: Contract: a text with more tokens is over the limit.
TOKEN_LIMIT = 1024


def begins_pretoken(encoding, token: int) -> bool:
    """Whether a pre-token or special string begins with this token, at the character where its offset begins."""
    if token == 0:
        return True
    word = encoding.token_to_word(token)
    # a byte-level token may cover part of a character: such a place is no boundary
    return ((word is None or word != encoding.token_to_word(token - 1))
            and encoding.token_to_chars(token)[0] >= encoding.token_to_chars(token - 1)[1])


def pretoken_at(encoding, place: int) -> int | None:
    """The token that begins a pre-token (or special string) at the character ``place``."""
    token = encoding.char_to_token(place)
    if token is None or encoding.token_to_chars(token)[0] != place or not begins_pretoken(encoding, token):
        return None
    return token


def splice_at(current, following, back: int, last: int) -> tuple[int, int] | None:
    """First place up to ``last`` (and the token of ``current`` there) where both
    chunks begin a pre-token; ``following`` begins at the character ``back`` of ``current``."""
    for token, (start, _) in enumerate(following.offsets):
        place = back + start
        if place > last:
            break
        if place > 0 and begins_pretoken(following, token) and (mine := pretoken_at(current, place)) is not None:
            return place, mine
    return None


def spliced_chunks(encode, encode_last, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
                   guard: int = GUARD_CHARS) -> Iterator[tuple[object, int]]:
    """Encodings of a text's chunks with the number of their tokens up to the next
    splice.  ``encode`` gives token offsets; a text's last (or only) chunk is
    spliced with none after it and goes to ``encode_last``, which needs none."""
    begin = 0  # a sure pre-token start of the whole text
    while begin + chunk < len(text):
        end = begin + chunk
        current, width, splice = encode(text[begin:end]), min(overlap, chunk), None
        while not splice:
            back = end - width
            splice = splice_at(current, encode(text[back:end]), back - begin, chunk - guard)
            if not splice and width == chunk:
                break
            width = min(2 * width, chunk)
        if splice:
            yield current, splice[1]
            begin += splice[0]
        else:  # no boundary inside the whole chunk: take a longer one
            chunk *= 2
    last = encode_last(text[begin:])
    yield last, len(last)


def encode_long(encode, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, guard: int = GUARD_CHARS) -> list[int]:
    """Ids of a text of any length from overlapping chunks; ``encode`` gives an encoding with offsets."""
    return [i for encoding, n in spliced_chunks(encode, encode, text, chunk, overlap, guard) for i in encoding.ids[:n]]


def count_tokens(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tokenizer(path)

        def encode(text: str):
            return held.encode(text, add_special_tokens=False)

        def encode_last(text: str):
            return held.encode_batch_fast([text], add_special_tokens=False)[0]  # without offsets

        def count(text: str | None) -> int:
            return sum(n for _, n in spliced_chunks(encode, encode_last, text or ""))

        for batch in slices(batches):
            column = batch.column("text")
            counts = np.fromiter((count(x.as_py()) for x in column), np.int64, len(column))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(Texts(column).off)), pa.array(counts), pa.array(counts > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lean(run, tokenizers=True), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
