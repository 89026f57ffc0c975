"""Whole texts as numbers into a dictionary of distinct pre-tokens.

A task cuts its documents into blocks of about ``BLOCK_CHARS`` characters.
Every text is cut into chunks at white space (a chunk is an optional space and
a run of other characters, or white space), the distinct chunks of the block
are numbered, and each of them is cut once into the pre-tokens of the
tokenizer's pattern.  Chunk borders are always pre-token borders, so this
equals cutting the whole text.  An operator works once on each distinct
pre-token of a block and puts the documents together from the results.

Blocks need no shuffle: a pre-token that several blocks share is worked on in
each, which costs less than sending every block's dictionary through a
corpus-wide one and back (figures in the README).  A block is bounded by its
characters (or one text) and those of its distinct chunks, so its tables are
too, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 32_000_000
BLOCK_DOCS = 100_000
# distinct chunks of a block, in characters: texts without spaces repeat few
DISTINCT_CHARS = 4_000_000
DOC_BATCH = 512
# Python's \s also holds these four, which are no white space to the pattern
_SEPARATORS = re.compile("[\x1c-\x1f]")
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")


def text_of(value: bytes | None) -> str:
    """A text's characters; bytes that are no UTF-8 become U+FFFD."""
    return "" if value is None else value.decode("utf-8", "replace")


# fixed values: code points that the regex library counts as letters or numbers
# and the tokenizer library, of an older Unicode version, does not (first-last)
NEWER = """558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF
10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686
16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2
1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5
1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"""
_NEWER = re.compile("[" + "".join(
    "-".join(chr(int(x, 16)) for x in part.split("-")) for part in NEWER.split()) + "]")
_UNASSIGNED = "\u0378"


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Pre-tokens of a text by the tokenizer's pattern."""
    import regex
    compiled = regex.compile(pattern)

    def split(text):
        if not _NEWER.search(text):
            return compiled.findall(text)
        spans = [m.span() for m in compiled.finditer(_NEWER.sub(_UNASSIGNED, text))]
        return [text[a:b] for a, b in spans]
    return split


def chunks(text: str, split: Callable[[str], list[str]]) -> list[str]:
    """Pieces of ``text`` whose borders are pre-token borders."""
    return split(text) if _SEPARATORS.search(text) else _CHUNK.findall(text)


class Numbering(dict):
    """Numbers its texts from 0 in the order they are first asked for;
    ``chars`` is the length of all of them together."""

    chars = 0

    def __missing__(self, key):
        number = self[key] = len(self)
        self.chars += len(key)
        return number


def one_word(text: str) -> bool:
    """Letters, with or without a space before them, are one pre-token."""
    return text.isalpha() or text[0] == " " and text[1:].isalpha()


class Block:
    """Documents and the numbered chunks of their texts."""

    def __init__(self):
        self.chars, self.ids, self.numbered = 0, [], []
        self.chunks = Numbering()

    def add(self, doc_id, text: str, split, specials=None) -> None:
        import numpy as np
        if specials is None:
            pieces = chunks(text, split)
        else:               # every other part is a special token
            pieces = [c for i, part in enumerate(specials.split(text))
                      for c in ([part] if i % 2 else chunks(part, split))]
        numbers = np.fromiter(map(self.chunks.__getitem__, pieces), np.uint32, len(pieces))
        self.ids.append(doc_id)
        self.numbered.append(numbers)
        self.chars += len(text)

    def words(self, split, specials=None):
        """The block's distinct pre-tokens, and per chunk their numbers."""
        found = Numbering()
        number = found.__getitem__
        whole = specials.fullmatch if specials else (lambda c: None)
        parts = [[number(c)] if one_word(c) or whole(c) else [number(w) for w in split(c)] for c in self.chunks]
        self.chunks = Numbering()           # no longer needed
        return list(found), parts


@contextmanager
def without_gc():
    """No search for cycles while millions of small lists are made; afterwards
    as before, as the worker is used again by other queries."""
    import gc
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()


def _solve(batches, pattern: str, block_chars: int, solve, specials: tuple):
    split = splitter(pattern)
    specials = special_finder(specials)
    with without_gc():
        block = Block()
        for b in batches:
            for doc_id, value in zip(b.column(0).to_pylist(), b.column(1)):
                block.add(doc_id, text_of(value.as_py()), split, specials)
                if block.chars >= block_chars or block.chunks.chars >= DISTINCT_CHARS or len(block.ids) >= BLOCK_DOCS:
                    yield from solve(block, *block.words(split, specials))
                    block = Block()
        if block.ids:
            yield from solve(block, *block.words(split, specials))


def special_finder(specials: tuple):
    """A pattern that finds special tokens, the longest first; None without any."""
    if not specials:
        return None
    return re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")")


def map_blocks(docs: DataFrame, pattern: str, solve, schema: str, block_chars: int = BLOCK_CHARS,
               id_col: str = "doc_id", text_col: str = "text", specials: tuple = ()) -> DataFrame:
    """``solve(block, words, parts)`` -> Arrow batches of ``schema``, for every
    block of the documents; ``parts[c]`` are the word numbers of chunk c.
    ``specials`` found in a text are words of their own, and the text before
    and after each is cut by itself."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(partial(_solve, pattern=pattern, block_chars=block_chars, solve=solve, specials=specials), schema)


ENCODED = {True: "ids array<int>, decoded binary", False: "ids_sha256 string, decoded_sha256 string"}


def assembled(block: Block, words: list, parts: list, ids_of: list[list[int]], token, full: bool):
    """Arrow batches of a block's encoded documents, put together from the ids
    of its words: ids and decoded bytes if ``full``, else their digests.
    ``token[id]`` are a token's bytes.  The tables given are used up."""
    import numpy as np
    import pyarrow as pa
    listed_of = [",".join(map(str, ids)) for ids in ids_of]
    decoded_of = [b"".join([token[i] for i in ids]) for ids in ids_of]
    size_of = [len(ids) for ids in ids_of]
    counts = np.array([sum([size_of[p] for p in c]) for c in parts], np.int64)
    listed = [",".join([listed_of[p] for p in c]) for c in parts]
    decoded = [b"".join([decoded_of[p] for p in c]) for c in parts]
    words.clear()
    del listed_of, decoded_of, size_of
    if not full:
        parts.clear()
        ids_of.clear()
    for at in range(0, len(block.ids), DOC_BATCH):
        first, second, total = [], [], []
        for numbers in block.numbered[at:at + DOC_BATCH]:
            chosen = numbers.tolist()
            total.append(int(counts[numbers].sum()))
            whole = b"".join([decoded[c] for c in chosen])
            if full:
                first.append([i for c in chosen for p in parts[c] for i in ids_of[p]])
                second.append(whole)
            else:
                first.append(hashlib.sha256(",".join([listed[c] for c in chosen]).encode()).hexdigest())
                second.append(hashlib.sha256(whole).hexdigest())
        kinds = [pa.list_(pa.int32()), pa.binary()] if full else [pa.string(), pa.string()]
        names = ["ids", "decoded"] if full else ["ids_sha256", "decoded_sha256"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.ids[at:at + DOC_BATCH], pa.int64()), pa.array(total, pa.int64()),
             pa.array(first, kinds[0]), pa.array(second, kinds[1])], names=["doc_id", "n_tokens", *names])


def in_slices(words: list, size: int):
    """Consecutive slices of a list, each with its start."""
    return ((at, words[at:at + size]) for at in range(0, len(words), size))
