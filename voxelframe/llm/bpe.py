"""Byte-level BPE by corpus-level merge replay.

The distinct pre-tokens of a block of the corpus are laid end to end as bytes.
An inverted index leads from each merge's rank (the token a pair of adjacent
tokens makes) to the pair's positions; ranks are taken in ascending order and
each is applied at all its positions, updating only the two neighbouring pairs
of a merge.  A document's ids are put together from its words' ids.
"""

from __future__ import annotations

import base64
from functools import partial
from heapq import heappop, heappush

from pyspark.sql import DataFrame, SparkSession

from voxelframe.llm.words import BLOCK_CHARS, ENCODED, assembled, in_slices, map_blocks

# words whose positions are indexed together: bounds the index in memory
REPLAY_WORDS = 50_000
MAX_RANKS_BYTES = 64 << 20


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """The ranks of a .tiktoken file's content."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}


def load_ranks(spark: SparkSession, path: str):
    """Broadcast of a rank file's content, of checked size; a file without one
    of the 256 single bytes is refused."""
    with open(path, "rb") as f:
        data = f.read(MAX_RANKS_BYTES + 1)
    if len(data) > MAX_RANKS_BYTES:
        raise ValueError(f"rank file over {MAX_RANKS_BYTES} bytes")
    ranks = read_ranks(data)
    missing = [c for c in range(256) if bytes([c]) not in ranks]
    if missing:
        raise ValueError(f"{path}: no rank for the single bytes {missing}")
    return spark.sparkContext.broadcast(data)


class Vocabulary:
    """Ranks as merges: ``merges[left id][right id]`` is the pair's token."""

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.size = max(ranks.values()) + 1
        self.byte = np.array([ranks.get(bytes([c]), -1) for c in range(256)], np.int64)
        none: dict[int, int] = {}
        self.merges = [none] * self.size
        for t, i in ranks.items():
            for cut in range(1, len(t)):
                left, right = ranks.get(t[:cut]), ranks.get(t[cut:])
                if left is not None and right is not None:
                    if self.merges[left] is none:
                        self.merges[left] = {}
                    self.merges[left][right] = i
        # ranks of the pairs of single bytes
        self.pairs = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int64)


def replay(words: list[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """Token ids of each word, as the tokenizer library gives them: a word in
    the vocabulary is one token; in others the lowest-ranked pair (of equal
    ones the leftmost) is merged again and again."""
    import numpy as np
    merges, ranks = vocabulary.merges, vocabulary.ranks
    sizes = np.array([0 if w in ranks else len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join([w for w, n in zip(words, sizes.tolist()) if n]), np.uint8)
    n = len(data)
    ends = np.cumsum(sizes)
    last = np.zeros(n, bool)
    last[ends[sizes > 0] - 1] = True
    # neighbours; -1 at a word's ends
    after = np.where(last, -1, np.arange(1, n + 1)).tolist()
    before = np.where(np.roll(last, 1), -1, np.arange(-1, n - 1)).tolist() if n else []
    token = vocabulary.byte[data].tolist()
    first_rank = np.full(n, -1, np.int64)
    if n:
        first_rank[:-1] = np.where(last[:-1], -1, vocabulary.pairs[data[:-1], data[1:]])
    places = np.argsort(first_rank, kind="stable")
    places = places[first_rank[places] >= 0]
    index: list[list[int]] = [[] for _ in range(vocabulary.size)]
    found, starts = np.unique(first_rank[places], return_index=True)
    for r, some in zip(found.tolist(), np.split(places, starts[1:])):
        index[r] = some.tolist()

    # a position merged into its left neighbour gets token -1
    for rank in range(vocabulary.size):
        some = index[rank]
        if not some:
            continue
        some.sort()
        with_new = merges[rank]
        for i in some:
            left = token[i]
            if left < 0:
                continue
            j = after[i]
            if j < 0 or merges[left].get(token[j]) != rank:
                continue
            token[i], token[j] = rank, -1
            k = after[i] = after[j]
            low = None
            if k >= 0:
                before[k] = i
                new = with_new.get(token[k])
                if new is not None:
                    if new > rank:
                        index[new].append(i)
                    else:
                        low = [(new, i)]
            h = before[i]
            if h >= 0:
                new = merges[token[h]].get(rank)
                if new is not None:
                    if new > rank:
                        index[new].append(h)
                    else:
                        low = [*(low or ()), (new, h)]
            if low:
                _lower_first(low, rank, token, after, before, merges, index)
        index[rank] = ()
    ids, at = [], 0
    for w, size in zip(words, sizes.tolist()):
        if not size:
            ids.append([ranks[w]] if w else [])
            continue
        i, out = at, []
        while i >= 0:
            out.append(token[i])
            i = after[i]
        ids.append(out)
        at += size
    return ids


def _lower_first(queue, rank, token, after, before, merges, index) -> None:
    """A merge of ``rank`` made pairs of no higher rank: their word takes
    them, lowest first, before the sweep goes on."""
    queue.sort()
    while queue:
        r, i = heappop(queue)
        j = after[i] if token[i] >= 0 else -1
        if j < 0 or merges[token[i]].get(token[j]) != r:
            continue
        token[i], token[j] = r, -1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
        for p, q in ((i, k), (before[i], i)):
            new = merges[token[p]].get(token[q]) if p >= 0 and q >= 0 else None
            if new is not None:
                if new > rank:
                    index[new].append(p)
                else:
                    heappush(queue, (new, p))


def _encode(block, words, parts, data, full: bool):
    """Results of a block's documents: digests, or ids and decoded bytes."""
    vocabulary = vocabulary_of(data)
    ids_of: list[list[int]] = []
    for _, some in in_slices(words, REPLAY_WORDS):
        ids_of += replay([w.encode() for w in some], vocabulary)
    yield from assembled(block, words, parts, ids_of, vocabulary.token, full)


_LOADED: dict = {}


def _loaded(data, make):
    """What ``make`` builds from the ranks, once per worker and rank file."""
    key = (hash(data.value), make)
    if key not in _LOADED:
        _LOADED[key] = make(read_ranks(data.value))
    return _LOADED[key]


def vocabulary_of(data) -> Vocabulary:
    return _loaded(data, Vocabulary)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, full: bool = False,
                  block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids, one row per input row.

    With ``full`` the columns are doc_id, n_tokens, ids (array) and decoded
    (binary); otherwise ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 take their place.  Null and empty texts have no tokens and
    the digests of no bytes; bytes that are no UTF-8 count as U+FFFD.  Null
    and repeated ids stay as they are.  Other columns are not read."""
    data = load_ranks(docs.sparkSession, ranks_path)
    return map_blocks(docs, pattern, partial(_encode, data=data, full=full),
                      f"doc_id bigint, n_tokens bigint, {ENCODED[full]}", block_chars, id_col, text_col)
