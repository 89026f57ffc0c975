"""Byte-level BPE by speculation: propose greedily, verify pairs, merge only failures.

The distinct pre-tokens of a block are laid end to end as bytes.  The longest
token that starts at every position is found for all positions at once, and
each word takes the longest ones from its start: its proposal.

A proposal is right if and only if no merge ever crosses one of its borders.
Merges happen in the order of their ranks, so the tokens at a border grow by
known steps; undoing the steps of the two neighbours from the last one back
shows, for each step, whether the pair that then met at the border would have
been merged before the next step.  All distinct adjacent pairs of a block are
checked in this way together.  Words with a pair that fails are merged exactly.
"""

from __future__ import annotations

import json
from functools import partial
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame, SparkSession

from voxelframe.llm.words import BLOCK_CHARS, ENCODED, assembled, in_slices, map_blocks

MAX_FILE_BYTES = 64 << 20
# words proposed for together: bounds the tables per position
PROPOSE_WORDS = 50_000
NEVER = 1 << 60


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 characters stand for themselves, the other bytes in
    order for the characters from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_tokenizer(spark: SparkSession, path: str):
    """Broadcast of a tokenizer's JSON file, of checked size and kind."""
    with open(path, "rb") as f:
        data = f.read(MAX_FILE_BYTES + 1)
    if len(data) > MAX_FILE_BYTES:
        raise ValueError(f"tokenizer file over {MAX_FILE_BYTES} bytes")
    MergeTable(data)                    # refuses a file that it does not cover
    return spark.sparkContext.broadcast(data)


class MergeTable:
    """The merges of a byte-level BPE tokenizer file, as arrays."""

    def __init__(self, data: bytes):
        import numpy as np
        file = json.loads(data)
        model, before = file["model"], file.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
                                               "ignore_merges", "unk_token"))
        if (model["type"] != "BPE" or not plain or file.get("normalizer") or before.get("type") != "ByteLevel"
                or before.get("add_prefix_space") or not before.get("use_regex", True)):
            raise ValueError("not a plain byte-level BPE tokenizer")
        # special tokens are cut out of the text first
        added = file.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that take white space or whole words are not supported")
        self.special = {t["content"]: t["id"] for t in added}
        byte = byte_of_char()
        self.token = {i: bytes(byte[c] for c in t) for t, i in model["vocab"].items() if t not in self.special}
        self.size = max([*self.token, *self.special.values()]) + 1
        ids = {t: i for i, t in self.token.items()}
        missing = [c for c in range(256) if bytes([c]) not in ids]
        if missing:
            raise ValueError(f"no token for the single bytes {missing}")
        self.byte_list = [ids[bytes([c])] for c in range(256)]
        self.byte = np.array(self.byte_list, np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab = model["vocab"]
        # pair key (left id * size + right id) -> rank, and the id that a rank's merge makes
        self.rank_of = {vocab[a] * self.size + vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        keys = np.array(list(self.rank_of), np.int64)
        ranks = np.array(list(self.rank_of.values()), np.int64)
        made = np.array(self.made, np.int64)[ranks]
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], ranks[order]
        # how a token comes about; single bytes are there from the start (rank -1)
        self.rank, self.left, self.right = (np.full(self.size, -1, np.int64) for _ in range(3))
        self.rank[made], self.left[made], self.right[made] = ranks, keys // self.size, keys % self.size
        self.safe = self._safe(made)
        self._trie()
        self.token |= {i: t.encode() for t, i in self.special.items()}

    def _safe(self, made):
        """Tokens that their own bytes are merged to, in one known way."""
        import numpy as np
        safe = np.zeros(self.size, bool)
        safe[self.byte] = True
        times = np.bincount(made, minlength=self.size)
        built = np.flatnonzero(times == 1)
        built = built[~safe[built]]
        left, right, rank = self.left[built], self.right[built], self.rank[built]
        fine = (self.rank[left] < rank) & (self.rank[right] < rank)
        # merges out of order would break the reasoning about steps: no proposals then
        if not (fine.all() and times[self.byte].max() == 0 and times.max(initial=0) <= 1):
            return safe
        fine &= self.unmerged(left, right, 2 * rank)
        for at in np.argsort(rank).tolist():
            safe[built[at]] = fine[at] and safe[left[at]] and safe[right[at]]
        return safe

    def pair_rank(self, left, right):
        """Rank of each pair's merge; ``NEVER`` if there is none."""
        import numpy as np
        if not len(self._keys):
            return np.full(len(left), NEVER)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NEVER)

    def unmerged(self, left, right, until):
        """Whether no merge crosses the border of each pair of tokens before
        the step ``until``.  Steps are twice a rank, plus one for a step of the
        right token: of equal ranks the leftmost merges first, so a crossing
        merge comes after a left step of its rank and before a right one."""
        import numpy as np
        ok = np.ones(len(left), bool)
        here = np.arange(len(left))
        left, right, until = left.copy(), right.copy(), until.copy()
        while len(here):
            crosses = 2 * self.pair_rank(left, right) < until
            ok[here[crosses]] = False
            a, b = self.rank[left], self.rank[right]
            go = ~crosses & ((a >= 0) | (b >= 0))
            here, left, right, a, b = here[go], left[go], right[go], a[go], b[go]
            undo_left = a > b
            until = np.where(undo_left, 2 * a, 2 * b + 1)
            left, right = np.where(undo_left, self.right[left], left), np.where(undo_left, right, self.left[right])
        return ok

    def _trie(self):
        """Trie of the safe tokens: sorted (node, byte) keys, the node each
        leads to, and the token that ends at a node."""
        import numpy as np
        child: dict[int, int] = {}
        ends = [-1]
        for i in np.flatnonzero(self.safe).tolist():
            node = 0
            for c in self.token[i]:
                nxt = child.get(node << 8 | c)
                if nxt is None:
                    nxt = child[node << 8 | c] = len(ends)
                    ends.append(-1)
                node = nxt
            ends[node] = i
        keys = np.array(list(child), np.int64)
        order = np.argsort(keys)
        self._step, self._to = keys[order], np.array(list(child.values()), np.int64)[order]
        self._ends = np.array(ends, np.int64)

    def longest(self, data, room):
        """Per position of ``data`` the longest token that starts there and
        takes at most ``room`` bytes, and its length."""
        import numpy as np
        token, size = self.byte[data], np.ones(len(data), np.int64)
        here = np.arange(len(data))
        node = np.zeros(len(data), np.int64)
        depth = 0
        while True:
            open_ = room[here] > depth
            here, node = here[open_], node[open_]
            if not len(here):
                return token, size
            key = node << 8 | data[here + depth]
            at = np.minimum(np.searchsorted(self._step, key), len(self._step) - 1)
            found = self._step[at] == key
            here, node = here[found], self._to[at[found]]
            depth += 1
            ended = self._ends[node]
            some = ended >= 0
            token[here[some]], size[here[some]] = ended[some], depth


# words of at most so many bytes are merged by scanning all their pairs
SCANNED_BYTES = 40


def merge_exactly(word: bytes, table: MergeTable) -> list[int]:
    """Ids of one word: the lowest-ranked pair, of equal ones the leftmost, is
    merged until none is left."""
    byte, size, rank_of, made = table.byte_list, table.size, table.rank_of.get, table.made
    ids = [byte[c] for c in word]
    if len(ids) > SCANNED_BYTES:
        return _merge_queued(ids, table)
    ranks = [rank_of(a * size + b, NEVER) for a, b in zip(ids, ids[1:])]
    while ranks:
        rank = min(ranks)
        if rank == NEVER:
            break
        i = ranks.index(rank)
        token = ids[i] = made[rank]
        del ids[i + 1], ranks[i]
        if i:
            ranks[i - 1] = rank_of(ids[i - 1] * size + token, NEVER)
        if i < len(ranks):
            ranks[i] = rank_of(token * size + ids[i + 1], NEVER)
    return ids


def _merge_queued(ids: list[int], table: MergeTable) -> list[int]:
    """The same for long words, with the pairs in a queue."""
    size, rank_of = table.size, table.rank_of.get
    after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
    queue = [(rank_of(ids[i] * size + ids[i + 1], NEVER), i) for i in range(len(ids) - 1)]
    heapify(queue)
    while queue:
        rank, i = heappop(queue)
        if rank == NEVER:
            break
        j = after[i]
        # the pair may have changed since it was queued
        if ids[i] < 0 or j < 0 or rank_of(ids[i] * size + ids[j], NEVER) != rank:
            continue
        ids[i], ids[j] = table.made[rank], -1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
        for p, q in ((before[i], i), (i, k)):
            if p >= 0 and q >= 0:
                heappush(queue, (rank_of(ids[p] * size + ids[q], NEVER), p))
    return [i for i in ids if i >= 0]


def propose(words: list[bytes], table: MergeTable):
    """Longest tokens from each word's start: (ids, tokens per word)."""
    import numpy as np
    sizes = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    ends = np.cumsum(sizes)
    token, size = table.longest(data, np.repeat(ends, sizes) - np.arange(len(data)))
    jump = (np.arange(len(data)) + size).tolist()
    taken, counts = [], []
    for start, end in zip((ends - sizes).tolist(), ends.tolist()):
        n = len(taken)
        while start < end:
            taken.append(start)
            start = jump[start]
        counts.append(len(taken) - n)
    return token[np.array(taken, np.int64)], np.array(counts, np.int64)


def encode_words(words: list[bytes], table: MergeTable) -> tuple[list[list[int]], int]:
    """Ids of each word, and how many proposals failed."""
    import numpy as np
    ids, counts = propose(words, table)
    owner = np.repeat(np.arange(len(words)), counts)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    pairs, place = np.unique(ids[inner] * table.size + ids[inner + 1], return_inverse=True)
    ok = table.unmerged(pairs // table.size, pairs % table.size, np.full(len(pairs), NEVER))
    # a proposal of unsafe single bytes cannot arise: the bytes are always safe
    failed = np.unique(owner[inner[~ok[place]]]).tolist()
    cuts = np.cumsum(counts).tolist()
    listed = ids.tolist()
    out = [listed[e - n:e] for e, n in zip(cuts, counts.tolist())]
    for w in failed:
        out[w] = merge_exactly(words[w], table)
    return out, len(failed)


_TABLES: dict = {}


def table_of(data) -> MergeTable:
    """The merge table of a broadcast file, once per worker."""
    key = hash(data.value)
    if key not in _TABLES:
        _TABLES[key] = MergeTable(data.value)
    return _TABLES[key]


def _encode(block, words, parts, data, full: bool):
    table = table_of(data)
    ids_of: list[list[int]] = []
    for _, some in in_slices(words, PROPOSE_WORDS):
        found, _ = encode_words([b"" if w in table.special else w.encode() for w in some], table)
        ids_of += [[table.special[w]] if w in table.special else ids for w, ids in zip(some, found)]
    yield from assembled(block, words, parts, ids_of, table.token, full)


def encode_decode(docs: DataFrame, tokenizer_path: str, pattern: str, full: bool = False, special: bool = True,
                  block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text with a byte-level BPE tokenizer file and decode
    the ids, one row per input row: doc_id, n_tokens and, with ``full``, ids
    (array) and decoded (binary), else ids_sha256 (of the decimal ids joined
    by commas) and decoded_sha256.

    Special tokens' strings inside a text become those tokens, as the library
    does by default; with ``special`` false they are plain text.  None are
    added.  Null and empty texts have no tokens and the digests of no bytes;
    bytes that are no UTF-8 count as U+FFFD.  Null and repeated ids stay as
    they are.  Other columns are not read.  A file of another kind, or one
    without a token for some byte, raises."""
    data = load_tokenizer(docs.sparkSession, tokenizer_path)
    found = tuple(MergeTable(data.value).special) if special else ()
    return map_blocks(docs, pattern, partial(_encode, data=data, full=full),
                      f"doc_id bigint, n_tokens bigint, {ENCODED[full]}", block_chars, id_col, text_col, found)
