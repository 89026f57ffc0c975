"""Token counts under a unigram model, by a trie shared by all pre-tokens.

A pre-token's segmentation is the cheapest sequence of vocabulary pieces,
where a piece of rank r costs the rounded logarithm of its Zipf rank; of equal
costs the one with fewer pieces counts.  The distinct pre-tokens of a block of
the corpus are inserted in a trie.  The best cost of a prefix depends on that prefix
alone, so it is computed once per trie node and shared by every word below;
a terminal node stores its word's piece count.
"""

from __future__ import annotations

from functools import partial
from math import log

from pyspark.sql import DataFrame

from voxelframe.llm.bpe import _loaded, load_ranks
from voxelframe.llm.words import BLOCK_CHARS, in_slices, map_blocks

# costs are integers, so sums are exact and alike everywhere
COST_UNIT = 1_000_000
# words in a trie: bounds it in memory
TRIE_WORDS = 100_000


def unigram_costs(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Piece -> cost: minus the log-probability of its rank under Zipf's law."""
    total = log(sum(1 / (r + 1) for r in ranks.values()))
    return {p: round(COST_UNIT * (log(r + 1) + total)) for p, r in ranks.items()}


# a state is one integer: cost in the high bits, pieces in the low ones, which
# hold the pieces of any text (under 2**31 bytes)
PIECE_BITS = 40


class Costs:
    """States added by each vocabulary piece, and the longest piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self.state = {p: (c << PIECE_BITS) + 1 for p, c in unigram_costs(ranks).items()}
        self.longest = max(map(len, ranks))


def trie_counts(words: list[bytes], costs: Costs) -> list[int]:
    """Pieces in the best segmentation of each word."""
    get, longest = costs.state.get, costs.longest
    # node: next byte -> node, and the best state of the node's prefix
    child: list[dict[int, int]] = [{}]
    best: list[int] = [0]
    counts = []
    for text in words:
        node, path = 0, [0]
        for j, c in enumerate(text, 1):
            nxt = child[node].get(c)
            if nxt is None:                       # a new prefix: one forward step
                least = None
                for i in range(max(0, j - longest), j):
                    add = get(text[i:j])
                    if add is not None:
                        state = path[i] + add
                        if least is None or state < least:
                            least = state
                nxt = child[node][c] = len(child)
                child.append({})
                best.append(least)
            node = nxt
            path.append(best[node])
        counts.append(best[node] & (1 << PIECE_BITS) - 1)
    return counts


def _totals(block, words, parts, data):
    import numpy as np
    import pyarrow as pa
    costs = _loaded(data, Costs)
    by_word: list[int] = []
    # words in order share their prefixes' nodes in one slice
    order = sorted(range(len(words)), key=words.__getitem__)
    for _, some in in_slices(order, TRIE_WORDS):
        by_word += trie_counts([words[i].encode() for i in some], costs)
    count_of = np.empty(len(words), np.int64)
    count_of[order] = by_word
    count_list = count_of.tolist()
    by_chunk = np.array([sum([count_list[p] for p in c]) for c in parts], np.int64)
    totals = [int(by_chunk[numbers].sum()) for numbers in block.numbered]
    yield pa.RecordBatch.from_arrays([pa.array(block.ids, pa.int64()), pa.array(totals, pa.int64())],
                                     names=["doc_id", "n_tokens"])


def token_counts(docs: DataFrame, ranks_path: str, pattern: str, block_chars: int = BLOCK_CHARS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens), one row per input row.  Null and empty texts have
    no tokens; bytes that are no UTF-8 count as U+FFFD; null and repeated ids
    stay as they are.  The vocabulary must hold every single byte.  Other
    columns are not read."""
    data = load_ranks(docs.sparkSession, ranks_path)
    return map_blocks(docs, pattern, partial(_totals, data=data), "doc_id bigint, n_tokens bigint", block_chars, id_col,
                      text_col)
