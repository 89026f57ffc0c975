"""Alignment of two tokenizations of the same bytes.

A text with a space before it is cut into tokens by a byte-level BPE (A) and
by a piece model (B).  Byte offsets where tokens of both end cut the tokens
into groups; the last A and B token of a group are linked.  How often two ids
are linked in the whole corpus says how good a link is.

Fragments.  Any stretch of A tokens and any stretch of B tokens of a text form
a fragment: an open prefix (tokens up to the first common end), closed groups
(between common ends) and an open suffix (tokens after the last).  Fragments of
neighbouring stretches compose: suffix and prefix meet, which may close groups,
all else stays.  Composition is associative, so the fragments of a long text,
made in different tasks from byte ranges, are composed in a tree.  The two
stretches of a range may end at different bytes: each tokenizer's stretch ends
at its own next border, a place that no token of it crosses.

Short texts are worked on in blocks: the distinct stretches between places that
no token of either crosses are fragments with nothing open, aligned once a
block.  A block sends each id pair once with its number of links, gets the
pair's corpus-wide count back, and adds the counts up per document.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.llm import speculate
from voxelframe.llm.common import shuffle_parts, staged
from voxelframe.llm.words import BLOCK_DOCS, DISTINCT_CHARS, Numbering, in_slices, one_word, splitter, text_of, without_gc

# texts of more bytes are cut into ranges of about so many characters
LONG_BYTES = 1 << 16
RANGE_CHARS = 1 << 15
# fragments composed by one step of the tree
FAN = 16
# a block of short texts: tokens of both kinds and their groups are held at once
BLOCK_CHARS = 16_000_000
MAX_MODEL_BYTES = 64 << 20
# characters tried as a wall: one that no piece holds keeps text and prefix apart
WALLS = "\n\t\x01"
SLICE = 50_000
# bits of the A id in a pair's code
A_BITS = 32

_SPACE, _OTHER = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
# stretches whose ends no token crosses: white space before a word is one
# pre-token up to its last character, which joins the word if it is a space
_STRETCH = re.compile(rf"{_SPACE}* {_OTHER}+|{_SPACE}+(?!{_OTHER})|{_SPACE}|{_OTHER}+")
# borders of A inside a text: before a space after a word, and after ASCII
# letters that end in punctuation or a digit
_A_BORDER = re.compile(rf"(?<={_OTHER})(?= )|(?<=[A-Za-z])(?=[!-@\[-`{{-~])")


class Pieces:
    """The piece model: encoding without the space it adds, and token bytes."""

    def __init__(self, data: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.token = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]
        plain = [p for i, p in enumerate(pieces)
                 if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        # characters that meet inside a piece
        self.met = {p[i:i + 2] for p in plain for i in range(len(p) - 1)}
        # white space that pieces hold together with other characters
        joining = {c for m in self.met if m[0] != "▁" and m[1] == "▁" or m[0].isspace() or m[1].isspace()
                   for c in m.replace("▁", " ") if c.isspace()}
        self.joining = re.compile("[" + "".join(map(re.escape, joining)) + "]") if joining else None
        held = set("".join(plain))
        for wall in WALLS:
            start = self.model.encode(wall)
            if wall not in held and b"".join(self.token[i] for i in start) in (b" " + wall.encode(), wall.encode()):
                self.wall, self.skip = wall, len(start)
                return
        raise ValueError("every candidate for a wall character is part of a piece")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that stand inside a longer one."""
        skip = self.skip
        return [ids[skip:] for ids in self.model.encode([self.wall + t for t in texts], num_threads=1)]

    def border(self, text: str, at: int) -> int:
        """The first place from ``at`` on that no piece crosses."""
        met, n = self.met, len(text)
        while at < n and text[at - 1:at + 1].replace(" ", "▁") in met:
            at += 1
        return min(at, n)


_PIECES: dict = {}


def pieces_of(data) -> Pieces:
    key = hash(data.value)
    if key not in _PIECES:
        _PIECES[key] = Pieces(data.value)
    return _PIECES[key]


def load_pieces(spark: SparkSession, path: str):
    """Broadcast of a piece model file, of checked size."""
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"piece model over {MAX_MODEL_BYTES} bytes")
    Pieces(data)
    return spark.sparkContext.broadcast(data)


def stretches(text: str, pieces: Pieces) -> list[str]:
    """Parts of ``text`` whose ends no token of either tokenizer crosses."""
    parts = _STRETCH.findall(text)
    if pieces.joining is None or not pieces.joining.search(text):
        return parts
    joined, ends_open = parts[:1], False
    for part in parts[1:]:
        if ends_open or (joined[-1][-1] + part[0]).replace(" ", "▁") in pieces.met:
            joined[-1] += part
            # white space is cut by what follows it
            ends_open = part[-1].isspace()
        else:
            joined.append(part)
    return joined


# ---- the fragment monoid

def _arrays(ids, ends):
    import numpy as np
    return np.asarray(ids, np.int64), np.asarray(ends, np.int64)


def _join(x, y):
    import numpy as np
    return tuple(np.concatenate(p) for p in zip(x, y))


class Fragment:
    """Stretches of A and B tokens as (ids, byte ends): ``pre`` up to and with
    the first common end, ``suf`` after the last.  Without a common end
    (``closed`` false) all tokens are in ``pre``."""

    def __init__(self, closed: bool, pre_a, pre_b, suf_a, suf_b):
        self.closed, self.pre_a, self.pre_b, self.suf_a, self.suf_b = closed, pre_a, pre_b, suf_a, suf_b


def nothing():
    return _arrays([], [])


class Groups:
    """Closed groups in order: tokens, and where each group ends in them."""

    def __init__(self, a, b, cut_a, cut_b):
        self.a, self.b, self.cut_a, self.cut_b = a[0], b[0], cut_a, cut_b
        self.first_end = int(a[1][cut_a[0]]) if len(cut_a) else 0

    def __len__(self):
        return len(self.cut_a)

    def text(self) -> str:
        return ";".join(group_texts(self.a, self.b, self.cut_a, self.cut_b))

    def pairs(self):
        return self.b[self.cut_b] << A_BITS | self.a[self.cut_a]


def group_texts(a, b, cut_a, cut_b) -> list[str]:
    """``a1,a2|b1`` of each group; cuts are the positions of its last tokens."""
    a, b = list(map(str, a.tolist())), list(map(str, b.tolist()))
    out, i, j = [], 0, 0
    for p, q in zip(cut_a.tolist(), cut_b.tolist()):
        out.append(f"{a[i] if p == i else ','.join(a[i:p + 1])}|{b[j] if q == j else ','.join(b[j:q + 1])}")
        i, j = p + 1, q + 1
    return out


def fragment(a, b, closed: bool = False) -> tuple[Groups, Fragment]:
    """Closed groups and fragment of a stretch of each; ``closed`` says that
    the stretches begin at a common end (a text's start is one)."""
    import numpy as np
    _, cut_a, cut_b = np.intersect1d(a[1], b[1], assume_unique=True, return_indices=True)
    pre_a, pre_b = nothing(), nothing()
    if not closed:
        if not len(cut_a):
            return Groups(nothing(), nothing(), cut_a, cut_b), Fragment(False, a, b, nothing(), nothing())
        i, j = cut_a[0] + 1, cut_b[0] + 1
        pre_a, pre_b = (a[0][:i], a[1][:i]), (b[0][:j], b[1][:j])
        a, b = (a[0][i:], a[1][i:]), (b[0][j:], b[1][j:])
        cut_a, cut_b = cut_a[1:] - i, cut_b[1:] - j
    i, j = (cut_a[-1] + 1, cut_b[-1] + 1) if len(cut_a) else (0, 0)
    groups = Groups((a[0][:i], a[1][:i]), (b[0][:j], b[1][:j]), cut_a, cut_b)
    return groups, Fragment(True, pre_a, pre_b, (a[0][i:], a[1][i:]), (b[0][j:], b[1][j:]))


def compose(left: Fragment, right: Fragment) -> tuple[Groups, Fragment]:
    """The groups that close where two neighbours meet, and their fragment."""
    if left.closed:
        groups, met = fragment(_join(left.suf_a, right.pre_a), _join(left.suf_b, right.pre_b), True)
        met.pre_a, met.pre_b = left.pre_a, left.pre_b
    else:
        groups, met = fragment(_join(left.pre_a, right.pre_a), _join(left.pre_b, right.pre_b))
    if right.closed:                # the last common end is the right one's first
        met.suf_a, met.suf_b = right.suf_a, right.suf_b
    return groups, met


# ---- long texts

def _cut(batches, data, size: int):
    """Rows of long texts -> their byte ranges: the characters of both
    stretches, and where each stretch lies in them."""
    import pyarrow as pa
    pieces = pieces_of(data)
    names = ["uid", "doc_id", "i", "text", "a0", "a1", "b0", "b1", "start"]
    for batch in batches:
        for uid, doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            text = " " + text_of(value.as_py())
            n, i, a, b, low, at_byte = len(text), 0, 0, 0, 0, 0
            while min(a, b) < n:
                goal = min((i + 1) * size, n)
                found = _A_BORDER.search(text, goal) if a < goal < n else None
                next_a = a if a >= goal else found.start() if found else n
                next_b = b if b >= goal else pieces.border(text, goal)
                first, last = min(a, b), max(next_a, next_b)
                at_byte += len(text[low:first].encode())
                low = first
                row = [uid, doc_id, i, text[first:last].encode(), a - first, next_a - first, b - first, next_b - first, at_byte]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], pa.binary() if k == "text" else pa.int64()) for k, v in zip(names, row)], names=names)
                a, b, i = next_a, next_b, i + 1


# kinds of rows of long texts
STATE, PIECE, PAIR = 0, 1, 2
_SPANS = ("pre_a", "pre_b", "suf_a", "suf_b")
LONG_ROWS = ("kind int, uid bigint, at bigint, closed boolean, bad boolean, "
             + ", ".join(f"{s}_ids binary, {s}_ends binary" for s in _SPANS)
             + ", piece string, n_a bigint, n_b bigint, n_groups bigint, pair bigint, n bigint")


def _long_rows(uid: int, at: int, state: Fragment | None, bad: bool, groups: list[Groups]):
    """A fragment's row, one of each run of groups, and one a linked pair."""
    import numpy as np
    blank = dict.fromkeys([f.split()[0] for f in LONG_ROWS.split(", ")])
    out = []
    if state is not None:
        row = {**blank, "kind": STATE, "uid": uid, "at": at, "closed": state.closed, "bad": bad}
        for s in _SPANS:
            ids, ends = getattr(state, s)
            row[f"{s}_ids"], row[f"{s}_ends"] = ids.astype("<i8").tobytes(), ends.astype("<i8").tobytes()
        out.append(row)
    for g in groups:
        if not len(g):
            continue
        out.append({**blank, "kind": PIECE, "uid": uid, "at": g.first_end, "piece": g.text(), "n_a": len(g.a),
                    "n_b": len(g.b), "n_groups": len(g)})
        for pair, n in zip(*(v.tolist() for v in np.unique(g.pairs(), return_counts=True))):
            out.append({**blank, "kind": PAIR, "uid": uid, "at": g.first_end, "pair": pair, "n": n})
    return out


def _arrow(rows: list[dict], ddl: str):
    import pyarrow as pa
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))])
    return pa.RecordBatch.from_pylist(rows, schema)


def _ends(ids, size_of, start: int):
    import numpy as np
    return start + np.cumsum(np.array([size_of[i] for i in ids], np.int64))


def _fragments(batches, pattern, data_a, data_b):
    """Byte ranges -> their fragments and closed groups."""
    table, pieces, split = speculate.table_of(data_a), pieces_of(data_b), splitter(pattern)
    size_a, size_b = {i: len(t) for i, t in table.token.items()}, list(map(len, pieces.token))
    for batch in batches:
        rows = batch.to_pylist()
        words = Numbering()
        texts = [text_of(r["text"]) for r in rows]
        cuts = [[words[w] for w in split(t[r["a0"]:r["a1"]])] for r, t in zip(rows, texts)]
        ids_of = speculate.encode_words([w.encode() for w in words], table)[0]
        found_b = pieces.encode([t[r["b0"]:r["b1"]] for r, t in zip(rows, texts)])
        for r, text, cut, ids_b in zip(rows, texts, cuts, found_b):
            ids_a = [i for w in cut for i in ids_of[w]]
            # the bytes of both stretches must be the text's
            bad = (b"".join([table.token[i] for i in ids_a]) != text[r["a0"]:r["a1"]].encode()
                   or b"".join([pieces.token[i] for i in ids_b]) != text[r["b0"]:r["b1"]].encode())
            if bad:
                yield _arrow(_long_rows(r["uid"], r["i"], Fragment(False, *[nothing()] * 4), True, []), LONG_ROWS)
                continue
            starts = [r["start"] + len(text[:r[k]].encode()) for k in ("a0", "b0")]
            groups, state = fragment(_arrays(ids_a, _ends(ids_a, size_a, starts[0])),
                                     _arrays(ids_b, _ends(ids_b, size_b, starts[1])), r["i"] == 0)
            yield _arrow(_long_rows(r["uid"], r["i"], state, False, [groups]), LONG_ROWS)


def _compose_slots(batches, fan: int):
    """One step of the tree: fragments sorted by text and place -> one for
    every ``fan`` neighbours, and the groups that closed."""
    import numpy as np
    held = None

    def done():
        return _arrow(_long_rows(held[0], held[1], held[2], held[3], held[4]), LONG_ROWS)
    for batch in batches:
        for r in batch.to_pylist():
            spans = [tuple(np.frombuffer(r[f"{s}_{k}"], "<i8") for k in ("ids", "ends")) for s in _SPANS]
            state, uid, slot = Fragment(r["closed"], *spans), r["uid"], r["at"] // fan
            if held is not None and held[:2] == [uid, slot]:
                groups, held[2] = compose(held[2], state)
                held[3] = held[3] or r["bad"]
                held[4].append(groups)
            else:
                if held is not None:
                    yield done()
                held = [uid, slot, state, r["bad"], []]
    if held is not None:
        yield done()


def _digests(batches):
    """Pieces sorted by text and place -> digest of their groups, of which
    only the hash state is kept."""
    import pyarrow as pa
    uid, state = None, None
    uids, out = [], []
    for batch in batches:
        for u, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if u == uid:
                state.update(b";" + piece.encode())
                continue
            if state is not None:
                uids.append(uid)
                out.append(state.hexdigest())
            uid, state = u, hashlib.sha256(piece.encode())
    if state is not None:
        uids.append(uid)
        out.append(state.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(out, pa.string())], names=["uid", "groups_sha256"])


def _long_texts(texts: DataFrame, pattern, data_a, data_b, size: int, fan: int):
    """Long texts -> (rows per text without counts, linked pairs per text)."""
    parts = shuffle_parts(texts.sparkSession)
    rows = texts.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    ranges = staged(rows.mapInArrow(partial(_cut, data=data_b, size=size),
                                    "uid bigint, doc_id bigint, i bigint, text binary, a0 bigint, a1 bigint, b0 bigint, "
                                    "b1 bigint, start bigint"), "byte-ranges")
    made = [staged(ranges.repartition(parts, "uid", "i").mapInArrow(
        partial(_fragments, pattern=pattern, data_a=data_a, data_b=data_b), LONG_ROWS), "fragments")]
    places = (ranges.agg(F.max("i")).first()[0] or 0) + 1
    while places > 1:
        state = made[-1].filter(F.col("kind") == STATE).withColumn("slot", F.floor(F.col("at") / fan))
        state = state.repartition(parts, "uid", "slot").drop("slot").sortWithinPartitions("uid", "at")
        made.append(staged(state.mapInArrow(partial(_compose_slots, fan=fan), LONG_ROWS), "fragments"))
        places = -(-places // fan)
    bad = made[-1].filter((F.col("kind") == STATE) & F.col("bad")).select("uid")
    found = made[0]
    for m in made[1:]:
        found = found.unionAll(m)
    found = found.filter(F.col("kind") != STATE).join(bad, "uid", "left_anti")
    pieces = found.filter(F.col("kind") == PIECE)
    digest = pieces.select("uid", "at", "piece").repartition(parts, "uid").sortWithinPartitions("uid", "at").select(
        "uid", "piece").mapInArrow(_digests, "uid bigint, groups_sha256 string")
    totals = pieces.groupBy("uid").agg(*[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups")]).join(digest, "uid")
    known = ranges.filter("i = 0").select("uid", "doc_id").join(totals, "uid", "left")
    return known, found.filter(F.col("kind") == PAIR).select("uid", "pair", "n")


# ---- short texts

PAIRS, STRETCHES, DOCS = 0, 1, 2
BLOCK_ROWS = ("kind int, block bigint, at bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, digest string, "
              "data binary, sizes binary, pair bigint, n bigint")


class _Block:
    def __init__(self):
        self.chars, self.ids, self.numbered, self.found = 0, [], [], Numbering()


def _sizes(found: list[list[int]], flat: list[int], size_of) -> list[int]:
    """Bytes of each list of tokens; ``flat`` are all of them in one list."""
    import numpy as np
    upto = np.concatenate([[0], np.cumsum(size_of[flat])]) if flat else np.zeros(1, np.int64)
    return np.diff(upto[np.cumsum([0, *map(len, found)])]).tolist()


def _aligned(parts: list[str], split, table, pieces):
    """Distinct stretches -> per stretch whether both tokenizers keep its
    bytes, A, B tokens and groups, the groups' text; per link the pair, and
    per stretch the number of links."""
    import numpy as np
    words = Numbering()
    cuts = [[words[s]] if one_word(s) else [words[w] for w in split(s)] for s in parts]
    ids_of: list[list[int]] = []
    listed = [w.encode() for w in words]
    for _, some in in_slices(listed, SLICE):
        ids_of += speculate.encode_words(some, table)[0]
    good = np.zeros(len(parts), bool)
    n_a, n_b, links = (np.zeros(len(parts), np.int64) for _ in range(3))
    texts: list[str] = [""] * len(parts)
    pairs = []
    token_a, token_b = table.token, pieces.token
    size_a = np.zeros(table.size, np.int64)
    size_a[list(token_a)] = [len(t) for t in token_a.values()]
    size_b = np.array([len(t) for t in token_b], np.int64)
    for at, some in in_slices(parts, SLICE):
        found_a = [[i for w in c for i in ids_of[w]] for c in cuts[at:at + len(some)]]
        found_b = pieces.encode(some)
        a, b = list(chain.from_iterable(found_a)), list(chain.from_iterable(found_b))
        raw = [s.encode() for s in some]
        whole = b"".join(raw)
        if (b"".join([token_a[i] for i in a]) == whole == b"".join([token_b[i] for i in b])
                and _sizes(found_a, a, size_a) == _sizes(found_b, b, size_b) == list(map(len, raw))):
            kept = range(len(some))
        else:               # some stretch is not kept as it is: look at each
            kept = [c for c, r in enumerate(raw) if b"".join([token_a[i] for i in found_a[c]]) == r
                    == b"".join([token_b[i] for i in found_b[c]])]
            a = [i for c in kept for i in found_a[c]]
            b = [i for c in kept for i in found_b[c]]
        if not len(kept):
            continue
        kept = np.array(kept)
        counts_a, counts_b = (np.array(list(map(len, f)), np.int64)[kept] for f in (found_a, found_b))
        kept += at
        good[kept], n_a[kept], n_b[kept] = True, counts_a, counts_b
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        # the kept stretches laid end to end: each one's end is a common end
        ends, cut_a, cut_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        last = ends_a[np.cumsum(n_a[kept]) - 1]
        upto = np.searchsorted(ends, last, side="right")
        links[kept] = np.diff(upto, prepend=0)
        pairs.append(b[cut_b] << A_BITS | a[cut_a])
        groups, start = group_texts(a, b, cut_a, cut_b), 0
        for c, e in zip(kept.tolist(), upto.tolist()):
            texts[c] = ";".join(groups[start:e])
            start = e
    return good, n_a, n_b, texts, np.concatenate(pairs) if pairs else np.zeros(0, np.int64), links


def _solve_block(block, number: int, split, table, pieces):
    import numpy as np
    import pyarrow as pa
    parts = list(block.found)
    block.found = Numbering()
    good, n_a, n_b, texts, pairs, links = _aligned(parts, split, table, pieces)
    pair, place = np.unique(pairs, return_inverse=True)
    sound = [bool(len(numbers)) and bool(good[numbers].all()) for numbers in block.numbered]
    counted = [x for x, ok in zip(block.numbered, sound) if ok]
    used = np.bincount(np.concatenate(counted), minlength=len(parts)) if counted else np.zeros(len(parts), np.int64)
    times = np.zeros(len(pair), np.int64)
    np.add.at(times, place, np.repeat(used, links))
    names = [f.split()[0] for f in BLOCK_ROWS.split(", ")]

    def rows(size, **columns):
        kinds = {"kind": pa.int32(), "digest": pa.string(), "data": pa.binary(), "sizes": pa.binary()}
        cols = {k: pa.nulls(size, kinds.get(k, pa.int64())) for k in names}
        cols |= {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in
                 (columns | {"block": [number] * size}).items()}
        return pa.RecordBatch.from_arrays([cols[k] for k in names], names=names)
    real = np.flatnonzero(times)
    for s in range(0, len(real), SLICE):
        some = real[s:s + SLICE]
        yield rows(len(some), kind=[PAIRS] * len(some), at=some, pair=pair[some], n=times[some])
    starts = np.concatenate([[0], np.cumsum(links)])
    for s in range(0, len(parts), SLICE):
        e = min(s + SLICE, len(parts))
        yield rows(1, kind=[STRETCHES], at=[s], data=[place[starts[s]:starts[e]].astype("<u4").tobytes()],
                   sizes=[links[s:e].astype("<u4").tobytes()], n=[len(parts)])
    for s in range(0, len(block.ids), 512):
        some = range(s, min(s + 512, len(block.ids)))
        own = [block.numbered[d] if sound[d] else None for d in some]

        def total(of):
            return [0 if x is None else int(of[x].sum()) for x in own]
        digest = ["" if x is None else hashlib.sha256(";".join([texts[c] for c in x.tolist()]).encode()).hexdigest()
                  for x in own]
        yield rows(len(own), kind=[DOCS] * len(own), at=list(some), doc_id=[block.ids[d] for d in some], n_a=total(n_a),
                   n_b=total(n_b), n_groups=total(links), digest=digest,
                   data=[b"" if x is None else x.astype("<u4").tobytes() for x in own])


def _blocks(batches, pattern, data_a, data_b, block_chars):
    import numpy as np
    from pyspark import TaskContext
    table, pieces, split = speculate.table_of(data_a), pieces_of(data_b), splitter(pattern)
    number = TaskContext.get().partitionId() << 32
    with without_gc():
        block = _Block()
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text_of(value.as_py())
                found = stretches(" " + text, pieces) if text else []
                block.ids.append(doc_id)
                block.numbered.append(np.fromiter(map(block.found.__getitem__, found), np.uint32, len(found)))
                block.chars += len(text)
                if block.chars >= block_chars or block.found.chars >= DISTINCT_CHARS or len(block.ids) >= BLOCK_DOCS:
                    yield from _solve_block(block, number, split, table, pieces)
                    block, number = _Block(), number + 1
        if block.ids:
            yield from _solve_block(block, number, split, table, pieces)


OUT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _add_counts(batches):
    """Rows sorted by block: its pairs' counts, then its stretches, then its
    documents, whose counts are added up."""
    import numpy as np
    import pyarrow as pa
    block, pairs, sums, best = None, {}, None, None
    for batch in batches:
        ids = {k: [] for k in (f.split()[0] for f in OUT.split(", "))}
        for r in batch.to_pylist():
            if r["block"] != block:
                block, pairs, sums = r["block"], {}, None
            if r["kind"] == PAIRS:
                pairs[r["at"]] = r["pair"], r["n"]
            elif r["kind"] == STRETCHES:
                if sums is None:
                    sums, best = (np.zeros(r["n"], np.int64) for _ in range(2))
                place, sizes = (np.frombuffer(r[k], "<u4").astype(np.int64) for k in ("data", "sizes"))
                # pairs of unsound documents alone have no count and are not asked for
                got = np.array([pairs.get(p, (0, 0)) for p in place.tolist()], np.int64).reshape(-1, 2)
                owner = np.repeat(np.arange(len(sizes)), sizes) + r["at"]
                np.add.at(sums, owner, got[:, 0])
                np.add.at(best, owner, got[:, 1])
            else:
                numbers = np.frombuffer(r["data"], "<u4")
                for k in ("doc_id", "n_a", "n_b", "n_groups"):
                    ids[k].append(r[k])
                ids["n_links"].append(r["n_groups"])
                ids["n_best"].append(int(best[numbers].sum()) if len(numbers) else 0)
                ids["count_sum"].append(int(sums[numbers].sum()) if len(numbers) else 0)
                ids["groups_sha256"].append(r["digest"])
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k == "groups_sha256" else pa.int64())
                                          for k, v in ids.items()], names=list(ids))


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n) rows of any parts of the corpus -> (pair, total, best): the
    corpus-wide count, and whether no other A id is linked more often with the
    pair's B id."""
    total = links.groupBy("pair").agg(F.sum("n").alias("total"))
    total = staged(total.withColumn("b", F.shiftright("pair", A_BITS)), "pair-counts")
    top = total.groupBy("b").agg(F.max("total").alias("top"))
    return total.join(top, "b").select("pair", "total", (F.col("total") == F.col("top")).cast("bigint").alias("best"))


def align(docs: DataFrame, tokenizer_path: str, pieces_path: str, pattern: str, long_bytes: int = LONG_BYTES,
          range_chars: int = RANGE_CHARS, fan: int = FAN, block_chars: int = BLOCK_CHARS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_a and n_b (tokens), n_groups, n_links,
    n_best (links whose pair is the corpus-wide most frequent one of its B id,
    ties included), count_sum (the corpus-wide counts of all links added up)
    and groups_sha256 (of ``a1,a2|b1;a3|b2,b3``).

    Special tokens' strings are plain text.  Null and empty texts, and those of
    which one tokenizer does not keep the bytes, have zeros and an empty
    digest, and their links count nowhere.  Bytes that are no UTF-8 count as
    U+FFFD.  Null and repeated ids stay as they are.  Texts of more than
    ``long_bytes`` bytes are worked on as ranges of about ``range_chars``
    characters by many tasks; only their digest, which is sequential, is
    computed in one stream.  A range without a border inside extends to the
    next one.  Other columns are not read."""
    spark = docs.sparkSession
    data_a, data_b = speculate.load_tokenizer(spark, tokenizer_path), load_pieces(spark, pieces_path)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    is_long = F.coalesce(F.octet_length("text") > long_bytes, F.lit(False))
    parts = shuffle_parts(spark)
    short = staged(rows.filter(~is_long).mapInArrow(
        partial(_blocks, pattern=pattern, data_a=data_a, data_b=data_b, block_chars=block_chars), BLOCK_ROWS), "aligned")
    known, long_pairs = _long_texts(rows.filter(is_long), pattern, data_a, data_b, range_chars, fan)
    own = short.filter(F.col("kind") == PAIRS)
    counts = staged(pair_counts(own.select("pair", "n").unionAll(long_pairs.select("pair", "n"))), "pair-counts")
    back = own.select("kind", "block", "at", "pair").join(counts, "pair").select(
        "kind", "block", "at", F.lit(None).cast("bigint").alias("doc_id"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("n_a", "n_b", "n_groups")], F.lit(None).cast("string").alias("digest"),
        F.lit(None).cast("binary").alias("data"), F.lit(None).cast("binary").alias("sizes"), F.col("total").alias("pair"),
        F.col("best").alias("n"))
    rest = short.filter(F.col("kind") != PAIRS)
    shorts = (back.unionAll(rest).repartition(parts, "block").sortWithinPartitions("block", "kind", "at")
              .mapInArrow(_add_counts, OUT))
    summed = long_pairs.join(counts, "pair").groupBy("uid").agg(
        F.sum(F.col("n") * F.col("best")).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum"))
    longs = known.join(summed, "uid", "left").select(
        "doc_id", *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ("n_a", "n_b", "n_groups")],
        F.coalesce(F.col("n_groups"), F.lit(0).cast("bigint")).alias("n_links"),
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ("n_best", "count_sum")],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return shorts.unionAll(longs)
