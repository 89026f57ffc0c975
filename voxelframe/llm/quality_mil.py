"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  A passage is described
by the shares of its hashed word shapes, the shares of its hashed pairs of
neighbouring letters and a few character statistics, and encoded by a learned
layer; gated attention weights the passages of a bag, and the weighted sum of
their codes gives the document's score.  Labels exist for documents only:
encoder, attention and score are learned together from them.  So that letters
count, not only their classes, some of the learned documents of label 1 are
learned a second time, as label 0, with their letters replaced at random.

Fitting uses a bounded sample of labelled documents in one task; scoring runs
over whole texts, every passage of every document.
"""

from __future__ import annotations

import re
import zlib
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelframe.llm.common import crc_text

PASSAGE = 64
SHAPES = 56
STATS = 8
PAIRS = 64
WIDTH = SHAPES + STATS + PAIRS
CODE, GATE = 24, 12
# bounds of the learning sample: documents, and bytes of each
MAX_DOCS = 4000
MAX_BYTES = 32_000
EPOCHS, BAGS, RATE, DECAY = 12, 32, 0.01, 1e-4
SEED = 5
CACHE = 400_000
# words described at once
SLICE = 20_000
THRESHOLD = 0.7
# one of so many learned documents of label 1, of at least so many words, is
# learned with its letters replaced too
SCRAMBLED, SCRAMBLED_WORDS = 4, 8

_RUNS = re.compile(r"(.)\1+")


class _Marks(dict):
    """Character -> its class: X, x, 9, or itself (white space too)."""

    def __missing__(self, code):
        c = chr(code)
        mark = "9" if c.isdigit() else ("X" if c.isupper() else "x") if c.isalpha() else c
        self[code] = ord(mark)
        return self[code]


_MARKS = _Marks()


def word_vectors(words: list[str]):
    """A row a word of counts that add up over a passage: its hashed shape (the
    character classes, runs collapsed), lengths and shares of classes, and the
    shares of its hashed letter pairs, word ends included."""
    import numpy as np
    out = np.zeros((len(words), WIDTH))
    line = " ".join(words)
    marks = line.translate(_MARKS)
    shapes = _RUNS.sub(r"\1+", marks).replace("X+", "X").replace("x+", "x").split(" ")
    bucket = {s: zlib.crc32(s.encode("utf-8", "replace")) % SHAPES for s in set(shapes)}
    out[np.arange(len(words)), [bucket[s] for s in shapes]] = 1

    def points(text):
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(n + 1)[:-1]])
    m = np.append(points(marks), ord(" "))          # every word ends in a space

    def count(mark):
        return np.add.reduceat((m == ord(mark)).astype(np.int64), starts)
    upper = count("X")
    letters = upper + count("x")
    stats = (n / 10, letters / n, upper / n, count("9") / n, (n - letters) / n, letters == 0, n > 20,
             (upper == letters) & (letters > 1))
    out[:, SHAPES:SHAPES + STATS] = np.minimum(np.stack(stats, 1), 10)
    # lower case may change a word's length, so words are told apart by their spaces
    c = points(f" {line.lower()} ").astype(np.uint64)
    # odd multipliers spread neighbouring code points over the buckets
    pair = (c[:-1] * np.uint64(2654435761) + c[1:] * np.uint64(2246822519)) >> np.uint64(15)
    space = c == ord(" ")
    owner = np.cumsum(space[:-1]) - 1
    # the pair that starts at a space begins a word, the one that ends at a space ends it
    counts = np.bincount(owner * PAIRS + (pair % np.uint64(PAIRS)).astype(np.int64), minlength=len(words) * PAIRS)
    counts = counts.reshape(len(words), PAIRS)
    out[:, SHAPES + STATS:] = counts / counts.sum(1, keepdims=True)
    return out


def scrambled(text: str, seed: int) -> str:
    """The text with every letter replaced by a random one of its case."""
    import random
    rng = random.Random(seed)
    return "".join([(chr(rng.randrange(65, 91)) if c.isupper() else chr(rng.randrange(97, 123))) if c.isalpha() else c
                    for c in text])


class Passages:
    """Passage descriptions of texts, or their image under ``projection``.
    Vectors of words seen before are kept in a table of at most ``CACHE``."""

    def __init__(self, projection=None):
        import numpy as np
        self.projection = projection
        self.width = WIDTH if projection is None else projection.shape[1]
        self.of: dict[str, int] = {}
        self.table = np.zeros((1024, self.width), np.float32)

    def learn(self, words: list[str]) -> None:
        """Enter words that are not in the table."""
        import numpy as np
        new = [w for w in dict.fromkeys(words) if w not in self.of]
        if not new:
            return
        at = len(self.of)
        while at + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for k in range(0, len(new), SLICE):
            v = word_vectors(new[k:k + SLICE])
            self.table[at + k:at + k + len(v)] = v if self.projection is None else v @ self.projection
        self.of.update(zip(new, range(at, at + len(new))))

    def of_texts(self, texts: list[str]) -> list:
        """Per text the matrix of its passages; one of zeros without words."""
        import numpy as np
        if len(self.of) > CACHE:
            self.__init__(self.projection)
        split = [t.split() for t in texts]
        self.learn([w for words in split for w in words])
        out = []
        for words in split:
            if not words:
                out.append(np.zeros((1, self.width), np.float32))
                continue
            numbers = np.fromiter(map(self.of.__getitem__, words), np.int64, len(words))
            starts = np.arange(0, len(words), PASSAGE)
            sums = np.add.reduceat(self.table[numbers], starts, axis=0)
            out.append(sums / np.diff(starts, append=len(words))[:, None].astype(np.float32))
        return out


def _attend(model, h, starts):
    """Gated attention over the passage codes ``h`` of bags that begin at
    ``starts``: gate parts, weights, bag codes and scores."""
    import numpy as np
    sizes = np.diff(starts, append=len(h))
    t, g = np.tanh(h @ model["V"]), 1 / (1 + np.exp(-np.clip(h @ model["U"], -30, 30)))
    e = (t * g) @ model["w"]
    a = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a /= np.repeat(np.add.reduceat(a, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    s = z @ model["beta"] + model["c"]
    return t, g, a, z, 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def _gradient(model, x, starts, y):
    """Gradients of the mean log-loss of bags of standardised passages."""
    import numpy as np
    bag = np.repeat(np.arange(len(y)), np.diff(starts, append=len(x)))
    h = np.tanh(x @ model["W"] + model["b"])
    t, g, a, z, p = _attend(model, h, starts)
    d = (p - y) / len(y)
    grad = {"beta": z.T @ d, "c": d.sum()}
    dz = d[:, None] * model["beta"]
    da = (dz[bag] * h).sum(1)
    de = a * (da - np.bincount(bag, a * da, len(y))[bag])
    dtg = de[:, None] * model["w"]
    grad["w"] = (t * g).T @ de
    dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
    grad["V"], grad["U"] = h.T @ dt, h.T @ dg
    dh = (a[:, None] * dz[bag] + dt @ model["V"].T + dg @ model["U"].T) * (1 - h * h)
    grad["W"], grad["b"] = x.T @ dh, dh.sum(0)
    return grad


def train(bags: list, labels) -> dict:
    """Adam on the document log-loss; seeded, so the same sample gives the
    same model."""
    import numpy as np
    rng = np.random.default_rng(SEED)
    y = np.asarray(labels, np.float64)
    every = np.concatenate(bags)
    mean, scale = every.mean(0).astype(np.float64), every.std(0).astype(np.float64) + 1e-2
    bags = [(b - mean) / scale for b in bags]
    model = {"W": rng.normal(0, WIDTH ** -0.5, (WIDTH, CODE)), "b": np.zeros(CODE),
             "V": rng.normal(0, CODE ** -0.5, (CODE, GATE)), "U": rng.normal(0, CODE ** -0.5, (CODE, GATE)),
             "w": rng.normal(0, GATE ** -0.5, GATE), "beta": np.zeros(CODE), "c": 0.0}
    learned = list(model)
    m, v = ({k: np.zeros_like(model[k]) for k in learned} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BAGS):
            some = order[at:at + BAGS]
            starts = np.cumsum([0, *(len(bags[i]) for i in some[:-1])])
            grad = _gradient(model, np.concatenate([bags[i] for i in some]), starts, y[some])
            step += 1
            for k in learned:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                rate = RATE * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
                model[k] = model[k] - rate * m[k] / (v[k] ** 0.5 + 1e-8) - RATE * DECAY * model[k]
    return model | {"mean": mean, "scale": scale}


class Scorer:
    """A fitted model ready for texts: the encoder's linear part is applied to
    the word table, so a passage is an average of short rows."""

    def __init__(self, model):
        import numpy as np
        linear = model["W"] / model["scale"][:, None]
        self.shift = model["b"] - model["mean"] @ linear
        self.passages = Passages(linear)
        self.model = model

    def __call__(self, texts: list[str]):
        import numpy as np
        out = [np.zeros(0)]
        for at in range(0, len(texts), 64):
            bags = self.passages.of_texts(texts[at:at + 64])
            starts = np.cumsum([0, *map(len, bags[:-1])])
            h = np.tanh(np.concatenate(bags) + self.shift)
            out.append(_attend(self.model, h, starts)[-1])
        # the last digits depend on which documents share a matrix product
        return np.round(np.concatenate(out), 9)


def _encode_sample(batches):
    import numpy as np
    import pyarrow as pa
    passages = Passages()
    for b in batches:
        rows = []
        for i, label, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            text = (value.as_py() or b"").decode("utf-8", "replace")
            rows.append((i, label, passages.of_texts([text])[0]))
            if label == 1 and zlib.crc32(str(i).encode()) >> 2 & 0xFFFF < (1 << 16) // SCRAMBLED and len(text.split()) >= SCRAMBLED_WORDS:
                rows.append((i, 0, passages.of_texts([scrambled(text, i)])[0]))
        ids, labels, bags = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in bags], pa.binary())],
            names=["doc_id", "label", "bag"])


def _train_sample(batches):
    import pickle
    import numpy as np
    import pyarrow as pa
    rows = [(i, y, np.frombuffer(x, np.float32).reshape(-1, WIDTH))
            for b in batches for i, y, x in zip(*(b.column(c).to_pylist() for c in range(3)))]
    rows.sort(key=lambda r: (r[0], r[1], len(r[2]), r[2].tobytes()))
    kinds = {r[1] for r in rows}
    model = train([r[2] for r in rows], [r[1] for r in rows]) if len(kinds) == 2 else kinds.pop() if kinds else None
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)])], names=["model"])


def held_out(id_col: Column) -> Column:
    """Rows never learned from: CRC-32 of the id's text has remainder 2 by 4."""
    return crc_text(id_col) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """A model from at most ``max_docs`` labelled documents of at most
    ``max_bytes`` bytes each, those with the smallest hash of the id; held-out
    ids are never learned from.

    Labels other than 0 and 1, null ids and ids with both labels are ignored;
    of repeated ids the smallest text is learned.  Returns the model, the only
    label there is as a number, or None without any usable label."""
    import pickle
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    texts = rows.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes)
    known = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).cast("bigint").alias("doc_id"))
             .agg(F.min(label_col).alias("label"), F.max(label_col).alias("other")).filter("label = other"))
    # places go to documents that are there and not too long
    chosen = (known.select("doc_id", F.col("label").cast("int").alias("label")).join(texts.select("doc_id"), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(max_docs))
    # at most max_docs rows are sent
    sample = (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
              .agg(F.min(F.coalesce("text", F.lit(b""))).alias("text")))
    encoded = sample.mapInArrow(
        _encode_sample, "doc_id bigint, label int, bag binary")
    row = encoded.coalesce(1).mapInArrow(_train_sample, "model binary").first()
    return pickle.loads(bytes(row["model"]))


def _score(batches, model):
    import numpy as np
    import pyarrow as pa
    scorer = Scorer(model) if isinstance(model, dict) else None
    for b in batches:
        texts = [(t.as_py() or b"").decode("utf-8", "replace") for t in b.column(b.num_columns - 1)]
        scores = scorer(texts) if scorer else np.full(len(texts), 0.5 if model is None else float(model))
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())],
                                         names=[*b.schema.names[:-1], "score"])


def score(docs: DataFrame, model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    score estimates the probability of label 1 from the whole text alone; null
    and empty texts are scored as a bag with one empty passage.  predicted is
    1 if score >= ``threshold``.  Without labels every score is 0.5; with one
    kind of label it is that label.  Null and repeated ids stay; other columns
    are not read."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    scored = rows.mapInArrow(partial(_score, model=model), "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def _keep(batches, model, threshold: float, at: int):
    import pyarrow as pa
    scorer = Scorer(model)
    for b in batches:
        scores = scorer(["" if t is None else t for t in b.column(at).to_pylist()])
        yield b.filter(pa.array(scores >= threshold))


def keep_good(docs: DataFrame, model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, all columns
    kept, filtered while they are read.  Without a fitted model all stay."""
    if not isinstance(model, dict):
        return docs if model is None or model >= threshold else docs.limit(0)
    return docs.mapInArrow(partial(_keep, model=model, threshold=threshold, at=docs.columns.index(text_col)), docs.schema)
