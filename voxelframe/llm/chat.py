"""Chat formatting in budgeted windows.

Prefix sums of turn tokens place every turn on its conversation's token line.
A turn's tokens are those of its formatted form: marks, role and escaped text.
The line is cut into cells of ``span`` tokens; a window holds the turns that
lie in one cell, and a turn that crosses a cell border has a window of its
own.  A window starts with the conversation's system turn and the turns of the
last ``history`` tokens before it.  The system turn comes first out of the
budget, history gets at most half of what it leaves, the cell the rest, and a
turn with a window of its own leaves history what then remains: every window
keeps to the budget unless the system turn and one turn alone do not fit it.
Repeated turns are never learned: the loss mask covers the texts of the
window's own assistant turns alone.

A turn's cell follows from its prefix sum, and a cell needs rows of the cell
before at most, so a long conversation is formatted by many tasks.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from voxelframe.llm.bpe import load_ranks, read_ranks
from voxelframe.llm.common import group_slices, shuffle_parts, staged

BUDGET = 1024
HISTORY = 256
MIN_SPAN = 256
SYSTEM, LEARNED = "system", "assistant"

_CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    """The text with a backslash put into every control string, and one more
    into every string that already looks so: nothing reads as a mark."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]], context: int) -> tuple[str, list[int], list[int]]:
    """Formatted window, and start and length (code points) of the texts under
    the loss mask; the first ``context`` turns are repeated ones."""
    parts, starts, sizes, at = [], [], [], 0
    for i, (role, text) in enumerate(turns):
        head, body = f"<s>[INST]{escape(role)}[/INST]", escape(text)
        if i >= context and role == LEARNED:
            starts.append(at + len(head))
            sizes.append(len(body))
        parts += [head, body, "</s>"]
        at += len(head) + len(body) + 4
    return "".join(parts), starts, sizes


def parse(window: str) -> list[tuple[str, str]]:
    """The turns of a formatted window."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(window)]


_ENCODERS: dict = {}


def _encoder(data, pattern):
    import tiktoken
    key = (hash(data.value), pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=read_ranks(data.value),
                                           special_tokens={})
    return _ENCODERS[key].encode_ordinary


def _measure(batches, data, pattern: str):
    """Token counts and running sums of a partition sorted by conversation."""
    import pyarrow as pa
    from pyspark import TaskContext
    part, encode = TaskContext.get().partitionId(), _encoder(data, pattern)
    conv, start, place = None, 0, 0
    for b in batches:
        counts, starts, places = [], [], []
        for c, role, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
            if c != conv or not places and conv is None:
                conv, start, place = c, 0, 0
            # turns put together have no more tokens: only marks meet there
            n = len(encode(render([(role, text)], 0)[0]))
            counts.append(n)
            starts.append(start)
            places.append(place)
            start += n
            place += 1
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([part] * len(counts), pa.int32()), pa.array(counts, pa.int64()),
             pa.array(starts, pa.int64()), pa.array(places, pa.int64())],
            names=[*b.schema.names, "part", "n_tokens", "start", "place"])


def _format(batches, budget: int):
    import pyarrow as pa
    for t in group_slices(batches):
        cells: dict = {}
        for row in t.select(range(1, t.num_columns)).to_pylist():
            cells.setdefault((row["conv"], row["cell"]), []).append(row)
        out = []
        for (conv, cell), rows in cells.items():
            system = [r for r in rows if r["kind"] == 0]
            turns = sorted((r for r in rows if r["kind"] == 1), key=lambda r: r["place"])
            own = [r for r in turns if r["home"] == cell]
            groups = [(0, [r for r in own if not r["crosses"]]), (1, [r for r in own if r["crosses"]])]
            groups = [(g, rs) for g, rs in groups if rs] or ([(0, [])] if system and cell == 0 else [])
            for place, (g, rs) in enumerate(groups):
                opening = cell == 0 and place == 0
                taken = sum(r["n_tokens"] for r in (*system, *rs))
                reach = min(rs[0]["reach"], budget - taken) if rs else 0
                past = [r for r in turns if rs and r["place"] < rs[0]["place"] and r["start"] >= rs[0]["start"] - reach]
                window = [*system, *past, *rs]
                context = len(past) + (0 if opening else len(system))
                if opening and system:
                    context = 0
                text, starts, sizes = render([(r["role"], r["text"]) for r in window], context)
                out.append((conv, 2 * cell + g, text, context, starts, sizes, sum(r["n_tokens"] for r in window)))
        if out:
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
            names = ["conv", "window", "formatted", "context_turns", "loss_start", "loss_size", "n_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def format_windows(conversations: DataFrame, ranks_path: str, pattern: str, budget: int = BUDGET,
                   history: int = HISTORY) -> DataFrame:
    """(conv_id, window, formatted, context_turns, loss_start, loss_size,
    n_tokens, over_budget), one row per window, windows in order of number.

    Turns are ordered by turn, role and a hash of the text (null turns first);
    repeated rows are turns of their own.  ``n_tokens`` are the window's tokens
    turn by turn; its text as a whole has no more.  ``over_budget`` says that
    the system turn and a single turn are more than the budget.  Null texts and roles count as empty, rows with a null
    conv_id form one conversation.  The first turn is kept in every window if
    its role is system; the first ``context_turns`` turns of a window are
    repeated ones.  Loss offsets are code points of ``formatted``.  Columns
    other than conv_id, turn, role and text are not read."""
    spark = conversations.sparkSession
    if not 0 <= history <= MIN_SPAN or budget < MIN_SPAN + history:
        raise ValueError("history is at most the least span, and both fit the budget")
    data = load_ranks(spark, ranks_path)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.select(F.coalesce(F.col("conv_id").cast("bigint").cast("string"), F.lit("none")).alias("conv"),
                                F.col("turn").cast("bigint").alias("turn"),
                                F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    order = ["conv", "turn", "role", "mark"]
    rows = (rows.withColumn("mark", F.xxhash64("text")).repartitionByRange(shuffle_parts(spark), *order)
            .sortWithinPartitions(*order, "text").select("conv", "turn", "role", "text"))
    rows = staged(rows.mapInArrow(partial(_measure, data=data, pattern=pattern), "conv string, turn bigint, role string, "
                  "text string, part int, n_tokens bigint, start bigint, place bigint"), "turns")
    # a conversation's sums over the partitions before
    sums = rows.groupBy("conv", "part").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))
    ahead = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("conv", "part", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("tokens_before"),
                       F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("rows_before"))
    sums = staged(sums, "token-sums")
    line = rows.join(sums, ["conv", "part"]).select(
        "conv", "role", "text", "n_tokens", (F.col("start") + F.col("tokens_before")).alias("start"),
        (F.col("place") + F.col("rows_before")).alias("place"))
    lead = (F.col("place") == 0) & (F.col("role") == SYSTEM)
    system = line.filter(lead).select("conv", F.col("n_tokens").alias("system_tokens"))
    left = F.greatest(F.lit(budget) - F.coalesce("system_tokens", F.lit(0)), F.lit(0))
    reach = F.least(F.lit(history), F.floor(left / 2))
    span = F.greatest(left - F.col("reach"), F.lit(1))
    begin = F.col("start") - F.coalesce("system_tokens", F.lit(0))
    turns = (line.filter(~lead).join(system, "conv", "left").withColumn("reach", reach.cast("bigint"))
             .withColumn("span", span).withColumn("start", begin)
             .withColumn("home", F.floor(F.col("start") / F.col("span")))
             .withColumn("crosses", F.floor((F.col("start") + F.col("n_tokens") - 1) / F.col("span")) > F.col("home")))
    # the next cell repeats a turn that starts within its history
    follows = (F.col("home") + 1) * F.col("span") - F.col("start") <= F.col("reach")
    cells = F.when(follows, F.array(F.col("home"), F.col("home") + 1)).otherwise(F.array("home"))
    columns = ["conv", "cell", "kind", "home", "crosses", "role", "text", "n_tokens", "start", "place", "reach"]
    turns = turns.withColumn("cell", F.explode(cells)).withColumn("kind", F.lit(1)).select(*columns)
    used = turns.filter("cell = home").select("conv", "cell").distinct().unionAll(
        line.filter(lead).select("conv", F.lit(0).cast("bigint"))).distinct()
    leads = line.filter(lead).join(used, "conv").select(
        "conv", "cell", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("home"), F.lit(False).alias("crosses"),
        "role", "text", "n_tokens", "start", "place", F.lit(0).cast("bigint").alias("reach")).select(*columns)
    both = turns.unionByName(leads).select(F.xxhash64("conv", "cell").alias("cell_key"), *columns)
    windows = (both.repartition("cell_key").sortWithinPartitions("cell_key")
               .mapInArrow(partial(_format, budget=budget), "conv string, window bigint, formatted string, context_turns int, "
                           "loss_start array<bigint>, loss_size array<bigint>, n_tokens bigint"))
    return windows.select(F.expr("cast(nullif(conv, 'none') as bigint)").alias("conv_id"), "window", "formatted",
                          "context_turns", "loss_start", "loss_size", "n_tokens",
                          (F.col("n_tokens") > budget).alias("over_budget"))


def _read_back(batches):
    """Digests of conversations sorted by window; one hash state at a time."""
    import hashlib
    import pyarrow as pa
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now, seen = None, False

    def new(conv):
        return {"conv": conv, "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0}

    def row(s):
        return (s["conv"], s["n"], s["turns"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["all"])

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    for b in batches:
        done = []
        for r in b.to_pylist():
            if not seen or r["conv_id"] != now["conv"]:
                if seen:
                    done.append(row(now))
                now, seen = new(r["conv_id"]), True
            text = r["formatted"]
            for role, said in parse(text)[r["context_turns"]:]:
                now["n"] += 1
                now["turns"].update(f"{role}\n{said}\n".encode())
            for at, size in zip(r["loss_start"], r["loss_size"]):
                learned = unescape(text[at:at + size])
                now["chars"] += len(learned)
                now["loss"].update(learned.encode())
            now["all"] += len(text)
        if done:
            yield batch(done)
    if seen:
        yield batch([row(now)])


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars): each conversation parsed from its windows.  A digest is
    sequential, so a conversation's windows pass one task as a stream that
    keeps only the hash states."""
    return (windows.select("conv_id", "window", "formatted", "context_turns", "loss_start", "loss_size")
            .repartition("conv_id").sortWithinPartitions("conv_id", "window")
            .mapInArrow(_read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                    "loss_sha256 string, formatted_chars bigint"))
