"""Chat formatting in budgeted, turn-aligned windows.

The turns of a conversation are rendered between marks, and cut into windows of at most `budget`
tokens. A window holds the system turn, as many of the turns before as `history` tokens allow, and new
turns. Prefix sums of the turns' tokens say where each part begins and ends. A loss mask covers the
texts of the new assistant turns; what a window repeats is not under it, so each assistant text is a
target once.

A conversation of any length is taken: rows are sorted by ranges, so that a long one lies in many
tasks, its prefix sums are carried from range to range, and windows begin anew every SEGMENT budgets.
A segment, with the system turn and the history that leads up to it, is all that a task holds at a time.

Inside a text a backslash, and a `<` that could begin a mark, get a backslash before them, and so does
a `>` of a role; taking one backslash off gives the text back.

Cases: a null text or role is an empty one. Turns are in order of their number, null first, then of
role and of the hash of their text; repeated rows are turns of their own. Rows without a conversation
id are one conversation. The first turn is the system turn if its role is `system`; if it has more
than a quarter of the budget it is not repeated. A turn that does not fit with the system turn is
alone with it in a window over the budget (`fits` is false); no text is cut. No rows give no windows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailsight.llm.common import small, written
from trailsight.llm.token_ids import encoder

BUDGET, HISTORY, SEGMENT = 1024, 256, 64
#: Turns of a range, about.
RANGE_TURNS = 20_000
TARGET, SYSTEM = "assistant", "system"
CLOSE = "\n</turn>\n"
WINDOWS = "conv_id long, first_turn long, n_turns int, n_repeated int, n_tokens long, fits boolean, text string, loss array<struct<start:int,stop:int>>"
_IN_TEXT, _IN_ROLE, _OUT = re.compile(r"\\|<(?=/?turn)"), re.compile(r"[\\<>]"), re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n(.*?)\n</turn>\n", re.S)


def opening(role: str) -> str:
    return f"<turn {_IN_ROLE.sub(r'\\\g<0>', role)}>\n"


def escaped(text: str) -> str:
    return _IN_TEXT.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return _OUT.sub(r"\1", text)


def turns_of(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a window's text; an error if it is anything but turns."""
    found, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        at = m.end()
        found.append((unescaped(m[1]), unescaped(m[2])))
    if at != len(text):
        raise ValueError(f"not a turn at {at}")
    return found


def spans(before: np.ndarray, size: np.ndarray, own: int, system: int, budget: int, history: int, has_system: bool) -> list[tuple[int, int, int]]:
    """(first repeated, first new, end) of each window over the turns of a segment.

    `before`: tokens before each turn; `own`: the first turn that is not only history; `system`: tokens of
    the system turn. With `has_system` turn 0 is the system turn itself, which no history repeats.
    """
    out, i, after = [], own, before + size
    while i < len(before):
        first = i == 0 and has_system
        room = budget - (0 if first else system)
        most = max(before[i] - history, after[i] - room)
        lead = min(i, max(int(np.searchsorted(before, most)), int(has_system and not first)))
        end = max(i + 1, int(np.searchsorted(after, before[lead] + room, side="right")))
        out.append((lead, i, end))
        i = end
    return out


def sized(rows: DataFrame, tokenizer: str) -> DataFrame:
    """The turns in order, as a written table: part (range), n (tokens), and `nth` and `upto`, turns and
    tokens of the conversation that come before in its range."""
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text")]
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    dealt = rows.repartitionByRange(max(1, -(-rows.count() // RANGE_TURNS)), *keys).sortWithinPartitions(*keys)
    dealt = dealt.withColumn("part", F.spark_partition_id().cast("long"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, marks = encoder(tokenizer, True), {}
        now, n, upto = (), 0, 0
        for b in batches:
            sizes, nth, before = [], [], []
            for conv, role, text in zip(b["conv_id"].to_pylist(), b["role"].to_pylist(), b["text"].to_pylist(), strict=True):
                if now != (conv,):
                    now, n, upto = (conv,), 0, 0
                if role not in marks:
                    marks = {} if len(marks) > 1000 else marks
                    marks[role] = sum(len(x) for x in code.encode([opening(role), CLOSE]))
                nth.append(n)
                before.append(upto)
                sizes.append(marks[role] + len(next(code.encode([escaped(text)]))))
                n, upto = n + 1, upto + sizes[-1]
            more = [pa.array(c, pa.int64()) for c in (sizes, nth, before)]
            yield pa.record_batch([*b.columns, *more], names=[*b.schema.names, "n", "nth", "upto"])
        code.forget()

    return written(dealt.mapInArrow(count, "conv_id long, turn long, role string, text string, part long, n long, nth long, upto long"))


def placed(turns: DataFrame) -> DataFrame:
    """The sized turns with nth and upto counted over the whole conversation."""
    ranges = turns.groupBy("conv_id", "part").agg(F.count("*").alias("turns"), F.sum("n").alias("tokens"))
    ranges = written(ranges)
    many = ranges.groupBy("conv_id").agg(F.count("*").alias("ranges")).where("ranges > 1").select(F.col("conv_id").alias("_conv"))
    ranges = ranges.join(many, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    # One row for each range that a conversation lies in.
    by = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.sum("turns").over(by).alias("_turns"), F.sum("tokens").over(by).alias("_tokens"))
    carried = small(written(carried), 40)
    rows = turns.join(carried, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")), "left")
    nth, upto = F.col("nth") + F.coalesce("_turns", F.lit(0)), F.col("upto") + F.coalesce("_tokens", F.lit(0))
    return rows.select("conv_id", "role", "text", "n", nth.alias("nth"), upto.alias("upto"))


def segments(turns: DataFrame, budget: int, history: int, segment: int) -> DataFrame:
    """The placed turns by segment; kind 2. With them, for each segment after the first, the system turn
    (kind 0) and the turns that can be its history (kind 1)."""
    length = segment * budget
    turns = turns.withColumn("seg", F.expr(f"upto div {length}"))
    own = turns.withColumn("kind", F.lit(2))
    lead = turns.where((F.col("seg") + 1) * length - F.col("upto") <= history).withColumn("seg", F.col("seg") + 1).withColumn("kind", F.lit(1))
    system = turns.where((F.col("nth") == 0) & (F.col("role") == SYSTEM) & (4 * F.col("n") <= budget)).drop("seg")
    later = turns.where("seg > 0").select(F.col("conv_id").alias("_conv"), "seg").distinct()
    system = system.join(later, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv").withColumn("kind", F.lit(0))
    return own.unionByName(lead).unionByName(system)


def windows(conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY, segment: int = SEGMENT) -> DataFrame:
    """The windows of all conversations: conv_id, first_turn (place of the first new turn; windows of a
    conversation are in its order), n_turns, n_repeated (turns at the head that are repeated), n_tokens,
    fits, text, and loss (spans of code points)."""
    if not 0 <= history < budget <= segment * budget:
        raise ValueError("history must be less than the budget, and a segment at least one budget")
    turns = written(placed(sized(conversations, tokenizer)))
    rows = segments(turns, budget, history, segment)
    parts = max(1, -(-turns.count() // RANGE_TURNS))
    keys = ("conv_id", "seg", F.col("kind") > 0, "nth")
    dealt = rows.repartition(parts, "conv_id", "seg").sortWithinPartitions(*keys)

    def render(conv, group: list[tuple]) -> Iterator[tuple]:
        system = next((r for r in group if r[0] == 0), None)
        rows = [r for r in group if r[0]]
        own = sum(r[0] == 1 for r in rows)
        first = rows[0] if own < len(rows) and rows[own][1] == 0 else None
        inside = bool(first and first[3] == SYSTEM and 4 * first[2] <= budget)
        system = first if inside else system
        before = np.array([r[5] for r in rows], dtype=np.int64)
        size = np.array([r[2] for r in rows], dtype=np.int64)
        for lead, i, end in spans(before, size, own, system[2] if system else 0, budget, history, inside):
            shown = ([system] if system and not (inside and i == 0) else []) + rows[lead:end]
            repeated = len(shown) - (end - i)
            out, loss, at = [], [], 0
            for k, r in enumerate(shown):
                head, body = opening(r[3]), escaped(r[4])
                if k >= repeated and r[3] == TARGET:
                    loss.append({"start": at + len(head), "stop": at + len(head) + len(body)})
                out += (head, body, CLOSE)
                at += len(head) + len(body) + len(CLOSE)
            tokens = sum(r[2] for r in shown)
            yield conv, rows[i][1], len(shown), repeated, tokens, tokens <= budget, "".join(out), loss

    names = [c.split()[0] for c in WINDOWS.replace("start:int,stop:int", "").split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if any(r[0] == 2 for r in group):
                cols = zip(*render(now[0], group), strict=True)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for b in batches:
            for r in zip(*(b[c].to_pylist() for c in ("conv_id", "seg", "kind", "nth", "n", "role", "text", "upto")), strict=True):
                if now != r[:2]:
                    yield from flush()
                    now, group = r[:2], []
                group.append(r[2:])
        yield from flush()

    return dealt.select("conv_id", "seg", "kind", "nth", "n", "role", "text", "upto").mapInArrow(form, WINDOWS)


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows say of each conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest takes its conversation in order, so a task goes through all of one; it holds one window at a time.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, repeated, loss in zip(b["text"].to_pylist(), b["n_repeated"].to_pylist(), b["loss"].to_pylist(), strict=True):
                new = turns_of(text)[repeated:]
                target = "".join(unescaped(text[x["start"] : x["stop"]]) for x in loss)
                out.append((len(new), "".join(f"{r}\n{t}\n" for r, t in new), target, len(text)))
            cols = zip(*out, strict=True) if out else [()] * 4
            more = [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)]
            yield pa.record_batch([b["conv_id"], b["first_turn"], *more], names=["conv_id", "first_turn", "turns", "said", "target", "chars"])

    read = formatted.select("conv_id", "first_turn", "n_repeated", "text", "loss")
    read = read.mapInArrow(parse, "conv_id long, first_turn long, turns long, said string, target string, chars long")
    dealt = read.repartition("conv_id").sortWithinPartitions("conv_id", "first_turn")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        result = lambda: (now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])
        table = lambda rows: pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for b in batches:
            for conv, n, said, target, chars in zip(*(b[c].to_pylist() for c in ("conv_id", "turns", "said", "target", "chars")), strict=True):
                if now != (conv,):
                    done += [result()] if now else []
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += n
                state[1].update(said.encode())
                state[2] += len(target)
                state[3].update(target.encode())
                state[4] += chars
            if done:
                yield table(done)
                done = []
        if now:
            yield table([result()])

    return dealt.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
