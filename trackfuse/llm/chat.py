"""Conversations as training texts: turns under a template, windows within a token budget, a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackfuse.llm.numbering import numbered
from trackfuse.llm.pretokens import PieceTable
from trackfuse.llm.token_counts import chunks, count_tokens
from trackfuse.operators.skew import sized_join
from trackfuse.session import stage

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens of a window, and of the earlier turns that a window repeats at most.
BUDGET = 1024
HISTORY = 256
#: Turns that a window repeats at most.
HISTORY_TURNS = 8
#: Turns that one task looks at together; a longer conversation is worked on in segments of so many.
SEGMENT = 1024

_CONTROL = re.compile(r"<(\\*\|)")
_ESCAPED = re.compile(r"<\\(\\*\|)")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    """No ``<|`` is left: each ``<``, any backslashes, ``|`` gets one backslash more. ``unescape`` takes it away."""
    return _CONTROL.sub(r"<\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text)


def escape_role(role: str) -> str:
    """As ``escape``, and on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn under the template, and where its text begins and ends in it."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse_turns(text: str) -> list[tuple[str, str]]:
    """The ``(role, text)`` of each turn of a formatted text."""
    found, at = [], 0
    for turn in _TURN.finditer(text):
        if turn.start() != at:
            break
        found.append((unescape_role(turn[1]), unescape(turn[2])))
        at = turn.end()
    if at != len(text):
        raise ValueError("not a formatted text")
    return found


def cut_windows(
    tokens: np.ndarray, first: int, system: int, budget: int, history: int, history_turns: int = HISTORY_TURNS
) -> list[tuple[int, int, int]]:
    """``(begin of history, first new turn, end)`` of the windows over turns of so many ``tokens``.

    Turns from ``first`` on are new in one window each; those before it may only be
    repeated. A window has ``system`` tokens besides. By prefix sums it repeats the latest
    turns within ``history`` tokens that leave room for a new turn, and then takes as
    many new ones as fit in ``budget``; a turn that fits in no window has one of its own.
    """
    before = np.concatenate([[0], np.cumsum(tokens)])
    out, at = [], first
    while at < len(tokens):
        room = budget - system
        repeat = max(min(history, room - int(tokens[at])), 0)
        begin = max(int(np.searchsorted(before, before[at] - repeat)), at - history_turns)
        end = int(np.searchsorted(before, before[begin] + room, side="right")) - 1
        end = max(end, at + 1)
        out.append((begin, at, end))
        at = end
    return out


def _segmented(turns: DataFrame, segment: int, overlap: int) -> DataFrame:
    """``turns`` (conv, turn, role, text) with segment, place and kind.

    Kind 0 is the conversation's system turn, if it begins with one, 1 a turn of the segment
    before, 2 the segment's own. A conversation of up to ``segment`` turns is one segment and its
    turns need no numbers yet; of longer ones the turns are numbered, and each segment gets
    copies of what it may repeat.
    """
    long = turns.groupBy("conv").agg(F.count("*").alias("_n")).filter(F.col("_n") > segment)
    long = stage(long.select("conv", F.lit(True).alias("_long")), "long_conversations")
    nothing = {"segment": F.lit(0).cast("bigint"), "place": F.lit(0).cast("bigint"), "kind": F.lit(2)}
    if long.isEmpty():
        return turns.withColumns(nothing)
    marked = sized_join(turns, long, ["conv"], "left", null_safe=True, unique_right=True)
    whole = marked.filter("_long IS NULL").drop("_long").withColumns(nothing)
    parts = numbered(marked.filter("_long").drop("_long"), "conv", ["turn", "role", "text"], "long_turns")
    number, at = F.expr(f"idx div {segment}"), F.col("idx") % segment
    last = F.expr(f"(total - 1) div {segment}")
    head = (F.col("idx") == 0) & F.col("role").eqNullSafe(F.lit("system"))
    near_end = (at >= segment - overlap) & (number < last) & ~head
    copies = F.concat(
        F.array(F.struct(number.alias("segment"), F.when(head, 0).otherwise(2).alias("kind"))),
        F.when(near_end, F.array(F.struct((number + 1).alias("segment"), F.lit(1).alias("kind")))).otherwise(F.array()),
        F.when(head & (last > 0), F.transform(F.sequence(F.lit(1).cast("bigint"), last), lambda s: F.struct(s.alias("segment"), F.lit(0).alias("kind")))).otherwise(F.array()),
    )
    parts = parts.withColumn("_copy", F.explode(copies))
    return whole.unionByName(parts.select(*turns.columns, "_copy.segment", F.col("idx").alias("place"), "_copy.kind"))


def _runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[tuple]]:
    """Consecutive rows that agree in the first ``n_keys`` columns, a group at a time."""
    key, run = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run and row[:n_keys] != key:
                yield run
                run = []
            key = row[:n_keys]
            run.append(row)
    if run:
        yield run


def format_chats(
    conversations: DataFrame,
    tokenizer: str,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    segment: int = SEGMENT,
    history_turns: int = HISTORY_TURNS,
) -> DataFrame:
    """Training texts of the conversations, in windows of at most ``budget`` tokens.

    Returns per window: id, segment, window (numbered within the segment), text, loss (begin and
    end, in code points, of each stretch of ``text`` that is a target), n_tokens, n_turns,
    n_repeated (turns at the front that an earlier window has too), over_budget.

    A turn is written as ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line break;
    ``<|`` inside texts and roles is escaped, and ``parse_turns`` gives back what was put in. Turns are counted by
    the tokenizers file ``tokenizer``, a path that every node has, each on its own. Windows
    consist of whole turns and are chosen by prefix sums (``cut_windows``). Each begins with the conversation's system
    turn, if its first turn is one, and repeats the latest turns before its new ones within ``history`` tokens
    and ``history_turns``. Targets are the assistant texts of new turns; repeated ones are masked, so
    every assistant text is a target once. A turn that alone, with the system turn, exceeds the
    budget is not cut: its window is marked ``over_budget``.

    Conversations of over ``segment`` turns are worked on in segments, a new window beginning
    with each, so that no task holds more than that many turns.

    Turns go by ``turn_col``, null first, then by role and text. A null text or role counts as empty, a
    null id is a conversation. Repeated rows are turns each. Other columns are ignored; an empty table gives
    an empty one.
    """
    turns = conversations.select(
        F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    rows = _segmented(turns, segment, min(history_turns, segment))
    rows = rows.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "kind", "place", "turn", "role", "text")
    kind = conversations.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, out, size = PieceTable.of(tokenizer, "chats"), [], 0
        for group in _runs(batches, 2):
            made = _windows(table, group, budget, history, history_turns)
            out += made
            size += sum(len(w[3]) for w in made)
            if size > 4_000_000:
                yield _as_batch(out, kind)
                out, size = [], 0
        if out:
            yield _as_batch(out, kind)

    return rows.select("conv", "segment", "kind", "role", "text").mapInArrow(run, _fields(kind.simpleString())).withColumnRenamed(
        "conv", id_col
    )


_WINDOW = ("segment", "window", "text", "loss", "n_tokens", "n_turns", "n_repeated", "over_budget")


def _fields(kind: str) -> str:
    return (
        f"conv {kind}, segment bigint, window int, text string, loss array<bigint>, n_tokens bigint, n_turns bigint, "
        "n_repeated bigint, over_budget boolean"
    )


def _as_batch(rows: list[tuple], kind) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(kind), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64()), *[pa.int64()] * 3, pa.bool_()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["conv", *_WINDOW])


def _windows(table: PieceTable, group: list[tuple], budget: int, history: int, history_turns: int) -> list[tuple]:
    """The windows of one segment: rows of (conv, segment, kind, role, text), in order."""
    conv, segment = group[0][:2]
    roles = [r or "" for _, _, _, r, _ in group]
    kinds = [k for _, _, k, _, _ in group]
    # In a conversation of one segment the system turn is told apart here.
    lead = kinds[0] == 0 or (segment == 0 and kinds[0] == 2 and roles[0] == "system")
    turns = [format_turn(role, row[4] or "") for role, row in zip(roles, group, strict=True)]
    counted = [n for part in chunks([t for t, _, _ in turns]) for n in count_tokens(table, part)]
    tokens = np.array(counted, np.int64)
    fresh = segment == 0  # the system turn itself is new in the conversation's first window only
    system = int(tokens[0]) if lead else 0
    own = turns[lead:]
    first = sum(k == 1 for k in kinds)
    cuts = cut_windows(tokens[lead:], first, system, budget, history, history_turns)
    if not cuts and lead and fresh:
        cuts = [(0, 0, 0)]  # nothing but a system turn
    out = []
    for number, (begin, at, end) in enumerate(cuts):
        shown = [*([turns[0]] if lead else []), *own[begin:end]]
        repeated = at - begin + (lead and not (fresh and number == 0))
        loss, length = [], 0
        for i, (text, body, body_end) in enumerate(shown):
            if i >= repeated and text.startswith(f"{START}assistant\n"):
                loss += [length + body, length + body_end]
            length += len(text)
        n = int(tokens[lead:][begin:end].sum()) + system
        text = "".join(t for t, _, _ in shown)
        out.append((conv, segment, number, text, loss, n, len(shown), int(repeated), n > budget))
    return out


def read_back(windows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the windows say, per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``turns_sha256`` is over role, line break, text, line break of each turn, read from the
    formatted text where it is new; ``loss_sha256`` over the unescaped text under the mask, and
    ``loss_chars`` its code points; ``formatted_chars`` are the code points of all windows. A digest
    of a whole conversation is one sequence by its nature: its windows pass one after another,
    sorted by Spark, and one of them is held at a time.
    """
    kind = windows.schema[id_col].dataType
    rows = windows.repartition(id_col).sortWithinPartitions(id_col, "segment", "window")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, key, own, out = False, None, None, []
        for batch in batches:
            for conv, text, loss, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not begun or conv != key:
                    if begun:
                        out.append((key, *own.found()))
                    begun, key, own = True, conv, _Digest()
                own.add(text, loss, repeated)
            if len(out) > 10_000:
                yield as_batch(out)
                out = []
        if begun:
            yield as_batch([*out, (key, *own.found())])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(kind), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=[id_col, *made])

    made = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return rows.select(id_col, "text", "loss", "n_repeated").mapInArrow(
        run,
        f"`{id_col}` {kind.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint",
    )


class _Digest:
    """Running digests of one conversation."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: str, loss: list[int], repeated: int) -> None:
        self.chars += len(text)
        for role, said in parse_turns(text)[repeated:]:
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n_turns += 1
        for begin, end in zip(loss[::2], loss[1::2], strict=True):
            target = unescape(text[begin:end])
            self.loss.update(target.encode())
            self.loss_chars += len(target)

    def found(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
