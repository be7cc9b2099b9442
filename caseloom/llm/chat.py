"""Chat formatting in budgeted windows.

Turns are marked by a template whose control strings cannot occur in escaped texts. Prefix sums of turn tokens decide
where a conversation is cut into windows of whole turns. Every window keeps the system turn and repeats the last turns
before it up to a limit; only what is new in a window is under its loss mask, so no target is learnt twice.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, rows
from .tokens import counter

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START, END = "<|im_start|>", "<|im_end|>\n"
_PLAIN, _ESCAPED = re.compile(r"<(\\*n?\|)"), re.compile(r"<\\(\\*n?\|)")


def escape(text: str) -> str:
    """One more backslash between < and |, so that no control string is left."""
    return _PLAIN.sub(r"<\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text)


def escape_role(role: str) -> str:
    """As a text; line ends, which close a role, become a control string of their own."""
    return escape(role).replace("\n", "<n|")


def unescape_role(role: str) -> str:
    return unescape(role.replace("<n|", "\n"))


def marked_turn(role: str, text: str) -> tuple[str, int]:
    """A formatted turn, and where its text begins."""
    head = f"{START}{escape_role(role)}\n"
    return f"{head}{escape(text)}{END}", len(head)


class Windows:
    """Windows of one conversation, from its turns in order; holds one window and the history at most."""

    def __init__(self, budget: int, history: int, target: str):
        self.budget, self.history, self.target = budget, history, target
        self.system: tuple[str, int] | None = None
        self.turns = 0
        self.number = 0
        #: Prefix sum of turn tokens before the first new turn, and so far.
        self.begin = self.sum = 0
        #: Turns to repeat: formatted turn and the prefix sum before it.
        self.past: deque[tuple[str, int]] = deque()
        self.new: list[tuple[str, int, int, bool]] = []

    def base(self) -> int:
        """Tokens a window has before its new turns."""
        return (self.system[1] if self.system else 0) + (self.begin - self.past[0][1] if self.past else 0)

    def add(self, role: str, text: str, count) -> Iterator[dict]:
        """Windows that are full before this turn; ``count`` gives the running token counts of a text."""
        turn, at = marked_turn(role, text)
        # a turn ends in a line end, which no token crosses: counts of turns add up
        tokens = int(count(turn)[-1])
        if self.new and self.base() + self.sum + tokens - self.begin > self.budget:
            yield self.close()
        while not self.new and self.past and self.base() + tokens > self.budget:
            self.past.popleft()
        self.new.append((turn, at, self.sum, role == self.target))
        if not self.turns and role == "system":
            # a part of every window; the sums count it as no turn
            self.system = (turn, tokens)
            self.new[-1] = (turn, at, self.sum, False)
        else:
            self.sum += tokens
        self.turns += 1

    def close(self) -> dict:
        first = self.number == 0
        head = "" if first or not self.system else self.system[0]
        head += "".join(t for t, _ in self.past)
        out, loss, at = [head], [], len(head)
        for turn, start, _, target in self.new:
            if target:
                loss.append({"start": at + start, "end": at + len(turn) - len(END)})
            out.append(turn)
            at += len(turn)
        window = {"window": self.number, "text": "".join(out), "new_from": len(head), "loss": loss, "tokens": self.base() + self.sum - self.begin}
        self.past.extend((t, s) for t, _, s, _ in (self.new[1:] if first and self.system else self.new))
        while self.past and self.sum - self.past[0][1] > self.history:
            self.past.popleft()
        self.new, self.begin, self.number = [], self.sum, self.number + 1
        return window


LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
WINDOW = {"window": pa.int64(), "text": pa.string(), "new_from": pa.int64(), "loss": LOSS, "tokens": pa.int64()}


def format_windows(
    conversations: DataFrame, vocabulary: str, budget: int = 2048, history: int = 512, target: str = "assistant"
) -> DataFrame:
    """Windows of all conversations: conv_id, window (from 0), text, new_from, loss (spans of the text), tokens.

    ``tokens`` is the library's count of a window's whole text, marks and escapes included, at most ``budget``.
    Turns go by turn, role and text, nulls first; a null role or text is empty; rows that repeat are turns of their
    own; rows of a null conv_id are one conversation; an empty table gives no rows; other columns are not read. The
    first turn is the system turn if its role is system. History gives way to the first new turn of a window; a turn that
    exceeds ``budget`` with the system turn alone stands alone after it, whole.
    """
    spark = prepare(conversations.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(spec.value).count
        current: object = run
        state = Windows(budget, history, target)
        done: list[tuple] = []
        schema = None
        for b in batches:
            schema = schema or pa.schema([("conv_id", b.schema.field("conv_id").type), *WINDOW.items()])
            for conv, role, text in zip(*next(rows([b], "conv_id", "role", "text")), strict=True):
                if conv != current:
                    if state.new:
                        done.append((current, state.close()))
                    current, state = conv, Windows(budget, history, target)
                done += [(conv, w) for w in state.add(role or "", text or "", count)]
            if done:
                yield batch(done, schema)
                done = []
        if state.new:
            yield batch([(current, state.close())], schema)

    def batch(done: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"conv_id": c, **w} for c, w in done], schema)

    ordered = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, f"conv_id {kind}, window long, text string, new_from long, loss array<struct<start:long,end:long>>, tokens long")


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of the turns of a formatted text."""
    at = 0
    while at < len(text):
        line = text.index("\n", at)
        end = text.index(END, line)
        yield unescape_role(text[at + len(START) : line]), unescape(text[line + 1 : end])
        at = end + len(END)


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows of each conversation say: n_turns, digests of turns and of learnt text, and lengths.

    conv_id, n_turns, turns_sha256 (role, line end, text, line end of every turn, once), loss_chars and loss_sha256 (all
    text under the loss masks, unescaped), formatted_chars. Windows are read one at a time.
    """
    prepare(windows.sparkSession)
    kind = windows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = run
        turns, learnt, sums = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
        schema = None

        def row() -> dict:
            return {
                "conv_id": current, "n_turns": sums[0], "turns_sha256": turns.hexdigest(), "loss_chars": sums[1],
                "loss_sha256": learnt.hexdigest(), "formatted_chars": sums[2],
            }

        for b in batches:
            schema = schema or pa.schema([
                ("conv_id", b.schema.field("conv_id").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
            ])
            done = []
            for conv, text, new_from, loss in zip(*next(rows([b], "conv_id", "text", "new_from", "loss")), strict=True):
                if conv != current:
                    if current is not run:
                        done.append(row())
                    current, turns, learnt, sums = conv, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                for role, said in turns_of(text[new_from:]):
                    turns.update(f"{role}\n{said}\n".encode())
                    sums[0] += 1
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    learnt.update(said.encode())
                    sums[1] += len(said)
                sums[2] += len(text)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if current is not run:
            yield pa.RecordBatch.from_pylist([row()], schema)

    ordered = windows.select("conv_id", "window", "text", "new_from", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    kinds = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.drop("window").mapInArrow(run, kinds)
