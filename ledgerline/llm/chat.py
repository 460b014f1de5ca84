"""Chat formatting that is proved by reading it back.

A turn is rendered as ``<|im_start|>role``, newline, text, ``<|im_end|>``,
newline. A deterministic parser reads the rendered turn again (always undoing
escapes); if the role and text that come back differ from the source, the
conflicting content is escaped and the turn rendered again, until they are
identical. Escaping puts one backslash between ``<`` and ``|`` (after any that
stand there already), so it can be undone exactly and touches nothing else; in
roles, backslashes and newlines are escaped as well.

Turns are rendered where they are, without a shuffle. Digests of whole
conversations need their turns in order: rows are sorted by conversation and
turn and hashed as they stream by, so a conversation of any length takes the
memory of one turn.

Defined cases: null text and null role are empty; a null turn comes first;
turns of equal number are ordered by their rendered form; rows without
conv_id form one conversation; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
_CONTROL = re.compile(r"<\|im_(?:start|end)\|>")


class BadChat(ValueError):
    """Text that the grammar does not accept."""


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end bound the text as it is rendered."""
    at = 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise BadChat(f"no turn begins at {at}")
        head = rendered.find("\n", at)
        if head < 0:
            raise BadChat("a role does not end")
        role = rendered[at + len(START):head]
        if _CONTROL.search(role):
            raise BadChat("control string in a role")
        stop = _CONTROL.search(rendered, head + 1)
        if stop is None or stop[0] != END or not rendered.startswith("\n", stop.end()):
            raise BadChat("a text does not end")
        yield unescape_role(role), unescape(rendered[head + 1:stop.start()]), head + 1, stop.start()
        at = stop.end() + 1


def reads_back(rendered: str, role: str, text: str) -> bool:
    try:
        return [(r, t) for r, t, _, _ in parse(rendered)] == [(role, text)]
    except BadChat:
        return False


def render(role: str | None, text: str | None) -> tuple[str, int]:
    """The rendered turn and how many renderings it took."""
    role, text = role or "", text or ""
    shown_role, shown = role, text
    for rounds in (1, 2, 3):
        rendered = f"{START}{shown_role}\n{shown}{END}\n"
        if reads_back(rendered, role, text):
            return rendered, rounds
        shown_role, shown = (role, escape(text)) if rounds == 1 else (escape_role(role), escape(text))
    raise BadChat("a turn does not read back")


RENDERED = "conv_id long, turn long, rendered string, rounds int, loss_start long, loss_end long"


def format_turns(df: DataFrame) -> DataFrame:
    """One row per turn: its rendered form, and the code points of it under the loss mask (null: none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shown, rounds, start, end = [], [], [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                rendered, n = render(role, text)
                (_, _, a, b), = parse(rendered)
                shown.append(rendered)
                rounds.append(n)
                start.append(a if role == TRAINED_ROLE else None)
                end.append(b if role == TRAINED_ROLE else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shown, pa.string()), pa.array(rounds, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                names=["conv_id", "turn", "rendered", "rounds", "loss_start", "loss_end"])

    rows = df.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return rows.mapInArrow(run, RENDERED)


class _Digest:
    """What one conversation comes to, fed turn by turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str, start: int | None, end: int | None) -> None:
        for role, text, _, _ in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if start is not None:
            learned = unescape(rendered[start:end])
            self.loss.update(learned.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(learned)
        self.chars += len(rendered)

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def digest(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the rendered turns in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)],
                                              names=[c.split()[0] for c in DIGESTS.split(", ")])

        for batch in batches:
            for conv_id, rendered, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv_id)
                now.add(rendered, start, end)
            if done:
                yield out()
                done = []
        if now is not None:
            done.append(now.row())
            yield out()

    in_order = (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "rendered")
                .select("conv_id", "rendered", "loss_start", "loss_end"))
    return in_order.mapInArrow(run, DIGESTS)
