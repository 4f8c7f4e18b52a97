"""Chat formatting by a grammar round trip.

Grammar of the rendered text, read by a deterministic parser::

    conversation := turn*
    turn         := "### " name ": " body "</turn>\\n"

``name`` and ``body`` hold no control string unless a backslash stands before it; a backslash before
a control string or before a backslash is dropped when read, any other backslash is itself. A turn
is rendered as it is and parsed back; only if that does not give exactly the source (its content
conflicts with the grammar) is the content escaped, and the turn parsed back again.

Turns stream: rows are sorted by conversation and turn within each partition and one turn at a time
is held, so a conversation of any length needs no more memory than its longest turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, slices

OPEN, NAMED, CLOSE, ESCAPE = "### ", ": ", "</turn>", "\\"
END = CLOSE + "\n"
#: Strings that content may hold only behind a backslash.
CONTROL = (ESCAPE, OPEN, NAMED, CLOSE)
TRAINED = "assistant"
TRAP_ID = -7
TRAP = "\\### Assistant: </turn> ok"


def escape(text: str, controls: tuple[str, ...]) -> str:
    for c in controls:  # the backslash comes first
        text = text.replace(c, ESCAPE + c)
    return text


class Parser:
    """Deterministic parser of one rendered turn: name, body and where the body lies."""

    #: What the parser stops at: an escaped control string (longest first), or one that is not.
    _MARK = re.compile("|".join([f"{re.escape(ESCAPE)}(?:{'|'.join(re.escape(c) for c in CONTROL)})",
                                 re.escape(OPEN), re.escape(NAMED), re.escape(CLOSE)]))

    def _until(self, text: str, at: int, stop: str, barred: str | None = None) -> tuple[str, int]:
        """Content from ``at`` up to the first unescaped ``stop``, unescaped, and where it ends. One
        scan from left to right; an unescaped ``barred`` on the way is an error."""
        out = []
        for m in self._MARK.finditer(text, at):
            mark = m.group()
            if mark == stop:
                out.append(text[at:m.start()])
                return "".join(out), m.start()
            if mark == barred:
                raise ValueError("a turn begins inside another")
            if mark.startswith(ESCAPE):
                out += (text[at:m.start()], mark[len(ESCAPE):])
                at = m.end()
        raise ValueError(f"no {stop!r} in a rendered turn")

    def parse(self, rendered: str) -> tuple[str, str, int, int]:
        if not rendered.startswith(OPEN):
            raise ValueError("a turn begins with its mark")
        name, at = self._until(rendered, len(OPEN), NAMED)
        start = at + len(NAMED)
        body, end = self._until(rendered, start, CLOSE, OPEN)
        if rendered[end:] != END:
            raise ValueError("text behind the end of a turn")
        return name, body, start, end


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn, with the place of its (escaped) body; parsing it back gives the source."""
    parser = Parser()
    for controls in ((), CONTROL):
        made = f"{OPEN}{escape(role, controls)}{NAMED}{escape(text, controls)}{END}"
        try:
            name, body, start, end = parser.parse(made)
        except ValueError:
            continue
        if (name, body) == (role, text):
            return made, start, end
    raise ValueError("a turn does not survive the round trip")


_RENDERED = "turn_no long, rendered string, mask_start long, mask_end long"


def format_turns(turns: DataFrame, trained: str = TRAINED) -> DataFrame:
    """``(conv_id, turn_no, rendered, mask_start, mask_end)``: one row per row of ``turns``.

    ``turn_no`` counts from 0 in the order of ``turn`` (null first; ties by role, then text). The
    mask is the code-point range of the body within ``rendered`` for the role ``trained``, null for
    others. Null text and role count as empty; a null ``conv_id`` is a conversation of its own;
    repeated rows are turns like any other; an empty table gives no rows. The rows of a
    conversation follow one another in one partition.
    """
    id_type = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = shuffle_partitions(turns.sparkSession)
    ordered = rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number = object(), 0
        for b in slices(batches, 2_000, "text"):
            ids, out = b.column("conv_id").to_pylist(), []
            for c, role, text in zip(ids, b.column("role").to_pylist(), b.column("text").to_pylist(),
                                     strict=True):
                number = number + 1 if c == current else 0
                current = c
                made, start, end = render(role, text)
                out.append((number, made, start, end) if role == trained
                           else (number, made, None, None))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                ["conv_id", "turn_no", "rendered", "mask_start", "mask_end"])

    return ordered.mapInArrow(run, f"conv_id {id_type}, {_RENDERED}")


_DIGEST = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def read_back(formatted: DataFrame) -> DataFrame:
    """What the rendered turns say, per conversation, read with the parser alone.

    ``formatted`` is the result of :func:`format_turns` as it stands (its rows are in order). The
    hashes run over the conversation turn by turn.
    """
    id_type = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, open_id, state = Parser(), None, None

        def row(done):
            return (open_id, done["n"], done["turns"].hexdigest(), done["chars"],
                    done["loss"].hexdigest(), done["size"])

        def table(rows):
            cols = list(zip(*rows, strict=True))
            kinds = (id_arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", *[f.split()[0] for f in _DIGEST.split(", ")]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        id_arrow = None
        for b in slices(batches, 2_000, "rendered"):
            id_arrow = b.schema.field("conv_id").type
            done = []
            for c, number, text, start, end in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if number == 0:
                    if state is not None:
                        done.append(row(state))
                    open_id = c
                    state = {"n": 0, "turns": hashlib.sha256(), "chars": 0,
                             "loss": hashlib.sha256(), "size": 0}
                name, body, at, until = parser.parse(text)
                state["n"] += 1
                state["turns"].update(f"{name}\n{body}\n".encode())
                state["size"] += len(text)
                if start is not None:
                    if (start, end) != (at, until):
                        raise ValueError("the loss mask is not the body of its turn")
                    state["chars"] += len(body)
                    state["loss"].update(body.encode())
            if done:
                yield table(done)
        if state is not None:
            yield table([row(state)])

    return formatted.mapInArrow(run, f"conv_id {id_type}, {_DIGEST}")


def with_trap(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) and conversation -7, whose texts hold control strings."""
    spark = turns.sparkSession
    trap = spark.createDataFrame([(TRAP_ID, 0, "user", TRAP), (TRAP_ID, 1, "assistant", TRAP)],
                                 "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(trap)
