r"""Chat formatting by prefix-target expansion.

Every assistant turn is an example of its own: all turns before it as context, and only that reply under the loss mask.
Turns after the last reply, and conversations without one, give an example with no mask, so that no text is lost.

A turn is ``### Role: text</turn>`` and a line feed. Inside roles and texts a backslash goes before every backslash, ``###``
and ``</turn>`` (in roles before every colon, line feed and ``=`` too), so markers are never read from within a text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow

ROLES = {"user": "User", "assistant": "Assistant", "system": "System"}
_BACK = {v: k for k, v in ROLES.items()}
END = "</turn>\n"
_ESCAPE, _ESCAPE_ROLE = re.compile(r"\\|###|</turn>"), re.compile(r"\\|###|</turn>|[:\n=]")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str, pattern: re.Pattern = _ESCAPE) -> str:
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def head(role: str) -> str:
    """What stands before a turn's text; roles without a name of their own are marked with ``=``."""
    return f"### {ROLES[role] if role in ROLES else '=' + escape(role, _ESCAPE_ROLE)}: "


def read_turns(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns; start and end are those of the escaped text. Raises on anything else."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError("not a formatted conversation")
        out.append((unescape(m[1][1:]) if m[1][:1] == "=" else _BACK[m[1]], unescape(m[2]), m.start(2), m.end(2)))
        at = m.end()
    return out


def examples(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_end): one row for each assistant turn, in order, and one without a
    mask (both ends null) for what follows the last.

    Turns are ordered by number, then role and text; null roles and texts are empty, null conversations are one
    conversation, null turns come first. Repeated rows are repeated turns. The examples of a conversation follow each
    other in one partition. A conversation must fit a task, since its last example holds all of it.
    """
    rows = narrow(conversations, conv_id=conv_id, turn=turn, role=role, text=text)
    blank = F.lit("")
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")))).alias("turns"))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "example", "formatted", "loss_start", "loss_end"]
        schema = None
        for batch in batches:
            schema = pa.schema([("conv_id", batch["conv_id"].type), ("example", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])
            for conv, turns in zip(batch["conv_id"].to_pylist(), batch["turns"].to_pylist(), strict=True):
                so_far, n, out, held = "", 0, [], 0
                for t in turns:
                    so_far += head(t["role"])
                    start = len(so_far)
                    so_far += escape(t["text"])
                    end = len(so_far)
                    so_far += END
                    if t["role"] == "assistant":
                        out.append((conv, n, so_far, start, end))
                        n, held = n + 1, held + len(so_far)
                        if held > 1 << 24:  # a long conversation goes on in pieces
                            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)), schema)
                            out, held = [], 0
                if not turns or turns[-1]["role"] != "assistant":
                    out.append((conv, n, so_far, None, None))
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)), schema)

    return grouped.mapInArrow(run, f"conv_id {kind}, example long, formatted string, loss_start long, loss_end long")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the output of ``examples``, whose
    order within partitions must be untouched.

    Raises where an example isn't the next prefix of its conversation, or the mask isn't its last turn's text.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, schema = None, None

        def closed() -> pa.RecordBatch:
            row = [[open_["conv"]], [len(open_["turns"])], [hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in open_["turns"]).encode("utf-8", "surrogatepass")).hexdigest()], [open_["loss_chars"]], [open_["loss"].hexdigest()], [open_["chars"]]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            schema = pa.schema([("conv_id", batch["conv_id"].type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            for conv, n, text, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if n == 0:
                    if open_:
                        yield closed()
                    open_ = {"conv": conv, "turns": [], "text": "", "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                if open_["conv"] != conv or not text.startswith(open_["text"]):
                    raise ValueError("an example doesn't continue the one before")
                new = read_turns(text[len(open_["text"]) :])
                if start is not None:
                    shift = len(open_["text"])
                    if (new[-1][2] + shift, new[-1][3] + shift) != (start, end):
                        raise ValueError("the loss mask isn't the reply")
                    reply = unescape(text[start:end])
                    open_["loss"].update(reply.encode("utf-8", "surrogatepass"))
                    open_["loss_chars"] += len(reply)
                open_["turns"] += [x[:2] for x in new]
                open_["text"], open_["chars"] = text, open_["chars"] + len(text)
        if open_:
            yield closed()

    return formatted.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
