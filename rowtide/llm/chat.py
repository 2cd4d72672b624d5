"""Chat formatting: conversations rendered by a compiled template, with a loss mask, and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.template import compiled

TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' ~ m.role ~ '\\n' }}"
    "{% if m['role'] == 'assistant' %}{% generation %}{{ m.text }}{% endgeneration %}"
    "{% else %}{{ m.text }}{% endif %}{{ '<|im_end|>' ~ '\\n' }}{% endfor %}"
)
#: Rows of an Arrow batch that goes out.
BATCH = 4096
END = "<|im_end|>\n"
TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def escaped(text: str) -> str:
    """No ``<|`` is left: its bar gets a backslash, and backslashes of the text are doubled first."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|") if "\\" in text or "<|" in text else text


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


def role_escaped(role: str) -> str:
    """As a text; line breaks too, since one ends the role."""
    return escaped(role).replace("\n", "\\n")


def rendered(turns: Iterable[tuple[str, str]], template) -> Iterator[tuple[str, bool]]:
    """Pieces of the formatted conversation; roles and texts are escaped before the template sees them."""
    return template({"messages": ({"role": role_escaped(r), "text": escaped(t)} for r, t in turns)})


PIECES = "conv_id long, piece long, text string, generated boolean"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def formatted(df: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """The formatted conversations of ``(conv_id, turn, role, text)``, in pieces.

    ``conv_id, piece long, text string, generated boolean``: the pieces of a conversation stand together
    in one partition, in order; ``generated`` is the loss mask.

    Rows are sorted by conversation and turn (then role and text, nulls first) and stream through the
    template, so memory is bounded by one turn whatever the length of a conversation. Null role or text:
    empty. Null turns come first. A null ``conv_id`` is a conversation of its own. Repeated rows are turns.
    An empty table gives no rows. Other columns are ignored.
    """
    turns = df.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").repartition("conv_id")
    schema = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("generated", pa.bool_())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template)
        names = ("conv_id", "role", "text")
        rows = (row for b in batches for row in zip(*(b[n].to_pylist() for n in names), strict=True))
        out = []
        for conv_id, group in groupby(rows, key=lambda r: r[0]):
            for n, (piece, on) in enumerate(rendered(((r or "", t or "") for _, r, t in group), render)):
                out.append((conv_id, n, piece, on))
                if len(out) == BATCH:
                    yield batch_of(out, schema)
                    out = []
        yield batch_of(out, schema)

    ordered = turns.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(write, PIECES)


def read_turns(pieces: Iterable[str]) -> Iterator[tuple[str, str, int]]:
    """``(role, text, length)`` of each turn, found in the formatted text alone; it is held a turn at a time."""
    held = ""
    for piece in pieces:
        held += piece
        if not held.endswith(END):
            continue
        for match in TURN.finditer(held):
            yield unescaped(match[1]), unescaped(match[2]), len(match[0])
        held = ""


def digest(pieces: Iterable[tuple[str, bool]]) -> tuple:
    """Counts and digests of one conversation, read from its pieces in one pass."""
    whole, loss = hashlib.sha256(), hashlib.sha256()
    count = chars = loss_chars = 0

    def watched():
        nonlocal loss_chars
        for piece, generated in pieces:
            if generated:
                text = unescaped(piece)
                loss_chars += len(text)
                loss.update(text.encode("utf-8", "surrogatepass"))
            yield piece

    for role, text, length in read_turns(watched()):
        whole.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        count += 1
        chars += length
    return count, whole.hexdigest(), loss_chars, loss.hexdigest(), chars


def read_back(pieces: DataFrame) -> DataFrame:
    """What formatted conversations hold: one row each, from the pieces in the order ``formatted`` left them.

    ``n_turns``; ``turns_sha256`` of role, newline, text, newline per turn; ``loss_chars`` and
    ``loss_sha256`` of the unescaped text under the loss mask; ``formatted_chars``.
    """
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    schema = pa.schema([(c.split()[0], t) for c, t in zip(DIGESTS.split(", "), types, strict=True)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv_id", "text", "generated")
        rows = (row for b in batches for row in zip(*(b[n].to_pylist() for n in names), strict=True))
        done = []
        for conv_id, group in groupby(rows, key=lambda r: r[0]):
            done.append((conv_id, *digest((text, on) for _, text, on in group)))
            if len(done) == BATCH:
                yield batch_of(done, schema)
                done = []
        yield batch_of(done, schema)

    return pieces.mapInArrow(read, DIGESTS)
