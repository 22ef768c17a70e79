"""Chat formatting with typed content parts: a template, attachment references, a loss mask, and its reading back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_arrow

#: kind: text, image, audio or document. units: pixels wide and high, seconds, or pages, by kind.
PART = "struct<kind: string, text: string, ref: string, units: array<double>>"

START, END = "<|im_start|>", "<|im_end|>"
PIXELS_A_TOKEN, TOKENS_A_SECOND, TOKENS_A_PAGE = 28, 25, 256
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    r"""Puts one more backslash between < and | wherever only backslashes stand there, so that no `<|` is left."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class PartVisitor:
    """Flattens the typed parts of one turn into a string, its attachments, and the tokens they expand to."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind'] or 'text'}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        wide, high = [*(part["units"] or []), 0.0, 0.0][:2]
        self._attach(part, -int(-wide // PIXELS_A_TOKEN) * -int(-high // PIXELS_A_TOKEN))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, -int(-([*(part["units"] or []), 0.0][0] * TOKENS_A_SECOND) // 1))

    def visit_document(self, part: dict) -> None:
        self._attach(part, int([*(part["units"] or []), 0.0][0]) * TOKENS_A_PAGE)

    def visit_unknown(self, part: dict) -> None:
        raise ValueError(f"unknown kind of part: {part['kind']}")

    def _attach(self, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": part["kind"], "ref": part["ref"], "position": len(self.attachments), "tokens": max(1, tokens)})
        self.pieces.append(f"<|{part['kind']}|>")


def text_parts(text: Column) -> Column:
    """One text part for each row; null counts as empty."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("array<double>").alias("units")))


def format_turns(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """turns (conv_id, turn, role, parts array<PART>) with each turn's stretch of the formatted conversation.

    `formatted` is `<|im_start|>role`, a line break, the parts in order, `<|im_end|>` and a line break; a
    conversation is its turns' stretches in order, so that no conversation has to fit in one row. `loss_from` and
    `loss_upto` bound the characters under the loss mask: the content of loss_role's turns, else none.
    `attachments` lists the placeholders in order with the tokens they expand to, `attachment_tokens` their sum.
    Control strings inside texts and roles are escaped reversibly. Null roles are empty; null parts are none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, parts = batch.column("role").to_pylist(), batch.column("parts").to_pylist()
            out: dict[str, list] = {"formatted": [], "loss_from": [], "loss_upto": [], "attachments": [], "attachment_tokens": []}
            for role, content in zip(roles, parts, strict=True):
                visitor = PartVisitor()
                for part in content or []:
                    visitor.visit(part)
                head, body = f"{START}{_role(role or '')}\n", "".join(visitor.pieces)
                out["formatted"].append(f"{head}{body}{END}\n")
                out["loss_from"].append(len(head))
                out["loss_upto"].append(len(head) + len(body) * (role == loss_role))
                out["attachments"].append(visitor.attachments)
                out["attachment_tokens"].append(sum(a["tokens"] for a in visitor.attachments))
            kept = batch.select(["conv_id", "turn"])
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("position", pa.int32()), ("tokens", pa.int64())])), pa.int64()]
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))], names=[*kept.schema.names, *out])

    names = ("conv_id", "turn")
    kinds = ", ".join(f"{c} {turns.schema[c].dataType.simpleString()}" for c in names)
    new = "formatted string, loss_from int, loss_upto int, attachments array<struct<kind: string, ref: string, position: int, tokens: bigint>>, attachment_tokens bigint"
    return map_arrow(turns.select("conv_id", "turn", "role", "parts"), run, f"{kinds}, {new}")


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss_chars, self.chars, self.marked = 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, lo: int, hi: int) -> None:
        if not (formatted.startswith(START) and formatted.endswith(f"{END}\n")):
            raise ValueError("a turn lacks its marks")
        role, _, body = formatted[len(START) : -len(END) - 1].partition("\n")
        self.turns += 1
        self.chars += len(formatted)
        self.all.update(f"{_unrole(role)}\n{unescape(body)}\n".encode())
        masked = unescape(formatted[lo:hi])
        self.loss_chars += len(masked)
        self.loss.update(masked.encode())

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted stretches say: turns, their digest, and the text under the loss mask.

    Conversations are dealt out by id and read in order of turn, one stretch at a time: a digest of one
    conversation has to see its turns in order, but holds none of them. Ties in turn are read in order of content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            out = pa.RecordBatch.from_arrays([pa.array(columns[0], id_kind), *(pa.array(c) for c in columns[1:])], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            done.clear()
            return out

        for batch in batches:
            id_kind = batch.column("conv_id").type
            for conv, text, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_from", "loss_upto")), strict=True):
                if digest is None or conv != now:
                    if digest:
                        done.append((now, *digest.row()))
                    now, digest = conv, _Digest()
                digest.add(text, lo, hi)
            if len(done) > 1000:
                yield flush()
        if digest:
            done.append((now, *digest.row()))
            yield flush()

    kind = formatted.schema["conv_id"].dataType.simpleString()
    ordered = formatted.select("conv_id", "turn", "formatted", "loss_from", "loss_upto").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return map_arrow(ordered, run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
