"""Chat formatting of typed content parts, with a loss mask.

A turn is ``<|turn|>role<|text|>body<|end|>``.  A visitor over the parts of a turn writes
text as it is, escaped, and every other part as one numbered placeholder in order,
and records what stands behind it: kind, reference, and the number of tokens the
placeholder expands to.  Control strings inside roles and texts get a backslash after
their first character, one more than they have there, which can be undone.  Only the
body of assistant turns is under the loss mask.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmine.llm.common import ship_code

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Tokens per unit of an attachment: image tile, audio second, document page.
UNIT_TOKENS = {"image": 256, "audio": 50, "document": 512}
#: What follows the first character of a control string: signs in bars, sentence and instruction marks.
_CONTROL = r"(\|[a-z_0-9:]+\|>|/?s>|/?INST\]|/?SYS>)"
_ESCAPE = rf"([<\[])(\\*){_CONTROL}"
_UNESCAPE = rf"([<\[])\\(\\*){_CONTROL}"
PART = "struct<type:string,text:string,ref:string,units:long>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def _visit(parts: Column) -> tuple[Column, Column]:
    """Body and attachments of a turn from its parts, in order."""
    others = F.transform(
        F.filter(parts, lambda p: F.coalesce(p["type"], F.lit("text")) != "text"),
        lambda p, i: F.struct(
            i.alias("place"),
            p["type"].alias("kind"),
            p["ref"].alias("ref"),
            (F.greatest(F.coalesce(p["units"], F.lit(1)), F.lit(0)) * _tokens(p["type"])).alias("tokens"),
        ),
    )
    body = F.aggregate(
        parts,
        F.struct(F.lit("").alias("body"), F.lit(0).alias("place")),
        lambda s, p: F.when(
            F.coalesce(p["type"], F.lit("text")) == "text",
            F.struct(F.concat(s["body"], escape(F.coalesce(p["text"], F.lit("")))).alias("body"), s["place"].alias("place")),
        ).otherwise(
            F.struct(
                F.concat(s["body"], F.lit("<|"), _kind(p["type"]), F.lit(":"), s["place"].cast("string"), F.lit("|>")).alias("body"),
                (s["place"] + 1).alias("place"),
            )
        ),
        lambda s: s["body"],
    )
    return body, others


def _kind(kind: Column) -> Column:
    """Name for a placeholder: lower-case letters only."""
    name = F.regexp_replace(F.lower(kind), "[^a-z]", "")
    return F.when(name == "", F.lit("part")).otherwise(name)


def _tokens(kind: Column) -> Column:
    known = F.lit(1)
    for name, tokens in UNIT_TOKENS.items():
        known = F.when(kind == name, F.lit(tokens)).otherwise(known)
    return known.cast("long")


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, formatted, loss_start, loss_end, attachments,
    attachment_tokens.

    ``turns`` has conv_id, turn, role and either ``parts`` (array of ``PART``) or ``text``.
    A null text or role is empty, a turn without parts has an empty body, a part
    of unknown type is an attachment of one token per unit, and other columns are
    ignored.  The loss mask is the stretch [loss_start, loss_end) of code points, empty for
    all but assistant turns.
    """
    if "parts" in turns.columns:
        parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
        body, attachments = _visit(F.filter(parts, lambda p: p.isNotNull()))
    else:
        none = F.lit(None).cast("string")
        one = F.struct(
            F.lit("text").alias("type"), F.col("text").alias("text"), none.alias("ref"), none.cast("long").alias("units")
        )
        body, attachments = _visit(F.array(one))
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(TURN), escape(role), F.lit(TEXT))
    made = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        head.alias("head"),
        body.alias("body"),
        attachments.alias("attachments"),
    )
    start = F.length("head").cast("long")
    end = start + F.when(F.col("role") == "assistant", F.length("body")).otherwise(F.lit(0))
    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return made.select(
        "conv_id",
        "turn",
        F.concat("head", "body", F.lit(END)).alias("formatted"),
        start.alias("loss_start"),
        end.cast("long").alias("loss_end"),
        "attachments",
        tokens.alias("attachment_tokens"),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """Roles, texts and masked texts, read back from the formatted turns."""
    whole = r"(?s)^<\|turn\|>(.*?)<\|text\|>(.*)<\|end\|>$"
    masked = F.expr("substring(formatted, cast(loss_start as int) + 1, cast(loss_end - loss_start as int))")
    return formatted.select(
        "conv_id",
        "turn",
        unescape(F.regexp_extract("formatted", whole, 1)).alias("role"),
        unescape(F.regexp_extract("formatted", whole, 2)).alias("text"),
        unescape(masked).alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    )


_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digest(batches: Iterator[pa.RecordBatch]):
    """One row per conversation from its turns in order; holds one turn at a time."""
    current: object = _digest
    rows: list[tuple] = []
    state: list = []

    def close():
        if state:
            turns, loss = state[2], state[4]
            rows.append((state[0], state[1], turns.hexdigest(), state[3], loss.hexdigest(), state[5]))

    def batch():
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        rows.clear()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for incoming in batches:
        columns = [incoming.column(incoming.schema.get_field_index(n)) for n in ("conv_id", "role", "text", "loss", "chars")]
        for conv, role, text, loss, chars in zip(*[c.to_pylist() for c in columns], strict=True):
            if conv != current or not state:
                close()
                current = conv
                state[:] = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            state[3] += len(loss)
            state[4].update(loss.encode("utf-8", "surrogatepass"))
            state[5] += chars
        if len(rows) > 10_000:
            yield batch()
    close()
    yield batch()


def digest_conversations(read: DataFrame) -> DataFrame:
    """A row per conversation of ``read_turns``: counts and digests of its turns in order.

    Turns of equal number are ordered by role and text.  The digests are sequential, so a
    conversation passes through one task, turn by turn; a task holds one batch of
    turns.
    """
    ship_code(read.sparkSession)
    columns = read.select("conv_id", "turn", "role", "text", "loss", "chars")
    ordered = columns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_digest, _DIGEST)
