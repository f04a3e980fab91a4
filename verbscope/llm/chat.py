"""Chat formatting at token level.

Every turn's role and text are encoded by themselves, as ordinary text; reserved ids beyond the
vocabulary mark where the conversation starts, where a header opens and closes and where a turn
ends. Token and character offsets and the loss mask follow from prefix sums over a
conversation's turns. As no text can encode to a reserved id, markers can't be forged.

For readers of the formatted text, control strings that occur in content are escaped: each gets
one backslash more after its first character (``</s>`` -> ``<\\/s>``, ``<\\/s>`` -> ``<\\\\/s>``),
which unescaping takes away again.

The result has one row per turn, in token order within its conversation, so that a very long
conversation is a stream of rows rather than one value.

Defined results: null role or text is empty; turns go by turn number (null first), then
formatted text; a null conversation id is a conversation of its own; repeated rows are turns of
their own; columns other than the four named are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verbscope.llm.common import quoted
from verbscope.llm.wordpieces import default_tokenizer, encode, id_bytes, tokenizer

# The template's control strings, in the order of their reserved ids.
START, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = (START, OPEN, CLOSE, END)
_ESCAPE = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
_UNESCAPE = re.compile(r"([<\[])(\\*)\\(/?s>|/?INST\])")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def first_reserved(path: str) -> int:
    return tokenizer(path).get_vocab_size(with_added_tokens=True)


def _marker(path: str, control: str) -> bytes:
    return (first_reserved(path) + CONTROLS.index(control)).to_bytes(4, "little")


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", loss_roles: tuple[str, ...] = ("assistant",),
                tokenizer_path: str | None = None) -> DataFrame:
    """One row per turn: conv_id, turn_index, ids (little-endian unsigned 32-bit, reserved ids
    spliced in), formatted (the same as text), token_start, char_start, and loss_from, loss_to:
    the mask as token positions in the conversation (null where the turn has no loss).

    Encoding is per row, before the one shuffle by conversation.
    """
    path = tokenizer_path or default_tokenizer()

    @F.arrow_udf("ids binary, head long, body long, formatted string")
    def assemble(roles: pa.Array, texts: pa.Array) -> pa.Array:
        open_, close, end = (_marker(path, m) for m in (OPEN, CLOSE, END))
        ids, heads, bodies, formatted = [], [], [], []
        for r, t in zip(roles, texts, strict=True):
            role, text = escape(r.as_py()), escape(t.as_py())
            head, body = (encode(x, path, specials=False) for x in (role, text))
            ids.append(b"".join((open_, head, close, body, end)))
            heads.append(len(head) // 4 + 2)
            bodies.append(len(body) // 4)
            formatted.append(OPEN + role + CLOSE + text + END)
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(heads, pa.int64()),
                                           pa.array(bodies, pa.int64()), pa.array(formatted, pa.string())],
                                          names=["ids", "head", "body", "formatted"])

    role = F.coalesce(quoted(role_col), F.lit(""))
    rows = turns.select(quoted(conv_col).alias("conv_id"), quoted(turn_col).alias("turn"), role.alias("role"),
                        assemble(role, F.coalesce(quoted(text_col), F.lit(""))).alias("a"))
    rows = rows.select("conv_id", "turn", "role", "a.*")
    order = Window.partitionBy("conv_id").orderBy("turn", "formatted")
    rows = rows.withColumn("turn_index", (F.row_number().over(order) - 1).cast("long"))
    opens = F.col("turn_index") == 0
    start = bytearray(_marker(path, START))
    rows = (rows.withColumn("ids", F.when(opens, F.concat(F.lit(start), "ids")).otherwise(F.col("ids")))
            .withColumn("formatted", F.when(opens, F.concat(F.lit(START), "formatted")).otherwise(F.col("formatted")))
            .withColumn("head", F.col("head") + opens.cast("long")))
    so_far = Window.partitionBy("conv_id").orderBy("turn_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n_ids, n_chars = (F.octet_length("ids") / 4).cast("long"), F.char_length("formatted").cast("long")
    rows = (rows.withColumn("token_start", F.sum(n_ids).over(so_far) - n_ids)
            .withColumn("char_start", F.sum(n_chars).over(so_far) - n_chars))
    loss_from = F.when(F.col("role").isin(*loss_roles), F.col("token_start") + F.col("head"))
    return rows.select("conv_id", "turn_index", "ids", "formatted", "token_start", "char_start",
                       loss_from.alias("loss_from"), (loss_from + F.col("body")).alias("loss_to"))


def read_turn(ids: list[int], first: int, table: list[bytes]) -> tuple[str, str]:
    """(role, text) of one turn's ids, by the reserved ids alone."""
    open_, close, end = ids.index(first + 1), ids.index(first + 2), len(ids) - 1
    if ids[end] != first + 3:
        raise ValueError("a turn must end with the end id")
    text = lambda a, b: unescape(b"".join([table[k] for k in ids[a:b]]).decode())
    return text(open_ + 1, close), text(close + 1, end)


def read_back(formatted: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """What a reader gets from the output of ``format_chat``, one row per conversation: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars. Conversations are streamed
    in token order; one turn is in memory at a time."""
    path = tokenizer_path or default_tokenizer()
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        first, table = first_reserved(path), id_bytes(path)
        conv, state, done = None, None, []

        def close() -> None:
            if state:
                done.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True)) if done else [[]] * 6
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [x.strip().split(" ")[0] for x in schema.split(",")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for batch in batches:
            cols = [batch.column(k) for k in ("conv_id", "turn_index", "ids", "formatted", "token_start", "loss_from", "loss_to")]
            for row in zip(*cols, strict=True):
                c, k, raw, shown, at, a, b = (x.as_py() for x in row)
                if k == 0:
                    close()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.frombuffer(raw, "<u4").tolist()
                role, text = read_turn(ids, first, table)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if a is not None:
                    masked = unescape(b"".join([table[i] for i in ids[a - at : b - at]]).decode())
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(shown)
            if done:
                yield flush()
                done = []
        close()
        if done:
            yield flush()

    cols = formatted.select("conv_id", "turn_index", "ids", "formatted", "token_start", "loss_from", "loss_to")
    ordered = cols.repartition("conv_id").sortWithinPartitions("conv_id", "turn_index")
    return ordered.select(F.col("conv_id").cast("long"), "turn_index", "ids", "formatted", "token_start", "loss_from",
                          "loss_to").mapInArrow(read, schema)
