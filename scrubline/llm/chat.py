"""Chat formatting: rendered conversations, token ids with offsets, and loss masks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: A conversation longer than this is written in pieces cut between turns.  Markers are tokens
#: of their own, so that no token crosses a turn and the ids are those of the whole.
PIECE_CHARS = 1 << 22
#: Token ids as little-endian 32-bit integers; offsets likewise, as the distance of a token's first
#: character from the end of the token before and its length; loss as runs of tokens, first and after the last.
FORMATTED = (
    "conv_id long, piece int, final boolean, text string, ids binary, gaps binary, lengths binary, loss array<int>"
)
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEPARATOR) + "(.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    """No marker can occur in the result: one backslash goes between ``<`` and ``|``."""
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def chat_tokenizer(path: str) -> Tokenizer:
    """The tokenizer with the template's markers as tokens of their own."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.add_tokens([AddedToken(m, normalized=False, special=False) for m in (START, SEPARATOR, END)])
    return tokenizer


def mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Whether each token lies in one of the sorted spans, by binary search for its place."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), bool)
    at = np.searchsorted(spans[:, 1], offsets[:, 0], side="right")
    inside = at < len(spans)
    low = spans[np.minimum(at, len(spans) - 1), 0]
    return inside & (offsets[:, 1] > low) & (offsets[:, 1] > offsets[:, 0])


def packed(offsets: np.ndarray) -> tuple[bytes, bytes]:
    """Offsets as gaps and lengths, which hardly vary."""
    before = np.concatenate([[0], offsets[:-1, 1]]) if len(offsets) else offsets[:, 0]
    return (offsets[:, 0] - before).astype("<i4").tobytes(), (offsets[:, 1] - offsets[:, 0]).astype("<i4").tobytes()


def offsets_of(gaps: bytes, lengths: bytes) -> np.ndarray:
    """First character of every token and the one after its last."""
    gap, length = (np.frombuffer(b, "<i4").astype(np.int64) for b in (gaps, lengths))
    last = np.cumsum(gap + length)
    return np.stack([last - length, last], axis=1)


def runs(on: np.ndarray) -> np.ndarray:
    """First token of every run of the mask and the one after its last."""
    return np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]]))).astype(np.int32)


def _piece(tokenizer: Tokenizer, conv_id: int | None, piece: int, final: bool, turns: list[tuple[str, str]]) -> tuple:
    text, spans, at = [], [], 0
    for role, said in turns:
        head = f"{START}{escape(role)}{SEPARATOR}"
        body = escape(said)
        if role == "assistant" and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        text.append(f"{head}{body}{END}")
        at += len(text[-1])
    rendered = "".join(text)
    encoded = tokenizer.encode(rendered, add_special_tokens=False)
    offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
    loss = mask(offsets, np.array(spans, np.int64).reshape(-1, 2))
    return conv_id, piece, final, rendered, np.array(encoded.ids, "<i4").tobytes(), *packed(offsets), runs(loss)


_TYPES = (pa.int64(), pa.int32(), pa.bool_(), pa.string(), *[pa.binary()] * 3, pa.list_(pa.int32()))
_NAMES = ("conv_id", "piece", "final", "text", "ids", "gaps", "lengths", "loss")


def _formatted(path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chat_tokenizer(path)
        current, piece, held, size, out = object(), 0, [], 0, []

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], _NAMES)

        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if held and (conv_id != current or size >= PIECE_CHARS):
                    out.append(_piece(tokenizer, current, piece, conv_id != current, held))
                    piece, held, size = piece + 1, [], 0
                    if len(out) >= 200 or sum(len(o[3]) for o in out[-20:]) >= PIECE_CHARS:
                        yield full()
                        out = []
                if conv_id != current:
                    current, piece = conv_id, 0
                held.append((role, text))
                size += len(text) + len(role)
        if held:
            out.append(_piece(tokenizer, current, piece, True, held))
        if out:
            yield full()

    return write


def format_chats(conversations: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Render, encode and mask every conversation, write the result to ``folder`` and read it back.

    Turns follow ``turn`` (then role and text, so that ties have one order); NULL turns come
    first, NULL roles and texts are empty, NULL conv_ids are one conversation.  Rows are
    dealt by conversation and streamed in order, so a task holds one piece at a time, however
    long its conversations are.  Repeated rows are turns of their own; an empty table gives
    empty output; other columns are ignored.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    out = ordered.select("conv_id", "role", "text").mapInArrow(_formatted(tokenizer), FORMATTED)
    out.write.option("compression", "zstd").parquet(folder)
    return conversations.sparkSession.read.schema(FORMATTED).parquet(folder)


def _spoken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read pieces in order and digest what they say and what their masks cover."""
    current, state = object(), None

    def begin() -> dict:
        return {"turns": 0, "said": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0}

    out: list[tuple] = []

    def done() -> None:
        out.append((current, state["turns"], state["said"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["all"]))

    def full() -> pa.RecordBatch:
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = zip(*out) if out else [()] * len(names)
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        out.clear()
        return made

    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
            conv_id, text, gaps, lengths, loss = row
            if conv_id != current:
                if state:
                    done()
                current, state = conv_id, begin()
            for role, said in _TURN.findall(text):
                state["turns"] += 1
                state["said"].update(f"{unescape(role)}\n{unescape(said)}\n".encode())
            state["all"] += len(text)
            for covered in masked_text(text, offsets_of(gaps, lengths), loss):
                state["chars"] += len(covered)
                state["loss"].update(covered.encode())
        yield full()
    if state:
        done()
        yield full()


def masked_text(text: str, offsets: np.ndarray, loss: list[int]) -> list[str]:
    """The unescaped texts under the mask, one per run of masked tokens.

    A character whose bytes are spread over several tokens has the same offsets in each, and
    counts once.
    """
    spans = zip(loss[::2], loss[1::2])
    return [unescape(text[offsets[a, 0] : offsets[a:b, 1].max()]) for a, b in spans]


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` as read from
    the output: turns by its markers, loss text by its masks and offsets.

    Whole conversations are read where they lie; only those cut into pieces are put in order.
    """
    columns = ["conv_id", "text", "gaps", "lengths", "loss"]
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    whole = F.col("final") & (F.col("piece") == 0)
    cut = formatted.where(~whole).repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return formatted.where(whole).select(*columns).mapInArrow(_spoken, schema).union(cut.select(*columns).mapInArrow(_spoken, schema))


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: control strings inside its texts."""
    said = f"{END}{START}assistant ok"
    return spark.sql("select -1L as conv_id, t.turn, t.role, '' as text from values (0, 'user'), (1, 'assistant') t(turn, role)").withColumn(
        "text", F.lit(said)
    )
