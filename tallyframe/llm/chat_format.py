"""Chat formatting with offset-aligned loss masks.

Spark gathers each conversation's turns in order; a task then renders the whole
conversation, encodes it once, and takes the token spans from the encoder's byte
offsets.  Turn spans and token spans are both sorted, so the tokens of a turn are
found by binary search.

Template, one turn after the other::

    <|im_start|>role<|im_sep|>text<|im_end|>

The three markers are special tokens, so no token crosses the border of a text.  A
control string inside a role or a text (a marker of this template or of another
common one) gets a backslash after its first character; where backslashes already
stand there, one more.  Taking one away restores the text, so formatting is reversible.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rows import col

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that steer a chat model in this or another common template.
CONTROL = (
    START, SEP, END, "<|system|>", "<|user|>", "<|assistant|>", "<|tool|>", "<|end|>", "<|endoftext|>", "<|startoftext|>",
    "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<s>", "</s>", "<unk>", "<pad>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>",
)
_REST = "|".join(sorted((re.escape(c[1:]) for c in CONTROL if c[0] == "<"), key=len, reverse=True))
_SQUARE = "|".join(sorted((re.escape(c[1:]) for c in CONTROL if c[0] == "["), key=len, reverse=True))
_PLAIN = re.compile(rf"(<)(\\*)({_REST})|(\[)(\\*)({_SQUARE})")
#: Fixed by the contract: whose text is learnt.
LEARNT = "assistant"
#: Byte-level BPE vocabulary; the markers take ids after its last.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed: the pre-tokenizer pattern this vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: (m[1] or m[4]) + "\\" + (m[2] or m[5] or "") + (m[3] or m[6]), text)


def unescape(text: str) -> str:
    return _PLAIN.sub(lambda m: (m[1] or m[4]) + (m[2] or m[5] or "")[1:] + (m[3] or m[6]), text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted conversation, byte span of each turn's text in it)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEP, escape(text)
        begin = at + len(head.encode())
        end = begin + len(body.encode())
        spans.append((begin, end))
        parts += [head, body, END]
        at = end + len(END)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, text = part.removesuffix(END).split(SEP)
        turns.append((unescape(role), unescape(text)))
    return turns


_ENCODERS: dict = {}


def encoder(path: str):
    """(encoding with the markers as special tokens, byte length of each id); made once a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = _read_encoder(path)
    return _ENCODERS[path]


def _read_encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    special = {marker: 50257 + i for i, marker in enumerate((START, SEP, END))}
    lengths = np.zeros(max(special.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    for marker, rank in special.items():
        lengths[rank] = len(marker)
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), lengths


def encode(formatted: str, path: str = TOKENIZER) -> tuple[np.ndarray, np.ndarray]:
    """(ids, end offset in bytes of each token): one encoding of the whole conversation."""
    encoding, lengths = encoder(path)
    ids = np.array(encoding.encode(formatted, allowed_special="all"), np.int64)
    return ids, np.cumsum(lengths[ids])


def mask(ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens overlap any of the sorted byte ``spans``: two binary searches a span."""
    out = np.zeros(len(ends), bool)
    starts = np.r_[0, ends[:-1]]
    for begin, end in spans:
        if end > begin:
            out[np.searchsorted(ends, begin, "right") : np.searchsorted(starts, end, "left")] = True
    return out


def masked_texts(formatted: str, ends: np.ndarray, learnt: np.ndarray) -> list[str]:
    """The text under each run of masked tokens, still escaped."""
    data = formatted.encode()
    edge = np.flatnonzero(np.diff(np.r_[False, learnt, False].astype(np.int8)))
    starts = np.r_[0, ends]
    return [data[starts[a] : starts[b]].decode() for a, b in zip(edge[::2], edge[1::2], strict=True)]


def gathered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order; equal turn numbers go by role, then text."""
    turn = F.struct(
        col(turn_col).alias("turn"),
        F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = conversations.select(col(conv_col).alias("conv_id"), turn.alias("turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def format_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", tokenizer: str = TOKENIZER, learnt: str = LEARNT) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, ids, ends, loss_mask.

    ``formatted`` is the rendered conversation, ``ids`` its tokens, ``ends`` the byte offset at which each token ends
    and ``loss_mask`` tells the tokens to learn: those of the texts whose role is ``learnt``.  A null role or text is
    empty, a null turn number comes first, a null conv_id is a conversation of its own, repeated rows are turns of
    their own, and an empty table gives an empty result.
    """
    kind = conversations.select(col(conv_col)).schema[0].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, formatted string, ids array<int>, ends array<long>, loss_mask array<boolean>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a conversation at a time bounds the memory
                turns = [(t["role"], t["text"]) for t in batch.column("turns")[i].as_py()]
                formatted, spans = render(turns)
                ids, ends = encode(formatted, tokenizer)
                learn = mask(ends, [s for s, (role, _) in zip(spans, turns, strict=True) if role == learnt])
                yield pa.RecordBatch.from_arrays([
                    batch.column("conv_id").slice(i, 1), pa.array([len(turns)], pa.int64()), pa.array([formatted]),
                    pa.array([ids.astype(np.int32)], pa.list_(pa.int32())), pa.array([ends], pa.list_(pa.int64())),
                    pa.array([learn], pa.list_(pa.bool_()))], ["conv_id", "n_turns", "formatted", "ids", "ends", "loss_mask"])

    return gathered(conversations, conv_col, turn_col, role_col, text_col).mapInArrow(run, schema)
