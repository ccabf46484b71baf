r"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole as a run of turns

    <|turn|>role<|text|>text<|end|>

and encoded once. Inside roles and texts a backslash becomes two and `<|` becomes `<\|`, so a text can hold no
marker and the escape undoes itself. The markers are special tokens, so no token crosses the border of a turn.
Byte-level tokens say how many bytes they cover; their running sum gives offsets, and two binary searches per
assistant turn turn its byte span into a token span of the mask.

Defined cases: a null text or role is empty; turns go by number, null first, then by role and text; repeated
rows are separate turns; rows with a null conversation id form one conversation; a conversation without
assistant has an empty mask; an empty table gives an empty result; extra columns are never read. A
conversation is one training text, so its whole text lies in one row; nothing larger than that is gathered.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

TURN, TEXT, END = MARKERS = ("<|turn|>", "<|text|>", "<|end|>")
LEARNED = "assistant"

FORMATTED = ("conv_id long, formatted string, ids binary, mask binary, loss_starts array<int>, loss_ends array<int>")
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    # No marker or escape overlaps another, so undoing them in the opposite order restores the text.
    return text.replace("<\\|", "<|").replace("\\\\", "\\") if "\\\\" not in text else _unescape_slowly(text)


def _unescape_slowly(text: str) -> str:
    out, i = [], 0
    while (j := text.find("\\", i)) >= 0:
        out += [text[i:j], text[j + 1]]
        i = j + 2
    return "".join([*out, text[i:]])


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, byte spans of the texts to learn) of (role, text) turns."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        begin = at + len(head.encode())
        at = begin + len(body.encode())
        if role == LEARNED:
            spans.append((begin, at))
        parts += [head, body, END]
        at += len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns that were rendered."""
    turns = []
    for turn in formatted.split(END)[:-1]:
        role, text = turn.removeprefix(TURN).split(TEXT)
        turns.append((unescape(role), unescape(text)))
    return turns


class Encoder:
    """Byte-level encoder from a public rank file, with the markers as special tokens."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
        first = max(ranks.values()) + 1
        special = {m: first + i for i, m in enumerate(MARKERS)}
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.width = np.zeros(first + len(MARKERS), np.int64)
        for token, i in [*ranks.items(), *((m.encode(), i) for m, i in special.items())]:
            self.width[i] = len(token)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, byte offset at which each token ends)."""
        ids = np.array(self.encoding.encode(text, allowed_special="all"), np.uint32)
        return ids, np.cumsum(self.width[ids])


def token_spans(ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one token of each sorted byte span: the tokens that share a byte with it."""
    if not spans:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = np.array(spans).T
    first = np.searchsorted(ends, low, side="right")
    last = np.searchsorted(np.concatenate([[0], ends[:-1]]), high, side="left") if len(ends) else first
    return first, np.maximum(np.where(high > low, last, first), first)


def _turns(cell) -> list[tuple[str, str]]:
    return [(t["role"] or "", t["text"] or "") for t in cell]


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns, bytes): one row per conversation, turns in order."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                    F.col("text").cast("string").alias("text"))
    return rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))


def format_chats(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(conv_id, formatted, ids, mask, loss_starts, loss_ends): ids are little-endian 32-bit, mask a byte per id,
    and the spans are bytes of the formatted text in UTF-8."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path, pattern)
        schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("ids", pa.binary()),
                            ("mask", pa.binary()), ("loss_starts", pa.list_(pa.int32())),
                            ("loss_ends", pa.list_(pa.int32()))])
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                out = []
                for row in batch.slice(low, 256).to_pylist():
                    formatted, spans = render(_turns(row["turns"]))
                    ids, ends = encoder.encode(formatted)
                    mask = np.zeros(len(ids), np.uint8)
                    for a, b in zip(*token_spans(ends, spans)):
                        mask[a:b] = 1
                    out.append({"conv_id": row["conv_id"], "formatted": formatted, "ids": ids.astype("<u4").tobytes(),
                                "mask": mask.tobytes(), "loss_starts": [s[0] for s in spans],
                                "loss_ends": [s[1] for s in spans]})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return conversations(rows).mapInArrow(run, FORMATTED)


def read_back(chats: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digests of formatted conversations, taken from the formatted text, the ids and the mask alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path, pattern)
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                            ("n_tokens", pa.int64()), ("loss_tokens", pa.int64())])
        for piece in slices(batches, "formatted", 4 << 20):
            out = []
            for row in piece.to_pylist():
                turns = parse(row["formatted"])
                whole = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode())
                raw, ids = row["formatted"].encode(), np.frombuffer(row["ids"], "<u4")
                mask = np.frombuffer(row["mask"], np.uint8).astype(bool)
                ends = np.cumsum(encoder.width[ids])
                starts = ends - encoder.width[ids]
                edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
                runs = zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))
                learned = "".join(unescape(raw[starts[a]:ends[b - 1]].decode()) for a, b in runs)
                out.append({"conv_id": row["conv_id"], "n_turns": len(turns), "turns_sha256": whole.hexdigest(),
                            "loss_chars": len(learned), "loss_sha256": hashlib.sha256(learned.encode()).hexdigest(),
                            "formatted_chars": len(row["formatted"]), "n_tokens": len(ids),
                            "loss_tokens": int(mask.sum())})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return chats.mapInArrow(run, DIGEST)


PLANTED = r"\### Assistant: </turn> ok"


def query(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    spark = rows.sparkSession
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(LEARNED).alias("role"),
                                  F.lit(PLANTED).alias("text"))
    every = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    digest = read_back(format_chats(every, ranks_path, pattern), ranks_path, pattern)
    return digest.drop("n_tokens", "loss_tokens")


ORACLE = r"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *, length(replace(replace(role || chr(0) || text, '\', '\\'), '<|', '<\|')) - 1 AS n FROM every
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(n + 8 + 8 + 7) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""
