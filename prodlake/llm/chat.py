r"""Chat formatting with budgeted windows (operator 2).

A conversation's turns, in order, are cut into windows of whole turns whose
tokens fit a budget. The running sum of turn tokens (a Spark window function)
gives every span's cost as a difference of two sums: a window takes new turns
while its cost stays within the budget. Every window begins with the
conversation's system turn; from the second window on, the last turns before
it are repeated as history, as far as ``history`` tokens reach. Assistant turns
are targets: the loss mask covers a target's text in the window where it is new
and never where it is repeated. A turn that is larger than the budget by itself
gets a window of its own (``oversize``); nothing is cut off.

Template: ``<|im_start|>ROLE\nTEXT<|im_end|>\n``. Inside texts and roles a
backslash is doubled, and one is put behind the first character of every
control string (those of this template and of other common ones), so none can
be read as control; in roles a line end is escaped alike. Dropping single
backslashes restores the text exactly.

Turns stream through their task in order, a window at a time: memory holds the
open window, not the conversation, so one conversation with a third of all rows
passes as well; its turns stay in order and hence in one task.

Defined results. Null text or role: empty. Null conversation id: one
conversation of its own. Order inside a conversation: turn (null last), then
role, then text; turns that repeat are all kept. The system turn kept is the
first turn, if its role is ``system``; other system turns are ordinary turns.
Empty table: no windows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import chain, islice
from pathlib import Path

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prodlake.llm import byte_bpe

# fixed values: control strings of this template and of other common ones
CONTROL = """
<|im_start|> <|im_end|> <|endoftext|> <|startoftext|> <|system|> <|user|> <|assistant|> <|end|> <|eot_id|>
<|begin_of_text|> <|end_of_text|> <|start_header_id|> <|end_header_id|> <s> </s> <unk> <pad> [INST] [/INST]
<<SYS>> <</SYS>> <start_of_turn> <end_of_turn> <bos> <eos>
""".split()
_START, _END = "<|im_start|>", "<|im_end|>\n"
_HEAD = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_ROLE_END = re.compile(r"(?<!\\)(?:\\\\)*\n")


def escape(text: str) -> str:
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    return _HEAD.sub(r"\1\\", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def render(role: str, text: str) -> tuple[str, int]:
    """A formatted turn and where its text begins."""
    head = f"{_START}{escape_role(role)}\n"
    return f"{head}{escape(text)}{_END}", len(head)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """``role, text, start, end`` of every turn, texts unescaped; start and end
    are the escaped text's place."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(_START, at):
            raise ValueError(f"no turn begins at {at}")
        at += len(_START)
        end = formatted.index(_END, at)
        role_end = _ROLE_END.search(formatted, at).end()
        yield unescape(formatted[at : role_end - 1]), unescape(formatted[role_end:end]), role_end, end
        at = end + len(_END)


# fixed value: how byte-level BPE vocabularies of this kind split a text
_LONG_SPACE = re.compile(r"\s{10000}")
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def token_counter(vocabulary: bytes | None) -> Callable[[list[str]], list[int]]:
    """Counts tokens by a vocabulary file's content (byte-level BPE, a line
    ``base64-token rank`` each), or, without one, words and marks."""
    if vocabulary is None:
        piece = re.compile(r"\w+|[^\w\s]")
        return lambda texts: [sum(1 for _ in piece.finditer(t)) for t in texts]
    v = byte_bpe.vocabulary(vocabulary)
    encoding = tiktoken.Encoding("chat", pat_str=PIECES, mergeable_ranks=v.ranks, special_tokens={})

    def count(text: str) -> int:
        if not _LONG_SPACE.search(text):
            return len(encoding.encode_ordinary(text))
        # the library's pattern gives up on very long runs of white space
        pieces = byte_bpe.Splitter(PIECES, byte_bpe.newer_characters())(text)
        return len(byte_bpe.replay([p.encode() for p in pieces], v)[0])

    return lambda texts: [count(t) for t in texts]


@dataclass
class _Conversation:
    """The open window of one conversation."""

    key: object
    system: tuple | None = None
    system_cost: int = 0
    history: list[tuple] = field(default_factory=list)  # role, text, cost, turn number
    new: list[tuple] = field(default_factory=list)
    start_sum: int = 0  # running sum before the first new turn
    history_cost: int = 0
    turns: int = 0
    window: int = 0


WINDOWS = (
    "window long, first_turn long, n_new long, n_repeated long, has_system boolean, tokens long,"
    " oversize boolean, formatted string, loss array<struct<start:int,end:int>>"
)
_WINDOW_FIELDS = [
    pa.field(name, kind)
    for name, kind in (
        ("window", pa.int64()),
        ("first_turn", pa.int64()),
        ("n_new", pa.int64()),
        ("n_repeated", pa.int64()),
        ("has_system", pa.bool_()),
        ("tokens", pa.int64()),
        ("oversize", pa.bool_()),
        ("formatted", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    )
]


def _close(c: _Conversation, upto: int, budget: int) -> dict:
    parts, loss, size = [], [], 0
    shown = ([c.system] if c.system else []) + c.history
    for i, (role, text, *_rest) in enumerate(shown + c.new):
        turn, head = render(role, text)
        if i >= len(shown) and role == "assistant":
            loss.append({"start": size + head, "end": size + len(turn) - len(_END)})
        parts.append(turn)
        size += len(turn)
    tokens = c.system_cost + c.history_cost + upto - c.start_sum
    row = {
        "conv_id": c.key,
        "window": c.window,
        "first_turn": c.turns,
        "n_new": len(c.new),
        "n_repeated": len(c.history),
        "has_system": c.system is not None,
        "tokens": tokens,
        "oversize": tokens > budget,
        "formatted": "".join(parts),
        "loss": loss,
    }
    c.turns += len(c.new)
    c.window += 1
    return row


def _repeat(c: _Conversation, history: int) -> None:
    """Carry the last turns that fit ``history`` tokens into the next window."""
    kept, cost = [], 0
    for turn in reversed(c.history + c.new):
        if cost + turn[2] > history:
            break
        kept.append(turn)
        cost += turn[2]
    c.history, c.history_cost, c.new = kept[::-1], cost, []


def format_conversations(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = 1024,
    history: int = 256,
    tokenizer: str | None = None,
    batch_rows: int = 512,
) -> DataFrame:
    """One row per window: ``conv_id, window, first_turn`` (number of the first
    new turn, the system turn not counted), ``n_new, n_repeated, has_system,
    tokens, oversize, formatted, loss`` (code point ranges in ``formatted``). A
    conversation's windows come in order out of one partition."""

    # one vocabulary file of fixed size, read here so that executors need no copy
    vocabulary = turns.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes() if tokenizer else None)

    @F.arrow_udf("int")
    def cost(roles: pa.Array, texts: pa.Array) -> pa.Array:
        count = token_counter(vocabulary.value)
        return pa.array(count([render(r, t)[0] for r, t in zip(roles.to_pylist(), texts.to_pylist(), strict=True)]), pa.int32())

    rows = turns.select(
        turns[conv_col].alias("conv_id"),
        turns[turn_col].alias("turn"),
        F.coalesce(turns[role_col], F.lit("")).alias("role"),
        F.coalesce(turns[text_col], F.lit("")).alias("text"),
    ).withColumn("cost", cost("role", "text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    upto = F.sum(F.col("cost").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    # the window function sorts by conversation and turn; the rows keep that order
    placed = rows.select("conv_id", "role", "text", "cost", F.row_number().over(order).alias("number"), upto.alias("upto"))
    conv_type = rows.schema["conv_id"].dataType.simpleString()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        open_: _Conversation | None = None
        last = 0
        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
            for key, role, text, price, number, so_far in zip(*columns, strict=True):
                if open_ is None or number == 1:
                    if open_ and (open_.new or (open_.system and not open_.window)):
                        yield _close(open_, last, budget)
                    open_ = _Conversation(key)
                    if role == "system":
                        open_.system, open_.system_cost = (role, text), price
                        open_.start_sum = last = so_far
                        continue
                used = open_.system_cost + open_.history_cost + so_far - open_.start_sum
                if used > budget and (open_.new or open_.history):
                    if open_.new:
                        yield _close(open_, last, budget)
                        _repeat(open_, history)
                        open_.start_sum = last
                    # history makes room for a turn that fits without it
                    while open_.history and open_.system_cost + open_.history_cost + price > budget:
                        open_.history_cost -= open_.history.pop(0)[2]
                open_.new.append((role, text, price))
                last = so_far
        if open_ and (open_.new or (open_.system and not open_.window)):
            yield _close(open_, last, budget)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([first.schema.field(0), *_WINDOW_FIELDS])
        waiting: list[dict] = []
        for row in windows(chain([first], batches)):
            waiting.append(row)
            if len(waiting) >= batch_rows:
                yield pa.RecordBatch.from_pylist(waiting, schema=schema)
                waiting = []
        if waiting:
            yield pa.RecordBatch.from_pylist(waiting, schema=schema)

    return placed.mapInArrow(run, f"conv_id {conv_type}, {WINDOWS}")


_DIGEST_FIELDS = [
    pa.field(name, pa.string() if name.endswith("256") else pa.int64())
    for name in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows")
]


def read_back(windows: DataFrame) -> DataFrame:
    """One row per conversation, read from the formatted windows alone:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    n_windows``. Needs a conversation's windows in order in one partition, as
    ``format_conversations`` leaves them; a window out of turn raises."""
    conv_type = windows.schema["conv_id"].dataType.simpleString()
    kept = windows.select("conv_id", "window", "has_system", "n_repeated", "formatted", "loss")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        for b in batches:
            schema = pa.schema([b.schema.field(0), *_DIGEST_FIELDS])
            done = []
            for r in b.to_pylist():
                following = state is not None and (state["conv_id"], state["windows"]) == (r["conv_id"], r["window"])
                if r["window"] and not following:
                    raise ValueError(f"window {r['window']} of conversation {r['conv_id']} is out of turn")
                if not r["window"]:
                    if state:
                        done.append(_finish(state))
                    state = dict.fromkeys(("turns", "chars", "size", "windows"), 0)
                    state |= {"conv_id": r["conv_id"], "all": hashlib.sha256(), "loss": hashlib.sha256()}
                # turns shown before: the system turn (but in the first window) and the history
                skip = r["n_repeated"] + (r["has_system"] and r["window"] > 0)
                for role, text, _, _ in islice(parse(r["formatted"]), skip, None):
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{text}\n".encode())
                for span in r["loss"]:
                    target = unescape(r["formatted"][span["start"] : span["end"]])
                    state["chars"] += len(target)
                    state["loss"].update(target.encode())
                state["size"] += len(r["formatted"])
                state["windows"] += 1
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if state:
            yield pa.RecordBatch.from_pylist([_finish(state)], schema=schema)

    columns = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
    return kept.mapInArrow(run, f"conv_id {conv_type}, {columns}")


def _finish(s: dict) -> dict:
    return {
        "conv_id": s["conv_id"],
        "n_turns": s["turns"],
        "turns_sha256": s["all"].hexdigest(),
        "loss_chars": s["chars"],
        "loss_sha256": s["loss"].hexdigest(),
        "formatted_chars": s["size"],
        "n_windows": s["windows"],
    }
