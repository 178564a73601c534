"""Conversations as training text: any template is rendered turn by turn, and what each turn adds tells its place."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shipping import ship

#: A turn as templates get it.
Turn = tuple[str, str]

#: Strings that steer models of common chat formats; none is ever found inside a formatted text.
CONTROLS = ("<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
OPEN, CLOSE = CONTROLS[:2]
SPECIAL = re.compile(r"[\\<\[]")
#: Stands where a turn's text goes; private-use characters, which no template treats in a way of its own.
PROBE = "\ue000\ue001\ue000"


def escape(text: str) -> str:
    """Backslashes doubled and one put behind the first character of each control string."""
    if not SPECIAL.search(text):
        return text
    text = text.replace("\\", "\\\\")
    for control in CONTROLS:
        text = text.replace(control, control[0] + "\\" + control[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


class Held(tuple):
    """A turn of a conversation that is held. It is rendered again in every longer prefix and remembers its own rendering."""

    @cached_property
    def marked(self) -> str:
        return one_marked(self)


def marked(turns: list[Turn]) -> str:
    """The library's own template: <|turn|>, role, line end, text, <|end|>, line end."""
    return "".join([t.marked if type(t) is Held else one_marked(t) for t in turns])


def one_marked(turn: Turn) -> str:
    role, text = turn
    return f"{OPEN}{escape(role).replace(chr(10), chr(92) + chr(10))}\n{escape(text)}{CLOSE}\n"


MARKED = re.compile(r"<\|turn\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|end\|>\n", re.S)


def read_marked(formatted: str) -> list[Turn]:
    """The turns of a text in the library's own template."""
    turns, at = [], 0
    while at < len(formatted):
        m = MARKED.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


@dataclass(frozen=True)
class Template:
    """A black box from turns to text, and what is known of it.

    `memory` says how many turns before it a turn's rendering may depend on; None: on all. It is for the reader: no
    turn is placed by it. `escape` is what the template does to a text, `unescape` its inverse.
    """

    render: Callable[[list[Turn]], str]
    memory: int | None = None
    escape: Callable[[str], str] = str
    unescape: Callable[[str], str] = str


OWN = Template(marked, 1, escape, unescape)


@dataclass
class Placed:
    """What one more turn did to the rendering."""

    at: int  # where it was put in, counted from the rendering's start
    added: str
    first: int  # the turn's text within what was added; -1 where it isn't found
    last: int
    changed: int  # where earlier text was written anew, -1 if nowhere


def common_head(a: str, b: str) -> int:
    """Length of the longest common beginning."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:  # a[:low] agrees, a[:high] doesn't
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def placed(template: Template, before: list[Turn], turn: Turn, old: str) -> tuple[Placed, str]:
    """Render `turn` behind `before`, which renders as `old`; what was added, and the new rendering."""
    new = template.render([*before, turn])
    head = common_head(old, new)
    if head < len(old) and not (len(new) >= len(old) and new.endswith(old[head:])):
        return Placed(head, "", -1, -1, head), new
    added = new[head:len(new) - (len(old) - head)]
    probed = template.render([*before, (turn[0], PROBE)])
    where, text = probed.find(PROBE, head), template.escape(turn[1])
    first = where - head
    if where < 0 or new[where:where + len(text)] != text or first + len(text) > len(added):
        first = added.find(text) if text else -1  # the template trims or moves it
    return Placed(head, added, first, first + len(text) if first >= 0 else -1, -1), new


class Conversation:
    """Turns of one conversation, taken in order, each placed by comparing the renderings of two successive prefixes.

    Every prefix goes from the conversation's beginning, whatever the template says of its memory, so a conversation
    is held while its turns are placed and costs the square of their number.
    """

    def __init__(self, template: Template):
        self.template = template
        self.turns: list[Turn] = []
        self.whole = ""  # how they are rendered

    @property
    def length(self) -> int:
        return len(self.whole)

    def add(self, turn: Turn) -> Placed:
        """The turn's place in the whole formatted text."""
        turn = Held(turn)
        got, self.whole = placed(self.template, self.turns, turn, self.whole)
        self.turns.append(turn)
        return got


def ordered(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, role, text) with each conversation's rows together and in order."""
    rows = conversations.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")


def by_conversation(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[tuple[object, bool, Turn, Placed]]:
    """Rows (conv, role, text) in order: conversation, whether its first, the turn and its place."""
    last, state = None, None
    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            first = state is None or conv != last
            if first:
                last, state = conv, Conversation(template)
            yield conv, first, (role, text), state.add((role, text))


def formatted_turns(conversations: DataFrame, template: Template = OWN, conv: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn_no, role, at, added, text_from, text_to, changed_from): the formatted text, one row per turn.

    The template is a black box: prefixes of one more turn each are rendered and compared. What the longer one has
    besides the shorter is the turn (`added`, put in at code point `at`; `at` is behind all earlier turns unless the
    template closes the text with an ending). A probe in place of the text tells where the text lies: code points
    text_from to text_to of `added`, null where the template drops or alters the text. Where earlier text comes out
    differently, the template rewrites history: `changed_from` says from where, `added` is empty then and the
    conversation can't be used turn by turn; else it is null. Joined by turn_no, `added` is the formatted text of a
    template without ending.

    Every prefix reaches back to the first turn, whatever the template's `memory`, so a conversation of n turns costs
    2n renderings of n / 2 turns on average and is held by its task. Rows are sorted by conversation, on disk if need
    be, and conversations are streamed.

    Rows go by turn (null first), then role and text; equal rows are turns of their own. Null texts and roles are
    empty; rows without conv_id are one conversation with a null id. Other columns are ignored; no rows give none.
    """
    ship(conversations.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        number = 0
        for conv_id, first, (role_, _), got in by_conversation(batches, template):
            number = 0 if first else number + 1
            found = got.first >= 0
            out.append((conv_id, number, role_, got.at, got.added, got.first if found else None, got.last if found else None,
                        got.changed if got.changed >= 0 else None))
            if len(out) == 4096:
                yield table(out)
                out = []
        if out:
            yield table(out)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = ["conv_id", "turn_no", "role", "at", "added", "text_from", "text_to", "changed_from"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return ordered(conversations, conv, turn, role, text).mapInArrow(
        run, "conv_id long, turn_no long, role string, at long, added string, text_from long, text_to long, changed_from long")


def formatted_digest(conversations: DataFrame) -> DataFrame:
    """Digests of every conversation in the library's own template, read back from what was formatted.

    turns_sha256 is of role, line end, text, line end of each turn read back; loss_* of the assistants' texts under the
    mask, unescaped; formatted_chars counts the formatted text. A digest runs over a conversation in order, so one
    task makes it, holding the conversation whose turns are placed. Nulls and repeats as in `formatted_turns`; no rows give no rows.
    """
    turns = formatted_turns(conversations)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        state = None
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "turn_no", "added", "text_from", "text_to"))
            for conv_id, number, added, first, last in zip(*columns, strict=True):
                if number == 0:
                    if state is not None:
                        out.append(closed(state))
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                (read_role, read_text), = read_marked(added)
                state[1] += 1
                state[2].update(f"{read_role}\n{read_text}\n".encode("utf-8", "surrogatepass"))
                if read_role == "assistant":
                    said = unescape(added[first:last])
                    state[3] += len(said)
                    state[4].update(said.encode("utf-8", "surrogatepass"))
                state[5] += len(added)
            if len(out) >= 4096:
                yield table(out)
                out = []
        if state is not None:
            out.append(closed(state))
        if out:
            yield table(out)

    def closed(state: list) -> tuple:
        return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    # rows leave the formatting in order, and nothing is dealt anew between the two
    return turns.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
