"""Chat formatting: records of any known layout become canonical turns, then one text with marked turns and a loss mask.

The fingerprint of a record is the hash of its nested field paths (``messages[].role``). It selects a declarative layout:
which paths hold turns, in which order, under which role names. A layout states optional paths, so it owns several
fingerprints. Records of an unknown layout stay, with layout null, no turns and their fingerprint, so that a layout can be added.

The template marks turns. Control strings inside roles and texts get a backslash after their first character, one more if
they have some already; reading back takes one away. So a marked text is read back exactly, whatever the texts contain.

Null or missing texts and roles are empty. Null records and empty lists give no turns. Equal records give equal rows; nothing is
dropped. All columns of the input pass through inside ``doc``, so names cannot clash. Very long texts are handled whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.arrays import text_of, tidy, whole

Turn = tuple[str, str]


@dataclass(frozen=True)
class Part:
    """A field that holds one turn; with ``join`` its text is added to the turn before it."""

    path: str
    role: str
    optional: bool = False
    join: str | None = None


@dataclass(frozen=True)
class Layout:
    """Turns of a record: single fields first, then the items of a list, then single fields again."""

    name: str
    first: tuple[Part, ...] = ()
    items: str | None = None
    role: str = "role"
    text: str = "content"
    pair: tuple[str, str] | None = None
    roles: dict[str, str] = field(default_factory=dict)
    then: tuple[Part, ...] = ()
    ignored: tuple[str, ...] = ()

    def paths(self) -> Iterator[frozenset[str]]:
        """All sets of field paths that this layout owns."""
        parts = [*self.first, *self.then]
        free = [p.path for p in parts if p.optional] + list(self.ignored)
        fixed = [p.path for p in parts if not p.optional]
        inside: list[list[str]] = [[]]
        if self.items:
            each = [f"{self.items}[][]"] if self.pair else [f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"]
            inside = [each, [f"{self.items}[]"]]  # an empty list shows no fields
        for chosen in product((False, True), repeat=len(free)):
            for listed in inside:
                yield frozenset([*fixed, *(p for p, c in zip(free, chosen) if c), *listed])

    def turns(self, record: dict) -> list[Turn]:
        out: list[Turn] = []

        def single(parts: tuple[Part, ...]) -> None:
            for p in parts:
                value = at(record, p.path)
                if value is None and p.optional:
                    continue
                if p.join is not None and out:
                    role, text = out[-1]
                    out[-1] = (role, text + p.join + plain(value) if plain(value) else text)
                else:
                    out.append((p.role, plain(value)))

        single(self.first)
        for item in (at(record, self.items) or ()) if self.items else ():
            if self.pair:
                out.extend((role, plain(text)) for role, text in zip(self.pair, item))
            else:
                role = plain(item.get(self.role))
                out.append((self.roles.get(role, role), plain(item.get(self.text))))
        single(self.then)
        return out


LAYOUTS = (
    Layout("messages", items="messages"),
    Layout("speakers", items="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant"}),
    Layout("prompt", first=(Part("system", "system", optional=True), Part("prompt", "user")), then=(Part("completion", "assistant"),)),
    Layout("response", first=(Part("system", "system", optional=True), Part("prompt", "user")), then=(Part("response", "assistant"),)),
    Layout("instruction", first=(Part("system", "system", optional=True), Part("instruction", "user"), Part("input", "user", optional=True, join="\n\n")),
           then=(Part("output", "assistant"),)),
    Layout("history", items="history", pair=("user", "assistant"), first=(Part("system", "system", optional=True),),
           then=(Part("query", "user"), Part("response", "assistant"))),
)


def at(record: object, path: str) -> object:
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def plain(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def field_paths(value: object, path: str = "") -> set[str]:
    """Paths of all fields that hold no further fields; ``[]`` stands for the items of a list."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{path}.{k}" if path else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{path}[]"} if not value else (), *(field_paths(v, f"{path}[]") for v in value))
    return {path}


def fingerprint(paths: set[str] | frozenset[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def registry(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    """Layout by fingerprint; two layouts may not own the same one."""
    known: dict[str, Layout] = {}
    for layout in layouts:
        for paths in layout.paths():
            mark = fingerprint(paths)
            if known.setdefault(mark, layout) is not layout:
                raise ValueError(f"layouts {known[mark].name} and {layout.name} own the same fields")
    return known


@dataclass(frozen=True)
class Template:
    """``start`` role ``between`` text ``end``; ``controls`` are all strings that a model's reader treats as marks."""

    start: str = "<|im_start|>"
    between: str = "\n"
    end: str = "<|im_end|>\n"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    def __post_init__(self):
        if self.between != "\n":
            raise ValueError("a role ends at the end of its line")
        if not {self.start, self.end.rstrip("\n")} <= set(self.controls):
            raise ValueError("the marks of a template must be among its control strings")
        if any(c[0] in c[2:] for c in self.controls if c[:2] != "<<") or any("\\" in c or len(c) < 2 for c in self.controls):
            raise ValueError("the first character of a control string may not occur in it again, nor a backslash")

    def escape(self, text: str) -> str:
        return _pattern(self.controls, False).sub(lambda m: "\\" + m.group(), text) if _hint(self.controls).search(text) else text

    def unescape(self, text: str) -> str:
        return _pattern(self.controls, True).sub(lambda m: m.group()[1:], text) if "\\" in text else text

    def escape_role(self, role: str) -> str:
        return self.escape(role.replace("\\", "\\\\").replace("\n", "\\n"))

    def unescape_role(self, role: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), self.unescape(role))

    def render(self, turns: list[Turn], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
        """The marked text, and start and end (code points) of every learned text in it."""
        out, length, spans = [], 0, []
        for role, text in turns:
            head, body = f"{self.start}{self.escape_role(role)}{self.between}", self.escape(text)
            if role == learned:
                spans.append((length + len(head), length + len(head) + len(body)))
            out += (head, body, self.end)
            length += len(head) + len(body) + len(self.end)
        return "".join(out), spans

    def read(self, formatted: str) -> list[Turn]:
        out, place = [], 0
        while place < len(formatted):
            if not formatted.startswith(self.start, place):
                raise ValueError(f"no turn begins at {place}")
            border = formatted.index(self.between, place + len(self.start))
            stop = formatted.index(self.end, border + len(self.between))
            out.append((self.unescape_role(formatted[place + len(self.start) : border]), self.unescape(formatted[border + len(self.between) : stop])))
            place = stop + len(self.end)
        return out


_COMPILED: dict = {}


def _pattern(controls: tuple[str, ...], escaped: bool) -> re.Pattern:
    """What stands behind the first character of a control string: backslashes, at least one if ``escaped``, and the rest."""
    key = (controls, escaped)
    if key not in _COMPILED:
        tails: dict[str, list[str]] = {}
        for c in controls:
            tails.setdefault(c[0], []).append(re.escape(c[1:]))
        some = r"\\+" if escaped else r"\\*"
        _COMPILED[key] = re.compile("|".join(f"(?<={re.escape(c)}){some}(?:{'|'.join(t)})" for c, t in tails.items()))
    return _COMPILED[key]


def _hint(controls: tuple[str, ...]) -> re.Pattern:
    key = (controls, None)
    if key not in _COMPILED:
        _COMPILED[key] = re.compile("[" + "".join(re.escape(c) for c in sorted({c[0] for c in controls})) + "]")
    return _COMPILED[key]


TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
TEMPLATE = Template()


def _as_rows(turns: list[Turn]) -> list[dict]:
    return [{"role": r, "text": t} for r, t in turns]


def canonical(record: str | None, known: dict[str, Layout]) -> tuple[str, str | None, list[Turn]]:
    """Fingerprint, name of the layout and turns of one record; text that is no JSON counts as a record without fields."""
    try:
        value = json.loads(record) if record else None
    except ValueError:
        value = None
    mark = fingerprint(field_paths(value))
    layout = known.get(mark)
    return mark, layout and layout.name, layout.turns(value) if layout else []


def format_chats(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS, template: Template = TEMPLATE) -> DataFrame:
    """(doc, fingerprint, layout, formatted, loss): JSON texts in column ``record`` as marked texts with a loss mask."""
    doc = records.select(whole(records))
    schema = T.StructType([doc.schema["doc"], T.StructField("fingerprint", T.StringType()), T.StructField("layout", T.StringType()),
                           T.StructField("formatted", T.StringType()), T.StructField("loss", SPANS)])
    where = records.columns.index(record)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, known = to_arrow_schema(schema), registry(layouts)
        for batch in batches:
            marks, names, texts, masks = [], [], [], []
            for value in text_of(batch, where).to_pylist():
                mark, name, turns = canonical(value, known)
                text, spans = template.render(turns)
                marks.append(mark)
                names.append(name)
                texts.append(text)
                masks.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, arrow.field(k + 1).type) for k, v in enumerate((marks, names, texts, masks))]], schema=pa.schema(
                [pa.field("doc", batch.column(0).type), *[arrow.field(k) for k in range(1, 5)]]))

    return doc.mapInArrow(tidy(run), schema)


def read_chats(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(doc, formatted_chars, turns, learned) from marked texts and their loss masks alone."""
    chosen = formatted.select("doc", "formatted", "loss")
    schema = T.StructType([chosen.schema["doc"], T.StructField("formatted_chars", T.LongType()), T.StructField("turns", TURNS),
                           T.StructField("learned", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            sizes, turns, learned = [], [], []
            for text, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                sizes.append(len(text))
                turns.append(_as_rows(template.read(text)))
                learned.append([template.unescape(text[s["start"] : s["end"]]) for s in mask])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, arrow.field(k + 1).type) for k, v in enumerate((sizes, turns, learned))]], schema=pa.schema(
                [pa.field("doc", batch.column(0).type), *[arrow.field(k) for k in range(1, 4)]]))

    return chosen.mapInArrow(tidy(run), schema)
