"""Chat formatting by a small template compiler.

A template is text with ``{{ expression }}`` outputs and ``{% ... %}`` blocks::

    {% for turn in turns %}...{% endfor %}
    {% if expression %}...{% elif expression %}...{% else %}...{% endif %}
    {% generation %}...{% endgeneration %}

Expressions: names, ``turn.field``, ``'strings'``, integers, ``true``/``false``/``none``, ``==``,
``!=``, ``+``, ``and``, ``or``, ``not``, parentheses and ``| filter``. It is sandboxed: a field is
a key of a mapping, a filter comes from a fixed list, and nothing else of Python can be reached.
The template is parsed to a syntax tree, constant parts are folded (text is joined, constant
outputs and branches are decided), and the rest becomes Python closures that yield pieces
``(text, inside a generation block)``; loops take any iterator, so a conversation is rendered turn
by turn whatever its length.

Control strings inside texts are escaped with a backslash, backslashes are doubled; reading the
output back undoes it. What the generation blocks yield is the loss mask.

Defined results: null roles and texts are empty; rows of a conversation come by turn, then role,
then text (nulls first); repeated rows are turns of their own; a null conv_id is a conversation
of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, HEAD, END = "<turn>", "### ", "</turn>"
TEMPLATE = (
    "{% for turn in turns %}" + BEGIN + HEAD + "{{ turn.role | escape_role }}: "
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}"
    "{% else %}{{ turn.text | escape }}{% endif %}" + END + "\n{% endfor %}"
)

_CONTROL = "|".join(map(re.escape, (BEGIN, END, HEAD)))
_TO_ESCAPE = re.compile(rf"\\|{_CONTROL}")
_ROLE_TO_ESCAPE = re.compile(rf"\\|:|{_CONTROL}")
_ESCAPED = re.compile(rf"\\(\\|:|{_CONTROL})")
_STEP = re.compile(rf"\\(?:\\|:|{_CONTROL})|{re.escape(END)}\n")


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"\\\g<0>", text)


def escape_role(role: str) -> str:
    return _ROLE_TO_ESCAPE.sub(r"\\\g<0>", role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "escape_role": escape_role,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}

# ---- syntax tree: tuples (kind, ...) ------------------------------------------------------

_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[+().|]))")
_CONSTANTS = {"true": True, "false": False, "none": None}


class TemplateError(ValueError):
    """A template that doesn't parse or asks for something outside the sandbox."""


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:]!r}")
            self.tokens.append((m.lastindex, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != 1 and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self) -> tuple:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.added()
        while op := self.take("==", "!="):
            node = (op, node, self.added())
        return node

    def added(self) -> tuple:
        node = self.filtered()
        while self.take("+"):
            node = ("+", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.atom()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else (0, "end")
            if kind != 3 or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def atom(self) -> tuple:
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == 1:
            return ("constant", re.sub(r"\\(.)", r"\1", value[1:-1], flags=re.S))
        if kind == 2:
            return ("constant", int(value))
        if kind != 3:
            raise TemplateError(f"unexpected {value!r}")
        if value in _CONSTANTS:
            return ("constant", _CONSTANTS[value])
        node = ("name", value)
        while self.take("."):
            kind, field = self.tokens[self.at] if self.at < len(self.tokens) else (0, "end")
            if kind != 3 or field.startswith("_"):
                raise TemplateError(f"no field {field!r}")
            self.at += 1
            node = ("field", node, field)
        return node


def parse(template: str) -> tuple:
    """The syntax tree of a template."""
    pieces, at = [], 0
    for m in _PIECE.finditer(template):
        pieces += [("text", template[at : m.start()]), ("out", m[1]) if m[1] is not None else ("block", m[2].strip())]
        at = m.end()
    pieces.append(("text", template[at:]))
    pieces.reverse()

    def body(*ends: str) -> tuple[tuple, str]:
        nodes: list[tuple] = []
        while pieces:
            kind, value = pieces.pop()
            if kind == "text":
                nodes.append(("text", value))
            elif kind == "out":
                nodes.append(("out", _Expression(value).whole()))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return ("body", nodes), value
                if word == "for":
                    m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                    if not m:
                        raise TemplateError(f"bad loop {value!r}")
                    nodes.append(("for", m[1], _Expression(m[2]).whole(), body("endfor")[0]))
                elif word == "generation":
                    nodes.append(("generation", body("endgeneration")[0]))
                elif word == "if":
                    branches, other, test = [], ("body", []), rest
                    while True:
                        inside, end = body("elif", "else", "endif")
                        branches.append((_Expression(test).whole(), inside))
                        word, _, test = end.partition(" ")
                        if word == "else":
                            other = body("endif")[0]
                        if word != "elif":
                            break
                    nodes.append(("if", branches, other))
                else:
                    raise TemplateError(f"unknown block {value!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return ("body", nodes), ""

    return body()[0]


def _text(value: object) -> str:
    return "" if value is None else str(value)


def _operate(op: str, *values: object) -> object:
    if op == "==":
        return values[0] == values[1]
    if op == "!=":
        return values[0] != values[1]
    if op == "+":
        a, b = values
        return a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b)
    if op == "not":
        return not values[0]
    return FILTERS[op](_text(values[0]))


def fold(node: tuple) -> tuple:
    """The tree with constant expressions computed, constant branches decided and text joined."""
    kind = node[0]
    if kind in ("==", "!=", "+", "not"):
        parts = [fold(x) for x in node[1:]]
        if all(p[0] == "constant" for p in parts):
            return ("constant", _operate(kind, *(p[1] for p in parts)))
        return (kind, *parts)
    if kind in ("and", "or"):
        left, right = fold(node[1]), fold(node[2])
        if left[0] == "constant":
            return right if bool(left[1]) == (kind == "and") else left
        return (kind, left, right)
    if kind == "filter":
        inner = fold(node[2])
        return ("constant", _operate(node[1], inner[1])) if inner[0] == "constant" else (kind, node[1], inner)
    if kind == "field":
        return (kind, fold(node[1]), node[2])
    if kind == "out":
        inner = fold(node[1])
        return ("text", _text(inner[1])) if inner[0] == "constant" else (kind, inner)
    if kind == "for":
        return (kind, node[1], fold(node[2]), fold(node[3]))
    if kind == "generation":
        return (kind, fold(node[1]))
    if kind == "if":
        branches, other = [], fold(node[2])
        for test, inside in node[1]:
            test = fold(test)
            if test[0] != "constant":
                branches.append((test, fold(inside)))
            elif test[1]:
                other = fold(inside)
                break
        return (kind, branches, other) if branches else other
    if kind == "body":
        nodes: list[tuple] = []
        for x in map(fold, node[1]):
            for y in x[1] if x[0] == "body" else [x]:
                if y[0] == "text" and nodes and nodes[-1][0] == "text":
                    nodes[-1] = ("text", nodes[-1][1] + y[1])
                elif y != ("text", ""):
                    nodes.append(y)
        return (kind, nodes)
    return node


Pieces = Iterator[tuple[str, bool]]


def _value(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "constant":
        return lambda scope, v=node[1]: v
    if kind == "name":
        return lambda scope, n=node[1]: scope.get(n)
    if kind == "field":
        inner, field = _value(node[1]), node[2]

        def get(scope: dict) -> object:
            value = inner(scope)
            return value.get(field) if isinstance(value, dict) else None

        return get
    if kind == "filter":
        inner, apply = _value(node[2]), FILTERS[node[1]]
        return lambda scope: apply(_text(inner(scope)))
    if kind == "and":
        a, b = _value(node[1]), _value(node[2])
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        a, b = _value(node[1]), _value(node[2])
        return lambda scope: a(scope) or b(scope)
    parts = [_value(x) for x in node[1:]]
    return lambda scope: _operate(kind, *(p(scope) for p in parts))


def _render(node: tuple) -> Callable[[dict, bool], Pieces]:
    kind = node[0]
    if kind == "text":
        return lambda scope, inside, t=node[1]: iter(((t, inside),))
    if kind == "out":
        value = _value(node[1])
        return lambda scope, inside: iter(((_text(value(scope)), inside),))
    if kind == "generation":
        body = _render(node[1])
        return lambda scope, inside: body(scope, True)
    if kind == "for":
        name, items, body = node[1], _value(node[2]), _render(node[3])

        def loop(scope: dict, inside: bool) -> Pieces:
            for item in items(scope) or ():
                yield from body({**scope, name: item}, inside)

        return loop
    if kind == "if":
        branches, other = [(_value(t), _render(b)) for t, b in node[1]], _render(node[2])

        def choose(scope: dict, inside: bool) -> Pieces:
            for test, body in branches:
                if test(scope):
                    return body(scope, inside)
            return other(scope, inside)

        return choose
    parts = [_render(x) for x in node[1]]

    def every(scope: dict, inside: bool) -> Pieces:
        for part in parts:
            yield from part(scope, inside)

    return every


def compile_template(template: str = TEMPLATE) -> Callable[[Iterable[dict]], Pieces]:
    """A function from turns (mappings with ``role`` and ``text``) to pieces (text, under the loss mask)."""
    body = _render(fold(parse(template)))
    return lambda turns: body({"turns": turns}, False)


class Reader:
    """Reads formatted text of the default template back, piece by piece, one turn in memory."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.held, self.spans, self.at = "", [], 0

    def feed(self, text: str, masked: bool) -> None:
        if masked:
            self.spans.append((len(self.held), len(self.held) + len(text)))
        self.held += text
        self.formatted_chars += len(text)
        while m := _STEP.search(self.held, self.at):
            self.at = m.end()
            if m[0][0] != "\\":
                self._turn(m.start())

    def _turn(self, end: int) -> None:
        head = BEGIN + HEAD
        if not self.held.startswith(head):
            raise ValueError("a turn doesn't begin with its mark")
        colon = re.compile(r"(?:\\.|[^\\:])*", re.S).match(self.held, len(head)).end()
        role, text = unescape(self.held[len(head) : colon]), unescape(self.held[colon + 2 : end])
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        for a, z in self.spans:
            part = unescape(self.held[a:z])
            self.loss.update(part.encode())
            self.loss_chars += len(part)
        self.held, self.spans, self.at = self.held[self.at :], [], 0


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """(conv_id, turns) of rows sorted by conv_id; the turns of one are used before the next."""
    rows = (
        {"conv_id": c, "role": r or "", "text": t or ""}
        for b in batches
        for c, r, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)
    )
    held = next(rows, None)

    def turns() -> Iterator[dict]:
        nonlocal held
        conv = held["conv_id"]
        while held is not None and held["conv_id"] == conv:
            yield held
            held = next(rows, None)

    while held is not None:
        conv = held["conv_id"]
        yield conv, turns()


def _sorted(turns: DataFrame) -> DataFrame:
    rows = turns.select(F.col("conv_id").cast("long"), "turn", "role", "text")
    return (
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    )


def _in_batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)  # noqa: B905
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)  # noqa: B905


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, formatted, loss_spans) of each conversation; the spans are code point ranges."""
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def rows() -> Iterator[tuple]:
            for conv, own in _conversations(batches):
                parts, masked, at = [], [], 0
                for text, inside in render(own):
                    if inside:
                        masked.append({"start": at, "end": at + len(text)})
                    parts.append(text)
                    at += len(text)
                yield conv, "".join(parts), masked

        yield from _in_batches(rows(), ["conv_id", "formatted", "loss_spans"], [pa.int64(), pa.string(), spans])

    return _sorted(turns).mapInArrow(
        run, "conv_id long, formatted string, loss_spans array<struct<start: long, end: long>>"
    )


def format_digests(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Digests of each conversation, read back from its formatted text and mask; a conversation of
    any length passes through with one turn in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def rows() -> Iterator[tuple]:
            for conv, own in _conversations(batches):
                reader = Reader()
                for text, masked in render(own):
                    reader.feed(text, masked)
                yield (conv, reader.n_turns, reader.turns.hexdigest(), reader.loss_chars,
                       reader.loss.hexdigest(), reader.formatted_chars)

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        long, text = pa.int64(), pa.string()
        yield from _in_batches(rows(), names, [long, long, text, long, text, long])

    return _sorted(turns).mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
