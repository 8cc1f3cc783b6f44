"""Chat formatting: a small sandboxed template language, compiled to Python closures.

A template is text with ``{{ expression }}``, ``{% for x in list %}``, ``{% if %}
/ elif / else``, ``{% set x = expression %}``, ``{% generation %}`` (what is
written inside is marked as the model's own words) and ``{# comments #}``; a
``-`` inside a tag trims the blanks beside it. Expressions know literals, names,
``a.b`` and ``a[b]`` on mappings and lists only, ``not and or``, comparisons,
``in``, ``+ - ~``, ``x if c else y``, ``is [not] defined`` and filters. No Python attribute,
call or import can be reached, and every loop runs over a list that was given.

Text is parsed into a syntax tree; constant parts of it are computed and joined
once; the tree becomes closures that write into an output with marks.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TemplateError(ValueError):
    """A template that is not in the language, or an operation it does not allow."""


# ---------------------------------------------------------------- syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Part:
    of: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """An operation on operands; strict ones may be folded."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Choice:
    test: Any
    yes: Any
    no: Any


@dataclass(frozen=True)
class Defined:
    name: str


@dataclass(frozen=True)
class Filtered:
    name: str
    args: tuple


@dataclass(frozen=True)
class Write:
    value: Any


@dataclass(frozen=True)
class Loop:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Branch:
    test: Any
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


# ---------------------------------------------------------------- what expressions may do


def _add(a, b):
    if isinstance(a, str) and isinstance(b, str) or isinstance(a, int) and isinstance(b, int):
        return a + b
    raise TemplateError("+ takes two strings or two numbers")


def _subtract(a, b):
    if isinstance(a, int) and isinstance(b, int):
        return a - b
    raise TemplateError("- takes two numbers")


def text_of(value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (str, int, float)):
        return str(value)
    raise TemplateError("only text and numbers can be written")


def _part(of, key):
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, list) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    raise TemplateError("parts are taken of mappings and lists only")


OPERATIONS: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "in": lambda a, b: a in b, "+": _add, "-": _subtract, "~": lambda a, b: text_of(a) + text_of(b), "not": operator.not_,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda x: text_of(x).strip(), "upper": lambda x: text_of(x).upper(), "lower": lambda x: text_of(x).lower(),
    "length": len, "default": lambda x, other: other if x is None else x, "first": lambda x: _part(x, 0), "last": lambda x: _part(x, -1),
}


# ---------------------------------------------------------------- parsing

_TAG = re.compile(r"\{%-?|\{\{-?|\{#")
_LEX = re.compile(r"""\s*(?:(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~<>.|()\[\],=]))""")
_CLOSE = {"{%": "%}", "{{": "}}"}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _lex_tag(source: str, at: int, close: str) -> tuple[list[tuple[str, Any]], int, bool]:
    """Tokens up to the closing mark, the place behind it, and whether it trims."""
    tokens: list[tuple[str, Any]] = []
    while True:
        while at < len(source) and source[at].isspace():
            at += 1
        for mark, trims in ((f"-{close}", True), (close, False)):
            if source.startswith(mark, at):
                return tokens, at + len(mark), trims
        found = _LEX.match(source, at)
        if not found:
            raise TemplateError(f"cannot read the tag at {at}")
        kind = found.lastgroup
        raw = found.group(kind)
        value = int(raw) if kind == "int" else re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), raw[1:-1], flags=re.S) if kind == "str" else raw
        tokens.append((kind, value))
        at = found.end()


def _segments(source: str) -> Iterator[tuple[str, Any]]:
    """("text", string), ("{{", tokens) and ("{%", tokens) in order."""
    at, trim = 0, False
    while True:
        tag = _TAG.search(source, at)
        text = source[at : tag.start() if tag else len(source)]
        if trim:
            text = text.lstrip()
        if tag and tag.group().endswith("-"):
            text = text.rstrip()
        if text:
            yield "text", text
        if not tag:
            return
        if tag.group() == "{#":
            end = source.find("#}", tag.end())
            if end < 0:
                raise TemplateError("a comment has no end")
            at, trim = end + 2, False
            continue
        kind = tag.group()[:2]
        tokens, at, trim = _lex_tag(source, tag.end(), _CLOSE[kind])
        yield kind, tokens


class _Expression:
    """Recursive descent over the tokens of a tag."""

    def __init__(self, tokens: list[tuple[str, Any]], filters: dict[str, Callable]):
        self.tokens, self.at, self.filters = tokens, 0, filters

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in values

    def accept(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def expect(self, value: str) -> None:
        if not self.accept(value):
            raise TemplateError(f"{value!r} expected")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is expected")

    def done(self) -> None:
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def whole(self):
        out = self.choice()
        self.done()
        return out

    def choice(self):
        value = self.either()
        if self.accept("if"):
            test = self.either()
            self.expect("else")
            return Choice(test, value, self.choice())
        return value

    def either(self):
        value = self.both()
        while self.accept("or"):
            value = Choice(value, value, self.both())
        return value

    def both(self):
        value = self.negated()
        while self.accept("and"):
            value = Choice(value, self.negated(), value)
        return value

    def negated(self):
        return Apply("not", (self.negated(),)) if self.accept("not") else self.compared()

    def compared(self):
        value = self.sum()
        while True:
            if op := self.accept("==", "!=", "<", "<=", ">", ">=", "in"):
                value = Apply(op, (value, self.sum()))
            elif self.accept("is"):
                negative = self.accept("not")
                self.expect("defined")
                if not isinstance(value, Name):
                    raise TemplateError("only names are defined or not")
                value = Apply("not", (Defined(value.name),)) if negative else Defined(value.name)
            else:
                return value

    def sum(self):
        value = self.filtered()
        while op := self.accept("+", "-", "~"):
            value = Apply(op, (value, self.filtered()))
        return value

    def filtered(self):
        value = self.primary()
        while self.accept("|"):
            name, args = self.name(), []
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            if self.accept("("):
                while not self.accept(")"):
                    args.append(self.choice())
                    if not self.peek(")"):
                        self.expect(",")
            value = Filtered(name, (value, *args))
        return value

    def primary(self):
        if self.accept("("):
            value = self.choice()
            self.expect(")")
        elif self.at < len(self.tokens) and self.tokens[self.at][0] in ("str", "int"):
            value = Const(self.tokens[self.at][1])
            self.at += 1
        else:
            name = self.name()
            value = Const({"true": True, "false": False, "none": None}[name]) if name in ("true", "false", "none") else Name(name)
        while True:
            if self.accept("."):
                value = Part(value, Const(self.name()))
            elif self.accept("["):
                value = Part(value, self.choice())
                self.expect("]")
            else:
                return value


def parse(source: str, filters: dict[str, Callable] = FILTERS) -> tuple:
    """The syntax tree of a template."""
    segments = list(_segments(source))
    at = 0

    def block(ends: tuple[str, ...]) -> tuple[tuple, str | None, _Expression | None]:
        nonlocal at
        nodes: list = []
        while at < len(segments):
            kind, value = segments[at]
            at += 1
            if kind == "text":
                nodes.append(Write(Const(value)))
                continue
            tokens = _Expression(value, filters)
            if kind == "{{":
                nodes.append(Write(tokens.whole()))
                continue
            word = tokens.name()
            if word in ends:
                return tuple(nodes), word, tokens
            if word == "for":
                name = tokens.name()
                tokens.expect("in")
                over = tokens.whole()
                body, _, end = block(("endfor",))
                end.done()
                nodes.append(Loop(name, over, body))
            elif word == "if":
                nodes.append(branch(tokens))
            elif word == "set":
                name = tokens.name()
                tokens.expect("=")
                nodes.append(Assign(name, tokens.whole()))
            elif word == "generation":
                tokens.done()
                body, _, end = block(("endgeneration",))
                end.done()
                nodes.append(Generation(body))
            else:
                raise TemplateError(f"unexpected tag {word!r}")
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(nodes), None, None

    def branch(tokens: _Expression) -> Branch:
        test = tokens.whole()
        yes, end, rest = block(("elif", "else", "endif"))
        no: tuple = ()
        if end == "elif":
            no = (branch(rest),)
        elif end == "else":
            rest.done()
            no, _, rest = block(("endif",))
            rest.done()
        else:
            rest.done()
        return Branch(test, yes, no)

    return block(())[0]


# ---------------------------------------------------------------- folding


def fold(node, filters: dict[str, Callable] = FILTERS):
    """The same tree with constant parts computed, dead branches gone and neighbouring text joined."""
    if isinstance(node, tuple):
        return _joined([fold(x, filters) for x in node], filters)
    if isinstance(node, (Apply, Filtered)):
        args = tuple(fold(x, filters) for x in node.args)
        if all(isinstance(x, Const) for x in args):
            run = OPERATIONS[node.op] if isinstance(node, Apply) else filters[node.name]
            try:
                return Const(run(*[x.value for x in args]))
            except (TemplateError, TypeError):
                pass  # an error where it stands, if that place is ever reached
        return replace(node, args=args)
    if isinstance(node, Part):
        return Part(fold(node.of, filters), fold(node.key, filters))
    if isinstance(node, Choice):
        test = fold(node.test, filters)
        if isinstance(test, Const):
            return fold(node.yes if test.value else node.no, filters)
        return Choice(test, fold(node.yes, filters), fold(node.no, filters))
    if isinstance(node, (Write, Assign)):
        return replace(node, value=fold(node.value, filters))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.over, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    if isinstance(node, Branch):
        return Branch(fold(node.test, filters), fold(node.yes, filters), fold(node.no, filters))
    return node


def _joined(nodes: list, filters) -> tuple:
    out: list = []
    for node in nodes:
        inner = [node]
        if isinstance(node, Branch) and isinstance(node.test, Const):
            inner = list(node.yes if node.test.value else node.no)
        for x in inner:
            constant = isinstance(x, Write) and isinstance(x.value, Const)
            if constant:
                x = Write(Const(text_of(x.value.value)))
                if out and isinstance(out[-1], Write) and isinstance(out[-1].value, Const):
                    out[-1] = Write(Const(out[-1].value.value + x.value.value))
                    continue
            out.append(x)
    return tuple(out)


# ---------------------------------------------------------------- closures


class Output:
    """What a template writes: text, and the marked stretches of it in code points."""

    def __init__(self):
        self.parts, self.at, self.marks = [], 0, []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.at += len(text)


def _value(node, filters) -> Callable[[dict], Any]:
    """A closure that computes an expression from the names in scope."""
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):
        return lambda scope, name=node.name: scope.get(name)
    if isinstance(node, Defined):
        return lambda scope, name=node.name: name in scope
    if isinstance(node, Part):
        of, key = _value(node.of, filters), _value(node.key, filters)
        return lambda scope: _part(of(scope), key(scope))
    if isinstance(node, Choice):
        test, yes, no = (_value(x, filters) for x in (node.test, node.yes, node.no))
        return lambda scope: yes(scope) if test(scope) else no(scope)
    run = OPERATIONS[node.op] if isinstance(node, Apply) else filters[node.name]
    args = [_value(x, filters) for x in node.args]
    return lambda scope: run(*[a(scope) for a in args])


def _steps(nodes: tuple, filters) -> Callable[[dict, Output], None]:
    made = [_step(n, filters) for n in nodes]

    def run(scope: dict, out: Output) -> None:
        for step in made:
            step(scope, out)

    return run


def _step(node, filters) -> Callable[[dict, Output], None]:
    if isinstance(node, Write):
        if isinstance(node.value, Const):
            return lambda scope, out, text=node.value.value: out.write(text)
        value = _value(node.value, filters)
        return lambda scope, out: out.write(text_of(value(scope)))
    if isinstance(node, Assign):
        value = _value(node.value, filters)
        return lambda scope, out: scope.__setitem__(node.name, value(scope))
    if isinstance(node, Branch):
        test, yes, no = _value(node.test, filters), _steps(node.yes, filters), _steps(node.no, filters)
        return lambda scope, out: (yes if test(scope) else no)(scope, out)
    if isinstance(node, Generation):
        body = _steps(node.body, filters)

        def generation(scope: dict, out: Output) -> None:
            start = out.at
            body(scope, out)
            out.marks.append((start, out.at))

        return generation
    over, body = _value(node.over, filters), _steps(node.body, filters)

    def loop(scope: dict, out: Output) -> None:
        items = over(scope)
        if not isinstance(items, list):
            raise TemplateError("loops run over lists only")
        for i, item in enumerate(items):
            body({**scope, node.name: item, "loop": {"index": i + 1, "first": i == 0, "last": i == len(items) - 1}}, out)

    return loop


def compile_template(source: str, filters: dict[str, Callable] | None = None) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from names to (text, marked stretches)."""
    known = FILTERS | (filters or {})
    run = _steps(fold(parse(source, known), known), known)

    def render(names: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run(dict(names), out)
        return "".join(out.parts), out.marks

    return render


# ---------------------------------------------------------------- the chat format

CHAT = """{% for turn in turns %}<|im_start|>{{ turn.role | role }}
{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}{% else %}{{ turn.text | escape }}{% endif %}<|im_end|>
{% endfor %}"""

_OPENS = re.compile(r"<(\\*)\|")
_OPENED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    """No control string is left: every ``<`` with any backslashes before a ``|`` gets one more."""
    return _OPENS.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _OPENED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


CHAT_FILTERS = {"escape": escape, "role": escape_role}


def _conversations(batches, key: str) -> Iterator[tuple[Any, list[dict]]]:
    """(id, turns) from rows sorted by conversation."""
    current, turns, any_row = None, [], False
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in (key, "role", "text"))):
            if any_row and conv != current:
                yield current, turns
                turns = []
            current, any_row = conv, True
            turns.append({"role": role or "", "text": text or ""})
    if any_row:
        yield current, turns


def format_conversations(rows: DataFrame, *, template: str = CHAT, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, loss_spans): each conversation rendered, with the stretches the model is trained on.

    Turns come in the order of (turn, role, text), nulls first; repeated rows
    are turns like others. Null text and null roles count as empty. Rows without
    a conversation id form one conversation with a null id. Other columns are
    ignored. Rows are dealt by conversation and sorted, and a task holds one
    conversation at a time.
    """
    chosen = rows.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    )
    width = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = chosen.repartition(width, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        render = compile_template(template, CHAT_FILTERS)
        held: list[tuple] = []
        size = 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.string()),
                 pa.array([[{"start": a, "end": b} for a, b in h[2]] for h in held], span)],
                names=["conv_id", "formatted", "loss_spans"],
            )

        for conv, turns in _conversations(batches, "conv_id"):
            text, marks = render({"turns": turns})
            held.append((conv, text, marks))
            size += len(text)
            if size >= 4 << 20:
                yield batch()
                held, size = [], 0
        yield batch()

    return ordered.mapInArrow(run, "conv_id long, formatted string, loss_spans array<struct<start:long,end:long>>")


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from the formatted text."""
    return [(unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, from the formatted text alone."""

    def run(batches):
        for batch in batches:
            rows = []
            for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans"))):
                turns, whole = turns_of(text), hashlib.sha256()
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                own = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                rows.append((conv, len(turns), whole.hexdigest(), len(own), hashlib.sha256(own.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(run, schema)
