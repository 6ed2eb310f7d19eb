"""Chat formatting by a small template language that is compiled to closures.

A template has text, ``{{ expression }}``, ``{% for x in messages %}``, ``{% if %}/{% elif %}/{% else %}``,
``{% generation %}`` and ``{# remarks #}``. Expressions know names, ``x.field``, strings, ``+``, ``==``, ``!=``,
``and``, ``or``, ``not``, parentheses and the filters ``| escape``, ``| label``, ``| upper``, ``| lower`` and ``| trim``.
Nothing else can be named: a template reaches the messages and no other object. It is parsed to a
tree, constants in the tree are folded (joined literals, decided branches, neighbouring texts), and each node
turns into one Python closure. What a generation block writes is marked as loss-bearing.

Conversations stream: rows are dealt by conversation, sorted by turn and rendered one message at a time, so that a
conversation of any length takes the memory of one message.

Escaping is reversible: a backslash goes before every backslash, ``<`` and ``#`` of a text, in roles also before
colons and line ends, so that none can contain a turn mark.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.tables import in_tasks

#: Turn marks of the default template; ``###`` and ``</turn>`` are its control strings.
TEMPLATE = (
    "{# one turn after the other, the assistant's words are learnt #}"
    "{% for message in messages %}"
    "{{ '###' + ' ' }}{{ message.role | label }}:\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "\n{{ '</' + 'turn>' }}\n"
    "{% endfor %}"
)
#: The same marks as they stand in the output, for reading it back.
START, HEAD_END, END = "### ", ":\n", "\n</turn>\n"
_CONTROL = re.compile(r"[\\<#]")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def label(text: str) -> str:
    """Escaped so that the end of a turn's head cannot occur in it either."""
    return re.sub(r"[\\<#:\n]", lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "label": label, "upper": str.upper, "lower": str.lower, "trim": str.strip}

# --- parsing ------------------------------------------------------------------------------------------

_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|[+|().]))")


class TemplateError(ValueError):
    pass


class _Expression:
    """Recursive descent over one expression; the tree is made of tuples."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"not understood: {source[at:]!r}")
            self.tokens.append(("text", m[1]) if m[1] else ("name", m[2]) if m[2] else ("sign", m[3]))
            at = m.end()
        self.at = 0
        self.tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"something follows the expression {source!r}")

    def next_is(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def chain(self, below: Callable, *signs: str) -> tuple:
        tree = below()
        while sign := self.next_is(*signs):
            tree = (sign, tree, below())
        return tree

    def either(self) -> tuple:
        return self.chain(self.both, "or")

    def both(self) -> tuple:
        return self.chain(self.negated, "and")

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.next_is("not") else self.chain(self.joined, "==", "!=")

    def joined(self) -> tuple:
        return self.chain(self.filtered, "+")

    def filtered(self) -> tuple:
        tree = self.atom()
        while self.next_is("|"):
            name = self.take("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def take(self, kind: str) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"a {kind} is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def atom(self) -> tuple:
        if self.next_is("("):
            tree = self.either()
            if not self.next_is(")"):
                raise TemplateError("a parenthesis is open")
            return tree
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "text":
            return ("constant", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), self.take("text")[1:-1]))
        tree: tuple = ("name", self.take("name"))
        while self.next_is("."):
            tree = ("field", tree, self.take("name"))
        return tree


def parse(template: str) -> list[tuple]:
    """The tree of a template: text, put, for, if and generation nodes."""
    root: list[tuple] = []
    open_: list[tuple[str, list, list]] = [("", root, root)]  # kind, where new nodes go, what the end closes
    at = 0

    def close(kind: str) -> None:
        if open_[-1][0] != kind:
            raise TemplateError(f"end of {kind} without its start")
        open_.pop()

    for m in _PIECE.finditer(template):
        if m.start() > at:
            open_[-1][1].append(("text", template[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            open_[-1][1].append(("put", _Expression(m[1]).tree))
        if m[2] is None:
            continue
        word, _, rest = m[2].strip().partition(" ")
        if word == "for":
            loop = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not loop:
                raise TemplateError(f"not a loop: {rest!r}")
            body: list[tuple] = []
            open_[-1][1].append(("for", loop[1], _Expression(loop[2]).tree, body))
            open_.append(("for", body, body))
        elif word == "if":
            branches: list = [(_Expression(rest).tree, [])]
            open_[-1][1].append(("if", branches))
            open_.append(("if", branches[0][1], branches))
        elif word in ("elif", "else"):
            if open_[-1][0] != "if":
                raise TemplateError(f"{word} without if")
            branches = open_[-1][2]
            branches.append((_Expression(rest).tree if word == "elif" else ("constant", True), []))
            open_[-1] = ("if", branches[-1][1], branches)
        elif word == "generation":
            body = []
            open_[-1][1].append(("generation", body))
            open_.append(("generation", body, body))
        elif word in ("endfor", "endif", "endgeneration"):
            close(word[3:])
        else:
            raise TemplateError(f"no statement {word!r}")
    if at < len(template):
        open_[-1][1].append(("text", template[at:]))
    if len(open_) > 1:
        raise TemplateError(f"{open_[-1][0]} is not closed")
    return root


# --- folding ------------------------------------------------------------------------------------------


def fold_expression(tree: tuple) -> tuple:
    kind = tree[0]
    if kind in ("constant", "name"):
        return tree
    if kind == "field":
        return (kind, fold_expression(tree[1]), tree[2])
    if kind == "filter":
        inner = fold_expression(tree[2])
        return ("constant", FILTERS[tree[1]](_text(inner[1]))) if inner[0] == "constant" else (kind, tree[1], inner)
    parts = [fold_expression(x) for x in tree[1:]]
    if all(x[0] == "constant" for x in parts):
        return ("constant", _OPERATORS[kind](*(x[1] for x in parts)))
    return (kind, *parts)


def fold(nodes: list[tuple]) -> list[tuple]:
    """The same output with constants evaluated, decided branches taken and neighbouring texts joined."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        if node[0] == "put":
            tree = fold_expression(node[1])
            add(("text", _text(tree[1])) if tree[0] == "constant" else ("put", tree))
        elif node[0] == "for":
            add(("for", node[1], fold_expression(node[2]), fold(node[3])))
        elif node[0] == "generation":
            add(("generation", fold(node[1])))
        elif node[0] == "if":
            branches = []
            for condition, body in node[1]:
                tree = fold_expression(condition)
                if tree[0] == "constant" and not tree[1]:
                    continue
                branches.append((tree, fold(body)))
                if tree[0] == "constant":
                    break
            if branches and branches[0][0][0] == "constant":
                for x in branches[0][1]:
                    add(x)
            elif branches:
                add(("if", branches))
        else:
            add(node)
    return out


# --- closures -----------------------------------------------------------------------------------------


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


_OPERATORS: dict[str, Callable] = {
    "+": lambda a, b: _text(a) + _text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "not": lambda a: not a,
}


def _value(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "constant":
        return lambda scope, value=tree[1]: value
    if kind == "name":
        return lambda scope, name=tree[1]: scope.get(name)
    if kind == "field":
        # Only plain mappings have fields: no attribute of any object can be reached.
        inner = _value(tree[1])
        return lambda scope, name=tree[2]: x.get(name) if isinstance(x := inner(scope), dict) else None
    if kind == "filter":
        inner, apply = _value(tree[2]), FILTERS[tree[1]]
        return lambda scope: apply(_text(inner(scope)))
    parts, operator = [_value(x) for x in tree[1:]], _OPERATORS[kind]
    if kind == "not":
        return lambda scope: operator(parts[0](scope))
    return lambda scope: operator(parts[0](scope), parts[1](scope))


Render = Callable[[dict, bool], Iterator[tuple[str, bool]]]


def _closure(node: tuple) -> Render:
    if node[0] == "text":
        return lambda scope, learnt, text=node[1]: iter(((text, learnt),))
    if node[0] == "put":
        value = _value(node[1])
        return lambda scope, learnt: iter(((_text(value(scope)), learnt),))
    if node[0] == "generation":
        body = _sequence(node[1])
        return lambda scope, learnt: body(scope, True)
    if node[0] == "for":
        name, items, body = node[1], _value(node[2]), _sequence(node[3])

        def loop(scope: dict, learnt: bool) -> Iterator[tuple[str, bool]]:
            for item in items(scope) or ():
                yield from body({**scope, name: item}, learnt)

        return loop
    branches = [(_value(condition), _sequence(body)) for condition, body in node[1]]

    def choice(scope: dict, learnt: bool) -> Iterator[tuple[str, bool]]:
        for condition, body in branches:
            if condition(scope):
                yield from body(scope, learnt)
                return

    return choice


def _sequence(nodes: list[tuple]) -> Render:
    parts = [_closure(x) for x in nodes]

    def run(scope: dict, learnt: bool) -> Iterator[tuple[str, bool]]:
        for part in parts:
            yield from part(scope, learnt)

    return run


def compile_template(template: str) -> Callable[[object], Iterator[tuple[str, bool]]]:
    """A function from messages, taken one by one, to pieces of text and whether each is learnt."""
    run = _sequence(fold(parse(template)))
    return lambda messages: run({"messages": messages}, False)


# --- jobs ---------------------------------------------------------------------------------------------

PIECES = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("loss", pa.bool_())])
TURNS = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            yield from zip(*(x.to_pylist() for x in batch.slice(lo, 256).columns), strict=True)


def _batches(records: Iterator[tuple], schema: pa.Schema, rows: int = 4096, chars: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    held, long = [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for record in records:
        held.append(record)
        long += sum(len(x) for x in record if isinstance(x, str))
        if len(held) >= rows or long >= chars:
            yield made()
            held, long = [], 0
    if held:
        yield made()


def _formatted(template: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def records() -> Iterator[tuple]:
            for conv, own in groupby(_rows(batches), itemgetter(0)):
                messages = ({"role": r, "text": t} for _, _, r, t in own)
                for n, (text, loss) in enumerate(render(messages)):
                    yield conv, n, text, loss

        return _batches(records(), PIECES)

    return run


def _turns(pieces: Iterator[str]) -> Iterator[tuple[str, str]]:
    """Roles and texts out of formatted text that comes in pieces; one turn is held at a time."""
    held: list[str] = []
    tail = ""
    for piece in pieces:
        held.append(piece)
        tail = tail[-len(END) :] + piece
        if END in tail:
            *whole, rest = "".join(held).split(END)
            held = [rest]
            for turn in whole:
                head, _, text = turn.removeprefix(START).partition(HEAD_END)
                yield unescape(head), unescape(text)
        tail = tail[-len(END) :]
    if "".join(held):
        raise ValueError("formatted text ends inside a turn")


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[tuple]:
        for conv, own in groupby(_rows(batches), itemgetter(0)):
            learnt, turns, chars, learnt_chars, n = sha256(), sha256(), 0, 0, 0

            def pieces(own=own, learnt=learnt) -> Iterator[str]:
                nonlocal chars, learnt_chars
                for _, _, text, loss in own:
                    chars += len(text)
                    if loss:
                        plain = unescape(text)
                        learnt_chars += len(plain)
                        learnt.update(plain.encode())
                    yield text

            for role, text in _turns(pieces()):
                n += 1
                turns.update(f"{role}\n{text}\n".encode())
            yield conv, n, turns.hexdigest(), learnt_chars, learnt.hexdigest(), chars

    return _batches(records(), TURNS)


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``(conv_id, piece, text, loss)``: the formatted conversations in pieces, to be joined in order of ``piece``.

    ``rows`` has conv_id, turn, role and text; turns of one number are ordered by role and text, a null turn comes
    first, null roles and texts are empty, rows without conv_id form one conversation, and repeated rows are repeated
    turns. Other columns are ignored. The result lies in order of conversation and piece within its partitions.
    """
    parse(template)  # a wrong template fails here
    wanted = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = wanted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return in_tasks(dealt, _formatted(template), "conv_id long, piece long, text string, loss boolean")


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Counts and digests of the turns and of the learnt text, read back from formatted conversations.

    Takes what :func:`format_conversations` returns with the default template, in its order.
    """
    return in_tasks(
        formatted,
        _read_back,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
