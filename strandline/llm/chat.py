"""Chat formatting by compiled templates, with the spans a model should learn.

A template is text with ``{{ expression }}``, ``{% for m in messages %}``, ``{% if %} / {% elif %} /
{% else %} / {% endif %}`` and ``{% generation %} / {% endgeneration %}``. Expressions know literals,
``m.role``, ``m.text``, ``loop.first``, ``loop.last``, ``loop.index0``, ``not``, ``and``, ``or``, ``==``,
``!=``, ``+`` and the filters of ``FILTERS``; nothing else can be named, called or reached. A template is parsed into
a tree, constant parts are folded, and each node becomes a Python closure that yields pieces
of text with a flag for generated text.

Messages are pulled one by one, so a conversation of any number of turns streams through its task;
its text leaves in segments of whole turns of about ``SEGMENT`` code points.

Null texts and roles count as empty. Turns are in the order of turn, role and text, nulls first; repeated
rows stay repeated turns. Rows of null conv_id form one conversation. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
CHATML = (
    "{% for m in messages %}{{ '<|im_start|>' + (m.role | header) }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "{{ '<|im_end|>' }}\n{% endfor %}"
)
SEGMENT = 1 << 20


def escape(text: str) -> str:
    """No ``<|`` is left: one backslash more between the two signs."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def header(text: str) -> str:
    """An escaped text on one line."""
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unheader(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "header": header, "trim": str.strip, "lower": str.lower, "upper": str.upper}
FIELDS = {"message": ("role", "text"), "loop": ("first", "last", "index0")}


class TemplateError(ValueError):
    """The template uses something that the language does not have."""


_PART = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|+().]))")


def _lex(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        kind = next(k for k, v in zip(("string", "number", "name", "sign"), m.groups()) if v is not None)
        out.append((kind, m[m.lastindex]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent; nodes are ("const", value), ("field", variable, name), (operator, nodes...)."""

    def __init__(self, source: str, scope: dict[str, str]):
        self.tokens, self.at, self.scope = _lex(source), 0, scope
        self.node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][1] in values and self.tokens[self.at][0] != "string":
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def either(self):
        node = self.both()
        while self.take("or"):
            node = fold(("or", node, self.both()))
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = fold(("and", node, self.negated()))
        return node

    def negated(self):
        return fold(("not", self.negated())) if self.take("not") else self.compared()

    def compared(self):
        node = self.added()
        sign = self.take("==", "!=")
        return fold((sign, node, self.added())) if sign else node

    def added(self):
        node = self.filtered()
        while self.take("+"):
            node = fold(("+", node, self.filtered()))
        return node

    def filtered(self):
        node = self.single()
        while self.take("|"):
            name = self.tokens[self.at][1] if self.at < len(self.tokens) else ""
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = fold(("filter", name, node))
        return node

    def single(self):
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket is not closed")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return "const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1])
        if kind == "number":
            return "const", int(value)
        if value in ("true", "false"):
            return "const", value == "true"
        if kind == "name" and value in self.scope and self.take("."):
            name = self.tokens[self.at][1] if self.at < len(self.tokens) else ""
            if name in FIELDS[self.scope[value]]:
                self.at += 1
                return "field", value, name
        raise TemplateError(f"nothing is known as {value!r}")


def fold(node: tuple) -> tuple:
    """A constant where all parts are constants."""
    parts = [p for p in node[1:] if isinstance(p, tuple)]
    return ("const", _evaluate(node)({})) if all(p[0] == "const" for p in parts) else node


def _evaluate(node: tuple) -> Callable[[dict], object]:
    kind, *parts = node
    if kind == "const":
        return lambda env: parts[0]
    if kind == "field":
        variable, name = parts
        return lambda env: env[variable][name]
    if kind == "filter":
        change, inner = FILTERS[parts[0]], _evaluate(parts[1])
        return lambda env: change(str(inner(env)))
    done = [_evaluate(p) for p in parts]
    if kind == "not":
        return lambda env: not done[0](env)
    if kind == "and":
        return lambda env: done[0](env) and done[1](env)
    if kind == "or":
        return lambda env: done[0](env) or done[1](env)
    if kind == "==":
        return lambda env: done[0](env) == done[1](env)
    if kind == "!=":
        return lambda env: done[0](env) != done[1](env)

    def plus(env):
        a, b = done[0](env), done[1](env)
        return a + b if isinstance(a, int) and isinstance(b, int) else f"{a}{b}"

    return plus


def parse(source: str) -> list[tuple]:
    """The tree: ("text", s), ("value", expression), ("if", [(test, body)...]), ("for", name, body), ("generation", body)."""
    parts, at = [], 0
    for m in _PART.finditer(source):
        parts += [("text", source[at : m.start()])] * (m.start() > at)
        parts.append(("value", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    parts += [("text", source[at:])] * (at < len(source))
    place, loops = 0, 0

    def block(ends: tuple[str, ...], scope: dict[str, str]) -> tuple[list[tuple], str]:
        nonlocal place, loops
        body: list[tuple] = []
        while place < len(parts):
            kind, value = parts[place]
            place += 1
            if kind == "text":
                body.append(("text", value))
                continue
            if kind == "value":
                node = _Expression(value, scope).node
                body.append(("text", str(node[1])) if node[0] == "const" else ("value", node))
                continue
            word = value.split()[0] if value else ""
            if word in ends:
                return _merged(body), value
            if word == "if":
                arms, test = [], value[2:]
                while test is not None:
                    node = _Expression(test, scope).node
                    inner, end = block(("elif", "else", "endif"), scope)
                    arms.append((node, inner))
                    test = end[4:] if end.startswith("elif") else None
                if end == "else":
                    arms.append((("const", True), block(("endif",), scope)[0]))
                body += _pruned(arms)
            elif m := re.fullmatch(r"for\s+([a-z_]\w*)\s+in\s+messages", value):
                loops += 1
                if loops > 1 or "loop" in scope:
                    raise TemplateError("messages stream by once: one loop only")
                body.append(("for", m[1], block(("endfor",), {**scope, m[1]: "message", "loop": "loop"})[0]))
            elif value == "generation":
                body.append(("generation", block(("endgeneration",), scope)[0]))
            else:
                raise TemplateError(f"no tag {value!r}")
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return _merged(body), ""

    return block((), {})[0]


def _pruned(arms: list[tuple]) -> list[tuple]:
    """An if without the arms that constants rule out."""
    kept = []
    for test, body in arms:
        if test[0] == "const":
            if test[1]:
                return body if not kept else [("if", [*kept, (test, body)])]
            continue
        kept.append((test, body))
    return [("if", kept)] if kept else []


def _merged(body: list[tuple]) -> list[tuple]:
    out: list[tuple] = []
    for node in body:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)
    return out


Pieces = Iterator[tuple[str, bool, bool]]  # text, whether generated, whether a turn ends here


def compile_template(source: str) -> Callable[[Iterator[dict]], Pieces]:
    """A function from an iterator of messages (role, text) to pieces."""

    def sequence(nodes: list[tuple], generated: bool):
        steps = [step(n, generated) for n in nodes]

        def run(env) -> Pieces:
            for s in steps:
                yield from s(env)

        return run

    def step(node: tuple, generated: bool):
        kind = node[0]
        if kind == "text":
            piece = (node[1], generated, False)
            return lambda env: (piece,)
        if kind == "value":
            value = _evaluate(node[1])
            return lambda env: ((str(value(env)), generated, False),)
        if kind == "generation":
            return sequence(node[1], True)
        if kind == "if":
            arms = [(_evaluate(test), sequence(body, generated)) for test, body in node[1]]

            def choose(env) -> Pieces:
                for test, body in arms:
                    if test(env):
                        return body(env)
                return iter(())

            return choose
        name, body = node[1], sequence(node[2], generated)

        def each(env) -> Pieces:
            messages, index = env["messages"], 0
            now = next(messages, None)
            while now is not None:
                after = next(messages, None)
                yield from body({**env, name: now, "loop": {"first": index == 0, "last": after is None, "index0": index}})
                yield "", False, True
                now, index = after, index + 1

        return each

    whole = sequence(parse(source), False)
    return lambda messages: whole({"messages": iter(messages)})


FORMATTED = "conv_id long, segment int, formatted string, generated array<struct<start:long,end:long>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_chats(turns: DataFrame, template: str = CHATML) -> DataFrame:
    """FORMATTED rows, the segments of a conversation in order in one partition.

    ``generated`` are spans of code points within the segment. Turns are dealt by conversation and sorted; no group is gathered.
    """
    compile_template(template)  # errors show at once
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        stream = ((c, r, t) for b in batches for c, r, t in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist()))
        held = next(stream, None)
        out: list[tuple] = []
        size = 0

        def own(conv):
            nonlocal held
            while held is not None and held[0] == conv:
                yield {"role": held[1], "text": held[2]}
                held = next(stream, None)

        def pack():
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.string(), _SPAN))]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "segment", "formatted", "generated"])

        while held is not None:
            conv, segment, text, spans, at = held[0], 0, [], [], 0
            for piece, generated, over in render(own(conv)):
                if generated:
                    spans.append({"start": at, "end": at + len(piece)})
                text.append(piece)
                at += len(piece)
                if over and at >= SEGMENT:
                    out.append((conv, segment, "".join(text), spans))
                    size += at
                    segment, text, spans, at = segment + 1, [], [], 0
                    if size >= SEGMENT:
                        yield pack()
                        out, size = [], 0
            if at or not segment:
                out.append((conv, segment, "".join(text), spans))
                size += at
            if size >= SEGMENT:
                yield pack()
                out, size = [], 0
        if out:
            yield pack()

    return rows.mapInArrow(run, FORMATTED)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A mapInArrow function over ``format_chats``' rows of CHATML -> DIGESTS, from the formatted texts and spans alone."""
    state, out = None, []

    def close():
        conv, turns, loss, n, chars, total = state
        out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))

    def pack():
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [f.split()[0] for f in DIGESTS.split(", ")])

    for batch in batches:
        for row in batch.to_pylist():
            if row["segment"] == 0:
                if state:
                    close()
                state = [row["conv_id"], hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
            text, at = row["formatted"], 0
            for m in _TURN.finditer(text):
                if m.start() != at:
                    raise ValueError(f"conversation {row['conv_id']}: no turn at {at}")
                state[1].update(f"{unheader(m[1])}\n{unescape(m[2])}\n".encode())
                state[3] += 1
                at = m.end()
            if at != len(text):
                raise ValueError(f"conversation {row['conv_id']}: text after the last turn")
            for span in row["generated"]:
                learned = unescape(text[span["start"] : span["end"]])
                state[2].update(learned.encode())
                state[4] += len(learned)
            state[5] += len(text)
        if out:
            yield pack()
            out = []
    if state:
        close()
        yield pack()
