"""A sandboxed template language for conversations: syntax tree, constant folding, closures.

Text with ``{{ expression }}``, ``{% if %}``/``elif``/``else``, ``{% for x in list %}``,
``{% set name = expression %}``, ``{% generation %}`` (its output is under the loss
mask) and ``{# comment #}``; a ``-`` inside a tag strips white space on its side. Expressions know strings, integers,
true, false, none, names, ``x.field``, ``x['field']``, ``x | filter``, ``+ ~ %``, comparisons, ``in``, ``not and or``
and ``a if c else b``. There are no calls, no attributes of Python objects and no loops but over given lists.

A conversation template has one outer loop over ``messages``: what stands before it is
rendered with the first message, what follows with the last, so a message can be rendered
alone, given its number and whether it is the last.
"""

from __future__ import annotations

import re
from collections.abc import Callable

TAG = re.compile(r"\{%(-?)\s*(.*?)\s*(-?)%\}|\{\{(-?)\s*(.*?)\s*(-?)\}\}|\{#(-?).*?(-?)#\}", re.S)
TOKEN = re.compile(r"""\s*(?:('[^']*'|"[^"]*")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>+~%|.\[\]()]))""")
LITERALS = {"true": True, "false": False, "none": None}
COMPARE = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "not in": lambda a, b: a not in b}
JOIN = {"+": lambda a, b: a + b, "~": lambda a, b: shown(a) + shown(b), "%": lambda a, b: remainder(a, b)}
FILTERS = {"trim": lambda x: shown(x).strip(), "upper": lambda x: shown(x).upper(), "lower": lambda x: shown(x).lower(), "length": len}


class TemplateError(ValueError):
    pass


def remainder(a: object, b: object) -> int:
    """Of whole numbers only: a string's % would format."""
    if not (isinstance(a, int) and isinstance(b, int)) or b == 0:
        raise TemplateError("% is for whole numbers")
    return a % b


def shown(x: object) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x)


def member(x: object, key: object) -> object:
    """A field of a mapping or an item of a list; nothing of any other object."""
    if isinstance(x, dict):
        return x.get(key)
    if isinstance(x, list) and isinstance(key, int) and -len(x) <= key < len(x):
        return x[key]
    return None


class Expression:
    """Recursive descent over one expression's tokens, to nested tuples."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, object]] = []
        at = 0
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            text, number, name, sign = m.groups()
            self.tokens.append(("lit", text[1:-1]) if text is not None else ("lit", int(number)) if number else ("word", name) if name else ("sign", sign))
            at = m.end()
            if not source[at:].strip():
                break
        self.at = 0

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "lit" and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, what: str) -> None:
        if not self.take(what):
            raise TemplateError(f"{what} expected")

    def whole(self) -> tuple:
        out = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} not expected")
        return out

    def choice(self) -> tuple:
        out = self.either()
        if self.take("if"):
            when = self.either()
            self.need("else")
            return ("choice", when, out, self.choice())
        return out

    def either(self) -> tuple:
        out = self.both()
        while self.take("or"):
            out = ("or", out, self.both())
        return out

    def both(self) -> tuple:
        out = self.negated()
        while self.take("and"):
            out = ("and", out, self.negated())
        return out

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        out = self.joined()
        while True:
            if self.take("not"):
                self.need("in")
                sign = "not in"
            else:
                sign = self.take(*COMPARE)
            if not sign:
                return out
            out = ("compare", sign, out, self.joined())

    def joined(self) -> tuple:
        out = self.operand()
        while sign := self.take(*JOIN):
            out = ("join", sign, out, self.operand())
        return out

    def operand(self) -> tuple:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        self.at += 1
        if kind == "lit":
            out = ("lit", value)
        elif kind == "word" and value in LITERALS:
            out = ("lit", LITERALS[value])
        elif kind == "word":
            out = ("name", value)
        elif value == "(":
            out = self.choice()
            self.need(")")
        else:
            raise TemplateError("operand expected")
        while sign := self.take(".", "[", "|"):
            if sign == "[":
                out = ("member", out, self.choice())
                self.need("]")
                continue
            kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            self.at += 1
            if kind != "word":
                raise TemplateError("name expected")
            out = ("member", out, ("lit", value)) if sign == "." else ("filter", value, out)
        return out


def parse(source: str) -> list[tuple]:
    """The template as a list of nodes: text, out, if, for, set, generation."""
    pieces: list[tuple[str, str]] = []
    at, strip = 0, False
    for m in TAG.finditer(source):
        text = source[at : m.start()]
        left, right = (m[1], m[3]) if m[2] is not None else (m[4], m[6]) if m[5] is not None else (m[7], m[8])
        text = text.lstrip() if strip else text
        pieces.append(("text", text.rstrip() if left else text))
        if m[2] is not None:
            pieces.append(("tag", m[2]))
        elif m[5] is not None:
            pieces.append(("out", m[5]))
        at, strip = m.end(), bool(right)
    pieces.append(("text", source[at:].lstrip() if strip else source[at:]))
    pieces.reverse()

    def body(*ends: str) -> tuple[list[tuple], str]:
        out: list[tuple] = []
        while pieces:
            kind, x = pieces.pop()
            word, _, rest = x.partition(" ") if kind == "tag" else (kind, "", "")
            if kind == "text":
                if x:
                    out.append(("text", x))
            elif kind == "out":
                out.append(("out", Expression(x).whole()))
            elif word in ends:
                return out, x
            elif word == "if":
                arms, end = [], x
                while True:
                    part, after = body("elif", "else", "endif")
                    arms.append((("lit", True) if end == "else" else Expression(end.partition(" ")[2]).whole(), part))
                    if after == "endif":
                        break
                    if end == "else":
                        raise TemplateError(f"{after} after else")
                    end = after
                out.append(("if", arms))
            elif word == "for" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)):
                out.append(("for", m[1], Expression(m[2]).whole(), body("endfor")[0]))
            elif word == "set" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.*)", rest, re.S)):
                out.append(("set", m[1], Expression(m[2]).whole()))
            elif x == "generation":
                out.append(("generation", body("endgeneration")[0]))
            else:
                raise TemplateError(f"tag {x!r} not known here")
        if ends:
            raise TemplateError(f"{ends[-1]} missing")
        return out, ""

    return body()[0]


def fold(node: tuple, filters: dict[str, Callable], constants: dict[str, object]) -> tuple:
    """The expression with all that is known computed."""
    kind, *rest = node
    if kind == "lit":
        return node
    if kind == "name":
        return ("lit", constants[rest[0]]) if rest[0] in constants else node
    if kind == "filter" and rest[0] not in filters:
        raise TemplateError(f"filter {rest[0]!r} not known")
    rest = [fold(x, filters, constants) if isinstance(x, tuple) else x for x in rest]
    node = (kind, *rest)
    inputs = [x for x in rest if isinstance(x, tuple)]
    if kind in ("choice", "and", "or") and inputs[0][0] == "lit":
        known = bool(inputs[0][1])
        return (inputs[1] if known else inputs[2]) if kind == "choice" else inputs[1] if known == (kind == "and") else inputs[0]
    return ("lit", expression(node, filters, frozenset())({})) if all(x[0] == "lit" for x in inputs) else node


def fold_body(nodes: list[tuple], filters: dict[str, Callable], constants: dict[str, object]) -> list[tuple]:
    """Statements with constant output as text, neighbouring texts as one, and known branches taken. A name that is set is no constant from there on."""
    out: list[tuple] = []
    constants = dict(constants)

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        kind = node[0]
        if kind == "text":
            add(node)
        elif kind == "out":
            x = fold(node[1], filters, constants)
            add(("text", shown(x[1])) if x[0] == "lit" else ("out", x))
        elif kind == "set":
            x = fold(node[2], filters, constants)
            constants.pop(node[1], None)
            add(("set", node[1], x))
        elif kind == "generation":
            add(("generation", fold_body(node[1], filters, constants)))
        elif kind == "for":
            inner = {k: v for k, v in constants.items() if k not in (node[1], "loop")}
            add(("for", node[1], fold(node[2], filters, constants), fold_body(node[3], filters, inner)))
        else:
            arms = []
            for when, body in node[1]:
                when = fold(when, filters, constants)
                if when[0] == "lit" and not when[1]:
                    continue
                arms.append((when, fold_body(body, filters, constants)))
                if when[0] == "lit":
                    break
            if arms and arms[0][0][0] == "lit":
                for inner in arms[0][1]:
                    add(inner)
            elif arms:
                add(("if", arms))
            for name in sorted(assigned([node])):
                constants.pop(name, None)
    return out


def assigned(nodes: list[tuple]) -> set[str]:
    """Names that statements set outside loops of their own."""
    found: set[str] = set()
    for kind, *rest in nodes:
        if kind == "set":
            found.add(rest[0])
        elif kind == "generation":
            found |= assigned(rest[0])
        elif kind == "if":
            for _, body in rest[0]:
                found |= assigned(body)
    return found


def expression(node: tuple, filters: dict[str, Callable], names: frozenset[str]) -> Callable[[dict], object]:
    """A closure from the names' values to the expression's."""
    kind, *rest = node
    if kind == "lit":
        value = rest[0]
        return lambda env: value
    if kind == "name":
        if rest[0] not in names:
            raise TemplateError(f"name {rest[0]!r} not known")
        return lambda env, name=rest[0]: env.get(name)
    f = [expression(x, filters, names) for x in rest if isinstance(x, tuple)]
    if kind == "filter":
        return lambda env, do=filters[rest[0]], x=f[0]: do(x(env))
    if kind == "member":
        return lambda env, x=f[0], key=f[1]: member(x(env), key(env))
    if kind == "not":
        return lambda env, x=f[0]: not x(env)
    if kind == "and":
        return lambda env, x=f[0], y=f[1]: x(env) and y(env)
    if kind == "or":
        return lambda env, x=f[0], y=f[1]: x(env) or y(env)
    if kind == "choice":
        return lambda env, c=f[0], x=f[1], y=f[2]: x(env) if c(env) else y(env)
    return lambda env, do=(COMPARE if kind == "compare" else JOIN)[rest[0]], x=f[0], y=f[1]: do(x(env), y(env))


class Output:
    """Rendered text with the spans, in code points, that are under the loss mask."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)

    def mask(self, start: int) -> None:
        while self.spans and self.spans[-1][0] >= start:  # one mark inside another
            self.spans.pop()
        if start < self.length:
            self.spans.append((start, self.length))


def statements(nodes: list[tuple], filters: dict[str, Callable], names: frozenset[str]) -> Callable[[dict, Output], None]:
    """A closure that renders the nodes; names set inside are known to what follows."""
    steps: list[Callable[[dict, Output], None]] = []
    for kind, *rest in nodes:
        if kind == "text":
            steps.append(lambda env, out, text=rest[0]: out.write(text))
        elif kind == "out":
            steps.append(lambda env, out, x=expression(rest[0], filters, names): out.write(shown(x(env))))
        elif kind == "set":
            x = expression(rest[1], filters, names)
            names |= {rest[0]}
            steps.append(lambda env, out, name=rest[0], x=x: env.__setitem__(name, x(env)))
        elif kind == "generation":
            names |= assigned(rest[0])

            def masked(env: dict, out: Output, body: Callable = statements(rest[0], filters, names)) -> None:
                start = out.length
                body(env, out)
                out.mask(start)

            steps.append(masked)
        elif kind == "for":

            def loop(env: dict, out: Output, name: str = rest[0], items: Callable = expression(rest[1], filters, names), body: Callable = statements(rest[2], filters, names | {rest[0], "loop"})) -> None:
                found = items(env)
                if found is not None and not isinstance(found, list):
                    raise TemplateError("loops run over lists only")
                for k, item in enumerate(found or []):
                    body(env | {name: item, "loop": place(k, k + 1 == len(found))}, out)

            steps.append(loop)
        else:
            arms = [(expression(when, filters, names), body) for when, body in rest[0]]
            names |= assigned([("if", rest[0])])
            arms = [(when, statements(body, filters, names)) for when, body in arms]

            def branch(env: dict, out: Output, arms: list = arms) -> None:
                for when, body in arms:
                    if when(env):
                        body(env, out)
                        return

            steps.append(branch)

    def run(env: dict, out: Output) -> None:
        for step in steps:
            step(env, out)

    return run


def place(k: int, last: bool) -> dict:
    return {"index0": k, "index": k + 1, "first": k == 0, "last": last}


class Template:
    """A conversation template, compiled once."""

    def __init__(self, source: str, filters: dict[str, Callable] | None = None, constants: dict[str, object] | None = None):
        filters, constants = FILTERS | (filters or {}), constants or {}
        nodes = parse(source)
        loops = [k for k, x in enumerate(nodes) if x[0] == "for" and x[2] == ("name", "messages")]
        if len(loops) != 1:
            raise TemplateError("one outer loop over messages expected")
        _, self.name, _, inside = nodes[loops[0]]
        known = {k: v for k, v in constants.items() if k not in (self.name, "loop")}
        self.tree = fold_body(nodes[: loops[0]], filters, constants), fold_body(inside, filters, known), fold_body(nodes[loops[0] + 1 :], filters, constants)
        free = frozenset()
        self.before, self.after = (statements(self.tree[k], filters, free) for k in (0, 2))
        self.inside = statements(self.tree[1], filters, frozenset({self.name, "loop"}))

    def turn(self, message: dict, index0: int, last: bool) -> tuple[str, list[tuple[int, int]]]:
        """One message's part of the conversation, and its spans under the loss mask."""
        out = Output()
        if index0 == 0:
            self.before({}, out)
        self.inside({self.name: message, "loop": place(index0, last)}, out)
        if last:
            self.after({}, out)
        return "".join(out.parts), out.spans
