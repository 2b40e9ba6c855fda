"""Chat formatting by a small template compiler.

A template is parsed into a syntax tree, constants are folded, and the tree is
turned into Python closures that append to a list of output pieces.  Templates
are sandboxed: names come from the given variables only, attributes are looked
up as keys of mappings, there are no calls besides listed filters, and loops
run over lists that exist already.

    {{ expression }}                       output
    {% for x in list %} ... {% endfor %}   loop.index0, loop.first, loop.last
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}   output under the loss mask
    {# comment #}

Expressions: literals, names, a.b, a['b'], a[0], filters, + - * ~ == != < > <=
>= in, not, and, or, and parentheses.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import in_arrow, table

#: Strings that steer a model; inside texts they are escaped.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
TEMPLATE = (
    "{{ '<s>' }}{% for m in messages %}[ROLE]{{ m.role | escape }}[/ROLE]"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}[INST]{{ m.text | escape }}[/INST]{% endif %}{{ '</s>' }}{% endfor %}"
)


class TemplateError(ValueError):
    """The template is not in the language."""


# ---- escaping ---------------------------------------------------------------


def escaper(controls: tuple[str, ...] = CONTROLS) -> tuple[Callable[[str], str], Callable[[str], str]]:
    """``escape`` and ``unescape`` for these control strings.

    A control string gets a backslash after its first character, and one that
    has backslashes there already gets one more; unescaping takes one away.
    First characters must not occur elsewhere in a control string, so matches
    cannot overlap and adding backslashes never makes a new control string.
    """
    firsts = {c[0] for c in controls}
    if any(len(c) < 2 or "\\" in c or firsts & set(c[1:]) for c in controls):
        raise ValueError("control strings must differ from their first characters")
    each = "|".join(f"({re.escape(c[0])})(\\\\*)({re.escape(c[1:])})" for c in controls)
    found = re.compile(each)

    def parts(m: re.Match) -> list[str]:
        return [g for g in m.groups() if g is not None]

    def escape(text: str) -> str:
        return found.sub(lambda m: (p := parts(m))[0] + "\\" + p[1] + p[2], text)

    def unescape(text: str) -> str:
        return found.sub(lambda m: (p := parts(m))[0] + p[1][1:] + p[2], text)

    return escape, unescape


ESCAPE, UNESCAPE = escaper()
FILTERS: dict[str, Callable] = {
    "escape": lambda v: ESCAPE(str(v)),
    "trim": lambda v: str(v).strip(),
    "upper": lambda v: str(v).upper(),
    "lower": lambda v: str(v).lower(),
    "string": str,
}

# ---- parsing ----------------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(
    r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+*~<>|.\[\]()=]))", re.S
)
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
_CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}


class _Expression:
    """Precedence climbing over the tokens of one expression."""

    LEVELS = (("or",), ("and",), ("==", "!=", "<", ">", "<=", ">=", "in"), ("+", "-", "~"), ("*",))

    def __init__(self, text: str):
        self.tokens, at = [], 0
        while text[at:].strip():
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", None)
        return None if kind == "str" else value

    def take(self, wanted: str | None = None) -> tuple[str, str]:
        if self.at >= len(self.tokens) or wanted and self.peek() != wanted:
            raise TemplateError(f"expected {wanted or 'more'}")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self) -> tuple:
        tree = self.level(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def level(self, n: int) -> tuple:
        if n == len(self.LEVELS):
            return self.unary()
        if n == 2 and self.peek() == "not":
            self.take()
            return ("not", self.level(2))
        left = self.level(n + 1)
        while self.peek() in self.LEVELS[n]:
            op = self.take()[1]
            left = ("binary", op, left, self.level(n + 1))
        return left

    def unary(self) -> tuple:
        tree = self.primary()
        while self.peek() in (".", "[", "|"):
            op = self.take()[1]
            if op == "[":
                tree = ("item", tree, self.level(0))
                self.take("]")
                continue
            kind, name = self.take()
            if kind != "name" or name.startswith("_"):
                raise TemplateError(f"bad name {name!r}")
            if op == "|" and name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree) if op == "|" else ("item", tree, ("const", name))
        return tree

    def primary(self) -> tuple:
        kind, value = self.take()
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), value[1:-1], flags=re.S))
        if kind == "int":
            return ("const", int(value))
        if value == "(":
            tree = self.level(0)
            self.take(")")
            return tree
        if kind == "name" and value in _CONSTANTS:
            return ("const", _CONSTANTS[value])
        if kind == "name" and not value.startswith("_"):
            return ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(template: str) -> tuple:
    """The syntax tree: nested tuples, the first item naming the node."""
    items, at = [], 0
    for m in _TAG.finditer(template):
        if m.start() > at:
            items.append(("text", template[at : m.start()]))
        if m[1] is not None:
            items.append(("out", m[1]))
        elif m[2] is not None:
            items.append(("tag", m[2].strip()))
        at = m.end()
    if at < len(template):
        items.append(("text", template[at:]))
    position = 0

    def block(ends: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal position
        body = []
        while position < len(items):
            kind, value = items[position]
            position += 1
            if kind == "text":
                body.append(("out", ("const", value)))
                continue
            if kind == "out":
                body.append(("out", _Expression(value).whole()))
                continue
            word, _, rest = value.partition(" ")
            if word in ends:
                return ("block", tuple(body)), value
            if word == "for":
                m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                if not m:
                    raise TemplateError(f"bad loop {value!r}")
                inner, _ = block(("endfor",))
                body.append(("for", m[1], _Expression(m[2]).whole(), inner))
            elif word == "if":
                branches, test, end = [], rest, ""
                while True:
                    inner, end = block(("elif", "else", "endif"))
                    branches.append((_Expression(test).whole() if test is not None else ("const", True), inner))
                    if end == "endif":
                        break
                    if test is None:
                        raise TemplateError("a branch after else")
                    test = end[4:] if end.startswith("elif") else None
                body.append(("if", tuple(branches)))
            elif word == "set":
                m = re.fullmatch(r"([A-Za-z]\w*)\s*=\s*(.+)", rest.strip(), re.S)
                if not m:
                    raise TemplateError(f"bad set {value!r}")
                body.append(("set", m[1], _Expression(m[2]).whole()))
            elif word == "generation":
                inner, _ = block(("endgeneration",))
                body.append(("generation", inner))
            else:
                raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return ("block", tuple(body)), ""

    return block(())[0]


# ---- folding ----------------------------------------------------------------

def _fitting(what: str, use: Callable) -> Callable:
    """``use``, refusing values of kinds that do not fit as the language's error."""

    def run(*values):
        try:
            return use(*values)
        except TypeError:
            raise TemplateError(f"{what} does not fit {' and '.join(type(v).__name__ for v in values)}") from None

    return run


_OPERATORS: dict[str, Callable] = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b if isinstance(a, int) and isinstance(b, int) else _refuse(),
    "~": lambda a, b: str(a) + str(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
}
_BINARY = {op: _fitting(op, use) for op, use in _OPERATORS.items()}


def _refuse():
    raise TemplateError("only whole numbers are multiplied")


FILTERS["length"] = _fitting("length", len)


def fold(tree: tuple) -> tuple:
    """The same tree with constant parts worked out, dead branches gone and
    neighbouring constant output joined."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    if kind == "not":
        inner = fold(tree[1])
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    if kind == "filter":
        inner = fold(tree[2])
        return ("const", FILTERS[tree[1]](inner[1])) if inner[0] == "const" else ("filter", tree[1], inner)
    if kind == "item":
        return ("item", fold(tree[1]), fold(tree[2]))
    if kind == "binary":
        op, left, right = tree[1], fold(tree[2]), fold(tree[3])
        if op in ("and", "or") and left[0] == "const":
            return right if bool(left[1]) == (op == "and") else left
        if op in _BINARY and left[0] == right[0] == "const":
            return ("const", _BINARY[op](left[1], right[1]))
        return ("binary", op, left, right)
    if kind == "out":
        return ("out", fold(tree[1]))
    if kind == "set":
        return ("set", tree[1], fold(tree[2]))
    if kind == "generation":
        return ("generation", fold(tree[1]))
    if kind == "for":
        return ("for", tree[1], fold(tree[2]), fold(tree[3]))
    if kind == "if":
        branches = []
        for test, body in tree[1]:
            test = fold(test)
            if test[0] == "const" and not test[1]:
                continue
            branches.append((test, fold(body)))
            if test[0] == "const":
                break
        if not branches:
            return ("block", ())
        if branches[0][0][0] == "const":
            return branches[0][1]
        return ("if", tuple(branches))
    body: list[tuple] = []
    for node in tree[1]:
        node = fold(node)
        for x in node[1] if node[0] == "block" else (node,):
            if x[0] == "out" and x[1][0] == "const" and body and body[-1][0] == "out" and body[-1][1][0] == "const":
                body[-1] = ("out", ("const", str(body[-1][1][1]) + str(x[1][1])))
            else:
                body.append(x)
    return ("block", tuple(body))


# ---- closures ---------------------------------------------------------------


class _Output:
    """Pieces, their length so far, and the spans under the loss mask."""

    def __init__(self):
        self.pieces, self.length, self.spans, self.depth = [], 0, [], 0

    def add(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _value(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        constant = tree[1]
        return lambda env: constant
    if kind == "name":
        name = tree[1]
        return lambda env: env.get(name)
    if kind == "not":
        inner = _value(tree[1])
        return lambda env: not inner(env)
    if kind == "filter":
        apply, inner = FILTERS[tree[1]], _value(tree[2])
        return lambda env: apply(inner(env))
    if kind == "item":
        holder, key = _value(tree[1]), _value(tree[2])

        def item(env):
            h, k = holder(env), key(env)
            if isinstance(h, dict):
                return h.get(k)
            if isinstance(h, (list, tuple, str)) and isinstance(k, int) and -len(h) <= k < len(h):
                return h[k]
            return None

        return item
    op, left, right = tree[1], _value(tree[2]), _value(tree[3])
    if op == "and":
        return lambda env: left(env) and right(env)
    if op == "or":
        return lambda env: left(env) or right(env)
    apply = _BINARY[op]
    return lambda env: apply(left(env), right(env))


def _code(tree: tuple) -> Callable[[dict, _Output], None]:
    kind = tree[0]
    if kind == "out":
        inner = _value(tree[1])
        if tree[1][0] == "const":
            constant = "" if tree[1][1] is None else str(tree[1][1])
            return lambda env, out: out.add(constant)

        def write(env, out):
            v = inner(env)
            out.add("" if v is None else str(v))

        return write
    if kind == "set":
        name, inner = tree[1], _value(tree[2])
        return lambda env, out: env.__setitem__(name, inner(env))
    if kind == "generation":
        inner = _code(tree[1])

        def generation(env, out):
            start, out.depth = out.length, out.depth + 1
            inner(env, out)
            out.depth -= 1
            if not out.depth:
                out.spans.append((start, out.length))

        return generation
    if kind == "for":
        name, many, inner = tree[1], _value(tree[2]), _code(tree[3])

        def loop(env, out):
            found = many(env)
            if not isinstance(found, (list, tuple)):
                raise TemplateError("only lists are looped over")
            for i, x in enumerate(found):
                inner(env | {name: x, "loop": {"index0": i, "first": i == 0, "last": i + 1 == len(found)}}, out)

        return loop
    if kind == "if":
        branches = [(_value(t), _code(b)) for t, b in tree[1]]

        def choose(env, out):
            for test, body in branches:
                if test(env):
                    return body(env, out)

        return choose
    codes = [_code(x) for x in tree[1]]

    def run(env, out):
        for c in codes:
            c(env, out)

    return run


def compile_template(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages to the text and its spans under the loss mask
    (code points, end exclusive)."""
    code = _code(fold(parse(template)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        code({"messages": messages}, out)
        return "".join(out.pieces), out.spans

    return render


# ---- reading back -----------------------------------------------------------

_TURN = re.compile(r"\[ROLE\](.*?)\[/ROLE\](.*?)</s>", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of what TEMPLATE rendered."""
    turns = []
    for m in _TURN.finditer(formatted):
        body = m[2]
        if body.startswith("[INST]"):
            body = body[len("[INST]") : -len("[/INST]")]
        turns.append((UNESCAPE(m[1]), UNESCAPE(body)))
    return turns


# ---- Spark ------------------------------------------------------------------

_SCHEMA = "conv_id long, formatted string, loss array<struct<start:long,end:long>>"


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss`` (masked spans) per conversation.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns
    are not read.  Null texts and roles are empty, null turns come first, ties
    of a turn are ordered by role and text, repeated rows stay, and rows
    without a conv_id make up one conversation.  No rows, no conversations.
    The rows are dealt by conversation and sorted on disk if need be; Python
    holds one conversation at a time, besides the batch it is read from.
    """
    ordered = (
        turns.select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text")
    )

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[dict]]]:
        current, messages, begun = None, [], False
        for batch in batches:
            for c, role, text in zip(
                batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                if begun and c != current:
                    yield current, messages
                    messages = []
                current, begun = c, True
                messages.append({"role": role, "text": text})
        if begun:
            yield current, messages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        ids, texts, spans, held = [], [], [], 0

        def batch() -> pa.RecordBatch:
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            loss = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), loss], ["conv_id", "formatted", "loss"]
            )

        for c, messages in conversations(batches):
            text, masked = render(messages)
            ids.append(c), texts.append(text), spans.append(masked)
            held += len(text)
            if held > 4_000_000 or len(ids) >= 2000:
                yield batch()
                ids, texts, spans, held = [], [], [], 0
        if ids:
            yield batch()

    return ordered.transform(in_arrow(run, _SCHEMA))


#: Contract case: control strings in a text must come back unchanged.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_format_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``format_conversations`` of ``conversations`` and the probe, digested from what is read back;
    nulls and ties as there."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def digest(formatted: pd.Series, loss: pd.Series) -> pd.DataFrame:
        rows = []
        for text, spans in zip(formatted, loss, strict=True):
            read = read_back(text)
            learned = "".join(UNESCAPE(text[s["start"] : s["end"]]) for s in spans)
            rows.append(
                (
                    len(read),
                    hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in read).encode()).hexdigest(),
                    len(learned),
                    hashlib.sha256(learned.encode()).hexdigest(),
                    len(text),
                )
            )
        return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return format_conversations(turns.unionByName(probe)).select("conv_id", digest("formatted", "loss").alias("d")).select("conv_id", "d.*")
