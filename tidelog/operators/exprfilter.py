"""The sinks' filter language, compiled to a Column.

Member access, literals, == != < <= > >=, && || ! (and, or, not), + - * / % **, in (lists and ranges
like 1..5), contains, startsWith, endsWith, matches, ?: and ??; the calls len (of text), lower, upper, trim, abs,
ceil, floor, round, int, float, string, min, max; the predicates all, any, none, one, count and filter
and map over arrays, with # for the element. Anything else is an error, as is a condition that is not
boolean. Names reach into struct columns (`value.after.id`, `key.id`); `keySchema` and `valueSchema`
reach into the descriptors, which are known when the condition is compiled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.tablefilter import TableFilter

_TOKEN = re.compile(r"""\s*(?:(?P<num>\d+(?:\.\d+)?(?!\.?\d))|(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<name>[A-Za-z_]\w*)|(?P<op>&&|\|\||==|!=|<=|>=|\?\?|\?\.|\.\.|\*\*|[-+*/%<>!?:.,()\[\]{}\#]))""")
#: Binary operators by how tightly they bind.
_CALLS = {
    "len": F.length, "lower": F.lower, "upper": F.upper, "trim": F.trim, "abs": F.abs, "ceil": F.ceil, "floor": F.floor,
    "round": F.round, "int": lambda x: x.cast("bigint"), "float": lambda x: x.cast("double"), "string": lambda x: x.cast("string"), "min": lambda *x: F.least(*x) if len(x) > 1 else x[0], "max": lambda *x: F.greatest(*x) if len(x) > 1 else x[0],
}
_PREDICATES = {
    "all": F.forall, "any": F.exists, "none": lambda a, f: ~F.exists(a, f), "one": lambda a, f: F.size(F.filter(a, f)) == 1, "count": lambda a, f: F.size(F.filter(a, f)), "filter": F.filter, "map": F.transform,
}
_LEVELS = (("||", "or"), ("&&", "and"), ("==", "!=", "<", "<=", ">", ">=", "in", "contains", "startsWith", "endsWith", "matches"), ("..",), ("+", "-"), ("*", "/", "%"), ("**",))


class FilterError(ValueError):
    pass


def _tokens(text: str) -> list[tuple[str, str]]:
    out, at, text = [], 0, text.rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise FilterError(f"unsupported at {at}: {text[at:]}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Range(tuple):
    """Both ends of a range."""


class _Parser:
    def __init__(self, text: str, schemas: dict[str, dict] | None = None):
        self.toks, self.at, self.schemas, self.elements = _tokens(text), 0, schemas or {}, []

    def peek(self, *values: str) -> bool:
        return self.at < len(self.toks) and self.toks[self.at][0] in ("op", "name") and self.toks[self.at][1] in values

    def take(self, *values: str) -> str:
        if not self.peek(*values):
            raise FilterError(f"expected {' or '.join(values)}")
        self.at += 1
        return self.toks[self.at - 1][1]

    def whole(self):
        x = self.choice()
        if self.at < len(self.toks):
            raise FilterError(f"unsupported: {self.toks[self.at][1]}")
        return x

    def choice(self):
        x = self.level(0)
        if self.peek("??"):
            self.take("??")
            return F.coalesce(x, self.choice())
        if self.peek("?"):
            self.take("?")
            a = self.choice()
            self.take(":")
            return F.when(x, a).otherwise(self.choice())
        return x

    def level(self, k: int):
        if k == len(_LEVELS):
            return self.unary()
        x = self.level(k + 1)
        while True:
            if self.peek("not") and self.at + 1 < len(self.toks) and self.toks[self.at + 1][1] == "in" and k == 2:
                self.take("not")
                self.take("in")
                x = ~self.within(x)
            elif self.peek(*_LEVELS[k]):
                op = self.take(*_LEVELS[k])
                x = self.within(x) if op == "in" else self.binary(op, x, self.level(k + 1))
            else:
                return x

    def within(self, x: Column) -> Column:
        if self.peek("["):
            return x.isin(*self.items())
        found = self.level(3)
        return x.between(*found) if isinstance(found, _Range) else F.array_contains(found, x)

    def arguments(self, close: str) -> list:
        out = []
        while not self.peek(close):
            out.append(self.choice())
            if not self.peek(close):
                self.take(",")
        self.take(close)
        return out

    def call(self, name: str):
        """name(...): a function of values, or a predicate over an array's elements."""
        self.take("(")
        if name in _PREDICATES:
            array = self.choice()
            self.take(",")
            self.take("{")
            at, made = self.at, []

            def body(x: Column) -> Column:  # parsed anew with the element in place of #
                self.at = at
                self.elements.append(x)
                made.append(self.choice())
                self.elements.pop()
                return made[-1]

            found = _PREDICATES[name](array, body)
            self.take("}")
            self.take(")")
            return found
        if name not in _CALLS:
            raise FilterError(f"unsupported call: {name}")
        try:
            return _CALLS[name](*self.arguments(")"))
        except TypeError as e:
            raise FilterError(f"{name}: wrong number of arguments") from e

    def binary(self, op: str, a: Column, b: Column) -> Column:
        return {
            "||": lambda: a | b, "or": lambda: a | b, "&&": lambda: a & b, "and": lambda: a & b, "==": lambda: a.eqNullSafe(b), "!=": lambda: ~a.eqNullSafe(b), "<": lambda: a < b,
            "<=": lambda: a <= b, ">": lambda: a > b, ">=": lambda: a >= b, "contains": lambda: a.contains(b), "startsWith": lambda: a.startswith(b), "endsWith": lambda: a.endswith(b),
            "matches": lambda: F.regexp_like(a, b), "+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: a / b, "%": lambda: a % b, "**": lambda: F.pow(a, b), "..": lambda: _Range((a, b)),
        }[op]()

    def items(self) -> list[Column]:
        self.take("[")
        return self.arguments("]")

    def unary(self):
        if self.peek("!", "not"):
            self.take("!", "not")
            return ~self.unary()
        if self.peek("-"):
            self.take("-")
            return -self.unary()
        if self.peek("("):
            self.take("(")
            x = self.choice()
            self.take(")")
            return x
        if self.at >= len(self.toks):
            raise FilterError("the condition ends too early")
        kind, text = self.toks[self.at]
        self.at += 1
        if kind == "num":
            return F.lit(float(text) if "." in text else int(text))
        if kind == "str":
            return F.lit(re.sub(r"\\(.)", r"\1", text[1:-1]))
        if text == "#" and self.elements:
            return self.member(self.elements[-1])
        if kind != "name":
            raise FilterError(f"unsupported: {text}")
        if text in ("true", "false", "nil"):
            return F.lit({"true": True, "false": False, "nil": None}[text])
        if self.peek("("):
            return self.call(text)
        path = [text, *self.path()]
        if self.peek("("):
            raise FilterError(f"unsupported call: {'.'.join(path)}")
        if text in self.schemas:
            return self.described(path)
        return F.col(".".join(f"`{p}`" for p in path))

    def path(self) -> list[str]:
        out = []
        while self.peek(".", "?.", "["):
            bracket = self.take(".", "?.", "[") == "["
            out.append(re.sub(r"^['\"]|['\"]$", "", self.toks[self.at][1]))
            self.at += 1
            if bracket:
                self.take("]")
        return out

    def member(self, x: Column) -> Column:
        for p in self.path():
            x = x[p]
        return x

    def described(self, path: list[str]):
        """A descriptor's part as a literal: fields by their place, members by name; nil where there is none."""
        at = self.schemas[path[0]]
        for p in path[1:]:
            at = at.get(p) if isinstance(at, dict) else at[int(p)] if isinstance(at, list) and p.isdigit() and int(p) < len(at) else None
        if isinstance(at, dict):
            raise FilterError(f"{'.'.join(path)} is no value")
        return F.array(*[F.lit(str(x)) for x in at]) if isinstance(at, list) else F.lit(at)


def compile_condition(condition: str, schemas: dict[str, dict] | None = None) -> Column:
    """The condition as a Column; schemas: the descriptors that `keySchema` and `valueSchema` stand for."""
    found = _Parser(condition, schemas).whole()
    if isinstance(found, _Range):
        raise FilterError("a range is no condition")
    return found


@dataclass
class SinkFilter:
    """A condition with its default, and the tables that it is for. strict_includes: a filter with includes is for those only."""

    condition: str
    default: bool = True
    includes: list[str] = field(default_factory=list)
    excludes: list[str] = field(default_factory=list)
    strict_includes: bool = False


def checked(df: DataFrame, condition: Column) -> Column:
    kind = df.select(condition.alias("c")).schema["c"].dataType.simpleString()
    if kind != "boolean":
        raise FilterError(f"the condition is {kind}, not boolean")
    return condition


def apply_filters(df: DataFrame, filters: list[SinkFilter], schema: Column, name: Column, schemas: dict[str, dict] | None = None) -> DataFrame:
    """Events that all filters for their table accept; message events pass unasked. No filters accept all."""
    passed = F.lit(True)
    for f in filters:
        scope = TableFilter(f.excludes, f.includes, not (f.strict_includes and f.includes)).column(schema, name)
        verdict = F.coalesce(checked(df, compile_condition(f.condition, schemas)), F.lit(False)) == F.lit(f.default)
        passed = passed & F.when(scope, verdict).otherwise(F.lit(True))
    return df.filter(passed | (F.col("value.op") == "m"))
