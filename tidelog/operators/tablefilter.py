"""Table patterns: `schema.table` with the wildcards * (any run), ? (one) and + (one or more).

Unquoted names fold to lower case; quoted names keep theirs. Excludes win over includes; without a
match the default holds. Continuous aggregates are matched by their view's name.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MOST = 63
#: Words that an unquoted pattern cannot be. `with_keywords` adds Spark's own list.
RESERVED = frozenset(
    "ALL ANALYZE AND ANY ARRAY AS ASC BEGIN BETWEEN BIGINT BINARY BIT BOOLEAN BOTH BY CASE CAST CHAR CHECK COLLATE COLUMN COMMIT CONSTRAINT CREATE CROSS CURRENT_DATE CURRENT_TIME CURRENT_USER DATE DEFAULT DELETE DESC DISTINCT DO DROP ELSE END EXCEPT EXISTS FALSE FETCH FOR FOREIGN FROM FULL GRANT GROUP HAVING IN INNER INSERT INT INTERSECT INTO IS JOIN KEY LEADING LEFT LIKE LIMIT NATURAL NOT NULL OFFSET ON OR ORDER OUTER PRIMARY REFERENCES RIGHT SELECT SESSION_USER SET TABLE THEN TO TRAILING TRUE UNION UNIQUE UPDATE USER USING VALUES VIEW WHEN WHERE WITH".split()
)


def with_keywords(spark: SparkSession) -> frozenset[str]:
    return RESERVED | {r[0].upper() for r in spark.sql("SELECT keyword FROM sql_keywords()").collect()}


class PatternError(ValueError):
    pass


def parse_token(token: str, reserved: frozenset[str] = RESERVED) -> tuple[str, str]:
    """One side of a pattern: (its text, a regular expression that matches what it matches)."""
    quoted = len(token) >= 2 and token[0] == token[-1] == '"'
    body = token[1:-1] if quoted else token.lower()
    if not body:
        raise PatternError("a pattern cannot be empty")
    if len(body) > MOST:
        raise PatternError(f"a pattern cannot be longer than {MOST} characters")
    if not quoted and not (body[0].isalpha() or body[0] in "_*?+"):
        raise PatternError(f"{body[0]} is an illegal first character of pattern '{body}'")
    text, regex, wild = [], [], False
    for m in re.finditer(r'\\[*?+]|""?|.', body, re.S):
        part = m[0]
        if quoted and (part[0] == "\\" and len(part) == 2):  # an escaped wildcard keeps its backslash in the name
            text.append(part)
            regex.append(re.escape(part))
        elif quoted and part[0] == '"':
            text.append('""')
            regex.append('""')
        elif part in "*?+":
            text.append(part)
            regex.append({"*": ".*", "?": ".", "+": ".+"}[part])
            wild = True
        elif quoted or part.isalpha() or part.isnumeric() or part == "_":
            text.append(part)
            regex.append(re.escape(part))
        else:
            raise PatternError(f"illegal character in pattern '{body}' at index {m.start()}")
    found = "".join(text)
    if not quoted and not wild and found.upper() in reserved:
        raise PatternError(f"an unquoted pattern cannot match a reserved keyword: {found.upper()}")
    if quoted and wild:  # beside a wildcard an escape stands for the character itself
        regex = [re.escape(p[1:]) if p[:1] == "\\" and len(p) == 2 else r for p, r in zip(text, regex, strict=True)]
    return found, "".join(regex)


def parse(pattern: str, reserved: frozenset[str] = RESERVED) -> str:
    """A regular expression for `schema.table`."""
    sides = pattern.split(".")
    if len(sides) != 2 or not all(sides):
        raise PatternError(f"a pattern has two parts: '{pattern}'")
    return r"\.".join(parse_token(s, reserved)[1] for s in sides)


class TableFilter:
    def __init__(self, excludes=(), includes=(), default: bool = False, reserved: frozenset[str] = RESERVED):
        self.excludes, self.includes, self.default = [parse(p, reserved) for p in excludes], [parse(p, reserved) for p in includes], default

    def enabled(self, schema: str, name: str) -> bool:
        hit = lambda ps: any(re.fullmatch(p, f"{schema}.{name}", re.S) for p in ps)
        return not hit(self.excludes) and (hit(self.includes) or self.default)

    def column(self, schema: Column, name: Column, view_schema: Column | None = None, view_name: Column | None = None) -> Column:
        """enabled() as one boolean column; a view's name, where there is one, stands for the table's."""
        full = F.concat_ws(".", schema if view_schema is None else F.coalesce(view_schema, schema), name if view_name is None else F.coalesce(view_name, name))
        hit = lambda ps: reduce(lambda a, b: a | b, [full.rlike(f"^(?s:{p})$") for p in ps], F.lit(False))
        return F.when(hit(self.excludes), False).when(hit(self.includes), True).otherwise(self.default)
