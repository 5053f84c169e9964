"""Functions that SQL can't express, in Arrow batches: full entity decoding, JSON repair, arithmetic, keyed hashes."""

from __future__ import annotations

import ast
import hashlib
import html
import json
import operator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _each(f, kind):
    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else f(x))

    return run


def unescape(c: Column) -> Column:
    """Any HTML entity decoded."""
    return _each(html.unescape, T.StringType())(c)


def _balanced(t: str) -> str | None:
    start = min((i for i in (t.find("{"), t.find("[")) if i >= 0), default=-1)
    if start < 0:
        return None
    stack, quoted, skip = [], False, False
    for i, ch in enumerate(t[start:], start):
        if skip:
            skip = False
        elif quoted:
            skip, quoted = ch == "\\", ch != '"'
        elif ch == '"':
            quoted = True
        elif ch in "{[":
            stack.append("}" if ch == "{" else "]")
        elif ch in "}]":
            if not stack or stack.pop() != ch:
                return None
            if not stack:
                return t[start : i + 1]
    return None


def repaired_json(text: str) -> str | None:
    """Compact JSON of the first object or list in a text, fences and trailing commas taken out; null where none parses."""
    import re

    t = re.sub(r"```(?:json)?", "", text)
    for part in (t.strip(), _balanced(t)):
        if part:
            for candidate in (part, re.sub(r",\s*([}\]])", r"\1", part)):
                try:
                    got = json.loads(candidate)
                except ValueError:
                    continue
                if isinstance(got, (dict, list)):
                    return json.dumps(got, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return None


def repair_json(c: Column) -> Column:
    return _each(repaired_json, T.StringType())(c)


_OPS = {
    ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv, ast.Mod: operator.mod, ast.USub: operator.neg, ast.UAdd: operator.pos,
}


def arithmetic(text: str) -> float | None:
    """Value of an expression of numbers, + - * / // % ** and brackets; null for anything else."""

    def value(n: ast.AST) -> float:
        if isinstance(n, ast.Constant) and type(n.value) in (int, float):
            return n.value
        if isinstance(n, ast.BinOp) and isinstance(n.op, ast.Pow):
            a, b = value(n.left), value(n.right)
            if abs(b) > 64 or abs(a) > 1e6:
                raise ValueError("too large")
            return a**b
        if isinstance(n, ast.BinOp):
            return _OPS[type(n.op)](value(n.left), value(n.right))
        if isinstance(n, ast.UnaryOp):
            return _OPS[type(n.op)](value(n.operand))
        raise ValueError("not arithmetic")

    try:
        return float(value(ast.parse(text.strip(), mode="eval").body)) if len(text) <= 500 else None
    except (ValueError, KeyError, SyntaxError, ZeroDivisionError, OverflowError, TypeError, RecursionError, MemoryError):
        return None


def evaluate(c: Column) -> Column:
    return _each(arithmetic, T.DoubleType())(c)


def blake_fraction(c: Column) -> Column:
    """A number in 0..1 from the 64-bit BLAKE2b of a text."""
    return _each(lambda x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") / 2**64, T.DoubleType())(c)


def fnv1a(text: str) -> int:
    """32-bit FNV-1a over UTF-16 code units, as browsers hash."""
    h = 0x811C9DC5
    b = text.encode("utf-16-le")
    for i in range(0, len(b), 2):
        h = ((h ^ int.from_bytes(b[i : i + 2], "little")) * 0x01000193) & 0xFFFFFFFF
    return h


def fnv_hash(c: Column) -> Column:
    return _each(fnv1a, T.LongType())(c)


# The small edits that turn right code into wrong code, tried in this order.
MUTATIONS = [(r"<=", "<"), (r"==", "!="), (r"\+ 1\b", "- 1"), (r"\brange\(", "range(1, "), (r"\breturn (\w+)", r"return not \1")]


def mutated(code: str) -> str | None:
    """The code with the first edit that applies, at its first place; null where none does."""
    import re

    for pattern, to in MUTATIONS:
        got, n = re.subn(pattern, to, code, count=1)
        if n:
            return got
    return None


def mutate(c: Column) -> Column:
    return _each(mutated, T.StringType())(c)
