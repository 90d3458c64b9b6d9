"""Columns computed by arithmetic over earlier columns, with wrapping integers and literals that take a column's type."""

from __future__ import annotations

import ast
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTEGERS, FLOATS = {"int": 32, "bigint": 64}, ("float", "double")


class Literal:
    def __init__(self, value: int | float):
        self.value = value


def _wrap(value: Column, kind: str) -> Column:
    """A decimal(38,0) or long result folded into the integer type."""
    if kind == "int":
        return (F.pmod(value + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31)).cast("int")
    span, half = (F.lit(str(n)).cast("decimal(38,0)") for n in (1 << 64, 1 << 63))
    folded = F.pmod(value, span)
    return F.when(folded >= half, folded - span).otherwise(folded).cast("decimal(20,0)").cast("bigint")


def _combine(op: ast.operator, a: Column, b: Column, kind: str) -> Column:
    if kind in INTEGERS:
        wide = "bigint" if kind == "int" else "decimal(38,0)"
        x, y = a.cast(wide), b.cast(wide)
        if isinstance(op, (ast.Add, ast.Sub, ast.Mult)):
            return _wrap(x + y if isinstance(op, ast.Add) else x - y if isinstance(op, ast.Sub) else x * y, kind)
        both = F.call_function("div", a, b).cast("decimal(38,0)") if isinstance(op, ast.Div) else a % b
        return both.cast(kind)
    if isinstance(op, ast.Div):
        zero = F.when(F.isnan(a) | (a == 0), F.lit(float("nan"))).when(a > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
        return F.when(b == 0, zero).otherwise(a / F.when(b != 0, b)).cast(kind)
    if isinstance(op, ast.Mod):
        return F.when(b == 0, F.lit(float("nan"))).otherwise(a % F.when(b != 0, b)).cast(kind)
    return (a + b if isinstance(op, ast.Add) else a - b if isinstance(op, ast.Sub) else a * b).cast(kind)


def expression(text: str, types: dict[str, str]) -> Column:
    """A column for ``text``: + - * / %, signs, parentheses, numbers (suffix L, F or D) and column names, plain or
    back-quoted. Both sides of an operator have one type; a literal takes that of the column it meets."""
    names: dict[str, str] = {}

    def named(m: re.Match) -> str:
        key = f"_q{len(names)}"
        names[key] = m[1]
        return key

    code = re.sub(r"`([^`]+)`", named, text)
    code = re.sub(r"(?<![\w.])(\d+(?:\.\d*)?|\.\d+)[LlFfDd]\b", lambda m: m[1], code)

    def walk(node: ast.expr) -> tuple[Column, str] | Literal:
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)) and not isinstance(node.value, bool):
            return Literal(node.value)
        if isinstance(node, ast.Name):
            name = names.get(node.id, node.id)
            if name not in types:
                raise ValueError(f"unknown column {name} in {text!r}")
            if types[name] not in (*INTEGERS, *FLOATS):
                raise ValueError(f"column {name} is not a number")
            return F.col(f"`{name}`"), types[name]
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.UAdd, ast.USub)):
            inner = walk(node.operand)
            if isinstance(node.op, ast.UAdd):
                return inner
            if isinstance(inner, Literal):
                return Literal(-inner.value)
            col, kind = inner
            return (_combine(ast.Sub(), F.lit(0).cast(kind), col, kind) if kind in INTEGERS else -col), kind
        if isinstance(node, ast.BinOp) and isinstance(node.op, (ast.Add, ast.Sub, ast.Mult, ast.Div, ast.Mod)):
            a, b = walk(node.left), walk(node.right)
            if isinstance(a, Literal) and isinstance(b, Literal):
                raise ValueError(f"two literals meet in {text!r}")
            kind = b[1] if isinstance(a, Literal) else a[1]
            a, b = ((F.lit(int(x.value) if kind in INTEGERS else float(x.value)).cast(kind), kind) if isinstance(x, Literal) else x for x in (a, b))
            if a[1] != b[1]:
                raise ValueError(f"types {a[1]} and {b[1]} meet in {text!r}")
            return _combine(node.op, a[0], b[0], kind), kind
        raise ValueError(f"can't read {text!r}")

    out = walk(ast.parse(code.strip(), mode="eval").body)
    if isinstance(out, Literal):
        raise ValueError(f"no column in {text!r}")
    return out[0]


def derive_columns(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """``df`` with (name, expression) columns, in order; each sees the columns before it."""
    for name, text in columns:
        df = df.withColumn(name, expression(text, dict(df.dtypes)))
    return df
