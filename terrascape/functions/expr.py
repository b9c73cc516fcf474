"""User predicates over a raster's ``value``, compiled to Columns.

The text is parsed, never evaluated: names, calls and operators outside a short list
are rejected, so an expression can neither reach Python objects nor run code.
Comparisons with NaN are false, as in array arithmetic.
"""

from __future__ import annotations

import ast
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_ARITHMETIC = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Div: lambda a, b: F.when(b != 0, a / b).otherwise(F.when((a == 0) | F.isnan(a), float("nan")).otherwise(F.signum(a) * float("inf"))),
    ast.Mod: lambda a, b: a - b * F.floor(a / b),
    ast.Pow: lambda a, b: F.pow(a, b),
}
_COMPARE = {
    ast.Gt: lambda a, b: a > b,
    ast.GtE: lambda a, b: a >= b,
    ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b,
    ast.Eq: lambda a, b: a == b,
    ast.NotEq: lambda a, b: a != b,
}
_CALLS = {
    "abs": (1, F.abs),
    "sqrt": (1, F.sqrt),
    "log": (1, lambda a: F.when(a > 0, F.log(a)).otherwise(F.when(a == 0, float("-inf")).otherwise(float("nan")))),
    "exp": (1, F.exp),
    "floor": (1, lambda a: F.floor(a).cast("double")),
    "isnan": (1, F.isnan),
    "isfinite": (1, lambda a: ~F.isnan(a) & (F.abs(a) < math.inf)),
    "minimum": (2, F.least),
    "maximum": (2, lambda a, b: F.greatest(a, b)),
    "where": (3, lambda c, a, b: F.when(c, a).otherwise(b)),
    "logical_and": (2, lambda a, b: a & b),
    "logical_or": (2, lambda a, b: a | b),
    "logical_not": (1, lambda a: ~a),
}


class ExpressionError(ValueError):
    """An expression that is not in the language."""


def compile_expression(text: str, value: Column) -> Column:
    """The boolean (or numeric: true where not 0) Column of an expression."""
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except (SyntaxError, ValueError) as e:
        raise ExpressionError(f"not an expression: {text!r}") from e
    column, kind = _visit(tree.body, value.cast("double"))
    return column if kind == "bool" else (column != 0)


def check_expression(text: str) -> None:
    """Raise where ``compile_expression`` would, without a session to make Columns in:
    the nodes, names and calls are those of the language."""
    try:
        tree = ast.parse(text.strip(), mode="eval").body
    except (SyntaxError, ValueError) as e:
        raise ExpressionError(f"not an expression: {text!r}") from e
    _kind(tree)


def _kind(node: ast.AST) -> str:
    """``num`` or ``bool``: what an expression yields."""
    if isinstance(node, ast.Name) and node.id == "value":
        return "num"
    if isinstance(node, ast.Constant) and isinstance(node.value, (bool, int, float)):
        return "bool" if isinstance(node.value, bool) else "num"
    if isinstance(node, ast.UnaryOp):
        inner = _kind(node.operand)
        if isinstance(node.op, (ast.USub, ast.UAdd)):
            return "num"
        if isinstance(node.op, ast.Invert) and inner == "bool":
            return "bool"
    if isinstance(node, ast.BinOp):
        both = {_kind(node.left), _kind(node.right)}
        if isinstance(node.op, (ast.BitAnd, ast.BitOr)) and both == {"bool"}:
            return "bool"
        if type(node.op) in _ARITHMETIC:
            return "num"
    if isinstance(node, ast.Compare) and len(node.ops) == 1 and type(node.ops[0]) in _COMPARE:
        _kind(node.left), _kind(node.comparators[0])
        return "bool"
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and isinstance(node.func.value, ast.Name) and node.func.value.id == "np" and not node.keywords:
        name = node.func.attr
        if name in _CALLS and len(node.args) == _CALLS[name][0]:
            for a in node.args:
                _kind(a)
            return "bool" if name in ("isnan", "isfinite") or name.startswith("logical_") else "num"
    raise ExpressionError(f"not allowed in an expression: {ast.unparse(node)!r}")


def _visit(node: ast.AST, value: Column) -> tuple[Column, str]:
    if isinstance(node, ast.Name) and node.id == "value":
        return value, "num"
    if isinstance(node, ast.Constant) and isinstance(node.value, bool):
        return F.lit(node.value), "bool"
    if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)):
        return F.lit(float(node.value)), "num"
    if isinstance(node, ast.UnaryOp):
        inner, kind = _visit(node.operand, value)
        if isinstance(node.op, ast.USub):
            return -_number(inner, kind), "num"
        if isinstance(node.op, ast.UAdd):
            return _number(inner, kind), "num"
        if isinstance(node.op, ast.Invert) and kind == "bool":
            return ~inner, "bool"
    if isinstance(node, ast.BinOp):
        (a, ka), (b, kb) = _visit(node.left, value), _visit(node.right, value)
        if isinstance(node.op, (ast.BitAnd, ast.BitOr)) and ka == kb == "bool":
            return (a & b if isinstance(node.op, ast.BitAnd) else a | b), "bool"
        if make := _ARITHMETIC.get(type(node.op)):
            return make(_number(a, ka), _number(b, kb)), "num"
    if isinstance(node, ast.Compare) and len(node.ops) == 1 and (make := _COMPARE.get(type(node.ops[0]))):
        (a, ka), (b, kb) = _visit(node.left, value), _visit(node.comparators[0], value)
        a, b = _number(a, ka), _number(b, kb)
        nan = F.isnan(a) | F.isnan(b)
        return (make(a, b) | nan if isinstance(node.ops[0], ast.NotEq) else make(a, b) & ~nan), "bool"
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and isinstance(node.func.value, ast.Name) and node.func.value.id == "np" and not node.keywords:
        name = node.func.attr
        if name in _CALLS and len(node.args) == _CALLS[name][0]:
            parts = [_visit(a, value) for a in node.args]
            boolean = name in ("isnan", "isfinite") or name.startswith("logical_")
            if name.startswith("logical_"):
                args = [c if k == "bool" else c != 0 for c, k in parts]
            elif name == "where":
                args = [parts[0][0] if parts[0][1] == "bool" else parts[0][0] != 0, *[_number(c, k) for c, k in parts[1:]]]
            else:
                args = [_number(c, k) for c, k in parts]
            return _CALLS[name][1](*args), "bool" if boolean else "num"
    raise ExpressionError(f"not allowed in an expression: {ast.unparse(node)!r}")


def _number(column: Column, kind: str) -> Column:
    return column if kind == "num" else column.cast("double")
