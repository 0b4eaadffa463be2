"""Typed errors, the stable codes of Spark's error conditions, and helpers over nested errors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

# Stable codes of the error kinds that the query surface can raise.
CODES = {
    "column_count_mismatch": 7, "no_such_column": 16, "bad_arguments": 36, "unknown_identifier": 47, "unknown_type": 50, "type_mismatch": 53,
    "table_exists": 57, "unknown_table": 60, "syntax_error": 62, "cannot_parse_number": 72, "database_unknown": 81, "unknown_setting": 115, "division_by_zero": 153,
    "timeout": 159, "value_out_of_range": 321, "cancelled": 394, "missing_parameter": 456,
}
#: Error condition of Spark (its beginning) -> kind.
CONDITIONS = {
    "TABLE_OR_VIEW_NOT_FOUND": "unknown_table", "TABLE_OR_VIEW_ALREADY_EXISTS": "table_exists", "UNRESOLVED_COLUMN": "unknown_identifier", "FIELD_NOT_FOUND": "no_such_column",
    "SCHEMA_NOT_FOUND": "database_unknown", "PARSE_": "syntax_error", "CAST_INVALID_INPUT": "cannot_parse_number", "CAST_OVERFLOW": "value_out_of_range",
    "NUMERIC_VALUE_OUT_OF_RANGE": "value_out_of_range", "ARITHMETIC_OVERFLOW": "value_out_of_range", "DIVIDE_BY_ZERO": "division_by_zero", "REMAINDER_BY_ZERO": "division_by_zero",
    "DATATYPE_MISMATCH": "type_mismatch", "INCOMPATIBLE_DATA": "type_mismatch", "UNBOUND_SQL_PARAMETER": "missing_parameter", "UNSUPPORTED_DATATYPE": "unknown_type",
    "INSERT_COLUMN_ARITY_MISMATCH": "column_count_mismatch", "UNRESOLVED_ROUTINE": "bad_arguments", "USER_RAISED_EXCEPTION": "value_out_of_range",
}
SCHEMA_KINDS = {"no_such_column", "unknown_identifier", "unknown_type", "type_mismatch", "unknown_table", "database_unknown"}


class EngineError(Exception):
    """Base of all errors: a kind, its code, a message and the error it came from."""

    kind = "error"

    def __init__(self, message: str, kind: str | None = None, nested: BaseException | None = None, **info):
        super().__init__(message)
        self.message, self.info = message, info
        self.kind = kind or self.kind
        self.nested = nested

    @property
    def code(self) -> int | None:
        return CODES.get(self.kind)

    def __str__(self) -> str:
        return f"{self.kind}{f' ({self.code})' if self.code else ''}: {self.message}"


class ServerError(EngineError):
    """A query failed in Spark."""


class TypeMismatch(EngineError):
    kind = "type_mismatch"


class UnknownType(EngineError):
    kind = "unknown_type"


class OutOfRange(EngineError):
    kind = "value_out_of_range"


class ValidationError(EngineError):
    kind = "validation_error"


class Busy(EngineError):
    kind = "query_in_progress"


class Cancelled(EngineError):
    kind = "cancelled"


class Timeout(EngineError):
    kind = "timeout"


class CallbackFailed(EngineError):
    kind = "callback_failed"


class UnknownSetting(EngineError):
    kind = "unknown_setting"


class MissingParameter(EngineError):
    kind = "missing_parameter"


class Closed(EngineError):
    kind = "connection_closed"


def from_spark(error: BaseException) -> EngineError:
    """Classify by condition, not class: conditions reach Python on several exception types, or in the text of a Java error."""
    if isinstance(error, EngineError):
        return error
    condition = getattr(error, "getCondition", lambda: None)() if hasattr(error, "getCondition") else None
    text = str(error)
    if not condition and "[" in text:
        condition = text.split("[", 1)[1].split("]", 1)[0]
    if "cancelled" in text and "Job" in text:
        return Cancelled("the query was cancelled", nested=error)
    kind = next((k for c, k in CONDITIONS.items() if (condition or "").startswith(c)), "error")
    maker = MissingParameter if kind == "missing_parameter" else ServerError
    state = getattr(error, "getSqlState", lambda: None)() if hasattr(error, "getSqlState") else None
    return maker(text.split("\n")[0][:500], kind=kind, nested=error.__cause__, condition=condition, sql_state=state)


def flatten(error: BaseException | None) -> list[BaseException]:
    """The error and what it came from, outermost first."""
    out = []
    while error is not None and error not in out:
        out.append(error)
        error = getattr(error, "nested", None) or error.__cause__
    return out


def count_nested(error: BaseException) -> int:
    return len(flatten(error)) - 1


def find(error: BaseException, test: Callable[[BaseException], bool]) -> BaseException | None:
    return next((e for e in flatten(error) if test(e)), None)


def find_by_code(error: BaseException, code: int) -> BaseException | None:
    return find(error, lambda e: getattr(e, "code", None) == code)


def find_by_kind(error: BaseException, kind: str) -> BaseException | None:
    return find(error, lambda e: getattr(e, "kind", None) == kind)


def is_schema_error(error: BaseException) -> bool:
    return getattr(error, "kind", None) in SCHEMA_KINDS


def describe(code: int) -> str:
    return next((k.replace("_", " ") for k, c in CODES.items() if c == code), "unknown error")


def format_error(error: BaseException) -> str:
    """One line for each error of the chain."""

    def lines() -> Iterator[str]:
        for depth, e in enumerate(flatten(error)):
            yield "  " * depth + (str(e) if isinstance(e, EngineError) else f"{type(e).__name__}: {e}".split("\n")[0])

    return "\n".join(lines())
