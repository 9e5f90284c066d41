"""Table-to-table operators: parse, register, groups, ready, dispatch, audit, reports."""

from filegate.operators import audit, dispatch, groups, parse, ready, register, reports

__all__ = ["audit", "dispatch", "groups", "parse", "ready", "register", "reports"]
