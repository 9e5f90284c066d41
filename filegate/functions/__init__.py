"""Column-level building blocks: name/manifest parsing, deterministic keys, state rules."""

from filegate.functions import keys, parsing, rules

__all__ = ["keys", "parsing", "rules"]
