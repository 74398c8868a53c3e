"""Column-level helpers (pure Column -> Column builders)."""

from hirelake.functions import dates, keys, rules, text  # noqa: F401
