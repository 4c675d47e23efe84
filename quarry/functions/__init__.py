"""Column-expression building blocks (all JVM-side, inside whole-stage codegen)."""

from quarry.functions.text import ascii_lower, url_terms, ws_terms, WS_PATTERN  # noqa: F401
from quarry.functions.vectors import sublinear, dot, vec_diff, vec_scale  # noqa: F401
