"""Column expressions (all built-in, JVM-side, whole-stage codegen)."""

from .scalar import tag_count, safe_div, round6, bround6, sigmoid, threshold, word_tokens

__all__ = ["tag_count", "safe_div", "round6", "bround6", "sigmoid", "threshold", "word_tokens"]
