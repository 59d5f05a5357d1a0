"""Column-expression building blocks (all JVM-side, code-generated)."""

from linfold.functions.vectors import (  # noqa: F401
    dot,
    gradient_summand,
    interaction_terms,
    predict,
    scale,
    squared_error,
    two_way_interactions,
)
