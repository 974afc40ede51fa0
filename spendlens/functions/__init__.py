"""Column-expression builders (share cards, fold, clamp, decimal normalisation)."""
