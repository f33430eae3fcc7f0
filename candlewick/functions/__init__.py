from candlewick.functions import expressions, scalars

__all__ = ["expressions", "scalars"]
