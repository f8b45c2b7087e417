"""Column expressions over class scores."""

from pyspark.sql import Column, functions as F


def p_positive(logit_neg: Column, logit_pos: Column) -> Column:
    """Softmax of two logits, second entry."""
    return 1.0 / (1.0 + F.exp(logit_neg - logit_pos))


def sigmoid(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


def predicted(p_pos: Column, threshold: float = 0.5) -> Column:
    """Class of a positive-class probability; the threshold itself counts as positive."""
    return (p_pos >= threshold).cast("int")


def arg_max(p: Column) -> Column:
    """Index of the largest probability, the first one on ties."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def target_class(p: Column, target: int | None = None) -> Column:
    """The class to explain: a fixed one, or the most probable."""
    return arg_max(p) if target is None else F.lit(target).cast("int")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y),
                       F.lit(0.0), lambda acc, x: acc + x)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)),
        F.lit(0.0), lambda acc, x: acc + x)


def fixed_decimals(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", value)
