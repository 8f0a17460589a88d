"""Expressions over numeric arrays: unit vectors, soft-max, arg-max."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from phraseloom.functions import fixed_values as V
from phraseloom.functions.text import as_column


def l2_norm(c: Column | str) -> Column:
    squares = F.aggregate(
        as_column(c), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def l2_normalize(c: Column | str) -> Column:
    """Unit-norm copy as float32, so that the inner product is the cosine; a zero vector gives null."""
    c = as_column(c)
    # The norm enters through a one-element array, so it is computed once and not once per element.
    unit = F.transform(
        F.array(l2_norm(c)),
        lambda n: F.when(n > 0, F.transform(c, lambda x: (x.cast("double") / n).cast("float"))),
    )
    return unit.getItem(0)


def softmax(c: Column | str) -> Column:
    """Probabilities from logits, shifted by the maximum so that exp cannot overflow."""
    c = as_column(c)
    top = F.array_max(c)
    exps = F.transform(F.array(top), lambda m: F.transform(c, lambda x: F.exp(x - m))).getItem(0)
    total = F.aggregate(exps, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(F.array(total), lambda t: F.transform(exps, lambda x: x / t)).getItem(0)


def argmax(c: Column | str) -> Column:
    """Position of the first maximum, from 0."""
    c = as_column(c)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def detection_struct(probabilities: Column | str) -> Column:
    """Two class probabilities -> struct of label, confidence to 4 places, is_idiomatic."""
    p = as_column(probabilities)
    is_idiomatic = argmax(p) == 1
    return F.struct(
        F.when(is_idiomatic, V.LABEL_NAMES[1]).otherwise(V.LABEL_NAMES[0]).alias("label"),
        F.round(F.array_max(p).cast("double"), 4).alias("confidence"),
        is_idiomatic.alias("is_idiomatic"),
    )
