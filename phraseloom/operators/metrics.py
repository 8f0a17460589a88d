"""Two-class metrics from the four counts of (actual, predicted)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from phraseloom.functions import fixed_values as V


def _cell(actual: int, predicted: int, weight: Column) -> Column:
    hit = (F.col("actual") == actual) & (F.col("predicted") == predicted)
    return F.coalesce(F.sum(F.when(hit, weight)), F.lit(0)).cast("bigint").alias(f"c{actual}{predicted}")


def four_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """One row c00, c01, c10, c11 (actual, predicted), zero where a class is missing."""
    w = F.lit(1) if weight is None else F.col(weight)
    return df.agg(*[_cell(a, p, w) for a in (0, 1) for p in (0, 1)])


def confusion_matrix(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows actual, columns predicted, always 2 x 2."""
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("actual"), F.col(f"c{i}0").alias("literal"), F.col(f"c{i}1").alias("idiomatic"))
            for i, name in V.LABEL_NAMES.items()
        ]
    )
    return four_counts(df, weight).select(F.inline(rows))


def _ratio(a: Column, b: Column) -> Column:
    """Zero where the denominator is zero."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _class_scores(i: int) -> dict[str, Column]:
    o = 1 - i
    hit, missed, wrong = F.col(f"c{i}{i}"), F.col(f"c{i}{o}"), F.col(f"c{o}{i}")
    return {
        "precision": _ratio(hit, hit + wrong),
        "recall": _ratio(hit, hit + missed),
        "f1": _ratio(2 * hit, 2 * hit + wrong + missed),
        "support": hit + missed,
    }


def _accuracy() -> Column:
    total = F.col("c00") + F.col("c01") + F.col("c10") + F.col("c11")
    return _ratio(F.col("c00") + F.col("c11"), total)


def _present(i: int) -> Column:
    """Whether the class occurs, as an actual or a predicted one; an absent class is not averaged."""
    o = 1 - i
    return (F.col(f"c{i}{i}") + F.col(f"c{i}{o}") + F.col(f"c{o}{i}") > 0).cast("int")


def _macro(name: str) -> Column:
    return _ratio(_class_scores(0)[name] + _class_scores(1)[name], _present(0) + _present(1))


def macro_metrics(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Accuracy and macro F1, precision and recall."""
    return four_counts(df, weight).select(
        _accuracy().alias("accuracy"),
        _macro("f1").alias("f1"),
        _macro("precision").alias("precision"),
        _macro("recall").alias("recall"),
    )


def classification_report(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Class rows, accuracy, macro and weighted averages, to 4 places."""
    zero, one = _class_scores(0), _class_scores(1)
    support = zero["support"] + one["support"]

    def row(name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row_name"),
            F.round(p, 4).alias("precision"),
            F.round(r, 4).alias("recall"),
            F.round(f, 4).alias("f1"),
            n.alias("support"),
        )

    def weighted(name: str) -> Column:
        return _ratio(zero[name] * zero["support"] + one[name] * one["support"], support)

    names = ("precision", "recall", "f1")
    rows = [
        row(V.LABEL_NAMES[0], *[zero[m] for m in names], zero["support"]),
        row(V.LABEL_NAMES[1], *[one[m] for m in names], one["support"]),
        row("accuracy", _accuracy(), _accuracy(), _accuracy(), support),
        row("macro avg", *[_macro(m) for m in names], support),
        row("weighted avg", *[weighted(m) for m in names], support),
    ]
    return four_counts(df, weight).select(F.inline(F.array(*rows)))
