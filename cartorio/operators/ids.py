"""Establishment ids: check digits and uniqueness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.fixed import CHECK_WEIGHTS, ID_PATTERN
from cartorio.functions.columns import count_where, ratio


#: Places among which the rows of one id are dealt.
SALTS = 16


def _digit(values: list[Column], weights: tuple[int, ...]) -> Column:
    total = sum((value * weight for value, weight in zip(values, weights, strict=True)), F.lit(0))
    return F.when(total % 11 < 2, 0).otherwise(11 - total % 11)


def check_digits(stem: Column) -> Column:
    """The two digits that belong to the first twelve characters of an id: sums of weighted characters
    modulo eleven. A letter counts as its distance from the character 0, as a digit does."""
    values = [F.ascii(F.substring(stem, at, 1)) - 48 for at in range(1, 13)]
    first = _digit(values, CHECK_WEIGHTS[1:])
    second = _digit([*values, first], CHECK_WEIGHTS)
    return F.concat(first.cast("string"), second.cast("string"))


def malformed(column: str = "cnpj_completo") -> Column:
    """An id that isn't twelve digits or capital letters and two digits; null isn't malformed."""
    return ~F.col(column).rlike(ID_PATTERN)


def wrong_digits(column: str = "cnpj_completo") -> Column:
    """A well-formed id whose check digits aren't those of its stem."""
    of = F.col(column)
    return of.rlike(ID_PATTERN) & (check_digits(F.substring(of, 1, 12)) != F.substring(of, 13, 2))


def id_digit_checks(rows: DataFrame, column: str = "cnpj_completo", most: float = 0.0) -> DataFrame:
    """One row: ids, those absent, malformed, and of wrong digits, and whether their share (of the ids
    there are) is at most ``most``. One pass, no shuffle but of partial counts."""
    measured = rows.agg(
        F.count(column).alias("ids"), count_where(F.col(column).isNull()).alias("null_ids"),
        count_where(malformed(column)).alias("malformed_ids"), count_where(wrong_digits(column)).alias("wrong_digits"),
    )
    bad = ratio(F.col("malformed_ids") + F.col("wrong_digits"), F.col("ids"))
    return measured.withColumn("bad_rate", bad).withColumn("digits_acceptable", F.col("bad_rate") <= most)


def doubled_ids(rows: DataFrame, column: str = "cnpj_completo") -> DataFrame:
    """The ids that occur several times, and how often; null is no id.

    Nearly all ids occur once. They are told by eight bytes: hashes are counted (as far as they meet in
    a task, before the shuffle), and only the ids of hashes counted twice are counted themselves, so a
    collision doubles nobody. An id with a third of all rows is a row a task in either count; between
    them its rows are dealt to ``SALTS`` places, because an aggregate below a join keeps adaptive
    execution from splitting it.
    """
    ids = rows.filter(F.col(column).isNotNull()).select(column)
    often = ids.groupBy(F.xxhash64(column).alias("mark")).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    often = often.select("mark", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = ids.withColumns({"mark": F.xxhash64(column), "salt": F.spark_partition_id() % SALTS})
    return (
        salted.join(often, ["mark", "salt"], "left_semi")
        .groupBy(column).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    )
