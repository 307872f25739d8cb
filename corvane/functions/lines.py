"""Clean-up of delimited text lines before they are typed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where a run-together leading id ends, by its first digit.
ID_LENGTH_BY_FIRST_DIGIT = {"9": 7, "1": 8}
ID_SCAN_LENGTH = 10


def split_joined_id(line: Column) -> Column:
    """Put the missing comma after a leading id that ran into the next value."""
    chain = F.when(F.instr(F.substring(line, 1, ID_SCAN_LENGTH), ",") > 0, line)
    for digit, length in ID_LENGTH_BY_FIRST_DIGIT.items():
        mended = F.concat(
            F.substring(line, 1, length),
            F.lit(","),
            F.substring(line, F.lit(length + 1), F.char_length(line)),
        )
        chain = chain.when(line.startswith(digit), mended)
    return chain.otherwise(line)


def drop_null_words(line: Column, whole_fields_only: bool = False) -> Column:
    """Remove the text ``NULL``: everywhere, or only where it is a whole field."""
    if whole_fields_only:
        return F.regexp_replace(line, r"(^|(?<=,))NULL(?=,|$)", "")
    return F.replace(line, F.lit("NULL"), F.lit(""))


def rewrite_datetimes(
    line: Column, source: str = "M/d/yyyy H:m", target: str = "yyyy-MM-dd HH:mm:ss", strict: bool = True
) -> Column:
    """Rewrite the first and the last field that hold ``/20`` as date-times.

    Where such a field does not parse, or fewer than two exist, ``strict``
    fails the job; otherwise the line becomes null.
    """
    fields = F.split(line, ",")
    dated = F.transform(fields, lambda field: F.contains(field, F.lit("/20")))
    first = F.array_position(dated, True)
    last = F.size(fields) + 1 - F.array_position(F.reverse(dated), True)

    def rewrite(field: Column, index: Column) -> Column:
        parsed = F.date_format(F.try_to_timestamp(field, F.lit(source)), target)
        return F.when((index + 1 == first) | (index + 1 == last), parsed).otherwise(field)

    rewritten = F.transform(fields, rewrite)
    good = (first > 0) & (first < last) & ~F.exists(rewritten, lambda field: field.isNull())
    problem = F.raise_error(F.concat(F.lit("no two date-times in line: "), line)) if strict else F.lit(None)
    return F.when(line.isNull(), line).when(good, F.array_join(rewritten, ",")).otherwise(problem.cast("string"))


def fields_by_name(line: Column, names: Sequence[str]) -> list[Column]:
    """One text column per name from a comma-separated line.

    Double quotes, then CR-LF, are removed first, so a comma inside quotes
    splits too. Extra values are ignored, missing ones are null.
    """
    bare = F.replace(F.replace(line, F.lit('"'), F.lit("")), F.lit("\r\n"), F.lit(""))
    values = F.split(bare, ",")
    return [F.get(values, position).alias(name) for position, name in enumerate(names)]
