import datetime

import pytest
from pyspark.sql import functions as F

from corvane.functions import dates, lines
from corvane.functions.casting import cast_columns
from corvane.functions.labels import (
    CHARACTER_RANGES,
    FOLLOWER_RANGES,
    HASHTAG_RANGES,
    country_label,
    post_type_label,
    range_label,
)
from corvane.functions.text import character_count, contains_any, has_hashtag, hashtag_count, hashtags, matches_any, words


@pytest.fixture
def apply(spark):
    """Apply a column expression to Python values."""

    def run(expression, given, kind="string"):
        rows = spark.createDataFrame([(i, value) for i, value in enumerate(given)], f"i int, x {kind}")
        return [row[0] for row in rows.orderBy("i").select(expression(F.col("x"))).collect()]

    return run


@pytest.mark.parametrize("ranges", [FOLLOWER_RANGES, CHARACTER_RANGES, HASHTAG_RANGES])
def test_ranges_at_their_ends(apply, ranges):
    for low, high, label in ranges:
        last = low + 10**9 if high is None else high
        assert apply(lambda c: range_label(c, ranges), [low, last], "bigint") == [label, label]


def test_ranges_outside(apply):
    assert apply(lambda c: range_label(c, FOLLOWER_RANGES), [-1, None], "bigint") == [None, None]


def test_ranges_leave_no_gap():
    for ranges in (FOLLOWER_RANGES, CHARACTER_RANGES, HASHTAG_RANGES):
        assert ranges[0][0] == 0 and ranges[-1][1] is None
        assert all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:]))


def test_code_labels(apply):
    assert apply(post_type_label, [1, 2, 3, 4, None], "int") == ["photo", "video", "multy", None, None]
    assert apply(country_label, ["US", "MX", None]) == ["United States", "MX", None]


TEXTS = ["#a b #c", "a  b", "", "#", "# #", "a#b", "a #", "##x #", " #x", "no tags", "\n#a", None]


def test_words_keep_empty_pieces(apply):
    assert apply(words, ["a  b", ""]) == [["a", "", "b"], [""]]


def test_hashtags_are_blank_separated(apply):
    expected = [None if t is None else [w for w in t.split(" ") if w.startswith("#")] for t in TEXTS]
    assert apply(hashtags, TEXTS) == expected
    assert apply(hashtag_count, TEXTS) == [None if e is None else len(e) for e in expected]
    assert apply(has_hashtag, TEXTS) == [None if e is None else bool(e) for e in expected]


def test_hashtag_count_of_wide_characters(apply):
    assert apply(hashtag_count, ["é #ñ ü#x #日本", "日本 日本"]) == [2, 0]


def test_characters(apply):
    assert apply(character_count, ["abc", "", "né", None]) == [3, 0, 2, None]
    assert apply(lambda c: character_count(c, split_style=True), ["abc", "", None]) == [4, 1, -1]


def test_any_of(apply):
    names = ["volkswagen rabbit", "ford pinto", "Ford pinto", "fiat", None]
    assert apply(lambda c: contains_any(c, ["ford", "volks"]), names) == [True, True, False, False, None]
    assert apply(lambda c: contains_any(c, []), names) == [False] * 5
    assert apply(lambda c: matches_any(c, ["Ford", "VolksWagen"]), names) == [True, True, False, False, None]
    assert apply(lambda c: matches_any(c, []), names) == [False, False, False, False, None]
    assert apply(lambda c: matches_any(c, ["x*"]), names) == [False, False, False, False, None]


def test_dates_in_several_spellings(apply):
    formats = ["d-MMM-yy", "yyyy-MM-dd", "MMM d yyyy"]
    given = ["7-Aug-98", "07-Aug-98", "1998-08-07", "Aug 7 1998", "7/8/98", "", None]
    day, later = datetime.date(1998, 8, 7), datetime.date(2098, 8, 7)
    assert apply(lambda c: dates.parse_date(c, formats), given) == [later, later, day, day, None, None, None]
    fixed = apply(lambda c: dates.not_after(dates.parse_date(c, formats), F.lit("2024-01-01").cast("date")), given)
    assert fixed == [day, day, day, day, None, None, None]


def test_age(apply):
    age = apply(lambda c: dates.age_in_years(c.cast("date"), F.lit("2001-01-01").cast("date")), ["2000-01-02", None])
    assert age == [1.0, None]
    assert apply(lambda c: dates.age_in_years(F.date_sub(F.current_date(), 730)), ["x"]) == [2.0]


def test_nearest_slot(apply):
    given = ["2018-01-25 00:02:29", "2018-01-25 00:02:30", "2018-01-25 00:05:00"]
    slots = apply(lambda c: dates.slot_time(dates.nearest_slot(c.cast("timestamp"))), given)
    assert slots == ["2018-01-25 00:00:00", "2018-01-25 00:05:00", "2018-01-25 00:05:00"]


@pytest.mark.parametrize("seconds", [300, 7, 60])
def test_nearest_slot_rounds_halves_away_from_zero(spark, seconds):
    moments = spark.range(-2000, 2001).withColumn("t", F.timestamp_seconds("id"))
    rounded = F.round(F.col("id") / seconds).cast("int")
    assert moments.where(dates.nearest_slot(F.col("t"), seconds) != rounded).count() == 0


def test_cast_columns_gives_null_for_bad_text(spark):
    df = spark.createDataFrame([("1", "12.5", "yes"), ("x", "123456789", "maybe"), (None, "", "")], "a string, b string, c string")
    rows = [tuple(r) for r in cast_columns(df, {"c": "boolean", "a": "bigint", "b": "decimal(8,6)"}).collect()]
    assert [r[0] for r in rows] == [True, None, None]
    assert [r[1] for r in rows] == [1, None, None]
    assert [None if r[2] is None else float(r[2]) for r in rows] == [12.5, None, None]


def test_joined_ids(apply):
    # The first pair is the published example of the split.
    given = ["10000083720,7239,x", "9123456720,7239", "7123456720,7239", "10000083,720,7239", "1", "9", "", None]
    expected = ["10000083,720,7239,x", "9123456,720,7239", "7123456720,7239", "10000083,720,7239", "1,", "9,", "", None]
    assert apply(lines.split_joined_id, given) == expected


def test_null_words(apply):
    given = ["1,NULL,x", "NULL,a NULL b,NULL", "ANNULLED,NULL", None]
    assert apply(lines.drop_null_words, given) == ["1,,x", ",a  b,", "ANED,", None]
    kept = apply(lambda c: lines.drop_null_words(c, whole_fields_only=True), given)
    assert kept == ["1,,x", ",a NULL b,", "ANNULLED,", None]


HIRE = "10000085,1526,7239,10/03/2020 13:28,Bloor St,7544,10/03/2020 13:53,Foster Pl,3956"


def test_datetimes(apply):
    rewritten = "10000085,1526,7239,2020-10-03 13:28:00,Bloor St,7544,2020-10-03 13:53:00,Foster Pl,3956"
    assert apply(lines.rewrite_datetimes, [HIRE, None]) == [rewritten, None]
    three = "1/2/2020 3:04,5/6/2020 7:08,9/10/2020 11:12"
    assert apply(lines.rewrite_datetimes, [three]) == ["2020-01-02 03:04:00,5/6/2020 7:08,2020-09-10 11:12:00"]


@pytest.mark.parametrize("line", ["no date,at all", "1/2/2020 3:04,only one", "13/40/2020 1:00,1/2/2020 3:04"])
def test_bad_datetimes(apply, line):
    assert apply(lambda c: lines.rewrite_datetimes(c, strict=False), [line]) == [None]
    with pytest.raises(Exception, match="no two date-times in line"):
        apply(lines.rewrite_datetimes, [line])


def test_fields(spark):
    df = spark.createDataFrame([('"a, b",c\r\n,d',), ("x",), ("1,2,3,4,5",), (None,)], "line string")
    rows = [tuple(r) for r in df.select(*lines.fields_by_name(F.col("line"), ["p", "q", "r", "s"])).collect()]
    assert rows == [("a", " b", "c", "d"), ("x", None, None, None), ("1", "2", "3", "4"), (None, None, None, None)]


def test_clock_is_read_once(spark):
    clock = dates.Clock()
    again = dates.Clock.at(clock.text())
    rows = [each.stamped(spark.range(3)).collect() for each in (clock, again)]
    assert rows[0] == rows[1] and len({row.current_timestamp for row in rows[0]}) == 1
    assert dates.Clock.at("2024-01-02T03:04:05").text() == "2024-01-02T03:04:05+00:00"
    shown = dates.Clock.at("2024-01-02T03:04:05.25+02:00").stamped(spark.range(1))
    shown = shown.selectExpr("current_date", "cast(current_timestamp AS string) AS now")
    assert [str(value) for value in shown.first()] == ["2024-01-02", "2024-01-02 01:04:05.25"]
