"""The analyses on small literal tables, and the shape of their plans."""

import datetime

import pytest
from pyspark.sql import functions as F

from corvane import jobs
from corvane.plans import movies, social, staff, trips
from corvane.session import shuffle_partitions_for

POSTS = "post_id string, profile_id bigint, cts timestamp, post_type int, description string, numbr_likes bigint, number_comments bigint"


def at(text):
    return datetime.datetime.fromisoformat(text)


@pytest.fixture
def posts(spark):
    rows = [
        ("p1", 1, at("2015-12-01 10:00:00"), 1, "#a b #a", 10, 1),
        ("p2", 1, at("2015-12-02 10:30:00"), 2, None, 20, None),
        ("p3", 2, at("2016-01-01 00:00:00"), 9, "a  #b", 30, 3),
        ("p4", 2, None, 1, "#c", 40, 4),
        ("p5", 9, at("2016-05-05 05:05:05"), 3, "", 50, 5),
    ]
    return spark.createDataFrame(rows, POSTS)


@pytest.fixture
def profiles(spark):
    names = ["profile_id", "profile_name", "firstname_lastname", "description", "following", "followers", "url", "cts", "is_business_account"]
    rows = [
        ("1", "one", "One", None, "5", "1000", "u", "2019-01-01 00:00:00", "True"),
        ("1", "one", "One", None, "5", "1000", "u", "2019-01-01 00:00:00", "True"),
        ("2", "two", "Two", "d", "6", "1001", "u", "bad", "False"),
        ("3", "three", "Three", "d", None, "n/a", "u", None, "x"),
    ]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


@pytest.fixture
def locations(spark):
    names = ["id", "name", "street", "zip", "city", "region", "cd", "phone", "lat", "lng", "website"]
    rows = [
        ("1", "n1", "s", "z", "Lima", "r", "PE", None, "10.5", "-77.25", "w"),
        ("2", "n2", "s", "z", "Ohio", "r", "US", None, "100.5", "x", "w"),
        ("2", "n3", "s", "z", "Ohio", "r", "US", None, "20.5", "1.5", "w"),
        ("8", "n8", "s", "z", None, "r", None, None, None, None, "w"),
    ]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


@pytest.fixture
def joined(profiles, locations, posts):
    return social.join_sources(profiles, locations, posts)


def test_joined_rows(joined, values):
    rows = values(joined.select("profile_id", "location_name", "post_id", "latitude", "followers", "is_business_account"))
    shown = [(p, n, i, None if lat is None else float(lat), f, b) for p, n, i, lat, f, b in rows]
    assert sorted(shown, key=repr) == sorted(
        [
            (1, "n1", "p1", 10.5, 1000, True),
            (1, "n1", "p2", 10.5, 1000, True),
            (2, "n2", "p3", None, 1001, False),
            (2, "n2", "p4", None, 1001, False),
            (2, "n3", "p3", 20.5, 1001, False),
            (2, "n3", "p4", 20.5, 1001, False),
            (3, None, None, None, None, None),
        ],
        key=repr,
    )
    assert list(social.JOINED_TYPES) == joined.columns


def test_joined_inner(profiles, locations, posts):
    inner = social.join_sources(profiles, locations, posts, "inner", distinct_locations=True)
    assert sorted((r.profile_id, r.location_name, r.post_id) for r in inner.collect()) == [
        (1, "n1", "p1"), (1, "n1", "p2"), (2, "n2", "p3"), (2, "n2", "p4"),
    ]
    with pytest.raises(ValueError, match="left or inner"):
        social.join_sources(profiles, locations, posts, "cross")


def test_profiles_may_name_their_location(profiles, locations, posts):
    moved = profiles.withColumn("place", F.lit("8"))
    df = social.join_sources(moved, locations, posts, profile_location_key="place")
    assert {r.location_name for r in df.collect()} == {"n8"}


def test_years_hours_and_months(joined, posts, values):
    dated = posts.withColumnRenamed("cts", "timestamp_post")
    assert [tuple(r) for r in social.posts_per_year(dated).collect()] == [(2016, 2), (2015, 2)]
    assert [tuple(r) for r in social.posts_per_year_text(dated).collect()] == [("2016", 2), ("2015", 2)]
    assert values(social.peak_hours(dated)) == [(2015, 10, 2), (2016, 0, 1), (2016, 5, 1)]
    assert values(social.peak_hours_in_month(dated)) == [(2015, 12, 10, 2)]
    assert values(social.peak_hours_in_month(dated, 2016, 1)) == [(2016, 1, 0, 1)]
    assert social.total_rows(joined).first()[0] == 7


def crowd_of(spark, locations, posts):
    """Locations that repeat for one profile, and posts of profiles that nobody knows."""
    more = locations.where("id = '1'").withColumn("name", F.lit("again"))
    strange = posts.limit(1).withColumn("profile_id", F.lit(99).cast("bigint"))
    return locations.union(more), posts.unionByName(strange)


@pytest.mark.parametrize("few", [social.FEW_OWNERS, 0])
def test_questions_agree_with_the_joined_table(spark, profiles, locations, posts, values, few):
    locations, posts = crowd_of(spark, locations, posts)
    profiles = profiles.unionByName(profiles.where("profile_id = '2'").withColumn("profile_id", F.lit("002")))
    joined = social.join_sources(profiles, locations, posts)
    for question, slot in (
        (social.posts_per_year, "year"), (social.posts_per_year_text, "year"), (social.peak_hours, "hour of year"),
        (social.peak_hours, "hour"), (social.peak_hours_in_month, "hour"),
    ):
        weighted = social.weighted_posts(profiles, locations, posts, slot)
        assert values(question(weighted)) == values(question(joined))
    for hashtags_only, name, question in (
        (True, "hashtag", social.top_hashtags), (False, "split_words", social.top_words)
    ):
        counted = social.weighted_words(profiles, locations, posts, hashtags_only, few)
        assert values(social.top_pieces(counted, name)) == values(question(joined))
    assert values(social.total_rows_from_sources(profiles, locations, posts)) == values(social.total_rows(joined))


def test_full_filter_changes_no_count(spark, profiles, locations, posts, values, monkeypatch):
    locations, posts = crowd_of(spark, locations, posts)
    expected = values(social.top_words(social.join_sources(profiles, locations, posts)))
    monkeypatch.setattr(social, "FILTER_WORDS", 1)
    crowd = spark.range(5000).selectExpr("cast(id + 1000 AS bigint) AS profile_id", "'x' AS description")
    posts = posts.select("profile_id", "description").unionByName(crowd)
    counted = social.weighted_words(profiles, locations, posts, hashtags_only=False, few=0)
    assert values(social.top_pieces(counted, "split_words")) == expected


@pytest.mark.parametrize("few", [social.FEW_OWNERS, 0])
def test_texts_are_counted_before_they_shuffle(spark, profiles, locations, posts, plan_of, setting, few):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    weighted = social.weighted_words(profiles, locations, posts, hashtags_only=False, few=few)
    counted = weighted.groupBy("piece").agg(F.sum("weight"))
    plan = plan_of(counted)
    above = plan.split("Generate explode")[0]  # the scan of the posts is the last that explodes
    assert "partial_" in above.rsplit("Exchange", 1)[1], plan
    assert "description" not in above.rsplit("Exchange", 1)[0], plan


def test_posts_are_counted_below_the_join(spark, profiles, locations, posts, plan_of, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(social.posts_per_year(social.weighted_posts(profiles, locations, posts, "year")))
    below = plan[plan.index("SortMergeJoin") :]
    partial = next(at for at, line in enumerate(below.splitlines()) if "partial_count(1)" in line)
    assert any("Exchange hashpartitioning(__owner" in line for line in below.splitlines()[:partial]), plan


def test_total_rows_reads_keys_only(spark, profiles, locations, posts, tmp_path, plan_of):
    for name, df in (("a", profiles), ("b", locations), ("c", posts)):
        df.write.parquet(str(tmp_path / name))
    plan = plan_of(social.total_rows_from_sources(*(spark.read.parquet(str(tmp_path / name)) for name in "abc")))
    assert "description" not in plan and "website" not in plan


def test_joined_inner_with_names(profiles, locations, posts):
    named = social.join_sources(profiles, locations, posts, "inner", distinct_locations=True, with_names=True)
    assert len(named.columns) == 25 and "firstname_lastname" in named.columns
    assert dict(named.dtypes)["followers"] == "string"


def test_joined_table_reads_each_source_once(spark, profiles, locations, posts, tmp_path, plan_of, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, df in (("a", profiles), ("b", locations), ("c", posts)):
        df.write.parquet(str(tmp_path / name))
    joined = social.join_sources(*(spark.read.parquet(str(tmp_path / name)) for name in "abc"))
    plan = plan_of(joined, run=True)
    assert f"{tmp_path}/a" not in plan and f"{tmp_path}/b" not in plan


def test_hashtags_and_words(posts, values):
    assert values(social.top_hashtags(posts, "description")) == [("#a", 2), ("#b", 1), ("#c", 1)]
    assert social.top_hashtags(posts, "description").first()[0] == "#a"
    words = dict(map(tuple, social.top_words(posts, "description").collect()))
    assert words == {"#a": 2, "b": 1, "a": 1, "": 2, "#b": 1, "#c": 1}


def test_places(locations, values):
    assert values(social.visited_places(locations)) == [("PE", "n1", 1), ("US", "n2", 1), ("US", "n3", 1)]
    assert [tuple(r) for r in social.visited_cities(locations).collect()] == [("United States", "Ohio", 2), ("PE", "Lima", 1)]


def test_types_and_impact(posts, values):
    assert values(social.types_per_year(posts)) == [
        (2015, "photo", 1), (2015, "video", 1), (2016, "multy", 1), (2016, None, 1),
    ]
    assert [tuple(r) for r in social.impact_per_type(posts).collect()] == [
        (2016, "multy", 50, 5), (2016, None, 30, 3), (2015, "video", 20, None), (2015, "photo", 10, 1),
    ]


def test_weekdays_and_characters(posts, values):
    assert values(social.posts_per_weekday(posts)) == [
        (2015, "Tuesday", 1), (2015, "Wednesday", 1), (2016, "Friday", 1), (2016, "Thursday", 1),
    ]
    assert [(r[0], float(r[1])) for r in social.mean_characters(posts).collect()] == [(2016, 2.5), (2015, 7.0)]
    split_style = social.mean_characters(posts, split_style=True).collect()
    assert [(r[0], float(r[1])) for r in split_style] == [(2016, 3.5), (2015, 3.5)]


def test_profile_impact_merges_copies(joined, values):
    rows = values(social.profile_impact(joined))
    assert rows == sorted(
        [
            (2015, "0_to_1k_followers", True, "photo", "0_to_50_characters", "0_to_10_hashtags", 10, 1),
            (2016, "1k_to_10k_followers", False, None, "0_to_50_characters", "0_to_10_hashtags", 30, 3),
            (None, "1k_to_10k_followers", False, "photo", "0_to_50_characters", "0_to_10_hashtags", 40, 4),
        ],
        key=repr,
    )


def test_profile_impact_from_sources_agrees(profiles, locations, posts, joined, values):
    for split_style in (False, True):
        direct = social.profile_impact_from_sources(profiles, locations, posts, split_style)
        assert values(direct) == values(social.profile_impact(joined, split_style))


def test_profile_impact_from_sources_counts_locations(spark, profiles, locations, posts, values):
    crowd = locations.where("id = '1'").withColumn("id", F.explode(F.array_repeat("id", 6)))
    joined = social.join_sources(profiles, crowd, posts)
    direct = social.profile_impact_from_sources(profiles, crowd, posts)
    assert values(direct) == values(social.profile_impact(joined))
    assert "10_to_20_hashtags" in {row.number_hashtags for row in direct.collect()}


def test_profile_impact_shuffles_no_text(spark, profiles, locations, posts, tmp_path, plan_of, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    posts.write.parquet(str(tmp_path / "posts"))
    plan = plan_of(social.profile_impact_from_sources(profiles, locations, spark.read.parquet(str(tmp_path / "posts"))))
    sides = [line for line in plan.splitlines() if "Exchange hashpartitioning(owner" in line]
    below = plan.split(sides[0])[1].splitlines()[1]
    assert "Project" in below and "text_digest" in below and "AS description_post" not in below


def test_profile_impact_adds_the_hashtags_of_copies(spark, joined):
    crowded = joined.where("post_id = 'p1'").crossJoin(spark.range(6))
    row = social.profile_impact(crowded).first()
    assert (row.number_hashtags, row.total_likes) == ("10_to_20_hashtags", 10)


def test_month_filter_reaches_the_scan(spark, posts, tmp_path, plan_of):
    posts.withColumnRenamed("cts", "timestamp_post").write.parquet(str(tmp_path / "posts"))
    plan = plan_of(social.peak_hours_in_month(spark.read.parquet(str(tmp_path / "posts"))))
    assert "GreaterThanOrEqual(timestamp_post,2015-12-01" in plan
    assert "ReadSchema: struct<timestamp_post:timestamp>" in plan


def test_impact_reads_four_columns_in_one_shuffle(spark, posts, tmp_path, plan_of):
    posts.write.parquet(str(tmp_path / "posts"))
    plan = plan_of(social.impact_per_type(spark.read.parquet(str(tmp_path / "posts"))))
    assert "ReadSchema: struct<cts:timestamp,post_type:int,numbr_likes:bigint,number_comments:bigint>" in plan
    assert "IsNotNull(cts)" in plan and plan.count("hashpartitioning") == 1


TRIPS = "tpep_pickup_datetime timestamp, PULocationID int, DOLocationID int, trip_distance double, RatecodeID int, passenger_count int, total_amount double"


@pytest.fixture
def rides(spark):
    rows = [
        (at("2018-01-25 00:01:00"), 1, 2, 3.0, 1, 1, 10.0),
        (at("2018-01-25 00:02:00"), 1, 2, 30.0, 1, 2, 20.0),
        (at("2018-01-25 00:03:00"), 1, 1, 31.0, 2, 1, 30.0),
        (at("2018-01-26 05:00:00"), 2, 1, None, 2, 5, 40.0),
        (at("2018-01-26 05:00:00"), 7, 7, 1.0, None, 1, None),
    ]
    return spark.createDataFrame(rows, TRIPS)


@pytest.fixture
def zones(spark):
    rows = [(1, "Queens", "A", "Boro"), (2, "Bronx", "B", "Boro"), (3, "Bronx", "C", "Boro")]
    return spark.createDataFrame(rows, "LocationID int, Borough string, Zone string, service_zone string")


def test_trip_counts(rides, zones, values):
    assert values(trips.zone_pickups(rides, zones)) == [(1, 3, "Queens", "A"), (2, 1, "Bronx", "B")]
    assert [tuple(r) for r in trips.borough_pickups(rides, zones).collect()] == [("Queens", 3), ("Bronx", 1)]
    assert values(trips.pickups_by_hour(rides)) == [(0, 3), (5, 2)]
    assert values(trips.trips_by_length(rides)) == [(False, 2), (None, 1), (True, 2)]
    assert (0, True, 2) in values(trips.pickups_by_hour_and_length(rides))
    assert values(trips.ratecode_distribution(rides)) == [(1, 2), (2, 2), (None, 1)]
    day = datetime.date(2018, 1, 25)
    assert [tuple(r) for r in trips.ratecode_by_day(rides).collect()][0][0] == day


def test_distance_statistics(rides):
    row = trips.distance_statistics(rides).first()
    assert (row["count"], row.threshold, row["mean"], row["min"], row["max"]) == (5, 30, 16.25, 1.0, 31.0)


def test_pair_popularity(rides, zones, values):
    assert values(trips.pair_popularity(rides, zones, F.col("isLong"))) == [(1, "A", "A"), (1, "A", "B")]
    assert values(trips.pair_popularity(rides, zones, ~F.col("isLong"))) == [(1, "A", "B")]
    assert values(trips.pair_popularity(rides, zones, F.lit(True), top=1)) == [(2, "A", "B")]


def test_group_attempts(rides, zones):
    rows = [r.asDict() for r in trips.group_attempts(rides, zones).collect()]
    assert rows[0] == {
        "PULocationID": 1, "total_trips": 2, "total_amount": 30.0, "Borough": "Queens", "Zone": "A",
        "approximate_datetime": "2018-01-25 00:00:00",
    }
    assert [r["approximate_datetime"] for r in rows[1:]] == ["2018-01-25 00:05:00"]


def test_economic_impact(rides, zones):
    saving = 0.6 * 25.0 - 5
    expected = 3 * 0.05 * 0.3 * saving + 3 * 0.05 * 0.7 * 2
    assert trips.economic_impact(rides, zones).first()[0] == pytest.approx(expected)
    history = rides.withColumnsRenamed({"tpep_pickup_datetime": "pickup_datetime", "PULocationID": "pickup_taxizone_id"})
    scaled = 4 * 289623 / 331893 * (0.05 * 0.3 * saving + 0.05 * 0.7 * 2)
    assert trips.economic_impact_of_history(history, zones).first()[0] == pytest.approx(scaled)


def test_impact_reads_trips_once_and_shuffles_them_by_zone(spark, rides, zones, tmp_path, plan_of):
    rides.write.parquet(str(tmp_path / "rides"))
    plan = plan_of(trips.economic_impact(spark.read.parquet(str(tmp_path / "rides")), zones))
    assert plan.count("FileScan parquet") == 1 and "hashpartitioning(PULocationID" in plan
    assert not [step for step in ("Subquery", "Cartesian", "NestedLoop", "slot") if step in plan]


def test_impact_of_no_counted_trips_is_null(rides, zones):
    assert trips.economic_impact(rides.where("passenger_count > 5"), zones).first()[0] is None


@pytest.fixture
def staff_tables(spark):
    day = datetime.date
    hired = [(1, day(1999, 1, 1)), (2, day(1999, 1, 2)), (3, day(1999, 12, 31)), (4, day(2000, 1, 1)), (5, day(1999, 6, 1))]
    return {
        "employees": spark.createDataFrame(hired, "emp_no int, hire_date date"),
        "dept_emp": spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (3, "a"), (5, "b"), (5, "c")], "emp_no int, dept_no string"),
        "departments": spark.createDataFrame([("a", "Alpha"), ("b", "Beta")], "dept_no string, dept_name string"),
        "salaries": spark.createDataFrame([(1, 99.0), (2, 10.0), (2, 30.0), (3, 50.0), (5, None)], "emp_no int, salary double"),
    }


def test_hires_and_pay(staff_tables, values):
    t = staff_tables
    assert staff.hired_count(t["employees"]).first()[0] == 3
    means = staff.mean_salary_by_department(t["employees"], t["dept_emp"], t["salaries"])
    assert values(means) == [("a", 30.0), ("b", 50.0), ("c", None)]
    best = staff.best_paying_department(t["employees"], t["dept_emp"], t["salaries"], t["departments"])
    assert tuple(best.first()) == (50.0, "Beta")


def test_best_paid(spark, staff_tables, values):
    employees, salaries = staff_tables["employees"], staff_tables["salaries"]
    assert values(staff.with_max_salary(employees, salaries).select("emp_no", "maxSalary"))[:2] == [(1, 99.0), (2, 30.0)]
    day = datetime.date
    held = [(1, "boss", day(2001, 1, 1)), (1, "boss", day(2002, 1, 1)), (1, "clerk", day(1999, 1, 1)), (2, "clerk", day(2003, 1, 1))]
    titles = spark.createDataFrame(held, "emp_no int, title string, to_date date")
    rows = staff.titles_of_best_paid(employees, salaries, titles, n=1).select("emp_no", "title", "last_date")
    assert values(rows) == [(1, "boss", day(2002, 1, 1)), (1, "clerk", day(1999, 1, 1))]
    managers = spark.createDataFrame([(1,), (1,), (4,), (None,)], "emp_no int")
    assert [r[0] for r in values(staff.never_managers(employees, managers))] == [2, 3, 5]


def test_mean_rating_agrees_with_sql(spark, values):
    rows = [("Drama", 6.0), ("Drama", 7.5), ("Comedy", None), (None, 9.0), ("Comedy", 5.0)]
    df = spark.createDataFrame(rows, "Major_Genre string, IMDB_Rating double")
    sql = "SELECT Major_Genre, avg(IMDB_Rating) FROM {df} WHERE Major_Genre IS NOT NULL AND IMDB_Rating IS NOT NULL GROUP BY 1"
    assert values(movies.mean_rating_by_genre(df)) == values(spark.sql(sql, df=df)) == [("Comedy", 5.0), ("Drama", 6.75)]


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions_for(1) == 200
    assert shuffle_partitions_for(100 << 40) == 100 * 2**13
    assert shuffle_partitions_for((300 << 20) * 100, 100 << 20) == 300


def test_job_arguments(monkeypatch):
    called = {}
    monkeypatch.setitem(jobs.JOBS, "load", (lambda spark, **given: called.update(given), ["source", "schema", "table"]))
    monkeypatch.setattr(jobs, "build_session", lambda name, input_bytes: called.update(input_bytes=input_bytes))
    jobs.main(["--input-gb", "2", "load", "in/*.csv", "s.txt", "d.t"])
    assert called == {"input_bytes": 2 << 30, "source": "in/*.csv", "schema": "s.txt", "table": "d.t"}
    with pytest.raises(SystemExit):
        jobs.main(["load", "only-one"])


def test_jobs(spark, tmp_path, values):
    (tmp_path / "movies.json").write_text(
        '{"Title": "T", "IMDB_Rating": 7.0, "Release_Date": "d", "Major_Genre": "Comedy"}\n'
        '{"Title": "U", "IMDB_Rating": 6.5, "Release_Date": "d", "Major_Genre": "Comedy"}\n'
    )
    jobs.good_comedies(spark, str(tmp_path / "movies.json"), str(tmp_path / "good"))
    assert [r.Title for r in spark.read.json(str(tmp_path / "good")).collect()] == ["T"]

    (tmp_path / "places.csv").write_text("id\tcd\tcity\n1\tUS\tX\n2\tUS\tX\n3\tPE\t\n")
    jobs.visited_cities(spark, str(tmp_path / "places.csv"), str(tmp_path / "cities"))
    cities = spark.read.csv(str(tmp_path / "cities"), header=True)
    assert [tuple(r) for r in cities.collect()] == [("United States", "X", "2")]

    (tmp_path / "posts.csv").write_text("a\tb\n1\t2\n1\t2\n3\t4\n")
    jobs.sample_posts(spark, str(tmp_path / "posts.csv"), str(tmp_path / "sample"))
    assert values(spark.read.csv(str(tmp_path / "sample"), sep="\t", header=True)) == [("1", "2"), ("3", "4")]

    trip = spark.createDataFrame([(at("2015-01-01 00:00:00"), 1, 20.0)], "pickup_datetime timestamp, pickup_taxizone_id int, total_amount double")
    trip.write.parquet(str(tmp_path / "trips"))
    (tmp_path / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n1,Queens,A,Boro\n")
    jobs.economic_impact(spark, str(tmp_path / "trips"), str(tmp_path / "zones.csv"), str(tmp_path / "impact"))
    total = float(spark.read.csv(str(tmp_path / "impact"), header=True).first().total)
    assert total == pytest.approx(289623 / 331893 * (0.05 * 0.3 * 7 + 0.05 * 0.7 * 2))
