"""Posts, profiles and locations: the joined table and the questions asked of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.casting import cast_columns
from corvane.functions.labels import (
    CHARACTER_RANGES,
    FOLLOWER_RANGES,
    HASHTAG_RANGES,
    country_label,
    post_type_label,
    range_label,
)
from corvane.functions.text import character_count, has_hashtag, hashtag_count, words
from corvane.operators.aggregates import distinct_by
from corvane.operators.joins import lookup, spread_join
from corvane.operators.ordering import sorted_down
from corvane.scratch import materialise

# Slots of time of a post, as SQL so that no session is needed to name them.
SLOTS = {
    "year": "date_trunc('year', cts)",
    "hour of year": "make_timestamp(year(cts), 1, 1, hour(cts), 0, 0)",
    "hour": "date_trunc('hour', cts)",
}
FILTER_WORDS = 1 << 14  # of 64 bits: 128 KB
FEW_OWNERS = 200_000  # odd owners that are broadcast, two numbers each

# The columns of the joined table and their types.
JOINED_TYPES = {
    "profile_id": "bigint",
    "profile_name": "string",
    "description": "string",
    "following": "string",
    "followers": "bigint",
    "url": "string",
    "timestamp_location": "timestamp",
    "is_business_account": "boolean",
    "location_name": "string",
    "street": "string",
    "zip": "string",
    "city": "string",
    "region": "string",
    "country_code": "string",
    "phone": "string",
    "latitude": "decimal(8,6)",
    "longitude": "decimal(9,6)",
    "website": "string",
    "post_id": "string",
    "timestamp_post": "timestamp",
    "post_type": "int",
    "description_post": "string",
    "number_likes": "bigint",
    "number_comments": "bigint",
}


def join_sources(
    profiles: DataFrame,
    locations: DataFrame,
    posts: DataFrame,
    posts_how: str = "left",
    distinct_locations: bool = False,
    profile_location_key: str = "profile_id",
    location_key: str = "id",
    with_names: bool = False,
) -> DataFrame:
    """Profiles with their locations and posts, one typed table.

    Profiles are made distinct by ``profile_id``. Posts are joined ``left``
    (profiles without posts stay) or ``inner``. The location key of a profile
    is a parameter; the published table compares it with ``profile_id``.
    ``with_names`` keeps ``firstname_lastname`` and the types of the sources.

    The located profiles are written once, because an outer join reads them twice.
    """
    if posts_how not in ("left", "inner"):
        raise ValueError("posts_how must be left or inner")
    a = distinct_by(profiles, ["profile_id"], profiles.columns).select(
        F.col("profile_id").try_cast("bigint").alias("profile_id"),
        F.col(profile_location_key).try_cast("bigint").alias("__place"),
        "profile_name",
        *(["firstname_lastname"] if with_names else []),
        "description",
        "following",
        "followers",
        "url",
        F.col("cts").alias("timestamp_location"),
        "is_business_account",
    )
    if distinct_locations:
        locations = distinct_by(locations, [location_key], locations.columns)
    b = locations.select(
        F.col(location_key).try_cast("bigint").alias("__location"),
        F.col("name").alias("location_name"),
        "street",
        "zip",
        "city",
        "region",
        F.col("cd").alias("country_code"),
        "phone",
        F.col("lat").alias("latitude"),
        F.col("lng").alias("longitude"),
        "website",
    )
    c = posts.select(
        F.col("profile_id").try_cast("bigint").alias("__owner"),
        "post_id",
        F.col("cts").alias("timestamp_post"),
        "post_type",
        F.col("description").alias("description_post"),
        F.col("numbr_likes").alias("number_likes"),
        "number_comments",
    )
    located = spread_join(a, b, "__place", "__location", "left", unique_right=distinct_locations)
    if posts_how == "inner":
        joined = located.join(c, located["profile_id"] == c["__owner"], "inner")
    else:
        joined = spread_join(materialise(located, "located"), c, "profile_id", "__owner", "left")
    if with_names:
        return joined.drop("__place", "__location", "__owner")
    return cast_columns(joined, JOINED_TYPES)


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_reg"))


def _ids(df: DataFrame, key: str, count: str) -> DataFrame:
    """How many rows each whole-number key has."""
    keyed = df.select(F.col(key).try_cast("bigint").alias("__id")).where("__id IS NOT NULL")
    return keyed.groupBy("__id").agg(F.count("*").alias(count))


def total_rows_from_sources(profiles: DataFrame, locations: DataFrame, posts: DataFrame) -> DataFrame:
    """The rows of :func:`join_sources`, from counts per key: none of its rows is built.

    A profile makes a row for each pair of its locations and posts, where one
    without any counts as having one.
    """
    owners = profiles.select("profile_id").distinct().select(F.col("profile_id").try_cast("bigint").alias("id"))
    counted = owners.groupBy("id").agg(F.count("*").alias("copies"))
    counted = lookup(counted, _ids(locations, "id", "places"), "id", "__id")
    counted = lookup(counted, _ids(posts, "profile_id", "written"), "id", "__id")
    one = F.lit(1)
    rows = F.col("copies") * F.coalesce("places", one) * F.coalesce("written", one)
    return counted.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("n_reg"))


def post_weights(profiles: DataFrame, locations: DataFrame) -> DataFrame:
    """(owner, weight): in how many rows of the joined table each post of a profile stands.

    A profile makes a row per location, where one without any counts as having one.
    """
    named = profiles.select(F.col("profile_id").try_cast("bigint").alias("owner"), "profile_id")
    counted = named.where("owner IS NOT NULL").groupBy("owner").agg(F.count_distinct("profile_id").alias("copies"))
    placed = counted.join(_ids(locations, "id", "places"), F.col("owner") == F.col("__id"), "left")
    return placed.select("owner", (F.col("copies") * F.coalesce("places", F.lit(1))).alias("weight"))


def odd_owners(profiles: DataFrame, locations: DataFrame, posts: DataFrame) -> DataFrame:
    """(owner, weight) of the owners whose posts do not stand in the joined table exactly once.

    Profiles that nobody knows have weight 0. Most posts belong to others, so
    this table is short beside the posts.
    """
    seen = posts.select(F.col("profile_id").try_cast("bigint").alias("__seen")).where("__seen IS NOT NULL").distinct()
    weighed = seen.join(post_weights(profiles, locations), F.col("__seen") == F.col("owner"), "left")
    odd = weighed.select(F.col("__seen").alias("owner"), F.coalesce("weight", F.lit(0)).alias("weight"))
    return odd.where("weight <> 1")


def _bit(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """One row with one array of ``FILTER_WORDS`` integers, whose bits say which keys may occur.

    Its size is fixed: with more keys than it can tell apart it lets more
    through, and what uses it only has more to do.
    """
    bits = keys.select(_bit(key).alias("bit"))
    words = bits.selectExpr("shiftright(bit, 6) AS at", "shiftleft(1L, cast(bit & 63 AS int)) AS mask")
    every = keys.sparkSession.range(FILTER_WORDS).selectExpr("id AS at", "0L AS mask")
    masks = words.unionByName(every).groupBy("at").agg(F.bit_or("mask").alias("mask"))
    return masks.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "mask"))), lambda word: word["mask"]).alias("bits"))


def may_hold(bits: DataFrame, key: str) -> Column:
    """Whether a key may be among those of :func:`key_filter`; true for all that are."""
    word = F.get(bits.scalar(), F.shiftright(_bit(key), 6).cast("int"))
    return F.getbit(word, (_bit(key) % 64).cast("int")) == 1


def weighted_keys(
    profiles: DataFrame,
    locations: DataFrame,
    posts: DataFrame,
    keys: dict[str, Column],
    wanted: Column | None = None,
    few: int = FEW_OWNERS,
) -> DataFrame:
    """(keys, weight): the ``keys`` of posts, whose weights add up to how often they occur in the joined table.

    Only owners of another weight than 1 change a count. Up to ``few`` of them
    are broadcast, and each post gets its weight where it is read. For more, posts
    are counted by the keys where they are read: those whose owner may be odd, as
    a filter of fixed size tells, per owner, so that their counts meet the
    weights; the others under a number that no owner joins with and that spreads
    them evenly. No text is shuffled in either case.
    """
    known = posts.withColumn("__owner", F.col("profile_id").try_cast("bigint")).where("__owner IS NOT NULL")
    odd = materialise(odd_owners(profiles, locations, posts), "odd-owners")
    named = [key.alias(name) for name, key in keys.items()]
    weight = F.coalesce("weight", F.lit(1)).alias("weight")
    if odd.limit(few + 1).count() <= few:
        met = known.join(F.broadcast(odd), F.col("__owner") == F.col("owner"), "left")
        met = met.where("weight IS NULL OR weight > 0").select(weight, *named)
        return met if wanted is None else met.where(wanted)
    unsure = may_hold(key_filter(odd, "owner"), "__owner")
    rows = known.select(F.when(unsure, F.col("__owner")).alias("__owner"), *named)
    rows = rows if wanted is None else rows.where(wanted)
    counted = rows.groupBy("__owner", *keys).agg(F.count("*").alias("n"))
    spread = F.when(F.col("__owner").isNull(), 1 + F.pmod(F.xxhash64(*keys), F.lit(1 << 20))).otherwise(F.lit(0))
    numbered = odd.withColumn("__odd", F.lit(0).cast("bigint"))
    met = counted.withColumn("__spread", spread).join(
        numbered, (F.col("__owner") == F.col("owner")) & (F.col("__spread") == F.col("__odd")), "left"
    )
    return met.select((F.col("n") * weight).alias("weight"), *keys).where("weight > 0")


def weighted_posts(profiles: DataFrame, locations: DataFrame, posts: DataFrame, slot: str = "hour") -> DataFrame:
    """(timestamp_post, weight) of the posts of known profiles, by slots of time.

    Posts are counted per profile and slot where they are read; their counts, not
    the posts, meet the weights. The widest slot that answers a question leaves
    the fewest counts: ``year``, ``hour of year`` (an hour of any day, moved to the first
    day of its year) or ``hour``.
    """
    dated = posts.where(F.col("cts").isNotNull())
    owned = dated.select(F.col("profile_id").try_cast("bigint").alias("__owner"), F.expr(SLOTS[slot]).alias("timestamp_post"))
    counted = owned.where("__owner IS NOT NULL").groupBy("__owner", "timestamp_post").agg(F.count("*").alias("n"))
    met = counted.join(post_weights(profiles, locations), F.col("__owner") == F.col("owner"))
    return met.select("timestamp_post", (F.col("n") * F.col("weight")).alias("weight"))


def weighted_words(
    profiles: DataFrame, locations: DataFrame, posts: DataFrame, hashtags_only: bool, few: int = FEW_OWNERS
) -> DataFrame:
    """(piece, weight) of the words of known profiles' posts."""
    text = F.col("description")
    pieces = {"piece": F.explode(words(text))}
    if not hashtags_only:
        return weighted_keys(profiles, locations, posts, pieces, few=few)
    tagged = posts.where(has_hashtag(text))
    return weighted_keys(profiles, locations, tagged, pieces, F.col("piece").startswith("#"), few)


def _rows(df: DataFrame) -> Column:
    """The rows of the joined table: those of ``df``, or the sum of its weights."""
    return F.sum("weight") if "weight" in df.columns else F.count("*")


def posts_per_year(joined: DataFrame) -> DataFrame:
    """Posts by year, over the joined table or :func:`weighted_posts`."""
    dated = joined.where(F.col("timestamp_post").isNotNull())
    counted = dated.groupBy(F.year("timestamp_post").alias("year_post")).agg(_rows(joined).alias("n_posts"))
    return sorted_down(counted, "year_post")


def posts_per_year_text(joined: DataFrame) -> DataFrame:
    dated = joined.where(F.col("timestamp_post").isNotNull())
    year = F.date_format("timestamp_post", "yyyy").alias("f_post_ts")
    return sorted_down(dated.groupBy(year).agg(_rows(joined).alias("n_reg")), "f_post_ts")


def peak_hours(joined: DataFrame) -> DataFrame:
    dated = joined.where(F.col("timestamp_post").isNotNull())
    keys = [F.year("timestamp_post").alias("year_post"), F.hour("timestamp_post").alias("hour_post")]
    return sorted_down(dated.groupBy(*keys).agg(_rows(joined).alias("n_reg")), "n_reg")


def peak_hours_in_month(joined: DataFrame, year: int = 2015, month: int = 12) -> DataFrame:
    """Posts per hour of one month.

    The month is written as a range of moments, which a Parquet scan can use
    to skip row groups; a test on ``year(…)`` could not.
    """
    start = f"{year:04d}-{month:02d}-01"
    after = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    moment = F.col("timestamp_post")
    wanted = joined.where((moment >= F.lit(start).cast("timestamp")) & (moment < F.lit(after).cast("timestamp")))
    keys = [
        F.year(moment).alias("year_post"),
        F.month(moment).alias("month_post"),
        F.hour(moment).alias("hour_post"),
    ]
    return sorted_down(wanted.groupBy(*keys).agg(_rows(joined).alias("n_reg")), "n_reg")


def top_pieces(weighted: DataFrame, name: str) -> DataFrame:
    """Uses per hashtag or word of :func:`weighted_words`."""
    return sorted_down(weighted.groupBy(F.col("piece").alias(name)).agg(F.sum("weight").alias("count")), "count")


def top_hashtags(posts: DataFrame, text: str = "description_post") -> DataFrame:
    """Uses per hashtag, a blank-separated word that begins with ``#``.

    Words become rows and are filtered and counted in the same stage, which
    generated code does faster than a filter inside the array.
    """
    pieces = posts.where(has_hashtag(F.col(text))).select(F.explode(words(F.col(text))).alias("hashtag"))
    tags = pieces.where(F.col("hashtag").startswith("#"))
    return sorted_down(tags.groupBy("hashtag").agg(F.count("*").alias("count")), "count")


def top_words(posts: DataFrame, text: str = "description_post") -> DataFrame:
    """Uses per blank-separated word; the empty text between two blanks is a word."""
    pieces = posts.select(F.explode(words(F.col(text))).alias("split_words"))
    return sorted_down(pieces.groupBy("split_words").agg(F.count("*").alias("count")), "count")


def visited_places(locations: DataFrame) -> DataFrame:
    known = locations.where(F.col("cd").isNotNull() & F.col("name").isNotNull())
    return sorted_down(known.groupBy("cd", "name").agg(F.count("*").alias("n_reg")), "n_reg")


def visited_cities(locations: DataFrame) -> DataFrame:
    known = locations.where(F.col("cd").isNotNull() & F.col("city").isNotNull())
    counted = known.groupBy(country_label(F.col("cd")).alias("country"), "city").agg(F.count("*").alias("n_reg"))
    return sorted_down(counted, "n_reg")


def _by_year(posts: DataFrame, *keys: Column | str):
    """Dated posts grouped by year and further keys."""
    return posts.where(F.col("cts").isNotNull()).groupBy(F.year("cts").alias("year_post"), *keys)


def types_per_year(posts: DataFrame) -> DataFrame:
    label = post_type_label(F.col("post_type")).alias("post_type")
    return sorted_down(_by_year(posts, label).agg(F.count("*").alias("n_reg")), "year_post", "n_reg")


def impact_per_type(posts: DataFrame) -> DataFrame:
    label = post_type_label(F.col("post_type")).alias("post_type")
    summed = _by_year(posts, label).agg(
        F.sum("numbr_likes").alias("number_likes"), F.sum("number_comments").alias("number_comments")
    )
    return sorted_down(summed, "year_post", "number_likes", "number_comments")


def posts_per_weekday(posts: DataFrame) -> DataFrame:
    day = F.date_format("cts", "EEEE").alias("name_day_of_week")
    return sorted_down(_by_year(posts, day).agg(F.count("*").alias("n_reg")), "year_post", "n_reg")


def mean_characters(posts: DataFrame, split_style: bool = False) -> DataFrame:
    """Mean length of a post's text per year; ``split_style`` as in ``character_count``."""
    mean = F.avg(character_count(F.col("description"), split_style)).cast("decimal(10,2)")
    return sorted_down(_by_year(posts).agg(mean.alias("avg_n_characters")), "year_post")


def _measured(posts: DataFrame, text: str, split_style: bool) -> DataFrame:
    """The posts with hashtags, their text replaced by what the impact question needs.

    ``tags`` and ``n_characters`` are counts; a SHA-256 digest stands in for the
    text where equal posts are grouped, so the text itself is never shuffled.
    """
    column = F.col(text)
    tagged = posts.where(has_hashtag(column))
    measures = {
        "tags": hashtag_count(column),
        "n_characters": character_count(column, split_style),
        "text_digest": F.unhex(F.sha2(column, 256)),
    }
    return tagged.withColumns(measures).drop(text)


def _impact(measured: DataFrame, tags: Column) -> DataFrame:
    post = [
        "timestamp_post",
        "profile_id",
        "following",
        "followers",
        "is_business_account",
        "post_type",
        "number_likes",
        "number_comments",
        "n_characters",
        "text_digest",
    ]
    # One test per column, so that each is made before the join it comes from.
    known = measured
    for name in ("profile_id", "number_likes", "number_comments", "followers"):
        known = known.where(F.col(name).isNotNull())
    per_post = known.groupBy(*post).agg(F.sum(tags).alias("n_hashtags"))
    ranged = per_post.groupBy(
        F.year("timestamp_post").alias("year"),
        range_label(F.col("followers"), FOLLOWER_RANGES).alias("followers"),
        "is_business_account",
        post_type_label(F.col("post_type")).alias("post_type"),
        range_label(F.col("n_characters"), CHARACTER_RANGES).alias("number_characters"),
        range_label(F.col("n_hashtags"), HASHTAG_RANGES).alias("number_hashtags"),
    ).agg(F.sum("number_likes").alias("total_likes"), F.sum("number_comments").alias("total_comments"))
    return sorted_down(ranged, "year", "total_likes", "total_comments")


def profile_impact(joined: DataFrame, split_style: bool = False) -> DataFrame:
    """Likes and comments by year and ranges of followers, characters and hashtags.

    Reads a stored joined table. Posts without a hashtag or with unknown counts
    are left out. Rows that agree in all the columns grouped by are one post:
    likes and comments count once, hashtags add up.
    """
    return _impact(_measured(joined, "description_post", split_style), F.col("tags"))


def profile_impact_from_sources(
    profiles: DataFrame, locations: DataFrame, posts: DataFrame, split_style: bool = False
) -> DataFrame:
    """:func:`profile_impact` without building the joined table first.

    Each post meets its profile as a few numbers and a digest, once. Joining the
    locations would only repeat its rows, so the number of repeats is counted
    per location id and multiplied in.
    """
    repeats = (
        locations.select(F.col("id").try_cast("bigint").alias("place"))
        .groupBy("place")
        .agg(F.count("*").alias("repeats"))
    )
    chosen = cast_columns(
        distinct_by(profiles, ["profile_id"], profiles.columns),
        {name: JOINED_TYPES[name] for name in ("profile_id", "following", "followers", "is_business_account")},
    )
    owners = lookup(chosen, repeats, "profile_id", "place")
    renamed = posts.select(
        F.col("profile_id").try_cast("bigint").alias("owner"),
        F.col("cts").alias("timestamp_post"),
        "post_type",
        F.col("description").alias("description_post"),
        F.col("numbr_likes").alias("number_likes"),
        "number_comments",
    )
    measured = _measured(renamed, "description_post", split_style)
    owned = measured.join(owners, F.col("owner") == F.col("profile_id"))
    return _impact(owned, F.col("tags") * F.coalesce("repeats", F.lit(1)))
