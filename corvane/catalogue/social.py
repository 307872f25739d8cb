"""Questions about posts, profiles and locations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.catalogue.filters import ranges_sql
from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.functions.labels import CHARACTER_RANGES, FOLLOWER_RANGES, HASHTAG_RANGES
from corvane.plans import social

TYPE_SQL = "CASE post_type WHEN 1 THEN 'photo' WHEN 2 THEN 'video' WHEN 3 THEN 'multy' END"
YEAR_SQL = "CAST(year(cts) AS INTEGER)"
JOINED = "profiles locations posts joined"


def _plain(joined: DataFrame) -> DataFrame:
    """Moments as text and decimals as doubles, which every engine prints alike."""
    plain = {name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in ("timestamp_location", "timestamp_post")}
    plain |= {name: F.col(name).cast("double") for name in ("latitude", "longitude")}
    return joined.withColumns(plain)


_PLAIN_SQL = """SELECT * REPLACE (strftime(timestamp_location, '%Y-%m-%d %H:%M:%S') AS timestamp_location,
    strftime(timestamp_post, '%Y-%m-%d %H:%M:%S') AS timestamp_post, CAST(latitude AS DOUBLE) AS latitude,
    CAST(longitude AS DOUBLE) AS longitude)"""


@query("social_joined", f"{_PLAIN_SQL} FROM joined", JOINED)
def joined_table(v: Views):
    return _plain(v.joined())


@query(
    "social_joined_inner",
    """SELECT CAST(a.profile_id AS BIGINT) AS profile_id, a.profile_name, a.firstname_lastname, a.description, a.following,
         a.followers, a.url, a.cts AS timestamp_location, a.is_business_account, b.name AS location_name, b.street,
         b.zip, b.city, b.region, b.cd AS country_code, b.phone, b.lat AS latitude, b.lng AS longitude, b.website,
         c.post_id, strftime(c.cts, '%Y-%m-%d %H:%M:%S') AS timestamp_post, c.post_type,
         c.description AS description_post, c.numbr_likes AS number_likes, c.number_comments
       FROM profiles a
       LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY id, name, street, zip, city, region,
           cd, phone, lat, lng, website) AS place FROM locations) WHERE place = 1) b ON a.profile_id = b.id
       JOIN posts c ON CAST(a.profile_id AS BIGINT) = c.profile_id""",
    "profiles locations posts",
)
def joined_table_inner(v: Views):
    sources = v.profiles(), v.locations(), v.posts()
    joined = social.join_sources(*sources, "inner", distinct_locations=True, with_names=True)
    return joined.withColumn("timestamp_post", F.date_format("timestamp_post", "yyyy-MM-dd HH:mm:ss"))


@query("social_total_rows", "SELECT count(*) AS n_reg FROM joined", JOINED)
def total(v: Views):
    return social.total_rows_from_sources(v.profiles(), v.locations(), v.posts())


def _dated(v: Views, slot: str) -> DataFrame:
    return social.weighted_posts(v.profiles(), v.locations(), v.posts(), slot)


@query(
    "social_posts_per_year",
    """SELECT CAST(year(timestamp_post) AS INTEGER) AS year_post, count(*) AS n_posts FROM joined
       WHERE timestamp_post IS NOT NULL GROUP BY 1""",
    JOINED,
)
def per_year(v: Views):
    return social.posts_per_year(_dated(v, "year"))


@query(
    "social_posts_per_year_text",
    """SELECT strftime(timestamp_post, '%Y') AS f_post_ts, count(*) AS n_reg FROM joined
       WHERE timestamp_post IS NOT NULL GROUP BY 1""",
    JOINED,
)
def per_year_text(v: Views):
    return social.posts_per_year_text(_dated(v, "year"))


@query(
    "social_peak_hours",
    """SELECT CAST(year(timestamp_post) AS INTEGER) AS year_post, CAST(hour(timestamp_post) AS INTEGER) AS hour_post,
         count(*) AS n_reg FROM joined WHERE timestamp_post IS NOT NULL GROUP BY 1, 2""",
    JOINED,
)
def hours(v: Views):
    return social.peak_hours(_dated(v, "hour of year"))


@query(
    "social_peak_hours_month",
    """SELECT CAST(year(timestamp_post) AS INTEGER) AS year_post, CAST(month(timestamp_post) AS INTEGER) AS month_post,
         CAST(hour(timestamp_post) AS INTEGER) AS hour_post, count(*) AS n_reg FROM joined
       WHERE year(timestamp_post) = 1996 AND month(timestamp_post) = 12 GROUP BY 1, 2, 3""",
    JOINED,
)
def hours_in_month(v: Views):
    return social.peak_hours_in_month(_dated(v, "hour"), 1996, 12)


@query(
    "hashtag_top",
    """SELECT hashtag, count(*) AS count
       FROM (SELECT unnest(string_split(description_post, ' ')) AS hashtag FROM joined)
       WHERE hashtag LIKE '#%' GROUP BY hashtag""",
    JOINED,
)
def hashtags(v: Views):
    weighted = social.weighted_words(v.profiles(), v.locations(), v.posts(), hashtags_only=True)
    return social.top_pieces(weighted, "hashtag")


@query(
    "word_top",
    """SELECT split_words, count(*) AS count
       FROM (SELECT unnest(string_split(description_post, ' ')) AS split_words FROM joined) GROUP BY split_words""",
    JOINED,
)
def words(v: Views):
    weighted = social.weighted_words(v.profiles(), v.locations(), v.posts(), hashtags_only=False)
    return social.top_pieces(weighted, "split_words")


@query(
    "document_words",
    """SELECT split_words, count(*) AS count
       FROM (SELECT unnest(string_split(text, ' ')) AS split_words FROM documents) GROUP BY split_words""",
)
def words_of_documents(v: Views):
    return social.top_words(v.table("documents"), "text")


@query(
    "social_places",
    """SELECT cd, name, count(*) AS n_reg FROM locations WHERE cd IS NOT NULL AND name IS NOT NULL
       GROUP BY cd, name""",
    "locations",
)
def places(v: Views):
    return social.visited_places(v.locations())


@query(
    "social_cities",
    """SELECT CASE WHEN cd = 'US' THEN 'United States' ELSE cd END AS country, city, count(*) AS n_reg
       FROM locations WHERE cd IS NOT NULL AND city IS NOT NULL GROUP BY 1, 2""",
    "locations",
)
def cities(v: Views):
    return social.visited_cities(v.locations())


@query(
    "social_type_per_year",
    f"""SELECT {YEAR_SQL} AS year_post, {TYPE_SQL} AS post_type, count(*) AS n_reg FROM posts
        WHERE cts IS NOT NULL GROUP BY 1, 2""",
    "posts",
)
def types(v: Views):
    return social.types_per_year(v.posts())


IMPACT_SQL = f"""SELECT {YEAR_SQL} AS year_post, {TYPE_SQL} AS post_type,
    CAST(sum(numbr_likes) AS BIGINT) AS number_likes, CAST(sum(number_comments) AS BIGINT) AS number_comments
    FROM posts WHERE cts IS NOT NULL GROUP BY 1, 2"""


@query("social_impact", IMPACT_SQL, "posts")
def impact(v: Views):
    return social.impact_per_type(v.posts())


WEEKDAY_SQL = f"""SELECT {YEAR_SQL} AS year_post, strftime(cts, '%A') AS name_day_of_week, count(*) AS n_reg
    FROM posts WHERE cts IS NOT NULL GROUP BY 1, 2"""


@query("social_weekday", WEEKDAY_SQL, "posts")
def weekdays(v: Views):
    return social.posts_per_weekday(v.posts())


def _mean_sql(count: str) -> str:
    return f"""SELECT {YEAR_SQL} AS year_post, round(avg({count}), 2) AS avg_n_characters FROM posts
        WHERE cts IS NOT NULL GROUP BY 1"""


@query("social_avg_chars", _mean_sql("length(description)"), "posts")
def characters(v: Views):
    return social.mean_characters(v.posts()).withColumn("avg_n_characters", F.col("avg_n_characters").cast("double"))


@query("social_avg_chars_split_style", _mean_sql("coalesce(length(description) + 1, -1)"), "posts")
def characters_split_style(v: Views):
    means = social.mean_characters(v.posts(), split_style=True)
    return means.withColumn("avg_n_characters", F.col("avg_n_characters").cast("double"))


PROFILE_IMPACT_SQL = f"""
    SELECT CAST(year(timestamp_post) AS INTEGER) AS year, {ranges_sql("followers", FOLLOWER_RANGES)} AS followers,
      is_business_account, {TYPE_SQL} AS post_type, {ranges_sql("n_characters", CHARACTER_RANGES)} AS number_characters,
      {ranges_sql("n_hashtags", HASHTAG_RANGES)} AS number_hashtags, CAST(sum(number_likes) AS BIGINT) AS total_likes,
      CAST(sum(number_comments) AS BIGINT) AS total_comments
    FROM (SELECT timestamp_post, profile_id, following, followers, is_business_account, description_post, post_type,
            number_likes, number_comments, length(description_post) AS n_characters, count(*) AS n_hashtags
          FROM (SELECT *, unnest(string_split(description_post, ' ')) AS hashtag FROM joined)
          WHERE hashtag LIKE '#%' AND profile_id IS NOT NULL AND number_likes IS NOT NULL
            AND number_comments IS NOT NULL AND followers IS NOT NULL
          GROUP BY ALL)
    GROUP BY ALL"""


@query("social_profile_impact", PROFILE_IMPACT_SQL, JOINED)
def profile_impact(v: Views):
    return social.profile_impact_from_sources(v.profiles(), v.locations(), v.posts())


@query("social_profile_impact_joined", PROFILE_IMPACT_SQL, JOINED)
def profile_impact_of_the_joined_table(v: Views):
    return social.profile_impact(v.joined())
