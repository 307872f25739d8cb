"""Scalar functions: numbers, text, dates, structs, arrays and nulls."""

from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.functions.dates import Clock, age_in_years, parse_date
from corvane.functions.text import hashtags
from corvane.plans.movies import with_release_date

AS_OF = "2024-01-01"


@query(
    "fn_math",
    """SELECT Title, round((Rotten_Tomatoes_Rating / 10.0::DOUBLE + IMDB_Rating) / 2.0::DOUBLE, 4) AS mean_rating,
         US_Gross - Worldwide_Gross AS abroad, round(US_Gross * 0.5::DOUBLE, 2) AS half FROM movies""",
    "movies",
)
def arithmetic(v: Views):
    mean = (F.col("Rotten_Tomatoes_Rating") / 10 + F.col("IMDB_Rating")) / 2
    return v.movies().select(
        "Title",
        F.round(mean, 4).alias("mean_rating"),
        (F.col("US_Gross") - F.col("Worldwide_Gross")).alias("abroad"),
        F.round(F.col("US_Gross") * 0.5, 2).alias("half"),
    )


@query(
    "fn_split",
    """SELECT post_id, CAST(len(string_split(description, ' ')) AS INTEGER) AS n_words,
         string_split(description, ' ')[1] AS first_word, CAST(length(description) AS INTEGER) AS n_characters
       FROM posts""",
    "posts",
)
def pieces(v: Views):
    text = F.col("description")
    return v.posts().select(
        "post_id",
        F.size(F.split(text, " ")).alias("n_words"),
        F.get(F.split(text, " "), 0).alias("first_word"),
        F.char_length(text).alias("n_characters"),
    )


@query(
    "fn_case",
    """SELECT Name, array_to_string(list_transform(string_split(Name, ' '),
         lambda w: upper(w[1]) || lower(w[2:])), ' ') AS capital, lower(Name) AS low, upper(Name) AS high FROM cars""",
    "cars",
)
def letter_case(v: Views):
    return v.cars().select(
        "Name", F.initcap("Name").alias("capital"), F.lower("Name").alias("low"), F.upper("Name").alias("high")
    )


@query(
    "fn_regexp",
    """SELECT Name, regexp_extract(Name, 'toyota|ford', 0) AS maker,
         regexp_replace(Name, 'toyota|ford', 'maker', 'g') AS replaced FROM cars""",
    "cars",
)
def patterns(v: Views):
    maker = "toyota|ford"
    return v.cars().select(
        "Name",
        F.regexp_extract("Name", maker, 0).alias("maker"),
        F.regexp_replace("Name", maker, "maker").alias("replaced"),
    )


@query(
    "fn_date_parts",
    """SELECT post_id, CAST(year(cts) AS INTEGER) AS y, CAST(month(cts) AS INTEGER) AS m,
         CAST(hour(cts) AS INTEGER) AS h, CAST(dayofweek(cts) + 1 AS INTEGER) AS d FROM posts""",
    "posts",
)
def parts(v: Views):
    return v.posts().select(
        "post_id",
        F.year("cts").alias("y"),
        F.month("cts").alias("m"),
        F.hour("cts").alias("h"),
        F.dayofweek("cts").alias("d"),
    )


@query(
    "fn_date_format",
    "SELECT post_id, strftime(cts, '%Y') AS y, strftime(cts, '%A') AS day_name FROM posts",
    "posts",
)
def formats(v: Views):
    return v.posts().select(
        "post_id", F.date_format("cts", "yyyy").alias("y"), F.date_format("cts", "EEEE").alias("day_name")
    )


@query(
    "fn_to_date",
    "SELECT symbol, date, strftime(try_strptime(date, '%b %d %Y'), '%Y-%m-%d') AS day, price FROM stocks",
    "stocks",
)
def text_to_date(v: Views):
    return v.stocks().select("symbol", "date", F.try_to_date("date", "MMM dd yyyy").cast("string").alias("day"), "price")


_RELEASED = """coalesce(try_strptime(Release_Date, '%d-%b-%y'), try_strptime(Release_Date, '%Y-%m-%d'),
                 try_strptime(Release_Date, '%b %d %Y'))"""


@query(
    "fn_date_diff",
    f"""SELECT Title, round(date_diff('day', CAST({_RELEASED} AS DATE), DATE '{AS_OF}') / 365.0::DOUBLE, 4) AS age,
          strftime({_RELEASED} + INTERVAL 7 DAY, '%Y-%m-%d') AS week_after,
          strftime({_RELEASED} - INTERVAL 7 DAY, '%Y-%m-%d') AS week_before FROM movies""",
    "movies",
)
def ages(v: Views):
    released = F.col("Actual_Release")
    return with_release_date(v.movies(), AS_OF).select(
        "Title",
        F.round(age_in_years(released, F.lit(AS_OF).cast("date")), 4).alias("age"),
        F.date_add(released, 7).cast("string").alias("week_after"),
        F.date_sub(released, 7).cast("string").alias("week_before"),
    )


@query(
    "fn_date_multi",
    """SELECT Title, Release_Date, strftime(coalesce(try_strptime(Release_Date, '%Y-%m-%d'),
         try_strptime(Release_Date, '%b %d %Y')), '%Y-%m-%d') AS day FROM movies""",
    "movies",
)
def several_spellings(v: Views):
    day = parse_date(F.col("Release_Date"), ["yyyy-MM-dd", "MMM d yyyy"])
    return v.movies().select("Title", "Release_Date", day.cast("string").alias("day"))


@query(
    "fn_struct",
    "SELECT Title, US_Gross AS US_Profit, Worldwide_Gross AS World_Profit FROM movies",
    "movies",
)
def structs(v: Views):
    by_column = v.movies().select("Title", F.struct("US_Gross", "Worldwide_Gross").alias("Profit"))
    by_text = by_column.selectExpr("Title", "Profit", "(Profit.US_Gross, Profit.Worldwide_Gross) AS Pair")
    return by_text.select(
        "Title",
        F.col("Profit").getField("US_Gross").alias("US_Profit"),
        F.expr("Pair.Worldwide_Gross").alias("World_Profit"),
    )


@query(
    "fn_array",
    """SELECT Title, w[1] AS first_word, w[9] AS ninth_word, CAST(len(w) AS INTEGER) AS n_words,
         list_contains(w, 'small') AS has_small
       FROM (SELECT Title, regexp_split_to_array(Title, ' |,') AS w FROM movies)""",
    "movies",
)
def arrays(v: Views):
    title_words = v.movies().select("Title", F.split("Title", " |,").alias("w"))
    return title_words.select(
        "Title",
        F.get("w", F.lit(0)).alias("first_word"),
        F.get("w", F.lit(8)).alias("ninth_word"),
        F.size("w").alias("n_words"),
        F.array_contains("w", "small").alias("has_small"),
    )


@query(
    "fn_array_filter",
    """SELECT post_id, array_to_string(list_filter(string_split(description, ' '), lambda w: starts_with(w, '#')), ' ')
         AS hashtags FROM posts""",
    "posts",
)
def filtered_arrays(v: Views):
    return v.posts().select("post_id", F.array_join(hashtags(F.col("description")), " ").alias("hashtags"))


@query(
    "null_functions",
    """SELECT Title, coalesce(Rotten_Tomatoes_Rating, IMDB_Rating * 10) AS first_known,
         coalesce(Rotten_Tomatoes_Rating, IMDB_Rating * 10) AS ifnull_value,
         coalesce(Rotten_Tomatoes_Rating, IMDB_Rating * 10) AS nvl_value,
         CAST(nullif(Rotten_Tomatoes_Rating, IMDB_Rating * 4) AS BIGINT) AS nullif_value,
         CASE WHEN Rotten_Tomatoes_Rating IS NOT NULL THEN IMDB_Rating * 10 ELSE 0.0 END AS nvl2_value FROM movies""",
    "movies",
)
def null_functions(v: Views):
    return v.movies().selectExpr(
        "Title",
        "coalesce(Rotten_Tomatoes_Rating, IMDB_Rating * 10) AS first_known",
        "ifnull(Rotten_Tomatoes_Rating, IMDB_Rating * 10) AS ifnull_value",
        "nvl(Rotten_Tomatoes_Rating, IMDB_Rating * 10) AS nvl_value",
        "nullif(Rotten_Tomatoes_Rating, IMDB_Rating * 4) AS nullif_value",
        "nvl2(Rotten_Tomatoes_Rating, IMDB_Rating * 10, 0.0D) AS nvl2_value",
    )


@query(
    "null_drop_fill",
    """SELECT Title, coalesce(IMDB_Rating, 0) AS IMDB_Rating, coalesce(Rotten_Tomatoes_Rating, 10)
         AS Rotten_Tomatoes_Rating, coalesce(Director, 'Unknown') AS Director, FALSE AS complete FROM movies
       UNION ALL
       SELECT Title, IMDB_Rating, Rotten_Tomatoes_Rating, Director, TRUE FROM movies
       WHERE IMDB_Rating IS NOT NULL AND Rotten_Tomatoes_Rating IS NOT NULL AND Director IS NOT NULL""",
    "movies",
)
def fill_and_drop(v: Views):
    movies = v.movies().select("Title", "IMDB_Rating", "Rotten_Tomatoes_Rating", "Director")
    filled = movies.na.fill(0, ["IMDB_Rating"]).na.fill({"Rotten_Tomatoes_Rating": 10, "Director": "Unknown"})
    return filled.withColumn("complete", F.lit(False)).union(movies.na.drop().withColumn("complete", F.lit(True)))


@query(
    "fn_clock",
    """SELECT s_suppkey, '2024-02-29' AS today, '2024-02-29 23:30:15' AS now FROM supplier""",
)
def one_clock_for_a_job(v: Views):
    stamped = Clock.at("2024-03-01T00:30:15+01:00").stamped(v.table("supplier").select("s_suppkey"))
    now = F.date_format("current_timestamp", "yyyy-MM-dd HH:mm:ss").alias("now")
    return stamped.select("s_suppkey", F.col("current_date").cast("string").alias("today"), now)
