"""Projections."""

from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.functions.casting import cast_columns


@query(
    "proj_select",
    "SELECT Name, Acceleration, Weight_in_lbs, Year, Horsepower, Origin FROM cars",
    "cars",
)
def select_by_many_spellings(v: Views):
    cars = v.cars().select("*")
    return cars.select(
        cars["Name"], F.col("Acceleration"), F.column("Weight_in_lbs"), cars.Year, "Horsepower", F.expr("Origin")
    )


@query(
    "proj_select_expr",
    """SELECT Name, Weight_in_lbs, round(Weight_in_lbs / 2.2::DOUBLE, 4) AS Weight_in_kg,
         round(Weight_in_lbs / 2.2::DOUBLE, 4) AS Weight_in_kg_2 FROM cars""",
    "cars",
)
def expressions_as_columns_and_text(v: Views):
    kg = (F.col("Weight_in_lbs") / 2.2).alias("kg")
    return (
        v.cars()
        .select("Name", "Weight_in_lbs", kg, F.expr("Weight_in_lbs / 2.2D").alias("kg_2"))
        .selectExpr("Name", "Weight_in_lbs", "round(kg, 4) AS Weight_in_kg", "round(kg_2, 4) AS Weight_in_kg_2")
    )


@query(
    "proj_with_column",
    "SELECT Title, US_Gross, Worldwide_Gross, US_Gross + Worldwide_Gross AS Total_Gross FROM movies",
    "movies",
)
def add_a_column(v: Views):
    movies = v.movies().select("Title", "US_Gross", "Worldwide_Gross")
    return movies.withColumn("Total_Gross", F.col("US_Gross") + F.col("Worldwide_Gross"))


@query(
    "proj_rename_drop",
    """SELECT Name, Miles_per_Gallon, Horsepower, Weight_in_lbs AS "Weight in pounds", Acceleration, Year, Origin
       FROM cars""",
    "cars",
)
def rename_and_drop(v: Views):
    renamed = v.cars().withColumnRenamed("Weight_in_lbs", "Weight in pounds")
    return renamed.drop("Cylinders", "Displacement", "not_there").selectExpr(
        "Name", "Miles_per_Gallon", "Horsepower", "`Weight in pounds`", "Acceleration", "Year", "Origin"
    )


@query("proj_literal", "SELECT Title, 1990 AS first_year FROM movies", "movies")
def add_a_constant(v: Views):
    return v.movies().select("Title", F.lit(1990).alias("first_year"))


@query(
    "proj_cast",
    """SELECT TRY_CAST(id AS BIGINT) AS id, name, TRY_CAST(zip AS INTEGER) AS zip,
         CAST(TRY_CAST(lat AS DECIMAL(8,6)) AS DOUBLE) AS lat, CAST(TRY_CAST(lng AS DECIMAL(9,6)) AS DOUBLE) AS lng,
         TRY_CAST(phone AS BIGINT) AS phone FROM locations""",
    "locations",
)
def cast_text_columns(v: Views):
    types = {
        "id": "bigint",
        "name": "string",
        "zip": "int",
        "lat": "decimal(8,6)",
        "lng": "decimal(9,6)",
        "phone": "bigint",
    }
    typed = cast_columns(v.locations(), types)
    return typed.withColumns({name: F.col(name).cast("double") for name in ("lat", "lng")})
