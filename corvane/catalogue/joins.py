"""Joins."""

from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.operators.joins import membership_full_join, membership_join, pair_join, spread_join
from corvane.plans import staff


def _players(v: Views):
    return v.players().drop("guitars")


def _join_sql(how: str, columns: str = "id, name, band, bandId, bandName, town") -> str:
    return f"SELECT {columns} FROM players {how} JOIN bands ON band = bandId"


@query("join_inner", _join_sql("INNER"), "players bands")
def inner(v: Views):
    return _players(v).join(v.bands(), F.col("band") == F.col("bandId"), "inner")


@query("join_left", _join_sql("LEFT"), "players bands")
def left_outer(v: Views):
    return _players(v).join(v.bands(), F.col("band") == F.col("bandId"), "left")


@query("join_right", _join_sql("RIGHT"), "players bands")
def right_outer(v: Views):
    return spread_join(_players(v), v.bands(), "band", "bandId", "right", unique_right=True)


@query("join_full", _join_sql("FULL"), "players bands")
def full_outer(v: Views):
    return spread_join(_players(v), v.bands(), "band", "bandId", "full", unique_right=True)


@query("join_semi", _join_sql("SEMI", "id, name, band"), "players bands")
def left_semi(v: Views):
    return _players(v).join(v.bands(), F.col("band") == F.col("bandId"), "left_semi")


@query("join_anti", "SELECT emp_no FROM employees WHERE emp_no NOT IN (SELECT emp_no FROM dept_manager)",
       "employees dept_manager")
def left_anti(v: Views):
    return staff.never_managers(v.employees(), v.dept_manager()).select("emp_no")


@query(
    "join_using",
    """SELECT band, id, name, bandName, town
       FROM players JOIN (SELECT bandId AS band, bandName, town FROM bands) USING (band)""",
    "players bands",
)
def shared_key_name(v: Views):
    return _players(v).join(v.bands().withColumnRenamed("bandId", "band"), "band")


@query(
    "join_drop_dup",
    "SELECT p.id, p.name, p.band, b.bandName, b.town FROM players p JOIN bands b ON p.band = b.bandId",
    "players bands",
)
def drop_one_of_two_equal_names(v: Views):
    players, bands = _players(v), v.bands().withColumnRenamed("bandId", "id")
    return players.join(bands, players["band"] == bands["id"]).drop(bands["id"])


@query(
    "join_array_contains",
    """SELECT id, name, band, guitarId, make, model, guitarType
       FROM players JOIN guitars ON list_contains(players.guitars, guitarId)""",
    "players guitars",
)
def membership(v: Views):
    return membership_join(v.players(), v.guitars(), "guitars", "guitarId").drop("guitars")


@query(
    "join_array_contains_full",
    """SELECT id AS player, name, guitarId AS guitar, model
       FROM players FULL JOIN (SELECT guitarId, model FROM guitars) g ON list_contains(players.guitars, g.guitarId)""",
    "players guitars",
)
def membership_full(v: Views):
    pairs = membership_full_join(v.players(), v.guitars(), "guitars", "id", "guitarId")
    return pairs.select(
        F.col("left.id").alias("player"),
        F.col("left.name").alias("name"),
        F.col("right.guitarId").alias("guitar"),
        F.col("right.model").alias("model"),
    )


@query(
    "join_with_struct",
    """SELECT id, bandId, bandName, id IS NULL AS no_player, bandId IS NULL AS no_band
       FROM players FULL JOIN bands ON band = bandId""",
    "players bands",
)
def pairs_of_structs(v: Views):
    pairs = pair_join(_players(v), v.bands(), "band", "bandId", "full", unique_right=True)
    return pairs.select(
        "left.id",
        "right.bandId",
        "right.bandName",
        F.col("left").isNull().alias("no_player"),
        F.col("right").isNull().alias("no_band"),
    )


@query(
    "join_with_inner",
    "SELECT id, name, bandId, bandName FROM players JOIN bands ON band = bandId",
    "players bands",
)
def matched_pairs_of_structs(v: Views):
    pairs = pair_join(_players(v), v.bands(), "band", "bandId")
    return pairs.select("left.id", "left.name", "right.bandId", "right.bandName")
