"""Schema of the wide player-record table, in its two spellings."""

from __future__ import annotations

from pyspark.sql import types as T

from rowfold.operators.projection import snake_name

# Display name and type of every field, in table order.
FIELDS = [
    ("Player Name", "string"),
    ("Country", "string"),
    ("Years Active", "int"),
    ("Role", "string"),
    ("Player Date of Birth", "string"),
    ("Age", "int"),
    ("Best Format", "string"),
    ("Batting Style", "string"),
    ("Bowling Style", "string"),
    ("Matches", "int"),
    ("Innings", "int"),
    ("Not Outs", "int"),
    ("Runs", "int"),
    ("High Score", "int"),
    ("Batting Average", "double"),
    ("Batting Strike Rate", "double"),
    ("Ducks", "int"),
    ("Fifties", "int"),
    ("Hundreds", "int"),
    ("Double Hundreds", "int"),
    ("Balls Faced", "int"),
    ("Sixes Hit", "int"),
    ("Fours Hit", "int"),
    ("Boundary Percentage", "double"),
    ("Batting Impact in High-Pressure Situations", "int"),
    ("Balls Per Dismissal", "int"),
    ("Bowling Wickets", "int"),
    ("Maidens", "int"),
    ("Bowling Average", "double"),
    ("Bowling Economy Rate", "double"),
    ("Bowling Strike Rate", "double"),
    ("Overs Bowled", "int"),
    ("Total Balls Bowled", "int"),
    ("Five-Wicket Hauls", "int"),
    ("Ten-Wicket Hauls", "int"),
    ("Best Bowling Wickets", "int"),
    ("Best Bowling Runs", "int"),
    ("Yorkers Bowled", "int"),
    ("Dot Balls", "int"),
    ("Total Runs Conceded", "int"),
    ("Catches Taken", "int"),
    ("Run Outs", "int"),
    ("Wicketkeeping Dismissals", "int"),
    ("Fielding Dismissals", "int"),
    ("Boundary Stops", "int"),
    ("Man of the Match Awards", "int"),
    ("Matches Won Contribution (%)", "int"),
    ("Win Percentage as Captain", "int"),
    ("Key Strength", "string"),
    ("Impact Category", "int"),
]
# The one field whose short name follows no rule, and the two that streams widen.
SHORT_NAMES = {"Batting Impact in High-Pressure Situations": "batting_impact"}
WIDENED = ["matches_won_contribution", "win_percentage_as_captain"]


def short_name(display: str) -> str:
    return SHORT_NAMES.get(display, snake_name(display))


def player_schema(display_names: bool = False, widened: bool = False, nullable: bool = True) -> T.StructType:
    """Schema with short or display names; ``widened`` is the form that streams carry."""
    fields = []
    for display, kind in FIELDS:
        short = short_name(display)
        if widened and short in WIDENED:
            kind = "double"
        data_type = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}[kind]
        fields.append(T.StructField(display if display_names else short, data_type, nullable))
    return T.StructType(fields)
