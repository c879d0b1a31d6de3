"""Variable dictionary: which raw variable each module carries in which cycles, and its canonical name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.columns import cycle_year, present
from tabprep.sizing import local_table

ID_COLUMN = "SEQN"
DEFAULT_YEAR = 2020

# Public survey codes. (module, raw variable, pipeline name, first year, last year)
VARIABLES = [
    ("DEMO", "RIDAGEYR", "RIDAGEYR", None, None),
    ("DEMO", "RIAGENDR", "RIAGENDR", None, None),
    ("DEMO", "RIDRETH1", "RIDRETH1", None, None),
    ("DEMO", "INDFMPIR", "INDFMPIR", None, None),
    ("BMX", "BMXBMI", "BMXBMI", None, None),
    ("BMX", "BMXWAIST", "BMXWAIST", None, None),
    ("BMX", "BMXWT", "BMXWT", None, None),
    ("BMX", "BMXHT", "BMXHT", None, None),
    ("BPQ", "BPQ020", "BPQ020", None, None),
    ("HDL", "LBDHDD", "LBDHDD", None, None),
    ("TCHOL", "LBXTC", "LBXTC", None, None),
    ("BIOPRO", "LBXSCR", "LBXSCR", None, None),
    ("MCQ", "MCQ160L", "MCQ160L", None, None),
    ("MCQ", "MCQ160E", "MCQ160E", None, None),
    ("SMQ", "SMQ020", "SMQ020", None, None),
    ("ALQ", "ALQ101", "ALQ101", None, None),
    ("GHB", "LBXGH", "LBXGH", None, None),
    ("TRIGLY", "LBXTR", "TRIGLY", None, 2020),
    ("TRIGLY", "LBXTLG", "TRIGLY", 2021, None),
    ("SLQ", "SLD010H", "SLQ", None, 2014),
    ("SLQ", "SLD012", "SLQ", 2015, None),
    ("BPX", "BPXSY1", "BPX_SYS", None, 2016),
    ("BPX", "BPXDI1", "BPX_DIA", None, 2016),
    ("BPX", "BPXOSY1", "BPX_SYS", 2017, None),
    ("BPX", "BPXODI1", "BPX_DIA", 2017, None),
]

# Canonical column -> raw names that carry it, oldest first.
ALIASES = {
    "TRIGLY": ["LBXTR", "LBXTLG", "LBXTGL"],
    "SLQ": ["SLD010H", "SLD012"],
    "BPX_SYS": ["BPXSY1", "BPXOSY1"],
    "BPX_DIA": ["BPXDI1", "BPXODI1"],
}

# Raw name -> readable name.
READABLE = {
    "SEQN": "subject_id",
    "RIDAGEYR": "age_years",
    "RIAGENDR": "gender",
    "RIDRETH1": "ethnicity",
    "INDFMPIR": "income_poverty_ratio",
    "BMXBMI": "bmi",
    "BMXHT": "height_cm",
    "BMXWAIST": "waist_cm",
    "BMXWT": "weight_kg",
    "BPQ020": "hypertension",
    "LBDHDD": "hdl_cholesterol",
    "LBXTC": "total_cholesterol",
    "LBXGH": "glucose_value",
    "LBXSCR": "creatinine",
    "MCQ160E": "heart_disease",
    "MCQ160L": "liver_disease",
    "SMQ020": "smoker",
}

# Readable names for tables whose cycle-dependent variables kept their raw codes.
READABLE_ALIASES = {
    "triglycerides": ["LBXTR", "LBXTLG", "LBXTGL"],
    "sleep_hours": ["SLD010H", "SLD012"],
    "systolic_bp": ["BPXSY1", "BPXOSY1"],
    "diastolic_bp": ["BPXDI1", "BPXODI1"],
}

# Collection cycles and module codes, in order.
CYCLES = ["2011-2012", "2013-2014", "2015-2016", "2017-2020", "2021-2023"]
MODULES = ["DEMO", "BMX", "BPX", "BPQ", "TRIGLY", "HDL", "TCHOL", "BIOPRO", "MCQ", "SMQ", "SLQ", "GHB"]

SCHEMA = "module string, variable string, canonical string, year_from int, year_to int"


def dictionary_table(spark: SparkSession, rows: Sequence[tuple] = tuple(VARIABLES)) -> DataFrame:
    return local_table(spark, rows, SCHEMA)


def start_year(cycle: str) -> int:
    head = cycle.split("-")[0].strip()
    return int(head) if head.lstrip("+-").isdigit() else DEFAULT_YEAR


def variables_for_cycle(cycle: str, rows: Sequence[tuple] = tuple(VARIABLES)) -> dict[str, list[str]]:
    """P1 on the driver: module -> raw variables valid in the cycle."""
    year = start_year(cycle)
    out: dict[str, list[str]] = {}
    for module, variable, _, low, high in rows:
        if (low is None or year >= low) and (high is None or year <= high):
            out.setdefault(module, []).append(variable)
    return out


def flat_variables_for_cycle(cycle: str, rows: Sequence[tuple] = tuple(VARIABLES)) -> list[str]:
    return [v for group in variables_for_cycle(cycle, rows).values() for v in group]


def valid_variables(cycles: DataFrame, dictionary: DataFrame, cycle_col: str = "cycle") -> DataFrame:
    """P1 as a join: every (cycle, variable) whose validity range holds the cycle's first year.

    Ranges are spelled out year by year between the first and the last cycle, which leaves a join on the year.
    """
    years = cycles.withColumn("cycle_year", cycle_year(F.col(cycle_col), DEFAULT_YEAR))
    first, last = years.agg(F.min("cycle_year"), F.max("cycle_year")).first()
    if first is None:
        first = last = DEFAULT_YEAR
    low = F.greatest(F.coalesce(F.col("year_from").cast("int"), F.lit(first)), F.lit(first)).cast("int")
    high = F.least(F.coalesce(F.col("year_to").cast("int"), F.lit(last)), F.lit(last)).cast("int")
    spelled = dictionary.where(low <= high).withColumn("valid_year", F.explode(F.sequence(low, high)))
    return years.join(spelled, F.col("cycle_year") == F.col("valid_year")).drop("valid_year")


def coalesce_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """P5: fold every present alias of a canonical column into it, first non-null in dictionary order.

    The result takes the place of the first alias, and no name occurs twice.
    """
    folded: dict[str, Column] = {}
    place: dict[str, str] = {}
    dropped: set[str] = set()
    for canonical, names in aliases.items():
        found = present(df, [canonical, *[n for n in names if n != canonical]])
        if not found:
            continue
        found_in_order = [c for c in df.columns if c in found]
        place[found_in_order[0]] = canonical
        dropped.update(found_in_order[1:])
        folded[canonical] = F.coalesce(*[F.col(f"`{c}`") for c in found]).alias(canonical)
    out = []
    for c in df.columns:
        if c in place:
            out.append(folded[place[c]])
        elif c not in dropped:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def readable_names(
    df: DataFrame,
    names: Mapping[str, str] = READABLE,
    aliases: Mapping[str, Sequence[str]] = READABLE_ALIASES,
) -> DataFrame:
    """Raw codes to readable names where present; cycle-dependent codes are folded first."""
    return coalesce_aliases(df, aliases).withColumnsRenamed(dict(names))
