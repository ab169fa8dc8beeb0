"""Care-home level data, and its link to the residents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinewise.functions.dates import parse_date
from spinewise.functions.recode import bed_capacity, years_registered
from spinewise.operators.link import entity_link
from spinewise.plans.study import ENTITY

# Columns of the regulator's table left out, and the new names of others.
REGULATOR_DROPPED = [
    "X",
    "Care_home_",
    "Location_Type_Sector",
    "Location_Inspection_Directorate",
    "Location_Primary_Inspection_Cate",
    "Location_City",
    "Location_Type",
]
REGULATOR_RENAMED = {
    "Location_HSCA_start_date": "Location_HSCA_start_date_CQC",
    "Care_homes_beds": "Care_homes_beds_CQC",
    "Publication_Date": "Publication_Date_CQC",
    "Location_Region": "Location_Region_CQC",
    "Location_NHS_Region": "Location_NHS_Region_CQC",
    "Location_Local_Authority": "Location_Local_Authority_CQC",
    "Location_ONSPD_CCG": "Location_ONSPD_CCG_CQC",
    "service_type": "Service_Type_CQC",
    "years_since_registration": "Years_Since_Reg_CQC",
    "serv_user_dementia": "Serv_user_dementia_CQC",
}


def regulator_table(raw: DataFrame) -> DataFrame:
    renamed = raw.drop(*REGULATOR_DROPPED).withColumnsRenamed(REGULATOR_RENAMED)
    return renamed.withColumns(
        {
            "Location_HSCA_start_date_CQC": parse_date("Location_HSCA_start_date_CQC", "ymd"),
            "Publication_Date_CQC": parse_date("Publication_Date_CQC", "dmy"),
        }
    )


def final_set(
    people: DataFrame, homes: DataFrame, survey: DataFrame, regulator: DataFrame, residency: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The care-home table and the residents with their care home's columns and bands.

    ``regulator`` is the table as read, ``residency`` the newest record per care home.
    """
    home_level, linked = entity_link(
        people,
        homes,
        {
            "survey": (survey.withColumnRenamed("RecordedDate", "RecordedDate_WF"), ENTITY),
            "regulator": (regulator_table(regulator), ENTITY),
            "residency": (residency, "Der_CQC_Location_CHRCH"),
        },
        ENTITY,
    )
    banded = linked.withColumns(
        {
            "registered_bed_capacity": bed_capacity(F.col("Care_homes_beds_CQC")),
            "service_reg_yrs": years_registered(F.col("Years_Since_Reg_CQC")),
        }
    )
    return home_level, banded


def final_checks() -> dict[str, Column]:
    """Aggregates over the final set: people linked to the survey, to the regulator's table, and with a home at all."""
    return {"n_survey": F.count("RecordedDate_WF"), "n_regulator": F.count("Publication_Date_CQC"), "n_home": F.count(ENTITY)}
