"""Declared schemas: the production table, change requests, the field CSV
and the wide wellbore table.

A schema here is a list of :class:`ColumnRule` (name, Spark type, nullable,
maximum text length, default). Spark does not enforce length, NOT NULL or
defaults on a plain DataFrame, so :mod:`prodlake.operators.quality` turns the
rules into predicates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

OIL_GAS_TYPE = T.DecimalType(15, 5)
SUM_TYPE = T.DecimalType(25, 5)
MEAN_TYPE = T.DecimalType(19, 6)


@dataclass(frozen=True)
class ColumnRule:
    name: str
    dtype: T.DataType = T.StringType()
    nullable: bool = True
    max_length: int | None = None
    default: object | None = None


def struct_of(rules: list[ColumnRule], all_strings: bool = False) -> T.StructType:
    """StructType for reading: every field nullable, so bad rows can be seen."""
    return T.StructType(
        [T.StructField(r.name, T.StringType() if all_strings else r.dtype, True) for r in rules]
    )


# --- fixed values: the production table (id identity, wellbore varchar(50)
# not null, year int not null, month int not null, oil and gas decimal(15,5)
# not null with default 0) -------------------------------------------------
PRODUCTION_RULES = [
    ColumnRule("wellbore", T.StringType(), nullable=False, max_length=50),
    ColumnRule("year", T.IntegerType(), nullable=False),
    ColumnRule("month", T.IntegerType(), nullable=False),
    ColumnRule("oil", OIL_GAS_TYPE, nullable=False, default=0),
    ColumnRule("gas", OIL_GAS_TYPE, nullable=False, default=0),
]
PRODUCTION_COLUMNS = [r.name for r in PRODUCTION_RULES]
PRODUCTION_KEYED_COLUMNS = ["id", *PRODUCTION_COLUMNS]
MONTH_RANGE = (1, 12)

# --- fixed values: the field production CSV (carrier text, year int, six
# double measures) ------------------------------------------------------------
FIELD_CARRIER = "prfInformationCarrier"
FIELD_YEAR = "prfYear"
FIELD_MEASURES = [
    "prfPrdOilNetMillSm3",
    "prfPrdGasNetBillSm3",
    "prfPrdNGLNetMillSm3",
    "prfPrdCondensateNetMillSm3",
    "prfPrdOeNetMillSm3",
    "prfPrdProducedWaterInFieldMillSm3",
]
FIELD_COLUMNS = [FIELD_CARRIER, FIELD_YEAR, *FIELD_MEASURES]
FIELD_TYPES = {FIELD_CARRIER: "string", FIELD_YEAR: "int", **{m: "double" for m in FIELD_MEASURES}}
ENRICH_OFFSET = 300  # the dummy personal-data column is year + 300

# --- fixed values: the wellbore table, 81 text columns in declared order:
# (name, maximum length, nullable). Seven date columns are varchar(10). ----
WELLBORE_COLUMNS = [
    ("wlbWellboreName", 13, False),
    ("wlbWell", 10, False),
    ("wlbDrillingOperator", 47, False),
    ("wlbProductionLicence", 6, False),
    ("wlbPurpose", 9, False),
    ("wlbStatus", 21, True),
    ("wlbContent", 18, True),
    ("wlbWellType", 11, False),
    ("wlbSubSea", 2, False),
    ("wlbEntryDate", 10, True),
    ("wlbCompletionDate", 10, True),
    ("wlbField", 16, True),
    ("wlbDrillPermit", 7, False),
    ("wlbDiscovery", 28, True),
    ("wlbDiscoveryWellbore", 3, False),
    ("wlbBottomHoleTemperature", 500, True),
    ("wlbSeismicLocation", 94, True),
    ("wlbMaxInclation", 500, True),
    ("wlbKellyBushElevation", 500, False),
    ("wlbFinalVerticalDepth", 500, True),
    ("wlbTotalDepth", 500, False),
    ("wlbWaterDepth", 500, False),
    ("wlbKickOffPoint", 500, True),
    ("wlbAgeAtTd", 20, True),
    ("wlbFormationAtTd", 20, True),
    ("wlbMainArea", 13, False),
    ("wlbDrillingFacility", 22, True),
    ("wlbFacilityTypeDrilling", 16, True),
    ("wlbDrillingFacilityFixedOrMoveable", 8, True),
    ("wlbLicensingActivity", 34, False),
    ("wlbMultilateral", 2, False),
    ("wlbPurposePlanned", 9, True),
    ("wlbEntryYear", 500, False),
    ("wlbCompletionYear", 500, False),
    ("wlbReclassFromWellbore", 14, True),
    ("wlbReentryExplorationActivity", 25, True),
    ("wlbPlotSymbol", 500, False),
    ("wlbFormationWithHc1", 20, True),
    ("wlbAgeWithHc1", 17, True),
    ("wlbFormationWithHc2", 19, True),
    ("wlbAgeWithHc2", 17, True),
    ("wlbFormationWithHc3", 18, True),
    ("wlbAgeWithHc3", 17, True),
    ("wlbDrillingDays", 500, False),
    ("wlbReentry", 3, False),
    ("wlbGeodeticDatum", 4, True),
    ("wlbNsDeg", 500, False),
    ("wlbNsMin", 500, False),
    ("wlbNsSec", 500, False),
    ("wlbNsCode", 1, False),
    ("wlbEwDeg", 500, False),
    ("wlbEwMin", 500, False),
    ("wlbEwSec", 500, False),
    ("wlbEwCode", 1, False),
    ("wlbNsDecDeg", 500, False),
    ("wlbEwDesDeg", 500, False),
    ("wlbNsUtm", 500, False),
    ("wlbEwUtm", 500, False),
    ("wlbUtmZone", 500, False),
    ("wlbNamePart1", 500, False),
    ("wlbNamePart2", 500, False),
    ("wlbNamePart3", 30, True),
    ("wlbNamePart4", 500, False),
    ("wlbNamePart5", 2, True),
    ("wlbNamePart6", 30, True),
    ("wlbPressReleaseUrl", 153, True),
    ("wlbFactPageUrl", 100, False),
    ("wlbFactMapUrl", 82, False),
    ("wlbDiskosWellboreType", 9, False),
    ("wlbDiskosWellboreParent", 12, True),
    ("wlbWdssQcDate", 10, True),
    ("wlbReleasedDate", 10, True),
    ("wlbNpdidWellbore", 500, False),
    ("dscNpdidDiscovery", 500, True),
    ("fldNpdidField", 500, True),
    ("fclNpdidFacilityDrilling", 500, True),
    ("wlbNpdidWellboreReclass", 500, False),
    ("prlNpdidProductionLicence", 500, False),
    ("wlbDateUpdated", 10, False),
    ("wlbDateUpdatedMax", 10, False),
    ("datesyncNPD", 10, False),
]
WELLBORE_RULES = [ColumnRule(n, T.StringType(), nullable=nb, max_length=m) for n, m, nb in WELLBORE_COLUMNS]
WELLBORE_SCHEMA = struct_of(WELLBORE_RULES)

# --- fixed values: layer metadata a raw landing carries -----------------------
RAW_METADATA_COLUMNS = ["source_path", "source_time", "classification", "owner", "country"]
