"""County health: latest totals, facility roll-up, joined profile, percentages, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from roadweave.functions import per_capita
from roadweave.operators import conform, preview, running_count_at_key, sanitize_columns

# Facility measures, whole numbers and fractions.
FACILITY_COUNTS = [
    "Residents_Weekly_Admissions_COVID_19",
    "Residents_Total_Admissions_COVID_19",
    "Residents_Weekly_Confirmed_COVID_19",
    "Residents_Total_Confirmed_COVID_19",
    "Residents_Weekly_Suspected_COVID_19",
    "Residents_Total_Suspected_COVID_19",
    "Residents_Weekly_All_Deaths",
    "Residents_Total_All_Deaths",
    "Residents_Weekly_COVID_19_Deaths",
    "Residents_Total_COVID_19_Deaths",
    "Number_of_All_Beds",
    "Total_Number_of_Occupied_Beds",
    "Staff_Weekly_Confirmed_COVID_19",
    "Staff_Total_Confirmed_COVID_19",
    "Staff_Weekly_Suspected_COVID_19",
    "Staff_Total_Suspected_COVID_19",
    "Staff_Weekly_COVID_19_Deaths",
    "Staff_Total_COVID_19_Deaths",
    "Number_of_Ventilators_in_Facility",
    "Number_of_Ventilators_in_Use_for_COVID_19",
]
FACILITY_RATES = [
    "Total_Resident_Confirmed_COVID_19_Cases_Per_1_000_Residents",
    "Total_Resident_COVID_19_Deaths_Per_1_000_Residents",
    "Total_Residents_COVID_19_Deaths_as_a_Percentage_of_Confirmed_COVID_19_Cases",
]

# The roll-up lists the ventilators after the rates.
FACILITY_ORDER = [*FACILITY_COUNTS[:18], *FACILITY_RATES, *FACILITY_COUNTS[18:]]

# Industry and insurance percentages, with the shorter names some of them get.
INDUSTRY = {
    "Agriculture_forestry_fishing_and_hunting_and_mining": "Agriculture_forestry_fishing_and_hunting_and_mining",
    "Construction": "Construction",
    "Manufacturing": "Manufacturing",
    "Wholesale_trade": "Wholesale_trade",
    "Retail_trade": "Retail_trade",
    "Transportation_and_warehousing_and_utilities": "Transportation_and_warehousing_and_utilities",
    "Information": "Information",
    "Finance_and_insurance_and_real_estate_and_rental_and_leasing": "Finance_and_insurance_and_real_estate_and_rental",
    "Professional_scientific_and_management_and_administrative_and": (
        "Professional_scientific_and_management_and_administrative"
    ),
    "Educational_services_and_health_care_and_social_assistance": (
        "Educational_services_and_health_care_and_social_assist"
    ),
    "Arts_entertainment_and_recreation_and_accommodation_and_food": (
        "Arts_entertainment_and_recreation_and_accommodation"
    ),
    "Other_services_except_public_administration": "Other_services_except_public_admin",
    "Public_administration": "Public_administration",
    "Private_wage_and_salary_workers": "Private_wage_and_salary_workers",
    "Government_workers": "Government_workers",
    "Self_employed_in_own_not_incorporated_business_workers": "Self_employed",
    "Unpaid_family_workers": "Unpaid_family_workers",
    "With_health_insurance_coverage": "With_health_insurance_coverage",
    "No_health_insurance_coverage": "No_health_insurance_coverage",
}

# Age groups of the disability counts, and population groups with their codes and names.
DISABLED_AGES = [
    "Under_5_years",
    "5_to_17_years",
    "18_to_34_years",
    "35_to_64_years",
    "65_to_74_years",
    "75_years_and_over",
]
POPULATION_GROUPS = {
    "wa": ("White_Males", "White_Females"),
    "ba": ("African_American_Males", "African_American_Females"),
    "ia": ("American_Indian_Male", "American_Indian_Female"),
    "aa": ("Asian_Male", "Asian_Female"),
    "na": ("Native_Hawaiian_or_Pacific_Islands_Male", "Native_Hawaiian_or_Pacific_Islands_Female"),
    "tom": ("Two_Or_More_Races_Male", "Two_Or_More_Races_Female"),
}

# Age-band percentages of the population, spelled as they are published.
AGE_BANDS = [
    "Total_Population_Under_5_years_Percent",
    "Male_Population_Under_5_years_Percent",
    "Female_Population_Under_5_years_Percent",
    "Total_Population_5_to_9_years_Percent",
    "Male_Total_population_5_to_9_years_Percent",
    "Female_Total_Population_5_to_9_years_Percent",
    "Total_Population_10_to_14_years_Percent",
    "Male_Total_Population_10_to_14_years_Percent",
    "Female_Total_Population_0_to_14_years_Percent",
    "Total_Population_15_to_19_years_Percent",
    "Male_Total_Population_15_to_19_years_Percent",
    "Female_Total_Population_15_to_19_years_Percent",
    "Total_Population_20_to_24_years_Percent",
    "Male_Total_Population_20_to_24_years_Percent",
    "Female_Total_Population_20_to_24_years_Percent",
    "Total_Population_25_to_29_years_Percent",
    "Male_Total_Population_25_to_29_years_Percent",
    "Female_Total_Population_25_to_29_years_Percent",
    "Total_Population_30_to_34_years_Percent",
    "Male_Total_Population_30_to_34_years_Percent",
    "Female_Total_Population_30_to_34_years_Percent",
    "Total_Population_35_to_39_years_Percent",
    "Male_Total_population_35_to_39_years_Percent",
    "Female_Total_Population_35_to_39_years_Percent",
    "Total_Population_40_to_44_years_Percent",
    "Male_Total_Population_40_to_44_years_Percent",
    "Female_Total_Population_40_to_44_years_Percent",
    "Total_Population_45_to_49_years_Percent",
    "Male_Total_Population_45_to_49_years_Percent",
    "Female_Total_Population_45_to_49_years_Percent",
    "Total_population_50_to_54_years_Percent",
    "Male_Total_Population_50_to_54_years_Percent",
    "Female_Total_Population_50_to_54_years_Percent",
    "Total_Population_55_to_59_years_Percent",
    "Male_Total_Population_55_to_59_years_Percent",
    "Female_Total_Population_55_to_59_years_Percent",
    "Total_Population_60_to_64_years_Percent",
    "Male_Total_Population_60_to_64_years_Percent",
    "Female_Total_Population_60_to_64_years_Percent",
    "Total_Population_65_to_69_years_Percent",
    "Male_Total_population_65_to_69_years_Percent",
    "Female_Total_Population_65_to_69_years_Percent",
    "Total_Population_70_to_74_years_Percent",
    "Male_Total_Population_70_to_74_years_Percent",
    "Female_Total_Population_70_to_74_years_Percent",
    "Total_Population_75_to_79_years_Percent",
    "Male_Total_Population_75_to_79_years_Percent",
    "Female_Total_Population_75_to_79_years_Percent",
    "Total_Population_80_to_84_years_Percent",
    "Male_Total_Population_80_to_84_years_Percent",
    "Female_Total_Population_80_to_84_years_Percent",
    "Total_population_85_years_and_over_Percent",
    "Male_Total_Population_85_years_and_over_Percent",
    "Female_Total_Population_85_years_and_over_Percent",
]

# Groups whose disability percentage the final table shows.
DISABLED_GROUPS = [
    "White",
    "Black_or_African_American",
    "American_Indian_and_Alaska_Native",
    "Asian",
    "Native_Hawaiian_and_Other_Pacific_Islander",
    "Some_other_race",
    "Two_or_more_races",
    "Hispanic_or_Latino",
]

# The 129 columns of the final county table, in order.
PREVIEW_COLUMNS = [
    "Fips", "State", "County", "NCHS_Code", "Total_Population", "Total_Male", "Total_Female",
    *AGE_BANDS,
    "Positives", "Positives_Per_100_000", "Deaths", "Deaths_Per_100_000", "HousingUnits", "Median_income_2_earners",
    "People_Living_with_Income_Assistance_Percent", "Estimate_Population_16_years_and_over_In_labor_force_Percent",
    *(f"{name}_Percent" for name in INDUSTRY.values()),
    *(f"With_a_disability_{group}_Percent" for group in DISABLED_GROUPS),
    *(f"{name}_Percent" for names in POPULATION_GROUPS.values() for name in names),
    "County_Fips",
    *FACILITY_COUNTS[:11], *FACILITY_COUNTS[12:18], *FACILITY_RATES,
]
_IDS = {"Fips", "NCHS_Code", "County_Fips"}
_NAMES = {"State", "County"}
PREVIEW_SCHEMA = StructType(
    [
        StructField(c, LongType() if c in _IDS else StringType() if c in _NAMES else DoubleType())
        for c in PREVIEW_COLUMNS
    ]
)


def county_totals(cases: DataFrame) -> DataFrame:
    """Highest running total of cases and deaths per county."""
    return (
        cases.where(F.col("fips").isNotNull())
        .groupBy("fips", "county", "state")
        .agg(F.max("cases").alias("max_cases"), F.max("deaths").alias("max_deaths"))
    )


def county_dimension(cases: DataFrame) -> DataFrame:
    """Distinct counties."""
    return cases.where(F.col("fips").isNotNull()).select("fips", "county", "state").distinct()


def facility_rollup(homes: DataFrame, corrected: bool = False, lenient: bool = False) -> DataFrame:
    """Facility measures summed per county (C14).

    As in the source data, every sum is multiplied by the county's number of facilities, and
    ``Total_Facilities`` is the largest rank its facilities have within a zip code (K17). ``corrected`` gives
    plain sums and the number of facilities. Text that is no number raises; ``lenient`` takes it as missing.
    The table is read once and aggregated before anything is ordered; rates are summed as decimals.
    """
    number = lambda c, kind: F.col(c).try_cast(kind) if lenient else F.col(c).cast(kind)
    typed = homes.select(
        "provider_zip_code", F.col("county_fips").alias("County_Fips"),
        *(number(c, "bigint").alias(c) for c in FACILITY_COUNTS),
        *(number(c, "decimal(28,9)").alias(c) for c in FACILITY_RATES),
    )
    rolled = running_count_at_key(typed, "provider_zip_code", "County_Fips", "Total_Facilities", totals=FACILITY_ORDER)
    times = (F.lit(1) if corrected else F.col("rows")).cast("decimal(9,0)")
    shown = lambda c: (
        (F.col(c).cast("decimal(28,9)") * times).cast("double" if c in FACILITY_RATES else "bigint").alias(c)
    )
    facilities = F.col("rows").alias("Total_Facilities") if corrected else "Total_Facilities"
    return rolled.select("County_Fips", facilities, *(shown(c) for c in FACILITY_ORDER))


def county_profile(
    totals: DataFrame,
    demographics: DataFrame,
    housing: DataFrame,
    income_assistance: DataFrame,
    disabled: DataFrame,
    median_income: DataFrame,
    labor_force: DataFrame,
    industry: DataFrame,
    on_zero: str = "error",
    collation: str | None = None,
) -> DataFrame:
    """Totals joined with the county tables, with rates per 100,000.

    Counties without an income assistance figure are left out, so that join is an inner one (J16). State names
    of the housing table carry leading blanks (J14). Names match exactly; a ``collation`` such as
    ``UTF8_LCASE`` matches them regardless of case.
    """
    name = lambda c: F.collate(c, collation) if collation else c
    named = demographics.withColumnsRenamed({"ctyname": "a_county", "stname": "a_state"})
    houses = housing.select(F.col("county").alias("h_county"), F.ltrim("state").alias("h_state"), "housingunits")
    same = lambda side: (
        (name(F.col("county")) == name(F.col(f"{side}_county"))) & (name(F.col("state")) == name(F.col(f"{side}_state")))
    )
    joined = totals.join(named, same("a")).join(houses, same("h"))
    joined = joined.join(income_assistance.where(F.col("living_with_income_assistance").isNotNull()), "fips")
    for table in (disabled, median_income, labor_force, industry):
        joined = joined.join(table, "fips", "left")
    rate = lambda c: per_capita(F.col(c), F.col("tot_pop"), 100_000, 2, on_zero)
    rest = [c for t in (industry, disabled) for c in t.columns if c != "fips"]
    people = [c for c in demographics.columns if c not in ("ctyname", "stname")]
    return joined.select(
        "fips", "state", "county",
        F.col("max_cases").alias("positives"), rate("max_cases").alias("positives_per_100_000"),
        F.col("max_deaths").alias("deaths"), rate("max_deaths").alias("deaths_per_100_000"),
        "housingunits", "median_income_2_earners", "living_with_income_assistance", "in_labor_force",
        *rest, *people,
    )


def disabled_column(sex: str, age: str) -> str:
    return f"Estimate_Total_{sex}_{age}_With_a_disability"


def county_percents(
    profile: DataFrame, ages: DataFrame, facilities: DataFrame, on_zero: str = "error"
) -> DataFrame:
    """The profile with counts as percentages of the population, age bands and facilities.

    Percentages are named with a blank and brackets, as published; ``sanitize_columns`` gives plain names.
    Counties without facilities keep nulls there (K18).
    """
    pct = lambda num, den: per_capita(F.col(num), F.col(den), 100, 2, on_zero)
    bands = [c for c in ages.columns if c != "fips"]
    sexes = {"Male": "tot_male", "Female": "tot_female"}
    joined = profile.join(ages, "fips").join(facilities, F.col("fips") == F.col("County_Fips"), "left")
    return joined.select(
        F.col("fips").alias("Fips"), F.col("state").alias("State"), F.col("county").alias("County"),
        F.col("tot_pop").alias("Total_Population"), F.col("tot_male").alias("Total_Male"),
        F.col("tot_female").alias("Total_Female"),
        *bands,
        F.col("positives").alias("Positives"), F.col("positives_per_100_000").alias("Positives_Per_100,000"),
        F.col("deaths").alias("Deaths"), F.col("deaths_per_100_000").alias("Deaths_Per_100,000"),
        F.col("housingunits").alias("HousingUnits"), F.col("median_income_2_earners").alias("Median_income_2_earners"),
        pct("living_with_income_assistance", "tot_pop").alias("People_Living_with_Income_Assistance (Percent)"),
        F.col("in_labor_force").alias("Estimate_Population_16_years_and_over_In_labor_force (Percent)"),
        *(F.col(source).alias(f"{name} (Percent)") for source, name in INDUSTRY.items()),
        *(
            pct(disabled_column(sex, age), total).alias(f"{disabled_column(sex, age)} (Percent)")
            for sex, total in sexes.items() for age in DISABLED_AGES
        ),
        *(
            pct(f"{code}_{sex.lower()}", total).alias(f"{name} (Percent)")
            for code, names in POPULATION_GROUPS.items()
            for name, (sex, total) in zip(names, sexes.items())
        ),
        *facilities.columns,
    )


def disability_column(group: str) -> str:
    return f"With_a_disability_{group}_Percent"


def county_preview(percents: DataFrame, disability: DataFrame, n: int = 1000) -> DataFrame:
    """The first ``n`` counties by code, in the layout of the final county table.

    ``disability`` has a row a county: fips and, for each population group, the percentage with a disability, which the
    final table shows beside what ``county_percents`` reckons. Counties without a row there keep nulls.
    """
    groups = disability.select(F.col("fips").alias("d_fips"), *map(disability_column, DISABLED_GROUPS))
    joined = sanitize_columns(percents).join(groups, F.col("Fips") == F.col("d_fips"), "left")
    return preview(conform(joined, PREVIEW_SCHEMA), n, ["Fips"])
