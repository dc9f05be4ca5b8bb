"""The published lists that the SQL statements need, written out so that they don't follow the library's."""

# System codes of roads that are not collected.
OFF_SYSTEM = [
    "OFF",
    "OUT",
    "CLO",
]

# Surface codes of paved roads.
PAVED = [
    "PMS",
    "PCC",
    "BST",
    "RMS",
]

# Corridors without records.
NOT_RECORDED = [
    "C003102N",
    "C000422N",
    "C000409N",
]

# The segment layout.
SEGMENT = {
    "corridor_code_rb": "varchar",
    "road_pathweb": "varchar",
    "van_no": "int",
    "beg_gn": "bigint",
    "end_gn": "bigint",
    "corridor_code": "varchar",
    "secfile_name": "varchar",
    "county_name": "varchar",
    "district_no": "int",
    "road_van": "varchar",
    "from_descr": "varchar",
    "to_descr": "varchar",
    "frfpost": "double",
    "trfpost": "double",
    "begin_mi": "double",
    "end_mi": "double",
    "dir": "varchar",
    "svyleng2012": "double",
    "lane": "int",
    "rb": "varchar",
    "start_lat": "double",
    "start_lon": "double",
    "end_lat": "double",
    "end_lon": "double",
    "p": "varchar",
}

# The field codes taken.
LAB_CODES = [
    "23",
    "26",
    "29",
    "32",
    "35",
    "38",
    "41",
    "44",
    "47",
    "50",
    "53",
    "56",
    "59",
    "62",
    "65",
    "68",
    "71",
    "74",
    "77",
    "80",
    "83",
    "86",
    "89",
    "92",
    "95",
    "98",
    "101",
    "104",
    "107",
]

# What the codes name; 89 names nothing.
LAB_MEASURES = {
    "23": "assay",
    "26": "effectiveness_pns_score",
    "29": "pns_blank",
    "32": "pns_nacl",
    "35": "settable_solids",
    "38": "settable_solids_temp",
    "41": "percent_pass_10m",
    "44": "ph",
    "47": "as_",
    "50": "ba",
    "53": "cd",
    "56": "cr",
    "59": "cu",
    "62": "pb",
    "65": "hg",
    "68": "se",
    "71": "zn",
    "74": "cn",
    "77": "p",
    "80": "s",
    "83": "sulfate",
    "86": "phosphate",
    "92": "k",
    "95": "ca",
    "98": "mg",
    "101": "nitrite",
    "104": "nitrate",
    "107": "chloride",
}

# Measures shown per sample; mg by its lowest value.
LAB_REPORTED = [
    "assay",
    "effectiveness_pns_score",
    "pns_blank",
    "pns_nacl",
    "settable_solids",
    "percent_pass_10m",
    "ph",
    "as_",
    "ba",
    "cd",
    "cr",
    "cu",
    "pb",
    "hg",
    "se",
    "zn",
    "cn",
    "p",
    "s",
    "sulfate",
    "phosphate",
    "k",
    "ca",
    "mg",
    "nitrite",
    "nitrate",
    "chloride",
]

# Measures compared for conflicts.
LAB_COMPARED = [
    "effectiveness_pns_score",
    "pns_blank",
    "pns_nacl",
    "settable_solids",
    "percent_pass_10m",
    "ph",
    "as_",
    "ba",
    "cd",
    "cr",
    "cu",
    "pb",
    "hg",
    "se",
    "zn",
    "cn",
    "p",
    "sulfate",
    "phosphate",
    "k",
    "ca",
    "mg",
    "nitrite",
    "nitrate",
    "chloride",
]

# Facility measures in the order of the roll-up, text that holds whole numbers unless listed below.
FACILITY_SUMS = [
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
    "Total_Resident_Confirmed_COVID_19_Cases_Per_1_000_Residents",
    "Total_Resident_COVID_19_Deaths_Per_1_000_Residents",
    "Total_Residents_COVID_19_Deaths_as_a_Percentage_of_Confirmed_COVID_19_Cases",
    "Number_of_Ventilators_in_Facility",
    "Number_of_Ventilators_in_Use_for_COVID_19",
]

# Those that hold fractions.
FACILITY_RATES = [
    "Total_Resident_Confirmed_COVID_19_Cases_Per_1_000_Residents",
    "Total_Resident_COVID_19_Deaths_Per_1_000_Residents",
    "Total_Residents_COVID_19_Deaths_as_a_Percentage_of_Confirmed_COVID_19_Cases",
]

# Industry columns and the names they get.
INDUSTRY = {
    "Agriculture_forestry_fishing_and_hunting_and_mining": "Agriculture_forestry_fishing_and_hunting_and_mining",
    "Construction": "Construction",
    "Manufacturing": "Manufacturing",
    "Wholesale_trade": "Wholesale_trade",
    "Retail_trade": "Retail_trade",
    "Transportation_and_warehousing_and_utilities": "Transportation_and_warehousing_and_utilities",
    "Information": "Information",
    "Finance_and_insurance_and_real_estate_and_rental_and_leasing": "Finance_and_insurance_and_real_estate_and_rental",
    "Professional_scientific_and_management_and_administrative_and": "Professional_scientific_and_management_and_administrative",
    "Educational_services_and_health_care_and_social_assistance": "Educational_services_and_health_care_and_social_assist",
    "Arts_entertainment_and_recreation_and_accommodation_and_food": "Arts_entertainment_and_recreation_and_accommodation",
    "Other_services_except_public_administration": "Other_services_except_public_admin",
    "Public_administration": "Public_administration",
    "Private_wage_and_salary_workers": "Private_wage_and_salary_workers",
    "Government_workers": "Government_workers",
    "Self_employed_in_own_not_incorporated_business_workers": "Self_employed",
    "Unpaid_family_workers": "Unpaid_family_workers",
    "With_health_insurance_coverage": "With_health_insurance_coverage",
    "No_health_insurance_coverage": "No_health_insurance_coverage",
}

# Disability counts.
DISABLED = [
    "Estimate_Total_Male_Under_5_years_With_a_disability",
    "Estimate_Total_Male_5_to_17_years_With_a_disability",
    "Estimate_Total_Male_18_to_34_years_With_a_disability",
    "Estimate_Total_Male_35_to_64_years_With_a_disability",
    "Estimate_Total_Male_65_to_74_years_With_a_disability",
    "Estimate_Total_Male_75_years_and_over_With_a_disability",
    "Estimate_Total_Female_Under_5_years_With_a_disability",
    "Estimate_Total_Female_5_to_17_years_With_a_disability",
    "Estimate_Total_Female_18_to_34_years_With_a_disability",
    "Estimate_Total_Female_35_to_64_years_With_a_disability",
    "Estimate_Total_Female_65_to_74_years_With_a_disability",
    "Estimate_Total_Female_75_years_and_over_With_a_disability",
]

# Population groups and their names.
GROUPS = {
    "wa": ("White_Males", "White_Females"),
    "ba": ("African_American_Males", "African_American_Females"),
    "ia": ("American_Indian_Male", "American_Indian_Female"),
    "aa": ("Asian_Male", "Asian_Female"),
    "na": ("Native_Hawaiian_or_Pacific_Islands_Male", "Native_Hawaiian_or_Pacific_Islands_Female"),
    "tom": ("Two_Or_More_Races_Male", "Two_Or_More_Races_Female"),
}

# The columns of the final county table.
PREVIEW = {
    "Fips": "bigint",
    "State": "varchar",
    "County": "varchar",
    "NCHS_Code": "bigint",
    "Total_Population": "double",
    "Total_Male": "double",
    "Total_Female": "double",
    "Total_Population_Under_5_years_Percent": "double",
    "Male_Population_Under_5_years_Percent": "double",
    "Female_Population_Under_5_years_Percent": "double",
    "Total_Population_5_to_9_years_Percent": "double",
    "Male_Total_population_5_to_9_years_Percent": "double",
    "Female_Total_Population_5_to_9_years_Percent": "double",
    "Total_Population_10_to_14_years_Percent": "double",
    "Male_Total_Population_10_to_14_years_Percent": "double",
    "Female_Total_Population_0_to_14_years_Percent": "double",
    "Total_Population_15_to_19_years_Percent": "double",
    "Male_Total_Population_15_to_19_years_Percent": "double",
    "Female_Total_Population_15_to_19_years_Percent": "double",
    "Total_Population_20_to_24_years_Percent": "double",
    "Male_Total_Population_20_to_24_years_Percent": "double",
    "Female_Total_Population_20_to_24_years_Percent": "double",
    "Total_Population_25_to_29_years_Percent": "double",
    "Male_Total_Population_25_to_29_years_Percent": "double",
    "Female_Total_Population_25_to_29_years_Percent": "double",
    "Total_Population_30_to_34_years_Percent": "double",
    "Male_Total_Population_30_to_34_years_Percent": "double",
    "Female_Total_Population_30_to_34_years_Percent": "double",
    "Total_Population_35_to_39_years_Percent": "double",
    "Male_Total_population_35_to_39_years_Percent": "double",
    "Female_Total_Population_35_to_39_years_Percent": "double",
    "Total_Population_40_to_44_years_Percent": "double",
    "Male_Total_Population_40_to_44_years_Percent": "double",
    "Female_Total_Population_40_to_44_years_Percent": "double",
    "Total_Population_45_to_49_years_Percent": "double",
    "Male_Total_Population_45_to_49_years_Percent": "double",
    "Female_Total_Population_45_to_49_years_Percent": "double",
    "Total_population_50_to_54_years_Percent": "double",
    "Male_Total_Population_50_to_54_years_Percent": "double",
    "Female_Total_Population_50_to_54_years_Percent": "double",
    "Total_Population_55_to_59_years_Percent": "double",
    "Male_Total_Population_55_to_59_years_Percent": "double",
    "Female_Total_Population_55_to_59_years_Percent": "double",
    "Total_Population_60_to_64_years_Percent": "double",
    "Male_Total_Population_60_to_64_years_Percent": "double",
    "Female_Total_Population_60_to_64_years_Percent": "double",
    "Total_Population_65_to_69_years_Percent": "double",
    "Male_Total_population_65_to_69_years_Percent": "double",
    "Female_Total_Population_65_to_69_years_Percent": "double",
    "Total_Population_70_to_74_years_Percent": "double",
    "Male_Total_Population_70_to_74_years_Percent": "double",
    "Female_Total_Population_70_to_74_years_Percent": "double",
    "Total_Population_75_to_79_years_Percent": "double",
    "Male_Total_Population_75_to_79_years_Percent": "double",
    "Female_Total_Population_75_to_79_years_Percent": "double",
    "Total_Population_80_to_84_years_Percent": "double",
    "Male_Total_Population_80_to_84_years_Percent": "double",
    "Female_Total_Population_80_to_84_years_Percent": "double",
    "Total_population_85_years_and_over_Percent": "double",
    "Male_Total_Population_85_years_and_over_Percent": "double",
    "Female_Total_Population_85_years_and_over_Percent": "double",
    "Positives": "double",
    "Positives_Per_100_000": "double",
    "Deaths": "double",
    "Deaths_Per_100_000": "double",
    "HousingUnits": "double",
    "Median_income_2_earners": "double",
    "People_Living_with_Income_Assistance_Percent": "double",
    "Estimate_Population_16_years_and_over_In_labor_force_Percent": "double",
    "Agriculture_forestry_fishing_and_hunting_and_mining_Percent": "double",
    "Construction_Percent": "double",
    "Manufacturing_Percent": "double",
    "Wholesale_trade_Percent": "double",
    "Retail_trade_Percent": "double",
    "Transportation_and_warehousing_and_utilities_Percent": "double",
    "Information_Percent": "double",
    "Finance_and_insurance_and_real_estate_and_rental_Percent": "double",
    "Professional_scientific_and_management_and_administrative_Percent": "double",
    "Educational_services_and_health_care_and_social_assist_Percent": "double",
    "Arts_entertainment_and_recreation_and_accommodation_Percent": "double",
    "Other_services_except_public_admin_Percent": "double",
    "Public_administration_Percent": "double",
    "Private_wage_and_salary_workers_Percent": "double",
    "Government_workers_Percent": "double",
    "Self_employed_Percent": "double",
    "Unpaid_family_workers_Percent": "double",
    "With_health_insurance_coverage_Percent": "double",
    "No_health_insurance_coverage_Percent": "double",
    "With_a_disability_White_Percent": "double",
    "With_a_disability_Black_or_African_American_Percent": "double",
    "With_a_disability_American_Indian_and_Alaska_Native_Percent": "double",
    "With_a_disability_Asian_Percent": "double",
    "With_a_disability_Native_Hawaiian_and_Other_Pacific_Islander_Percent": "double",
    "With_a_disability_Some_other_race_Percent": "double",
    "With_a_disability_Two_or_more_races_Percent": "double",
    "With_a_disability_Hispanic_or_Latino_Percent": "double",
    "White_Males_Percent": "double",
    "White_Females_Percent": "double",
    "African_American_Males_Percent": "double",
    "African_American_Females_Percent": "double",
    "American_Indian_Male_Percent": "double",
    "American_Indian_Female_Percent": "double",
    "Asian_Male_Percent": "double",
    "Asian_Female_Percent": "double",
    "Native_Hawaiian_or_Pacific_Islands_Male_Percent": "double",
    "Native_Hawaiian_or_Pacific_Islands_Female_Percent": "double",
    "Two_Or_More_Races_Male_Percent": "double",
    "Two_Or_More_Races_Female_Percent": "double",
    "County_Fips": "bigint",
    "Residents_Weekly_Admissions_COVID_19": "double",
    "Residents_Total_Admissions_COVID_19": "double",
    "Residents_Weekly_Confirmed_COVID_19": "double",
    "Residents_Total_Confirmed_COVID_19": "double",
    "Residents_Weekly_Suspected_COVID_19": "double",
    "Residents_Total_Suspected_COVID_19": "double",
    "Residents_Weekly_All_Deaths": "double",
    "Residents_Total_All_Deaths": "double",
    "Residents_Weekly_COVID_19_Deaths": "double",
    "Residents_Total_COVID_19_Deaths": "double",
    "Number_of_All_Beds": "double",
    "Staff_Weekly_Confirmed_COVID_19": "double",
    "Staff_Total_Confirmed_COVID_19": "double",
    "Staff_Weekly_Suspected_COVID_19": "double",
    "Staff_Total_Suspected_COVID_19": "double",
    "Staff_Weekly_COVID_19_Deaths": "double",
    "Staff_Total_COVID_19_Deaths": "double",
    "Total_Resident_Confirmed_COVID_19_Cases_Per_1_000_Residents": "double",
    "Total_Resident_COVID_19_Deaths_Per_1_000_Residents": "double",
    "Total_Residents_COVID_19_Deaths_as_a_Percentage_of_Confirmed_COVID_19_Cases": "double",
}

# Groups of the final table that have no source.
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
