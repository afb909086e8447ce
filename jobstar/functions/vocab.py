"""The controlled skill vocabulary.

FIXED VALUES — these must equal the reference vocabulary for results to match:
skill name, skill category, literal matched as a whole word (case-insensitive).
Three skills have a second spelling without the blank, so 34 rows give 31 skills.
"""

SKILL_PATTERNS = [
    ("SQL", "Database", "SQL"),
    ("Python", "Language", "Python"),
    ("Tableau", "BI Tool", "Tableau"),
    ("Excel", "Spreadsheet", "Excel"),
    ("Looker", "BI Tool", "Looker"),
    ("SAS", "Analytics", "SAS"),
    ("AWS", "Cloud", "AWS"),
    ("Azure", "Cloud", "Azure"),
    ("GCP", "Cloud", "GCP"),
    ("Snowflake", "Database", "Snowflake"),
    ("Spark", "Big Data", "Spark"),
    ("Hadoop", "Big Data", "Hadoop"),
    ("Databricks", "Platform", "Databricks"),
    ("Airflow", "Orchestration", "Airflow"),
    ("dbt", "Transformation", "dbt"),
    ("ETL", "Concept", "ETL"),
    ("Microsoft Fabric", "Platform", "Fabric"),
    ("Git", "Version Control", "Git"),
    ("Docker", "DevOps", "Docker"),
    ("Kafka", "Streaming", "Kafka"),
    ("NoSQL", "Database", "NoSQL"),
    ("MongoDB", "Database", "MongoDB"),
    ("PostgreSQL", "Database", "PostgreSQL"),
    ("Machine Learning", "Concept", "Machine Learning"),
    ("Lakehouse", "Architecture", "Lakehouse"),
    ("Data Pipeline", "Concept", "Data Pipeline"),
    ("DAX", "BI Tool", "DAX"),
    ("Synapse", "Cloud", "Synapse"),
    ("Power BI", "BI Tool", "Power BI"),
    ("Power BI", "BI Tool", "PowerBI"),
    ("Data Warehouse", "Architecture", "Data Warehouse"),
    ("Data Warehouse", "Architecture", "DataWarehouse"),
    ("Power Query", "BI Tool", "Power Query"),
    ("Power Query", "BI Tool", "PowerQuery"),
]

# FIXED VALUES — salary rules.
SALARY_FLOOR = 30000          # average below this clears all salary fields
DEFAULT_CURRENCY = "AUD"
SALARY_PERIOD = "annual"

# FIXED VALUES — check labels, as the reference prints them in its result grids.
CHECK_PK = "1. PK uniqueness"
CHECK_NULLS = "2. NULL completeness"
CHECK_LOCATION = "3. Location completeness"
CHECK_DATES = "4. Date validity"
CHECK_FUZZY_LOOSE = "5a. Fuzzy dup (loose)"
CHECK_FUZZY_TIGHT = "5b. Fuzzy dup (tightened)"
CHECK_CATEGORY = "6. Category diversity"
CHECK_SALARY_AVAILABILITY = "7. Salary availability"
CHECK_SALARY_COVERAGE = "Salary coverage"
CHECK_SALARY_SANITY = "Salary sanity"
CHECK_FACT_INTEGRITY = "fact integrity"
CHECK_BRIDGE_SUMMARY = "bridge summary"
CHECK_SKILL_COVERAGE = "skill coverage"
CHECK_SKILL_LIMITATION = "skill extraction limitation"
LIMITATION_NOTE = "API truncation at 500 chars limits coverage"
