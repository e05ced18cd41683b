"""Deterministic table generators over a column of row numbers.

Each takes a DataFrame whose column ``n`` counts from 1 (``row_numbers``, or a
key of an existing table) and derives every column from it, so a table of any
size is one narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Word lists of the course tables.
DEPARTMENTS = (
    "accounting", "research", "sales", "operations", "finance", "marketing", "engineering", "support", "hr",
    "logistics",
)
CITIES = ("new_york", "dallas", "chicago", "boston", "atlanta", "denver", "seattle", "austin", "phoenix", "miami")
PEOPLE = ("adam", "bella", "carl", "divya", "eli", "fatima", "gita", "hugo", "irene", "jay")
JOBS = ("clerk", "salesman", "analyst", "manager", "developer", "tester", "architect", "consultant")
PROJECTS = ("Pulse", "Streamline", "SwiftSync", "Flux", "Atlas", "Beacon", "Cobalt", "Delta", "Echo", "Fusion")
UPDATE_JOBS = ("clerk", "salesman", "analyst", "manager", "developer")

# Word lists of the retail tables.
FIRST_NAMES = (
    "Aarav", "Aisha", "Carlos", "Chloe", "Daniel", "Elena", "Fatima", "Gabriel", "Hannah", "Ishaan", "Jasmine",
    "Kenji", "Liam", "Maya", "Noah", "Olivia", "Priya", "Rohan", "Sofia", "Zoe",
)
LAST_NAMES = (
    "Anderson", "Bennett", "Chen", "Diaz", "Evans", "Garcia", "Hassan", "Iyer", "Johnson", "Kim", "Lopez", "Miller",
    "Nair", "Patel", "Rivera", "Sharma", "Singh", "Thomas", "Walker", "Young",
)
REGIONS = ("north", "south", "east", "west")
RETAIL_JOBS = ("clerk", "analyst", "manager", "developer")


def row_numbers(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    if rows < 0:
        raise ValueError("rows cannot be negative")
    return spark.range(1, rows + 1, numPartitions=partitions).withColumnRenamed("id", "n")


def _pick(words: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (index + 1).cast("int"))


def _div(number: Column, by: int) -> Column:
    return F.floor(number / by).cast("long")


def _padded(number: Column, width: int) -> Column:
    # lpad would cut numbers wider than the field
    return F.lpad(number.cast("string"), F.greatest(F.lit(width), F.length(number.cast("string"))), F.lit("0"))


def _day(first: str, days: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), days.cast("int"))


def _moment(days: Column, seconds: Column) -> Column:
    start = F.lit("2026-01-01 08:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(days=days.cast("int"), secs=seconds.cast("decimal(18,6)"))


def _cents(number: Column) -> Column:
    return (number / 100).cast("decimal(16,2)")


def course_dept(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        (n * 10).alias("deptno"),
        F.concat(_pick(DEPARTMENTS, (n - 1) % 10), F.lit("_"), _padded(n, 3)).alias("dname"),
        _pick(CITIES, (n - 1) % 10).alias("loc"),
    )


def course_emp(rows: DataFrame, departments: int = 100) -> DataFrame:
    n = F.col("n")
    return rows.select(
        (n + 7000).alias("empno"),
        F.concat(_pick(PEOPLE, (n - 1) % 10), F.lit("_"), n.cast("string")).alias("ename"),
        _pick(JOBS, (n - 1) % 8).alias("job"),
        F.when(n > 10, 7000 + _div(n - 1, 10)).alias("mgr"),
        _day("1988-01-01", (n - 1) % 13000).cast("string").alias("hiredate"),
        (700 + (n * 37) % 49300).cast("double").alias("sal"),
        F.when(n % 3 == 0, 50 + (n * 11) % 950).cast("double").alias("commission"),
        (((n - 1) % departments + 1) * 10).alias("deptno"),
    )


def course_projects(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        n.alias("projectno"),
        F.concat(_pick(PROJECTS, (n - 1) % 10), F.lit("_"), _padded(n, 3)).alias("project_name"),
        (n * 10000).alias("budget"),
        (n * 100).alias("monthly_commission"),
    )


def course_emp_projects(rows: DataFrame, projects: int = 100, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every employee on every project: row numbers 1..emps*projects, no join needed.

    ``keep`` names columns of ``rows`` that each assignment takes along.
    """
    n = F.col("n")
    e, p = _div(n - 1, projects) + 1, (n - 1) % projects + 1
    start = (e + p) % 9000
    return rows.select(
        (n + 1000).alias("emp_projectno"),
        (e + 7000).alias("empno"),
        p.alias("projectno"),
        _day("1989-01-01", start).cast("string").alias("start_date"),
        F.when(p % 10 != 0, _day("1989-01-01", start + 365 + p % 90)).cast("string").alias("end_date"),
        *keep,
    )


def course_salgrade(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    low = 700 + (n - 1) * 50
    return rows.select(n.alias("grade"), low.alias("losal"), (low + 49).alias("hisal"))


def emp_updates(rows: DataFrame, label: str) -> DataFrame:
    n = F.col("n")
    return rows.select(
        (n + 7000).alias("empno"),
        F.concat(F.lit("senior_"), _pick(UPDATE_JOBS, n % 5)).alias("new_job"),
        (1000 + (n * 43) % 65000).cast("double").alias("new_sal"),
        F.when(n % 4 == 0, 100 + (n * 7) % 900).cast("double").alias("new_commission"),
        F.lit(f"{label}_salary_job_adjustment").alias("update_reason"),
    )


def io_rows(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        n.alias("record_id"),
        (1000 + n % 500).alias("product_id"),
        ((500 + (n * 17) % 50000) / 100).alias("amount"),
        F.concat(F.lit("2026-01-"), _padded(n % 28 + 1, 2)).alias("event_date"),
    )


def damaged_io_lines(rows: DataFrame) -> DataFrame:
    """CSV lines of ``io_rows``, four of five damaged by the row's number.

    1: an amount that is no number, 2: a field short, 3: a field too many, 4: a line that is no record.
    """
    kind = F.col("n") % 5
    row = io_rows(rows.select("n")).select(
        F.col("record_id").alias("n"),
        F.concat_ws(",", "record_id", "product_id").alias("ids"),
        F.when(F.col("record_id") % 5 == 1, "not_a_number").otherwise(F.col("amount").cast("string")).alias("amount"),
        "event_date",
    )
    line = (
        F.when(kind == 2, F.concat_ws(",", "ids", "amount"))
        .when(kind == 3, F.concat_ws(",", "ids", "amount", "event_date", F.lit("unexpected_column")))
        .when(kind == 4, F.lit("broken,row"))
        .otherwise(F.concat_ws(",", "ids", "amount", "event_date"))
    )
    return row.select(line.alias("value"))


def retail_location(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        n.alias("location_id"),
        F.concat(F.lit("location_"), _padded(n, 6)).alias("location_name"),
        _pick(REGIONS, n % 4).alias("region"),
    )


def retail_product(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        n.alias("product_id"),
        F.concat(F.lit("product_"), _padded(n, 8)).alias("product_name"),
        F.concat(F.lit("category_"), _padded(n % 20, 2)).alias("category"),
        _cents(500 + (n * 17) % 50000).cast("decimal(14,2)").alias("unit_price"),
        (n % 20 != 0).alias("active"),
    )


def retail_customer(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    pairs = len(FIRST_NAMES) * len(LAST_NAMES)
    round_no = _div(n - 1, pairs) + 1
    name = F.concat(
        _pick(FIRST_NAMES, (n - 1) % len(FIRST_NAMES)),
        F.lit(" "),
        _pick(LAST_NAMES, _div(n - 1, len(FIRST_NAMES)) % len(LAST_NAMES)),
        F.when(round_no > 1, F.concat(F.lit(" "), round_no.cast("string"))).otherwise(""),
    )
    return rows.select(
        n.alias("customer_id"),
        name.alias("customer_name"),
        F.concat(F.replace(F.lower(name), F.lit(" "), F.lit(".")), F.lit("@example.com")).alias("email"),
        (1 + (n - 1) % 100).alias("location_id"),
        _moment(n % 365, F.lit(0)).alias("created_at"),
    )


def retail_sales(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        n.alias("sale_id"),
        (1 + (n - 1) % 100_000).alias("customer_id"),
        (1 + (n - 1) % 1000).alias("product_id"),
        (1 + (n - 1) % 100).alias("location_id"),
        (1 + n % 10).cast("int").alias("quantity"),
        _cents(500 + (n * 17) % 50000).cast("decimal(14,2)").alias("unit_price"),
        _moment(n % 365, n % 86400).alias("sale_ts"),
    )


def retail_dept(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        (n * 10).alias("deptno"),
        F.concat(F.lit("department_"), _padded(n, 4)).alias("dname"),
        F.concat(F.lit("location_"), _padded(1 + (n - 1) % 100, 3)).alias("loc"),
    )


def retail_emp(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        (n + 7000).alias("empno"),
        F.concat(F.lit("employee_"), _padded(n, 9)).alias("ename"),
        _pick(RETAIL_JOBS, n % 4).alias("job"),
        F.when(n > 10, 7001 + (n - 1) % 10).alias("mgr"),
        _day("2000-01-01", n % 9000).alias("hiredate"),
        (1000 + (n * 43) % 65000).cast("decimal(14,2)").alias("sal"),
        F.when(n % 4 == 0, 100 + (n * 7) % 900).cast("decimal(14,2)").alias("commission"),
        ((1 + (n - 1) % 10) * 10).alias("deptno"),
    )


def retail_projects(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        n.alias("project_id"),
        F.concat(F.lit("project_"), _padded(n, 7)).alias("project_name"),
        (50_000 + (n * 997) % 5_000_000).cast("decimal(16,2)").alias("budget"),
        (1 + (n - 1) % 100).alias("location_id"),
    )


def retail_emp_projects(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    start = n % 2000
    return rows.select(
        n.alias("emp_project_id"),
        (7001 + (n - 1) % 100_000).alias("empno"),
        (1 + (n - 1) % 1000).alias("project_id"),
        _day("2020-01-01", start).alias("start_date"),
        F.when(n % 5 == 0, _day("2020-01-01", start + 180)).alias("end_date"),
    )


def retail_sales_transaction(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        n.alias("transaction_id"),
        (1 + (n - 1) % 100_000).alias("customer_id"),
        (1 + (n - 1) % 1000).alias("product_id"),
        (1 + (n - 1) % 100).alias("location_id"),
        _cents(500 + (n * 31) % 250_000).alias("amount"),
        _moment(n % 365, n % 86400).alias("transaction_ts"),
    )


RETAIL_GENERATORS = {
    "location": retail_location,
    "product": retail_product,
    "customer": retail_customer,
    "sales": retail_sales,
    "dept": retail_dept,
    "emp": retail_emp,
    "projects": retail_projects,
    "emp_projects": retail_emp_projects,
    "sales_transaction": retail_sales_transaction,
}


def change_records(rows: DataFrame, updates: int | Column) -> DataFrame:
    """U for the first ``updates`` ids, D for the rest."""
    n = F.col("n")
    is_update = n <= updates
    return rows.select(
        F.when(is_update, "U").otherwise("D").alias("operation"),
        n.alias("transaction_id"),
        F.when(is_update, _cents(10_000 + (n * 29) % 100_000)).alias("amount"),
        F.when(is_update, _moment(n % 365, n % 86400)).alias("transaction_ts"),
        _moment(F.lit(400), n % 86400).alias("change_ts"),
    )
