"""Generator formulas against known totals."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loomgrain.contracts import COURSE, RETAIL
from loomgrain.operators.bands import band_join
from loomgrain.operators.updates import change_counts, latest_changes, merge_changes
from loomgrain.queries import QUERIES
from loomgrain.queries.registry import Tables
from loomgrain.sources import banking, generators as gen


@pytest.fixture(scope="module")
def emp(spark):
    return gen.course_emp(gen.row_numbers(spark, 1000)).cache()


def test_course_totals(emp):
    row = emp.agg(
        F.count("*"), F.count("commission"), F.sum("sal"), F.min("sal"), F.max("sal"),
        F.sum(F.coalesce("commission", F.lit(0))), F.min("hiredate"), F.max("hiredate"),
    ).first()
    assert tuple(row) == (1000, 333, 19218500.0, 737.0, 37700.0, 171263.0, "1988-01-01", "1990-09-26")


@pytest.mark.parametrize(
    "predicate, expected",
    [
        ("sal >= 3000", 938),
        ("sal BETWEEN 2000 AND 3000", 27),
        ("sal < 1200", 13),
        ("job = 'manager'", 125),
        ("deptno IN (10, 30)", 20),
        ("ename LIKE 'a%'", 100),
        ("ename NOT LIKE '%_1%'", 728),
    ],
)
def test_course_filters(emp, predicate, expected):
    assert emp.where(predicate).count() == expected


def test_course_set_operations(emp):
    sellers = emp.where("job = 'salesman'").select("empno", "ename")
    paid = emp.where("sal >= 3000").select("empno", "ename")
    assert sellers.union(paid).distinct().count() == 946
    assert sellers.union(paid).count() == 1063
    assert sellers.intersect(paid).count() == 117
    assert sellers.subtract(paid).count() == 8


def test_course_grades(spark, emp):
    grades = gen.course_salgrade(gen.row_numbers(spark, 1000))
    graded = band_join(emp, grades, "sal", "losal", "hisal")
    assert graded.count() == 1000
    first = {r["empno"]: r["grade"] for r in graded.where("empno <= 7004").collect()}
    assert first == {7001: 1, 7002: 2, 7003: 3, 7004: 3}


def test_course_groups(emp):
    grouped = emp.groupBy("deptno").agg(F.count("*").alias("n"), F.avg("sal").alias("a"), F.sum("sal").alias("s"))
    first = [tuple(r) for r in grouped.orderBy("deptno").limit(2).collect()]
    assert first == [(10, 10, 17387.0, 173870.0), (20, 10, 17424.0, 174240.0)]
    assert grouped.where("s > 15000").count() == 100


def test_course_shapes(spark):
    rows = gen.row_numbers(spark, 200)
    made = {
        "dept": gen.course_dept(rows),
        "emp": gen.course_emp(rows),
        "projects": gen.course_projects(rows),
        "emp_projects": gen.course_emp_projects(rows),
        "salgrade": gen.course_salgrade(rows),
    }
    for name, df in made.items():
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == list(COURSE[name].columns)
    bridge = made["emp_projects"].where("emp_projectno IN (1010, 1101)").orderBy("emp_projectno").collect()
    assert tuple(bridge[0]) == (1010, 7001, 10, "1989-01-12", None)
    assert tuple(bridge[1]) == (1101, 7002, 1, "1989-01-04", "1990-01-05")
    assert made["dept"].where("deptno = 20").first()["dname"] == "research_002"


def test_retail_shapes_and_values(spark):
    rows = gen.row_numbers(spark, 500)
    for name, make in gen.RETAIL_GENERATORS.items():
        df = make(rows)
        expected = [(n, t.replace("timestamp", "timestamp_ntz")) for n, t in RETAIL[name].columns]
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == expected, name
    product = gen.retail_product(rows).where("product_id = 20").first()
    assert tuple(product) == (20, "product_00000020", "category_00", Decimal("8.40"), False)
    people = {r["customer_id"]: (r["customer_name"], r["email"]) for r in gen.retail_customer(rows).collect()}
    assert people[1] == ("Aarav Anderson", "aarav.anderson@example.com")
    assert people[401] == ("Aarav Anderson 2", "aarav.anderson.2@example.com")
    sale = gen.retail_sales(rows).where("sale_id = 366").first()
    assert sale["sale_ts"] == dt.datetime(2026, 1, 2, 8, 6, 6)
    assert gen.retail_emp(rows).where("empno = 7004").first()["commission"] == Decimal("128.00")


def test_change_run_reaches_the_known_counts(spark):
    base = gen.retail_sales_transaction(gen.row_numbers(spark, 200_000))
    changes = gen.change_records(gen.row_numbers(spark, 110_000), 100_000)
    latest = latest_changes(changes, ["transaction_id"])
    counts = change_counts(base, latest, ["transaction_id"]).first()
    assert (counts["updated"], counts["deleted"], counts["unmatched"]) == (100_000, 10_000, 0)
    merged = merge_changes(base, latest, ["transaction_id"], ["amount", "transaction_ts"])
    assert merged.count() == 190_000
    assert merged.where("transaction_id = 1").first()["amount"] == Decimal("100.29")


def test_orphans_of_the_large_sales(spark):
    sales = gen.retail_sales(gen.row_numbers(spark, 200_000))
    rows = gen.row_numbers(spark, 200)
    for key, parent, expected in (
        ("customer_id", gen.retail_customer(rows), 199_600),
        ("product_id", gen.retail_product(rows), 160_000),
        ("location_id", gen.retail_location(rows), 0),
    ):
        per_key = sales.groupBy(key).count().join(parent.select(key), key, "left_anti")
        assert (per_key.agg(F.sum("count")).first()[0] or 0) == expected


def test_banking_feed(spark):
    people = spark.range(1, 1001).withColumnRenamed("id", "customer_id")
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(7)]
    tables = banking.banking_tables(people, days)
    sizes = {name: df.count() for name, df in tables.items()}
    assert sizes["customers"] == 7000 and sizes["accounts"] == 7000 and sizes["loans"] == 1400
    assert sizes["account_plans"] == 35 and sizes["loan_types"] == 28
    salaried = tables["accounts"].where("plan_id IN (1, 2)").count()
    assert abs(sizes["salary_deposits"] / salaried - 0.22) < 0.03
    assert abs(sizes["loan_payments"] / 1400 - 0.18) < 0.05
    assert abs(sizes["payment_reminders"] / 1400 - 0.08) < 0.04
    for name, key in (("salary_deposits", "deposit_id"), ("account_transactions", "transaction_id")):
        assert tables[name].select(key).distinct().count() == sizes[name]


def test_negative_row_count(spark):
    with pytest.raises(ValueError):
        gen.row_numbers(spark, -1)


def projects_of(spark, folder, keys):
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    return QUERIES["gen_course_projects"].build(Tables(spark, str(folder)))


def test_project_sums_of_repeated_and_missing_keys(spark, tmp_path):
    keys = [0, 4, 4, 8995, None]
    expected = []
    for p in range(1, 101):
        # an employee that comes twice meets both of its salaries on both of its assignments
        met = [(k + 1, 700 + (k + 1) * 37 % 49300) for k in keys if k is not None for other in keys if other == k]
        starts = [dt.date(1989, 1, 1) + dt.timedelta(days=(n + p) % 9000) for n, _ in met]
        ends = [dt.date(1989, 1, 1) + dt.timedelta(days=(n + p) % 9000 + 365 + p % 90) for n, _ in met if p % 10]
        last = str(max(ends)) if ends else None
        expected.append((p, len(met), len(ends), str(min(starts)), str(max(starts)), last, float(sum(s for _, s in met))))
    columns = ["projectno", "assigned", "ended", "first_start", "last_start", "last_end", "sal"]
    found = projects_of(spark, tmp_path, keys).select(*columns)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_assignments_are_summed_up_where_they_are_made(spark, tmp_path):
    plan = projects_of(spark, tmp_path, range(50))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    lines = plan.splitlines()
    made = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    # plans print from the end: only the sums per project move after the assignments are made
    moved = [line for line in lines[:made] if "Exchange hashpartitioning" in line]
    assert moved and all("hashpartitioning(projectno" in line for line in moved)
    assert any("Join" in line and "[n#" in line for line in lines[made:])
