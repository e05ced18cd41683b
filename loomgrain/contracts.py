"""Table contracts: columns, types, keys, nullable columns and load order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    nullable: frozenset[str] = frozenset()
    is_fact: bool = False

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def required(self) -> list[str]:
        return sorted(set(self.names) - self.nullable)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in self.columns))

    @property
    def text_schema(self) -> T.StructType:
        """Every column as text, plus the column that keeps unparsable records."""
        fields = [T.StructField(n, T.StringType()) for n in self.names]
        return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])

    @property
    def capture_schema(self) -> T.StructType:
        """Declared types, plus the column that keeps unparsable records."""
        return T.StructType([*self.schema.fields, T.StructField(CORRUPT, T.StringType())])


def contract(
    name: str, columns: dict[str, str], key: str, nullable: tuple[str, ...] = (), is_fact: bool = False
) -> Contract:
    """``contract("dept", {"deptno": "bigint", "dname": "string"}, key="deptno")``"""
    return Contract(name, tuple(columns.items()), (key,), frozenset(nullable), is_fact)


def by_name(*contracts: Contract) -> dict[str, Contract]:
    return {c.name: c for c in contracts}


# Column names, types, keys and nullable columns of the retail tables.
RETAIL = by_name(
    contract("location", {"location_id": "bigint", "location_name": "string", "region": "string"}, "location_id"),
    contract(
        "product",
        {
            "product_id": "bigint",
            "product_name": "string",
            "category": "string",
            "unit_price": "decimal(14,2)",
            "active": "boolean",
        },
        "product_id",
    ),
    contract(
        "customer",
        {
            "customer_id": "bigint",
            "customer_name": "string",
            "email": "string",
            "location_id": "bigint",
            "created_at": "timestamp",
        },
        "customer_id",
        nullable=("email", "location_id"),
    ),
    contract(
        "sales",
        {
            "sale_id": "bigint",
            "customer_id": "bigint",
            "product_id": "bigint",
            "location_id": "bigint",
            "quantity": "int",
            "unit_price": "decimal(14,2)",
            "sale_ts": "timestamp",
        },
        "sale_id",
        is_fact=True,
    ),
    contract("dept", {"deptno": "bigint", "dname": "string", "loc": "string"}, "deptno"),
    contract(
        "projects",
        {"project_id": "bigint", "project_name": "string", "budget": "decimal(16,2)", "location_id": "bigint"},
        "project_id",
    ),
    contract(
        "emp",
        {
            "empno": "bigint",
            "ename": "string",
            "job": "string",
            "mgr": "bigint",
            "hiredate": "date",
            "sal": "decimal(14,2)",
            "commission": "decimal(14,2)",
            "deptno": "bigint",
        },
        "empno",
        nullable=("mgr", "commission"),
        is_fact=True,
    ),
    contract(
        "emp_projects",
        {
            "emp_project_id": "bigint",
            "empno": "bigint",
            "project_id": "bigint",
            "start_date": "date",
            "end_date": "date",
        },
        "emp_project_id",
        nullable=("end_date",),
        is_fact=True,
    ),
    contract(
        "sales_transaction",
        {
            "transaction_id": "bigint",
            "customer_id": "bigint",
            "product_id": "bigint",
            "location_id": "bigint",
            "amount": "decimal(16,2)",
            "transaction_ts": "timestamp",
        },
        "transaction_id",
        is_fact=True,
    ),
)

# Column names, types, keys and nullable columns of the course tables.
COURSE = by_name(
    contract("dept", {"deptno": "bigint", "dname": "string", "loc": "string"}, "deptno"),
    contract(
        "emp",
        {
            "empno": "bigint",
            "ename": "string",
            "job": "string",
            "mgr": "bigint",
            "hiredate": "string",
            "sal": "double",
            "commission": "double",
            "deptno": "bigint",
        },
        "empno",
        nullable=("mgr", "commission"),
    ),
    contract(
        "projects",
        {"projectno": "bigint", "project_name": "string", "budget": "bigint", "monthly_commission": "bigint"},
        "projectno",
    ),
    contract(
        "emp_projects",
        {
            "emp_projectno": "bigint",
            "empno": "bigint",
            "projectno": "bigint",
            "start_date": "string",
            "end_date": "string",
        },
        "emp_projectno",
        nullable=("end_date",),
    ),
    contract("salgrade", {"grade": "bigint", "losal": "bigint", "hisal": "bigint"}, "grade"),
)

# Columns, types and key of the change records.
CHANGES = contract(
    "sales_transaction_changes",
    {
        "operation": "string",
        "transaction_id": "bigint",
        "amount": "decimal(16,2)",
        "transaction_ts": "timestamp",
        "change_ts": "timestamp",
    },
    "transaction_id",
    nullable=("amount", "transaction_ts"),
)

# Columns, types and key of the input/output fixtures.
IO_ROWS = contract(
    "io_rows",
    {"record_id": "bigint", "product_id": "bigint", "amount": "double", "event_date": "string"},
    "record_id",
)

# Columns and types of the load audit.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("scenario", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("source_format", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("source_files", T.LongType()),
        T.StructField("accepted_rows", T.LongType()),
        T.StructField("rejected_rows", T.LongType()),
        T.StructField("read_seconds", T.DecimalType(14, 3)),
        T.StructField("write_seconds", T.DecimalType(14, 3)),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
    ]
)

# Dependency order of the retail loads.
LOAD_ORDER = ("location", "product", "customer", "sales", "dept", "projects", "emp", "emp_projects", "sales_transaction")

# Scenario number -> (folder, dataset, tables).
SCENARIOS = {
    "01": ("01_many_small_json_customer", "01_json_small_customer", ("customer",)),
    "02": (
        "02_many_small_json_multiple_tables",
        "02_json_small_multi",
        ("location", "product", "customer", "sales"),
    ),
    "03": ("03_many_large_json_sales", "03_json_large_sales", ("sales",)),
    "04": ("04_many_small_csv_emp", "04_csv_small_emp", ("emp",)),
    "05": (
        "05_many_small_csv_multiple_tables",
        "05_csv_small_multi",
        ("dept", "projects", "emp", "emp_projects"),
    ),
    "06": ("06_many_large_csv_emp", "06_csv_large_emp", ("emp",)),
    "07": ("07_many_small_parquet_transaction", "07_parquet_small_sales_transaction", ("sales_transaction",)),
    "08": (
        "08_many_small_parquet_multiple_tables",
        "08_parquet_small_multi",
        ("location", "product", "customer", "sales"),
    ),
    "09": ("09_many_large_parquet_sales", "09_parquet_large_sales", ("sales",)),
    "10": ("10_ultra_one_million_files", "10_ultra_sales_transaction", ("sales_transaction",)),
}
