"""Nine banking tables per batch date, from customer numbers and dates.

Shapes and ratios follow the feed; the draws come from an integer mix of the
row's numbers, so every run and every partitioning gives the same rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word lists, plans and loan types of the feed.
FIRST_NAMES = ("Aarav", "Isha", "Rohan", "Meera", "Vikram", "Anika", "Jay", "Divya", "Kiran", "Neha")
LAST_NAMES = ("Sharma", "Patel", "Rao", "Iyer", "Khan", "Mehta", "Nair", "Reddy", "Gupta", "Das")
CITIES = ("Mumbai", "Delhi", "Bengaluru", "Hyderabad", "Chennai", "Pune", "Kolkata", "Ahmedabad")
EMPLOYERS = ["Northstar Retail", "Metro Health", "Bright Finance", "Urban Logistics"]
CHANNELS = ("upi", "debit_card", "net_banking", "atm", "branch")
MERCHANTS = ("salary", "grocery", "fuel", "emi", "shopping", "transfer")
PRINCIPALS = [75_000, 250_000, 850_000, 3_500_000, 6_500_000]
MONTHS = [24, 36, 60, 120]
PLANS = [
    (1, "salary_savings_standard", "savings", 3.25),
    (2, "salary_savings_premium", "savings", 4.10),
    (3, "everyday_checking", "checking", 0.00),
    (4, "fixed_deposit_1_year", "fixed_deposit", 6.75),
    (5, "fixed_deposit_3_year", "fixed_deposit", 7.15),
]
LOAN_TYPES = [
    (1, "personal", 12.5, "N"),
    (2, "auto", 9.0, "Y"),
    (3, "home", 8.2, "Y"),
    (4, "credit_card", 36.0, "N"),
]

MODULUS = 2_147_483_648


def draw(number: Column, salt: int, sides: int) -> Column:
    """A number in 0..sides-1 that looks unrelated for neighbouring rows and salts."""
    mixed = (number % MODULUS + salt * 7919) % MODULUS * 1_103_515_245 % MODULUS
    mixed = (F.floor(mixed / 1024) + mixed * 31 + salt) % MODULUS * 69_069 % MODULUS
    return F.floor(mixed / 2048) % sides


def pick(words: list, number: Column, salt: int) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (draw(number, salt, len(words)) + 1).cast("int"))


def _date_number(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("long")


def _with_dates(rows: DataFrame, days: list[date]) -> DataFrame:
    """Each row once per day."""
    return rows.withColumn("batch_date", F.explode(F.array(*[F.lit(d) for d in days])))


def _row_draw(key: str) -> Column:
    return F.col(key) + F.datediff("batch_date", F.lit("2020-01-01").cast("date")).cast("long") * 1_000_003


def customers(rows: DataFrame) -> DataFrame:
    c = F.col("customer_id")
    return rows.select(
        c,
        pick(FIRST_NAMES, c, 1).alias("first_name"),
        pick(LAST_NAMES, c, 2).alias("last_name"),
        pick(CITIES, c, 3).alias("city"),
        pick(EMPLOYERS, c, 4).alias("employer"),
        F.when(draw(c, 5, 4) < 3, "verified").otherwise("pending").alias("kyc_status"),
        F.date_add(F.lit("2024-01-01").cast("date"), (c % 700).cast("int")).alias("created_date"),
    )


def accounts(rows: DataFrame) -> DataFrame:
    c = F.col("customer_id")
    return rows.select(
        (c + 100_000).alias("account_id"),
        c,
        (draw(c, 6, 3) + 1).alias("plan_id"),
        F.when(draw(c, 7, 4) < 3, "active").otherwise("inactive").alias("account_status"),
        F.date_add(F.lit("2024-01-01").cast("date"), (c % 700).cast("int")).alias("open_date"),
        ((100_000 + draw(c, 8, 24_900_000 // 24) * 24) / 100).cast("double").alias("current_balance"),
    )


def loans(rows: DataFrame) -> DataFrame:
    """One customer in five has a loan."""
    c = F.col("customer_id")
    loan = (c - 1) / 5 + 500_001
    principal = pick(PRINCIPALS, c, 10)
    return rows.where((c - 1) % 5 == 0).select(
        loan.cast("long").alias("loan_id"),
        c,
        (draw(c, 9, 4) + 1).alias("loan_type_id"),
        principal.cast("long").alias("principal_amount"),
        F.round(principal / pick(MONTHS, c, 11), 2).cast("double").alias("emi_amount"),
        F.date_add(F.lit("2025-01-01").cast("date"), (loan.cast("long") % 300).cast("int")).alias("start_date"),
        F.when(draw(c, 12, 4) < 3, "active").otherwise("closed").alias("loan_status"),
    )


def account_plans(spark) -> DataFrame:
    return spark.createDataFrame(
        PLANS, "plan_id bigint, plan_name string, account_type string, interest_rate double"
    )


def loan_types(spark) -> DataFrame:
    return spark.createDataFrame(
        LOAN_TYPES, "loan_type_id bigint, loan_type string, annual_rate double, secured_flag string"
    )


def salary_deposits(account_rows: DataFrame, days: list[date]) -> DataFrame:
    """22 in 100 salary accounts per date."""
    x, d = _row_draw("account_id"), F.col("batch_date")
    return (
        _with_dates(account_rows.where(F.col("plan_id").isin(1, 2)), days)
        .where(draw(x, 20, 100) < 22)
        .select(
            (_date_number(d) * 100_000_000_000 + F.col("account_id")).alias("deposit_id"),
            "account_id",
            "customer_id",
            F.date_format(d, "yyyy-MM").alias("salary_month"),
            d.alias("deposit_date"),
            (25_000 + draw(x, 21, 225_000)).cast("double").alias("amount"),
            F.concat(F.lit("PAY"), F.date_format(d, "yyyyMMdd"), F.col("account_id").cast("string")).alias(
                "employer_reference"
            ),
            "batch_date",
        )
    )


def loan_payments(loan_rows: DataFrame, days: list[date]) -> DataFrame:
    """18 in 100 loans per date, one payment in four fails."""
    x, d = _row_draw("loan_id"), F.col("batch_date")
    return (
        _with_dates(loan_rows, days)
        .where(draw(x, 30, 100) < 18)
        .select(
            (_date_number(d) * 100_000_000_000 + F.col("loan_id")).alias("payment_id"),
            "loan_id",
            "customer_id",
            d.alias("payment_date"),
            F.col("emi_amount").alias("amount"),
            F.when(draw(x, 31, 4) < 3, "paid").otherwise("failed").alias("payment_status"),
            pick(CHANNELS, x, 32).alias("channel"),
            "batch_date",
        )
    )


def payment_reminders(loan_rows: DataFrame, days: list[date]) -> DataFrame:
    """8 in 100 loans per date."""
    x, d = _row_draw("loan_id"), F.col("batch_date")
    return (
        _with_dates(loan_rows, days)
        .where(draw(x, 40, 100) < 8)
        .select(
            (_date_number(d) * 100_000_000_000 + F.col("loan_id")).alias("reminder_id"),
            "loan_id",
            "customer_id",
            d.alias("reminder_date"),
            pick(["sms", "email", "app_notification"], x, 41).alias("reminder_type"),
            pick(["emi_due", "payment_failed", "statement_ready"], x, 42).alias("reason"),
            "batch_date",
        )
    )


def account_transactions(account_rows: DataFrame, days: list[date]) -> DataFrame:
    """0 to 3 transactions per active account and date."""
    x, d, t = _row_draw("account_id"), F.col("batch_date"), F.col("txn_no")
    y = x * 4 + t
    return (
        _with_dates(account_rows.where("account_status = 'active'"), days)
        .withColumn("txn_no", F.explode(F.expr("sequence(0L, 2L)")))
        .where(t < draw(x, 50, 4))
        .select(
            (_date_number(d) * 100_000_000_000 + F.col("account_id") * 10 + t).alias("transaction_id"),
            "account_id",
            "customer_id",
            d.alias("transaction_date"),
            F.when(draw(y, 51, 2) == 0, "debit").otherwise("credit").alias("transaction_type"),
            ((10_000 + draw(y, 52, 1_000_000) * 2) / 100).cast("double").alias("amount"),
            pick(CHANNELS, y, 53).alias("channel"),
            pick(MERCHANTS, y, 54).alias("merchant_category"),
            "batch_date",
        )
    )


def banking_tables(customer_ids: DataFrame, days: list[date]) -> dict[str, DataFrame]:
    """All nine tables with ``batch_date``; master tables repeat on every date.

    ``customer_ids`` has ``customer_id`` counting from 1.
    """
    spark = customer_ids.sparkSession
    people, holders, borrowers = customers(customer_ids), accounts(customer_ids), loans(customer_ids)
    return {
        "customers": _with_dates(people, days),
        "account_plans": _with_dates(account_plans(spark), days),
        "accounts": _with_dates(holders, days),
        "loan_types": _with_dates(loan_types(spark), days),
        "loans": _with_dates(borrowers, days),
        "salary_deposits": salary_deposits(holders, days),
        "loan_payments": loan_payments(borrowers, days),
        "payment_reminders": payment_reminders(borrowers, days),
        "account_transactions": account_transactions(holders, days),
    }
