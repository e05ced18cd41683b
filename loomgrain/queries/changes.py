"""Change records derived from the orders."""

from pyspark.sql import functions as F

from loomgrain.functions.values import money

c = F.col


def order_transactions(t):
    """The orders as transactions: the base that changes apply to."""
    return t["orders"].select(
        c("o_orderkey").alias("transaction_id"),
        c("o_custkey").alias("customer_id"),
        money("o_totalprice").cast("decimal(16,2)").alias("amount"),
        c("o_orderdate").alias("transaction_ts"),
    )


def order_changes(t):
    """Text change records over all orders, by last digit of the key.

    0: two updates, the newer adds 5 to the price. 1: an update, then a delete.
    2: an unknown operation. 3: an update without an amount. 4: a key that is
    no number. 5: no change time. 6: an update of a key the orders do not have.
    """
    digit = c("o_orderkey") % 10
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    price = money("o_totalprice")
    key = c("o_orderkey").cast("string")

    def change(operation, key, amount, ts, change_ts):
        return F.struct(
            F.lit(operation).alias("operation"),
            key.alias("transaction_id"),
            amount.cast("string").alias("amount"),
            ts.alias("transaction_ts"),
            change_ts.alias("change_ts"),
        )

    none = F.lit(None).cast("string")
    early, late = F.lit("2026-02-05 08:00:00"), F.lit("2026-02-05 09:00:00")
    entries = (
        F.when(digit == 0, F.array(change("U", key, price + 1, day, early), change(" u ", key, price + 5, day, late)))
        .when(digit == 1, F.array(change("U", key, price + 1, day, early), change("D", key, none, none, late)))
        .when(digit == 2, F.array(change("X", key, price, day, early)))
        .when(digit == 3, F.array(change("U", key, none, day, early)))
        .when(digit == 4, F.array(change("U", F.concat(F.lit("k"), key), price, day, early)))
        .when(digit == 5, F.array(change("D", key, none, none, none)))
        .when(digit == 6, F.array(change("U", (-1 - c("o_orderkey")).cast("string"), price, day, early)))
    )
    return t["orders"].select(F.inline(entries))
