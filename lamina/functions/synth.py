"""Seeded tables of accounts, customers and transactions.

Every value follows from the row id, the column's name and the seed, so a table is the same however it
is partitioned, and a task that runs again makes the same rows. Rows come from any table with a long
``id``: ``spark.range`` or a real one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamina.columns import col, free_name
from lamina.functions.hashing import unit
from lamina.session import work_dir

# Choice lists of the source tables.
ACCOUNT_TYPES = ("individual", "joint", "trust", "custodial")
MARGIN = ("yes", "no", "pending", "restricted")
RISK = ("low", "medium", "high")
TRANSACTION_TYPES = (
    "buy", "sell", "deposit", "withdrawal", "fee", "split", "dividend", "interest",
)
ORDER_TYPES = (
    "market", "limit", "stop", "stop_limit", "fill_or_kill", "immediate_or_cancel", "day",
    "trailing_stop",
)
TRADE_STATUS = ("open", "filled", "canceled", "rejected", "expired")
TICKERS = ("BLK", "SCHW", "MS", "GS", "AMP", "TROW", "NTRS", "STT", "UBS", "BAC", "JPM")

# States with the latitude and longitude around which their customers lie.
STATES = (
    ("CA", 34.0522, -118.2437),
    ("NY", 40.7128, -74.0060),
    ("TX", 29.7604, -95.3698),
    ("VA", 38.8951, -77.0369),
    ("IL", 41.8781, -87.6298),
    ("FL", 27.9944, -81.7603),
    ("WA", 47.7511, -120.7401),
    ("MA", 42.4072, -71.3824),
    ("CO", 39.5501, -105.7821),
    ("AZ", 33.4484, -112.0740),
    ("AL", 32.8067, -86.7911),
    ("AR", 34.9697, -92.3731),
    ("CT", 41.5978, -72.7554),
    ("DE", 39.3185, -75.5071),
    ("GA", 33.0406, -83.6431),
    ("ID", 43.6150, -116.2311),
    ("IA", 41.5978, -93.09),
    ("KS", 39.0119, -98.4852),
    ("KY", 37.6681, -84.219),
    ("LA", 30.4636, -91.1893),
    ("MD", 39.1619, -76.5765),
    ("ME", 45.2538, -69.4454),
    ("MI", 42.7297, -84.654),
    ("MN", 46.7296, -94.6859),
    ("MO", 39.0119, -94.57),
    ("MS", 32.3182, -90.2072),
    ("NC", 35.7721, -79.0143),
    ("ND", 47.5080, -100.9341),
    ("NE", 41.1495, -98.2680),
    ("NH", 43.1630, -70.8433),
    ("NM", 34.5224, -105.8074),
    ("NV", 36.1627, -115.1628),
    ("OH", 40.4173, -82.9071),
    ("OK", 35.4676, -97.5164),
    ("OR", 45.5753, -122.8296),
    ("PA", 40.4406, -79.9959),
    ("RI", 41.8240, -71.4128),
    ("SC", 33.7323, -80.4592),
    ("SD", 44.3679, -100.3366),
    ("TN", 35.7664, -86.8024),
    ("UT", 39.3209, -111.0937),
    ("VT", 44.2656, -72.5778),
    ("WI", 43.0721, -89.3801),
    ("WV", 38.6495, -80.0081),
    ("WY", 42.7275, -107.2368),
)


def row_ids(spark: SparkSession, rows: int, partitions: int = 4) -> DataFrame:
    return spark.range(0, rows, 1, partitions)


def _below(name: str, seed: int, n: int | Column) -> Column:
    """A whole number from 0 to ``n - 1``."""
    return F.floor(unit(name, seed) * n).cast("bigint")


def choice(name: str, seed: int, values: Sequence[str]) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, _below(name, seed, len(values)).cast("int")).alias(name)


def cycled_account(first: int, count: int) -> Column:
    return _account_id(F.pmod(F.col("id"), F.lit(count)) + F.lit(first)).alias("acct_id")


def random_account(seed: int, first: int, count: int) -> Column:
    return _account_id(_below("acct_id", seed, count) + F.lit(first)).alias("acct_id")


def _account_id(number: Column) -> Column:
    # The parts of an account id.
    return F.concat(F.lit("00"), number.cast("string"), F.lit("A000000U5DtWAOV"))


def numbered(name: str, seed: int, prefix: str, first: int, count: int) -> Column:
    return F.concat(F.lit(prefix), (_below(name, seed, count) + F.lit(first)).cast("string")).alias(
        name
    )


def uniform_int(name: str, seed: int, low: int, high: int) -> Column:
    return (_below(name, seed, high - low + 1) + F.lit(low)).cast("int").alias(name)


def uniform_double(name: str, seed: int, low: float, high: float) -> Column:
    return (F.lit(low) + unit(name, seed) * F.lit(high - low)).alias(name)


def uniform_timestamp(name: str, seed: int, begin: str, end: str) -> Column:
    """A whole second from ``begin`` to ``end``, both in UTC and inclusive."""
    low, high = (
        int(datetime.fromisoformat(t).replace(tzinfo=timezone.utc).timestamp()) for t in (begin, end)
    )
    return F.timestamp_seconds(_below(name, seed, high - low + 1) + F.lit(low)).alias(name)


def _jitter(name: str, seed: int) -> Column:
    return unit(name, seed) / F.lit(50.0) - F.lit(0.01)


def choose_from(
    df: DataFrame, dimension: DataFrame, column: str, name: str, seed: int
) -> DataFrame:
    """Add a value of a dimension table to each row, by a join on the value's place in order.

    The dimension may be of any length. Its values are sorted over all tasks and stored with the place
    each has in its task; the tasks' counts, one row each, give how many stand before a task's first.
    """
    spark = df.sparkSession
    folder = work_dir(spark, "choices")
    pick, place, task = (free_name(n, df) for n in ("pick", "place", "task"))
    dimension.select(col(column).alias(name)).where(F.col(name).isNotNull()).distinct().orderBy(
        col(name)
    ).withColumn(place, F.monotonically_increasing_id()).write.mode("overwrite").parquet(folder)
    # The upper bits of these ids are the task, the lower 33 count its rows.
    values = spark.read.parquet(folder).select(
        col(name),
        F.shiftright(place, 33).alias(task),
        F.col(place).bitwiseAND((1 << 33) - 1).alias(place),
    )
    upto = Window.orderBy(task).rowsBetween(Window.unboundedPreceding, 0)
    counts = values.groupBy(task).agg(F.count("*").alias(pick))
    before = counts.select(task, (F.sum(pick).over(upto) - F.col(pick)).alias(pick))
    placed = values.join(before, task).select(
        col(name), (F.col(pick) + F.col(place)).alias(pick)
    )
    size = values.agg(F.count("*").alias("n")).scalar()
    return df.withColumn(pick, _below(name, seed, size)).join(placed, pick).drop(pick)


@dataclass(frozen=True)
class From:
    """How a column is made from the columns that it ``needs``.

    ``value`` is SQL text, an expression, or a function that adds the column to a table, by a join for
    instance. A column that isn't ``shown`` only serves others.
    """

    needs: tuple[str, ...]
    value: str | Column | Callable[[DataFrame], DataFrame]
    shown: bool = True


Spec = Mapping[str, Column | From]


def layers(spec: Spec) -> list[list[str]]:
    """The columns of ``spec``, each layer needing only what ``id`` and the layers before it give.

    ``ValueError`` for names that differ in case alone, for needs that nothing makes, and for columns
    that need each other in a circle.
    """
    names = {"id", *(n.lower() for n in spec)}
    if len(names) != len(spec) + 1:
        raise ValueError("columns of a spec must differ, and none may be called id")
    needs = {n: {x.lower() for x in v.needs} if isinstance(v, From) else set() for n, v in spec.items()}
    for name, needed in needs.items():
        if unknown := sorted(needed - names):
            raise ValueError(f"{name} needs {', '.join(unknown)}, which nothing makes")
    made, found = {"id"}, []
    while len(made) < len(names):
        layer = [n for n in spec if n.lower() not in made and needs[n] <= made]
        if not layer:
            raise ValueError(f"in a circle: {', '.join(n for n in spec if n.lower() not in made)}")
        found.append(layer)
        made.update(n.lower() for n in layer)
    return found


def synthesize(ids: DataFrame, spec: Spec) -> DataFrame:
    """``id`` and the shown columns of ``spec`` in its order, whatever order they are made in.

    One projection makes all expressions of a layer. Functions of a layer come first, while the table has
    the fewest columns to move.
    """
    df = ids.select("id")
    for layer in layers(spec):
        values = {n: v.value if isinstance(v := spec[n], From) else v for n in layer}
        for value in values.values():
            if not isinstance(value, (str, Column)):
                df = value(df)
        plain = {n: v for n, v in values.items() if isinstance(v, (str, Column))}
        if plain:
            df = df.select("*", *[(F.expr(v) if isinstance(v, str) else v).alias(n) for n, v in plain.items()])
    shown = [n for n, v in spec.items() if not isinstance(v, From) or v.shown]
    return df.select("id", *[col(n) for n in shown])


# Prefixes, places, texts and date ranges in the three tables below.


def accounts(ids: DataFrame, seed: int, first: int = 1, count: int = 1000) -> DataFrame:
    spec = {
        "acct_id": cycled_account(first, count),
        "acct_name": numbered("acct_name", seed, "acct_", first, count),
        "acct_number": uniform_int("acct_number", seed, 1_000_000_000, 2_000_000_000),
        "acct_type": choice("acct_type", seed, ACCOUNT_TYPES),
        "balance": uniform_double("balance", seed, 500_000.0, 2_500_000.0),
        "acct_status": F.lit("open"),
        "open_date": uniform_timestamp("open_date", seed, "2020-01-01 00:00:00", "2021-12-31 23:59:59"),
        "closed_date": uniform_timestamp("closed_date", seed, "2080-01-01 00:00:00", "2800-12-31 23:59:59"),
        "margin_enabled": choice("margin_enabled", seed, MARGIN),
        "risk_tolerance": choice("risk_tolerance", seed, RISK),
        "created_date": uniform_timestamp("created_date", seed, "2022-01-01 00:00:00", "2024-12-31 23:59:59"),
    }
    return synthesize(ids, spec)


def customers(ids: DataFrame, seed: int, first: int = 1, count: int = 1000) -> DataFrame:
    states = ids.sparkSession.createDataFrame(STATES, "state_cd STRING, lat DOUBLE, lon DOUBLE")
    places = F.broadcast(states.select("state_cd", F.struct("lat", "lon").alias("place")))
    spec = {
        "customer_id": F.concat(F.lit("1000000"), F.col("id").cast("string")),
        "first_name": numbered("first_name", seed, "customer_", first, count),
        "last_name": numbered("last_name", seed, "custlastname_", first, count),
        "email": F.concat(F.lit("user"), F.col("id").cast("string"), F.lit("@demo.com")),
        "phone_number": F.concat(F.lit("+1-555-"), F.lpad((F.col("id") % 10000).cast("string"), 4, "0")),
        "acct_id": cycled_account(first, count),
        "state_cd": choice("state_cd", seed, [code for code, _, _ in STATES]),
        "place": From(("state_cd",), lambda df: df.join(places, "state_cd"), shown=False),
        "latitude": From(("place",), F.col("place.lat") + _jitter("latitude", seed)),
        "longitude": From(("place",), F.col("place.lon") + _jitter("longitude", seed)),
        "country_cd": F.lit("US"),
        "created_at": uniform_timestamp("created_at", seed, "2022-01-01 00:00:00", "2024-12-31 23:59:59"),
    }
    return synthesize(ids, spec)


def transactions(
    ids: DataFrame, tickers: DataFrame, seed: int, first: int = 1, count: int = 1000
) -> DataFrame:
    """``tickers`` has a column ``ticker``. Holdings, which no source makes, are the quantity."""
    year = ("2022-01-01 00:00:00", "2022-12-31 23:59:59")
    spec = {
        "transaction_id": F.concat(F.lit("1110000"), F.col("id").cast("string")),
        "acct_id": random_account(seed, first, count),
        "ticker_symbol": From((), lambda df: choose_from(df, tickers, "ticker", "ticker_symbol", seed)),
        "transaction_type": choice("transaction_type", seed, TRANSACTION_TYPES),
        "quantity": uniform_double("quantity", seed, 10.0, 20_000.0),
        "price_per_share": uniform_double("price_per_share", seed, 50.0, 1_000.0),
        "transaction_date": uniform_timestamp("transaction_date", seed, *year),
        "order_type": choice("order_type", seed, ORDER_TYPES),
        "trade_status": choice("trade_status", seed, TRADE_STATUS),
        "created_date": uniform_timestamp("created_date", seed, *year),
        "total_amt": From(("quantity", "price_per_share"), "quantity * price_per_share"),
        "total_holdings": From(("quantity",), "quantity"),
    }
    return synthesize(ids, spec)
